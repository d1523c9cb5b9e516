"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record is ``length (8 bytes) | masked crc of it (4) | data | masked crc of the data (4) | newline``,
all little-endian. The data are a flag byte (1: the id is present), the id (8 bytes, signed) and the
token ids, 2 bytes each when the vocabulary allows it and 4 otherwise. Checksums are CRC-32, masked
by rotation and a constant so that a checksum over data that holds checksums stays meaningful. The
newline is written by Spark's text sink, the one sink that writes bytes as they are to any file
system that Spark reaches.
"""

import struct
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ridemetrics.llm.common import id_and_text, partitions, set_up, shared_folder, store, together

# Fixed value: constant of the checksum mask.
MASK_DELTA = 0xA282EAD8
END_ID = 1
# Bounds of a file, which a reading task holds whole. A file is written as packs of records, and it is
# as large as its packs: FILE_BYTES, or as many of the largest records as there are packs.
RECORDS_PER_FILE = 8192
FILE_BYTES = 1 << 26
PACKS_PER_FILE = 16
# Words, token ids and what it takes to keep them, that a process remembers, in bytes.
MEMO_BYTES = 96 << 20
# Texts that are encoded together: the more, the less often a word is looked up.
TOGETHER_BYTES = 1 << 22
_ENTRY_BYTES = 200
# Words that are encoded as one text.
ENCODED_TOGETHER = 256

# A letter of Latin script, ASCII punctuation, and the end of the word. The vocabulary cuts between them, as it does
# between any letter and punctuation; behind letters that normalising takes apart it may not.
_MARKS_AT_END = "([a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])([!-/:-@\\[-`{-~]+)(\\s|$)", r"\1 \2\3"
_CASE_MATTERS = "<\\||[\u0300-\u036f]"
_HEAD = struct.Struct("<QI")
_ID = struct.Struct("<?q")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """A record without its newline."""
    data = _ID.pack(doc_id is not None, doc_id or 0) + ids
    length = struct.pack("<Q", len(data))
    return b"".join((length, struct.pack("<I", masked_crc(length)), data, struct.pack("<I", masked_crc(data))))


def read_frame(content: bytes, offset: int) -> tuple[int | None, bytes, int]:
    """Id, token bytes and end of the record at ``offset``; a damaged record is an error."""
    head = content[offset : offset + _HEAD.size]
    if len(head) < _HEAD.size or masked_crc(head[:8]) != _HEAD.unpack(head)[1]:
        raise ValueError(f"damaged record length at {offset}")
    start = offset + _HEAD.size
    end = start + _HEAD.unpack(head)[0]
    data = content[start:end]
    if content[end : end + 4] != struct.pack("<I", masked_crc(data)) or content[end + 4 : end + 5] != b"\n":
        raise ValueError(f"damaged record at {offset}")
    known, doc_id = _ID.unpack_from(data)
    return (doc_id if known else None), data[_ID.size :], end + 5


class _Encoder:
    """Token ids of texts, word by word.

    The vocabulary's own splitting drops white space and never joins across it, ignores case, and
    cuts between letters and punctuation, so a text's ids are those of its words in turn. The words of
    a slice of texts are numbered in Arrow, so that each distinct one is looked up once, and the
    ids are gathered by number. A word met before is not encoded again; the memory is bounded in
    bytes and kept between tasks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.uint16 if len(vocabulary) <= 1 << 16 else np.uint32
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.held, self.known, self.older = 0, {}, {}

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text with the end's, as bytes."""
        texts = texts.cast(pa.string())
        lowered = pc.ascii_lower(texts)
        # Case matters in names of special tokens, and ahead of combining marks, as some letters are one
        # character together with a mark in only one of the cases.
        as_is = pc.match_substring_regex(texts, _CASE_MATTERS)
        if pc.any(as_is).as_py():
            lowered = pc.if_else(as_is, texts, lowered)
        parted = pc.replace_substring_regex(lowered, *_MARKS_AT_END)
        words = pc.ascii_split_whitespace(pc.if_else(as_is, lowered, parted))
        numbered = words.flatten().dictionary_encode()
        ids = self._of(numbered.dictionary.to_pylist())
        number = numbered.indices.to_numpy()
        offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32) // np.dtype(self.dtype).itemsize
        flat = pa.array(np.frombuffer(b"".join(ids), self.dtype))
        gathered = pa.ListArray.from_arrays(pa.array(offsets), flat).take(numbered.indices).flatten().to_numpy()
        past = np.r_[0, np.cumsum(np.diff(offsets)[number], dtype=np.int64)]
        bounds = past[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        end = np.array([END_ID], self.dtype).tobytes()
        return [gathered[a:b].tobytes() + end for a, b in zip(bounds, bounds[1:])]

    def _of(self, words: list[str]) -> list[bytes]:
        found = list(map(self.known.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        if not new:
            return found
        if self.held > MEMO_BYTES // 2:
            # What has not been met since the last time goes; what is met again moves up.
            self.older, self.known, self.held = self.known, {}, 0
        older, missing = self.older, []
        for i in new:
            ids = older.get(words[i])
            if ids is None:
                missing.append(words[i])
            else:
                self._keep(words[i], ids)
        if missing:
            self._learn(missing)
        for i in new:
            found[i] = self.known[words[i]]
        return found

    def _keep(self, word: str, ids: bytes) -> None:
        self.known[word] = ids
        self.held += _ENTRY_BYTES + len(ids)

    def _learn(self, words: list[str]) -> None:
        """Words of letters are encoded many at a time and cut at the tokens that end a word."""
        plain = [word for word in words if word.isalpha()]
        odd = [word for word in words if not word.isalpha()]
        groups = [plain[i : i + ENCODED_TOGETHER] for i in range(0, len(plain), ENCODED_TOGETHER)]
        for group, found in zip(groups, self._ids([" ".join(group) for group in groups])):
            past = np.flatnonzero(self.ends_word[found]) + 1
            if len(past) != len(group):  # a letter that the vocabulary rewrites
                odd += group
                continue
            raw, ends = found.tobytes(), (past * found.itemsize).tolist()
            self.known.update(zip(group, [raw[a:b] for a, b in zip([0, *ends], ends)]))
            self.held += len(group) * _ENTRY_BYTES + len(raw)
        for word, found in zip(odd, self._ids(odd)):
            self._keep(word, found.tobytes())

    def _ids(self, texts: list[str]):
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return (np.array(e.ids, self.dtype) for e in encoded)


@cache
def _encoder(path: str) -> _Encoder:
    """A process loads each vocabulary once."""
    return _Encoder(path)


def write_records(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text, ends it with ``END_ID`` and writes the records in ascending id order.

    Texts are range-partitioned by id (the texts are smaller than their token ids) and encoded on
    the far side, so each task writes its files as it goes. Null ids come first, null text counts
    as empty, rows with equal ids are ordered by a hash of their texts, other columns are not read. A text of
    any length is one record. The vocabulary must be present at ``tokenizer`` on every executor and must split at
    white space.
    """
    packs = min(PACKS_PER_FILE, RECORDS_PER_FILE)
    most_records, most_bytes = RECORDS_PER_FILE // packs, FILE_BYTES // packs

    def encode(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
        encoder = _encoder(tokenizer)
        pack, held = [], 0
        for batch in together(batches, TOGETHER_BYTES):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                record = frame(doc_id, ids)
                if pack and (len(pack) >= most_records or held + len(record) > most_bytes):
                    yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(pack)], pa.binary())], ["pack"])
                    pack, held = [], 0
                pack.append(record)
                held += len(record) + 1
        if pack:
            yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(pack)], pa.binary())], ["pack"])

    rows = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    records = ordered.drop("tie").mapInArrow(encode, "pack binary")
    # Spark casts bytes to a string without looking at them, and its text sink writes them unchanged.
    records.select(F.col("pack").cast("string")).write.option("maxRecordsPerFile", packs).text(path)


_INDEX = "file string, part int, chunk int, offset long, n_bytes long, doc_id long, n_tokens long, ids_crc32 long, before long"


def build_index(spark: SparkSession, path: str, token_bytes: int) -> DataFrame:
    """Checks every record and stores one row for each: file, offset, size, id, tokens.

    ``before`` counts the tokens ahead of the record in its file. A task holds one file at a time.
    """

    def scan(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                content = content.as_py()
                rows, offset, before = [], 0, 0
                while offset < len(content):
                    doc_id, ids, end = read_frame(content, offset)
                    wide = np.frombuffer(ids, f"<u{token_bytes}").astype("<u4")
                    rows.append((offset, end - offset, doc_id, len(wide), zlib.crc32(wide.tobytes()), before))
                    offset, before = end, before + len(wide)
                if not rows:
                    continue
                part, chunk = _place(name)
                arrays = [pa.array([name] * len(rows)), *(pa.array([x] * len(rows), pa.int32()) for x in (part, chunk))]
                arrays += [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _INDEX.split(", ")])

    set_up(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return store(files.mapInArrow(scan, _INDEX), "record-index")


def _place(name: str) -> tuple[int, int]:
    """Numbers of the writing task and of the file within it, from Spark's file name."""
    words = name.rpartition("/")[2].split(".")[0].split("-")
    return int(words[1]), int(words[-1][1:]) if words[-1][1:].isdigit() else 0


def with_starts(index: DataFrame) -> DataFrame:
    """Adds ``start``, the tokens of all records before; only the table of files is ordered as a whole."""
    files = index.groupBy("part", "chunk").agg(F.sum("n_tokens").alias("_tokens"))
    earlier = Window.orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", "chunk", F.coalesce(F.sum("_tokens").over(earlier), F.lit(0)).alias("_start"))
    return index.join(files, ["part", "chunk"]).withColumn("start", F.col("_start") + F.col("before")).drop("_start")


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, seed: int, token_bytes: int) -> DataFrame:
    """``place, doc_id, ids`` of all records; sorted by ``place`` they are in the random order of ``seed``.

    Each file is read once, and its records are cut out by the offsets of the index.
    """
    set_up(spark)
    offsets = index.groupBy("file").agg(F.collect_list("offset").alias("offsets"))  # bounded by RECORDS_PER_FILE
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    joined = files.join(offsets, files["path"] == offsets["file"]).select("file", "offsets", "content")

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = [read_frame(row["content"], o)[:2] for o in row["offsets"]]
                ids = [np.frombuffer(x, f"<u{token_bytes}").astype(np.int64) for _, x in found]
                arrays = [pa.array([row["file"]] * len(ids)), pa.array(row["offsets"], pa.int64())]
                arrays += [pa.array([d for d, _ in found], pa.int64()), pa.array(ids, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["file", "offset", "doc_id", "ids"])

    records = joined.mapInArrow(cut, "file string, offset long, doc_id long, ids array<long>")
    return records.select(F.xxhash64(F.lit(seed), "file", "offset").alias("place"), "doc_id", "ids")


def token_bytes(tokenizer: str) -> int:
    return np.dtype(_encoder(tokenizer).dtype).itemsize


def encode_to_records(docs: DataFrame, tokenizer: str, path: str | None = None, **columns) -> tuple[str, DataFrame]:
    """Writes records and index; returns the folder and the index with ``start``."""
    spark = docs.sparkSession
    path = path or shared_folder(spark, "token-records")
    write_records(docs, path, tokenizer, **columns)
    return path, with_starts(build_index(spark, path, token_bytes(tokenizer)))
