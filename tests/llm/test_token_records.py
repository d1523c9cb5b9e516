import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ridemetrics.llm import token_records
from ridemetrics.llm.token_records import build_index, encode_to_records, frame, read_frame, read_shuffled, token_bytes

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, "Hello WORLD's it'll 'S", "a.b.c ... foo). bar,", "<|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y.", "ΣΑΣ ς. İstanbul",
    "é É. ́x", "क़. क़ क़,", " a b​c\u0085d", "1234 12.5, $$$***", "\x00 \x1c\x1d a\x1fb", "日本語。テスト, 한국어.", "x " * 30000,
]


def _plain(rows):
    """(id, start, tokens, crc) from the library's own encoding of whole texts."""
    tokenizer, start, out = Tokenizer.from_file(VOCABULARY), 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = [(3 * i - 50, t) for i, t in enumerate(ODD + texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").orderBy(F.rand(1))
    path = f"{tmp_path_factory.mktemp('records').as_uri()}/records"
    return rows, *encode_to_records(docs.withColumns({"tie": F.lit(1), "record": F.lit("r"), "start": F.lit(0)}), VOCABULARY, path)


def test_equals_the_library(written):
    rows, _, index = written
    got = index.orderBy("doc_id").select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert list(map(tuple, got)) == _plain(rows)


def test_several_files_in_order(written):
    _, path, index = written
    assert len(list(Path(path.removeprefix("file:")).glob("part-*"))) > 1
    places = index.orderBy("part", "chunk", "offset").select("doc_id").collect()
    assert places == sorted(places)


def test_shuffled_read_gives_all_records(spark, written):
    rows, path, index = written
    orders = []
    for seed in (1, 2):
        found = read_shuffled(spark, path, index, seed, token_bytes(VOCABULARY)).orderBy("place").collect()
        assert {r.doc_id: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in found} == {d: c for d, _, _, c in _plain(rows)}
        orders.append([r.doc_id for r in found])
    assert orders[0] != orders[1]


@pytest.mark.parametrize("at", [0, 9, 14, -3, -1])
def test_damage_is_found(at):
    record = bytearray(frame(7, b"\x01\x00\x02\x00") + b"\n")
    assert read_frame(bytes(record), 0) == (7, b"\x01\x00\x02\x00", len(record))
    record[at] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        read_frame(bytes(record), 0)


def test_ties_nulls_and_empty_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_records, "RECORDS_PER_FILE", 2)
    rows = [(None, "b"), (1, "x y"), (1, "x y"), (1, "z"), (2, None)]
    _, index = encode_to_records(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY, f"{tmp_path.as_uri()}/a")
    got = index.orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 1, 1, 2]
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got[:-1]]))
    _, index = encode_to_records(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY, f"{tmp_path.as_uri()}/b")
    assert index.count() == 0


def test_random_texts_over_letters_that_the_vocabulary_rewrites():
    """Letters whose case, composition or compatibility form changes, next to points, commas and marks."""
    rng, encoder, library = random.Random(5), token_records._Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    letters = "JHTWYAaZéÉİIıßŉǰΐΰḱẖẗẘẙẚﬁΣςσϓΩÅKſ가각ก็क़ग़य़אבּ יִاأ中文ΆxyzLJDž①２½ªʰ" + "".join(map(chr, range(0x300, 0x330)))
    pool = [*letters, *"aeéÀ", *".,.,.,'!?-$%12  \n\t "]
    texts = ["".join(rng.choices(pool, k=rng.randrange(1, 14))) for _ in range(200_000)]
    for start in range(0, len(texts), 10_000):
        part = texts[start : start + 10_000]
        found = encoder.encode(pa.array([t.encode() for t in part], pa.binary()))
        for text, ids, expected in zip(part, found, library.encode_batch(part, add_special_tokens=False)):
            assert np.frombuffer(ids, encoder.dtype).tolist() == [*expected.ids, 1], ascii(text)


def test_memory_and_files_are_bounded_in_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_records, "MEMO_BYTES", 5000)
    monkeypatch.setattr(token_records, "FILE_BYTES", 20_000)
    encoder = token_records._Encoder(VOCABULARY)
    for k in range(30):
        encoder.encode(pa.array([" ".join(f"word{k}x{i}" for i in range(10)).encode()], pa.binary()))
        assert encoder.held <= 5000 + 30 * 1000
    assert len(encoder.known) + len(encoder.older) < 300
    rows = [(i, "lorem " * (3000 if i % 10 == 0 else 3)) for i in range(200)]
    path, index = encode_to_records(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), VOCABULARY, f"{tmp_path.as_uri()}/a")
    sizes = [f.stat().st_size for f in Path(path.removeprefix("file:")).glob("part-*")]
    # As many packs as a file has, each of its share of the bytes or of one record.
    assert max(sizes) <= token_records.PACKS_PER_FILE * max(20_000 // token_records.PACKS_PER_FILE, 6100)
    assert [r.doc_id for r in index.orderBy("start").collect()] == list(range(200))


def test_a_very_long_text(spark, tmp_path):
    text = "Éa, b. " * 400_000
    _, index = encode_to_records(spark.createDataFrame([(1, text), (2, "x" * 300_000)], "doc_id long, text string"), VOCABULARY, f"{tmp_path.as_uri()}/a")
    assert [tuple(r) for r in index.orderBy("start").select("doc_id", "start", "n_tokens", "ids_crc32").collect()] == _plain([(1, text), (2, "x" * 300_000)])
