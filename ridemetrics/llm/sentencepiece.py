"""SentencePiece encoding by a Viterbi search over an Aho-Corasick automaton, and decoding.

The automaton runs over the text once. At each position its output links name all pieces that end
there, and each may improve the best score of that position. A character that is no piece costs a
penalty and is encoded as its UTF-8 bytes.

No piece holds a space after another character (checked when the model is loaded), so every space
that follows one starts a new piece, the search splits there exactly, and the result for a stretch
of text is remembered.
"""

import re
import zlib
from array import array
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ridemetrics.llm.common import SLICE_BYTES, set_up

SPACE = "▁"
# Fixed value: what an unknown character costs below the worst piece.
UNKNOWN_PENALTY = 10.0
# Stretches of text whose pieces a process remembers, twice: those met lately and those before.
MEMO = 150_000

_STRETCH = re.compile(f"{SPACE}+[^{SPACE}]*")


def log_score(score: float, ranked: bool) -> float:
    """Score of a piece as a log probability. Merge models store the rank, which Zipf's law turns into one."""
    return float(np.float32(-np.log(2.0 - score))) if ranked else score


class Encoder(dict):
    """Pieces of a model; as a dictionary, the token bytes of stretches met before."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        """``kinds``: ``normal``, ``byte`` or ``other`` (never matched) by piece."""
        self.kinds = kinds
        self.before: dict[str, bytes] = {}
        self.byte_ids = {}
        self.automaton = ahocorasick.Automaton()
        self.text_of = []
        lowest = min((s for s, k in zip(scores, kinds) if k == "normal"), default=0.0)
        self.unknown = lowest - UNKNOWN_PENALTY
        self.single = set()
        for i, (piece, score, kind) in enumerate(zip(pieces, scores, kinds)):
            if kind == "normal":
                if re.search(f"[^{SPACE}]{SPACE}", piece):
                    raise ValueError(f"piece {piece!r} spans words")
                self.automaton.add_word(piece, (len(piece), i, score))
                self.text_of.append(piece.replace(SPACE, " ").encode())
                if len(piece) == 1:
                    self.single.add(piece)
            elif kind == "byte":
                self.byte_ids[int(piece[3:5], 16)] = i
                self.text_of.append(bytes([int(piece[3:5], 16)]))
            else:
                self.text_of.append(b"")
        self.automaton.make_automaton()
        self.is_byte = np.array([k == "byte" for k in kinds])
        self.dtype, self.code = (np.uint16, "H") if len(pieces) <= 1 << 16 else (np.uint32, "I")

    def search(self, text: str) -> list[int]:
        """Ids of the best segmentation of ``text`` (spaces as ``SPACE``); of equal ones, longer pieces first."""
        if not self.single.issuperset(text):
            return self._search_with_unknown(text)
        size = len(text)
        best, chosen = [0.0] + [-np.inf] * size, [None] * (size + 1)
        for last, piece in self.automaton.iter(text):
            end = last + 1
            total = best[end - piece[0]] + piece[2]
            if total > best[end]:
                best[end], chosen[end] = total, piece
        ids = []
        while size:
            length, i, _ = chosen[size]
            ids.append(i)
            size -= length
        return ids[::-1]

    def _search_with_unknown(self, text: str) -> list[int]:
        """The same when some characters are no pieces: an edge over each of them is tried as well."""
        size = len(text)
        best, from_, piece = [0.0] + [-np.inf] * size, [0] * (size + 1), [-1] * (size + 1)
        unknown = {i for i, c in enumerate(text) if c not in self.single}
        done = 0

        def pass_unknown(upto):
            nonlocal done
            while done < upto:
                if done in unknown and best[done] + self.unknown > best[done + 1]:
                    best[done + 1], from_[done + 1], piece[done + 1] = best[done] + self.unknown, done, -1
                done += 1

        for last, (length, i, score) in self.automaton.iter(text):
            if unknown and last > done:
                pass_unknown(last)
            end = last + 1
            total = best[end - length] + score
            if total > best[end]:
                best[end], from_[end], piece[end] = total, end - length, i
        pass_unknown(size)
        ids = []
        while size:
            start = from_[size]
            if piece[size] < 0:
                ids += [self.byte_ids[b] for b in reversed(text[start:size].encode())]
            else:
                ids.append(piece[size])
            size = start
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), self.dtype)

    def encode_bytes(self, text: str) -> bytes:
        if not text:
            return b""
        if SPACE in text or "  " in text or text[0] == " ":
            stretches = [s[1:] for s in _STRETCH.findall(SPACE + text.replace(" ", SPACE))]
        else:
            stretches = text.split(" ")
        found = list(map(self.get, stretches))
        if None in found:
            if len(self) > MEMO:
                self.before = dict(self)
                self.clear()
                found = [None] * len(stretches)
            for k, ids in enumerate(found):
                if ids is None:
                    ids = self.get(stretches[k])
                    if ids is None:
                        ids = self.before.get(stretches[k])
                        if ids is None:
                            ids = array(self.code, self.search(SPACE + stretches[k])).tobytes()
                        self[stretches[k]] = ids
                    found[k] = ids
        return b"".join(found)

    def decode(self, ids) -> bytes:
        """Text of ``ids`` in UTF-8, without the space that encoding puts first."""
        text = b"".join(map(self.text_of.__getitem__, ids))
        return text[1:] if text[:1] == b" " else text


@cache
def load(path: str) -> Encoder:
    """The model at ``path``, once per process."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kinds = [
        "byte" if model.is_byte(i) else "other" if model.is_unknown(i) or model.is_control(i) or model.is_unused(i) else "normal"
        for i in ids
    ]
    scores = [model.get_score(i) for i in ids]
    # Merge models score by rank: whole numbers from 0 down, each once.
    normal = [s for s, k in zip(scores, kinds) if k == "normal"]
    ranked = all(s == int(s) and s <= 0 for s in normal)
    return Encoder([model.id_to_piece(i) for i in ids], [log_score(s, ranked) for s in scores], kinds)


def encoded(text: Column, model: str) -> Column:
    """``struct<ids, n_bytes, ids_crc32, round_trip>`` of a text column.

    ``n_bytes`` counts byte pieces, ``ids_crc32`` covers the ids as little-endian 32-bit numbers, and
    ``round_trip`` tells whether decoding the ids gives the text back (it does unless the text holds
    the character that stands for a space). Null and empty texts have no ids. The model file must be
    present at ``model`` on every executor.
    """

    def encode(texts: pa.Array) -> pa.Array:
        encoder = load(model)
        parts = []
        for start, stop in _runs(texts):
            ids, n_bytes, crcs, same = [], [], [], []
            for text in texts[start:stop]:
                text = text.as_py() or ""
                found = encoder.encode(text)
                ids.append(found)
                n_bytes.append(int(encoder.is_byte[found].sum()))
                crcs.append(zlib.crc32(found.astype("<u4").tobytes()))
                same.append(encoder.decode(found.tolist()) == text.encode())
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32))
            arrays = [lists, pa.array(n_bytes, pa.int64()), pa.array(crcs, pa.int64()), pa.array(same, pa.bool_())]
            parts.append(pa.StructArray.from_arrays(arrays, ["ids", "n_bytes", "ids_crc32", "round_trip"]))
        if not parts:
            return pa.array([], _RESULT)
        return pa.concat_arrays(parts).cast(_RESULT)

    return F.arrow_udf(encode, "ids array<int>, n_bytes long, ids_crc32 long, round_trip boolean")(text.cast("string"))


_RESULT = pa.struct(
    [("ids", pa.list_(pa.int32())), ("n_bytes", pa.int64()), ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())]
)


def _runs(texts: pa.Array):
    """Stretches of a batch of about SLICE_BYTES each."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text.as_buffer()) if text.is_valid else 0
        if held > SLICE_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_pieces(docs: DataFrame, model: str, text_col: str = "text", into: str = "pieces") -> DataFrame:
    """``docs`` with the struct of ``encoded`` in column ``into``, which it replaces if present."""
    set_up(docs.sparkSession)
    return docs.withColumn(into, encoded(F.col(f"`{text_col}`"), model))


def decode_pieces(docs: DataFrame, model: str, ids_col: str, into: str = "text") -> DataFrame:
    """``docs`` with the text of the ids in ``ids_col``; null ids give null, damaged UTF-8 is replaced."""
    set_up(docs.sparkSession)

    def decode(lists: pa.Array) -> pa.Array:
        encoder = load(model)
        return pa.array([None if x is None else encoder.decode(x).decode("utf-8", "replace") for x in lists.to_pylist()], pa.string())

    return docs.withColumn(into, F.arrow_udf(decode, "string")(F.col(f"`{ids_col}`").cast("array<int>")))
