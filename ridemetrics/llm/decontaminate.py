"""Benchmark decontamination by a positional inverted index of the training tokens, in shards of documents.

1. The index is built once, from the training texts alone. A shard holds some documents; for every term in them, as a
   64-bit hash, the sorted positions at which it stands. It is stored, and any benchmark is answered from it.
2. Test items are cut into windows of words. Their terms' counts, summed over the dictionaries of all shards, put
   the words of each window in the order of rarity.
3. In each shard the postings of the rarest term of every window whose terms are all there are moved by the
   term's offset and intersected with the moved lists of the next rarer terms, of all windows at a time. Words may
   first be ``slop`` off their places; what is left is the proximity matches, and among them are the phrases.

Nothing is shuffled but counts. Test items are broadcast in blocks of bounded size; however many blocks there are,
each is matched against the whole index.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ridemetrics.llm.common import LARGE_ROWS, id_and_text, slices, store, together
from ridemetrics.llm.ngram_join import _word_hashes

WINDOW_WORDS = 13
# Test words that one pass over the index handles; bounds what is broadcast.
BLOCK_WORDS = 1_000_000
# Text of a shard; a longer document is a shard by itself.
SHARD_BYTES = 1 << 18
# Places that are intersected at a time, at least those of one window.
CANDIDATES = 1 << 20

_WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin, with the end of the last.

    Words are runs of digits, letters (A-Z in lower case) and non-ASCII characters.
    """
    raw = np.frombuffer(b" ".join([*texts, b""]).translate(_WORD_BYTES), np.uint8)
    hashes, starts = _word_hashes(raw)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.r_[0, np.searchsorted(starts, ends)].astype(np.int64)


# --- the index --------------------------------------------------------------------------------------

_SHARD = "doc_ids array<long>, keys array<long>, first array<long>, terms binary, lengths binary, positions binary"


def _index(docs: DataFrame) -> DataFrame:
    """Stored shards of ``doc_id, key, text``: documents, where their words begin, and postings of all terms."""
    limit = SHARD_BYTES

    def build(batches):
        for batch in together(batches, limit):
            hashes, first = _terms(batch.column("text").to_pylist())
            order = np.argsort(hashes, kind="stable")
            new = np.flatnonzero(np.r_[True, np.diff(hashes[order]) != 0][: len(order)])
            parts = hashes[order][new], np.diff(np.r_[new, len(order)]).astype(np.int32), order.astype(np.int32)
            columns = [pa.array([batch.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("doc_id", "key")]
            columns += [pa.array([first.tolist()], pa.list_(pa.int64()))]
            columns += [pa.array([x.tobytes()], pa.binary()) for x in parts]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SHARD.split(", ")])

    return store(docs.mapInArrow(build, _SHARD), "postings", LARGE_ROWS)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored positional index of all words of all documents, for ``search``.

    Each row is a document with a number of its own, whatever its id; null and empty texts have no words. A shard
    holds SHARD_BYTES of text, or one longer document. Other columns are not read.
    """
    return _index(id_and_text(docs, id_col, text_col).withColumn("key", F.monotonically_increasing_id()))


# --- test items ------------------------------------------------------------------------------------


class TestWindows:
    """Windows of one block of test items, as numbers of their terms, by length."""

    __test__ = False

    def __init__(self, items, window_words: int = WINDOW_WORDS):
        places = defaultdict(set)  # window -> its items
        hashes, first = _terms([text for _, text in items])
        for (item_id, _), a, b in zip(items, first.tolist(), first[1:].tolist()):
            found = hashes[a:b].tobytes()
            for start in range(max(1, b - a - window_words + 1) if b > a else 0):
                places[found[8 * start : 8 * min(start + window_words, b - a)]].add(item_id)
        self.candidates = CANDIDATES
        self.terms = np.unique(hashes)
        by_length = defaultdict(list)
        for window in places:
            by_length[len(window) // 8].append(window)
        self.groups = []
        for length, windows in by_length.items():
            terms = np.searchsorted(self.terms, np.frombuffer(b"".join(windows), np.uint64)).reshape(-1, length)
            self.groups.append((terms.astype(np.int32), [sorted(i for i in places[w] if i is not None) for w in windows]))

    def order(self, counts: np.ndarray) -> None:
        """Drops windows with an absent term and sorts the places of the others by how rare their terms are."""
        kept = []
        for terms, items in self.groups:
            there = np.flatnonzero((counts[terms] > 0).all(1))
            if len(there):
                rarity = np.argsort(counts[terms[there]], axis=1, kind="stable")
                kept.append((terms[there], rarity, [items[k] for k in there.tolist()]))
        self.groups = kept


def _count_terms(index: DataFrame, shared) -> DataFrame:
    """How often each test term stands in the training texts, from the dictionaries of the shards."""

    def count(batches):
        terms = shared.value.terms
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for own, lengths in zip(batch.column("terms").to_pylist(), batch.column("lengths").to_pylist()):
                at, there = _found(np.frombuffer(own, np.uint64), terms)
                total[there] += np.frombuffer(lengths, np.int32)[at[there]]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "n"])

    counted = index.select("terms", "lengths").mapInArrow(count, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def _found(own: np.ndarray, terms: np.ndarray):
    """Place of each of ``terms`` in the sorted ``own``, and whether it is there."""
    if not len(own):
        return np.zeros(len(terms), np.int64), np.zeros(len(terms), bool)
    at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
    return at, own[at] == terms


# --- matching ---------------------------------------------------------------------------------------


class _Shard:
    def __init__(self, row: dict):
        self.terms, self.lengths = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.positions = np.frombuffer(row["positions"], np.int32).astype(np.int64)
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.first = np.asarray(row["first"], np.int64)
        self.n = len(self.positions)
        # Term and position as one number: all lists one behind the other, sorted.
        self.keys = np.repeat(np.arange(len(self.terms)), self.lengths) * self.n + self.positions

    def matches(self, test: TestWindows, slop: int):
        """``(document, start, past, items, is exact)`` of each window's matches."""
        at, there = _found(self.terms, test.terms)
        for terms, rarity, items in test.groups:
            windows = np.flatnonzero(there[terms].all(1))
            rarest = at[terms[windows, rarity[windows, 0]]]
            load = np.cumsum(self.lengths[rarest])
            cuts = np.searchsorted(load, np.arange(test.candidates, load[-1], test.candidates)) if len(load) else []
            for part in np.split(np.arange(len(windows)), cuts):
                if len(part):
                    yield from self._of(windows[part], rarest[part], at[terms], rarity, items, slop)

    def _of(self, windows, rarest, lists, rarity, items, slop):
        size = self.lengths[rarest]
        window = np.repeat(windows, size)
        place = np.arange(len(window)) - np.repeat(np.cumsum(size) - size, size)
        anchor = self.positions[np.repeat(self.begin[rarest], size) + place]
        document = np.searchsorted(self.first, anchor, "right") - 1
        start = anchor - rarity[window, 0]
        for off in (slop, 0) if slop else (0,):
            if not off:
                keep = (start >= self.first[document]) & (start + rarity.shape[1] <= self.first[document + 1])
                window, start, document = window[keep], start[keep], document[keep]
            # The lists of the rarest terms first: few places are left after two or three of them.
            for r in range(1, rarity.shape[1] if len(window) else 1):
                moved = start + rarity[window, r]
                of = lists[window, rarity[window, r]] * self.n
                low = of + np.maximum(moved - off, self.first[document])
                high = of + np.minimum(moved + off, self.first[document + 1] - 1)
                near = self.keys[np.minimum(np.searchsorted(self.keys, low), self.n - 1)]
                keep = (near >= low) & (near <= high)
                window, start, document = window[keep], start[keep], document[keep]
            for w, s, d in zip(window.tolist(), start.tolist(), document.tolist()):
                yield d, s, s + rarity.shape[1], items[w], not off


_MATCHES = "doc_id long, key long, n_words long, spans array<struct<first:long,past:long>>, items array<long>, near array<long>"


def _match(index: DataFrame, shared, slop: int) -> DataFrame:
    def match(batches):
        span = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))
        for batch in slices(batches, "positions"):
            for row in batch.to_pylist():
                shard, size = _Shard(row), len(row["keys"])
                spans, items, near = ([() for _ in range(size)] for _ in range(3))
                found = defaultdict(lambda: (set(), set(), set()))
                for document, start, past, ids, exact in shard.matches(shared.value, slop):
                    at, exactly, nearly = found[document]
                    nearly.update(ids)
                    if exact:
                        at.add((start, past))
                        exactly.update(ids)
                for document, (at, exactly, nearly) in found.items():
                    first = row["first"][document]
                    spans[document] = [{"first": a - first, "past": b - first} for a, b in _joined(at)]
                    items[document], near[document] = sorted(exactly), sorted(nearly)
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["keys"], pa.int64()), pa.array(np.diff(shard.first))]
                columns += [pa.array(spans, span), pa.array(items, pa.list_(pa.int64())), pa.array(near, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_words", "spans", "items", "near"])

    return index.mapInArrow(match, _MATCHES)


def _joined(spans):
    """Disjoint spans that cover the same words, in order."""
    out = []
    for first, past in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], past)
        else:
            out.append([first, past])
    return out


def _block_count(items: DataFrame, block_words: int) -> int:
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    return -(-size // (2 * block_words)) or 1


def _blocks(items: DataFrame, count: int):
    """Lists of (item_id, text); each holds about a block's words and is all that is on the driver."""
    for k in range(count):
        part = items if count == 1 else items.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)) == k)
        yield [(row["doc_id"], bytes(row["text"])) for row in part.toLocalIterator()]


def _passages(index: DataFrame, tests: DataFrame, block_words: int, window_words: int = WINDOW_WORDS, slop: int = 2) -> DataFrame:
    """Answers per document of an index; with several blocks of items, rows with equal id and key become one."""
    spark = index.sparkSession
    answers = []
    for block in _blocks(tests, _block_count(tests, block_words)):
        test = TestWindows(block, window_words)
        shared = spark.sparkContext.broadcast(test)
        counts = np.zeros(len(test.terms), np.int64)
        if len(test.terms):
            # At most one row per test term of the block.
            for term, n in _count_terms(index, shared).collect():
                counts[term] = n
        test.order(counts)
        answers.append(_match(index, spark.sparkContext.broadcast(test), slop))
    if len(answers) == 1:
        return answers[0]
    every = answers[0]
    for answer in answers[1:]:
        every = every.unionByName(answer)
    merged = every.groupBy("doc_id", "key", "n_words").agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "near")]
    )
    return merged.select(
        "doc_id", "key", "n_words", "spans", *[F.array_sort(F.array_distinct(c)).alias(c) for c in ("items", "near")]
    )


def search(
    index: DataFrame,
    items: DataFrame,
    window_words: int = WINDOW_WORDS,
    slop: int = 2,
    block_words: int = BLOCK_WORDS,
    text_col: str = "text",
    item_id_col: str = "item_id",
) -> DataFrame:
    """Per document of an index from ``build_index``: ``doc_id, n_words, spans, items, near``.

    ``spans`` are the word ranges covered by occurrences of test windows, ``items`` the ids of the
    items with an occurring window, ``near`` those with a window whose words all stand within
    ``slop`` of their places (the exact ones among them). An item shorter than a window is one
    window; an item without words matches nothing; an item without an id covers words and is not
    listed; repeated items count once.

    Rows are answered one by one, whatever their ids and however many blocks of items there are; with several
    ``spans`` may overlap. Empty tables on either side are allowed, and other columns are not read.
    """
    return _passages(index, id_and_text(items, item_id_col, text_col), block_words, window_words, slop).drop("key")


def find_test_passages(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """``search`` for ``items`` in an index made of ``docs``."""
    return search(build_index(docs, id_col, text_col), items, text_col=text_col, **options)


def hit_words(spans="spans"):
    """Number of words covered by spans that may overlap: they are swept in order."""
    step = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("past")),
        lambda acc, s: F.struct(
            (acc["hit"] + F.greatest(F.lit(0), s["past"] - F.greatest(acc["past"], s["first"]))).alias("hit"),
            F.greatest(acc["past"], s["past"]).alias("past"),
        ),
    )
    return step["hit"]


def _contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def contamination(passages: DataFrame) -> DataFrame:
    """Counts of ``find_test_passages`` per document; contaminated from one hit word in twenty on."""
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    counted = passages.withColumn("n_hit", hit_words())
    return counted.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        _contaminated().alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    block_words: int = BLOCK_WORDS,
    **options,
) -> DataFrame:
    """``docs`` without contaminated documents, all columns; null ids stay, as they name no document.

    Of rows with one id, those go whose own text is contaminated.
    """
    tests = id_and_text(items, item_id_col, text_col)
    rows = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    found = _passages(_index(rows), tests, block_words, **options)
    bad = found.withColumn("n_hit", hit_words()).filter(_contaminated()).select("doc_id", "key").distinct()
    bad = store(bad, "contaminated")
    # The rows travel as one column, so no name of theirs can clash.
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("key"),
    )
    return whole.join(bad, ["doc_id", "key"], "left_anti").select("row.*")
