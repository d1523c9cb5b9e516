"""Language-model scores: prediction by partial matching over bytes, and a word unigram beside it.

The byte model is a trie of contexts of up to ``ORDER`` bytes, counted over all training texts.
A byte seen after the longest known context has probability c / (n + d) there, with n occurrences
of d different bytes; the escape to the next shorter context has d / (n + d). Bytes that the longer
context has seen are excluded from the shorter one's counts; below order 0 the bytes left are
equally likely. As every byte seen after a context is also seen after its suffix, what is excluded
depends on the next longer context only, so the code length of a byte after a context, escapes
included, is one number, which all texts share.

All counts of the longest order are a stored table, and the shorter orders are summed from it. The
code lengths of the most frequent sequences are broadcast; a text's other sequences are joined with
the stored ones. Sequences that training has not seen descend order by order, each distinct one once;
the lowest orders, of which there are 65,536 contexts at most, are a dense table.

Texts are framed by a marker that UTF-8 never uses: it fills the context ahead of the first byte
and is the symbol that ends the text, so a score is the probability of the text as a whole.
"""

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ridemetrics.llm.common import id_and_text, slices, store

ORDER = 5
MARK = 0xFF
# Longest order of the dense table in the query.
TABLE_ORDER = 2
# Contexts of its longest order that a dense table keeps, the most frequent ones; all that there can
# be at TABLE_ORDER.
TRIE_CONTEXTS = 1 << 16
# Byte sequences whose code lengths are broadcast, at most; the others are joined.
COMMON_GRAMS = 1 << 21
# Words whose counts are broadcast, at most. None of the others holds much more than one token in so
# many, so they are joined without a hot key.
COMMON_WORDS = 1 << 17
# Distinct words that a task counts before it hands them on, and their bytes.
COUNTED_WORDS = 1_000_000
COUNTED_BYTES = 1 << 26
# The same for byte sequences.
COUNTED_GRAMS = 4_000_000
# Stands for the end of a text among the words; no word can hold a space.
END = b" "


def training(doc_id="doc_id"):
    """Six documents in seven, by checksum of the id (a null id counts as an empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(7)) != 2


def _framed(texts):
    """Bytes of all texts, each with its frame, and the place of each text's first byte."""
    pad = bytes([MARK]) * ORDER
    joined = np.frombuffer(pad + b"".join([t + pad for t in texts]), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = ORDER + np.r_[0, np.cumsum(lengths + ORDER)[:-1]].astype(np.int64)
    return joined, starts, lengths


def _coded(starts, lengths, size):
    """Mask of the bytes that are coded: all of each text and one marker after it."""
    coded = np.zeros(size + 1, np.int32)
    np.add.at(coded, starts, 1)
    np.add.at(coded, starts + lengths + 1, -1)
    return np.cumsum(coded[:-1]).astype(bool)


def _keys(raw):
    """The ORDER bytes ahead of each byte from the ORDER-th on, and the byte, as one number."""
    wide = raw.astype(np.int64)
    keys = wide[ORDER:].copy()
    for k in range(ORDER):
        keys |= wide[k : len(wide) - ORDER + k] << 8 * (ORDER - k)
    return keys


# --- counting -----------------------------------------------------------------------------------

_COUNTS = "word binary, gram long, n long"


def _counts(texts: DataFrame) -> DataFrame:
    """Counts of words (ends of texts among them) and of byte sequences of ORDER + 1, by task."""

    def count(batches):
        seen, grams = Counter(), []

        def handed_on():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.nulls(len(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                ["word", "gram", "n"],
            )
            seen.clear()

        def merged():
            keys = np.concatenate([k for k, _ in grams])
            found, place = np.unique(keys, return_inverse=True)
            return found, np.bincount(place, np.concatenate([c for _, c in grams])).astype(np.int64)

        def of_grams():
            keys, n = merged()
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(keys), pa.binary()), pa.array(keys), pa.array(n)], ["word", "gram", "n"]
            )

        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            for text in texts:
                seen.update(text.lower().split())
            seen[END] += len(texts)
            raw, starts, lengths = _framed(texts)
            keys = _keys(raw)[_coded(starts, lengths, len(raw))[ORDER:]]
            grams.append(np.unique(keys, return_counts=True))
            if len(grams) > 16:
                grams[:] = [merged()]
                if len(grams[0][0]) > COUNTED_GRAMS:
                    yield of_grams()
                    grams.clear()
                if sum(map(len, seen)) > COUNTED_BYTES:
                    yield from handed_on()
            if len(seen) > COUNTED_WORDS:
                yield from handed_on()
        if seen:
            yield from handed_on()
        if grams:
            yield of_grams()

    return texts.mapInArrow(count, _COUNTS)


# --- the lowest orders as a table --------------------------------------------------------------------------


class CodeTable:
    """Code lengths in decimal digits: ``cost[row[context], symbol]``, and ``after`` an escape from there.

    ``keys`` are sequences of ``longest`` + 1 bytes. ``symbol_of`` maps bytes to the symbols seen in training; the last symbol is any other byte.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, longest: int = 3):
        self.longest = longest
        raw = self._bytes(keys)
        used = np.unique(np.append(raw, MARK))
        self.size = size = len(used) + 1
        self.symbol_of = np.full(256, size - 1, np.int64)
        self.symbol_of[used] = np.arange(size - 1)
        s = self.symbol_of[raw]
        rows, escapes, contexts = [], [], []
        for order in range(longest + 1):
            index = np.zeros(len(counts), np.int64)
            for k in range(longest - order, longest):
                index = index * size + s[k]
            found, place = np.unique(index, return_inverse=True)
            if order == longest and len(found) > TRIE_CONTEXTS:
                weight = np.bincount(place, counts, len(found))
                best = np.sort(np.argsort(-weight, kind="stable")[:TRIE_CONTEXTS])
                number = np.full(len(found), -1)
                number[best] = np.arange(len(best))
                found, place = found[best], number[place]
            seen = np.zeros((len(found), size))
            np.add.at(seen, (place[place >= 0], s[longest][place >= 0]), counts[place >= 0])
            shorter = None if not order else np.searchsorted(contexts[-1], found % size ** (order - 1))
            cost, escape = self._level(seen, shorter, rows and self._seen, escapes and escapes[-1])
            self._seen = seen
            rows.append(cost)
            escapes.append(escape)
            contexts.append(found)
        del self._seen
        self.cost = np.concatenate(rows)
        self.after = np.concatenate(escapes)
        offset = np.cumsum([0] + [len(r) for r in rows])
        self.row = np.zeros(1, np.int32)  # order 0 has one row, the first
        for order in range(1, longest + 1):
            self.row = np.tile(self.row, size)
            self.row[contexts[order]] = offset[order] + np.arange(len(contexts[order]))

    def _level(self, seen, shorter, seen_shorter, escape_shorter):
        """Costs after the contexts of one order, and costs of what follows an escape from them."""
        n, d = seen.sum(1, keepdims=True), (seen > 0).sum(1, keepdims=True)
        if shorter is None:
            escape = np.full(seen.shape, np.log10(max(1, 256 - int(d[0, 0]))))
        else:
            below = seen_shorter[shorter]
            left = np.where(seen > 0, 0, below)
            n_left, d_left = left.sum(1, keepdims=True), (left > 0).sum(1, keepdims=True)
            total = np.log10(np.maximum(1, n_left + d_left))
            again = np.where(d_left > 0, total - np.log10(np.maximum(1, d_left)), 0.0)
            escape = np.where(left > 0, total - np.log10(np.maximum(1, left)), again + escape_shorter[shorter])
        total = np.log10(n + d)
        return np.where(seen > 0, total - np.log10(np.maximum(1, seen)), total - np.log10(d) + escape), escape

    def _bytes(self, keys):
        return np.stack([keys >> 8 * (self.longest - k) & 255 for k in range(self.longest + 1)]).astype(np.int64)

    def lookup(self, keys: np.ndarray):
        """Costs of sequences, and costs of their last byte after an escape from the bytes ahead of it."""
        s = self.symbol_of[self._bytes(keys)]
        context = np.zeros(len(keys), np.int64)
        for k in range(self.longest):
            context = context * self.size + s[k]
        at = self.row[context], s[self.longest]
        return self.cost[at], self.after[at]


class GramTable:
    """Costs of byte sequences in a hashed table with open addressing, at most half full."""

    _ODD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, costs: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)  # no sequence has this number
        self.costs = np.zeros(1 << bits)
        slot = self._first(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]  # of those that meet, one stays
            placed = self.keys[slot] == keys
            self.costs[slot[placed]] = costs[placed]
            keys, costs, slot = keys[~placed], costs[~placed], slot[~placed] + 1 & self.mask

    def _first(self, keys):
        return (keys.view(np.uint64) * self._ODD >> self.shift).astype(np.int64)

    def lookup(self, keys: np.ndarray):
        """Costs, 0 for sequences that are not in the table, and whether they are."""
        slot = self._first(keys)
        there = self.keys[slot]
        known = there == keys
        cost = np.where(known, self.costs[slot], 0.0)
        rest = np.flatnonzero(~known & (there != -1))
        slot = slot[rest]
        while len(rest):
            slot = slot + 1 & self.mask
            there = self.keys[slot]
            same = there == keys[rest]
            known[rest[same]], cost[rest[same]] = True, self.costs[slot[same]]
            on = ~same & (there != -1)
            rest, slot = rest[on], slot[on]
        return cost, known


def _most_frequent(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows with the largest counts, as many whole classes of counts as hold ``most`` rows together.

    A class is a sixteenth of a power of two, so there are a thousand at most; a sorted limit would
    send ``most`` rows of each partition to one task.
    """
    of = F.floor(16 * F.log2(F.col(column).cast("double")))
    total, least = 0, None
    for row in sorted(counts.groupBy(of.alias("of")).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["of"]
    return counts.filter(of >= least) if least is not None else counts.limit(0)


# --- the longer orders as stored tables -----------------------------------------------------------


def _low(column, n_bytes: int):
    return F.col(column).bitwiseAND(F.lit((1 << 8 * n_bytes) - 1))


def _contexts(grams: DataFrame, order: int) -> DataFrame:
    """Per context of ``order`` bytes: occurrences ``n``, of ``d`` different bytes, and these bytes' counts."""
    return store(
        grams.groupBy(F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").alias("n"), F.count("*").alias("d"), F.collect_list(F.struct(_low("gram", 1).alias("byte"), "n")).alias("seen")
        ),
        f"order-{order}",
    )


def _grams(contexts: DataFrame, *more) -> DataFrame:
    """A row per byte after a context, at most 256 of each."""
    rows = contexts.select("*", F.explode("seen").alias("of"))
    return rows.select(F.shiftleft("context", 8).bitwiseOR(F.col("of.byte")).alias("gram"), F.col("of.n").alias("n"), *more)


def _all_orders(grams: DataFrame) -> dict[int, DataFrame]:
    """Contexts of each order from TABLE_ORDER to ORDER."""
    contexts = {ORDER: _contexts(grams, ORDER)}
    for order in range(ORDER - 1, TABLE_ORDER - 1, -1):
        shorter = _grams(contexts[order + 1]).groupBy(_low("gram", order + 1).alias("gram")).agg(F.sum("n").alias("n"))
        contexts[order] = _contexts(shorter, order)
    return contexts


def _descended(missing: DataFrame, contexts: dict[int, DataFrame], shared) -> DataFrame:
    """``gram, cost`` of distinct sequences of ORDER + 1 bytes that training has not seen.

    ``cost`` holds where no longer context is known, ``after`` past an escape from a known context. Each
    distinct sequence goes down once, so none of the joins has a key with more than 65,536 rows.
    """
    levels = []
    for order in range(ORDER, TABLE_ORDER, -1):
        shorter = contexts[order - 1].toDF("context", "n_below", "d_below", "seen_below")
        rows = missing.select("gram", F.shiftright("gram", 8).alias("context")).join(contexts[order], "context", "left")
        rows = rows.withColumn("context", _low("context", order - 1)).join(shorter, "context", "left")
        known = F.col("n").isNotNull()
        there = F.get(F.filter("seen_below", lambda x: x["byte"] == _low("gram", 1)), 0)["n"]
        excluded = F.filter("seen_below", lambda x: F.array_contains("seen.byte", x["byte"]))
        n_left = F.col("n_below") - F.aggregate(excluded, F.lit(0).cast("long"), lambda total, x: total + x["n"])
        rows = rows.select("gram", "n", "d", "n_below", "d_below", there.alias("there"), n_left.alias("n_left"))
        total = F.log10(F.when(known, F.col("n_left") + F.col("d_below") - F.col("d")).otherwise(F.col("n_below") + F.col("d_below")).cast("double"))
        again = F.when(known & (F.col("d_below") > F.col("d")), total - F.log10(F.col("d_below") - F.col("d"))).otherwise(0.0)
        levels.append(
            store(
                rows.select(
                    "gram",
                    _low("gram", order).alias("lower"),
                    known.alias("known"),
                    F.col("there").isNull().alias("deeper"),
                    F.when(known, F.log10(F.col("n") + F.col("d")) - F.log10("d")).otherwise(0.0).alias("escape"),
                    F.when(F.col("there").isNotNull(), total - F.log10("there")).otherwise(again).alias("own"),
                ),
                f"unseen-{order}",
            )
        )
        missing = levels[-1].filter("deeper").select(F.col("lower").alias("gram")).distinct()

    def look_up(batches):
        table = shared.value
        for batch in batches:
            cost, after = table.lookup(batch.column("gram").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("gram"), pa.array(cost), pa.array(after)], ["gram", "cost", "after"])

    costs = missing.mapInArrow(look_up, "gram long, cost double, after double")
    for level in reversed(levels):
        rows = level.join(costs.toDF("lower", "cost_below", "after_below"), "lower", "left")
        after = F.col("own") + F.when(F.col("deeper"), F.col("after_below")).otherwise(0.0)
        unknown = F.col("own") + F.when(F.col("deeper"), F.col("cost_below")).otherwise(0.0)
        costs = rows.select("gram", F.when(F.col("known"), F.col("escape") + after).otherwise(unknown).alias("cost"), after.alias("after"))
    return costs.select("gram", "cost")


# --- scoring --------------------------------------------------------------------------------------

_SCORED = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, word binary, gram long, n long"


def _common_scores(texts, table: GramTable | None):
    """Scores of the texts' common byte sequences, and the others as text, sequence and times.

    Without ``table`` there was no training: each byte, and the end, is one of 256.
    """
    raw, starts, lengths = _framed(texts)
    none = np.zeros(0, np.int64)
    if table is None:
        return -np.log10(256.0) * (lengths + 1), none, none, none
    keys, coded = _keys(raw), _coded(starts, lengths, len(raw))
    cost, common = table.lookup(keys)
    cost = np.r_[np.zeros(ORDER), cost]
    cost[~coded] = 0
    at = np.flatnonzero(coded[ORDER:] & ~common)
    of, keys = np.searchsorted(starts, at + ORDER, "right") - 1, keys[at]
    order = np.lexsort((keys, of))
    of, keys = of[order], keys[order]
    first = np.flatnonzero(np.r_[True, (np.diff(of) != 0) | (np.diff(keys) != 0)][: len(of)])
    return -np.add.reduceat(cost, starts), of[first], keys[first], np.diff(np.r_[first, len(of)])


def _scores(docs: DataFrame, shared) -> DataFrame:
    """A row per document, and a row for each of its words and byte sequences that is not a common one."""
    names = [c.split()[0] for c in _SCORED.split(", ")]

    def score(batches):
        common, table = shared.value
        key = TaskContext.get().partitionId() << 40
        end = common.get(END)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            size = len(texts)
            tokens, known, logs = (np.empty(size, t) for t in (np.int64, np.int64, np.float64))
            keys, words, times = [], [], []
            for i, text in enumerate(texts):
                found = text.lower().split()
                log = np.fromiter(map(common.get, found, repeat(-1.0)), np.float64, len(found))
                rest = np.flatnonzero(log < 0)
                if len(rest):
                    other = Counter([found[k] for k in rest.tolist()])
                    keys += [key + i] * len(other)
                    words += other.keys()
                    times += other.values()
                tokens[i] = len(found) + 1
                known[i] = len(found) - len(rest) + (end is not None)
                logs[i] = log.sum() + len(rest) + (end or 0.0)
            columns = [np.arange(key, key + size), batch.column("doc_id"), batch.column("held_out"), tokens, known, logs]
            score, *rare = _common_scores(texts, table)
            columns += [score, pa.nulls(size, pa.binary()), *[pa.nulls(size, pa.int64())] * 2]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)
            types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            columns = [pa.array(keys, pa.int64()), *(pa.nulls(len(keys), t) for t in types)]
            columns += [pa.array(words, pa.binary()), pa.nulls(len(keys), pa.int64()), pa.array(times, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)
            of, gram, times = rare
            columns = [pa.array(key + of), *(pa.nulls(len(of), t) for t in (*types, pa.binary())), pa.array(gram), pa.array(times)]
            yield pa.RecordBatch.from_arrays(columns, names)
            key += size

    return docs.mapInArrow(score, _SCORED)


def _common_words(vocabulary: DataFrame) -> dict[bytes, float]:
    """Logs of the counts plus one of the most frequent words, and of the end of a text whatever its place among them."""
    most = _most_frequent(vocabulary, "c", COMMON_WORDS).toArrow()
    common = dict(zip(most.column("word").to_pylist(), np.log10(most.column("c").to_numpy() + 1.0).tolist()))
    ends = vocabulary.filter(F.col("word") == F.lit(END)).first()
    if ends:
        common[END] = float(np.log10(ends["c"] + 1.0))
    return common


def _common_grams(seen: DataFrame) -> GramTable:
    most = _most_frequent(seen, "n", COMMON_GRAMS).select("gram", "cost").toArrow()
    return GramTable(most.column("gram").to_numpy(), most.column("cost").to_numpy())


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Both models learn from the documents that ``training`` picks and score all of them.
    ``base_score`` is the add-one unigram score of the words (A-Z in lower case, split at white
    space) and of the end of the text; ``n_known`` counts tokens seen in training. ``score`` is the
    byte model's log10 probability of the text. Null text counts as empty; repeated rows each get a
    row; without training documents N and V are 0 and bytes are uniform; other columns are not read.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    counts = _counts(rows.filter(training()).select("text"))
    counts = store(counts.groupBy("word", "gram").agg(F.sum("n").alias("n")), "counts")
    vocabulary = counts.filter(F.col("gram").isNull()).select("word", F.col("n").alias("c"))
    n, v = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("word")).first()
    if n:
        contexts = _all_orders(counts.filter(F.col("gram").isNotNull()).select("gram", "n"))
        seen = _grams(contexts[ORDER], (F.log10(F.col("n") + F.col("d")) - F.log10("of.n")).alias("cost"))
    # Held by the broadcast only; the driver keeps no copy.
    shared = spark.sparkContext.broadcast((_common_words(vocabulary), _common_grams(seen) if n else None))

    scored = store(_scores(rows.withColumn("held_out", ~training()), shared), "scores")
    documents = scored.filter(F.col("word").isNull() & F.col("gram").isNull())
    others = scored.filter(F.col("word").isNotNull()).select("key", "word", "n")
    score = F.col("score")
    if n:
        rare = scored.filter(F.col("gram").isNotNull()).select("key", "gram", "n")
        needed = store(rare.select("gram").distinct().join(seen.select("gram", "cost"), "gram", "left"), "needed")
        # At most 256 x TRIE_CONTEXTS sequences.
        low = _grams(contexts[TABLE_ORDER]).toArrow()
        lowest = CodeTable(low.column("gram").to_numpy(), low.column("n").to_numpy(), TABLE_ORDER)
        unseen = _descended(needed.filter("cost IS NULL").select("gram"), contexts, spark.sparkContext.broadcast(lowest))
        needed = needed.filter("cost IS NOT NULL").unionByName(unseen)
        rare = rare.join(needed, "gram").groupBy("key").agg(F.sum(F.col("n") * F.col("cost")).alias("rare_cost"))
        documents = documents.drop("gram").join(rare, "key", "left")
        score = score - F.coalesce("rare_cost", F.lit(0.0))
    found = others.join(vocabulary, "word").groupBy("key").agg(
        F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more_logs")
    )
    none = F.lit(0)
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))
    return documents.drop("word", "gram", "n").join(found, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", none)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
    )
