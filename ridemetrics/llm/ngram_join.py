"""Exact Jaccard self-join of word n-gram sets, and the classes its links form.

Prefix index. The n-grams are put in one global order, frequent ones last; two sets that link share
one of the first few of either. Each set is entered in the lists of those n-grams, with its size and
the position of the n-gram in it. Lists are sorted by size and position, and partners whose sizes or
positions rule a link out are skipped without looking at the sets.

Set relations. A long list is mostly made of highly similar sets (near copies). There a set is
at first compared with a few sets only, those with the most similar bitmaps. Sets that link to a common set form a
cluster with known distances to its centre, and the answers of a member are derived from those of
the centre: members of one class need no further comparison, and by the triangle inequality of the
Jaccard distance two clusters whose centres are far apart hold no link. A long list is then a list
of clusters, cut into blocks of size and position ranges, and blocks are skipped as a whole. Only
where neither decides are members compared one by one. So the classes are exact, and a class of
near copies costs about as many comparisons as it has members.

Equal sets count once throughout. The bits in which the bitmaps of two sets differ bound their distance and rule out
most other pairs. What is left is compared on the texts, which are smaller than their hashes and are fetched only for sets that share
a list with another.
"""

import re
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ridemetrics.llm.common import SLICE_BYTES, id_and_text, partitions, slices, store, without_rows
from ridemetrics.llm.components import connected_components

N = 4
# Similarity as a fraction of whole numbers.
SIMILARITY = (85, 100)
# An n-gram in at least one of so many sets counts as frequent. Bounds the broadcast: at most
# (mean set size) x FREQUENT n-grams can be that frequent, whatever the number of sets.
FREQUENT = 1000
# N-grams that a task counts at a time when it looks for frequent ones.
COUNTED_TOGETHER = 1_000_000
# Text that is hashed at a time; some ten arrays of as many 64-bit numbers are made of it.
HASHED_BYTES = 1 << 18
# Up to this length all pairs of a list are compared (at most 28).
SHORT_LIST = 8
# Sets that one part of a long list holds, about.
LIST_PART = 2000
# Clusters of one n-gram that are compared in one place, about.
SQUARE = 1000
# Least and largest size of a set's bitmap; in between it has two to four bits per n-gram.
SKETCH_BITS = 1024
MOST_SKETCH_BITS = 8192
# Most similar sets of its list that a set of a long list is first compared with.
NEAREST = 3
# Slack for distances held as doubles.
EPSILON = 1e-9

_U = np.uint64
_SPACE = re.compile(rb"[\x09-\x0d ]")
_SPACES = np.array([9 <= b <= 13 or b == 32 for b in range(256)])
_FACTORS = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mixed(x):
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(32))


@cache
def _powers(size: int):
    """Powers of an odd base and of its inverse, and a random number per byte."""
    base = 0x9E3779B97F4A7C15 | 1
    up = np.full(size, base, _U)
    down = np.full(size, pow(base, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down), np.random.default_rng(7).integers(1, 1 << 63, 256, _U)


def _word_hashes(raw: np.ndarray):
    """64-bit hash and first byte of each word in ``raw``, from prefix sums of a polynomial."""
    space = _SPACES[raw]
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down, random = _powers(1 << max(19, int(len(raw)).bit_length()))
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(random[raw] * up[: len(raw)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U)), starts


def _pieces(text: bytes):
    """A long text in pieces that end at white space."""
    start = 0
    while len(text) - start > HASHED_BYTES:
        cut = _SPACE.search(text, start + HASHED_BYTES)
        stop = cut.end() if cut else len(text)
        yield text[start:stop]
        start = stop
    yield text[start:]


def ngram_sets(texts: list[bytes], n: int = N):
    """Per text its sorted distinct 64-bit hashes of word n-grams; a shorter text with words is one n-gram.

    Words are runs of bytes other than white space (9 to 13 and 32), A-Z in lower case.
    """
    group, held = [], 0
    for text in texts:
        if len(text) > HASHED_BYTES:
            yield from _sets_of(group, n)
            group, held = [], 0
            yield _set_of(np.concatenate([_word_hashes(np.frombuffer(p.lower(), np.uint8))[0] for p in _pieces(text)]), n)
            continue
        if held + len(text) > HASHED_BYTES:
            yield from _sets_of(group, n)
            group, held = [], 0
        group.append(text)
        held += len(text)
    yield from _sets_of(group, n)


def _sets_of(texts, n):
    if not texts:
        return
    hashes, starts = _word_hashes(np.frombuffer(b"\n".join(texts).lower(), np.uint8))
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.r_[0, np.searchsorted(starts, ends)].tolist()
    grams = _grams(hashes, n)  # some reach from one text into the next
    for first, past in zip(bounds, bounds[1:]):
        yield _distinct(grams[first : past - n + 1]) if past - first >= n else _set_of(hashes[first:past], n)


def _grams(words, k):
    """Hash of each run of ``k`` words."""
    total = np.full(max(0, len(words) - k + 1), _U(k))
    for i in range(k):
        total += words[i : i + len(total)] * _FACTORS[i % 4] ** _U(1 + i // 4)
    return _mixed(total)


def _distinct(grams):
    grams = np.sort(grams)
    return grams[np.r_[True, grams[1:] != grams[:-1]]]


def _set_of(words: np.ndarray, n: int) -> np.ndarray:
    return _distinct(_grams(words, min(n, len(words)))) if len(words) else words


def _sketch(grams: np.ndarray) -> np.ndarray:
    """Bitmap with a bit set for each n-gram, as words of 64 bits; halves of it OR to the next smaller size."""
    size = SKETCH_BITS
    while size < min(2 * len(grams), MOST_SKETCH_BITS):
        size *= 2
    bits = np.zeros(size, bool)
    bits[(grams >> _U(20)).astype(np.int64) % size] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def _folded(sketch: np.ndarray) -> bytes:
    """The bitmap at its least size."""
    return np.bitwise_or.reduce(sketch.reshape(-1, SKETCH_BITS // 64), axis=0).tobytes()


def _digest(grams):
    """Two 64-bit sums that do not depend on order, as signed numbers."""
    pair = np.array([_mixed(grams).sum(dtype=_U), _mixed(grams ^ _FACTORS[1]).sum(dtype=_U)], _U)
    return _mixed(pair ^ _U(len(grams))).view(np.int64).tolist()


def least_overlap(n: int, t=SIMILARITY) -> int:
    """N-grams that a set of size ``n`` shares with any partner."""
    return -(-t[0] * n // t[1])


# --- pass 1: sets and frequent n-grams -----------------------------------------------------------

_PROFILE = "doc_id long, tie long, n long, id long, check long, sketch array<long>, brief binary, gram long, count long"


def _profiles(docs: DataFrame, n: int) -> DataFrame:
    """Rows of two kinds: a document's set, and n-grams that many sets of a task have (``gram``)."""

    def profile(batches):
        held, seen = [], set()

        def frequent():
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            common = counts >= max(3, len(held) / FREQUENT)
            held.clear()
            seen.clear()
            types = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.binary()]
            columns = [pa.nulls(common.sum(), t) for t in types]
            columns += [pa.array(grams[common].view(np.int64)), pa.array(counts[common])]
            return pa.RecordBatch.from_arrays(columns, names)

        names = [c.split()[0] for c in _PROFILE.split(", ")]
        waiting = 0
        for batch in slices(batches):
            rows, sketches = [], []
            for grams in ngram_sets(batch.column("text").to_pylist(), n):
                rows.append((len(grams), *_digest(grams)))
                sketches.append(_sketch(grams))
                if rows[-1][1] not in seen:
                    seen.add(rows[-1][1])
                    held.append(grams)
                    waiting += len(grams)
            columns = [batch.column("doc_id"), batch.column("tie"), *(pa.array(c, pa.int64()) for c in zip(*rows))]
            offsets = np.cumsum([0, *map(len, sketches)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(offsets, np.concatenate(sketches)))
            columns.append(pa.array([_folded(x) for x in sketches], pa.binary()))
            columns += [pa.nulls(len(rows), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(columns, names)
            if waiting >= COUNTED_TOGETHER:
                yield frequent()
                waiting = 0
        if held:
            yield frequent()

    return docs.mapInArrow(profile, _PROFILE)


def _frequent(profiles: DataFrame, n_sets: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent n-grams, sorted, and their counts. They only decide the order, not the result."""
    counts = profiles.filter(F.col("gram").isNotNull()).groupBy("gram").agg(F.sum("count").alias("count"))
    found = counts.filter(F.col("count") >= max(SHORT_LIST, n_sets // FREQUENT)).toArrow()
    grams = found.column("gram").to_numpy().view(_U)
    order = np.argsort(grams)
    return grams[order], found.column("count").to_numpy()[order]


# --- pass 2: lists ------------------------------------------------------------------------------

_ENTRY = "gram long, part long, entry long, id long"


def _entries(docs: DataFrame, shared, n: int, t) -> DataFrame:
    """List entries: n-gram, part of its list, set, and ``entry`` = set size and n-grams after this one.

    The list of a frequent n-gram is dealt into numbered parts; any other list has part 0.
    """

    def enter(batches):
        frequent, counts = shared.value
        rank = np.empty(len(frequent), np.int64)
        rank[np.lexsort((frequent, counts))] = np.arange(len(frequent))
        parts = -(-counts // LIST_PART)
        for batch in slices(batches):
            seen, columns = set(), ([], [], [], [])
            for grams in ngram_sets(batch.column("text").to_pylist(), n):
                size = len(grams)
                if size * t[1] < (size + 1) * t[0]:
                    continue  # too small to link with a different set
                number = _digest(grams)[0]
                if number in seen:
                    continue
                seen.add(number)
                prefix = size - least_overlap(size, t) + 1
                part = np.zeros(prefix, np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
                    is_frequent = frequent[at] == grams
                    rare = grams[~is_frequent]
                    late = at[is_frequent]
                    late = late[np.argsort(rank[late])]
                    grams = np.concatenate((rare, frequent[late]))
                    if len(rare) < prefix:
                        # Dealt anew for each n-gram, so that any two sets meet in some part.
                        of = parts[late[: prefix - len(rare)]]
                        deal = _mixed(grams[len(rare) : prefix] ^ _U(number & 0xFFFFFFFFFFFFFFFF)) >> _U(1)
                        part[len(rare) :] = np.where(of > 1, 1 + deal.astype(np.int64) % of, 0)
                columns[0].append(grams[:prefix].view(np.int64))
                after = np.arange(size - 1, size - 1 - prefix, -1)
                columns[1].append(part)
                columns[2].append(size << 32 | after)
                columns[3].append(np.full(prefix, number))
            if columns[0]:
                arrays = [pa.array(np.concatenate(c)) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["gram", "part", "entry", "id"])

    return docs.select("text").mapInArrow(enter, _ENTRY)


def _size(entry):
    return entry >> 32


def _after(entry):
    return entry & 0xFFFFFFFF


def _possible(small_a, large_a, after_a, small_b, large_b, after_b, t):
    """Whether sets of these size ranges and most words after the n-gram can link over it."""
    fit = (large_a * t[1] >= small_b * t[0]) & (large_b * t[1] >= small_a * t[0])
    needed = -(-t[0] * (small_a + small_b) // (t[0] + t[1]))
    return fit & (1 + np.minimum(after_a, after_b) >= needed)


_LISTS = "a long, b long, gram long, part long, entry long"


def _array(column):
    """Numbers, or bitmaps as rows of words."""
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), _U).reshape(len(column), -1)
    return column.to_numpy()


def _in_groups(batches, columns, same):
    """Sorted batches as arrays that end where a group ends; ``same`` names the grouping arrays."""
    return (arrays for arrays, _ in _streamed(batches, columns, same))


def _streamed(batches, columns, same, most: int | None = None):
    """``(arrays, whether they end where a group ends)``; a group beyond ``most`` rows comes in pieces of so many."""
    rest = None
    for batch in batches:
        arrays = [_array(batch.column(c)) for c in columns]
        if not len(arrays[0]):
            continue
        if rest is not None:
            arrays = [np.concatenate(x) for x in zip(rest, arrays)]
        keys = same(*arrays)
        cuts = [np.flatnonzero(k[1:] != k[:-1]) + 1 for k in keys]
        cut = max(c.max(initial=0) for c in cuts)
        if cut and most:
            # The first group may be what is left of one that came in pieces.
            head = min(c.min(initial=cut) for c in cuts)
            yield [x[:head] for x in arrays], True
            if head < cut:
                yield [x[head:cut] for x in arrays], True
        elif cut:
            yield [x[:cut] for x in arrays], True
        rest = [x[cut:] for x in arrays]
        while most and len(rest[0]) > most:
            yield [x[:most] for x in rest], False
            rest = [x[most:] for x in rest]
    if rest is not None:
        yield rest, True


def _in_pieces(batches, most: int):
    """Lists as arrays ``gram, part, entry, id``, whole ones with part 0.

    A list longer than ``most`` is cut by position on the way, so a task never holds one whole. Parts of it, and parts
    dealt before, have numbers above 0 that differ within the n-gram.
    """
    now, piece = None, 0
    for arrays, ends in _streamed(batches, ["gram", "part", "entry", "id"], lambda g, p, *_: (g, p), most):
        gram, part, entry, number = arrays
        piece = piece + 1 if now == (gram[0], part[0]) else 0
        now = None if ends else (gram[0], part[0])
        if not ends or piece:
            part = (part << 32) + piece + 1  # a list of its own, as all rows are of one
        else:
            part = part << 32
        yield gram, part, entry, number


def _lists(entries: DataFrame, t) -> DataFrame:
    """Pairs to compare (``a``, ``b``), and the entries of long lists (``gram``, ``part``, ``entry``, set in ``a``)."""

    most = LIST_PART

    def pair(batches):
        for gram, part, entry, number in _in_pieces(batches, most):
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (entry[1:] != entry[:-1]) | (number[1:] != number[:-1]) | (part[1:] != part[:-1])
            gram, part, entry, number = gram[new], part[new], entry[new], number[new]
            first = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])])
            length = np.diff(np.r_[first, len(gram)])
            left, right = [], []
            for k in range(2, SHORT_LIST + 1):
                starts = first[(length == k) & (part[first] == 0)]
                i, j = np.triu_indices(k, 1)
                left.append((starts[:, None] + i).ravel())
                right.append((starts[:, None] + j).ravel())
            long = (length > SHORT_LIST) | (part[first] > 0)  # a part says nothing about the other parts
            is_long = np.repeat(long, length)
            left, right = np.concatenate(left), np.concatenate(right)
            sizes, after = _size(entry), _after(entry)
            sl, sr = sizes[left], sizes[right]
            keep = (number[left] != number[right]) & _possible(sl, sl, after[left], sr, sr, after[right], t)
            x, y = number[left[keep]], number[right[keep]]
            pairs = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y))), axis=1)
            none = pa.nulls(pairs.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), none, none, none], names)
            none = pa.nulls(int(is_long.sum()), pa.int64())
            columns = [pa.array(number[is_long]), none, *(pa.array(x[is_long]) for x in (gram, part, entry))]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [c.split()[0] for c in _LISTS.split(", ")]
    spread = entries.repartition(partitions(entries.sparkSession), "gram", "part")
    return spread.sortWithinPartitions("gram", "part", "entry", "id").mapInArrow(pair, _LISTS)


def _nearest(long: DataFrame, sets: DataFrame, t) -> DataFrame:
    """In the form of ``_lists``: for each entry of a long list the sets most similar to it by bitmap,
    and the entries that are left.

    The pairs are compared first, as they join most of a class; what they miss is found later. An
    entry is left if its bitmap allows a link to another one of the list, or if this is but a part of it.
    """
    limit = (t[1] - t[0]) / (t[1] + t[0]) + EPSILON

    def pair(batches):
        columns = ["gram", "part", "entry", "id", "brief"]
        for gram, part, entry, number, brief in _in_groups(batches, columns, lambda g, p, *_: (g, p)):
            first = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])])
            pairs, alive = [], part > 0
            for start, end in zip(first.tolist(), [*first[1:].tolist(), len(gram)]):
                ids, sizes, bits = number[start:end], _size(entry[start:end]), brief[start:end]
                for low in range(0, end - start, 64):  # bounds the memory of a comparison
                    rows = slice(low, min(low + 64, end - start))
                    differ = np.bitwise_count(bits[rows, None] ^ bits[None]).sum(2, dtype=np.int64)
                    total = sizes[rows, None] + sizes[None]
                    share = np.where(ids[rows, None] == ids[None], 2.0, differ / total)
                    alive[start:end][rows] |= (share <= limit).any(1)
                    count = min(NEAREST, end - start - 1)
                    best = np.argpartition(share, count - 1, axis=1)[:, :count] if count else np.empty((len(share), 0), int)
                    i, k = np.nonzero(np.take_along_axis(share, best, 1) <= limit)
                    x, y = ids[rows][i], ids[best[i, k]]
                    pairs.append(np.stack((np.minimum(x, y), np.maximum(x, y))))
            pairs = np.unique(np.concatenate(pairs, axis=1), axis=1)
            none = pa.nulls(pairs.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), none, none, none], names)
            none = pa.nulls(int(alive.sum()), pa.int64())
            found = [pa.array(number[alive]), none, *(pa.array(x[alive]) for x in (gram, part, entry))]
            yield pa.RecordBatch.from_arrays(found, names)

    names = [c.split()[0] for c in _LISTS.split(", ")]
    rows = long.join(sets.select("id", "brief"), "id").select("gram", "part", "entry", "id", "brief")
    spread = rows.repartition(partitions(long.sparkSession), "gram", "part")
    return spread.sortWithinPartitions("gram", "part", "entry", "id").mapInArrow(pair, _LISTS)


def _packed(batches):
    """Texts compressed, as they go through several shuffles."""
    packer = zstandard.ZstdCompressor()
    for batch in batches:
        texts = [packer.compress(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.binary())], ["id", "text"])


# --- comparing ----------------------------------------------------------------------------------

_COMPARED = "a long, b long, linked boolean, distance double"


def _compare(pairs: DataFrame, texts: DataFrame, n: int, t) -> DataFrame:
    """``pairs`` with their exact answer and Jaccard distance."""

    def compare(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        # Packed texts, so slices of a quarter.
        for batch in slices(slices(batches, "text_a", SLICE_BYTES // 4), "text_b", SLICE_BYTES // 4):
            linked, distance = [], []
            two = batch.column("text_b").to_pylist()
            # Rows of one b stand together; its set is made once.
            new = [i == 0 or two[i] != two[i - 1] for i in range(len(two))]
            others = ngram_sets([unpack(t) for t, x in zip(two, new) if x], n)
            for x, is_new in zip(ngram_sets(map(unpack, batch.column("text_a").to_pylist()), n), new):
                y = next(others) if is_new else y
                shared = np.intersect1d(x, y, assume_unique=True).size
                union = len(x) + len(y) - shared
                linked.append(shared * t[1] >= union * t[0])
                distance.append(1 - shared / union)
            columns = [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.array(distance, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "linked", "distance"])

    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return store(pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(compare, _COMPARED), "compared")


def _plausible(pairs: DataFrame, sets: DataFrame, t, slack=0.0, in_size=True) -> DataFrame:
    """Pairs whose sizes (if ``in_size``) and bitmaps allow a Jaccard distance of up to the limit plus ``slack``.

    Each differing bit is an n-gram that only one of the sets has, so the bits bound the distance.
    """
    one = sets.select(F.col("id").alias("a"), F.col("n").alias("_n_a"), F.col("sketch").alias("_s_a"))
    two = sets.select(F.col("id").alias("b"), F.col("n").alias("_n_b"), F.col("sketch").alias("_s_b"))
    # Sizes of sets that can link differ by less than a factor of two, so one fold makes bitmaps equal in size.
    longest = F.greatest(F.size("_s_a"), F.size("_s_b"))
    shortest = F.least(F.size("_s_a"), F.size("_s_b"))

    def folded(name):
        half = (longest / 2).cast("int")
        pieces = F.slice(F.col(name), F.lit(1), half), F.slice(F.col(name), half + 1, half)
        return F.when(F.size(name) == shortest, F.col(name)).otherwise(F.zip_with(*pieces, lambda x, y: x.bitwiseOR(y)))

    bits = F.zip_with(folded("_s_a"), folded("_s_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
    fit = (F.col("_n_a") * t[1] >= F.col("_n_b") * t[0]) & (F.col("_n_b") * t[1] >= F.col("_n_a") * t[0])
    joined = pairs.join(one, "a").join(two, "b")
    joined = (joined.filter(fit) if in_size else joined).withColumn("_differ", F.when(longest <= 2 * shortest, differ).otherwise(0))
    bound = 2 * F.col("_differ") / (F.col("_n_a") + F.col("_n_b") + F.col("_differ"))
    return joined.filter(bound <= 1 - t[0] / t[1] + EPSILON + slack).select(*pairs.columns)


_CLUSTER_PAIRS = "a long, b long, radius_a double, radius_b double"


def _cluster_pairs(blocks: DataFrame, t) -> DataFrame:
    """Pairs of clusters of different classes that a long list leaves possible; blocks are skipped whole."""

    columns = ["gram", "row", "column", "own", "small", "large", "after", "center", "class", "radius"]

    def pair(batches):
        for arrays in _in_groups(batches, columns, lambda g, r, c, *_: (g, r, c)):
            new = np.logical_or.reduce([x[1:] != x[:-1] for x in arrays[:3]])
            first = np.flatnonzero(np.r_[True, new])
            for start, end in zip(first, np.r_[first[1:], len(arrays[0])]):
                _, row, column, own, small, large, after, center, of, radius = (x[start:end] for x in arrays)
                if (of == of[0]).all():
                    continue
                across = row[0] != column[0]
                # Sorted by the least size, so the partners of a block are a stretch of the list.
                past = np.searchsorted(small, large * t[1] // t[0], side="right")
                for i in range(len(small)):
                    j = np.arange(i + 1, past[i])
                    j = j[(of[j] != of[i]) & ((own[j] != own[i]) | (not across))]
                    j = j[_possible(small[i], large[i], after[i], small[j], large[j], after[j], t)]
                    if len(j):
                        swap = center[j] < center[i]
                        a = np.where(swap, center[j], center[i])
                        b = np.where(swap, center[i], center[j])
                        ra = np.where(swap, radius[j], radius[i])
                        rb = np.where(swap, radius[i], radius[j])
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a, b, ra, rb)], names)

    names = [c.split()[0] for c in _CLUSTER_PAIRS.split(", ")]
    # The clusters of an n-gram in squares: each meets those of its own share and of every other one.
    many = store(blocks.groupBy("gram").agg(F.ceil(F.count(F.lit(1)) / SQUARE).alias("shares")).filter("shares > 1"), "many-clusters")
    shares = F.coalesce("shares", F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64("center"), shares)
    dealt = blocks.join(many, "gram", "left").withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0).cast("long"), shares - 1))})
    dealt = dealt.withColumns({"row": F.least("own", "other"), "column": F.greatest("own", "other")})
    spread = dealt.select(*columns).repartition(partitions(blocks.sparkSession), "gram", "row", "column")
    pairs = spread.sortWithinPartitions("gram", "row", "column", "small").mapInArrow(pair, _CLUSTER_PAIRS)
    return pairs.groupBy("a", "b").agg(F.max("radius_a").alias("radius_a"), F.max("radius_b").alias("radius_b"))


def _classes(links: DataFrame) -> DataFrame:
    """``id, class`` of all linked sets, stored."""
    found = connected_components(links.select("a", "b"))
    return store(found.select(F.col("node").alias("id"), F.col("component").alias("class")), "classes")


def _with_class(df: DataFrame, classes: DataFrame, column: str, name: str) -> DataFrame:
    of = classes.select(F.col("id").alias(column), F.col("class").alias("_class"))
    return df.join(of, column, "left").withColumn(name, F.coalesce("_class", column)).drop("_class")


def _set_classes(docs: DataFrame, sets: DataFrame, shared, n: int, t) -> DataFrame:
    """``id, class`` for every set that links with a different one."""
    lists = store(_lists(_entries(docs, shared, n, t), t), "lists")
    long = lists.filter(F.col("b").isNull()).select(F.col("a").alias("id"), "gram", "part", "entry")
    nearest = store(_nearest(long, sets, t), "nearest")
    long = nearest.filter(F.col("b").isNull()).select(F.col("a").alias("id"), "gram", "entry")
    pairs = lists.unionByName(nearest).filter(F.col("b").isNotNull()).select("a", "b").distinct()
    pairs = store(_plausible(pairs, sets, t), "pairs")
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(long.select("id")).distinct()
    wanted = sets.join(needed, "id").select("id", F.col("doc_id").alias("_doc"), F.col("tie").alias("_tie"))
    same = docs["doc_id"].eqNullSafe(F.col("_doc")) & (docs["tie"] == F.col("_tie"))
    texts = store(docs.join(wanted, same).select("id", "text").mapInArrow(_packed, "id long, text binary"), "texts")

    first = _compare(pairs, texts, n, t)
    links = first.filter("linked")
    classes = _classes(links)

    # A set's centre is the least set it links to, if that is smaller than itself.
    centers = links.groupBy(F.col("b").alias("id")).agg(F.min(F.struct("a", "distance")).alias("c"))
    centers = store(centers.select("id", F.col("c.a").alias("center"), "c.distance"), "centers")
    members = long.join(centers, "id", "left").select(
        "gram", "entry", "id", F.coalesce("center", "id").alias("center"), F.coalesce("distance", F.lit(0.0)).alias("d")
    )
    members = _with_class(members, classes, "id", "class")
    size, after = F.shiftright("entry", 32), F.col("entry").bitwiseAND(F.lit(0xFFFFFFFF))
    blocks = store(members.groupBy("gram", "center", "class").agg(
        F.min(size).alias("small"), F.max(size).alias("large"), F.max(after).alias("after"), F.max("d").alias("radius")
    ), "clusters")
    apart = _plausible(_cluster_pairs(blocks, t), sets, t, F.col("radius_a") + F.col("radius_b"), in_size=False)
    apart = store(apart, "cluster-pairs")
    second = _compare(apart, texts, n, t).join(apart, ["a", "b"])
    reach = 1 - t[0] / t[1] + EPSILON
    joins = _of_classes(second.filter("linked"), classes)
    near = second.filter(~F.col("linked") & (F.col("distance") <= reach + F.col("radius_a") + F.col("radius_b")))
    if not near.isEmpty():
        # Clusters whose classes another pair has linked need no further comparison.
        near = _of_classes(near, classes).join(joins.select("class_a", "class_b"), ["class_a", "class_b"], "left_anti")
        between = _between(near.select("a", "b", "distance", "radius_a", "radius_b"), centers, sets, texts, n, t)
        joins = joins.unionByName(_of_classes(between, classes), allowMissingColumns=True)
    # The classes of the first links are nodes now, and the later links are edges between them.
    merged = connected_components(joins.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
    merged = store(merged.select(F.col("node").alias("class"), "component"), "merged")
    alone = merged.join(classes.select("class").distinct(), "class", "left_anti")
    every = classes.unionByName(alone.select(F.col("class").alias("id"), "class"))
    return every.join(merged, "class", "left").select("id", F.coalesce("component", "class").alias("class"))


def _of_classes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` with the classes of their ends, the smaller one first."""
    joined = _with_class(_with_class(pairs, classes, "a", "_x"), classes, "b", "_y").filter("_x != _y")
    ends = {"class_a": F.least("_x", "_y"), "class_b": F.greatest("_x", "_y")}
    return joined.withColumns(ends).drop("_x", "_y")


def _between(near: DataFrame, centers: DataFrame, sets: DataFrame, texts: DataFrame, n: int, t) -> DataFrame:
    """Links between members of clusters that neither class nor distance has decided."""
    own = sets.select("id", F.col("id").alias("center"), F.lit(0.0).alias("distance"))
    every = own.join(centers, "id", "left_anti").unionByName(centers).join(sets.select("id", "n"), "id")

    def side(name):
        columns = {"center": name, "id": f"id_{name}", "distance": f"d_{name}", "n": f"n_{name}"}
        return every.select(*[F.col(c).alias(x) for c, x in columns.items()])

    reach = 1 - t[0] / t[1] + EPSILON
    # Of each cluster only members far enough from its centre to reach the other one.
    pairs = near.join(side("a"), "a").filter(F.col("distance") <= reach + F.col("d_a") + F.col("radius_b"))
    pairs = pairs.join(side("b"), "b").filter(
        (F.col("distance") <= reach + F.col("d_a") + F.col("d_b"))
        & (F.col("n_a") * t[1] >= F.col("n_b") * t[0])
        & (F.col("n_b") * t[1] >= F.col("n_a") * t[0])
    )
    ends = pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()
    ends = _plausible(ends, sets, t)
    return _compare(ends, texts, n, t).filter("linked").select("a", "b")


def _classified(docs: DataFrame, n: int, similarity, id_col: str, text_col: str) -> DataFrame:
    """Stored ``doc_id, tie, n, class`` of each row; ``tie`` is its text's hash, ``n`` its set's size."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    profiles = store(_profiles(rows, n), "profiles")
    documents = profiles.filter(F.col("gram").isNull())
    of_set = documents.filter("n > 0").groupBy("id").agg(
        F.min(F.struct("doc_id", "tie", "sketch", "brief")).alias("first"),
        F.min(F.struct("n", "check")).alias("low"),
        F.max(F.struct("n", "check")).alias("high"),
    )
    clash = F.raise_error(F.lit("two different sets share a 64-bit id")).cast("long")
    sets = store(
        of_set.select("id", "first.*", F.when(F.col("low") == F.col("high"), F.col("low.n")).otherwise(clash).alias("n")),
        "sets",
    )
    shared = spark.sparkContext.broadcast(_frequent(profiles, sets.count()))
    classes = _set_classes(rows, sets, shared, n, similarity)

    return store(_with_class(documents.select("doc_id", "tie", "n", "id"), classes, "id", "class"), "grouped")


def similarity_classes(
    docs: DataFrame, n: int = N, similarity=SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    A document's set holds its distinct word ``n``-grams; a text with fewer words is one n-gram, and
    one without words, or null, has the empty set. Two documents link if the Jaccard similarity of
    their sets is at least ``similarity`` = (numerator, denominator); empty sets link with nothing.
    ``component_id`` is the smallest id that links reach, the document's own included; rows without
    an id are compared like others and get the smallest id they reach, null if there is none.
    Repeated rows each get a row. Other columns are not read.

    Set ids are 64 bits of a 128-bit digest. Different sets with one id fail the job.
    """
    grouped = _classified(docs, n, similarity, id_col, text_col)
    least = store(grouped.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("least")), "components")
    return grouped.join(least, "class", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def drop_similar(
    docs: DataFrame, n: int = N, similarity=SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest id, and all columns.

    Rows without an id stay, as they cannot be named; so do empty documents. Of rows that share an id but not their
    text each is a document of its own, and in a class of both the one with the smaller hash stays; rows that
    repeat id and text are one document.
    """
    grouped = _classified(docs, n, similarity, id_col, text_col).filter("n > 0 AND doc_id IS NOT NULL")
    document = F.struct("doc_id", "tie")
    first = store(grouped.groupBy("class").agg(F.min(document).alias("first")), "first-of-class")
    gone = grouped.join(first, "class").filter(document != F.col("first")).select("doc_id", "tie").distinct()
    return without_rows(docs, id_col, text_col, store(gone, "similar"))
