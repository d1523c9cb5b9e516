import random

import pytest
from pyspark.sql import functions as F

import brute
from ridemetrics.llm import ngram_join
from ridemetrics.llm.components import connected_components
from ridemetrics.llm.ngram_join import drop_similar, similarity_classes

SCHEMA = "doc_id long, text string"


def _edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
    return words


def _corpus(seed):
    """Groups of near copies around the limit, chains that drift, shared passages, short and odd texts."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    texts = ["", " \t\n", "one", "one two", "One  TWO", "one two three four", None, "a\x0bb\x0cc d"]
    for size, copies in [(60, 40), (200, 25), (25, 12), (9, 15), (120, 5)]:
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(copies):
            texts.append(" ".join(_edited(rng, base, rng.randrange(0, max(2, size // 20)))))
    drift = [f"d{i}" for i in range(80)]
    for _ in range(30):
        drift = _edited(rng, drift, 1)
        texts.append(" ".join(drift))
    for _ in range(40):
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 8))]
        texts.append(" ".join(own[:2] + passage + own[2:]))
    texts += texts[10:20]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


def _got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("frequent", [2, 1000])
def test_equals_all_pairs(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "LIST_PART", 7)
    member_by_member = []
    real = ngram_join._between
    monkeypatch.setattr(ngram_join, "_between", lambda *a: member_by_member.append(1) or real(*a))
    rows = _corpus(seed)
    got = _got(similarity_classes(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert got == brute.similarity_classes(dict(rows))
    assert member_by_member  # members of two clusters may link while their centres do not


def test_nulls_repeats_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text, 1), (3, text, 1), (None, text + " y", 2), (9, text + " z", 3), (4, None, 4), (5, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long").withColumns(
        {"gram": F.lit(1), "n": F.lit("x"), "class": F.lit(0), "tie": F.lit(0)}
    )
    got = sorted(map(tuple, similarity_classes(docs).collect()), key=repr)
    assert got == sorted([(3, 47, 3), (3, 47, 3), (None, 48, 3), (9, 48, 3), (4, 0, 4), (5, 0, 5)], key=repr)
    kept = drop_similar(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id or 0 for r in kept.collect()]) == [0, 3, 3, 4, 5]


def test_empty_table(spark):
    assert similarity_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + rng.randrange(1, 99)) for _ in range(200)] + [(7, 7), (5000, 5000)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert got == {k: find(k) for k in parent}


def test_rows_that_share_an_id_are_told_apart(spark):
    """Only the near copy goes, not the other row of its id."""
    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(1, a), (5, a + " y"), (5, b), (7, b + " z"), (8, "c d e f g"), (8, "c d e f g")]
    kept = drop_similar(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, kept.collect())) == sorted([(1, a), (5, b), (8, "c d e f g"), (8, "c d e f g")])
    # One id, one class: one of the two texts stays.
    kept = drop_similar(spark.createDataFrame([(1, a), (1, a + " y")], SCHEMA)).collect()
    assert len(kept) == 1


def test_a_list_below_the_threshold_is_cut_by_position(spark, monkeypatch):
    """50,000 sets share an n-gram that no task counts as frequent; no piece of the list is larger than a part."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 1)
    monkeypatch.setattr(ngram_join, "LIST_PART", 300)
    monkeypatch.setattr(ngram_join, "SQUARE", 50)
    def entries(n, gram):
        entry = F.shiftleft(F.lit(20).cast("long") + F.col("id") % 9, 32) + F.lit(30)
        numbers = {"gram": F.lit(gram).cast("long"), "part": F.lit(0).cast("long"), "entry": entry, "id": F.xxhash64("id")}
        return spark.range(n).select(*[c.alias(name) for name, c in numbers.items()])

    entries = entries(50_000, 7).unionByName(entries(5, 9))
    found = ngram_join._lists(entries, (80, 100))
    sizes = {r["part"]: r["count"] for r in found.filter("b IS NULL").groupBy("part").count().collect()}
    assert sum(sizes.values()) == 50_000 and max(sizes.values()) <= 300 and 0 not in sizes and len(sizes) >= 50_000 / 300
    assert found.filter("b IS NOT NULL").count() == 10


def test_cut_lists_lose_no_link(spark, monkeypatch):
    """Sets of one shared passage and little else, more than a part holds, none of it counted as frequent."""
    monkeypatch.setattr(ngram_join, "LIST_PART", 10)
    monkeypatch.setattr(ngram_join, "SQUARE", 3)
    monkeypatch.setattr(ngram_join, "_frequent", lambda *a: (ngram_join.np.zeros(0, ngram_join.np.uint64), ngram_join.np.zeros(0, int)))
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(26)]
    texts = []
    for _ in range(150):
        own = [f"o{rng.randrange(40)}" for _ in range(rng.randrange(1, 9))]
        texts.append(" ".join(passage + own))
    rows = list(enumerate(texts))
    got = _got(similarity_classes(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    assert got == brute.similarity_classes(dict(rows))


def test_texts_beyond_a_megabyte(spark):
    rng = random.Random(2)
    long = [f"w{rng.randrange(10**6)}" for _ in range(200_000)]
    near = list(long)
    for k in range(0, 200_000, 4000):
        near[k] = "x"
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(long[:100_000])), (4, "y" * 2_000_000)]
    assert _got(similarity_classes(spark.createDataFrame(rows, SCHEMA))) == brute.similarity_classes(dict(rows))
