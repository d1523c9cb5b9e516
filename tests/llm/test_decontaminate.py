import hashlib
import random

import pytest
from pyspark.sql import functions as F

import brute
from ridemetrics.llm import decontaminate
from ridemetrics.llm.decontaminate import contamination, drop_contaminated, find_test_passages

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def _tables(seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(40)] + ["É", "ñu", "42"]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40)))) for i in range(30)]
    items += [(30, None), (31, "..."), (32, "short one"), (33, "short one"), (None, "no id here"), (5, items[5][1])]
    docs = []
    for i in range(120):
        text = rng.choices(words, k=rng.randrange(0, 200))
        if i % 3 == 0:
            passage = (rng.choice(items)[1] or "").split()
            a = rng.randrange(0, 5)
            text[10:10] = passage[a : a + rng.randrange(5, 40)] if i % 2 else [w.upper() for w in passage]
        docs.append((i, ", ".join(text) if i % 4 else "\n".join(text)))
    docs += [(200, None), (201, ""), (202, "-- ##"), (203, "a Short-ONE b"), (204, "no id, here" + " z" * 50)]
    return docs, items


def _got(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block_words", [60, 10**6])
def test_equals_the_plain_version(spark, seed, block_words):
    docs, items = _tables(seed)
    found = find_test_passages(
        spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), block_words=block_words
    )
    got = _got(contamination(found))
    for k, (n, hit, names, bad) in brute.contamination(dict(docs), items).items():
        listed = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        r = got[k]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(names), listed, bad), k


def test_proximity(spark):
    item = " ".join(f"t{i}" for i in range(13))
    shifted = item.replace("t6", "x t6")
    far = item.replace("t6", "x x x x x x t6")
    docs = spark.createDataFrame([(1, item), (2, shifted), (3, far)], DOCS)
    got = _got(find_test_passages(docs, spark.createDataFrame([(1, item)], ITEMS), slop=2))
    assert [(got[k].items, got[k].near) for k in (1, 2, 3)] == [([1], [1]), ([], [1]), ([], [])]
    assert got[1].spans[0].asDict() == {"first": 0, "past": 13}


def test_dropping_and_edges(spark):
    docs = spark.createDataFrame([(1, "the short one"), (2, "x " * 90 + "short one"), (3, None), (None, "short one")], DOCS)
    docs = docs.withColumns({"terms": F.lit(1), "n_words": F.lit("x"), "_bad": F.lit(0)})
    items = spark.createDataFrame([(1, "Short, one!")], ITEMS)
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3]
    assert drop_contaminated(docs, items.limit(0)).count() == 4
    assert contamination(find_test_passages(docs.limit(0), items)).count() == 0


@pytest.mark.parametrize("block_words", [60, 10**6])
def test_null_and_repeated_ids(spark, block_words):
    """Each row has its own answer, in one block of items and in many."""
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices("abcdefgh", k=40))) for i in range(6)]
    texts = [" ".join(rng.choices("abcdefgh", k=60)) for _ in range(20)] + [None, "", items[5][1], items[5][1]]
    texts += [" ".join(reversed(t.split())) for _, t in items] + [f"{t} {'z ' * 20}" for _, t in items]
    answers = brute.contamination(dict(enumerate(texts)), items)
    for doc_id in (None, 7):
        table = spark.createDataFrame([(doc_id, t) for t in texts], DOCS).repartition(3)
        tests = spark.createDataFrame(items, ITEMS)
        found = contamination(find_test_passages(table, tests, block_words=block_words)).collect()
        got = [(r.n_words, r.n_hit, r.n_items, r.contaminated) for r in found]
        assert sorted(got) == sorted((n, hit, len(names), bad) for n, hit, names, bad in answers.values())
        kept = [r.text or "" for r in drop_contaminated(table, tests, block_words=block_words).collect()]
        assert sorted(kept) == sorted(t or "" for k, t in enumerate(texts) if doc_id is None or not answers[k][3])


def test_a_second_benchmark_is_answered_from_the_stored_index(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 3000)
    docs, items = _tables(3)
    index = decontaminate.build_index(spark.createDataFrame(docs, DOCS).repartition(2))
    assert index.count() > 10
    for part in (items[:10], items[10:], [(1, "w1"), (2, "w2 w3")]):
        got = _got(contamination(decontaminate.search(index, spark.createDataFrame(part, ITEMS))))
        assert len(got) == len(docs)
        for k, (n, hit, names, bad) in brute.contamination(dict(docs), part).items():
            r = got[k]
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(names), bad), k


@pytest.mark.parametrize("candidates", [1, 7, 1 << 20])
def test_very_frequent_words(spark, monkeypatch, candidates):
    """One word makes up texts and items, so each window matches almost everywhere."""
    monkeypatch.setattr(decontaminate, "CANDIDATES", candidates)
    docs = [(1, "x " * 300), (2, "x " * 12), (3, "x " * 13), (4, "y " * 50 + "x " * 20), (5, "")]
    items = [(1, "x " * 14), (2, "x " * 40 + "y"), (3, "y " * 13)]
    got = _got(contamination(find_test_passages(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))))
    for k, (n, hit, names, bad) in brute.contamination(dict(docs), items).items():
        assert (got[k].n_words, got[k].n_hit, got[k].n_items, got[k].contaminated) == (n, hit, len(names), bad), k


def test_matches_do_not_cross_documents(spark):
    words = [f"t{i}" for i in range(13)]
    docs = [(1, " ".join(words[:7])), (2, " ".join(words[7:])), (3, " ".join(words))]
    found = find_test_passages(spark.createDataFrame(docs, DOCS).coalesce(1), spark.createDataFrame([(1, " ".join(words))], ITEMS))
    assert {r.doc_id: (r.items, r.near) for r in found.collect()} == {1: ([], []), 2: ([], []), 3: ([1], [1])}


def test_a_very_long_text(spark):
    words = [f"w{i % 977}" for i in range(300_000)]
    docs = [(1, " ".join(words)), (2, "z" * 3_000_000)]
    items = [(1, " ".join(words[1000:1020])), (2, "none of this is there " * 4)]
    got = _got(contamination(find_test_passages(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))))
    for k, (n, hit, names, bad) in brute.contamination(dict(docs), items).items():
        assert (got[k].n_words, got[k].n_hit, got[k].n_items, got[k].contaminated) == (n, hit, len(names), bad), k
