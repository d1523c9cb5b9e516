"""The pipeline against plain versions of its stages, on a small table with planted cases."""

import random
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import brute
from ridemetrics.llm.common import forget

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents of the small scale and, planted among them, copies, near copies and passages."""
    folder = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    rng = random.Random(4)
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs]
    long = [r for r in rows if len(r[1].split()) > 100]
    for k, r in enumerate(long[:12]):
        words = r[1].split(" ")
        words[rng.randrange(len(words))] = "edited"
        text = r[1] if k % 3 == 0 else " ".join(words) if k % 3 == 1 else f"{items[k].text} {r[1][:50]}"
        rows.append((10_000 + k, text, r[2], r[3], len(text)))
    rows += [(20_000, None, "en", "src0", 0), (20_001, "123 ...", "en", "src0", 7), (20_002, "", None, None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, [(r.item_id, r.text) for r in items]


def test_stages_keep_what_plain_versions_keep(spark, corpus):
    folder, rows, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {r[0]: r[1] for r in rows}
    stages = dict(corpus_pipeline.STAGES)

    docs = stages["language_id"](spark, docs, folder).persist()
    assert docs.columns == columns
    # Clean documents stay; those without letters go.
    kept = {k: t for k, t in kept.items() if k < 20_000}
    assert {r.doc_id for r in docs.collect()} == set(kept)

    docs = stages["exact_dedup"](spark, docs, folder).persist()
    last = {}
    for k, t in kept.items():
        last[t] = max(k, last.get(t, k))
    kept = {k: t for t, k in last.items()}
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == kept

    docs = stages["ngram_join"](spark, docs, folder).persist()
    classes = brute.similarity_classes(kept)
    kept = {k: t for k, t in kept.items() if classes[k][1] == k}
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == set(kept)
    assert any(v[1] != k for k, v in classes.items())

    docs = stages["decontamination"](spark, docs, folder).persist()
    dirty = {k for k, v in brute.contamination(kept, items).items() if v[3]}
    assert dirty and docs.columns == columns and {r.doc_id for r in docs.collect()} == set(kept) - dirty

    docs = stages["sentencepiece"](spark, docs, folder)
    assert docs.columns[: len(columns)] == columns
    assert docs.filter("round_trip AND n_pieces > 0 AND size(ids) = n_pieces").count() == len(kept) - len(dirty)

    whole = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in whole.select("doc_id").collect()} == set(kept) - dirty


def test_near_copies_from_four_fifths_on_go(spark):
    """Pairs planted around 0.8 at five words; those below 0.85 stayed at four words and 0.85."""
    rng = random.Random(8)

    def pair(shared, apart):
        """Two texts with ``shared`` five-word runs in common, and ``apart`` more in each."""
        head = [f"w{rng.randrange(10**9)}" for _ in range(shared + 4)]
        return [" ".join(head + [f"w{rng.randrange(10**9)}" for _ in range(apart)]) for _ in range(2)]

    # shared / (shared + 2 apart): 0.80, 0.82, 0.84, 0.78, 0.90
    pairs = [pair(160, 20), pair(164, 18), pair(168, 16), pair(156, 22), pair(180, 10)]
    texts = {k: t for k, t in enumerate(t for p in pairs for t in p)}
    similar = brute.similarity_classes(texts, n=5, t=(80, 100))
    wanted = {k for k in texts if similar[k][1] == k}
    assert wanted == {0, 2, 4, 6, 7, 8}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    kept = dict(corpus_pipeline.STAGES)["ngram_join"](spark, docs, SF)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == wanted


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "decontamination", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("key", ["op1_warc", "op8_exact_dedup", "op11_topk_search", "op13_centroid_clustering"])
def test_same_rows_as_sql(spark, key):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = con.execute(contract.oracle_sql()[key])
    names = [c[0] for c in expected.description]
    got = contract.queries()[key](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, expected.fetchall()))


def test_queries_name_all_operators():
    found = [k for k in contract.queries() if k.startswith("op")]
    assert {int(k[2:].split("_")[0]) for k in found} == set(range(1, 14))
    assert "pipeline" in contract.queries()


def test_every_stage_takes_an_empty_table(spark, corpus):
    folder, *_ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).agg(F.count("*")).first()[0] == 0, name


@pytest.fixture(scope="module")
def clashing(spark, tmp_path_factory):
    """Rows with columns named like those that the stages use, and one with a point in its name."""
    folder = str(tmp_path_factory.mktemp("clashing"))
    text = " ".join(f"the cat number{i} sat on a mat" for i in range(30))
    other = " ".join(f"when dogs run{i} far they rest" for i in range(30))
    rows = [(1, text, "en", "s"), (5, f"{text} now", "en", "s"), (5, other, "en", "s"), (5, other, "en", "s"), (None, text + " b", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumns({c: F.lit(c) for c in ("language_id", "_pieces", "row", "_row", "tie", "key", "a.b", "doc id", "pieces")})
    docs.withColumn("m", F.create_map(F.lit("k"), F.lit(1))).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_any_column_names_pass_through(spark, clashing):
    docs = spark.read.parquet(f"{clashing}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, clashing).persist()
        assert docs.columns == before.columns and docs.dtypes == before.dtypes, name
        assert {r["language_id"] for r in docs.select("language_id").collect()} == {"language_id"}
        assert {r["a.b"] for r in docs.collect()} == {"a.b"}
    # The near copy under the id 5 goes and the other text of that id stays.
    assert sorted([(r.doc_id or 0, r.text[:8]) for r in docs.collect()]) == [(0, "the cat "), (1, "the cat "), (5, "when dog")]
    done = corpus_pipeline.STAGES[-1][1](spark, docs, clashing)
    assert done.columns == [*docs.columns, "ids", "n_pieces", "round_trip"]
    assert done.filter("round_trip AND _pieces = '_pieces'").count() == 3
    assert corpus_pipeline.run(spark, clashing).count() == 3


def test_a_name_that_a_stage_adds_is_refused(spark, clashing):
    docs = spark.read.parquet(f"{clashing}/documents.parquet").withColumn("IDS", F.lit(1))
    with pytest.raises(ValueError, match="ids"):
        corpus_pipeline.STAGES[-1][1](spark, docs, clashing)


def test_a_query_leaves_only_the_tables_of_its_last_call(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), "ridemetrics-llm", spark.sparkContext.applicationId)
    counts = []
    for _ in range(2):
        contract.queries()["op8_exact_dedup"](spark, SF).collect()
        counts.append(len(list((root / "op8_exact_dedup").iterdir())))
    assert counts == [1, 1]
    forget(spark, "op8_exact_dedup")
    assert not (root / "op8_exact_dedup").exists()
