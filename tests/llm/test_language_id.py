import base64
import random

import pytest
from pyspark.sql import functions as F

import brute
from ridemetrics.llm import language_id
from ridemetrics.llm.language_id import host_of, identify, suffix_of, trigrams
from ridemetrics.llm.queries import op5_language_id_pages

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string"
EN, FR = "the cat sat on the mat and the dog ran ", "le chat est sur la table avec les chiens "


def _by_id(df):
    return {r.doc_id: r.language_id for r in df.collect()}


def test_documents_are_recognised_without_their_own_label(spark):
    """Trained on six sevenths; the labels of the others are withheld."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    hidden = docs.withColumn("lang", F.when(~held, F.col("lang")))
    found = identify(hidden).filter(held).select("doc_id", "language_id.*").join(docs.select("doc_id", "lang"), "doc_id")
    right, kept = found.agg(F.avg((F.col("language") == F.col("lang")).cast("int")), F.avg(F.col("accepted").cast("int"))).first()
    assert right > 0.97 and kept > 0.97


def test_pages_use_markup_and_address(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumns(
        {
            "text": F.regexp_replace("html", "<[^>]*>", " "),
            "lang": F.nullif(F.regexp_extract("html", '<html lang="([a-z]+)"', 1), F.lit("")),
            "host": host_of("url"),
        }
    )
    found = identify(pages, host=F.col("host"))
    assert found.columns == [*pages.columns, "language_id"]
    assert found.filter("language_id.accepted").count() > 0.9 * pages.count()
    suffixes = pages.select(suffix_of(F.col("host")).alias("s")).distinct().collect()
    assert {"com", "net", "org"} >= {r.s for r in suffixes} - {""}


@pytest.mark.parametrize("broadcast_hosts", [0, 50_000])
def test_surroundings_decide_when_the_text_does_not(spark, monkeypatch, broadcast_hosts):
    monkeypatch.setattr(language_id, "BROADCAST_HOSTS", broadcast_hosts)
    rows = [(i, EN * 3, "en", "a.uk") for i in range(30)] + [(100 + i, FR * 3, "fr", "b.fr") for i in range(30)]
    rows += [(200, "zzz", None, "a.uk"), (201, "zzz", None, "b.fr"), (202, "zzz", "fr", "new.fr"), (203, EN * 9, "fr", "b.fr")]
    found = _by_id(identify(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert [found[k].language for k in (200, 201, 202, 203)] == ["en", "fr", "fr", "en"]
    assert found[203].text_language == "en" and found[203].declared == "fr"


def test_nulls_ties_and_clashing_columns(spark):
    rows = [
        (1, EN, "en", "h"), (2, None, "en", "h"), (3, "", "en", "h"), (4, "12 ?? 34", "en", None), (5, EN * 4000, "EN", "h"),
        (5, EN * 4000, "EN", "h"), (None, FR, "fr", None), (6, FR, None, None),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"prior": F.lit(1), "host": F.lit("x"), "_near": F.lit(2), "language": F.lit("y"), "language_id": F.lit("z")}
    )
    found = identify(docs)
    assert found.columns == docs.columns and found.count() == len(rows)
    by_id = _by_id(found)
    assert [by_id[k].accepted for k in (1, 2, 3, 4, 5, 6)] == [True, False, False, False, True, True]
    assert by_id[2].language is None and by_id[5].language == "en"


def test_no_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, EN, None, "h")], SCHEMA)
    assert not identify(docs).first().language_id.accepted
    assert identify(docs.limit(0)).count() == 0


def test_trigrams():
    assert len(trigrams(b"")) == len(trigrams(b"1 2 ..")) == 0
    assert (trigrams(b"Abc!") == trigrams(b"abc?")).all() and len(trigrams(b"abc")) == 3


FOREIGN = [
    "これは日本語の文章です。とても長い文章を書いています。", "Это русский текст, который написан кириллицей и довольно длинный.",
    "이것은 한국어로 쓴 문장입니다 그리고 조금 더 깁니다", "هذا نص طويل باللغة العربية مكتوب هنا",
]


def _junk(seed, n=300):
    rng = random.Random(seed)
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))


def test_foreign_scripts_and_junk_are_rejected(spark):
    """Among all documents of the table, which stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = [*FOREIGN, *[_junk(k) for k in range(4)], base64.b64encode(_junk(9).encode()).decode(), " ".join(_junk(k, 7) for k in range(60))]
    planted = spark.createDataFrame([(10**9 + k, t, None, "src0") for k, t in enumerate(odd)], SCHEMA)
    labelled = spark.createDataFrame([(2 * 10**9, FOREIGN[0], "en", "src0"), (2 * 10**9 + 1, _junk(77), "de", "src1")], SCHEMA)
    found = identify(docs.unionByName(planted).unionByName(labelled)).select("doc_id", "language_id.*")
    assert [r.language for r in found.filter(f"doc_id >= {10**9}").collect()] == [None] * (len(odd) + 2)
    kept = found.filter(f"doc_id < {10**9}").agg(F.avg(F.col("accepted").cast("int"))).first()[0]
    assert kept > 0.97


def test_equals_the_plain_fusion(spark):
    rng = random.Random(6)
    rows = []
    for i in range(150):
        words = rng.choices((EN if i % 3 else FR).split(), k=rng.randrange(1, 30))
        rows.append((i, " ".join(words), rng.choice(["en", "fr", "FR", None, "xx"]), rng.choice(["a.uk", "b.fr", "c.fr", "plain", None, "A.uk"])))
    rows += [(500, None, "en", "a.uk"), (501, "12", None, None), (502, FOREIGN[1], None, "b.fr"), (503, "zz", "fr", "new.fr"), (503, "zz", "fr", "new.fr")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = language_id.train(docs, "text", language_id._declaration(docs, "lang"))

    def logs(text):
        return [[*model.logs[t].astype(float).tolist(), language_id.BACKGROUND_LOG] for t in trigrams(text.encode()).tolist()]

    expected = brute.language(
        [r[1:] for r in rows], (model.languages, logs), language_id.TEMPER, None, language_id.PRIOR_WEIGHT,
        language_id.DECLARED_SMOOTHING, language_id.BACKGROUND_PRIOR,
    )
    found = sorted(identify(docs).collect(), key=lambda r: r.doc_id)
    for r, (_, *_), (best, confidence) in zip(found, rows, expected):
        assert r.language_id.language == best, r
        assert r.language_id.confidence == (None if confidence is None else pytest.approx(confidence, rel=1e-6))


def test_many_declared_values_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 2)
    rows = [(i, EN, "en", "h") for i in range(6)] + [(10 + i, FR, "fr", "h") for i in range(5)]
    rows += [(20 + i, "xyz wvu qqq zzk " * 3, f"x{i}", "h") for i in range(4)]
    found = _by_id(identify(spark.createDataFrame(rows, SCHEMA)))
    assert {found[k].language for k in (0, 10, 20, 23)} == {"en", "fr", language_id.OTHER}
    assert len(found) == len(rows)


def test_reading_pages(spark):
    html = '<!DOCTYPE html>\n<HTML class="a" lang = "EN-gb"><head><script>var le = "chat";</script><style>p {}</style></head><!-- les --><p>the&nbsp;cat</p>'
    pages = spark.createDataFrame([(1, "https://me@News.Example.CO.uk:80/a?b", html), (2, "nowhere", None), (3, None, "<p lang='fr'>x")], "page_id long, url string, html string")
    rows = language_id.of_pages(pages).orderBy("page_id").collect()
    assert [(r.text and r.text.split(), r.lang, r.host) for r in rows] == [(["the", "cat"], "en", "news.example.co.uk"), (None, None, ""), (["x"], None, None)]
    found = op5_language_id_pages(spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert found.filter("accepted").count() > 0.9 * found.count()
    assert found.filter("declared != ''").count() > 0
