"""Language identification that fuses the text with what its surroundings declare.

The log posterior of a language is the sum of
- the text's likelihood under a model of byte trigrams, tempered, as neighbouring trigrams overlap;
- how often documents of that language carry the declared markup language that this one carries;
- the prior of the host: the counts of its documents' languages, smoothed towards those of its
  address suffix, and these towards those of all documents.

Trigrams, declarations and priors are counted over all documents by grouped aggregation. The
counts of the declarations and priors use the languages that the text alone suggests.

One more hypothesis competes with the languages: a background in which all trigrams are equally likely, with the
declarations of all documents and a small prior of its own. It wins where a text is in none of the languages,
in another script or no language at all, and such texts are rejected.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ridemetrics.llm.common import set_up, slices, store

BUCKETS = 1 << 16
# Share of a trigram's log likelihood that counts: each byte is in three of them.
TEMPER = 1 / 3
# Documents that an outer level of the prior is worth in an inner one.
PRIOR_WEIGHT = 20.0
DECLARED_SMOOTHING = 1.0
LEAST_CONFIDENCE = 0.5
# Prior of the background, and its log likelihood of a trigram.
BACKGROUND_PRIOR = 0.01
BACKGROUND_LOG = -float(np.log(BUCKETS))
# Declared values that are languages of their own, the most frequent ones; all others are one class. Bounds the model.
MOST_LANGUAGES = 255
OTHER = "other"
# Up to this many hosts their priors are broadcast; beyond it they are joined by shuffle.
BROADCAST_HOSTS = 50_000

_LETTERS = bytes(
    b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def trigrams(text: bytes) -> np.ndarray:
    """Hashed byte trigrams; what is not an ASCII letter or part of a longer character is a space."""
    raw = np.frombuffer(b" " + text.translate(_LETTERS) + b" ", np.uint8)
    if len(raw) < 3:
        return np.empty(0, np.int64)
    spaces = (raw == 0x20).view(np.uint8)
    wide = raw.astype(np.uint32)
    keys = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
    keys = keys[spaces[:-2] + spaces[1:-1] + spaces[2:] < 2]
    return (keys * np.uint32(2654435761) >> np.uint32(16)).astype(np.int64)


def _count(labelled: DataFrame) -> DataFrame:
    """Trigram counts by declared language."""

    def count(batches):
        totals = {}
        for batch in slices(batches):
            texts = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, found in texts.items():
                total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total += np.bincount(trigrams(b"  ".join(found)), minlength=BUCKETS)
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            columns = [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(total[used])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    counted = labelled.mapInArrow(count, "lang string, bucket long, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class TextModel:
    """Log likelihoods of trigrams in each language, with add-half smoothing."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        self.logs = np.log(smooth / smooth.sum(1, keepdims=True)).T.astype(np.float32).copy()

    def evidence(self, text: bytes | None) -> list[float] | None:
        """Tempered log likelihood per language, then that of the background; null without letters."""
        found = trigrams(text or b"")
        if not len(found) or not self.languages:
            return None
        return [*(TEMPER * self.logs[found].sum(0, dtype=np.float64)).tolist(), TEMPER * BACKGROUND_LOG * len(found)]


def _declaration(docs: DataFrame, declared_col: str) -> Column:
    """The declared value in lower case, empty for none; all but the most frequent ones are one class."""
    value = F.coalesce(F.lower(F.col(f"`{declared_col}`").cast("string")), F.lit(""))
    counts = docs.select(value.alias("value")).filter("value != ''").groupBy("value").count()
    frequent = counts.orderBy(F.desc("count"), "value").limit(MOST_LANGUAGES)
    return F.when((value == "") | value.isin([r["value"] for r in frequent.collect()]), value).otherwise(OTHER)


def train(docs: DataFrame, text_col: str, declared: Column) -> TextModel:
    """Text model from all documents that declare a language. Its size is languages x BUCKETS."""
    set_up(docs.sparkSession)
    text = F.col(f"`{text_col}`")
    labelled = docs.select(declared.alias("lang"), text.cast("string").cast("binary").alias("text"))
    labelled = labelled.filter("lang != '' AND text IS NOT NULL")
    found = _count(labelled).toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((len(languages), BUCKETS))
    place = {lang: i for i, lang in enumerate(languages)}
    row = [place[lang] for lang in found.column("lang").to_pylist()]
    counts[row, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return TextModel(languages, counts)


def _text_evidence(docs: DataFrame, model: TextModel, text_col: str) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def evidence(texts: pa.Array) -> pa.Array:
        model = shared.value
        # One text at a time: a batch may hold many long ones.
        return pa.array([model.evidence(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return F.arrow_udf(evidence, "array<double>")(F.col(f"`{text_col}`").cast("string").cast("binary"))


def _best(scores: str, languages: list[str]) -> Column:
    """Language with the highest score, the first in alphabetical order among equals; null for the background."""
    names = F.array(*map(F.lit, languages)) if languages else F.array().cast("array<string>")
    return F.get(names, (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^[A-Za-z]+://(?:[^/@]*@)?([^/:?#]+)", 1))


def suffix_of(host: Column) -> Column:
    """Last label of a host name, empty without a dot."""
    return F.when(host.contains("."), F.substring_index(host, ".", -1)).otherwise("")


def of_pages(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``pages`` with ``text``, ``lang`` and ``host``: what a reader sees, the language that the markup declares and
    the host of the address. These columns replace others of their names.

    Null markup gives a null text; a declaration's region (``en-GB``) is left out; an address without a host has an empty one.
    """
    seen = F.regexp_replace(F.col(f"`{html_col}`"), r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")
    declared = F.regexp_extract(F.col(f"`{html_col}`"), r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-z]{2,8})""", 1)
    text = F.regexp_replace(F.regexp_replace(seen, "<[^>]*>", " "), "&[a-zA-Z]{1,10};|&#[0-9xa-fA-F]{1,8};", " ")
    return pages.withColumns({"text": text, "lang": F.nullif(F.lower(declared), F.lit("")), "host": host_of(url_col)})


def identify(
    docs: DataFrame,
    text_col: str = "text",
    declared_col: str = "lang",
    host: Column | None = None,
    least_confidence: float = LEAST_CONFIDENCE,
) -> DataFrame:
    """All rows and columns of ``docs`` and a column ``language_id`` of
    ``struct<language, confidence, text_language, declared, accepted>``.

    ``host`` defaults to the column ``source``. A document is accepted if its text has letters and
    the posterior of its best language is at least ``least_confidence``. Null and empty texts, texts without
    letters and those for which the background is more likely than any language have no language and are
    rejected. A null declaration or host is a value like others; declared values beyond the MOST_LANGUAGES
    most frequent ones are the one class OTHER. Ties go to the first language in alphabetical order. A text of any length is
    read as a whole; rows that repeat each get their answer. A table without declared languages has no model and no
    accepted rows. An existing column ``language_id`` is replaced.
    """
    spark = docs.sparkSession
    host = F.col("source") if host is None else host
    host = F.coalesce(F.lower(host.cast("string")), F.lit(""))
    declared = _declaration(docs, declared_col)
    model = train(docs, text_col, declared)
    languages = model.languages
    near = _text_evidence(docs, model, text_col)

    # What the text alone says, for all documents.
    seen = docs.select(host.alias("host"), declared.alias("declared"), near.alias("near"))
    seen = seen.withColumn("language", _best("near", languages)).filter(F.col("language").isNotNull())
    seen = store(seen.groupBy("host", "declared", "language").agg(F.count(F.lit(1)).alias("n")), "evidence")

    tell = _declaration_logs(seen, languages)
    priors = _host_priors(seen, languages)
    if priors.count() <= BROADCAST_HOSTS:
        priors = F.broadcast(priors)

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "language_id"]).alias("_row")
    rows = docs.select(whole, host.alias("_host"), declared.alias("_declared"), near.alias("_near"))
    rows = rows.join(priors, F.col("_host") == F.col("host"), "left")
    none = F.array_repeat(F.lit(0.0), len(languages) + 1)
    told = F.coalesce(F.try_element_at(tell, F.col("_declared")), none)
    fused = F.zip_with(F.zip_with("_near", told, lambda a, b: a + b), F.coalesce("prior", none), lambda a, b: a + b)
    rows = rows.withColumn("_sum", fused)
    total = F.aggregate("_sum", F.lit(0.0), lambda s, x: s + F.exp(x - F.array_max("_sum")))
    rows = rows.withColumn("_best", _best("_sum", languages)).withColumn("_sure", F.when(F.size("_sum") > 0, 1 / total))
    answer = F.struct(
        F.col("_best").alias("language"),
        F.col("_sure").alias("confidence"),
        _best("_near", languages).alias("text_language"),
        F.col("_declared").alias("declared"),
        F.coalesce(F.col("_sure") >= least_confidence, F.lit(False)).alias("accepted"),
    )
    return rows.select("_row.*", answer.alias("language_id"))


def _declaration_logs(seen: DataFrame, languages: list[str]) -> Column:
    """Map from a declaration to its log probability in each language and in the background.

    It has at most MOST_LANGUAGES + 2 entries, for the languages, all others and none.
    """
    counts = {(r["declared"], r["language"]): r["n"] for r in seen.groupBy("declared", "language").agg(F.sum("n").alias("n")).collect()}
    values = sorted({d for d, _ in counts})
    logs = {}
    for d in values:
        logs[d] = [
            float(np.log((counts.get((d, lang), 0) + DECLARED_SMOOTHING)
                         / (sum(counts.get((e, lang), 0) for e in values) + DECLARED_SMOOTHING * len(values))))
            for lang in languages
        ]
        of_all = sum(counts.get((d, lang), 0) for lang in languages) + DECLARED_SMOOTHING
        logs[d].append(float(np.log(of_all / (sum(counts.values()) + DECLARED_SMOOTHING * len(values)))))
    if not logs:
        return F.lit(None).cast("map<string,array<double>>")
    entries = [x for d, row in logs.items() for x in (F.lit(d), F.array(*map(F.lit, row)))]
    return F.create_map(*entries)


def _host_priors(seen: DataFrame, languages: list[str]) -> DataFrame:
    """``host, prior``: log prior of each language, smoothed over suffix and all documents, and of the background."""

    of = [F.coalesce(F.sum(F.when(F.col("language") == lang, F.col("n"))), F.lit(0)) for lang in languages]
    counts = (F.array(*of) if of else F.array().cast("array<long>")).alias("counts")

    def smoothed(name, outer):
        """(counts + weight x outer) / (all + weight)"""
        size = F.aggregate(name, F.lit(0).cast("long"), lambda s, x: s + x)
        return F.zip_with(name, outer, lambda c, p: (c + PRIOR_WEIGHT * p) / (size + PRIOR_WEIGHT))

    seen = seen.withColumn("suffix", suffix_of(F.col("host")))
    even = F.array_repeat(F.lit(1.0 / max(1, len(languages))), len(languages))
    top = seen.agg(counts).select(smoothed("counts", even).alias("p"))
    suffixes = seen.groupBy("suffix").agg(counts).join(F.broadcast(top))  # one row
    suffixes = suffixes.select("suffix", smoothed("counts", F.col("p")).alias("p"))
    hosts = seen.groupBy("host", "suffix").agg(counts).join(suffixes, "suffix")
    hosts = hosts.select("host", smoothed("counts", F.col("p")).alias("p"))
    logs = F.transform("p", lambda x: F.log(x * F.lit(1 - BACKGROUND_PRIOR)))
    return store(hosts.select("host", F.concat(logs, F.array(F.lit(float(np.log(BACKGROUND_PRIOR))))).alias("prior")), "priors")
