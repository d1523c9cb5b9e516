"""Registered queries of the operators, each over its whole table."""

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from ridemetrics.llm.centroid_clusters import cluster, with_inertia
from ridemetrics.llm.chat import parse_transcripts, train
from ridemetrics.llm.common import scope, shared_folder
from ridemetrics.llm.conversation_repair import damaged, repair
from ridemetrics.llm.decontaminate import contamination, find_test_passages
from ridemetrics.llm.exact_dedup import exact_groups
from ridemetrics.llm.language_id import identify, of_pages
from ridemetrics.llm.ngram_join import similarity_classes
from ridemetrics.llm.ppm import lm_scores
from ridemetrics.llm.secrets import scan_secrets
from ridemetrics.llm.sentencepiece import encode_pieces
from ridemetrics.llm.token_records import encode_to_records
from ridemetrics.llm.topk_search import integer_vectors, top_k
from ridemetrics.llm.warc import arc_to_warc, page_records, write_arc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark, sf_dir):
    arc, warc = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    write_arc(_table(spark, sf_dir, "pages"), arc)
    arc_to_warc(spark, arc, warc)
    return page_records(spark, warc)


def op2_ngram_join(spark, sf_dir):
    return similarity_classes(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark, sf_dir):
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark, sf_dir):
    found = encode_pieces(_table(spark, sf_dir, "documents").select("doc_id", "text"), _vocabulary("piece_bpe_32k.model"))
    return found.select(
        "doc_id", F.size("pieces.ids").cast("long").alias("n_pieces"), "pieces.n_bytes", "pieces.ids_crc32", "pieces.round_trip"
    )


def op5_language_id(spark, sf_dir):
    found = identify(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "language_id.*")


def op5_language_id_pages(spark, sf_dir):
    """With the language that the markup declares, the host of the address and its suffix."""
    found = identify(of_pages(_table(spark, sf_dir, "pages")), host=F.col("host"))
    return found.select("page_id", "host", "language_id.*")


# Speaker markers of raw transcripts by style: system, user, assistant.
_STYLES = [
    ["System: ", "User: ", "Assistant: "],
    ["[Instructions] ", "[Human] ", "[AI] "],
    ["Context: ", "Q: ", "A: "],
    ["### System:\n", "### Customer:\n", "### Agent:\n"],
]


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the text as in a raw transcript: a speaker marker in the
    style of the conversation ahead of it, left out in one turn of eight."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(_STYLES)))
    marks = F.create_map(
        *[F.lit(x) for k, row in enumerate(_STYLES) for role, mark in zip(("system", "user", "assistant"), row) for x in (f"{k}{role}", mark)]
    )
    mark = F.coalesce(F.try_element_at(marks, F.concat(style.cast("string"), F.lower("role"))), F.lit(""))
    shown = F.pmod(F.xxhash64("conv_id", "turn", "role"), F.lit(8)) != 0
    text = F.concat(F.when(shown, mark).otherwise(""), F.coalesce("text", F.lit("")))
    return conversations.select("conv_id", "turn", "role", text.alias("text"))


def op6_chat_formatting(spark, sf_dir):
    raw = raw_transcripts(_table(spark, sf_dir, "conversations"))
    turns = parse_transcripts(raw, train(raw))
    return turns.select(
        "conv_id", F.col("seq").alias("turn"), "segment", "role", "opens", "n_lines", F.sha2("rendered", 256).alias("rendered_sha256")
    )


def op7_decontamination(spark, sf_dir):
    found = find_test_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return contamination(found)


def op8_exact_dedup(spark, sf_dir):
    return exact_groups(_table(spark, sf_dir, "documents"))


def op9_lm_scores(spark, sf_dir):
    return lm_scores(_table(spark, sf_dir, "documents"))


def op10_token_records(spark, sf_dir):
    _, index = encode_to_records(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_topk_search(spark, sf_dir):
    return top_k(integer_vectors(_table(spark, sf_dir, "embeddings")), F.col("id") % 50 == 0)


def op12_conversation_repair(spark, sf_dir):
    conversations = _table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations).reports()


def op13_centroid_clustering(spark, sf_dir):
    found = with_inertia(*cluster(_table(spark, sf_dir, "embeddings")))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


_QUERIES = {
    "op1_warc": op1_warc,
    "op2_ngram_join": op2_ngram_join,
    "op3_secret_scan": op3_secret_scan,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_language_id": op5_language_id,
    "op5_language_id_pages": op5_language_id_pages,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_decontamination": op7_decontamination,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_lm_scores": op9_lm_scores,
    "op10_token_records": op10_token_records,
    "op11_topk_search": op11_topk_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_centroid_clustering": op13_centroid_clustering,
    "pipeline": corpus_pipeline.run,
}


def _scoped(name, query):
    """The query, which first deletes what its last call has stored."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with scope(spark, name):
            return query(spark, sf_dir)

    return run


QUERIES = {name: _scoped(name, query) for name, query in _QUERIES.items()}

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_SCALED = "list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))"


def _clusters_sql(clusters: int, rounds: int, dimensions: int) -> str:
    """The rounds one after the other; c holds the centroids of a round, a what it assigns."""
    assign = """a{0} AS (
        SELECT v.n, v.vec_id, MIN({{'d': CAST(v.s - 2 * list_inner_product(v.q, c.q) + list_inner_product(c.q, c.q) AS BIGINT), 'c': c.c}}) AS best
        FROM v CROSS JOIN c{0} c GROUP BY ALL)"""
    move = """m{1} AS (
        SELECT c, list(CAST(x AS DOUBLE) ORDER BY i) AS q FROM (
            SELECT c, i, CAST((s - ((s % k) + k) % k) // k AS BIGINT) AS x FROM (
                SELECT a.best.c AS c, u.i, CAST(SUM(CAST(v.q[u.i] AS BIGINT)) AS BIGINT) AS s, COUNT(*) AS k
                FROM a{0} a JOIN v USING (n) CROSS JOIN range(1, {2}) u(i) GROUP BY 1, 2)) GROUP BY c),
    c{1} AS (SELECT c, COALESCE(m.q, o.q) AS q FROM c{0} o LEFT JOIN m{1} m USING (c))"""
    steps = [f"""
    v AS MATERIALIZED (
        SELECT row_number() OVER () AS n, vec_id, q, list_inner_product(q, q) AS s
        FROM (SELECT vec_id, {_SCALED} AS q FROM embeddings WHERE {_FINITE} AND len(embedding) = {dimensions})),
    c0 AS (
        SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q
        FROM (SELECT sha256('2:' || vec_id) AS h, q FROM v) ORDER BY h NULLS LAST, q LIMIT {clusters})"""]
    for k in range(rounds):
        steps += [assign.format(k), move.format(k, k + 1, dimensions + 1)]
    steps.append(assign.format(rounds))
    return "WITH" + ",\n    ".join(steps) + f"""
    SELECT a.vec_id, CAST(a.best.c AS INT) AS cluster, a.best.d AS distance,
           CAST(SUM(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia, CAST(SUM(a.best.d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(list_transform(c.q, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
    FROM a{rounds} a JOIN c{rounds} c ON c.c = a.best.c"""


ORACLE_SQL = {
    "op1_warc": """
        WITH p AS (SELECT page_id, encode(COALESCE(html, '')) AS payload FROM pages),
        f AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest,
                     MIN(page_id) OVER (PARTITION BY payload) AS first FROM p)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
        FROM f""",
    "op8_exact_dedup": """
        SELECT doc_id, MAX(doc_id) OVER t AS keep_id, COUNT(*) OVER t AS group_size,
               doc_id = MAX(doc_id) OVER t AS kept, sha256(COALESCE(text, '')) AS text_sha256
        FROM documents WINDOW t AS (PARTITION BY COALESCE(text, ''))""",
    "op11_topk_search": f"""
        WITH v AS (SELECT vec_id, {_SCALED} AS q FROM embeddings WHERE {_FINITE}),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
    "op13_centroid_clustering": _clusters_sql(40, 5, 64),
}
