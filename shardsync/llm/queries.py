"""The queries of this subpackage, their contracts' columns and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsync.llm.common import held_out, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.token_files import count_tokens

    found = count_tokens(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_tokens", "ordinal", "start")


@query
def op3_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.warc import archive_pages

    return archive_pages(_table(spark, sf_dir, "pages")).drop("capture")


ORACLE["op3_warc_transactions"] = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), g AS (
    SELECT page_id, octet_length(b) AS n, sha1(b) AS d,
           CASE WHEN octet_length(b) >= 1000 THEN max(page_id) OVER (PARTITION BY b) ELSE page_id END AS keep
    FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM g
"""


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.language import identify

    docs = _table(spark, sf_dir, "documents")
    outside = held_out(F.col("doc_id")).alias("held_out")
    return identify(docs, keep=("doc_id", outside))


@query
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE["op5_exact_top_k"] = """
WITH v AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id, score
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.dedup import exact_dedup

    found = exact_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op6_exact_dedup"] = """
WITH d AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), g AS (
    SELECT doc_id, sha256(t) AS text_sha256, max(doc_id) OVER (PARTITION BY t) AS keep_id,
           count(*) OVER (PARTITION BY t) AS group_size
    FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.neardup import near_dedup

    return near_dedup(_table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.toxicity import fit, score_toxicity

    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    found = score_toxicity(docs, fit(docs, labels))
    return found.withColumn("held_out", held_out(F.col("doc_id")))


@query
def op9_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.mixing import plan_mix

    return plan_mix(_table(spark, sf_dir, "documents"), repeats=2.0).drop("at")


ORACLE["op9_temperature_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source, coalesce('=' || source, '') AS name,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens,
           ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
    FROM documents
), s AS (
    SELECT name, sum(n_tokens)::BIGINT AS tokens, ((count(*) + 999) // 1000) AS blocks,
           max(sum(n_tokens)) OVER () AS most,
           min(CASE WHEN sum(n_tokens) > 0 THEN sum(n_tokens) END) OVER () AS least
    FROM d GROUP BY name
), f AS (
    SELECT name, tokens, blocks, round(most * pow(tokens / most,
               CASE WHEN most <= 2 * least THEN 0 ELSE 1 - ln(2) / ln(most / least) END))::BIGINT AS budget
    FROM s
), w AS (
    SELECT d.*, h % blocks AS block,
           sum(n_tokens) OVER (PARTITION BY name, h % blocks ORDER BY h, doc_id, n_tokens
                               ROWS UNBOUNDED PRECEDING)::BIGINT - n_tokens AS before
    FROM d JOIN f USING (name)
), b AS (
    SELECT name, block, sum(n_tokens)::BIGINT AS block_tokens FROM w GROUP BY name, block
), e AS (
    SELECT b.*, f.tokens, f.budget, unnest(range(0, budget // greatest(tokens, 1) + 1)) AS epoch
    FROM b JOIN f USING (name)
), o AS (
    SELECT name, block, epoch, budget, epoch * tokens - block_tokens
           + sum(block_tokens) OVER (
               PARTITION BY name, epoch
               ORDER BY ('0x' || substr(md5('0:' || epoch || ':' || name || ':' || block), 1, 15))::BIGINT,
                        block
               ROWS UNBOUNDED PRECEDING)::BIGINT AS first
    FROM e
)
SELECT w.doc_id, w.source, o.epoch::INTEGER AS epoch, w.n_tokens, w.block,
       o.first + w.before AS start, o.budget
FROM w JOIN o USING (name, block)
WHERE o.first + w.before + w.n_tokens <= o.budget
"""


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"))


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.trie import conversation_trie

    return conversation_trie(_table(spark, sf_dir, "conversations"))


ORACLE["op13_conversation_trie"] = r"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p
    FROM conversations WHERE conv_id IS NOT NULL
), c AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base,
           list_reduce(list_concat([4294967295::BIGINT],
                   [ord(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
               lambda s, x: list_reduce(list_concat([xor(s, x)], range(8)),
                   lambda y, i: CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)) AS crc
    FROM (SELECT DISTINCT conv_id FROM t)
), h AS (
    SELECT conv_id, base, 3 - crc % 4 AS h FROM c
), r AS (
    SELECT h.conv_id, p, role, text FROM h JOIN t ON t.conv_id = h.base AND p < h
    UNION ALL
    SELECT h.conv_id, p, role, text FROM h JOIN t ON t.conv_id = h.conv_id AND p >= h
), s AS (
    SELECT h.conv_id, coalesce(list(sha256(strlen(role) || ':' || role || text) ORDER BY p)
               FILTER (text IS NOT NULL), []) AS path,
           coalesce(list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY p)
               FILTER (text IS NOT NULL), []) AS words
    FROM h LEFT JOIN r USING (conv_id) GROUP BY h.conv_id
), m AS (
    SELECT conv_id, unnest(range(0, len(path) + 1)) AS depth, path, words FROM s
), n AS (
    SELECT depth, list_slice(path, 1, depth) AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
           any_value(CASE WHEN depth = 0 THEN 0 ELSE words[depth] END) AS w,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), ''))
               AS ends_sha256
    FROM m GROUP BY ALL
), k AS (
    SELECT p.depth, p.prefix, count(c.depth) AS n_children
    FROM n p LEFT JOIN n c ON c.depth = p.depth + 1 AND list_slice(c.prefix, 1, p.depth) = p.prefix
    GROUP BY ALL
), u AS (
    SELECT n.*, n_children FROM n JOIN k USING (depth, prefix)
), b AS (
    SELECT unnest(range(0, depth + 1)) AS top, prefix, (n_convs - 1) * w AS saved,
           (n_children = 0)::INTEGER AS leaf
    FROM u
), g AS (
    SELECT top AS depth, list_slice(prefix, 1, top) AS prefix, sum(leaf)::BIGINT AS n_leaves,
           sum(saved)::BIGINT AS saved_tokens
    FROM b GROUP BY ALL
)
SELECT u.conv_id, u.depth, p.conv_id AS parent_conv_id, u.n_convs, u.n_children, g.n_leaves, g.saved_tokens,
       u.ends_sha256
FROM u JOIN g USING (depth, prefix)
LEFT JOIN n p ON p.depth = u.depth - 1 AND p.prefix = list_slice(u.prefix, 1, u.depth - 1)
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.negatives import hard_negatives

    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


ORACLE["op12_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) for x in embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same,
           list_inner_product(a.v, c.v)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""


@query
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardsync.llm.jaccard import jaccard_classes

    return jaccard_classes(_table(spark, sf_dir, "documents"))
