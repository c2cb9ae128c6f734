"""The package's operators as named queries ``(spark, table folder) -> DataFrame``, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.llm import block_names, collocations, grid_order, hard_negatives, line_quality, mixing, packing, sharding, simhash, suffixes, toxicity, urls, vector_files
from tidewrack.llm.tables import table

SHARDS = 24
#: Target weights of the production mixture; sources share evenly.
WEIGHTS = {"domain": {"d0": 3.0, "d1": 2.0, "d2": 2.0, "d3": 1.0}, "lang": {"en": 6.0, "de": 2.0, "fr": 2.0, "es": 1.5}}


def domain_of(source: str = "source") -> Column:
    """Stand-in for a site list: four domains by a checksum of the source."""
    return F.concat(F.lit("d"), (F.crc32(F.coalesce(F.col(source), F.lit("")).cast("binary")) % 4).cast("string"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack(table(spark, sf_dir, "documents")).placed
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op6_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), domain_of(), 0.8, 2, WEIGHTS)


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_files.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op10_block_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = block_names.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


def op12_grid_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_order.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_toxicity, op3_simhash, op4_sharding, op5_urls, op6_suffix_repeats, op7_mixing, op8_line_quality,
        op9_vector_search, op10_block_names, op11_hard_negatives, op12_grid_order, op13_collocations, pipeline,
    )
}

ORACLE: dict[str, str] = {
    "op9_vector_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op10_block_names": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS n
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY n) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha256(n) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY n ORDER BY length(text) DESC, doc_id)""",
    "op11_hard_negatives": """
        WITH v AS MATERIALIZED (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS MATERIALIZED (
            SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
               (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
        QUALIFY rank <= 10""",
    "op12_grid_order": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), l AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.98
        ), r(a, b) AS (
            SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
        ), c AS (SELECT a, min(b) AS least FROM r GROUP BY a), n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(c.least, vec_id)) AS component_id,
               vec_id <= coalesce(c.least, vec_id) AS kept
        FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id""",
    "op13_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, ws FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p) WHERE len(ws) > 0
        ), f AS MATERIALIZED (
            SELECT lang, k, phrase, count(*) AS f FROM (
                SELECT lang, k, unnest(list_transform(generate_series(1, len(ws) - k + 1), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS phrase
                FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k
            ) GROUP BY ALL HAVING k = 1 OR count(*) >= 100
        ), n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
        ), c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1
        ), cuts AS (
            SELECT lang, k, phrase, a, cut, array_to_string(ws[1 : cut], ' ') AS first, array_to_string(ws[cut + 1 : k], ' ') AS rest
            FROM (SELECT *, unnest(generate_series(1, k - 1)) AS cut FROM c)
        ), scored AS (
            SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, n,
                   ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.first
            JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.rest JOIN n ON n.lang = cuts.lang
        ), best AS (
            SELECT lang, phrase, a, l, r, n, score FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), covered AS (
            SELECT DISTINCT s.lang, s.phrase FROM c s JOIN c t
            ON s.lang = t.lang AND t.k > s.k AND 100 * t.a >= 100 * s.a AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' ')
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
        FROM best ANTI JOIN covered USING (lang, phrase) QUALIFY rank <= 2000""",
}
