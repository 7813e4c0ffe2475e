"""The registered queries of this subpackage and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthclose.llm import (
    byte_bpe,
    clustering,
    exact_dedup,
    hard_negatives,
    language,
    license_scan,
    line_quality,
    mixing,
    packing,
    secret_scan,
    simhash,
    token_counts,
    topk,
)
from monthclose.llm.common import ship_package, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rule"] < len(secret_scan.BASE_RULES))
    counts = {
        f"n_{rule.kind}": F.expr(f"cast(size(filter(spans, s -> s.rule = {number})) AS long)")
        for number, rule in enumerate(secret_scan.BASE_RULES)
    }
    return found.select(
        "doc_id",
        *[c.alias(name) for name, c in counts.items()],
        F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    joined = {name: F.array_join(name, ",").alias(name) for name in ("base_labels", "labels")}
    return found.select(*[joined.get(c, F.col(c)) for c in found.columns])


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.digests(table(spark, sf_dir, "documents"))
    found = exact_dedup.exact_dedup(rows, exact_dedup.own_history(rows))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    vectors = hard_negatives.usable(table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clustering.cluster(clustering.usable(table(spark, sf_dir, "embeddings")))
    listed = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.withColumn("centroid_sha256", F.sha2(listed.cast("binary"), 256)).drop("centroid")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _secrets_sql(rules: tuple[secret_scan.Rule, ...], base: int) -> str:
    """Every rule's matches with their places, from the lengths of matches and of what lies between them."""
    kinds = []
    for number, rule in enumerate(rules):
        regex = "'" + rule.regex.replace("'", "''") + "'"
        kinds.append(
            f"""
  SELECT rid, {number} AS rule, '{rule.kind}' AS kind, unnest(regexp_extract_all(text, {regex})) AS m,
         unnest(regexp_extract_all(text, {regex}, {rule.group})) AS held, {rule.least} AS least,
         unnest(string_split_regex(text, {regex})[:-2]) AS gap,
         generate_subscripts(regexp_extract_all(text, {regex}), 1) AS i
  FROM t WHERE regexp_matches(text, {regex})"""
        )
    counts = ",\n       ".join(
        f"count(rule) FILTER (rule = {n}) AS n_{rule.kind}" for n, rule in enumerate(rules[:base])
    )
    return f"""
WITH t AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), found AS ({" UNION ALL ".join(kinds)}
), placed AS (
  SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY rid, rule ORDER BY i) AS finish FROM found
), spans AS (
  SELECT rid, rule, CAST(finish AS BIGINT) - length(m) AS start,
         kind || ':' || (CAST(finish AS BIGINT) - length(m)) || ':' || CAST(finish AS BIGINT) AS span
  FROM placed WHERE length(held) >= least
)
SELECT doc_id, {counts},
       sha256(coalesce(string_agg(span, ',' ORDER BY start, rule) FILTER (rule < {base}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, rule), '') AS spans
FROM t LEFT JOIN spans USING (rid)
GROUP BY rid, doc_id
"""


SECRETS_SQL = _secrets_sql(secret_scan.RULES, len(secret_scan.BASE_RULES))

EXACT_DEDUP_SQL = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
"""

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s
QUALIFY rank <= 10
"""

HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
            AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def _centroids_sql(k: int, rounds: int) -> str:
    """Each round is a step of its own; vectors and centroids are one row per component."""
    steps = [
        """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE len(embedding) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, v AS c
  FROM v QUALIFY cluster < """
        + str(k)
        + "\n)"
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, cluster, CAST(d AS BIGINT) AS distance FROM (
    SELECT vec_id, v, cluster, list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c) AS d
    FROM v, c{r})
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1
)"""
        )
        if r < rounds:
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(n.c, c.c) AS c
  FROM c{r} c LEFT JOIN (
    SELECT cluster, list(m ORDER BY i) AS c FROM (
      SELECT cluster, i, floor(sum(x) / count(*)) AS m
      FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY cluster, i)
    GROUP BY cluster) n USING (cluster)
)"""
            )
    return (
        ",\n".join(steps)
        + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""
    )


CENTROIDS_SQL = _centroids_sql(clustering.CENTROIDS, clustering.ROUNDS)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_line_quality": op2_line_quality,
    "op3_simhash": op3_simhash,
    "op4_token_counts": op4_token_counts,
    "op5_language": op5_language,
    "op6_source_mix": op6_source_mix,
    "op7_packing": op7_packing,
    "op8_top_k": op8_top_k,
    "op9_license_scan": op9_license_scan,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_centroids": op12_centroids,
    "op13_byte_bpe": op13_byte_bpe,
}

SQL: dict[str, str] = {
    "op1_secret_scan": SECRETS_SQL,
    "op8_top_k": TOP_K_SQL,
    "op10_exact_dedup": EXACT_DEDUP_SQL,
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
    "op12_centroids": CENTROIDS_SQL,
}


def _shipped(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    return run


QUERIES = {name: _shipped(build) for name, build in _QUERIES.items()}
