"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    byte_bpe, centroids, filter_audit, fingerprints, language, licenses, mixing, packing, quality,
    setsketch, suffix_dedup, token_counts, topk,
)
from tablewright.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"), window=200)
    lengths = F.transform("spans", lambda s: (s["end"] - s["begin"]).cast("long"))
    return suffix_dedup.removed(found).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.train(documents)
    found = language.identify(documents, model)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred",
                        "score", "n_words", F.size("spans").alias("n_spans"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        byte_bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(
        table(spark, sf_dir, "documents"), setsketch.Similar(words=2, percent=80)
    ).select("doc_id", "n_shingles", "component_id", "kept")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.classify(documents, quality.train(documents))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        end_id=2, capacity=1024,
        ranks_file=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform("base", lambda p: p["first"].cast("long"))
    names = F.array_sort(F.array_distinct(F.transform("base", lambda p: p["label"])))
    return found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(names, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
        F.size("places").cast("long").alias("n_places"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprints.as_text(F.col("samples")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_samples")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("samples"), F.col("edited_samples")).alias("near_edited"),
        fingerprints.likeness(F.col("samples"), F.col("next_samples")).alias("near_next"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents")).by_document()
    return found.select(
        F.col("key").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("key").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        centroids.centroid_digest(F.col("centroid")).alias("centroid_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_TOP_K = """
WITH rows AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_MIXING = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source, md5(coalesce(text, '')) AS mark,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM d GROUP BY source
), w AS (
  SELECT *, number % 3 + 1 AS weight, 3 * source_size AS most,
    CAST(3 * source_size AS DOUBLE) / (number % 3 + 1) AS stops FROM s
), p AS (
  SELECT *, CAST((SELECT sum(source_size) FROM s)
      - coalesce(sum(most) OVER before, 0) AS DOUBLE)
    / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER before, 0)) AS level
  FROM w WINDOW before AS (ORDER BY stops, number
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, number,
    CASE WHEN level * weight >= most THEN CAST(most AS DOUBLE)
      ELSE (SELECT max(level) FROM p WHERE level * weight < most) * weight END AS target FROM p
), q AS (
  SELECT d.*, number, target, CAST(ceil(target) AS BIGINT) AS ends, pass,
    md5(concat_ws(':', pass, doc_id, mark)) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source,
    unnest(generate_series(1, CAST(ceil(target / source_size) AS BIGINT))) AS passes(pass)
  WHERE size > 0 AND target > 0
), b AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY number ORDER BY pass, place, row
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begin_word FROM q
), f AS (
  SELECT *, least(size, ends - begin_word) AS words,
    (begin_word + least(size, ends - begin_word)) / target AS finish
  FROM b WHERE begin_word < ends
), m AS (
  SELECT row, words, CAST(coalesce(sum(words) OVER (ORDER BY finish, number, pass, place, row
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS position FROM f
), k AS (
  SELECT row, sum(least(words, (SELECT sum(source_size) FROM s) - position)) AS taken FROM m
  WHERE position < (SELECT sum(source_size) FROM s) GROUP BY row
)
SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
  CAST(coalesce(k.taken, 0) AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN k USING (row)
"""


def _centroid_rounds(rounds: int) -> str:
    parts = ["""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
    [CAST(floor(greatest(least(256 * CAST(x AS DOUBLE), 134217728), -134217728)) AS DOUBLE)
     FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
)""", """c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY digest NULLS LAST, v) - 1 AS cluster, v FROM (
    SELECT v, sha256('2:' || vec_id) AS digest FROM kept ORDER BY digest NULLS LAST, v LIMIT 40)
)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT kept.row, min(struct_pack(distance := CAST(list_inner_product(kept.v, kept.v)
    - 2 * list_inner_product(kept.v, c.v) + list_inner_product(c.v, c.v) AS BIGINT),
    cluster := c.cluster)) AS best
  FROM kept, c{i} c GROUP BY kept.row
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(moved.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT cluster, list(floor(total / n) ORDER BY place) AS v FROM (
      SELECT cluster, place, sum(x) AS total, count(*) AS n FROM (
        SELECT best.cluster AS cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place
        FROM kept JOIN a{i} USING (row))
      GROUP BY cluster, place)
    GROUP BY cluster) moved USING (cluster)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, CAST(best.cluster AS INTEGER) AS cluster, best.distance AS distance,
  CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.distance) OVER () AS BIGINT) AS inertia,
  sha256(list_aggregate([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN c.v], 'string_agg', ','))
    AS centroid_sha256
FROM kept JOIN a{rounds} a USING (row) JOIN c{rounds} c ON a.best.cluster = c.cluster
"""


_FILTER_AUDIT = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY text) AS first_id FROM d
), l AS (
  SELECT doc_id, max(CAST(coalesce(quality = 1, FALSE) AS INT)) AS good,
    max(CAST(coalesce(toxic = 1, FALSE) AS INT)) AS toxic
  FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(words) < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text)
       THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > first_id THEN 16 ELSE 0 END) AS mask
  FROM w LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s AS (
  SELECT filter_order, step, bit,
    (SELECT coalesce(sum(g.bit), 0) FROM f g
     WHERE strpos(filter_order, g.letter) < step) AS earlier
  FROM o, unnest([1, 2, 3, 4, 5]) AS steps(step), f
  WHERE substr(filter_order, step, 1) = letter
), r AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & earlier > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, (SELECT filter_order, step, bit, CAST(earlier AS INTEGER) AS earlier FROM s)
  GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""

QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language": op2_language,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_token_counts": op4_token_counts,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quality": op6_quality,
    "op7_topk": op7_topk,
    "op8_packing": op8_packing,
    "op9_licenses": op9_licenses,
    "op10_fingerprints": op10_fingerprints,
    "op11_mixing": op11_mixing,
    "op12_centroids": op12_centroids,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op7_topk": _TOP_K,
    "op11_mixing": _MIXING,
    "op12_centroids": _centroid_rounds(5),
    "op13_filter_audit": _FILTER_AUDIT,
}
