"""The operators' queries: each over its whole table with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import PATTERN, bpe_encode
from .bpe_tree import tree_encode
from .centroids import cluster_vectors
from .common import Scratch, met, rows_of
from .embedding_pq import near_vectors
from .filter_audit import audit_filters
from .line_dedup import line_dedup
from .media import media_features
from .mixing import taken_words
from .simhash import simhash_components
from .suffix_dedup import remove_repeats
from .token_rollup import TokenRollup, count_changes, token_counter
from .toxicity import TOXIC, fit_toxicity, held_out, toxicity_scores
from .warc import archive_round_trip


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file: from the folder named by SIEVELOG_TOKENIZERS, else from the installed package."""
    folder = os.environ.get("SIEVELOG_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(rows_of(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents: counts of every document, deletes of exact copies (all but the smallest doc_id),
    and revised counts of documents that change when runs of blanks become one; the second is sent twice."""
    docs = rows_of(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    rollup = TokenRollup(spark, Scratch(spark, "rollup").base)
    count = token_counter(spark, tokenizer_file("byte_bpe_50k.tiktoken"), PATTERN)
    rollup.apply("counts", count_changes(docs, count, "byte_bpe_50k"))
    hashed = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    first = Scratch(spark, "copies").save(hashed.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1"), "first")
    copies = met(hashed, first, "h", docs.count()).filter("doc_id > first").select(F.lit("delete").alias("op"), "doc_id", F.lit("byte_bpe_50k").alias("version"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("long").alias("n_tokens"))
    rollup.apply("copies", copies)
    squeezed = docs.withColumn("new", F.regexp_replace("text", "[ \t]+", " ")).filter("new <> text").withColumn("text", F.col("new")).drop("new")
    left = squeezed.join(rollup.state().select("doc_id"), "doc_id", "left_semi")
    rollup.apply("squeezed", count_changes(left, count, "byte_bpe_50k"))
    rollup.apply("copies", copies)
    return rollup.totals()


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(rows_of(spark, sf_dir, "embeddings"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(rows_of(spark, sf_dir, "documents"), radius=2, ngram=3).select("doc_id", "fingerprint", "component_id", "kept")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(rows_of(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows_of(spark, sf_dir, "documents")
    model = fit_toxicity(docs, rows_of(spark, sf_dir, "labels"))
    scored = toxicity_scores(docs, model, ("doc_id",))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(rows_of(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(rows_of(spark, sf_dir, "documents"), length=100, with_text=False)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(rows_of(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), with_ids=False)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(rows_of(spark, sf_dir, "pages"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(rows_of(spark, sf_dir, "embeddings"), dims=64, k=16, rounds=3, scale=64, seed="1")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(rows_of(spark, sf_dir, "documents"), rows_of(spark, sf_dir, "labels"))


def op13_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_encode(rows_of(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"), with_ids=False)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_token_rollup, op3_embedding_near_dedup, op4_simhash_near_dedup, op5_source_mix, op6_toxicity, op7_media, op8_suffix_dedup, op9_bpe, op10_warc, op11_centroids, op12_filter_audit, op13_bpe_tree, pipeline)}



def _centroid_sql(dims: int = 64, k: int = 16, rounds: int = 3) -> str:
    """Every distance to every centroid, round by round."""
    steps = [
        f"v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({dims} * x::DOUBLE)::BIGINT) AS g FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h, g) - 1 AS cluster, g AS c FROM (SELECT sha256('1:' || vec_id) AS h, g FROM v ORDER BY h, g LIMIT {k}))",
    ]
    for r in range(rounds + 1):
        apart = "list_sum(list_transform(list_zip(g, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, g, n, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (SELECT vec_id, g, n, cluster, {apart} AS d FROM (SELECT *, row_number() OVER () AS n FROM v) CROSS JOIN c{r}) GROUP BY 1, 2, 3)")
        if r < rounds:
            mean = "(s - ((s % n + n) % n)) // n"
            steps.append(
                f"c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (SELECT cluster, list({mean} ORDER BY i) AS c FROM (SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(g) AS x, generate_subscripts(g, 1) AS i FROM a{r}) GROUP BY 1, 2) GROUP BY 1) m USING (cluster))"
            )
    last = f"a{rounds}"
    return f"""WITH {", ".join(steps)}
SELECT vec_id, cluster::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM {last} JOIN c{rounds} USING (cluster)"""


#: Archives and audits need nothing but grouping, and few centroids a comparison of each, so DuckDB can say them.
ORACLES = {
    "op11_centroids": _centroid_sql(),
    "op12_filter_audit": r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
     b AS (SELECT doc_id, part, concat(CASE WHEN len(words) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
             CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' END, CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
             CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS failed FROM w),
     l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
     c AS (SELECT part, failed, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM b LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
     x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
     o AS (SELECT v.f || w.f || y.f || z.f || u.f AS filter_order FROM x v JOIN x w ON w.f <> v.f JOIN x y ON y.f NOT IN (v.f, w.f) JOIN x z ON z.f NOT IN (v.f, w.f, y.f) JOIN x u ON u.f NOT IN (v.f, w.f, y.f, z.f)),
     s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
     e AS (SELECT c.*, filter_order, step, filter_order[step] AS f, coalesce(list_min(list_transform(string_split(nullif(failed, ''), ''), lambda y: strpos(filter_order, y))), 9) AS gone FROM c CROSS JOIN s),
     r AS (SELECT part, filter_order, step, f, sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed, sum(CASE WHEN gone < step AND contains(failed, f) THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost FROM e GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r""",
    "op10_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
     d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
     f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f""",
}
