"""The registered queries of the training-data operators and, where SQL can say it, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprints, idstore, langid, licences, linededup, negatives, neighbours, packing, pii, repetitions, secrets, simhash
from .common import shared_dir, table


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = f"{shared_dir(spark)}/ids"
    idstore.write_ids(table(spark, sf_dir, "documents"), place)
    got = idstore.read_ids(spark, place)
    return got.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(table(spark, sf_dir, "documents")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~langid.held_out()))
    got = langid.predict(docs, model)
    return got.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "item_id", "coverage", "covered", "longest", F.size("tiles").alias("n_tiles"))


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetitions.digest(repetitions.periodic_runs(repetitions.with_planted_runs(table(spark, sf_dir, "documents"))))


def op12_quartile_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(fingerprints.edited_by_next(table(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", shifted.alias("label")))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_licence_scan": op2_licence_scan,
    "op3_simhash_groups": op3_simhash_groups,
    "op4_benchmark_leaks": op4_benchmark_leaks,
    "op5_line_dedup": op5_line_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_token_id_files": op7_token_id_files,
    "op8_nearest_vectors": op8_nearest_vectors,
    "op9_secret_scan": op9_secret_scan,
    "op10_personal_data": op10_personal_data,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_quartile_digests": op12_quartile_digests,
    "op13_hard_negatives": op13_hard_negatives,
}

#: The line key in DuckDB: ends stripped, A-Z alone lower-cased.
_KEY = "translate(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op5_line_dedup": f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
each AS (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM cut),
keyed AS (SELECT doc_id, i, l, {_KEY} AS k FROM each),
common AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT doc_id, i, l, last IS NOT NULL AND doc_id <> last AS gone FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op13_hard_negatives": """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
negative AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS nth
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, nth::INTEGER AS rank, negative_id, positive_score, negative_score FROM negative WHERE nth <= 3""",
}
