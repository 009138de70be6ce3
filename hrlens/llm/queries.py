"""The registered queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dac, decontaminate, fingerprints, hardneg, licenses, lm, mixing, neardup, pii, secrets, sharding, toxicity, variants
from .common import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = mixing.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (sharding.assign_shards(table(spark, sf_dir, "documents"))
            .withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (lm.score_documents(table(spark, sf_dir, "documents"))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), n_words=2)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_personal_data(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def of(kind):
        return F.filter("findings", lambda f: f["kind"] == kind)

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])))
    base = F.filter("findings", lambda f: f["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def op10_dac(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    scratch = Scratch(spark, "token-files")
    # Parquet's vectored reads go through direct buffers of a whole column chunk that every I/O thread keeps
    docs = spark.read.option("parquet.hadoop.vectored.io.enabled", "false").parquet(f"{sf_dir}/documents.parquet")
    dac.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), f"{scratch.path}/ids")
    return dac.read_tokens(spark, f"{scratch.path}/ids")


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))

    def labels(*columns):
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.col(c)["label"] for c in columns]))), ",")
    best = F.coalesce(F.array_max(F.col("found")["containment"]), F.lit(0.0))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(F.col("places")["word"]).alias("first_word"),
                        F.array_max(F.col("places")["word"]).alias("last_word"), labels("places").alias("base_labels"), labels("places", "found").alias("labels"),
                        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    quantised = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("id"), relabelled.alias("label"), F.when(usable, quantised).alias("vector"))
    return hardneg.mine_hard_negatives(rows, F.col("id") % 100 == 0)


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_mixing, op3_sharding, op4_fingerprints, op5_language_model, op6_decontamination, op7_minhash, op8_pii, op9_secrets, op10_dac, op11_licenses,
                                   op12_hard_negatives, op13_variants)}


#: Every anchor's scores with all rows, ranked.
HARD_NEGATIVES = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS nr,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.nr AS anchor, a.vec_id AS anchor_id, b.vec_id, b.nr, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.nr <> b.nr
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, nr) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.nr ORDER BY n.score DESC, n.vec_id, n.nr) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.anchor = n.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.nr ORDER BY n.score DESC, n.vec_id, n.nr) <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_hard_negatives": HARD_NEGATIVES}
