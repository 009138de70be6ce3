"""Vector analyses: person centroids and matching, largest box, split check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import sig_sql
from ..operators.ml.split import exact_split, is_test, with_split
from ..operators.vectors import as_double_array, box_area, centroids, largest_per_group, nearest_centroid, normalize
from ..sources.tables import employees, read_table

# Fixed value: similarity threshold of the face matcher.
SIM_THRESHOLD = 0.35
UNKNOWN = "unknown"


def _embeddings(spark, sf_dir) -> DataFrame:
    """Embeddings with a person name; hash split: 20 % targets, 80 % reference set."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("label").cast("string").alias("person"), "embedding",
                    is_test("vec_id").alias("is_target"))


def _sig_vec(c: str):
    return F.expr(f"transform(`{c}`, x -> {sig_sql('x')})")


def _centroids(spark, sf_dir) -> DataFrame:
    e = _embeddings(spark, sf_dir)
    return centroids(e.where(~F.col("is_target")), "person", "embedding")


def person_centroids(spark, sf_dir):
    """Unit-norm mean of each person's unit-norm reference vectors."""
    return _centroids(spark, sf_dir).select("person", "n_refs", _sig_vec("centroid").alias("centroid"))


def _matched(targets: DataFrame, cent: DataFrame) -> DataFrame:
    m = nearest_centroid(targets, "vec_id", "embedding", cent, SIM_THRESHOLD, UNKNOWN)
    return m.select("vec_id", "match_name", "best_person",
                    F.expr(sig_sql("best_sim")).alias("best_sim"),
                    F.expr(sig_sql("similarity")).alias("similarity"), "is_match")


def person_match(spark, sf_dir):
    """Each target vector's best person by cosine, or 'unknown' below 0.35."""
    return _matched(_embeddings(spark, sf_dir).where(F.col("is_target")), _centroids(spark, sf_dir))


def person_match_all(spark, sf_dir):
    """Every vector of the table against the persons' centroids of the reference part: a whole second table is scored."""
    return _matched(_embeddings(spark, sf_dir), _centroids(spark, sf_dir))


def vector_match(spark, sf_dir):
    """V3 in a gallery as large as the table: every reference vector is a person of its own, every target finds its nearest."""
    e = _embeddings(spark, sf_dir).where(F.col("embedding").isNotNull())
    gallery = e.where(~F.col("is_target")).select(F.format_string("v%012d", "vec_id").alias("person"), normalize(as_double_array(F.col("embedding"))).alias("centroid"))
    return _matched(e.where(F.col("is_target")), gallery)


def largest_box(spark, sf_dir):
    """Largest face per image, over a numeric stand-in: per order, the
    line item with the largest box (x1=discount, y1=tax, x2=quantity,
    y2=extendedprice/1000); ties → first line (line number, part, supplier)."""
    li = read_table(spark, sf_dir, "lineitem")
    area = box_area(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity"), F.col("l_extendedprice") / 1000)
    b = largest_per_group(li, "l_orderkey", area, ["l_linenumber", "l_partkey", "l_suppkey"],
                          ["l_linenumber", "l_partkey", "l_suppkey"])
    return b.select(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("face_no"),
                    "l_partkey", "l_suppkey", F.expr(sig_sql("area")).alias("area"))


def split_check(spark, sf_dir):
    """L1: the 80/20 hash split of the attrition table (seed 42)."""
    return with_split(employees(spark, sf_dir).select("employee_id"), "employee_id")


def split_exact(spark, sf_dir):
    """L1: a split whose test side has exactly ceil(0.2 n) rows."""
    return exact_split(employees(spark, sf_dir).select("employee_id"), "employee_id")
