"""Exact-size split: distributed selection of the k-th hash."""
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from hrlens.operators.ml import split
from hrlens.operators.ml.split import exact_split, kth_smallest


@pytest.mark.parametrize("n", [1, 4, 5, 6, 997])
def test_exactly_the_rows_of_smallest_hash(spark, n):
    got = exact_split(spark.range(n).withColumnRenamed("id", "k").repartition(7), "k")
    again = exact_split(spark.range(n).withColumnRenamed("id", "k").coalesce(1), "k")
    order = sorted(range(n), key=lambda i: int(hashlib.md5(f"{i}:42".encode()).hexdigest()[:15], 16))
    want = set(order[:math.ceil(n / 5)])
    for out in (got, again):
        assert {r["k"] for r in out.collect() if r["split"] == "test"} == want


def test_repeated_keys_still_give_the_exact_size(spark):
    df = spark.range(600).select(F.when(F.col("id") < 400, 7).when(F.col("id") < 500, F.col("id")).alias("k"), F.lit("x").alias("split_hash"))
    for share in (0.1, 0.2, 0.5, 0.77):
        rows = exact_split(df, "k", share).collect()
        assert len(rows) == 600 and sum(r["split"] == "test" for r in rows) == math.ceil(round(600 * share, 6))
        assert rows[0]["split_hash"] == "x"


def test_selection_by_digits(spark):
    values = [(i * 7919) % 1009 << 40 for i in range(300)] + [5] * 40 + [(1 << 60) - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    for k in (1, 40, 41, 200, 341):
        v, below, equal = kth_smallest(df, "v", k)
        assert v == sorted(values)[k - 1] and below == sum(x < v for x in values) and equal == values.count(v)
    with pytest.raises(ValueError):
        kth_smallest(df, "v", 342)


def test_edges(spark):
    assert [split.test_rows(n, 0.2) for n in (0, 1, 5, 10, 11, 15)] == [0, 1, 1, 2, 3, 3]
    assert split.test_rows(10, 0.3) == 3
    none = spark.range(0).withColumnRenamed("id", "k")
    assert exact_split(none, "k").collect() == [] and exact_split(none, "k").columns == ["k", "split"]
