"""A key holding a third of all rows: results stay exact, aggregation is partial
before the shuffle, and the session has AQE skew handling on."""

import contextlib
import io

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hrlens.operators.stats import anova
from hrlens.operators.vectors import box_area, elementwise_mean, largest_per_group


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(9)
    n = 30000
    key = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 500, n))
    pdf = pd.DataFrame({"k": key.astype("int64"), "line": np.arange(n, dtype="int64"),
                        "x1": rng.random(n), "x2": rng.random(n) + 1, "y1": rng.random(n), "y2": rng.random(n) + 1,
                        "v": rng.normal(size=n)})
    return pdf, spark.createDataFrame(pdf).repartition(8)


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_largest_box_hot_key(skewed):
    pdf, df = skewed
    out = largest_per_group(df, "k", box_area(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")), ["line"], ["line"])
    assert "partial_max_by" in _plan(out)
    got = {r["k"]: r["line"] for r in out.collect()}
    a = (pdf.x2 - pdf.x1) * (pdf.y2 - pdf.y1)
    want = pdf.assign(a=a).sort_values(["k", "a", "line"], ascending=[True, False, True]).groupby("k").first()["line"]
    assert got == want.to_dict()


def test_group_moments_hot_key(skewed):
    pdf, df = skewed
    g = anova.group_moments(df, "k", "v")
    assert "partial_avg" in _plan(g) or "partial_count" in _plan(g)
    got = {r["grp"]: (r["n"], r["mean"]) for r in g.collect()}
    want = pdf.groupby("k")["v"].agg(["count", "mean"])
    assert got[0][0] == want.loc[0, "count"]
    assert all(got[k][1] == pytest.approx(want.loc[k, "mean"], rel=1e-12) for k in want.index)


def test_elementwise_mean_hot_key(spark, skewed):
    pdf, _ = skewed
    vec = spark.createDataFrame(pdf[["k"]].assign(vec=[[a, b] for a, b in zip(pdf.x1, pdf.y1)]))
    m = {r["k"]: r["mean_vec"] for r in elementwise_mean(vec, "k", "vec").collect()}
    assert m[0] == pytest.approx([pdf[pdf.k == 0].x1.mean(), pdf[pdf.k == 0].y1.mean()], rel=1e-12)


def test_session_handles_skewed_joins(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
