"""Tree models grown by this library: boosted pay models, forests of unbounded depth."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import round_sig
from ..operators.ml import boost, forest
from ..operators.ml.models import regression_metrics
from ..operators.ml.split import is_test
from ..operators.persist import materialize
from ..sources.tables import establishments, read_table
from .memo import memo
from .stats import large_active_df

FEATURES = ["headcount", "year", "joiners", "leavers", "region_code"]
#: Rounds of the comparison key, as many as the analyses' libraries grow by default.
COMPARED_ROUNDS = 100


def boosting_design(spark: SparkSession, sf_dir: str) -> DataFrame:
    """est_id, annual_pay and FEATURES of every active establishment with a pay estimate, written once."""
    def build():
        d = large_active_df(establishments(spark, sf_dir), 1)
        return materialize(d.select("est_id", "annual_pay", *FEATURES).where(F.col("annual_pay").isNotNull()), repartition=False)
    return memo(spark, sf_dir, "boosting_design", build)


def _first_tree(spark, sf_dir, params: boost.Params) -> DataFrame:
    model = boost.fit(boosting_design(spark, sf_dir), FEATURES, "annual_pay", replace(params, rounds=1))
    t = boost.tree_table(spark, model)
    return t.select("node", "step", "feature", "cut", round_sig("gain").alias("gain"), "n", round_sig("value").alias("value"))


def pay_leafwise_tree(spark, sf_dir):
    """The first leaf-wise tree, 31 leaves and 20 rows a leaf: splits in the order they were made, and leaves."""
    return _first_tree(spark, sf_dir, boost.LEAF_WISE)


def pay_newton_tree(spark, sf_dir):
    """The first depth-wise tree, depth 6, with a penalty of 1 on squared leaf values."""
    return _first_tree(spark, sf_dir, boost.DEPTH_WISE).drop("step")


def pay_gradient_histogram(spark, sf_dir):
    """Rows and gradient sum of each (feature, bin) at the start, with the bin's upper cut."""
    d = boosting_design(spark, sf_dir)
    cuts = boost.cut_points(d, FEATURES, boost.LEAF_WISE.bins)
    base = d.agg(F.avg("annual_pay")).first()[0] or 0.0
    rows = boost.binned(d, FEATURES, cuts, "annual_pay").withColumn("score", F.lit(base))
    hist = boost.histograms(rows, [boost.Node(0, 0, 0.0)], [0], (len(FEATURES), max((len(c) for c in cuts), default=0) + 2), "squared")[0]
    out = [(f, b, float(cuts[j][b - 1]) if 0 < b <= len(cuts[j]) else None, int(hist[j, b, 2]), float(hist[j, b, 0]))
           for j, f in enumerate(FEATURES) for b in range(hist.shape[1]) if hist[j, b, 2]]
    df = spark.createDataFrame(out, "feature string, bin int, cut double, n long, gradient double")
    return df.select("feature", "bin", "cut", "n", F.round("gradient", 2).alias("gradient"))


def pay_boosted(spark, sf_dir):
    """Hold-out R² and RMSE (10k won) of both boosted models, and their features' shares of the gain."""
    d = boosting_design(spark, sf_dir).withColumn("is_test", is_test("est_id"))
    train, test = d.where(~F.col("is_test")), d.where("is_test")
    models = {"leaf-wise": boost.LEAF_WISE, "depth-wise, L2": boost.DEPTH_WISE}
    with ThreadPoolExecutor(max_workers=len(models)) as together:
        fitted = dict(zip(models, together.map(lambda p: boost.fit(train, FEATURES, "annual_pay", replace(p, rounds=COMPARED_ROUNDS)), models.values()), strict=True))
    rows = []
    for name, model in fitted.items():
        m = regression_metrics(boost.predict(model, test), "annual_pay")
        rows += [(name, COMPARED_ROUNDS, m["r2"], m["rmse"] / 10000, f, float(s)) for f, s in zip(FEATURES, model.importance(), strict=True)]
    return spark.createDataFrame(rows, "model string, rounds int, r2 double, rmse_10k double, feature string, gain_share double")


#: Trees of the pay forest's key; the analysis grows 100.
PAY_TREES = 10


def pay_forest(spark, sf_dir):
    """Hold-out R² and RMSE (10k won) of a forest grown to pure leaves, and its importances."""
    d = boosting_design(spark, sf_dir).withColumn("is_test", is_test("est_id"))
    model = forest.fit(d.where(~F.col("is_test")), FEATURES, "annual_pay", trees=PAY_TREES)
    test = d.where("is_test").select("est_id", "annual_pay", *FEATURES)
    scored = forest.predict(model, test, "est_id").join(test.select("est_id", "annual_pay"), "est_id")
    m = regression_metrics(scored, "annual_pay")
    rows = [(PAY_TREES, m["r2"], m["rmse"] / 10000, f, s) for f, s in zip(FEATURES, model.importances(), strict=True)]
    return spark.createDataFrame(rows, "trees int, r2 double, rmse_10k double, feature string, importance double")


def activity_forest(spark, sf_dir):
    """100 trees to pure leaves on the training rows; every row of the table is classified."""
    e = read_table(spark, sf_dir, "embeddings")
    dim = e.agg(F.max(F.size("embedding"))).first()[0] or 0
    names = [f"emb_{i}" for i in range(dim)]
    d = e.where("vec_id is not null").dropDuplicates(["vec_id"]).select(
        "vec_id", "label", *[F.coalesce(F.get("embedding", F.lit(i)).cast("double"), F.lit(0.0)).alias(n) for i, n in enumerate(names)])
    d = materialize(d, repartition=False)
    classes = sorted(r[0] for r in d.where("label is not null").select("label").distinct().collect())  # the label's values
    model = forest.fit(d.where(~is_test("vec_id")), names, "label", classes=classes)
    out = forest.predict(model, d, "vec_id", "predicted_label")
    return out.join(d.select("vec_id", "label", is_test("vec_id").alias("held_out")), "vec_id")
