"""Every operator and pipeline stage on edge rows, and on an empty table."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hrlens.llm import dac, decontaminate, fingerprints, lm, mixing, neardup, pii, secrets, sharding, toxicity

tokenizers = pytest.importorskip("public_tokenizers")


def items(spark):
    return spark.createDataFrame([(0, "quick brown fox jumps over the lazy dog"), (0, "quick brown fox jumps over the lazy dog"),
                                  (1, None), (2, ""), (None, "x"), (3, "x")], "item_id long, text string")


def tokens(docs, path):
    dac.write_token_files(docs, tokenizers.path("byte_bpe_50k.json"), str(path))
    return dac.read_tokens(docs.sparkSession, str(path))


def operators(labels, path):
    return {
        "toxicity": lambda d: toxicity.score_documents(d, toxicity.fit_toxicity(d, labels)),
        "mixing": lambda d: mixing.mixing_rates(d, labels)[0],
        "sharding": sharding.assign_shards,
        "fingerprints": fingerprints.fingerprint_documents,
        "lm": lm.score_documents,
        "neardup": neardup.near_duplicates,
        "pii": pii.replace_personal_data,
        "secrets": secrets.scan_secrets,
        "dac": lambda d: tokens(d, path),
    }


@pytest.mark.parametrize("name", list(operators(None, None)))
def test_edge_rows_and_empty_table(name, edge, empty, labels, no_labels, tmp_path):
    rows = operators(labels, tmp_path / "a")[name](edge).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in edge.collect())
    for k, la in enumerate((labels, no_labels)):
        assert operators(la, tmp_path / f"b{k}")[name](empty).collect() == []


def test_no_labels(edge, no_labels):
    assert toxicity.score_documents(edge, toxicity.fit_toxicity(edge, no_labels)).where("score between 0 and 1").count() == 11
    assert mixing.mixing_rates(edge, no_labels)[0].count() == 11


def test_decontaminate_edges(spark, edge, empty):
    found = decontaminate.contaminated(edge, items(spark)).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, found)) == [(1, 0), (5, 0), (5, 0), (8, 3)]
    assert decontaminate.contaminated(empty, items(spark)).count() == 0
    assert decontaminate.contaminated(edge, items(spark).limit(0)).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, edge, empty, labels, tmp_path, name, stage):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (edge, empty):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns[:len(docs.columns)] == docs.columns
        rows = out.collect()
        clash = set(docs.columns) - {"shard"} if name == "sharding" else set(docs.columns)
        assert {tuple(r[c] for c in sorted(clash)) for r in rows} <= {tuple(r[c] for c in sorted(clash)) for r in docs.collect()}
        kept = {(r.doc_id, r.text) for r in rows}
        assert kept <= {(r.doc_id, r.text) for r in docs.collect()}
        if name in ("mixing", "sharding"):
            assert len(kept) == docs.select("doc_id", "text").distinct().count()


def test_stages_judge_rows_not_ids(spark):
    bad, clean = "see the quick brown fox jumps over the lazy dog", [f"c{i} nothing of a{i} benchmark b{i} in here {i}" for i in range(4)]
    rows = [(None, bad), (None, clean[0]), (None, clean[1]), (5, bad), (5, clean[2]), (5, clean[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = decontaminate.drop_contaminated(docs, items(spark)).collect()
    assert sorted(map(str, map(tuple, left))) == sorted(str(r) for r in rows if r[1] != bad)


def test_one_row_of_a_group_stays(spark):
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"u{i}" for i in range(60))
    rows = [(None, base), (None, base), (None, base + " x"), (5, other), (5, other), (5, other + " y"), (5, "alone here"), (None, ""), (None, "")]
    left = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(str(r.doc_id) for r in left) == ["5", "5", "None", "None", "None"]
    assert sorted(r.text[:1] for r in left) == ["", "", "a", "u", "w"]


def test_rows_without_ids_stay_linear(spark):
    """Rows that share an id, or have none, meet only the sets of their own texts."""
    rows = [(None if i % 2 else 7, f"text number {i} has its own words w{i} v{i} u{i}") for i in range(400)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = docs.select(F.monotonically_increasing_id().alias("node"), F.col("doc_id").alias("low"), F.xxhash64("text").alias("text_hash"),
                         F.lit(b"").alias("set_id"))
    joined = neardup.sets_of(docs, wanted, 5)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "own_hash" in plan and "text_hash" in plan
    out = neardup.near_duplicates(docs).collect()
    assert len(out) == 800 and sum(r.kept for r in out) == 400


def test_copies_are_drawn_by_row(spark):
    """Rows of one id get whole copies that add up to their rates, as rows of different ids do."""
    n, rate = 4000, 1.37
    for key in (F.lit(5).cast("long"), F.lit(None).cast("long"), F.col("id")):
        df = spark.range(n).select(key.alias("doc_id"), F.lit(rate).alias("rate"), F.col("id").alias("row"))
        total = df.select(F.sum(mixing.copies(F.col("rate"), F.col("row"), F.col("doc_id"))).alias("s")).first()["s"]
        assert abs(total - n * rate) < 4 * (n * 0.37 * 0.63) ** 0.5
