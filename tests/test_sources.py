"""Sources: cp949 registry CSV, payload parsing and status gate, streaming ingest, sinks."""

import os
import tempfile

from pyspark.sql import functions as F


from hrlens.plans.registry import pay_topk_large_df
from hrlens.sources import payloads as pl
from hrlens.sources.registry_csv import REGISTRY_HEADERS, read_registry_csv
from hrlens.streaming.ingest import pay_api_rows, payload_stream, start_ingest


def test_cp949_registry(spark):
    d = tempfile.mkdtemp(prefix="hrlens-csv-")
    hdr = list(REGISTRY_HEADERS)
    lines = [",".join(hdr),
             "가나다(주),1,2500,190000000,11,300100,2001-03-02,,10,3",
             "라마바,1,abc,1000,41,300100,bad-date,,1,1",
             "사아자,2,300,5000000,11,551001,1999-01-01,2025-03-04,0,2"]
    with open(os.path.join(d, "r.csv"), "w", encoding="cp949") as f:
        f.write("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.legacy.javaCharsets", "false")  # the reader must turn it on itself
    df = read_registry_csv(spark, d)
    rows = {r["est_name"]: r for r in df.collect()}
    assert set(rows) == {"가나다(주)", "라마바", "사아자"}
    assert rows["라마바"]["headcount"] is None and rows["라마바"]["start_date"] is None
    assert rows["사아자"]["end_date"].year == 2025 and rows["가나다(주)"]["industry_code"] == "300100"
    top = pay_topk_large_df(df, 2000, 10).collect()
    assert [r["est_name"] for r in top] == ["가나다(주)"]


def _resp(code, items, year=2024):
    body = "".join(f"<item><ENT_NAME>{n}</ENT_NAME><N_SUM>{v}</N_SUM></item>" for n, v in items)
    return (f"<response><header><resultCode>{code}</resultCode><resultMsg>m</resultMsg></header>"
            f"<body><ac_year>{year}</ac_year><items>{body}</items></body></response>")


def test_payload_gate_and_parse(spark):
    p = spark.createDataFrame([(2024, 1, _resp("00", [("A", "1,234.5"), ("B", "x"), ("", "5"), ("C", "")])),
                               (2024, 2, _resp("99", [("D", "10")]))], "pay_year int, page_no long, payload string")
    st = {r["page_no"]: r["accepted"] for r in pl.api_status(p).collect()}
    assert st == {1: True, 2: False}
    rows = [(r["org_name"], r["amount"]) for r in pl.parse_pay_payloads(p).collect()]
    assert rows == [("A", 1234)]


def test_streaming_ingest_once(spark):
    land = tempfile.mkdtemp(prefix="hrlens-land-")
    out = tempfile.mkdtemp(prefix="hrlens-out-")
    for i, items in enumerate([[("A", "100")], [("B", "200"), ("C", "300")]]):
        with open(os.path.join(land, f"r{i}.xml"), "w") as f:
            f.write(_resp("00", items))
    q = start_ingest(pay_api_rows(payload_stream(spark, land)), os.path.join(out, "t"), "pay_ingest_test",
                     checkpoint=os.path.join(out, "ck"), once=True)
    q.awaitTermination(120)
    got = sorted((r["org_name"], r["amount"], r["pay_year"]) for r in spark.read.parquet(os.path.join(out, "t")).collect())
    assert got == [("A", 100, 2024), ("B", 200, 2024), ("C", 300, 2024)]


def test_registry_table_prunes_status(spark):
    import contextlib
    import io
    from conftest import SF_SMALL
    from hrlens.plans.registry import PARAMS, pay_topk_large_df
    from hrlens.sources.tables import establishments, write_registry_table
    path = os.path.join(tempfile.mkdtemp(prefix="hrlens-regtab-"), "registry")
    reg = write_registry_table(spark, SF_SMALL, path, tasks=6)
    writers = {f.split("-")[1] for d in os.listdir(path) if d.startswith("status_code=") for f in os.listdir(f"{path}/{d}") if f.startswith("part-")}
    assert len(writers) == 6
    sizes = [r["n"] for r in reg.groupBy("status_code", F.input_file_name()).agg(F.count("*").alias("n")).where("status_code = 1").collect()]
    assert max(sizes) < 2 * min(sizes)
    df = pay_topk_large_df(reg, PARAMS["large_headcount"], PARAMS["top_k"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(status_code" in plan and "(status_code#" in plan
    assert "GreaterThanOrEqual(headcount,200)" in plan
    want = pay_topk_large_df(establishments(spark, SF_SMALL), PARAMS["large_headcount"], PARAMS["top_k"])
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))


def test_hr_csv_text_vs_date_exit(spark):
    """The attrition flag tests the raw text, the turnover parse drops bad dates."""
    from hrlens.operators.hr import attrition_rate, termination_flag, turnover_by_month
    from hrlens.sources.registry_csv import read_hr_csv
    d = tempfile.mkdtemp(prefix="hrlens-hr-")
    rows = ["Hire_Date,Termination_Date,Status,Department,Job_Role,Performance_Rating",
            "2020-01-05,2020-03-10,Voluntary,영업,A,3",
            "2020-02-01,N/A,Involuntary,영업,A,2",
            "2020-02-11,,Active,개발,B,4"]
    with open(os.path.join(d, "hr.csv"), "w", encoding="cp949") as f:
        f.write("\n".join(rows) + "\n")
    hr = read_hr_csv(spark, d)
    by_text = {r["department"]: r["turnover_rate_pct"]
               for r in attrition_rate(hr, ["department"], termination_flag("termination_text")).collect()}
    by_date = {r["department"]: r["turnover_rate_pct"]
               for r in attrition_rate(hr, ["department"], termination_flag("termination_date")).collect()}
    assert by_text == {"영업": 100.0, "개발": 0.0} and by_date == {"영업": 50.0, "개발": 0.0}
    months = [(r["month"], r["active"], r["terminated"]) for r in turnover_by_month(hr, last_n=None).collect()]
    assert months == [("2020-01", 1, 0), ("2020-02", 3, 0), ("2020-03", 3, 1)]


def test_rss_streaming_ingest(spark):
    from hrlens.streaming.ingest import rss_rows
    land = tempfile.mkdtemp(prefix="hrlens-rss-")
    out = tempfile.mkdtemp(prefix="hrlens-rssout-")
    with open(os.path.join(land, "feed.xml"), "w") as f:
        f.write('<rss version="2.0"><channel><title>t</title>'
                '<item><title>A &amp; B</title><link>http://x/1</link><pubDate>Mon, 01 Jan 2024 00:00:00 GMT</pubDate></item>'
                '<item><title>C</title><link>http://x/2</link></item></channel></rss>')
    q = start_ingest(rss_rows(payload_stream(spark, land)), os.path.join(out, "t"), "rss_ingest_test",
                     checkpoint=os.path.join(out, "ck"), once=True)
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "t")).collect())
    assert got == [("A & B", "http://x/1", "Mon, 01 Jan 2024 00:00:00 GMT"), ("C", "http://x/2", None)]


def test_activity_csv_with_dotted_names(spark):
    import random
    from hrlens.plans.ml import activity_from_tables
    from hrlens.sources.registry_csv import read_text_csv
    rnd = random.Random(3)
    feats = ["age", "Applewatch.Steps_LE", "Applewatch.Heart_LE"]
    d = tempfile.mkdtemp(prefix="hrlens-act-")
    with open(os.path.join(d, "train.csv"), "w") as f:
        f.write(",".join(feats + ["activity_trimmed"]) + "\n")
        for i in range(300):
            cls = ["Lying", "Walking", "Running"][i % 3]
            steps = {"Lying": 0, "Walking": 50, "Running": 150}[cls] + rnd.random() * 10
            f.write(f"{20 + i % 30},{steps},{60 + steps / 3},{cls}\n")
        f.write("33,,70,Walking\n")  # incomplete training row: dropped
    pdir = os.path.join(d, "predict")
    os.makedirs(pdir)
    with open(os.path.join(pdir, "p.csv"), "w") as f:
        f.write(",".join(feats) + "\n25,151,110\n40,3,61\n30,,\n")
    train = read_text_csv(spark, os.path.join(d, "train.csv"))
    pred, imp = activity_from_tables(train, read_text_csv(spark, pdir), feats, "activity_trimmed")
    got = [r["Predicted_activity_trimmed"] for r in pred.collect()]
    assert got[:2] == ["Running", "Lying"] and len(got) == 3
    assert "Applewatch.Steps_LE" in pred.columns
    assert abs(sum(r["importance"] for r in imp.collect()) - 1.0) < 1e-9


def test_feed_dates(spark):
    """Weekday and zone in any common form, one-digit days, and what is no date."""
    from hrlens.functions.clean import feed_timestamp
    texts = {"Mon, 01 Jan 2024 09:00:00 +0900": 1704067200, "Mon, 1 Jan 2024 00:00:00 GMT": 1704067200, "01 Jan 2024 00:00 +0000": 1704067200,
             "Tue, 01 Jan 2024 00:00:00 GMT": 1704067200, "2024-01-01T09:00:00+09:00": 1704067200, " Mon,  01 Jan 2024 00:00:00 UTC ": 1704067200,
             "yesterday": None, "": None, None: None, "Mon, 32 Jan 2024 00:00:00 GMT": None, "Mon, 01 Foo 2024 00:00:00 GMT": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(F.unix_timestamp(feed_timestamp("t"))).collect()] == list(texts.values())


def test_rater_table_is_typed(spark):
    from hrlens.sources.registry_csv import read_rater_table
    d = tempfile.mkdtemp(prefix="hrlens-rater-")
    with open(os.path.join(d, "r.csv"), "w") as f:
        f.write("employee_id,rater_id,rating_score,department\n1,7,3.5,Sales\n2,7,NA,R&D\n3,9,4,\n")
    csv = read_rater_table(spark, d, "csv")
    assert dict(csv.dtypes) == {"employee_id": "bigint", "rater_id": "bigint", "rating_score": "double", "department": "string"}
    assert [tuple(r) for r in csv.orderBy("employee_id").collect()] == [(1, 7, 3.5, "Sales"), (2, 7, None, "R&D"), (3, 9, 4.0, None)]
    p = os.path.join(d, "parquet")
    spark.createDataFrame([(1, float("nan"), 2.0, "x"), (2, 1.5, None, None)], "id long, `a.b` double, c float, d string").write.parquet(p)
    assert [tuple(r) for r in read_rater_table(spark, p).orderBy("id").collect()] == [(1, None, 2.0, "x"), (2, 1.5, None, None)]
