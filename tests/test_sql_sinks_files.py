"""SQL functions, sinks, file listing, month spine."""

import datetime as dt
import os
import tempfile

from hrlens.plans import catalog
from hrlens.functions.sql_functions import register_sql_functions
from hrlens.plans.registry import closures_by_month_df
from hrlens.sources.files import list_images
from hrlens.sources.sinks import route_by, run_stamp, write_csv


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT clean_html('<b>A</b> &amp;lt; B') c, annual_pay_10k(950, 1) p, "
                  "annual_pay_10k(1, 0) z, money_to_long('1,234.9') m, bias_class(-0.2) b").first()
    assert (r.c, r.p, r.z, r.m, r.b) == ("A &lt; B", 12, None, 1234, "Severity (엄격화)")


def test_sinks(spark):
    d = tempfile.mkdtemp(prefix="hrlens-sink-")
    df = spark.createDataFrame([(1, "kim"), (2, "unknown"), (3, "kim")], "id long, match_name string")
    p = write_csv(df, d, "news", run_stamp(dt.datetime(2024, 1, 2, 3, 4, 5)))
    assert p.endswith("run_ts=20240102_030405")
    assert spark.read.option("header", True).csv(p).count() == 3
    route_by(df, os.path.join(d, "routed"))
    parts = {n for n in os.listdir(os.path.join(d, "routed")) if n.startswith("match_name=")}
    assert parts == {"match_name=kim", "match_name=unknown"}


def test_list_images(spark):
    d = tempfile.mkdtemp(prefix="hrlens-img-")
    for n in ("kim12.JPG", "lee3.png", "notes.txt", "park.jpeg"):
        with open(os.path.join(d, n), "wb") as f:
            f.write(b"x")
    got = sorted((r.file_name, r.person) for r in list_images(spark, d).collect())
    assert got == [("kim12.JPG", "kim"), ("lee3.png", "lee"), ("park.jpeg", "park")]


def test_closures_month_spine(spark):
    est = spark.createDataFrame([(2, dt.date(1999, 3, 5)), (2, dt.date(1999, 3, 9)), (1, dt.date(1999, 4, 1)),
                                 (2, dt.date(2000, 1, 1))], "status_code int, end_date date")
    rows = [tuple(r) for r in closures_by_month_df(est, 1999, all_months=True).collect()]
    assert len(rows) == 12 and rows[2] == (3, 2) and rows[3] == (4, 0)


def test_cli_lists_keys_and_rejects_unknown(capsys):
    from hrlens.__main__ import main
    assert main(["--list"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) == len(catalog.queries()) and lines[0].startswith("pay_topk_large")
    assert main(["no_such_key"]) == 2
