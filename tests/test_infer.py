"""Types by whole content, against a whole-file pandas read."""
import io

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hrlens.sources import infer
from hrlens.sources.registry_csv import read_text_csv

COLUMNS = [["1", "2"], ["1", ""], ["1", "2.5"], ["1", "x"], ["True", "False"], ["True", ""], ["TRUE", "tRue"], ["True", "1"], ["", ""],
           ["18446744073709551615", "1"], ["18446744073709551615", "-1"], ["99999999999999999999999", "1"], ["9223372036854775808", ""],
           ["9223372036854775807", "-9223372036854775808"], ["1e5", "3"], ["inf", "1"], ["-inf", "2"], ["Infinity", "1"], ["+5", "6"], [" 5", "6"],
           ["5 ", "6"], ["1_000", "2"], ["nan", "1"], ["NA", "1"], ["1.", "2"], [".5", "2"], ["0x10", "1"], ["1d", "2"], ["007", "8"], ["1e400", "2"],
           ["-", "1"], ["yes", "no"], ["1e-400", "2"], ["null", "None"], ["#N/A", "x"], ["1", "1"]]


def test_types_equal_a_whole_file_read(spark, tmp_path):
    names = [f"c {i}.x" for i in range(len(COLUMNS))]
    text = "\n".join([",".join(names), *[",".join(c[r] for c in COLUMNS) for r in range(2)]]) + "\n"
    (tmp_path / "a.csv").write_text(text)
    want = pd.read_csv(io.StringIO(text), low_memory=False)
    df = read_text_csv(spark, str(tmp_path))
    types = infer.column_types(df)
    got = {r["column"]: r for r in types.collect()}
    assert list(got) == names and [got[c]["dtype"] for c in names] == [str(t).replace("str", "object") for t in want.dtypes]
    assert got["c 3.x"]["mixed"] and got["c 3.x"]["odd_text"] == "x" and not got["c 4.x"]["mixed"]
    typed = infer.typed(df, types)
    kinds = dict(typed.dtypes)
    assert kinds["c 0.x"] == "bigint" and kinds["c 1.x"] == "double" and kinds["c 4.x"] == "boolean" and kinds["c 9.x"] == "decimal(20,0)"
    assert [r[0] for r in typed.select("`c 25.x`").collect()] == [0.5, 2.0]


def test_a_late_odd_cell_is_seen(spark, tmp_path):
    """The only text cell is the last of many, in another file; counts do not depend on the partitions."""
    spark.range(5000).select(F.col("id").cast("string").alias("code")).repartition(6).write.option("header", True).csv(str(tmp_path / "a"))
    spark.createDataFrame([("x9",), ("300100",), ("NA",)], "code string").coalesce(1).write.mode("append").option("header", True).csv(str(tmp_path / "a"))
    df = read_text_csv(spark, str(tmp_path / "a"))
    for d in (df, df.repartition(3)):
        r = infer.column_types(d).first()
        assert (r["n"], r["n_int"], r["n_text"], r["n_missing"], r["dtype"], r["mixed"], r["odd_text"]) == (5003, 5001, 1, 1, "object", True, "x9")
    assert df.where(infer.matches_code("code", 300100)).count() == 1


def test_edges(spark):
    r = infer.column_types(spark.createDataFrame([], "a string, `b.c` string")).collect()
    assert [(x["column"], x["n"], x["dtype"]) for x in r] == [("a", 0, "float64"), ("b.c", 0, "float64")]
    wide = spark.createDataFrame([tuple(str(i) for i in range(300))], [f"c{i}" for i in range(300)])
    assert {x["dtype"] for x in infer.column_types(wide).collect()} == {"int64"}
    codes = spark.createDataFrame([("300100",), (" 300100.0",), ("x",), (None,)], "c string")
    assert [x[0] for x in codes.select(infer.matches_code("c", 300100)).collect()] == [True, True, False, False]


@pytest.mark.parametrize("value,kind", [("-0", "int"), ("1e309", "text"), ("٣", "text"), ("True ", "text"), ("NULL", "missing"), (None, "missing")])
def test_cell_classes(spark, value, kind):
    assert spark.createDataFrame([(value,)], "v string").select(infer.cell_class(F.col("v"))).first()[0] == kind
