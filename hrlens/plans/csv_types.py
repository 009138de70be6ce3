"""Written CSV files read back: types by their whole content (S1, D10) and ties by file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.persist import Rounds, materialize
from ..sources.infer import column_types
from ..sources.positions import with_position
from ..sources.registry_csv import read_text_csv
from ..sources.tables import read_table

#: Column -> SQL over ``orders`` that both engines read alike: the mess of a hand-kept registry.
MESS = {
    "order no": "CAST(o_orderkey AS VARCHAR(40))",
    "industry": "CASE WHEN o_orderkey % 997 = 3 THEN 'unknown' ELSE CAST(o_custkey AS VARCHAR(40)) END",
    "headcount": "CASE WHEN o_orderkey % 11 = 0 THEN 'NA' ELSE CAST(o_custkey % 300 AS VARCHAR(40)) END",
    "amount": "CASE WHEN o_orderkey % 7 = 0 THEN '1e400' WHEN o_orderkey % 7 = 1 THEN '1,200' ELSE '3.5' END",
    "rate": "CASE WHEN o_orderkey % 13 = 0 THEN ' .5' WHEN o_orderkey % 13 = 1 THEN '-inf' WHEN o_orderkey % 13 = 2 THEN '#N/A' ELSE '7' END",
    "active": "CASE WHEN o_orderstatus = 'O' THEN 'TRUE' ELSE 'False' END",
    "insured": "CASE WHEN o_orderstatus = 'O' THEN 'true' WHEN o_orderstatus = 'F' THEN 'NULL' ELSE 'false' END",
    "big": "CASE WHEN o_orderkey % 5 = 0 THEN '18446744073709551615' ELSE '12' END",
    "too big": "CASE WHEN o_orderkey % 5 = 0 THEN '18446744073709551616' ELSE '12' END",
    "empty": "CASE WHEN o_orderkey % 2 = 0 THEN 'nan' ELSE 'None' END",
}


def csv_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the mess as CSV, reads all of it as text and reports every column's cells and type."""
    files = Rounds(spark, "messy-csv")
    mess = read_table(spark, sf_dir, "orders").selectExpr(*[f"{sql.replace('VARCHAR(40)', 'STRING')} AS `{c}`" for c, sql in MESS.items()])
    mess.write.option("header", True).csv(files.path)
    report = column_types(read_text_csv(spark, files.path)).collect()  # a row a column
    files.drop()
    out = spark.createDataFrame(report, "position int, column string, n long, n_missing long, n_int long, n_uint long, n_float long, n_huge long, "
                                        "n_bool long, n_text long, dtype string, mixed boolean, odd_text string")
    return out


#: Ties are what the file order decides: few priorities and statuses, many rows.
FIRST_ROWS = 50


def first_in_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of the highest priority in file order, and the first row of each status among them.

    The orders are written as CSV in order of their key over several files; only priority, status and amount are in
    the files, so nothing but the place of a row tells ties apart.
    """
    files = Rounds(spark, "ordered-csv")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    (orders.repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey").select("o_orderpriority", "o_orderstatus", "o_totalprice")
     .write.option("header", True).csv(files.path))
    rows = with_position(read_text_csv(spark, files.path))
    rows = rows.select("position", "o_orderpriority", "o_orderstatus", F.col("o_totalprice").cast("double").alias("amount"))
    top = materialize(rows.orderBy("o_orderpriority", "position").limit(FIRST_ROWS), repartition=False)
    first = rows.groupBy("o_orderstatus").agg(F.min("position").alias("first_of_status"))
    files_read = materialize(top.join(first, "o_orderstatus"), repartition=False)
    files.drop()
    return files_read


def sql() -> dict[str, str]:
    """Each column's classes and type as the mess was made, not as it is read."""
    known = {  # class of the cells by their text, where it is not a plain number
        "unknown": "text", "NA": "missing", "1e400": "text", "1,200": "text", "3.5": "float", " .5": "float", "-inf": "float", "#N/A": "missing",
        "TRUE": "bool", "False": "bool", "true": "bool", "false": "bool", "NULL": "missing", "18446744073709551615": "uint",
        "18446744073709551616": "huge", "nan": "missing", "None": "missing"}
    dtype = {"order no": "int64", "industry": "object", "headcount": "float64", "amount": "object", "rate": "float64", "active": "bool",
             "insured": "object", "big": "uint64", "too big": "object", "empty": "float64"}
    classes = ("missing", "int", "uint", "float", "huge", "bool", "text")
    case = "CASE v " + " ".join(f"WHEN '{t}' THEN '{c}'" for t, c in known.items()) + " ELSE 'int' END"
    parts = []
    for i, (c, expr) in enumerate(MESS.items()):
        counts = ", ".join(f"count(*) FILTER (k = '{x}') AS n_{x}" for x in classes)
        mixed = "count(*) FILTER (k IN ('int', 'uint', 'float')) > 0 AND count(*) FILTER (k IN ('text', 'bool')) > 0"
        parts.append(f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", count(*) AS n, {counts}, '{dtype[c]}' AS dtype, {mixed} AS mixed, "
                     f"CASE WHEN {mixed} THEN min(v) FILTER (k IN ('text', 'bool', 'huge')) END AS odd_text FROM (SELECT v, {case} AS k FROM (SELECT {expr} AS v FROM orders) a) b")
    first = ("WITH f AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, o_orderpriority, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS amount FROM orders) "
             "SELECT t.*, first_of_status FROM (SELECT * FROM f ORDER BY o_orderpriority, position LIMIT 50) t "
             "JOIN (SELECT o_orderstatus, min(position) AS first_of_status FROM f GROUP BY o_orderstatus) s USING (o_orderstatus)")
    return {"csv_types": " UNION ALL ".join(parts), "first_in_file": first}
