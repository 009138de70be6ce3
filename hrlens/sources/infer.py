"""Types of text columns by their whole content.

A reader that infers types from a part of a file meets the odd cell later; the analyses read whole files for that
reason, and one of them warns that a code column may hold numbers and text side by side.  Here every cell of every
column is put into a class, and one aggregate counts the classes by column; a column's type follows from its counts.
Counts add up in any order, so the pass is one scan, combined on the map side, for any number of columns.

The lattice, as a whole-file pandas read has it:

    only whole numbers                      int64; uint64 beyond it; with missing cells float64
    whole and other numbers                 float64, as for a column without a value
    only true and false                     bool; with missing cells object
    anything else, numbers too large        object
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import to_number

# Texts that stand for a missing cell.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
           "NaN", "None", "n/a", "nan", "null")
UINT64_MAX = (1 << 64) - 1
CLASSES = ("missing", "int", "uint", "float", "huge", "bool", "text")


def cell_class(value: Column) -> Column:
    """The class of a text cell: missing, int (64 bits), uint (beyond, up to 2**64 - 1), huge (whole, beyond that), float, bool, text."""
    t = F.trim(value)
    whole = t.rlike(r"^[+-]?\d+$")
    large = t.try_cast("decimal(38,0)")
    return (F.when(value.isNull() | value.isin(*MISSING), "missing")
            .when(whole & t.try_cast("bigint").isNotNull(), "int")
            .when(whole & large.between(0, F.lit(str(UINT64_MAX)).cast("decimal(38,0)")), "uint")
            .when(whole, "huge")
            .when(to_number(t).isNotNull(), "float")
            .when(F.lower(value).isin("true", "false"), "bool")
            .otherwise("text"))


def column_types(df: DataFrame) -> DataFrame:
    """position, column, n, one count a class, dtype, mixed (numbers beside text), and the smallest text among numbers.

    ``df`` holds text columns.  A table without rows gives float64 columns without cells, like a file with a header only.
    """
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    seen = df.select(F.posexplode(cells).alias("position", "value")).withColumn("class", cell_class(F.col("value")))
    counts = seen.groupBy("position").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("class") == c).alias(f"n_{c}") for c in CLASSES],
        F.count_if((F.col("class") == "int") & F.ltrim("value").startswith("-")).alias("negative"),
        F.min(F.when(F.col("class").isin("text", "bool", "huge"), F.col("value"))).alias("odd"))
    names = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "position int, column string")  # a row a column
    t = names.join(counts, "position", "left").fillna(0, ["n", "negative", *[f"n_{c}" for c in CLASSES]])
    whole = F.col("n_int") + F.col("n_uint")
    numbers = whole + F.col("n_float")
    dtype = (F.when((F.col("n_text") > 0) | (F.col("n_huge") > 0), "object")
             .when(F.col("n_bool") > 0, F.when((numbers == 0) & (F.col("n_missing") == 0), "bool").otherwise("object"))
             .when(F.col("n_float") > 0, "float64")
             .when(F.col("n_uint") > 0, F.when((F.col("n_missing") == 0) & (F.col("negative") == 0), "uint64").otherwise("object"))
             .when((whole > 0) & (F.col("n_missing") == 0), "int64")
             .otherwise("float64"))
    mixed = (numbers > 0) & (F.col("n_text") + F.col("n_bool") > 0)
    return t.select("position", "column", "n", *[f"n_{c}" for c in CLASSES], dtype.alias("dtype"), mixed.alias("mixed"),
                    F.when(mixed, F.col("odd")).alias("odd_text")).orderBy("position")


SPARK_TYPES = {"int64": "bigint", "uint64": "decimal(20,0)", "float64": "double", "bool": "boolean"}


def typed(df: DataFrame, types: DataFrame) -> DataFrame:
    """The columns cast to their types; missing cells are NULL, ``object`` columns stay text."""
    out = []
    for r in types.collect():  # a row a column
        c = F.col(f"`{r['column']}`")
        present = F.when(~c.isin(*MISSING), c)
        kind = SPARK_TYPES.get(r["dtype"])
        if kind == "double":
            present = to_number(present)
        elif kind:
            present = F.trim(present).try_cast(kind)
        out.append(present.alias(r["column"]))
    return df.select(*out)


def matches_code(c: Column | str, code: int) -> Column:
    """A cell equals a numeric code whether it was stored as a number or as text; NULL and other text do not."""
    return F.coalesce(to_number(c) == F.lit(float(code)), F.lit(False))
