"""Delimited scans of the registry, HR and rater files.

The registry is a cp949 (MS949) CSV with Korean headers.  Spark's CSV reader
accepts that charset only with ``spark.sql.legacy.javaCharsets=true`` (set by
``hrlens.session``); the scan reads every column as text and the typed view
applies the tolerant parses, so a malformed cell becomes NULL instead of
failing the job (SURVEY D1–D3).  Convert once to Parquet (``to_parquet``)
and run the analyses on that: later scans get column pruning and pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from ..functions.clean import code_to_text, nan_to_null, to_date_tolerant, to_long, to_number
from .infer import column_types, typed
from .positions import with_position

# Registry headers (as published) → aliases used by the engine.
REGISTRY_HEADERS = {
    "사업장명": "est_name",
    "사업장가입상태코드": "status_code",
    "가입자수": "headcount",
    "당월고지금액": "billed_amount",
    "법정동주소광역시도코드": "region_code",
    "사업장업종코드": "industry_code",
    "적용일자": "start_date",
    "탈퇴일자": "end_date",
    "신규취득자수": "joiners",
    "상실가입자수": "leavers",
}
REGISTRY_ENCODING = "MS949"


def require_charset(spark: SparkSession, encoding: str) -> None:
    """Korean code pages need ``spark.sql.legacy.javaCharsets``; set it or fail early."""
    if encoding.upper().replace("-", "") in ("UTF8", "USASCII", "ISO88591", "UTF16"):
        return
    key = "spark.sql.legacy.javaCharsets"
    if spark.conf.get(key, "false") != "true":
        try:
            spark.conf.set(key, "true")
        except Exception as e:  # pragma: no cover - depends on the deployment
            raise RuntimeError(f"reading {encoding} needs {key}=true in the session") from e


def read_text_csv(spark: SparkSession, path: str, encoding: str = "UTF-8", header: bool = True,
                  columns: list[str] | None = None) -> DataFrame:
    """Every column as a string (no inference pass over the file)."""
    require_charset(spark, encoding)
    r = spark.read.option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    if columns:
        r = r.schema(StructType([StructField(c, StringType()) for c in columns]))
    return r.csv(path)


def read_registry_csv(spark: SparkSession, path: str, encoding: str = REGISTRY_ENCODING) -> DataFrame:
    """The registry with English aliases and typed, tolerant columns.

    Missing known columns become NULL.  ``est_id`` is the row's place in the files (``positions.with_position``):
    files in order of path, rows in file order.  It is the same however the scan is cut, tells exact duplicates apart,
    and as a tie-break it gives the row that comes first in the files.
    """
    raw = read_text_csv(spark, path, encoding)
    raw = with_position(raw, "est_id")
    raw = raw.withColumnsRenamed({k: v for k, v in REGISTRY_HEADERS.items() if k in raw.columns})
    for alias in REGISTRY_HEADERS.values():
        if alias not in raw.columns:
            raw = raw.withColumn(alias, F.lit(None).cast("string"))
    typed = raw.select(
        "est_id",
        F.col("est_name"),
        to_long("status_code").try_cast("int").alias("status_code"),
        code_to_text("industry_code").alias("industry_code"),
        to_long("region_code").try_cast("int").alias("region_code"),
        to_long("headcount").alias("headcount"),
        to_number("billed_amount").alias("billed_amount"),
        to_long("joiners").alias("joiners"),
        to_long("leavers").alias("leavers"),
        to_date_tolerant("start_date").alias("start_date"),
        to_date_tolerant("end_date").alias("end_date"),
    )
    return typed


def read_hr_csv(spark: SparkSession, path: str, encoding: str = REGISTRY_ENCODING) -> DataFrame:
    """S1 for the HR master: dates parsed tolerantly, status/department as text."""
    raw = read_text_csv(spark, path, encoding)
    cols = {c.lower(): c for c in raw.columns}

    def pick(name):
        return F.col(cols[name.lower()]) if name.lower() in cols else F.lit(None).cast("string")

    return raw.select(
        to_date_tolerant(pick("Hire_Date")).alias("hire_date"),
        to_date_tolerant(pick("Termination_Date")).alias("termination_date"),
        pick("Termination_Date").alias("termination_text"),
        pick("Status").alias("status"),
        pick("Department").alias("department"),
        pick("Job_Role").alias("job_role"),
        to_number(pick("Performance_Rating")).alias("performance_rating"),
    )


def read_rater_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S3 (re-aimed): the rater table as Parquet or CSV instead of a workbook.

    A CSV's columns get the types of their whole content (``infer.column_types``), as a workbook's cells have them.
    NaN cells become NULL (D7).
    """
    if fmt == "csv":
        text = read_text_csv(spark, path)
        return typed(text, column_types(text))
    return without_nan(spark.read.parquet(path))


def without_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every float and double column of a scan."""
    return df.select(*[nan_to_null(f"`{f.name}`").cast(f.dataType).alias(f.name) if isinstance(f.dataType, (FloatType, DoubleType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def to_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Convert once; analyses then read the columnar copy."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
