"""Incremental ingestion of API / feed responses with Structured Streaming.

The analyses fetch a response, parse it and save a time-stamped file per run.
The streaming form watches a landing folder of response files (one document
per file, as a fetcher writes them), parses each new file with the same
``sources.payloads`` parsers, and appends the rows to a table — exactly once
per file through the checkpoint.  The checkpoint location must be on shared
storage: by default a folder under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir
from ..sources import payloads as pl


def payload_stream(spark: SparkSession, landing: str) -> DataFrame:
    """Each new file in ``landing`` → one row (path, payload, arrival time)."""
    raw = (spark.readStream.format("text").option("wholetext", True)
           .option("maxFilesPerTrigger", 1000).load(landing))
    return raw.select(F.input_file_name().alias("path"), F.col("value").alias("payload"),
                      F.current_timestamp().alias("ingested_at"))


def pay_api_rows(stream: DataFrame) -> DataFrame:
    """Parsed pay items of accepted responses; the year comes from the response."""
    s = stream.withColumn("pay_year", F.xpath_string("payload", F.lit("//ac_year")).try_cast("int"))
    return pl.parse_pay_payloads(s)


def rss_rows(stream: DataFrame) -> DataFrame:
    return pl.parse_rss(stream)


def start_ingest(rows: DataFrame, table_path: str, name: str, checkpoint: str | None = None,
                 once: bool = False) -> StreamingQuery:
    """Append parsed rows to a Parquet table; ``once`` processes what is there and stops."""
    spark = rows.sparkSession
    ck = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    w = (rows.writeStream.format("parquet").option("path", table_path)
         .option("checkpointLocation", ck).outputMode("append").queryName(name))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()
