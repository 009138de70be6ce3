"""Sinks (K1–K3): CSV with header and run stamp, Parquet result tables, routing."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame


def run_stamp(now: dt.datetime | None = None) -> str:
    """``%Y%m%d_%H%M%S`` time stamp of a run."""
    return (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def write_csv(df: DataFrame, folder: str, name: str, stamp: str | None = None) -> str:
    """K1: header CSV (UTF-8) under ``folder/name/run_ts=<stamp>``; returns the path.

    Written by the executors in parallel (one file per partition).
    """
    path = os.path.join(folder, name, f"run_ts={stamp or run_stamp()}")
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K2 (re-aimed from a workbook): a result table as Parquet or CSV."""
    w = df.write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))


def route_by(df: DataFrame, path: str, column: str = "match_name") -> None:
    """K3: one folder per value (``column=value``), e.g. matched person or 'unknown'."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)
