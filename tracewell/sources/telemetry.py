"""Telemetry tables by date: a lookback reads the days that it needs, whatever the table's age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The partition column of telemetry tables.
DATE = "event_date"


def append(df: DataFrame, path: str, ts: str = "ts") -> None:
    """Adds events to the table at path, in a folder for each date; files are in the order of time, so that their row groups can be skipped.

    Ranges of time are dealt out, so that a day with most of the rows has as many writers as its size asks for. Null times have a folder of their own.
    """
    dated = df.withColumn(DATE, F.to_date(ts))
    dated.repartitionByRange(DATE, ts).sortWithinPartitions(DATE, ts).write.mode("append").partitionBy(DATE).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The whole table, with its dates; a lookback on it (see lookback()) prunes by them."""
    return spark.read.parquet(path)


def lookback(df: DataFrame, ts: str, as_of: Column, interval: str) -> DataFrame:
    """Rows after as_of minus the interval; the edge itself is out.

    as_of may be a value or a scalar subquery, which is run first. A table by dates is asked for the dates of
    the interval only: folders before it aren't listed for the scan, and within the first one row groups are skipped by time.
    """
    start = as_of - F.expr(f"INTERVAL {interval}")
    recent = df.where(F.col(ts) > start)
    return recent.where(F.col(DATE) >= F.to_date(start)) if DATE in df.columns else recent
