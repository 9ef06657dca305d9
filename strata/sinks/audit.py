"""Audit log (also the watermark store) and pipeline logs (B4-B6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from strata import storage
from strata.functions.columns import empty_frame
from strata.schemas import AUDIT_LOG, PIPELINE_LOG


def audit_row(spark: SparkSession, table: str, load_type: str, count: int,
              now: dt.datetime, status: str = "SUCCESS") -> DataFrame:
    return spark.createDataFrame([(table, load_type, count, now, status)], AUDIT_LOG)


def reject_row(spark: SparkSession, table: str, count: int, now: dt.datetime) -> DataFrame:
    """Broken lines, under a name of their own: they move no watermark."""
    return audit_row(spark, f"{table}_rejects", "rejects", count, now, "REJECTED")


def append_audit(spark: SparkSession, path: str, rows: DataFrame) -> None:
    rows.coalesce(1).write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    if not storage.exists(spark, path):
        return empty_frame(spark, AUDIT_LOG)
    return spark.read.schema(AUDIT_LOG).parquet(path)


class PipelineLog:
    """Log entries of one run, flushed to a table and a JSON file.

    Entries are a handful of driver-side records (one per step), so they are
    kept in a list and written with an explicit schema at the end of the run.
    ``flush`` is called from a ``finally`` so logs survive a failed run.
    """

    def __init__(self, clock=None):
        self.entries: list[tuple] = []
        self._clock = clock or dt.datetime.now

    def event(self, event_type: str, message: str, table: str | None = None) -> None:
        self.entries.append((self._clock().isoformat(), event_type, message, table))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.entries, PIPELINE_LOG)

    def flush(self, spark: SparkSession, table_path: str | None,
              json_dir: str | None) -> None:
        if not self.entries:
            return
        df = self.frame(spark)
        if table_path:
            df.coalesce(1).write.mode("append").parquet(table_path)
        if json_dir:
            stamp = self._clock().strftime("%Y%m%d%H%M%S")
            df.coalesce(1).write.mode("overwrite").json(f"{json_dir}/pipeline_log_{stamp}.json")

