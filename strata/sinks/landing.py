"""Landing zone writes and the archive of earlier landing files.

Layout (all below one landing root on shared storage)::

    <root>/<table>/<table>_<ddMMyyyy>.json/part-*.json.gz  JSON lines (B1)
    <root>/customer_reviews/customer_reviews_<yyyyMMdd>.parquet/  (B2)
    <archive>/<table>/year=<yyyy>/month=<MM>/day=<dd>/file=<landing file>/part-*  (B3)

Every write is a distributed DataFrame write; nothing passes through the
driver. Timestamps land as epoch-millisecond numbers, which the bronze
tables read back as digit text.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType, TimestampNTZType, TimestampType

from strata import storage
from strata.functions.columns import empty_frame, epoch_millis


def landing_file(root: str, table: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{table}/{table}_{day:%d%m%Y}.json"


def reviews_file(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/customer_reviews/customer_reviews_{day:%Y%m%d}.parquet"


def millis_timestamps(df: DataFrame) -> DataFrame:
    """Replace every timestamp column by its epoch milliseconds (BIGINT)."""
    return df.select([
        epoch_millis(f.name, f.dataType).alias(f.name)
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)) else F.col(f.name)
        for f in df.schema.fields])


def land_json(df: DataFrame, root: str, table: str, day: dt.date) -> int:
    """Write one extract as JSON lines; returns the number of rows written.

    The count is taken by an ``Observation`` on the write itself, so the
    source is read once (the original counted with a second extract).
    Lines are written with gzip (``part-*.json.gz``), which every reader of the
    folder undoes: as plain text the landed lines were most of what a day writes.
    """
    obs = Observation(f"land_{table}")
    out = millis_timestamps(df).observe(obs, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").json(landing_file(root, table, day), compression="gzip")
    return int(obs.get["rows"])


def land_reviews(df: DataFrame, root: str, day: dt.date) -> int:
    """Write one daily review snapshot as Parquet; returns its row count."""
    obs = Observation("land_reviews")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
        reviews_file(root, day))
    return int(obs.get["rows"])


_FILE_DATE = re.compile(r"^(.*)_(\d{2})(\d{2})(\d{4})\.json$")


def archive_landing(spark: SparkSession, root: str, archive_root: str, table: str,
                    keep: str | None = None) -> int:
    """Move every landed file of ``table`` into the dated archive, byte for byte.

    The date comes from the file name (``<table>_<ddMMyyyy>.json``). Files are
    renamed, not read and rewritten: extra columns and broken lines stay as
    they landed, and nothing passes through a task. A second landing of the
    same day joins the first, as written files have names of their own. Every
    rename is atomic, so an interrupted archive goes on where it stopped.
    The landing file named ``keep`` stays. Returns the number of lines moved,
    which one scan counts.
    """
    landed = [(p, m) for p in storage.matches(spark, f"{root.rstrip('/')}/{table}/*.json")
              if (m := _FILE_DATE.match(p.rsplit("/", 1)[1])) and p.rsplit("/", 1)[1] != keep]
    held = [f for p, _ in landed for f in storage.files(spark, p)]
    lines = spark.read.text(held).where(F.trim("value") != "").count() if held else 0
    for path, date in landed:
        name, (_, day, month, year) = path.rsplit("/", 1)[1], date.groups()
        kept = f"{archive_root.rstrip('/')}/{table}/year={year}/month={month}/day={day}/file={name}"
        files = storage.files(spark, path)
        if files != [path] and not storage.exists(spark, kept):
            storage.move(spark, path, kept)  # the day's first landing: one rename of its folder
            continue
        for f in files:
            storage.move(spark, f, f"{kept}/{f.rsplit('/', 1)[1]}")
        storage.delete(spark, path)
    return lines


def read_archive(spark: SparkSession, archive_root: str, table: str, schema: StructType) -> DataFrame:
    """Archived rows by ``schema``, with year, month, day and file."""
    path = f"{archive_root.rstrip('/')}/{table}"
    full = StructType(list(schema.fields) + [StructField(c, StringType()) for c in ("year", "month", "day", "file")])
    return spark.read.schema(full).json(path) if storage.exists(spark, path) else empty_frame(spark, full)


def read_archived_lines(spark: SparkSession, archive_root: str, table: str) -> DataFrame:
    """Archived lines as they landed: value, year, month, day, file."""
    schema = StructType([StructField(c, StringType()) for c in ("value", "year", "month", "day", "file")])
    return spark.read.schema(schema).text(f"{archive_root.rstrip('/')}/{table}")
