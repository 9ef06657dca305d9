"""Bronze tables: schema-on-read scans of the landing zone (A5, A6).

A bronze table is a declared schema over a file glob, exactly like an
external table: every landed JSON file of a table (``<table>/*.json``), or
every daily review snapshot (``customer_reviews_*.parquet``). The glob
resolves to paths on shared storage, never to a session-relative path.

A landed line that is no record of the schema (broken JSON, a value of another
type) never becomes a row of NULLs: it is a reject, kept as it landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata import storage
from strata.functions.columns import empty_frame
from strata.schemas import BRONZE, JSON_TABLES


def bronze_glob(landing_root: str, table: str) -> str:
    root = landing_root.rstrip("/")
    if table == "customer_reviews":
        return f"{root}/customer_reviews/customer_reviews_*.parquet"
    return f"{root}/{table}/*.json"


BAD_LINE = StructType([StructField("file", StringType()), StructField("line", StringType())])


def landed_lines(spark: SparkSession, landing_root: str, table: str) -> DataFrame | None:
    """``value``, ``file``: every line landed for a JSON table."""
    glob = bronze_glob(landing_root, table)
    return with_file(spark.read.text(glob)) if storage.matches(spark, glob) else None


def with_file(lines: DataFrame) -> DataFrame:
    """Lines with the landing file they stand in (the part of its path behind the table's folder)."""
    name = F.regexp_extract("_metadata.file_path", r"/([^/]*\.json)(/[^/]*)?$", 1)
    return lines.select("value", name.alias("file"))


def _parsed(lines: DataFrame, table: str) -> DataFrame:
    """Lines are parsed whole, whatever columns a query reads: a JSON scan that
    prunes a column would not see that its value is bad."""
    schema = StructType([*BRONZE[table].fields, StructField("_bad", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    # A generator is a step of its own: the filter on ``_bad`` does not parse a second time.
    record = F.inline(F.array(F.from_json("value", schema, options)))
    return lines.where(F.trim("value") != "").select(F.col("file").alias("_file"), F.col("value").alias("_line"), record)


def good_rows(lines: DataFrame, table: str) -> DataFrame:
    """Typed rows of the lines that are JSON records of the table's schema."""
    return _parsed(lines, table).where("_bad IS NULL").select(*BRONZE[table].fieldNames())


def bad_lines(lines: DataFrame, table: str) -> DataFrame:
    """(file, line) of all other lines, as they landed."""
    return _parsed(lines, table).where("_bad IS NOT NULL").select(F.col("_file").alias("file"), F.col("_line").alias("line"))


def read_bronze(spark: SparkSession, landing_root: str, table: str) -> DataFrame:
    """Typed scan of everything landed for ``table``; broken lines are left to ``read_rejects``.

    A number landed under a ``STRING`` column is read as its digit text,
    which is how epoch-millisecond timestamps become bronze strings.
    """
    if table in JSON_TABLES:
        lines = landed_lines(spark, landing_root, table)
        return empty_frame(spark, BRONZE[table]) if lines is None else good_rows(lines, table)
    glob = bronze_glob(landing_root, table)
    return spark.read.schema(BRONZE[table]).parquet(glob) if storage.matches(spark, glob) else \
        empty_frame(spark, BRONZE[table])


def read_rejects(spark: SparkSession, landing_root: str, table: str) -> DataFrame:
    lines = landed_lines(spark, landing_root, table)
    return empty_frame(spark, BAD_LINE) if lines is None else bad_lines(lines, table)


def write_rejects(bad: DataFrame, root: str, table: str, batch: str) -> int:
    """Keep a batch's broken lines below ``<root>/<table>/batch=<batch>``;
    returns their number. Run again, the batch replaces its own lines."""
    obs = Observation(f"rejects_{table}")
    bad.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{table}/batch={batch}")
    return int(obs.get["n"])


def register_bronze(spark: SparkSession, landing_root: str,
                    database: str = "bronze") -> list[str]:
    """``CREATE TABLE ... USING json|parquet OPTIONS (path <absolute glob>)``.

    Gives SQL users the same external tables; paths are absolute because a
    relative path silently reads nothing. Tables with nothing landed yet are
    skipped (their glob matches no file); the registered names are returned.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    done = []
    for table, schema in BRONZE.items():
        fmt = "json" if table in JSON_TABLES else "parquet"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
        if not storage.matches(spark, bronze_glob(landing_root, table)):
            continue
        spark.sql(f"CREATE TABLE {database}.{table} ({cols}) USING {fmt} "
                  f"OPTIONS (path '{bronze_glob(landing_root, table)}')")
        done.append(table)
    return done
