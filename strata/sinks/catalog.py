"""Named tables in the session catalog: ``CREATE TABLE IF NOT EXISTS`` and CTAS.

Statements that find their table do nothing, as the original scripts did, but
only if it has the columns they ask for: a table of another schema is refused
instead of being read as something else. Data lies below an absolute folder on
shared storage, so a new session names the same tables again from their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.plans.silver import SilverStore
from strata.schemas import REFRESH_TABLES, SCD2_TABLES
from strata.sinks.tables import BatchTable


class SchemaMismatch(ValueError):
    pass


def columns_of(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in columns_of(schema))


def _must_match(spark: SparkSession, name: str, schema: StructType) -> None:
    there, asked = columns_of(spark.table(name).schema), columns_of(schema)
    if there != asked:
        raise SchemaMismatch(f"{name} has the columns {there}, not {asked}")


def create_database(spark: SparkSession, database: str, folder: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")


def create_if_absent(spark: SparkSession, name: str, schema: StructType, folder: str) -> bool:
    """An empty typed table ``name`` over ``folder``; whether it was made now.
    Files that the folder holds from an earlier session are its rows."""
    made = not spark.catalog.tableExists(name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet LOCATION '{folder}'")
    _must_match(spark, name, schema)
    return made


def insert(df: DataFrame, name: str) -> None:
    """Append rows by column name; columns the table lacks are an error."""
    table = df.sparkSession.table(name)
    if set(df.columns) != set(table.columns):
        raise SchemaMismatch(f"{name} has the columns {table.columns}, the rows {df.columns}")
    df.select([F.col(f.name).cast(f.dataType) for f in table.schema.fields]).write.insertInto(name)


def ctas_if_absent(df: DataFrame, name: str, folder: str) -> bool:
    """``CREATE TABLE IF NOT EXISTS name AS`` the frame; whether it was made now.

    The frame runs only if there is no table. Rows are written before the
    table is named, so a run that fails leaves no half-filled table.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        _must_match(spark, name, df.schema)
        return False
    df.write.mode("overwrite").parquet(folder)
    spark.sql(f"CREATE TABLE {name} ({ddl(df.schema)}) USING parquet LOCATION '{folder}'")
    return True


def publish_silver(store: SilverStore, database: str) -> list[str]:
    """Name every silver table in ``database``: views over the committed state.

    An SCD2 table is a view of its log as of now, resolved by SQL, so it can be
    queried and joined from SQL with the scan's pruning; publish again after
    a batch. Tables without a commit are typed and empty.
    """
    spark = store.spark
    names = []
    for table in (*REFRESH_TABLES, *SCD2_TABLES):
        name = f"{database}.{table}"
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {store.table(table).as_sql()}")
        names.append(name)
    return names


def publish_mart(spark: SparkSession, mart: BatchTable, name: str) -> None:
    """A view of the latest committed version of a mart."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {mart.as_sql()}")
