"""Silver layer: quarantine flag plus SCD2 history or full refresh.

Two forms of every silver table:

* ``first_load`` / ``refresh``: the lazily planned silver rows of one run
  from an empty warehouse. Catalyst folds the merge against an empty
  target away, so gold marts over them are one plan from the scan on.
* ``SilverStore``: the written tables. Every run of a batch writes a new
  batch folder per table (history part + active part for SCD2 tables, one
  data part for refreshed tables) and commits it through the manifest.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.quality import quarantine
from strata.operators.scd2 import SPECS, corrected, insert_all, merge_source, scd2_merge
from strata.schemas import REFRESH_TABLES, SCD2_TABLES, silver_schema
from strata.sinks.tables import BatchTable
from strata.sinks.versions import VersionLog
from strata.storage import shuffles_dropped


def refresh(bronze: DataFrame, table: str) -> DataFrame:
    """``TRUNCATE`` + ``INSERT SELECT *, flag``: silver = flagged bronze."""
    return quarantine(bronze, table).select(*silver_schema(table).fieldNames())


def first_load(bronze: DataFrame, table: str, now: dt.datetime,
               semantics: str = "reference") -> DataFrame:
    """The SCD2 table after one merge into an empty target."""
    spec = corrected(SPECS[table]) if semantics == "corrected" else SPECS[table]
    return insert_all(merge_source(bronze, spec), spec, now, silver_schema(table).fieldNames())


def silver_tables(bronze: dict[str, DataFrame], now: dt.datetime) -> dict[str, DataFrame]:
    """All eight silver tables of a first run, lazily."""
    out = {t: first_load(bronze[t], t, now) for t in SCD2_TABLES}
    out.update({t: refresh(bronze[t], t) for t in REFRESH_TABLES})
    return out


class MultiMatchError(RuntimeError):
    pass


class SilverStore:
    """Written silver tables below ``root``: a ``VersionLog`` for each SCD2 table,
    to which a batch adds what it changes, a ``BatchTable`` for each refreshed one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str) -> BatchTable:
        root, schema = f"{self.root}/{name}", silver_schema(name)
        if name not in SCD2_TABLES:
            return BatchTable(self.spark, root, schema)
        spec = SPECS[name]
        return VersionLog(self.spark, root, schema, spec.corrected_keys or spec.keys, spec.keys)

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def merge(self, name: str, bronze: DataFrame, batch: str, now: dt.datetime,
              semantics: str = "reference", on_multi_match: str = "error",
              cache_source: bool = True) -> None:
        """Merge one batch of bronze rows and commit what it changes as ``batch``.

        When there is a target, the flagged source (a distinct over the
        batch's bronze rows) is persisted for the duration of the merge: the
        test for unique keys and the joins read it, and the bronze files are
        parsed once. A lost executor only costs recomputing its cached blocks.
        The shuffle files of each action go when it ends: those of a first load
        are as large as the table.
        """
        with shuffles_dropped(self.spark):
            self._merge(name, bronze, batch, now, semantics, on_multi_match, cache_source)

    def _merge(self, name: str, bronze: DataFrame, batch: str, now: dt.datetime, semantics: str,
               on_multi_match: str, cache_source: bool) -> None:
        spec, tbl = SPECS[name], self.table(name)
        if not tbl.previous_for(batch):
            # ``first_load``, whose distinct rows are told apart behind the shuffle of the write.
            made = corrected(spec) if semantics == "corrected" else spec
            rows = insert_all(quarantine(bronze, name), made, now, silver_schema(name).fieldNames())
            return tbl.append(batch, rows.withColumn("kind", F.lit("active")), distinct=spec.distinct_source)
        source = merge_source(bronze, spec)
        if cache_source:
            source = source.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            unique = semantics == "reference" and self._unique_keys(source, spec)
            # Where the log is bucketed by more than the merge's key, its join would shuffle
            # the target: only the versions that the source meets take part.
            coarse = unique and set(tbl.keys) != set(spec.keys)
            target = tbl.target(batch, unkeyed=semantics == "corrected", met_by=source if coarse else None)
            res = scd2_merge(target, source, spec, now, semantics, unique_source_keys=unique, stored_by_key=not coarse)

            def check(hits: int) -> None:
                if hits > 1 and semantics == "reference" and on_multi_match == "error":
                    raise MultiMatchError(f"{name}: a target row would be updated by several source rows")

            tbl.append(batch, res.changes(), check)
        finally:
            if cache_source:
                source.unpersist()

    @staticmethod
    def _unique_keys(source: DataFrame, spec) -> bool:
        """At most one source row per non-NULL key (NULL keys never match).

        A source-only aggregate: when it holds, no target row can be hit
        twice and the merge takes its one-join plan.
        """
        keyed = source
        for k in spec.keys:
            keyed = keyed.where(F.col(k).isNotNull())
        return keyed.groupBy(*spec.keys).count().where("count > 1").isEmpty()

    def refresh(self, name: str, bronze: DataFrame, batch: str) -> None:
        tbl = self.table(name)
        tbl.previous_for(batch)  # a late re-run of an older batch is refused, as in a merge
        tbl.write_batch(batch, {"data": refresh(bronze, name)})

    def load(self, name: str, bronze: DataFrame, batch: str, now: dt.datetime,
             semantics: str = "reference") -> None:
        if name in SCD2_TABLES:
            self.merge(name, bronze, batch, now, semantics)
        else:
            self.refresh(name, bronze, batch)
