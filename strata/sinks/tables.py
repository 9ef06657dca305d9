"""Batch-versioned Parquet tables on shared storage.

A table is a folder of batches, ``<root>/batch=<id>/attempt=<name>/kind=<part>/``,
plus an append-only manifest ``<root>/_manifest/`` that lists committed
batches in order: the attempt that counts and the row count of each part.
Every run of a batch writes a folder of its own, so a failed run leaves the
committed one as it was; the manifest row is appended last and is the commit
point. Nothing that was committed is ever overwritten.

Reads name the committed attempts' folders. A part that the manifest counts
rows of must be there: a lost folder is an error, not an empty table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, MapType, StringType, StructField, StructType

from strata import storage
from strata.functions.columns import empty_frame

_MANIFEST = StructType([
    StructField("seq", LongType()), StructField("batch", StringType()),
    StructField("attempt", StringType()), StructField("rows", MapType(StringType(), LongType())),
    # of a version log only (``sinks.versions``)
    StructField("base", BooleanType()), StructField("buckets", LongType()), StructField("loose", StringType())])


class BatchTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    # -- manifest ---------------------------------------------------------
    def _manifest(self) -> list:
        """The last commit of each batch, oldest first (one small row a commit)."""
        if not storage.exists(self.spark, f"{self.root}/_manifest"):
            return []
        rows = self.spark.read.schema(_MANIFEST).json(f"{self.root}/_manifest").collect()
        last = {r["batch"]: r for r in sorted(rows, key=lambda r: r["seq"])}
        return sorted(last.values(), key=lambda r: r["seq"])

    def committed(self) -> list[str]:
        """Committed batch ids, oldest first."""
        return [r["batch"] for r in self._manifest()]

    @staticmethod
    def _next(entries: list) -> int:
        return max((r["seq"] for r in entries), default=0) + 1

    def _commit(self, entry: Row) -> None:
        name = f"commit-{entry['seq']:012d}-{entry['attempt']}.json"
        storage.write_small(self.spark, f"{self.root}/_manifest", name, json.dumps(entry.asDict()) + "\n")

    # -- as SQL ----------------------------------------------------------
    def _empty_sql(self) -> str:
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schema.fields)
        return f"SELECT {nulls} WHERE FALSE"

    def _columns_sql(self) -> str:
        return ", ".join(f"`{c}`" for c in self.schema.fieldNames())

    def _folders_sql(self, folders: list[str]) -> list[str]:
        return [f"SELECT {self._columns_sql()} FROM parquet.`{f}`" for f in folders]

    def as_sql(self) -> str:
        """The latest committed version as a query for a view."""
        last = [e for e in self._manifest()[-1:] if (e["rows"] or {}).get("data")]
        return " UNION ALL ".join(self._folders_sql(
            [f"{self.root}/batch={e['batch']}/attempt={e['attempt']}/kind=data" for e in last])) or self._empty_sql()

    # -- data ---------------------------------------------------------------
    def _full_schema(self) -> StructType:
        return StructType(list(self.schema.fields) + [
            StructField("batch", StringType()), StructField("attempt", StringType()),
            StructField("kind", StringType())])

    def empty(self) -> DataFrame:
        return empty_frame(self.spark, self.schema)

    def read(self, kinds: dict[str, str] | None = None) -> DataFrame:
        """Rows of the given parts; ``kinds`` maps part -> "latest" | "all"."""
        done = self._manifest()
        frames = []
        for kind, which in (kinds or {"data": "latest"}).items():
            # Only committed folders are listed. A part without rows has no
            # folder and is skipped; the partition filter keeps the read exact.
            full = [e for e in (done[-1:] if which == "latest" else done) if (e["rows"] or {}).get(kind)]
            if not full:
                continue
            df = (self.spark.read.schema(self._full_schema()).option("basePath", self.root)
                  .parquet(*[f"{self.root}/batch={e['batch']}/attempt={e['attempt']}/kind={kind}" for e in full]))
            frames.append(df.where((F.col("kind") == kind) & F.col("batch").isin([e["batch"] for e in full])))
        if not frames:
            return self.empty()
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out.select(*self.schema.fieldNames())

    @staticmethod
    def _before(entries: list, batch: str) -> list:
        """Commits that a new run of ``batch`` builds on (never itself)."""
        if any(e["batch"] == batch for e in entries[:-1]):
            raise ValueError(f"batch {batch} is committed and not the latest; "
                             "re-running it would rewrite history")
        return [e for e in entries if e["batch"] != batch]

    def previous_for(self, batch: str) -> list[str]:
        return [e["batch"] for e in self._before(self._manifest(), batch)]

    def write_batch(self, batch: str, parts: dict[str, DataFrame] | DataFrame) -> None:
        """Write every part of one batch in a single job, then commit.

        ``parts`` maps part name -> rows, or is one frame whose ``kind``
        column names the part of each row.
        """
        if isinstance(parts, DataFrame):
            out = parts.select(*self.schema.fieldNames(), "kind")
        else:
            frames = [df.select(*self.schema.fieldNames()).withColumn("kind", F.lit(k))
                      for k, df in parts.items()]
            out = frames[0]
            for f in frames[1:]:
                out = out.unionByName(f)
        attempt = uuid.uuid4().hex[:12]
        path = f"{self.root}/batch={batch}/attempt={attempt}"
        out.write.partitionBy("kind").parquet(path)
        counts = self.spark.read.schema(StructType([StructField("kind", StringType())])) \
            .parquet(path).groupBy("kind").count().collect()
        rows = {r["kind"]: r["count"] for r in counts}
        self._commit(Row(seq=self._next(self._manifest()), batch=batch, attempt=attempt, rows=rows,
                         base=None, buckets=None, loose=None))
