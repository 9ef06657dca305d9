"""Slowly changing tables as a bucketed log of versions.

A merge only adds rows: a version that begins (``is_active`` TRUE) or the
closed copy of a version that ends (``is_active`` FALSE, with its end date).
Nothing is rewritten, so a merge costs what it changes, plus one scan of the
log. The log is one Parquet table that Spark buckets and sorts by the key: a
scan of any batches of it is already partitioned by the key, so neither the
merge's join nor the pass that resolves the log shuffles the target.

A version is closed if the log holds a closed copy of it, that is, a row equal
in every column but the end date and the flag. (Equal versions are hit by the
same source rows, so they close together.)

``compact`` writes the active versions as a new base and moves closed ones to
the history, after which reads and merges start from that base. It is due when
the rows added since the last base pass ``COMPACT_AT`` of it.

Layout: ``<root>/log/part=<attempt>`` is bucketed; ``part=<attempt>-loose``
holds rows with a NULL key, which no merge ever matches, dealt evenly instead
of into one bucket; ``part=<attempt>-old`` the history a compaction moved. The
manifest is that of ``BatchTable``: a part counts once its commit names it.
The session catalog only learns where the log lies and which parts are
committed; another session registers the same folder again.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata import storage
from strata.sinks.tables import BatchTable

#: Share of the base that later batches may add before the next compaction.
COMPACT_AT = 0.5
#: A log has one bucket for each shuffle partition, but no more than so many for each core.
BUCKETS_PER_CORE = 4


def _rows(entry, *kinds: str) -> int:
    """Rows of some kinds that one commit counted."""
    return sum((entry["rows"] or {}).get(k, 0) for k in kinds)


class VersionLog(BatchTable):
    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: tuple[str, ...],
                 match: tuple[str, ...] | None = None):
        """``keys`` bucket the log; rows whose ``match`` columns hold a NULL are loose."""
        super().__init__(spark, root, schema)
        self.keys, self.match = keys, match or keys

    # -- the log as a table of the session catalog ----------------------------
    def _new_buckets(self) -> int:
        cores = max(8, self.spark.sparkContext.defaultParallelism)
        return min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), BUCKETS_PER_CORE * cores)

    def _table(self, buckets: int) -> str:
        where = f"{self.root}/log"
        name = f"strata_log_{hashlib.sha256(f'{where} {buckets}'.encode()).hexdigest()[:20]}"
        if not self.spark.catalog.tableExists(f"spark_catalog.default.{name}"):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            by = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE spark_catalog.default.{name} ({columns}, `part` string) USING parquet "
                f"PARTITIONED BY (part) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
                f"LOCATION '{where}'")
        return f"spark_catalog.default.{name}"

    def _log(self, entries: list) -> DataFrame | None:
        """The bucketed rows of the given commits."""
        parts = [e["attempt"] for e in entries if _rows(e, "active", "history")]
        if not parts:
            return None
        self._must_exist(parts)  # before they are added, which would create a folder
        table = self._table(entries[0]["buckets"])
        named = " ".join(f"PARTITION (part = '{p}')" for p in parts)
        self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {named}")
        return self.spark.table(table).where(F.col("part").isin(parts)).select(*self.schema.fieldNames())

    def _must_exist(self, parts: list[str]) -> None:
        """A committed part that is gone is an error, not an empty part."""
        for p in parts:
            if not storage.exists(self.spark, f"{self.root}/log/part={p}"):
                raise FileNotFoundError(f"PATH_NOT_FOUND: {self.root}/log/part={p} is committed but gone")

    def _plain(self, entries: list, name: str) -> DataFrame | None:
        kinds, by = (("loose", "closed"), "loose") if name == "loose" else ((name,), "attempt")
        parts = [f"{self.root}/log/part={e[by]}-{name}" for e in entries if _rows(e, *kinds)]
        return self.spark.read.schema(self.schema).parquet(*parts) if parts else None

    # -- reading ------------------------------------------------------------------
    @staticmethod
    def _since_base(entries: list) -> list:
        first = max((i for i, e in enumerate(entries) if e["base"]), default=0)
        return entries[first:]

    def _open(self, rows: DataFrame, closed: bool) -> DataFrame:
        """Versions that no closed copy ends, and with ``closed`` the closed copies, too."""
        same = [c for c in self.schema.fieldNames() if c not in ("effective_end_date", "is_active")]
        ends = F.count(F.when(~F.col("is_active"), 1)).over(Window.partitionBy(*same))
        keep = (F.col("_ends") == 0) | (~F.col("is_active") if closed else F.lit(False))
        return rows.withColumn("_ends", ends).where(keep).drop("_ends")

    def _keyed(self, entries: list, closed: bool, met_by: DataFrame | None = None) -> DataFrame | None:
        since = self._since_base(entries)
        log = self._log(since)
        if log is not None and met_by is not None:
            # Equal versions have equal keys, so what is left out here closes nothing that stays.
            log = log.join(met_by.select(*self.match), list(self.match), "left_semi").select(*self.schema.fieldNames())
        return self._open(log, closed) if log is not None and any(_rows(e, "history") for e in since) else log

    def _unkeyed(self, entries: list, closed: bool) -> DataFrame | None:
        loose = self._plain(entries, "loose")
        return self._open(loose, closed) if loose is not None and any(_rows(e, "closed") for e in entries) else loose

    def _union(self, *frames: DataFrame | None) -> DataFrame:
        found = [f for f in frames if f is not None]
        out = found[0] if found else self.empty()
        for f in found[1:]:
            out = out.unionByName(f)
        return out

    def read(self, kinds: dict[str, str] | None = None) -> DataFrame:
        """All versions; or only ``history`` or ``active`` ones."""
        entries = self._manifest()
        if kinds is not None and "active" not in kinds:
            log = self._log(self._since_base(entries))
            loose = self._plain(entries, "loose")
            return self._union(self._plain(entries, "old"), *[
                x.where("NOT is_active") for x in (log, loose) if x is not None])
        if kinds is not None and "history" not in kinds:
            return self._union(self._keyed(entries, False), self._unkeyed(entries, False))
        return self._union(self._plain(entries, "old"), self._keyed(entries, True), self._unkeyed(entries, True))

    def as_sql(self) -> str:
        """All versions as of now, as a query for a view: the log resolved, loose and moved rows beside it."""
        entries = self._manifest()
        since, cols = self._since_base(entries), self._columns_sql()
        parts = [e["attempt"] for e in since if _rows(e, "active", "history")]
        same = ", ".join(f"`{c}`" for c in self.schema.fieldNames() if c not in ("effective_end_date", "is_active"))
        ends = f"count(CASE WHEN NOT is_active THEN 1 END) OVER (PARTITION BY {same})"
        resolve = lambda rows: (f"SELECT {cols} FROM (SELECT {cols}, {ends} AS _ends FROM {rows}) "  # noqa: E731
                                "WHERE _ends = 0 OR NOT is_active")
        out = self._folders_sql([f"{self.root}/log/part={e['attempt']}-old" for e in entries if _rows(e, "old")])
        if parts:
            self._log(since)  # the log's table knows these parts
            listed = ", ".join(f"'{p}'" for p in parts)
            out.append(resolve(f"(SELECT * FROM {self._table(since[0]['buckets'])} WHERE part IN ({listed}))"))
        loose = self._folders_sql([f"{self.root}/log/part={e['loose']}-loose" for e in entries if _rows(e, "loose", "closed")])
        if loose:
            out.append(resolve(f"({' UNION ALL '.join(loose)})"))
        return " UNION ALL ".join(out) or self._empty_sql()

    def target(self, batch: str, unkeyed: bool = False, met_by: DataFrame | None = None) -> DataFrame:
        """Open versions before ``batch``; those without a key only if asked for,
        and with ``met_by`` only those with a match key in it."""
        entries = self._before(self._manifest(), batch)
        return self._union(self._keyed(entries, False, met_by), self._unkeyed(entries, False) if unkeyed else None)

    # -- writing -----------------------------------------------------------------
    def _write(self, rows: DataFrame, base: bool, buckets: int,
               distinct: bool = False) -> tuple[str, dict[str, int], int]:
        """Write rows (``kind``: history, active; maybe ``n_hits``) as one attempt, equal
        ones once if ``distinct``: they are dealt to one bucket, so this needs no shuffle of its own."""
        attempt = uuid.uuid4().hex[:12]
        known = F.lit(True)
        for k in self.match:
            known = known & F.col(k).isNotNull()
        ended = F.col("kind") == "history"
        kind = F.when(~known, F.when(ended, "closed").otherwise("loose")) \
            .when(ended, F.lit("old" if base else "history")).otherwise("active")
        part = F.when(F.col("_kind").isin("loose", "closed"), f"{attempt}-loose") \
            .when(F.col("_kind") == "old", f"{attempt}-old").otherwise(attempt)
        if "n_hits" not in rows.columns:
            rows = rows.withColumn("n_hits", F.lit(0).cast("long"))
        # Rows without a key are dealt by their other columns.
        types = dict(rows.dtypes)
        spread = F.xxhash64(*self.schema.fieldNames())
        deal = [F.coalesce(F.col(k), F.when(~known, spread).cast(types[k])).alias(f"_d{i}")
                for i, k in enumerate(self.keys)]
        named = rows.withColumn("_kind", kind).select("*", part.alias("part"), *deal)
        # Observed behind the shuffle: adaptive execution drops what is before an empty one.
        obs = Observation(f"rows_{attempt}")
        count = lambda k: F.count(F.when(F.col("_kind") == k, 1)).alias(k)
        dealt = named.repartition(buckets, *[f"_d{i}" for i in range(len(deal))])
        out = (dealt.distinct() if distinct else dealt).observe(
            obs, *[count(k) for k in ("active", "history", "loose", "closed", "old")], F.max("n_hits").alias("hits"))
        out.select(*self.schema.fieldNames(), "part").write.insertInto(self._table(buckets))
        counts = {k: int(v) for k, v in obs.get.items() if k != "hits" and v}
        return attempt, counts, int(obs.get["hits"] or 0)

    def append(self, batch: str, changes: DataFrame, check=None, distinct: bool = False) -> None:
        """Add one batch's changes and commit them, equal rows once if ``distinct``.
        ``check(hits)`` may raise on the largest number of hits before anything counts."""
        done = self._manifest()
        before = self._before(done, batch)
        buckets = before[0]["buckets"] if before else self._new_buckets()
        attempt, rows, hits = self._write(changes, not before, buckets, distinct)
        if check is not None:
            check(hits)
        entry = Row(seq=self._next(done), batch=batch, attempt=attempt, rows=rows, base=not before,
                    buckets=buckets, loose=attempt)
        self._commit(entry)
        since = self._since_base([*before, entry])
        size = lambda e: _rows(e, "active", "history")
        if sum(map(size, since[1:])) > COMPACT_AT * size(since[0]):
            self._rebase([*before, entry])

    def compact(self) -> None:
        """Commit the state of the latest batch once more, as a new base."""
        entries = self._manifest()
        if entries and not entries[-1]["base"]:
            self._rebase(entries)

    def _rebase(self, entries: list) -> None:
        state, last = self._keyed(entries, True), entries[-1]
        if state is None:
            return
        rows = state.withColumn("kind", F.when(F.col("is_active"), "active").otherwise("history"))
        attempt, counts, _ = self._write(rows, True, last["buckets"])
        counts |= {k: _rows(last, k) for k in ("loose", "closed") if _rows(last, k)}
        self._commit(Row(seq=self._next(entries), batch=last["batch"], attempt=attempt, rows=counts, base=True,
                         buckets=last["buckets"], loose=last["loose"]))
