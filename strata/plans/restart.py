"""A daily run that can be stopped anywhere and started again.

Each step leaves a mark that its next run reads, so a repeated day does only
what is missing and ends with the rows of an unbroken one:

* landing: a file that landed whole has Spark's ``_SUCCESS``; it is not
  extracted again.
* silver: a Structured Streaming query per table reads the landing files
  (``availableNow``, ``foreachBatch``). Its checkpoint says which files have
  been merged. A micro-batch is one merge, named by its number, so a merge that
  was committed before the checkpoint moved on is replaced by itself.
* audit: a load's row, and with it the watermark of the next extract, is
  added when silver holds the load, once for each table and run clock.
* archive: files move after silver has them, at the next day's beginning.

Files that a broken day left are merged before the next day lands, as a batch
of their own. Full refreshes read their table's newest landing file.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import storage
from strata.plans.pipeline import Layout, run_gold
from strata.plans.silver import SilverStore
from strata.schemas import BRONZE, JSON_TABLES, REFRESH_TABLES, SCD2_TABLES
from strata.sinks.audit import PipelineLog, append_audit, audit_row, read_audit, reject_row
from strata.sinks.landing import archive_landing, land_json, landing_file, reviews_file
from strata.sources.bronze import bad_lines, bronze_glob, good_rows, with_file, write_rejects
from strata.sources.ingest import FULL_LOAD, Source, extract, latest_watermark
from strata.sources.reviews import ingest_reviews


class RestartableDay:
    def __init__(self, spark: SparkSession, layout: Layout, source: Source, control: list[dict],
                 step=lambda name: None):
        """``step`` is called after every step with its name; tests stop a run there."""
        self.spark, self.layout, self.source, self.step = spark, layout, source, step
        self.control = [r for r in control if r.get("is_active") == "1"]
        self.tables = [r["tablename"] for r in self.control]

    # -- landing and audit ---------------------------------------------------------
    def _audited(self, table: str, load_type: str, now: dt.datetime) -> bool:
        """Whether the load at ``now`` is in the audit log (one small table)."""
        rows = read_audit(self.spark, self.layout.audit)
        here = (F.col("tablename") == table) & (F.col("load_type") == load_type) & \
            (F.col("load_timestamp") == F.lit(str(now)).cast("timestamp_ntz"))
        return not rows.where(here).isEmpty()

    def _land(self, row: dict, day: dt.date, now: dt.datetime, log: PipelineLog) -> None:
        table, load_type = row["tablename"], row["loadtype"]
        path = landing_file(self.layout.landing, table, day)
        if storage.exists(self.spark, f"{path}/_SUCCESS") or self._audited(table, load_type, now):
            log.event("INFO", f"{table} of {day} has landed before", table)
            return
        wm = None
        if (load_type or "").strip().lower() != FULL_LOAD:
            wm = latest_watermark(read_audit(self.spark, self.layout.audit), table)
        log.event("INFO", f"extract of {table} starts past {wm}" if wm else f"extract of {table} starts", table)
        n = land_json(extract(self.source, table, load_type, row["watermark"], wm), self.layout.landing, table, day)
        log.event("SUCCESS", f"landed {n} rows", table)
        self.step(f"land {table}")

    def _audit(self, row: dict, day: dt.date, now: dt.datetime, log: PipelineLog) -> None:
        table, load_type = row["tablename"], row["loadtype"]
        path = landing_file(self.layout.landing, table, day)
        if self._audited(table, load_type, now) or not storage.exists(self.spark, path):
            return
        held = storage.files(self.spark, path)
        n = self.spark.read.text(held).count() if held else 0
        append_audit(self.spark, self.layout.audit, audit_row(self.spark, table, load_type, n, now))
        log.event("SUCCESS", f"audit log updated for {table}", table)
        self.step(f"audit {table}")

    # -- silver ------------------------------------------------------------------------
    def _stream(self, table: str) -> DataFrame | None:
        """Landing files as a stream of lines (JSON) or rows (snapshots)."""
        glob = bronze_glob(self.layout.landing, table)
        if not storage.matches(self.spark, glob):
            return None
        if table in JSON_TABLES:
            return with_file(self.spark.readStream.text(glob))
        return self.spark.readStream.schema(BRONZE[table]).parquet(glob)

    def merge_landed(self, table: str, now: dt.datetime, log: PipelineLog) -> None:
        """Merge the landing files that silver does not hold yet."""
        stream = self._stream(table)
        if stream is None:
            return

        def merge(rows: DataFrame, number: int) -> None:
            batch, spark = f"{number:010d}", rows.sparkSession
            if table in JSON_TABLES:
                self._reject(spark, bad_lines(rows, table), table, batch, now, log)
                rows = good_rows(rows, table)
            SilverStore(spark, self.layout.silver).merge(table, rows, batch, now)
            self.step(f"commit {table}")

        query = stream.writeStream.foreachBatch(merge).trigger(availableNow=True) \
            .option("checkpointLocation", f"{self.layout.root}/checkpoints/{table}").start()
        query.awaitTermination()
        self.step(f"merge {table}")

    def _refresh(self, table: str, day: dt.date, now: dt.datetime, log: PipelineLog) -> None:
        path, batch = landing_file(self.layout.landing, table, day), f"{day:%Y%m%d}"
        store = SilverStore(self.spark, self.layout.silver)
        if batch in store.table(table).committed() or not storage.exists(self.spark, path):
            return
        lines = with_file(self.spark.read.text(path))
        self._reject(self.spark, bad_lines(lines, table), table, batch, now, log)
        store.refresh(table, good_rows(lines, table), batch)
        self.step(f"refresh {table}")

    def _reject(self, spark, bad: DataFrame, table: str, batch: str, now: dt.datetime, log: PipelineLog) -> None:
        n = write_rejects(bad, self.layout.rejects, table, batch)
        if n and not self._audited(f"{table}_rejects", "rejects", now):
            append_audit(spark, self.layout.audit, reject_row(spark, table, n, now))
            log.event("WARNING", f"{n} broken lines kept apart", table)

    # -- the day -------------------------------------------------------------------------
    def _silver(self, day: dt.date | None, now: dt.datetime, log: PipelineLog) -> None:
        for t in REFRESH_TABLES:
            if day is not None and t in self.tables:
                self._refresh(t, day, now, log)
        for t in SCD2_TABLES:
            if t in self.tables or t not in JSON_TABLES:
                self.merge_landed(t, now, log)

    def ingest(self, day: dt.date, now: dt.datetime, reviews_path: str | None = None,
               multi_line: bool = False, on_error: str = "raise", log: PipelineLog | None = None) -> SilverStore:
        """Land, merge and audit one day. With ``on_error="continue"`` a table
        that cannot be extracted is logged and the others go on."""
        log = log or PipelineLog(clock=lambda: now)
        self._silver(None, now, log)  # what a broken day left
        for row in self.control:
            table = row["tablename"]
            today = landing_file(self.layout.landing, table, day).rsplit("/", 1)[1]
            moved = archive_landing(self.spark, self.layout.landing, self.layout.archive, table, keep=today)
            log.event("INFO", f"archived {moved} lines of earlier landing files" if moved else "nothing to archive", table)
            try:
                self._land(row, day, now, log)
            except Exception as e:
                log.event("ERROR", f"error processing {table}: {e}", table)
                if on_error == "raise":
                    raise
        if reviews_path and not storage.exists(self.spark, f"{reviews_file(self.layout.landing, day)}/_SUCCESS"):
            n = ingest_reviews(self.spark, reviews_path, self.layout.landing, day, multi_line)
            log.event("SUCCESS", f"landed {n} review records", "customer_reviews")
            self.step("land customer_reviews")
        self._silver(day, now, log)
        for row in self.control:
            self._audit(row, day, now, log)
        return SilverStore(self.spark, self.layout.silver)

    def run(self, day: dt.date, now: dt.datetime, reviews_path: str | None = None, as_of: dt.date | None = None,
            multi_line: bool = False, on_error: str = "raise", if_exists: str = "overwrite") -> dict[str, DataFrame]:
        log = PipelineLog(clock=lambda: now)
        try:
            store = self.ingest(day, now, reviews_path, multi_line, on_error, log)
            return run_gold(self.spark, self.layout, store, as_of or day, if_exists, f"{day:%Y%m%d}")
        finally:
            log.flush(self.spark, self.layout.pipeline_logs, self.layout.log_files)
