"""One daily run in logical order: ingest -> bronze -> silver -> gold.

Layout below a lakehouse root on shared storage::

    landing/  archive/  rejects/  audit_log/  pipeline_logs/  logs/  silver/<table>/  gold/<mart>/

Only the control rows (a handful) and one watermark value per table reach
the driver; every data movement is a distributed read or write. Logs are
flushed in ``finally``, so a failed run still leaves its log.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.plans import gold
from strata.plans.silver import SilverStore
from strata.schemas import JSON_TABLES, REFRESH_TABLES, SCD2_TABLES
from strata.sinks.audit import PipelineLog, append_audit, audit_row, read_audit, reject_row
from strata.sinks.landing import archive_landing, land_json
from strata.sinks.tables import BatchTable
from strata.sources.bronze import read_bronze, read_rejects, write_rejects
from strata.sources.ingest import Source, extract, latest_watermark
from strata.sources.reviews import ingest_reviews


@dataclass
class Layout:
    root: str

    def __post_init__(self):
        self.root = self.root.rstrip("/")

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def archive(self) -> str:
        return f"{self.root}/archive"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit_log"

    @property
    def pipeline_logs(self) -> str:
        return f"{self.root}/pipeline_logs"

    @property
    def log_files(self) -> str:
        return f"{self.root}/logs"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    def gold(self, mart: str) -> str:
        return f"{self.root}/gold/{mart}"


def ingest_table(spark: SparkSession, layout: Layout, source: Source, row: dict,
                 day: dt.date, now: dt.datetime, log: PipelineLog) -> int:
    """Archive earlier landing files, extract, land, and audit one table."""
    table, load_type, wm_col = row["tablename"], row["loadtype"], row["watermark"]
    moved = archive_landing(spark, layout.landing, layout.archive, table)
    log.event("INFO", f"archived {moved} rows of earlier landing files", table)
    wm = None
    if (load_type or "").strip().lower() != "full load":
        wm = latest_watermark(read_audit(spark, layout.audit), table)
        log.event("INFO", f"latest watermark for {table}: {wm}", table)
    df = extract(source, table, load_type, wm_col, wm)
    n = land_json(df, layout.landing, table, day)
    log.event("SUCCESS", f"landed {n} rows", table)
    append_audit(spark, layout.audit, audit_row(spark, table, load_type, n, now))
    return n


def run_ingest(spark: SparkSession, layout: Layout, source: Source, control: list[dict],
               day: dt.date, now: dt.datetime, log: PipelineLog,
               on_error: str = "raise") -> dict[str, int]:
    counts = {}
    for row in control:
        if row.get("is_active") != "1":
            continue
        try:
            counts[row["tablename"]] = ingest_table(spark, layout, source, row, day, now, log)
        except Exception as e:
            log.event("ERROR", f"error processing {row['tablename']}: {e}", row["tablename"])
            if on_error == "raise":
                raise
    return counts


def run_silver(spark: SparkSession, layout: Layout, batch: str, now: dt.datetime,
               semantics: str = "reference") -> SilverStore:
    store = SilverStore(spark, layout.silver)
    for t in REFRESH_TABLES + SCD2_TABLES:
        if t in JSON_TABLES:
            n = write_rejects(read_rejects(spark, layout.landing, t), layout.rejects, t, batch)
            if n:
                append_audit(spark, layout.audit, reject_row(spark, t, n, now))
        store.load(t, read_bronze(spark, layout.landing, t), batch, now, semantics)
    return store


def run_gold(spark: SparkSession, layout: Layout, store: SilverStore,
             as_of: dt.date, if_exists: str = "overwrite",
             batch: str | None = None) -> dict[str, DataFrame]:
    """Build the five marts as new versions and return reads of them.

    Each mart is a batch-versioned table: a run writes its own folder and
    commits it through the manifest, so readers of the previous version are
    never cut off mid-read. ``if_exists="ignore"`` keeps a mart that already
    has a version (the original's ``CREATE TABLE IF NOT EXISTS``); the
    default rebuilds.
    """
    silver = {t: store.read(t) for t in REFRESH_TABLES + SCD2_TABLES}
    batch = batch or f"{as_of:%Y%m%d}"
    out = {}
    for name, fn in gold.MARTS.items():
        df = fn(silver, as_of) if name == "customer_engagement" else fn(silver)
        table = BatchTable(spark, layout.gold(name), df.schema)
        if not (if_exists == "ignore" and table.committed()):
            table.write_batch(batch, {"data": df})
        out[name] = table.read({"data": "latest"})
    return out


def run_day(spark: SparkSession, layout: Layout, source: Source, control: list[dict],
            day: dt.date, now: dt.datetime, reviews_path: str | None = None,
            as_of: dt.date | None = None, semantics: str = "reference",
            if_exists: str = "overwrite", multi_line: bool = False,
            on_error: str = "raise") -> dict[str, DataFrame]:
    """One unbroken run. ``multi_line`` reads a reviews feed that is one JSON
    array; ``on_error="continue"`` goes on with the other tables. A run that can
    be stopped and repeated is ``plans.restart``."""
    log = PipelineLog(clock=lambda: now)
    try:
        run_ingest(spark, layout, source, control, day, now, log, on_error)
        if reviews_path:
            n = ingest_reviews(spark, reviews_path, layout.landing, day, multi_line)
            log.event("SUCCESS", f"landed {n} review records", "customer_reviews")
        batch = f"{day:%Y%m%d}"
        store = run_silver(spark, layout, batch, now, semantics)
        return run_gold(spark, layout, store, as_of or day, if_exists, batch)
    finally:
        log.flush(spark, layout.pipeline_logs, layout.log_files)

