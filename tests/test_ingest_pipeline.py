"""Ingest, landing, archive, audit, logs, and a two-day pipeline run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.conf import CONTROL_COLUMNS, CONTROL_ROWS, control_dicts
from strata.plans.pipeline import Layout, run_day
from strata.schemas import BRONZE
from strata.sinks.audit import PipelineLog, read_audit
from strata.sinks.landing import archive_landing, land_json, read_archive
from strata.sources.bronze import read_bronze, register_bronze
from strata.sources.ingest import (
    DEFAULT_WATERMARK, FrameSource, active_rows, config_active_tables, extract,
    latest_watermark, read_control,
)
from strata.functions.columns import empty_frame
from strata.schemas import AUDIT_LOG

D1, D2 = dt.date(2024, 2, 24), dt.date(2024, 2, 25)
C1, C2 = dt.datetime(2024, 2, 24, 9), dt.datetime(2024, 2, 25, 9)   # after the seed rows (08:00)


def orders_source(spark):
    rows = [(1, 10, dt.datetime(2024, 2, 23, 10), 5.0, dt.datetime(2024, 2, 23, 10)),
            (2, 11, dt.datetime(2024, 2, 24, 12), 7.5, dt.datetime(2024, 2, 24, 12)),
            (3, 12, dt.datetime(2024, 2, 25, 1), 1.0, dt.datetime(2024, 2, 25, 1))]
    return spark.createDataFrame(
        rows, "order_id bigint, customer_id bigint, order_date timestamp_ntz, "
              "total_amount double, updated_at timestamp_ntz")


def test_control_table_csv(spark, tmp_root):
    path = f"{tmp_root}/config.csv"
    lines = [",".join(CONTROL_COLUMNS)] + [",".join(r) for r in CONTROL_ROWS]
    lines.append("shop,shop_db,old_table,Full Load,,0,x")
    spark.createDataFrame([(ln,) for ln in lines], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    control = read_control(spark, path)
    assert config_active_tables(control).count() == len(CONTROL_ROWS)
    assert [r["tablename"] for r in active_rows(control)][:2] == ["products", "categories"]


def test_extract_full_and_incremental(spark):
    src = FrameSource({"orders": orders_source(spark)})
    assert extract(src, "orders", "Full Load", None, None).count() == 3
    assert extract(src, "orders", "FULL LOAD", None, None).count() == 3
    inc = extract(src, "orders", "Incremental", "updated_at", "2024-02-24 12:00:00")
    assert [r.order_id for r in inc.collect()] == [3]          # strict >
    assert extract(src, "orders", "weird", "updated_at", None).count() == 3


def test_incremental_filter_reaches_parquet_scan(spark, tmp_root):
    orders_source(spark).write.parquet(f"{tmp_root}/ops")
    src = FrameSource({"orders": spark.read.parquet(f"{tmp_root}/ops")})
    plan = extract(src, "orders", "Incremental", "updated_at", "2024-02-24 00:00:00") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(updated_at), GreaterThan(updated_at" in plan


def test_watermark_default_and_latest(spark):
    empty = empty_frame(spark, AUDIT_LOG)
    assert latest_watermark(empty, "orders") == DEFAULT_WATERMARK
    audit = spark.createDataFrame(
        [("orders", "Incremental", 3, C1, "SUCCESS"), ("orders", "Incremental", 1, C2, "SUCCESS"),
         ("customers", "Incremental", 2, C2, "SUCCESS")], AUDIT_LOG)
    assert latest_watermark(audit, "orders") == "2024-02-25 09:00:00"


def test_land_json_writes_epoch_millis_and_bronze_reads_text(spark, tmp_root):
    n = land_json(orders_source(spark), tmp_root, "orders", D1)
    assert n == 3
    raw = spark.read.json(f"{tmp_root}/orders/*.json")
    assert dict(raw.dtypes)["updated_at"] == "bigint"
    b = read_bronze(spark, tmp_root, "orders").orderBy("order_id").collect()
    assert b[0].updated_at == "1708682400000"       # 2024-02-23 10:00 UTC


def test_landed_lines_are_packed_and_read_as_before(spark, tmp_root):
    import glob
    land_json(orders_source(spark), tmp_root, "orders", D1)
    held = glob.glob(f"{tmp_root}/orders/*.json/part-*")
    assert held and all(f.endswith(".json.gz") for f in held)
    assert read_bronze(spark, tmp_root, "orders").count() == 3


def test_archive_moves_every_row_once(spark, tmp_root):
    landing, archive = f"{tmp_root}/landing", f"{tmp_root}/archive"
    land_json(orders_source(spark), landing, "orders", D1)
    assert archive_landing(spark, landing, archive, "orders") == 3
    assert read_bronze(spark, landing, "orders").count() == 0
    land_json(orders_source(spark).limit(2), landing, "orders", D2)
    assert archive_landing(spark, landing, archive, "orders") == 2
    got = read_archive(spark, archive, "orders", BRONZE["orders"]) \
        .groupBy("year", "month", "day").count().orderBy("day").collect()
    assert [(r.year, r.month, r.day, r["count"]) for r in got] == \
        [("2024", "02", "24", 3), ("2024", "02", "25", 2)]
    # A second landing of the same day joins the first.
    land_json(orders_source(spark), landing, "orders", D2)
    assert archive_landing(spark, landing, archive, "orders") == 3
    got = read_archive(spark, archive, "orders", BRONZE["orders"]) \
        .groupBy("file").count().orderBy("file").collect()
    assert [(r.file, r["count"]) for r in got] == \
        [("orders_24022024.json", 3), ("orders_25022024.json", 5)]


def test_register_bronze_sql_tables(spark, tmp_root):
    land_json(orders_source(spark), tmp_root, "orders", D1)
    register_bronze(spark, tmp_root, "bronze_t")
    assert spark.sql("SELECT count(*) FROM bronze_t.orders").first()[0] == 3


def test_pipeline_log_flush(spark, tmp_root):
    log = PipelineLog(clock=lambda: C1)
    log.event("INFO", "hello", "orders")
    log.flush(spark, f"{tmp_root}/plog", f"{tmp_root}/logs")
    assert spark.read.parquet(f"{tmp_root}/plog").count() == 1
    assert spark.read.json(f"{tmp_root}/logs/*.json").first().message == "hello"


def test_two_day_pipeline(spark, tmp_root):
    from tests import seed
    bronze = seed.bronze(spark)
    # Operational shape: millisecond text back to timestamps.
    ops = {}
    for t, df in bronze.items():
        cols = [F.timestamp_millis(F.col(c).cast("bigint")).cast("timestamp_ntz").alias(c)
                if c in ("updated_at", "last_updated", "created_at") else F.col(c)
                for c in df.columns]
        ops[t] = df.select(cols)
    reviews = f"{tmp_root}/feed"
    spark.createDataFrame([("r1", 1, 101, 5, "great", "1708761600000"),
                           ("r2", 2, 101, 2, "bad", "1708761600000")],
                          "id string, customer_id bigint, product_id bigint, rating bigint, "
                          "review_text string, review_date string").write.json(reviews)
    layout = Layout(f"{tmp_root}/lake")
    src = FrameSource(ops)
    marts = run_day(spark, layout, src, control_dicts(), D1, C1, reviews, dt.date(2024, 3, 1))
    assert marts["sales_summary"].count() == 9
    rs = {r.product_id: r for r in marts["customer_reviews_summary"].collect()}
    assert (rs[101].avg_rating, rs[101].positive_reviews, rs[101].negative_reviews) == \
        (3.5, 1, 1)
    # Day 2: incremental tables bring nothing new; full loads land again.
    run_day(spark, layout, src, control_dicts(), D2, C2, None, dt.date(2024, 3, 1))
    audit = read_audit(spark, layout.audit).where(F.col("load_timestamp") == C2)
    counts = {r.tablename: r.record_count for r in audit.collect()}
    assert counts["orders"] == 0 and counts["products"] == 20
    assert spark.read.parquet(layout.pipeline_logs).count() > 0
    # Gold keeps one committed version per run; "ignore" freezes an existing mart.
    from strata.plans.pipeline import run_gold
    from strata.plans.silver import SilverStore
    from strata.sinks.tables import BatchTable
    mart = BatchTable(spark, layout.gold("sales_summary"), marts["sales_summary"].schema)
    assert mart.committed() == ["20240224", "20240225"]
    run_gold(spark, layout, SilverStore(spark, layout.silver), dt.date(2024, 3, 1),
             if_exists="ignore", batch="later")
    assert mart.committed() == ["20240224", "20240225"]
