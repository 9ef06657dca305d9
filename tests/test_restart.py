"""A day that is stopped after every step ends like an unbroken one; broken lines stay out of silver."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata import storage
from strata.conf import control_dicts
from strata.plans.pipeline import Layout, run_ingest, run_silver
from strata.plans.restart import RestartableDay
from strata.plans.silver import SilverStore
from strata.sinks.audit import PipelineLog, read_audit
from strata.sinks.landing import landing_file, read_archived_lines
from strata.sources.bronze import read_bronze, read_rejects
from strata.sources.ingest import FrameSource, latest_watermark

DAYS = [(dt.date(2024, 2, 24), dt.datetime(2024, 2, 24, 9)), (dt.date(2024, 2, 25), dt.datetime(2024, 2, 25, 9))]
CONTROL = [r for r in control_dicts() if r["tablename"] in ("orders", "products")]
SILVER = ("orders", "products", "customer_reviews")


def source(spark, later: bool):
    orders = [(i, i % 3, dt.datetime(2024, 2, 23, i % 24), 1.0 * i, dt.datetime(2024, 2, 23, 10)) for i in range(20)]
    if later:  # two orders change after the first load, one is new
        orders[:2] = [(i, 9, dt.datetime(2024, 2, 23), 5.0, dt.datetime(2024, 2, 25, 8)) for i in range(2)]
        orders.append((77, 1, dt.datetime(2024, 2, 25), 7.0, dt.datetime(2024, 2, 25, 8)))
    products = [(i, f"p{i}", i % 2, 2.5, dt.datetime(2024, 1, 1)) for i in range(5 + later)]
    return FrameSource({
        "orders": spark.createDataFrame(orders, "order_id bigint, customer_id bigint, order_date timestamp_ntz, "
                                                "total_amount double, updated_at timestamp_ntz"),
        "products": spark.createDataFrame(products, "product_id bigint, name string, category_id bigint, "
                                                    "price double, updated_at timestamp_ntz")})


def feed(spark, path, day):
    rows = [(f"r{i}", i, i % 5, 1 + (i + day * (i % 4 == 0)) % 5, "text", "1708761600000") for i in range(10 + day)]
    spark.createDataFrame(rows, "id string, customer_id bigint, product_id bigint, rating bigint, review_text string, "
                                "review_date string").write.json(path)
    return path


def two_days(spark, root, stop_at=None):
    """Run both days; with ``stop_at`` stop once after each step it names. Returns the steps."""
    layout, seen, stopped = Layout(root), [], set()
    for n, (day, now) in enumerate(DAYS):
        reviews = feed(spark, f"{root}-feed-{n}", n)

        def step(name, n=n):
            seen.append((n, name))
            if stop_at and name in stop_at[n] and (n, name) not in stopped:
                stopped.add((n, name))
                raise InterruptedError(name)

        while True:
            before = len(stopped)
            try:
                RestartableDay(spark, layout, source(spark, n == 1), CONTROL, step).ingest(day, now, reviews)
                break
            except Exception:
                if len(stopped) == before:
                    raise
    if stop_at:
        assert stopped == {(n, s) for n in (0, 1) for s in stop_at[n]}
    return layout, seen


def state(spark, layout):
    store = SilverStore(spark, layout.silver)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    return ({t: rows(store.read(t)) for t in SILVER}, rows(read_audit(spark, layout.audit)),
            {t: rows(read_archived_lines(spark, layout.archive, t)) for t in ("orders", "products")},
            {t: rows(read_bronze(spark, layout.landing, t)) for t in ("orders", "products")})


def test_a_day_stopped_after_every_step_ends_like_an_unbroken_one(spark, tmp_root):
    whole, steps = two_days(spark, f"{tmp_root}/whole")
    want = state(spark, whole)
    assert [r[2] for r in want[1] if r[0] == "orders"] == [20, 3]
    assert sum(r[-1] for r in want[0]["orders"]) == 20 - 2 + 1      # changed ones are expired until offered again
    every = {s for n, s in steps if n == 0}
    assert {"land orders", "commit orders", "merge orders", "refresh products", "merge customer_reviews", "audit orders"} <= every
    broken, _ = two_days(spark, f"{tmp_root}/broken", [every, {"land orders", "commit orders", "merge orders"}])
    assert state(spark, broken) == want


def test_the_watermark_waits_for_silver(spark, tmp_root):
    def stop(name):
        if name == "merge orders":
            raise InterruptedError(name)
    layout, (day, now) = Layout(tmp_root), DAYS[0]
    with pytest.raises(InterruptedError):
        RestartableDay(spark, layout, source(spark, False), CONTROL, stop).ingest(day, now)
    assert read_audit(spark, layout.audit).count() == 0
    RestartableDay(spark, layout, source(spark, True), CONTROL).ingest(*DAYS[1])
    # the next day merged the file the broken day left, then its own
    assert latest_watermark(read_audit(spark, layout.audit), "orders") == "2024-02-25 09:00:00"
    assert read_archived_lines(spark, layout.archive, "orders").count() == 20
    assert SilverStore(spark, layout.silver).table("orders").committed() == ["0000000000", "0000000001"]


BROKEN = ['{"order_id": 5, "customer', '{"order_id": "five"}', "no json", '{"order_id": 906, "total_amount": "much"}', "[1, 2]"]


def plant(spark, layout, day):
    lines = [*BROKEN, "", "  ", '{"order_id": 900, "customer_id": 1, "total_amount": 2.5, "updated_at": 17, "more": 1}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(landing_file(layout.landing, "orders", day))


def test_broken_lines_are_kept_apart_and_counted(spark, tmp_root):
    layout = Layout(tmp_root)
    (day, now), (other, _) = DAYS
    run_ingest(spark, layout, source(spark, False), CONTROL, day, now, PipelineLog(clock=lambda: now))
    plant(spark, layout, other)
    assert sorted(r.line for r in read_rejects(spark, layout.landing, "orders").collect()) == sorted(BROKEN)
    # also where only one column is read, which alone would look right
    assert read_bronze(spark, layout.landing, "orders").select("order_id").where("order_id = 906").count() == 0
    store = run_silver(spark, layout, "1", now)
    got = store.read("orders")
    assert got.where(F.col("order_id").isNull()).count() == 0 and got.count() == 21
    assert got.where("order_id = 900").first().updated_at == "17"
    assert spark.read.parquet(f"{layout.rejects}/orders").count() == len(BROKEN)
    audit = [tuple(r) for r in read_audit(spark, layout.audit).where("status = 'REJECTED'").collect()]
    assert audit == [("orders_rejects", "rejects", len(BROKEN), now, "REJECTED")]


def test_broken_lines_of_a_restartable_day(spark, tmp_root):
    layout, (day, now) = Layout(tmp_root), DAYS[0]
    plant(spark, layout, day - dt.timedelta(days=1))
    RestartableDay(spark, layout, source(spark, False), CONTROL).ingest(day, now)
    got = SilverStore(spark, layout.silver).read("orders")
    assert got.count() == 21 and got.where("order_id IS NULL").count() == 0
    assert spark.read.parquet(f"{layout.rejects}/orders").count() == len(BROKEN)
    # the file the day found moved into the archive as it was
    lines = read_archived_lines(spark, layout.archive, "orders")
    assert {r.value for r in lines.collect()} >= set(BROKEN)


def test_on_error_goes_on_with_the_other_tables(spark, tmp_root):
    src, layout, (day, now) = source(spark, False), Layout(tmp_root), DAYS[0]
    del src.frames["orders"]
    with pytest.raises(KeyError):
        RestartableDay(spark, layout, src, CONTROL).ingest(day, now)
    RestartableDay(spark, layout, src, CONTROL).ingest(day, now, on_error="continue")
    assert SilverStore(spark, layout.silver).read("products").count() == 5
    assert [r.tablename for r in read_audit(spark, layout.audit).collect()] == ["products"]


def test_an_array_feed(spark, tmp_root):
    path = f"{tmp_root}/feed"
    body = '[{"id":"a","customer_id":1,"product_id":2,"rating":5,"review_text":"x","review_date":"1"},\n {"id":"b"}]'
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(path)
    layout = Layout(f"{tmp_root}/lake")
    RestartableDay(spark, layout, source(spark, False), CONTROL).ingest(*DAYS[0], reviews_path=path, multi_line=True)
    assert sorted(r.id for r in SilverStore(spark, layout.silver).read("customer_reviews").collect()) == ["a", "b"]


def test_archived_files_keep_their_bytes(spark, tmp_root):
    from strata.sinks.landing import archive_landing
    layout = Layout(tmp_root)
    plant(spark, layout, DAYS[0][0])
    (path,) = storage.files(spark, landing_file(layout.landing, "orders", DAYS[0][0]))
    before = spark.read.format("binaryFile").load(path).first().content
    assert archive_landing(spark, layout.landing, layout.archive, "orders") == len(BROKEN) + 1
    kept = f"{layout.archive}/orders/year=2024/month=02/day=24/file=orders_24022024.json"
    (moved,) = storage.files(spark, kept)
    assert spark.read.format("binaryFile").load(moved).first().content == before
    assert storage.matches(spark, f"{layout.landing}/orders/*") == []
