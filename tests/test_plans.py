"""Plan properties: pruning and pushdown reach the scans; flags match SQL."""

from __future__ import annotations

import datetime as dt

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.quality import quarantine
from strata.oracle.sql import FLAG
from strata.plans import gold
from strata.plans.silver import SilverStore
from strata.schemas import BRONZE
from strata.session import work_dir

T1, T2 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


def executed(df) -> str:
    """The formatted physical plan, as ``df.explain("formatted")`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_mart_scans_are_pruned_and_filtered(spark, tmp_root):
    store = SilverStore(spark, tmp_root)
    from tests import seed
    bronze = seed.bronze(spark)
    for t in ("orders", "order_items"):
        store.merge(t, bronze[t], "1", T1)
    for t in ("products", "categories"):
        store.refresh(t, bronze[t], "1")
    silver = {t: store.read(t) for t in ("orders", "order_items", "products", "categories")}
    df = gold.sales_summary(silver)
    plan = executed(df)
    # The active filter reaches the orders scan, and only used columns are read.
    blocks = plan.split("\n\n")
    orders_scan = [b for b in blocks if "Scan parquet" in b and "/orders/log/part=" in b]
    assert orders_scan, plan
    field = lambda name: orders_scan[0].split(name + ":")[1].split("\n")[0]
    assert "EqualTo(is_active,true)" in field("PushedFilters")
    assert "part" in field("PartitionFilters")
    read_schema = field("ReadSchema")
    assert "total_amount" not in read_schema and "order_date" in read_schema


def test_a_merge_does_not_shuffle_its_target(spark, tmp_root):
    """The log is bucketed by the key: neither the join nor the pass that drops
    closed versions has an Exchange above the target's scan."""
    from strata.operators.scd2 import SPECS, merge_source, scd2_merge
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for table in ("customers", "orders", "order_items", "customer_reviews"):
            store = SilverStore(spark, f"{tmp_root}/{table}")
            frame = lambda ids, v: spark.range(*ids).selectExpr(*[
                f"cast(id as {f.dataType.simpleString()}) {f.name}" if f.name == SPECS[table].keys[0] else
                f"cast({v} as {f.dataType.simpleString()}) {f.name}" for f in BRONZE[table].fields])
            store.merge(table, frame((1000,), 1), "1", T1)
            store.merge(table, frame((10,), 2), "2", T2)
            target = store.table(table).target("3")
            assert target.count() == 990
            res = scd2_merge(target, merge_source(frame((5, 20), 3), SPECS[table]), SPECS[table], T2,
                             unique_source_keys=True)
            plan = res.changes()._jdf.queryExecution().executedPlan().toString().split("\n")
            scans = [i for i, line in enumerate(plan) if "strata_log_" in line]
            assert scans and "Bucketed: true" in plan[scans[0]]
            for i in scans:   # walk up to the join by indentation
                depth = plan[i].index("FileScan")
                for line in reversed(plan[:i]):
                    at = len(line) - len(line.lstrip(" :+-"))
                    if at < depth:
                        depth = at
                        if "Join" in line:
                            break
                        assert "Exchange" not in line, line
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


keys = st.one_of(st.none(), st.integers(-3, 3))
amounts = st.one_of(st.none(), st.floats(-5, 5, allow_nan=False))
texts = st.one_of(st.none(), st.just("x"))


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(keys, keys, keys, keys, amounts, texts), min_size=1, max_size=12))
def test_order_item_flags_equal_sql_case(spark, rows):
    data = [(a, b, c, d, e, f) for a, b, c, d, e, f in rows]
    got = [r.is_quarantined for r in
           quarantine(spark.createDataFrame(data, BRONZE["order_items"]), "order_items")
           .collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (order_item_id BIGINT, order_id BIGINT, product_id BIGINT, "
                "quantity BIGINT, price DOUBLE, updated_at VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?)", data)
    want = [r[0] for r in con.execute(
        f"SELECT CASE WHEN {FLAG['order_items']} THEN TRUE ELSE FALSE END FROM t").fetchall()]
    assert sorted(got) == sorted(want) and len(got) == len(data)
