"""Registered queries against their DuckDB oracles, and fan-out properties."""

from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.functions.columns import line_amount
from strata.plans import gold
from strata.queries import Inputs
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()

KEYS = ["sales_summary", "customer_engagement", "product_performance", "supplier_analysis",
        "customer_reviews_summary", "scd2_orders", "scd2_product_suppliers",
        "distinct_rows", "archive_landing", "bronze_customer_reviews", "quarantine_order_items",
        "days_since_order", "join_left_chain", "archive_lines", "bronze_rejects", "restartable_day"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return None if v is None else str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple("" if x is None else x for x in t))


def test_every_query_has_an_oracle():
    """Optional queries may lack one: their own tests compare them with brute force."""
    from strata.oracle.registry import oracles
    from strata.queries import registry
    assert set(registry()) == set(oracles())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[key])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(d_cols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


def direct_product_performance(silver):
    """G3 with the many-to-many joins materialised (the original form)."""
    p = silver["products"].where(~F.col("is_quarantined")).alias("p")
    c = silver["categories"].alias("c")
    ps = silver["product_suppliers"].alias("ps")
    s = silver["suppliers"].alias("s")
    oi = silver["order_items"].alias("oi")
    cr = silver["customer_reviews"].alias("cr")
    j = (p.join(c, F.col("p.category_id") == F.col("c.category_id"), "left")
         .join(ps, F.col("p.product_id") == F.col("ps.product_id"), "left")
         .join(s, F.col("ps.supplier_id") == F.col("s.supplier_id"), "left")
         .join(oi, F.col("p.product_id") == F.col("oi.product_id"), "left")
         .join(cr, F.col("p.product_id") == F.col("cr.product_id"), "left"))
    return (j.groupBy(F.col("p.product_id").alias("product_id"),
                      F.col("p.name").alias("product_name"),
                      F.col("p.category_id").alias("category_id"),
                      F.col("c.name").alias("category_name"),
                      F.col("ps.supplier_id").alias("supplier_id"),
                      F.col("s.supplier_name").alias("supplier_name"))
            .agg(F.sum("oi.quantity").alias("total_units_sold"),
                 F.sum(line_amount("oi.price", "oi.quantity")).cast("double").alias("total_revenue"),
                 (F.sum("cr.rating") / F.count("cr.rating")).alias("avg_rating"),
                 F.count("cr.review_text").alias("total_reviews")))


def test_preaggregated_equals_direct_fanout(spark):
    silver = Inputs(spark, SF_SMALL).silver
    fast = gold.product_performance(silver)
    slow = direct_product_performance(silver)
    cols = fast.columns
    assert canon(cols, [tuple(r) for r in fast.collect()]) == \
        canon(cols, [tuple(r) for r in slow.select(*cols).collect()])


def test_preaggregated_plan_has_no_fanout_join(spark):
    """Items and reviews meet the product rows already at product grain."""
    silver = Inputs(spark, SF_SMALL).silver
    plan = gold.product_performance(silver)._jdf.queryExecution().optimizedPlan().toString()
    # Both many-sides are aggregated before their join.
    assert plan.count("Aggregate [product_id") >= 2


@pytest.fixture(scope="module")
def silver_with_history(spark):
    """Silver tables written by two merge runs (history + active parts)."""
    from strata.conf import T1, T2
    from strata.fixtures.retail import next_batch
    from strata.plans.silver import SilverStore
    from strata.schemas import REFRESH_TABLES, SCD2_TABLES
    from strata.session import work_dir
    bronze = Inputs(spark, SF_SMALL).bronze
    store = SilverStore(spark, work_dir(spark, "marts_history"))
    for t in REFRESH_TABLES:
        store.refresh(t, bronze[t], "1")
    for t in SCD2_TABLES:
        store.merge(t, bronze[t], "1", T1)
        store.merge(t, next_batch(bronze[t], t), "2", T2)
    return {t: store.read(t) for t in REFRESH_TABLES + SCD2_TABLES}


@pytest.mark.parametrize("mart", list(gold.MARTS))
def test_marts_over_history_match_oracle(spark, duck, silver_with_history, mart):
    """Expired versions count wherever only the flag is filtered."""
    from strata.conf import AS_OF
    from strata.oracle import sql
    fn = gold.MARTS[mart]
    df = fn(silver_with_history, AS_OF) if mart == "customer_engagement" \
        else fn(silver_with_history)
    res = duck.execute(sql.mart_after_two_batches(mart))
    d_cols = [d[0] for d in res.description]
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(d_cols, res.fetchall())


def test_results_do_not_depend_on_session_time_zone(spark):
    """Timestamps are wall-clock NTZ values and millis are UTC: a driver
    session in another zone must produce the same rows."""
    keys = ["scd2_customers", "bronze_orders", "days_since_order"]
    zone = spark.conf.get("spark.sql.session.timeZone")

    def run():
        return {k: sorted(map(str, E.queries()[k](spark, SF_SMALL).collect())) for k in keys}
    base = run()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        other = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert base == other
