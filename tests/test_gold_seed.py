"""Golden facts of the five marts, worked out by hand from the seed rows."""

from __future__ import annotations

import datetime as dt

import pytest

from strata.plans import gold
from strata.plans.silver import silver_tables
from tests import seed

NOW = dt.datetime(2024, 2, 25)


@pytest.fixture(scope="module")
def silver(spark):
    return silver_tables(seed.bronze(spark), NOW)


def rows(df, key):
    return {key(r): r for r in df.collect()}


def test_sales_summary(silver):
    out = gold.sales_summary(silver).collect()
    assert len(out) == 9
    r = [x for x in out if x.product_id == 102][0]
    assert (r.total_units_sold, r.total_sales, r.unique_customers) == (2, 40.0, 2)


def test_customer_engagement(silver):
    out = gold.customer_engagement(silver, dt.date(2024, 3, 1)).collect()
    by = {r.customer_id: r for r in out}
    assert len(out) == 10
    assert (by[1].total_orders, by[1].total_spent, by[1].avg_order_value) == (2, 1020.0, 510.0)
    assert (by[10].total_orders, by[10].total_spent) == (1, None)
    assert by[1].days_since_last_order == 6   # 2024-02-24 -> 2024-03-01 (leap year)


def test_product_performance(silver):
    out = gold.product_performance(silver).collect()
    assert len(out) == 21
    p101 = sorted((r.supplier_id, r.total_units_sold, r.total_revenue)
                  for r in out if r.product_id == 101)
    assert p101 == [(1, 1, 1000.0), (3, 1, 1000.0)]
    p109 = [r for r in out if r.product_id == 109][0]
    assert (p109.supplier_id, p109.supplier_name) == (8, None)
    assert all(r.supplier_id is None for r in out if 110 <= r.product_id <= 120)


def test_supplier_analysis(silver):
    by = {r.supplier_id: r for r in gold.supplier_analysis(silver).collect()}
    assert len(by) == 7
    assert (by[1].total_products_supplied, by[1].total_units_sold, by[1].total_revenue) == \
        (2, 3, 1040.0)
    assert (by[2].total_products_supplied, by[2].total_units_sold) == (1, None)


def test_customer_reviews_summary(silver):
    out = gold.customer_reviews_summary(silver).collect()
    assert len(out) == 20
    assert all(r.avg_rating is None and r.total_reviews == 0 and r.positive_reviews == 0
               and r.negative_reviews == 0 for r in out)
