"""The adapters keep every row of the star tables."""

from __future__ import annotations

from strata.fixtures.retail import load_star, source_tables
from tests.conftest import SF_SMALL


def test_adapters_keep_every_row(spark):
    star = load_star(spark, SF_SMALL)
    src = source_tables(star)
    assert src["order_items"].count() == star["lineitem"].count()
    assert src["customer_reviews"].count() == star["events"].count()
    assert src["suppliers"].count() == star["supplier"].count()
    assert src["product_suppliers"].count() == star["lineitem"].select("l_suppkey", "l_partkey").distinct().count()
    for table, base, key in (("orders", "orders", "order_id"), ("products", "part", "product_id"),
                             ("customers", "customer", None)):
        assert src[table].count() > star[base].count()
        if key:
            assert src[table].where(f"{key} < 50000000").count() == star[base].count()
