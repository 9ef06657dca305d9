"""Quarantine flag: bad rows are marked, never dropped.

Each rule is a list of columns that must not be NULL plus columns that must
not be negative. The flag is ``CASE WHEN <any violation> THEN TRUE ELSE
FALSE``: a comparison with NULL is unknown and so falls to FALSE, which is
why a NULL amount is not flagged by the ``< 0`` test.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import any_of, flag


@dataclass(frozen=True)
class Rule:
    not_null: tuple[str, ...]
    non_negative: tuple[str, ...] = ()

    def violated(self) -> Column:
        preds = [F.col(c).isNull() for c in self.not_null]
        preds += [F.col(c) < 0 for c in self.non_negative]
        return any_of(preds)


# The quarantine rule of every silver table, as given by the
# original transformation scripts (products do not check product_id and
# product_suppliers do not check supplier_id).
RULES: dict[str, Rule] = {
    "customers": Rule(("customer_id", "email", "name")),
    "orders": Rule(("order_id", "customer_id", "order_date"), ("total_amount",)),
    "order_items": Rule(("order_item_id", "order_id", "product_id"), ("quantity", "price")),
    "categories": Rule(("category_id", "name")),
    "products": Rule(("category_id", "name")),
    "product_suppliers": Rule(("product_id", "supply_price")),
    "suppliers": Rule(("supplier_id", "supplier_name")),
    "customer_reviews": Rule(("customer_id", "product_id", "rating")),
}


def quarantine_flag(table: str) -> Column:
    return flag(RULES[table].violated()).alias("is_quarantined")


def quarantine(df: DataFrame, table: str) -> DataFrame:
    """``SELECT *, <flag> AS is_quarantined`` (a narrow, codegen'd projection)."""
    return df.select("*", quarantine_flag(table))


def distinct_flagged(df: DataFrame, table: str) -> DataFrame:
    """``SELECT DISTINCT cols, <flag>``: the merge source of four tables.

    The distinct runs as a hash aggregate with a map-side partial step, so
    repeated rows collapse before the shuffle however hot they are.
    """
    return quarantine(df, table).distinct()
