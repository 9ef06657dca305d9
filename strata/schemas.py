"""Declared schemas of every table the lakehouse reads or writes.

Bronze tables are schema-on-read over landing files: timestamps arrive as
epoch-millisecond numbers and are kept as their digit text (``STRING``).
Silver adds the quarantine flag and, for slowly changing tables, the SCD2
validity columns. SCD2 bounds and audit times are ``TIMESTAMP_NTZ`` holding
UTC wall-clock time, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

I, F, S = LongType(), DoubleType(), StringType()


def _struct(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


BRONZE: dict[str, StructType] = {
    "orders": _struct(
        ("order_id", I), ("customer_id", I), ("order_date", S),
        ("total_amount", F), ("updated_at", S)),
    "customers": _struct(
        ("customer_id", I), ("name", S), ("email", S), ("updated_at", S)),
    "products": _struct(
        ("product_id", I), ("name", S), ("category_id", I), ("price", F),
        ("updated_at", S)),
    "categories": _struct(
        ("category_id", I), ("name", S), ("updated_at", S)),
    "order_items": _struct(
        ("order_item_id", I), ("order_id", I), ("product_id", I),
        ("quantity", I), ("price", F), ("updated_at", S)),
    "suppliers": _struct(
        ("supplier_id", I), ("supplier_name", S), ("contact_name", S),
        ("phone", S), ("email", S), ("address", S), ("city", S),
        ("country", S), ("created_at", S)),
    "product_suppliers": _struct(
        ("supplier_id", I), ("product_id", I), ("supply_price", F),
        ("last_updated", S)),
    "customer_reviews": _struct(
        ("id", S), ("customer_id", I), ("product_id", I), ("rating", I),
        ("review_text", S), ("review_date", S)),
}

# Tables whose landing files come from the shop / supplier databases
# (JSON lines) versus the reviews feed (Parquet snapshots).
JSON_TABLES = ("orders", "customers", "products", "categories", "order_items",
               "suppliers", "product_suppliers")
PARQUET_TABLES = ("customer_reviews",)

QUARANTINE = StructField("is_quarantined", BooleanType(), True)
SCD_COLUMNS = [
    StructField("effective_start_date", TimestampNTZType(), True),
    StructField("effective_end_date", TimestampNTZType(), True),
    StructField("is_active", BooleanType(), True),
]

# Silver tables kept with SCD2 history versus rebuilt by full refresh.
SCD2_TABLES = ("customers", "orders", "order_items", "product_suppliers",
               "customer_reviews")
REFRESH_TABLES = ("categories", "products", "suppliers")


def silver_schema(table: str) -> StructType:
    fields = list(BRONZE[table].fields) + [QUARANTINE]
    if table in SCD2_TABLES:
        fields += SCD_COLUMNS
    return StructType(fields)


AUDIT_LOG = _struct(
    ("tablename", S), ("load_type", S), ("record_count", I),
    ("load_timestamp", TimestampNTZType()), ("status", S))

PIPELINE_LOG = _struct(
    ("timestamp", S), ("event_type", S), ("message", S), ("table", S))

CONTROL = _struct(
    ("database", S), ("datasource", S), ("tablename", S), ("loadtype", S),
    ("watermark", S), ("is_active", S), ("targetpath", S))
