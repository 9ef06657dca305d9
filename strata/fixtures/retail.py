"""Star schema -> retail operational tables (the fixture adapters).

The driver's test data is a TPC-H-like star schema. These adapters turn it
into the shape of the shop and supplier databases, and add the dirty
rows, gaps and duplicate keys that the quarantine and merge rules need
(see FIXTURES.md). ``source_tables`` gives the operational shape (real
timestamps, as a JDBC read would); ``bronze_tables`` gives what the bronze
layer reads back after landing (timestamps as epoch-millisecond text).

The SQL twin used by the DuckDB oracle lives in ``strata.oracle.sql``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.conf import UNREFERENCED
from strata.functions.columns import epoch_millis, ntz_lit
from strata.schemas import BRONZE

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")

# Fixed values of the adapters: the load time stamped on dimension rows and
# the offset that turns an existing key into a new one in later batches.
DIM_UPDATED_AT = dt.datetime(2024, 1, 1)
NEW_KEY_OFFSET = 10_000_000_000


def load_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in STAR_TABLES}


def _ts_lit(v: dt.datetime):
    return ntz_lit(v)


def _with_unreferenced(df: DataFrame, key: str, cond, offset: int) -> DataFrame:
    """``df`` and, under offset keys, copies of some rows that no other table
    refers to. Every row of ``df`` stays."""
    return df.unionByName(df.where(cond).withColumn(key, F.col(key) + offset))


def source_tables(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Operational tables, as they would come out of the source databases.

    Each holds all rows of the table it derives from. Products without sales
    or suppliers, customers without orders and orders without lines are added
    rows under offset keys.
    """
    star = {**star,
            "part": _with_unreferenced(star["part"], "p_partkey", F.col("p_partkey") % 25 == 3,
                                       UNREFERENCED),
            "customer": _with_unreferenced(star["customer"], "c_custkey",
                                           F.col("c_custkey") % 10 == 7, UNREFERENCED),
            "orders": _with_unreferenced(star["orders"], "o_orderkey",
                                         F.col("o_orderkey") % 13 == 0, UNREFERENCED),
            "all_parts": star["part"]}
    part, lineitem = star["part"], star["lineitem"]
    dim_ts = _ts_lit(DIM_UPDATED_AT)

    # The distinct type list is tiny, so numbering it in one window is fine.
    categories = (part.select("p_type").distinct()
                  .select(F.row_number().over(Window.orderBy("p_type")).cast("bigint")
                          .alias("category_id"),
                          F.col("p_type").alias("name"),
                          dim_ts.alias("updated_at")))

    products = (part.join(categories.select("category_id", F.col("name").alias("p_type")),
                          "p_type")
                .select(F.col("p_partkey").alias("product_id"),
                        F.col("p_name").alias("name"),
                        F.when(F.col("p_partkey") % 40 == 9, None)
                        .otherwise(F.col("category_id")).alias("category_id"),
                        F.col("p_retailprice").alias("price"),
                        dim_ts.alias("updated_at")))

    c = star["customer"]
    customers = c.select(
        F.when(F.col("c_custkey") % 500 == 3, None).otherwise(F.col("c_custkey"))
        .alias("customer_id"),
        F.when(F.col("c_custkey") % 50 == 2, None).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_custkey") % 50 == 1, None)
        .otherwise(F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(""))),
                            F.lit("@example.com"))).alias("email"),
        dim_ts.alias("updated_at"))

    o = star["orders"]
    orders = (o.select(F.col("o_orderkey").alias("order_id"),
                      F.when(F.col("o_orderkey") % 100 == 5, None)
                      .otherwise(F.col("o_custkey")).alias("customer_id"),
                      F.col("o_orderdate").alias("order_date"),
                      F.when(F.col("o_orderkey") % 100 == 4, -F.col("o_totalprice"))
                      .when(F.col("o_orderkey") % 100 == 6, None)
                      .otherwise(F.col("o_totalprice")).alias("total_amount"),
                      (F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).alias("updated_at")))

    # (l_orderkey, l_linenumber) is not unique in the test data; a rank
    # inside the pair makes a unique item id.
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
    order_items = (lineitem.withColumn("rn", F.row_number().over(w))
                   .select(((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100
                            + F.col("rn")).alias("order_item_id"),
                           F.col("l_orderkey").alias("order_id"),
                           F.col("l_partkey").alias("product_id"),
                           F.when(F.col("l_orderkey") % 200 == 1,
                                  -F.col("l_quantity").cast("bigint"))
                           .otherwise(F.col("l_quantity").cast("bigint")).alias("quantity"),
                           F.col("l_extendedprice").alias("price"),
                           F.col("l_shipdate").alias("updated_at")))

    s, n, r = star["supplier"], star["nation"], star["region"]
    suppliers = (s.join(n, s.s_nationkey == n.n_nationkey)
                 .join(r, n.n_regionkey == r.r_regionkey)
                 .select(F.col("s_suppkey").alias("supplier_id"),
                         F.when(F.col("s_suppkey") % 25 == 2, None)
                         .otherwise(F.col("s_name")).alias("supplier_name"),
                         F.concat(F.lit("contact "), F.col("s_suppkey").cast("string"))
                         .alias("contact_name"),
                         F.concat(F.lit("+0-"), F.col("s_suppkey").cast("string")).alias("phone"),
                         F.concat(F.lit("s"), F.col("s_suppkey").cast("string"),
                                  F.lit("@example.com")).alias("email"),
                         F.concat(F.col("s_nationkey").cast("string"), F.lit(" Main St"))
                         .alias("address"),
                         F.col("n_name").alias("city"),
                         F.col("r_name").alias("country"),
                         dim_ts.alias("created_at")))

    product_suppliers = (lineitem.groupBy("l_suppkey", "l_partkey")
                         .agg(F.min("l_extendedprice").alias("min_price"),
                              F.max("l_shipdate").alias("last_updated"))
                         .select(F.when(F.col("l_suppkey") % 50 == 49,
                                        F.col("l_suppkey") + 1_000_000)
                                 .otherwise(F.col("l_suppkey")).alias("supplier_id"),
                                 F.col("l_partkey").alias("product_id"),
                                 F.when((F.col("l_suppkey") + F.col("l_partkey")) % 97 == 0, None)
                                 .otherwise(F.col("min_price")).alias("supply_price"),
                                 "last_updated"))

    return {"categories": categories, "products": products, "customers": customers,
            "orders": orders, "order_items": order_items, "suppliers": suppliers,
            "product_suppliers": product_suppliers,
            "customer_reviews": review_records(star)}


def review_records(star: dict[str, DataFrame]) -> DataFrame:
    """Review records as the reviews feed delivers them (already flat text)."""
    e, part = star["events"], star.get("all_parts", star["part"])
    n_parts = part.select(F.count(F.lit(1))).scalar()
    return (e.withColumn("product_id", (F.col("event_id") * 7) % n_parts)
            .select(F.col("event_id").cast("string").alias("id"),
                    F.col("user_id").alias("customer_id"),
                    "product_id",
                    F.when(F.col("event_id") % 30 == 0, None)
                    .otherwise(F.col("event_id") % 5 + 1).alias("rating"),
                    F.when(F.col("event_type") == "error", None)
                    .otherwise(F.col("event_type")).alias("review_text"),
                    epoch_millis("ts").cast("string").alias("review_date")))


def to_bronze(df: DataFrame, table: str) -> DataFrame:
    """What the bronze layer reads after ``df`` is landed as JSON lines.

    Timestamps land as epoch-millisecond numbers and are read back as their
    digit text; every other column takes its declared bronze type.
    """
    types = dict(df.dtypes)
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in BRONZE[table].fields:
        if types.get(f.name) in ("timestamp", "timestamp_ntz"):
            c = epoch_millis(f.name, dtypes[f.name]).cast("string")
        else:
            c = F.col(f.name).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(cols)


def bronze_tables(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {t: to_bronze(df, t) for t, df in source_tables(star).items()}


# --- later batches for the SCD2 merges ------------------------------------

# Change applied to the one compared column of each table in batch 2, and
# the key the batch rules are evaluated on.
_BATCH_KEY = {
    "customers": lambda: F.col("customer_id"),
    "orders": lambda: F.col("order_id"),
    "order_items": lambda: F.col("order_item_id"),
    "product_suppliers": lambda: F.col("supplier_id"),
    "customer_reviews": lambda: F.col("id").cast("bigint"),
}
_BATCH_CHANGE = {
    "customers": ("email", lambda: F.concat(F.lit("v2."), F.col("email"))),
    "orders": ("total_amount", lambda: F.col("total_amount") + 1),
    "order_items": ("quantity", lambda: F.col("quantity") + 1),
    "product_suppliers": ("supply_price", lambda: F.col("supply_price") + 1),
    "customer_reviews": ("rating", lambda: F.col("rating") % 5 + 1),
}
_TS_COLUMN = {"customers": "updated_at", "orders": "updated_at",
              "order_items": "updated_at", "product_suppliers": "last_updated"}
_KEY_COLUMN = {"customers": "customer_id", "orders": "order_id",
               "order_items": "order_item_id", "product_suppliers": "supplier_id",
               "customer_reviews": "id"}


def next_batch(bronze: DataFrame, table: str) -> DataFrame:
    """Batch 2 of FIXTURES.md §4, derived from batch-1 bronze rows.

    Keys ``% 7 = 0`` change one compared column (and move their update time
    one day on); keys ``% 7 = 1`` come again unchanged; keys ``% 11 = 0``
    are offered again under a new key. Product-supplier mappings keep one
    row per supplier (the lowest product) so that no target row can match
    two source rows.
    """
    df = bronze
    if table == "product_suppliers":
        # The lowest-product row per supplier, as an aggregate (combined
        # map-side, so a supplier with a third of all rows is no hot task).
        cols0 = df.columns
        df = (df.groupBy("supplier_id")
              .agg(F.min_by(F.struct(*cols0), "product_id").alias("_r"))
              .select("_r.*"))
    k = _BATCH_KEY[table]()
    cols = df.columns
    changed_col, changed_expr = _BATCH_CHANGE[table]
    changed = df.where(k % 7 == 0).withColumn(changed_col, changed_expr())
    if table in _TS_COLUMN:
        ts = _TS_COLUMN[table]
        changed = changed.withColumn(
            ts, (F.col(ts).cast("bigint") + 86_400_000).cast("string"))
    same = df.where(k % 7 == 1)
    key = _KEY_COLUMN[table]
    new_key = k + NEW_KEY_OFFSET
    renamed = df.where(k % 11 == 0).withColumn(
        key, new_key.cast("string") if table == "customer_reviews" else new_key)
    return changed.select(cols).unionByName(same.select(cols)).unionByName(renamed.select(cols))
