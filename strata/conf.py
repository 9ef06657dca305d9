"""Fixed run parameters of the registered queries and the default control rows."""

from __future__ import annotations

import datetime as dt

# The clock of the three SCD2 batches, the date the marts
# count days from, and the clock of the two ingest days.
DAY1, DAY2, DAY3 = dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 4)
T1, T2, T3 = (dt.datetime(d.year, d.month, d.day) for d in (DAY1, DAY2, DAY3))
AS_OF = dt.date(2025, 1, 1)
INGEST_CLOCK_1 = dt.datetime(1997, 1, 1)
INGEST_CLOCK_2 = dt.datetime(1998, 1, 1)

# The control rows of the shop and supplier databases
# (database, datasource, tablename, loadtype, watermark, is_active, targetpath).
CONTROL_ROWS = [
    ("shop", "shop_db", "products", "Full Load", "", "1", "landing/shop-db/products"),
    ("shop", "shop_db", "categories", "Full Load", "", "1",
     "landing/shop-db/categories"),
    ("shop", "shop_db", "customers", "Incremental", "updated_at", "1",
     "landing/shop-db/customers"),
    ("shop", "shop_db", "orders", "Incremental", "updated_at", "1",
     "landing/shop-db/orders"),
    ("shop", "shop_db", "order_items", "Incremental", "updated_at", "1",
     "landing/shop-db/order_items"),
    ("supplier-db", "mysql-db", "suppliers", "Full Load", "created_at", "1", "supplier"),
    ("supplier-db", "mysql-db", "product_suppliers", "Incremental", "last_updated", "1",
     "supplier"),
]
CONTROL_COLUMNS = ("database", "datasource", "tablename", "loadtype", "watermark",
                   "is_active", "targetpath")


def control_dicts() -> list[dict]:
    return [dict(zip(CONTROL_COLUMNS, r)) for r in CONTROL_ROWS]

# Offset of the keys of added rows that no other table refers to.
UNREFERENCED = 50_000_000
