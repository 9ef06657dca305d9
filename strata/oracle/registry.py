"""Plan key -> DuckDB SQL text (see ``strata.oracle.sql``)."""

from __future__ import annotations

import datetime as dt

from strata.conf import AS_OF, CONTROL_ROWS, INGEST_CLOCK_1, INGEST_CLOCK_2, T1, T2, T3
from strata.oracle import sql
from strata.oracle.sql import ADAPTERS, COLUMNS, REFRESH, SCD2, flag_case, ts, with_ctes

_UTC = dt.timezone.utc


def _millis(v: dt.datetime) -> int:
    return int(v.replace(tzinfo=_UTC).timestamp() * 1000)


def _cols(t: str) -> str:
    return ", ".join(COLUMNS[t])


def _days_since_order() -> str:
    day = ("DATE '1970-01-01' + CAST(floor(CAST(order_date AS BIGINT) / 86400000) AS INTEGER)")
    return with_ctes(ADAPTERS, f"""
SELECT order_id, order_date, {day} AS order_day,
       CAST(date_diff('day', {day}, DATE '{AS_OF:%Y-%m-%d}') AS BIGINT) AS days_since_order
FROM b_orders""")


def _join_inner_chain() -> str:
    return with_ctes(sql.silver_ctes(), """
SELECT o.order_id, o.order_date, o.customer_id, oi.order_item_id, oi.product_id,
       oi.quantity, oi.price, p.name AS product_name, p.category_id,
       c.name AS category_name
FROM s_orders o
JOIN s_order_items oi ON o.order_id = oi.order_id
JOIN s_products p ON oi.product_id = p.product_id
JOIN s_categories c ON p.category_id = c.category_id
WHERE o.is_active = TRUE""")


def _join_left_chain() -> str:
    return with_ctes(sql.silver_ctes(), """
SELECT c.customer_id, c.name AS customer_name, o.order_id, o.order_date,
       oi.order_item_id, oi.quantity, oi.price
FROM s_customers c
LEFT JOIN s_orders o ON c.customer_id = o.customer_id
LEFT JOIN s_order_items oi ON o.order_id = oi.order_id
WHERE c.is_active = TRUE""")


def _bronze(t: str) -> str:
    if t == "customer_reviews":
        ctes = dict(ADAPTERS)
        ctes["n_customer_reviews"] = sql.next_batch(t)
        return with_ctes(ctes, f"SELECT {_cols(t)} FROM b_{t} "
                               f"UNION ALL SELECT {_cols(t)} FROM n_{t}")
    return with_ctes(ADAPTERS, f"SELECT {_cols(t)} FROM b_{t}")


def _land_json() -> str:
    cols = ", ".join("CAST(updated_at AS BIGINT) AS updated_at" if c == "updated_at" else c
                     for c in COLUMNS["order_items"])
    return with_ctes(ADAPTERS, f"SELECT {cols} FROM b_order_items")


def _archive() -> str:
    ctes = dict(ADAPTERS)
    ctes["n_orders"] = sql.next_batch("orders")
    c = _cols("orders")
    return with_ctes(ctes, f"""
SELECT {c}, '2024' AS year, '01' AS month, '02' AS day, 'orders_02012024.json' AS file
FROM b_orders
UNION ALL
SELECT {c}, '2024' AS year, '01' AS month, '03' AS day, 'orders_03012024.json' AS file
FROM n_orders""")


def _order_line(broken: str) -> str:
    line = ("'{\"order_id\":' || order_id || ',\"customer_id\":' || coalesce(CAST(customer_id AS VARCHAR), 'null') || "
            "',\"note\":\"n' || order_id || '\"}'")
    return f"CASE WHEN {broken} THEN left({line}, 15) ELSE {line} END"


def _archive_lines() -> str:
    return with_ctes(ADAPTERS, f"""
SELECT {_order_line('order_id % 10 = 3')} AS line, '2024' AS year, '01' AS month, '02' AS day,
       'orders_02012024.json' AS file
FROM b_orders WHERE order_id IS NOT NULL""")


def _bronze_rejects() -> str:
    return with_ctes(ADAPTERS, f"""
SELECT 'orders_03012024.json' AS file, {_order_line('TRUE')} AS line FROM b_orders WHERE order_id % 10 = 3
UNION ALL
SELECT 'orders_03012024.json' AS file,
       CASE order_id % 3 WHEN 0 THEN '{{"order_id":' || order_id
            WHEN 1 THEN '{{"order_id":"no ' || order_id || '"}}' ELSE 'order ' || order_id || ' was lost' END AS line
FROM b_orders WHERE order_id % 10 = 4""")


def _review_snapshots() -> str:
    """Three whole snapshots, merged one after the other."""
    t = "customer_reviews"
    ctes = dict(ADAPTERS)
    ctes["n_later"] = sql.next_batch(t)
    ctes["n_second"] = (f"SELECT {_cols(t)} FROM b_{t} WHERE id NOT IN (SELECT id FROM n_later) "
                        f"UNION ALL SELECT {_cols(t)} FROM n_later")
    ctes["n_third"] = "SELECT * FROM n_second WHERE rating IS NOT NULL"
    ctes[f"m0_{t}"] = sql.empty_silver(t)
    for i, (src, now) in enumerate(((f"b_{t}", T1), ("n_second", T2), ("n_third", T3)), 1):
        ctes.update(sql.merge_ctes(t, f"m{i}_{t}", f"m{i - 1}_{t}", src, now))
    return with_ctes(ctes, f"SELECT * FROM m3_{t}")


def _distinct_customers() -> str:
    return with_ctes(ADAPTERS, """
SELECT oi.product_id, count(DISTINCT o.customer_id) AS unique_customers
FROM b_orders o JOIN b_order_items oi ON o.order_id = oi.order_id
WHERE o.customer_id IS NOT NULL GROUP BY oi.product_id""")


_MADE_ONCE = "TRUE AS made, FALSE AS made_again, TRUE AS refused"


def _create_table() -> str:
    return with_ctes(sql.silver_ctes(), f"SELECT *, {_MADE_ONCE} FROM s_orders")


def _ctas() -> str:
    return f"SELECT *, {_MADE_ONCE} FROM ({sql.mart('customer_reviews_summary')}) AS made_of"


def _named_silver() -> str:
    return with_ctes(sql.silver_two_batches_ctes(), """
SELECT c.customer_id, c.name, c.email, c.is_active, count(r.id) AS reviews,
       count(CASE WHEN r.is_active THEN 1 END) AS active_reviews
FROM s_customers c LEFT JOIN s_customer_reviews r ON c.customer_id = r.customer_id
GROUP BY c.customer_id, c.name, c.email, c.is_active""")


def _restartable_day() -> str:
    """Silver orders of two unbroken days: all orders, then those past the first clock."""
    ctes = dict(ADAPTERS)
    ctes["n_orders"] = ("SELECT * FROM b_orders "
                        f"WHERE CAST(updated_at AS BIGINT) > {_millis(INGEST_CLOCK_1)}")
    ctes["m0_orders"] = sql.empty_silver("orders")
    ctes.update(sql.merge_ctes("orders", "m1_orders", "m0_orders", "b_orders", INGEST_CLOCK_1))
    ctes.update(sql.merge_ctes("orders", "m2_orders", "m1_orders", "n_orders", INGEST_CLOCK_2))
    return with_ctes(ctes, "SELECT * FROM m2_orders")


_TS_COL = {"customers": "updated_at", "orders": "updated_at", "order_items": "updated_at",
           "product_suppliers": "last_updated", "suppliers": "created_at"}


def _audit_rows() -> str:
    parts = []
    for clock_i, clock in enumerate((INGEST_CLOCK_1, INGEST_CLOCK_2)):
        for _db, _ds, table, load_type, _wm, _active, _tp in CONTROL_ROWS:
            cond = ""
            if load_type.lower() != "full load" and clock_i == 1:
                cond = (f" WHERE CAST({_TS_COL[table]} AS BIGINT) > "
                        f"{_millis(INGEST_CLOCK_1)}")
            parts.append(
                f"SELECT '{table}' AS tablename, '{load_type}' AS load_type, "
                f"(SELECT count(*) FROM b_{table}{cond}) AS record_count, "
                f"{ts(clock)} AS load_timestamp, 'SUCCESS' AS status")
    return "\nUNION ALL\n".join(parts)


def _audit_log() -> str:
    return with_ctes(ADAPTERS, _audit_rows())


def _pipeline_log() -> str:
    """Log rows of the two ingest days: archive, watermark (incremental
    tables) and landing events, with counts taken from the adapters."""
    parts = []
    for day in (1, 2):
        clock = (INGEST_CLOCK_1 if day == 1 else INGEST_CLOCK_2).isoformat()
        for _db, _ds, table, load_type, _wm, _active, _tp in CONTROL_ROWS:
            full = f"(SELECT count(*) FROM b_{table})"
            incremental = load_type.lower() != "full load"
            landed = full
            if incremental and day == 2:
                landed = (f"(SELECT count(*) FROM b_{table} WHERE CAST({_TS_COL[table]} "
                          f"AS BIGINT) > {_millis(INGEST_CLOCK_1)})")
            archived = "0" if day == 1 else f"CAST({full} AS VARCHAR)"
            row = "SELECT '{c}' AS timestamp, '{e}' AS event_type, {m} AS message, " \
                  "'{t}' AS \"table\""
            parts.append(row.format(
                c=clock, e="INFO", t=table,
                m=f"'archived ' || {archived} || ' rows of earlier landing files'"))
            if incremental:
                wm = "1900-01-01 00:00:00" if day == 1 else \
                    f"{INGEST_CLOCK_1:%Y-%m-%d %H:%M:%S}"
                parts.append(row.format(c=clock, e="INFO", t=table,
                                        m=f"'latest watermark for {table}: {wm}'"))
            parts.append(row.format(c=clock, e="SUCCESS", t=table,
                                    m=f"'landed ' || CAST({landed} AS VARCHAR) || ' rows'"))
    return with_ctes(ADAPTERS, "\nUNION ALL\n".join(parts))


def _latest_watermark() -> str:
    names = [r[2] for r in CONTROL_ROWS]
    listed = ", ".join(f"({i}, '{t}')" for i, t in enumerate(names))
    return f"""
WITH control(i, tablename) AS (VALUES {listed}),
loads AS (SELECT o_custkey % {len(names) - 1} AS i,
                 CAST(o_orderdate AS TIMESTAMP) + to_milliseconds(max(o_orderkey % 1000)) AS loaded
          FROM orders GROUP BY o_custkey % {len(names) - 1}, o_orderdate)
SELECT tablename, coalesce(CAST(max(loaded) AS VARCHAR), '1900-01-01 00:00:00') AS latest_timestamp
FROM control LEFT JOIN loads USING (i) GROUP BY tablename"""


def _ingest_full_load() -> str:
    return with_ctes(ADAPTERS, f"SELECT {_cols('products')} FROM b_products")


def _ingest_incremental() -> str:
    return with_ctes(ADAPTERS, f"SELECT {_cols('orders')} FROM b_orders "
                               f"WHERE CAST(updated_at AS BIGINT) > {_millis(INGEST_CLOCK_1)}")


def _quarantine(t: str) -> str:
    return with_ctes(ADAPTERS, f"SELECT {_cols(t)}, {flag_case(t)} FROM b_{t}")


def _distinct_rows() -> str:
    ctes = dict(ADAPTERS)
    ctes["n_orders"] = sql.next_batch("orders")
    c = _cols("orders")
    return with_ctes(ctes, f"""
SELECT DISTINCT {c}, {flag_case('orders')}
FROM (SELECT {c} FROM b_orders UNION ALL SELECT {c} FROM n_orders) u""")


def _refresh(t: str) -> str:
    return with_ctes(ADAPTERS, sql.silver_first_load(t))


def _preview() -> str:
    return with_ctes(sql.silver_ctes(), "SELECT * FROM s_customer_reviews")


def oracles() -> dict[str, str]:
    out = {name: sql.mart(name) for name in sql.MARTS}
    out.update({
        "days_since_order": _days_since_order(),
        "join_inner_chain": _join_inner_chain(),
        "join_left_chain": _join_left_chain(),
        "land_json": _land_json(),
        "land_reviews": with_ctes(ADAPTERS, f"SELECT {_cols('customer_reviews')} "
                                            "FROM b_customer_reviews"),
        "ingest_reviews": with_ctes(ADAPTERS, f"SELECT {_cols('customer_reviews')} "
                                              "FROM b_customer_reviews"),
        "archive_landing": _archive(),
        "archive_lines": _archive_lines(),
        "bronze_rejects": _bronze_rejects(),
        "create_table_if_absent": _create_table(),
        "ctas_if_absent": _ctas(),
        "named_silver_tables": _named_silver(),
        "restartable_day": _restartable_day(),
        "ingest_full_load": _ingest_full_load(),
        "extract_in_parts": with_ctes(ADAPTERS, f"SELECT {_cols('orders')} FROM b_orders"),
        "scd2_review_snapshots": _review_snapshots(),
        "distinct_customers_merged": _distinct_customers(),
        "ingest_incremental": _ingest_incremental(),
        "audit_log": _audit_log(),
        "latest_watermark": _latest_watermark(),
        "pipeline_log": _pipeline_log(),
        "pipeline_log_json": _pipeline_log(),
        "distinct_rows": _distinct_rows(),
        "preview_customer_reviews": _preview(),
    })
    out.update({f"bronze_{t}": _bronze(t) for t in COLUMNS})
    out.update({f"quarantine_{t}": _quarantine(t) for t in COLUMNS})
    out.update({f"scd2_{t}": sql.scd2_three_batches(t) for t in SCD2})
    out.update({f"silver_{t}": _refresh(t) for t in REFRESH})
    return out
