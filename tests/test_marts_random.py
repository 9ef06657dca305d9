"""Pre-aggregated marts equal the direct-form SQL on random silver tables.

Small random tables with duplicate keys, NULL keys, NULL flags and values,
orders without items and products without reviews or suppliers: every mart
is computed by the Spark plans in ``strata.plans.gold`` and by the oracle's
direct-form SQL in DuckDB, and the results must be equal.
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.oracle.sql import MARTS as MART_SQL
from strata.plans import gold
from strata.schemas import silver_schema

AS_OF = dt.date(2025, 1, 1)
NOW = dt.datetime(2024, 1, 2)

key = st.one_of(st.none(), st.integers(1, 4))
name = st.one_of(st.none(), st.sampled_from(["a", "b"]))
flag = st.one_of(st.none(), st.booleans())
price = st.one_of(st.none(), st.sampled_from([0.5, 1.25, 19.99, 100.0]))
qty = st.one_of(st.none(), st.integers(-1, 3))
millis = st.one_of(st.none(), st.sampled_from(["1704067200000", "1704153600000",
                                                "1706745600000"]))
rating = st.one_of(st.none(), st.integers(1, 5))


def rows_of(table, draw):
    """Random rows in the silver column order of ``table``."""
    scd = lambda: (NOW, None, draw(flag))  # noqa: E731  start, end, is_active
    n = draw(st.integers(0, 6))
    out = []
    for _ in range(n):
        if table == "customers":
            r = (draw(key), draw(name), draw(name), "1", draw(flag), *scd())
        elif table == "orders":
            r = (draw(key), draw(key), draw(millis), draw(price), "1", draw(flag), *scd())
        elif table == "order_items":
            r = (draw(key), draw(key), draw(key), draw(qty), draw(price), "1", draw(flag), *scd())
        elif table == "product_suppliers":
            r = (draw(key), draw(key), draw(price), "1", draw(flag), *scd())
        elif table == "customer_reviews":
            r = (draw(st.sampled_from(["r1", "r2"])), draw(key), draw(key), draw(rating),
                 draw(name), "1", draw(flag), *scd())
        elif table == "products":
            r = (draw(key), draw(name), draw(key), draw(price), "1", draw(flag))
        elif table == "categories":
            r = (draw(key), draw(name), "1", draw(flag))
        else:  # suppliers
            r = (draw(key), draw(name), None, None, None, None, None, None, "1", draw(flag))
        out.append(r)
    return out


TABLES = ["customers", "orders", "order_items", "product_suppliers", "customer_reviews",
          "products", "categories", "suppliers"]


@st.composite
def silver_rows(draw):
    return {t: rows_of(t, draw) for t in TABLES}


_DUCK_TYPE = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return None if v is None else str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple("" if x is None else x for x in t))


@pytest.mark.parametrize("mart", list(gold.MARTS))
@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture,
                                 HealthCheck.too_slow])
@given(data=silver_rows())
def test_mart_equals_direct_sql(spark, mart, data):
    silver = {t: spark.createDataFrame(data[t], silver_schema(t)) for t in TABLES}
    fn = gold.MARTS[mart]
    df = fn(silver, AS_OF) if mart == "customer_engagement" else fn(silver)
    con = duckdb.connect()
    for t in TABLES:
        schema = silver_schema(t)
        cols = ", ".join(f"{f.name} {_DUCK_TYPE[f.dataType.simpleString()]}"
                         for f in schema.fields)
        con.execute(f"CREATE TABLE s_{t} ({cols})")
        if data[t]:
            marks = ", ".join("?" * len(schema.fields))
            con.executemany(f"INSERT INTO s_{t} VALUES ({marks})", data[t])
    res = con.execute(MART_SQL[mart])
    d_cols = [d[0] for d in res.description]
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(d_cols, res.fetchall())
