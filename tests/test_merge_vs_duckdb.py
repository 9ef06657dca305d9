"""The join-form SCD2 merge equals a native MERGE statement, row for row.

Random batches (NULL keys and NULL values included) are merged three times
in Spark (``SilverStore.merge``) and in DuckDB with ``MERGE INTO``; the
final tables must be equal. Batches after the first have at most one row
per match key, as the original warehouse requires.
"""

from __future__ import annotations

import datetime as dt

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.scd2 import SPECS, hit_counts
from strata.oracle.sql import FLAG
from strata.plans.silver import SilverStore
from strata.schemas import BRONZE
from strata.session import work_dir

NOWS = [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4)]

names = st.sampled_from(["a", "b", None])
stamps = st.sampled_from(["1", "2", None])
keys = st.one_of(st.none(), st.integers(1, 6))


@st.composite
def customer_batches(draw):
    out = []
    for i in range(3):
        rows = draw(st.lists(st.tuples(keys, names, names, stamps), max_size=8))
        # One row per non-null key (NULL keys never match, repeats are fine).
        seen, batch = set(), []
        for r in rows:
            if r[0] is not None and r[0] in seen:
                continue
            seen.add(r[0])
            batch.append(r)
        out.append(batch)
    return out


@st.composite
def mapping_batches(draw):
    out = []
    prices = st.sampled_from([1.0, 2.5, None])
    for i in range(3):
        rows = draw(st.lists(st.tuples(st.integers(1, 4), st.integers(100, 103), prices, stamps),
                             max_size=8))
        if i == 0:
            batch = list(dict.fromkeys(rows))
        else:
            batch = list({r[0]: r for r in rows}.values())    # one row per supplier
        out.append(batch)
    return out




def native_merge(table: str, now: dt.datetime) -> str:
    """The MERGE statement that a table's spec describes."""
    spec, cols = SPECS[table], BRONZE[table].fieldNames()
    on = " AND ".join(f"old.{k} = new.{k}" for k in spec.keys)
    differs = [f"old.{c} <> new.{c}" for c in spec.changed] + [f"old.{c} = new.{c}" for c in spec.unchanged]
    end = "NULL" if spec.end_on_expire == "null" else f"TIMESTAMP '{now}'"
    given = ", ".join(f"new.{c}" for c in cols)
    flagged = "new.flagged" if spec.insert_flag else "NULL"
    kind = "DISTINCT" if spec.distinct_source else ""
    return (f"MERGE INTO tgt old USING (SELECT {kind} {', '.join(cols)}, ({FLAG[table]}) IS TRUE AS flagged FROM src) new "
            f"ON {on} AND old.is_active "
            f"WHEN MATCHED AND ({' OR '.join(differs)}) THEN UPDATE SET is_active = FALSE, effective_end_date = {end} "
            f"WHEN NOT MATCHED THEN INSERT VALUES ({given}, {flagged}, TIMESTAMP '{now}', NULL, TRUE)")


DDL = {
    "customers": "customer_id BIGINT, name VARCHAR, email VARCHAR, updated_at VARCHAR",
    "product_suppliers": "supplier_id BIGINT, product_id BIGINT, supply_price DOUBLE, "
                         "last_updated VARCHAR",
}


def duck_run(table, batches):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE tgt ({DDL[table]}, is_quarantined BOOLEAN, "
                "effective_start_date TIMESTAMP, effective_end_date TIMESTAMP, is_active BOOLEAN)")
    ncols = len(DDL[table].split(","))
    for batch, now in zip(batches, NOWS):
        con.execute(f"CREATE OR REPLACE TABLE src ({DDL[table]})")
        if batch:
            con.executemany(f"INSERT INTO src VALUES ({', '.join('?' * ncols)})", batch)
        con.execute(native_merge(table, now))
    return sorted(con.execute("SELECT * FROM tgt").fetchall(), key=repr)


def spark_run(spark, table, batches):
    store = SilverStore(spark, work_dir(spark, "merge_prop"))
    for i, (batch, now) in enumerate(zip(batches, NOWS), 1):
        store.merge(table, spark.createDataFrame(batch, BRONZE[table]), str(i), now)
    return sorted((tuple(r) for r in store.read(table).collect()), key=repr)


PROP = settings(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@PROP
@given(batches=customer_batches())
def test_customers_merge_equals_native_merge(spark, batches):
    assert spark_run(spark, "customers", batches) == \
        duck_run("customers", batches)


@PROP
@given(batches=mapping_batches())
def test_mappings_merge_equals_native_merge(spark, batches):
    assert spark_run(spark, "product_suppliers", batches) == \
        duck_run("product_suppliers", batches)


# --- counted hits: no pair of target and source rows is ever made -------------------

def hits_by_hand(table, target, source):
    """How many source rows the merge's condition holds for, by comparing every pair."""
    spec, cols = SPECS[table], BRONZE[table].fieldNames()
    at = {c: i for i, c in enumerate(cols)}

    def hit(t, s):
        if any(t[at[k]] is None or t[at[k]] != s[at[k]] for k in spec.keys):
            return False
        both = lambda c: t[at[c]] is not None and s[at[c]] is not None
        return any(both(c) and t[at[c]] != s[at[c]] for c in spec.changed) or \
            any(both(c) and t[at[c]] == s[at[c]] for c in spec.unchanged)
    return sorted(((*t, sum(hit(t, s) for s in source)) for t in target), key=repr)


reviews = st.lists(st.tuples(st.sampled_from(["r1", "r2", None]), st.sampled_from([1, None]), st.sampled_from([5, 6]),
                             st.sampled_from([1, 2, None]), st.sampled_from(["x", None]), stamps), max_size=12)
mappings = st.lists(st.tuples(st.sampled_from([1, 2, None]), st.integers(100, 102), st.sampled_from([1.0, 2.5, None]),
                              stamps), max_size=12)


@PROP
@given(target=reviews, source=reviews)
def test_counted_hits_of_reviews(spark, target, source):
    _counted(spark, "customer_reviews", target, source)


@PROP
@given(target=mappings, source=mappings)
def test_counted_hits_of_mappings(spark, target, source):
    _counted(spark, "product_suppliers", target, source)


def _counted(spark, table, target, source):
    got = hit_counts(spark.createDataFrame(target, BRONZE[table]), spark.createDataFrame(source, BRONZE[table]), SPECS[table])
    assert sorted(map(tuple, got.collect()), key=repr) == hits_by_hand(table, target, source)


def test_a_supplier_with_a_thousand_rows_on_both_sides_makes_no_pairs(spark):
    target = [(1, i, float(i % 7), str(i % 5)) for i in range(1000)]
    source = [(1, i, float(i % 11), str(i % 3)) for i in range(1000)]
    df = hit_counts(spark.createDataFrame(target, BRONZE["product_suppliers"]),
                    spark.createDataFrame(source, BRONZE["product_suppliers"]), SPECS["product_suppliers"])
    got = df.collect()
    assert sorted(map(tuple, got), key=repr) == hits_by_hand("product_suppliers", target, source)
    assert max(join_rows(df)) <= 2000


def join_rows(df) -> list[int]:
    """Output rows of every join of an executed plan."""
    out, seen = [], [df._jdf.queryExecution().executedPlan()]
    while seen:
        p = seen.pop()
        name = p.nodeName()
        if "Join" in name:
            out.append(p.metrics().apply("numOutputRows").value())
        if name.startswith("AdaptiveSparkPlan"):
            seen.append(p.executedPlan())
        elif "QueryStage" in name:
            seen.append(p.plan())
        kids = p.children()
        seen += [kids.apply(i) for i in range(kids.size())]
    assert out
    return out


def test_several_matches_are_an_error_exactly_when_a_row_is_hit_twice(spark):
    import pytest
    from strata.plans.silver import MultiMatchError
    first = [(1, 100, 1.0, "1"), (1, 101, 2.0, "1"), (2, 100, 1.0, "1")]
    for second in ([(1, 100, 2.0, "2"), (1, 101, 2.0, "2")],      # the row priced 1.0 is hit twice
                   [(1, 100, 1.0, "2"), (1, 101, 1.0, "3"), (2, 100, 5.0, "2")],   # the row priced 2.0
                   [(1, 100, None, "2"), (1, 101, None, "3")],    # NULL prices hit nothing
                   [(1, 100, 1.0, "1"), (2, 103, 1.0, "2"), (2, 104, 2.0, "2")]):  # each row at most once
        store = SilverStore(spark, work_dir(spark, "multi"))
        load = lambda rows, batch, now: store.merge(
            "product_suppliers", spark.createDataFrame(rows, BRONZE["product_suppliers"]), batch, now)
        load(first, "1", NOWS[0])
        before = sorted(map(tuple, store.read("product_suppliers").collect()))
        if max(r[-1] for r in hits_by_hand("product_suppliers", first, second)) > 1:
            with pytest.raises(MultiMatchError):
                load(second, "2", NOWS[1])
            assert sorted(map(tuple, store.read("product_suppliers").collect())) == before
        else:
            load(second, "2", NOWS[1])
            assert sorted(map(tuple, store.read("product_suppliers").collect()), key=repr) == \
                duck_run("product_suppliers", [first, second])
