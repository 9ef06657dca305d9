"""Quarantine rules and SCD2 merge cases on tiny in-code frames."""

from __future__ import annotations

import datetime as dt

import pytest

from strata.operators.quality import distinct_flagged, quarantine
from strata.operators.scd2 import SPECS, merge_source, scd2_merge
from strata.plans.silver import MultiMatchError, SilverStore
from strata.schemas import BRONZE

T1, T2, T3 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4)


def frame(spark, table, rows):
    return spark.createDataFrame(rows, BRONZE[table])


# --- quarantine ----------------------------------------------------------------

def flags(spark, table, rows):
    return [r.is_quarantined for r in quarantine(frame(spark, table, rows), table).collect()]


def test_orders_rule_nulls_negative_and_unknown(spark):
    rows = [(1, 10, "1", 5.0, "1"),      # clean
            (2, None, "1", 5.0, "1"),    # null customer
            (3, 10, None, 5.0, "1"),     # null date
            (4, 10, "1", -1.0, "1"),     # negative amount
            (5, 10, "1", None, "1")]     # NULL amount: unknown -> not flagged
    assert flags(spark, "orders", rows) == [False, True, True, True, False]


def test_order_items_rule(spark):
    rows = [(1, 1, 1, 1, 1.0, "1"), (2, 1, 1, -1, 1.0, "1"), (3, 1, 1, 1, -1.0, "1"),
            (None, 1, 1, 1, 1.0, "1"), (5, 1, None, 1, 1.0, "1"), (6, 1, 1, None, None, "1")]
    assert flags(spark, "order_items", rows) == [False, True, True, True, True, False]


def test_products_do_not_check_product_id(spark):
    rows = [(None, "a", 1, 1.0, "1"), (1, None, 1, 1.0, "1"), (2, "b", None, 1.0, "1")]
    assert flags(spark, "products", rows) == [False, True, True]


def test_product_suppliers_do_not_check_supplier_id(spark):
    rows = [(None, 1, 1.0, "1"), (1, None, 1.0, "1"), (1, 2, None, "1")]
    assert flags(spark, "product_suppliers", rows) == [False, True, True]


@pytest.mark.parametrize("table,rows,expected", [
    ("customers", [(1, "a", "e", "1"), (None, "a", "e", "1"), (1, None, "e", "1"),
                   (1, "a", None, "1")], [False, True, True, True]),
    ("categories", [(1, "a", "1"), (None, "a", "1"), (1, None, "1")], [False, True, True]),
    ("suppliers", [(1, "a", None, None, None, None, None, None, "1"),
                   (None, "a", None, None, None, None, None, None, "1"),
                   (1, None, None, None, None, None, None, None, "1")], [False, True, True]),
    ("customer_reviews", [("1", 1, 1, 5, None, "1"), ("2", None, 1, 5, "x", "1"),
                          ("3", 1, None, 5, "x", "1"), ("4", 1, 1, None, "x", "1")],
     [False, True, True, True]),
])
def test_other_rules(spark, table, rows, expected):
    assert flags(spark, table, rows) == expected


def test_distinct_flagged_collapses_repeats(spark):
    rows = [(1, 10, "1", 5.0, "1")] * 3 + [(2, 10, "1", 5.0, "1")]
    assert distinct_flagged(frame(spark, "orders", rows), "orders").count() == 2


# --- SCD2 merge --------------------------------------------------------------------

def merge_runs(spark, tmp_root, table, batches, **kw):
    store = SilverStore(spark, tmp_root)
    for i, (rows, now) in enumerate(batches, 1):
        store.merge(table, frame(spark, table, rows), str(i), now, **kw)
    return store.read(table)


def state(df, key):
    return sorted((getattr(r, key), r.email if hasattr(r, "email") else None, r.is_active,
                   r.effective_start_date, r.effective_end_date) for r in df.collect())


def test_new_same_changed_and_gap(spark, tmp_root):
    b1 = [(1, "a", "a@x", "1"), (2, "b", "b@x", "1")]
    b2 = [(1, "a", "a@x", "1"),            # same -> nothing
          (2, "b", "b2@x", "2"),           # changed -> expired only (gap)
          (3, "c", "c@x", "2")]            # new -> inserted
    out = merge_runs(spark, tmp_root, "customers", [(b1, T1), (b2, T2), (b2, T3)])
    rows = state(out, "customer_id")
    assert rows == [
        (1, "a@x", True, T1, None),
        (2, "b2@x", True, T3, None),        # new version only on the next run
        (2, "b@x", False, T1, T2),
        (3, "c@x", True, T2, None),
    ]


def test_null_key_inserted_every_run_and_null_is_not_a_change(spark, tmp_root):
    b = [(None, "n", "n@x", "1"), (5, "e", None, "1")]
    b_later = [(None, "n", "n@x", "1"), (5, "e", "e@x", "1")]   # NULL -> value
    out = merge_runs(spark, tmp_root, "customers", [(b, T1), (b_later, T2), (b_later, T3)])
    got = out.collect()
    assert sum(1 for r in got if r.customer_id is None) == 3
    five = [r for r in got if r.customer_id == 5]
    assert len(five) == 1 and five[0].is_active and five[0].email is None


def test_multi_match_raises(spark, tmp_root):
    b1 = [(1, 101, 5.0, "1"), (1, 102, 6.0, "1")]
    # Two source rows for supplier 1 that both hit the same target rows.
    b2 = [(1, 101, 7.0, "2"), (1, 102, 8.0, "2")]
    with pytest.raises(MultiMatchError):
        merge_runs(spark, tmp_root, "product_suppliers", [(b1, T1), (b2, T2)])


def test_product_suppliers_reference_semantics(spark, tmp_root):
    b1 = [(1, 101, 5.0, "1"), (1, 102, 6.0, "1"), (2, 103, 1.0, "1")]
    b2 = [(1, 101, 5.0, "1"),      # unchanged, but "last_updated =" is a hit
          (3, 104, 2.0, "2")]      # new supplier
    out = merge_runs(spark, tmp_root, "product_suppliers", [(b1, T1), (b2, T2)])
    got = {(r.supplier_id, r.product_id): r for r in out.collect()}
    assert not got[(1, 101)].is_active and got[(1, 101)].effective_end_date is None
    assert not got[(1, 102)].is_active           # matched on supplier alone
    assert got[(2, 103)].is_active
    assert got[(3, 104)].is_active


def test_reviews_flag_not_inserted(spark, tmp_root):
    b1 = [("1", 1, 1, 5, "good", "1"), ("1", 1, 1, 5, "good", "1"), ("2", None, 1, 5, "x", "1")]
    out = merge_runs(spark, tmp_root, "customer_reviews", [(b1, T1)]).collect()
    assert len(out) == 3                          # no DISTINCT in this merge
    assert all(r.is_quarantined is None for r in out)


def test_corrected_inserts_new_version_in_same_pass(spark, tmp_root):
    b1 = [(1, "a", "a@x", "1")]
    b2 = [(1, "a", "a2@x", "2")]
    out = merge_runs(spark, tmp_root, "customers", [(b1, T1), (b2, T2)],
                     semantics="corrected")
    rows = state(out, "customer_id")
    assert rows == [(1, "a2@x", True, T2, None), (1, "a@x", False, T1, T2)]


def test_history_never_changes(spark, tmp_root):
    b1 = [(1, "a", "a@x", "1")]
    b2 = [(1, "a", "a2@x", "2")]
    b3 = [(1, "a", "a3@x", "3")]
    store = SilverStore(spark, tmp_root)
    for i, (b, now) in enumerate([(b1, T1), (b2, T2), (b2, T3)], 1):
        store.merge("customers", frame(spark, "customers", b), str(i), now)
    hist = sorted(map(tuple, store.table("customers").read({"history": "all"}).collect()))
    store.merge("customers", frame(spark, "customers", b3), "4", T3 + dt.timedelta(days=1))
    hist_after = sorted(map(tuple, store.table("customers").read({"history": "all"}).collect()))
    assert set(hist) <= set(hist_after)


def test_rerun_of_a_batch_is_idempotent(spark, tmp_root):
    b1 = [(1, "a", "a@x", "1"), (2, "b", "b@x", "1")]
    b2 = [(2, "b", "b2@x", "2"), (3, "c", "c@x", "2")]
    store = SilverStore(spark, tmp_root)
    store.merge("customers", frame(spark, "customers", b1), "1", T1)
    store.merge("customers", frame(spark, "customers", b2), "2", T2)
    first = sorted(map(tuple, store.read("customers").collect()))
    store.merge("customers", frame(spark, "customers", b2), "2", T2)   # retry
    assert sorted(map(tuple, store.read("customers").collect())) == first


def test_lazy_merge_matches_spec_on_empty_target(spark):
    b = frame(spark, "orders", [(1, 10, "1", 5.0, "1"), (1, 10, "1", 5.0, "1")])
    spec = SPECS["orders"]
    from strata.functions.columns import empty_frame
    from strata.schemas import silver_schema
    res = scd2_merge(empty_frame(spark, silver_schema("orders")), merge_source(b, spec),
                     spec, T1)
    assert res.expired.count() == 0 and res.current.count() == 1


def test_tables_exist_typed_and_empty_before_any_load(spark, tmp_root):
    """CREATE TABLE IF NOT EXISTS: an unloaded silver table reads as a typed empty table."""
    from strata.schemas import silver_schema
    store = SilverStore(spark, tmp_root)
    for t in ("customers", "products"):
        df = store.read(t)
        assert df.schema.fieldNames() == silver_schema(t).fieldNames()
        assert df.count() == 0


def test_a_rerun_refresh_is_the_latest_and_a_failed_one_changes_nothing(spark, tmp_root):
    from strata.sinks.tables import BatchTable
    from pyspark.sql import functions as F
    t = BatchTable(spark, tmp_root, spark.range(1).schema)
    for batch, n in (("1", 1), ("2", 2), ("3", 3), ("3", 5)):
        t.write_batch(batch, {"data": spark.range(n)})
    assert t.committed() == ["1", "2", "3"] and t.read().count() == 5
    broken = spark.range(2).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        t.write_batch("3", {"data": broken})
    assert t.read().count() == 5
    t.write_batch("1", {"data": spark.range(7)})
    assert t.committed() == ["2", "3", "1"] and t.read().count() == 7
    with pytest.raises(ValueError):
        t.previous_for("2")


def test_a_lost_committed_folder_is_an_error(spark, tmp_root):
    import shutil
    from strata.sinks.tables import BatchTable
    t = BatchTable(spark, tmp_root, spark.range(1).schema)
    t.write_batch("1", {"data": spark.range(3)})
    shutil.rmtree(f"{tmp_root}/batch=1")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        t.read().count()
