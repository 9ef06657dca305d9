"""The log of versions: what a merge writes, compaction, rows without a key, lost and repeated runs."""

from __future__ import annotations

import datetime as dt

import pytest

from strata.plans.silver import SilverStore
from strata.schemas import BRONZE

T = [dt.datetime(2024, 1, 2) + dt.timedelta(days=i) for i in range(6)]


def customers(spark, rows):
    return spark.createDataFrame(rows, BRONZE["customers"])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def base(n=40):
    return [(i, "a", f"{i}@x", "1") for i in range(n)] + [(None, "n", "n@x", "1")] * 2


def test_a_merge_writes_what_it_changes_only(spark, tmp_root):
    store = SilverStore(spark, tmp_root)
    store.merge("customers", customers(spark, base()), "1", T[0])
    store.merge("customers", customers(spark, [(1, "a", "new", "2"), (2, "a", "2@x", "1"), (99, "b", "b", "1"),
                                               (None, "n", "n@x", "1")]), "2", T[1])
    first, second = store.table("customers")._manifest()
    assert dict(first["rows"]) == {"active": 40, "loose": 1} and first["base"]
    assert dict(second["rows"]) == {"active": 1, "history": 1, "loose": 1} and not second["base"]
    assert store.read("customers").count() == 40 + 1 + 2


def test_a_merge_by_part_of_the_key_reads_what_the_source_meets(spark, tmp_root):
    mapped = lambda rs: spark.createDataFrame(rs, BRONZE["product_suppliers"])
    store = SilverStore(spark, tmp_root)
    first = [(i % 6, i, 5.0, "1") for i in range(24)]
    # Equal rows once, also where the key is NULL.
    store.merge("product_suppliers", mapped([*first, *first[:9], (None, 1, 1.0, "1"), (None, 1, 1.0, "1")]), "1", T[0])
    assert store.read("product_suppliers").count() == 25
    change = mapped([(0, 0, 6.0, "2"), (1, 1, 5.0, "3"), (2, 2, 5.0, "1"), (77, 1, 2.0, "2"), (None, 1, 1.0, "1")])
    store.merge("product_suppliers", change, "2", T[1])
    want = {(0, False): 4, (0, True): 0, (1, True): 4, (2, False): 4, (77, True): 1, (None, True): 2}
    got = {(r.supplier_id, r.is_active): r["count"] for r in
           store.read("product_suppliers").groupBy("supplier_id", "is_active").count().collect()}
    assert all(got.get(k, 0) == n for k, n in want.items())
    store.merge("product_suppliers", change, "3", T[2])
    assert store.read("product_suppliers").where("supplier_id = 0").count() == 5
    target = store.table("product_suppliers").target("4", met_by=change)
    assert {r.supplier_id for r in target.collect()} == {0, 1, 2}
    plan = target._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_an_empty_batch_and_an_unchanged_one_add_nothing(spark, tmp_root):
    store = SilverStore(spark, tmp_root)
    store.merge("customers", customers(spark, base()), "1", T[0])
    before = rows(store.read("customers"))
    store.merge("customers", customers(spark, []), "2", T[1])
    store.merge("customers", customers(spark, base()[:40]), "3", T[2])
    assert rows(store.read("customers")) == before
    assert [dict(e["rows"] or {}) for e in store.table("customers")._manifest()[1:]] == [{}, {}]


def test_compaction_changes_no_row_and_moves_closed_ones_out_of_the_log(spark, tmp_root):
    store, other = SilverStore(spark, f"{tmp_root}/a"), SilverStore(spark, f"{tmp_root}/b")
    import strata.sinks.versions as v
    keep = v.COMPACT_AT
    batches = [base(), [(i, "b", "b", "2") for i in range(30)], [(i, "c", "c", "3") for i in range(35)],
               [(i, "d", "d", "4") for i in range(5)], [(None, "n", "n@x", "1")]]
    try:
        for s, share in ((store, 0.1), (other, 1e9)):
            v.COMPACT_AT = share
            for i, b in enumerate(batches):
                s.merge("customers", customers(spark, b), str(i), T[i])
    finally:
        v.COMPACT_AT = keep
    assert rows(store.read("customers")) == rows(other.read("customers"))
    for kinds in ({"history": "all"}, {"active": "latest"}):
        assert rows(store.table("customers").read(kinds)) == rows(other.table("customers").read(kinds))
    moved = [e for e in store.table("customers")._manifest() if (e["rows"] or {}).get("old")]
    assert moved and not any((e["rows"] or {}).get("old") for e in other.table("customers")._manifest())


def test_a_repeated_batch_replaces_itself_also_after_a_compaction(spark, tmp_root):
    store = SilverStore(spark, tmp_root)
    store.merge("customers", customers(spark, base()), "1", T[0])
    change = [(i, "b", "b", "2") for i in range(30)]
    store.merge("customers", customers(spark, change), "2", T[1])
    once = rows(store.read("customers"))
    store.table("customers").compact()
    assert rows(store.read("customers")) == once
    store.merge("customers", customers(spark, change), "2", T[1])
    assert rows(store.read("customers")) == once
    with pytest.raises(ValueError):
        store.merge("customers", customers(spark, change), "1", T[0])


def test_an_attempt_without_a_commit_is_never_read(spark, tmp_root):
    store = SilverStore(spark, tmp_root)
    store.merge("customers", customers(spark, base()), "1", T[0])
    before = rows(store.read("customers"))

    def fail(hits):
        raise RuntimeError("stopped before the commit")

    from pyspark.sql import functions as F
    changes = store.read("customers").withColumn("kind", F.lit("active"))
    with pytest.raises(RuntimeError):
        store.table("customers").append("2", changes, fail)
    assert rows(store.read("customers")) == before


def test_another_session_reads_the_same_log(spark, tmp_root):
    SilverStore(spark, tmp_root).merge("customers", customers(spark, base()), "1", T[0])
    before = rows(SilverStore(spark, tmp_root).read("customers"))
    for t in spark.catalog.listTables("spark_catalog.default"):
        if t.name.startswith("strata_log_"):
            spark.sql(f"DROP TABLE spark_catalog.default.{t.name}")
    assert rows(SilverStore(spark, tmp_root).read("customers")) == before


def test_a_lost_part_is_an_error(spark, tmp_root):
    import shutil
    store = SilverStore(spark, tmp_root)
    store.merge("customers", customers(spark, base()), "1", T[0])
    part = store.table("customers")._manifest()[0]["attempt"]
    shutil.rmtree(f"{tmp_root}/customers/log/part={part}")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read("customers").count()


def test_null_keys_close_under_corrected_semantics(spark, tmp_root):
    store = SilverStore(spark, tmp_root)
    for i, row in enumerate([(None, "n", "one", "1"), (None, "n", "two", "2"), (None, "n", "two", "2")]):
        store.merge("customers", customers(spark, [row]), str(i), T[i], semantics="corrected")
    assert sorted((r.email, r.is_active, r.effective_end_date) for r in store.read("customers").collect()) == \
        [("one", False, T[1]), ("two", True, None)]


def test_a_merge_leaves_no_shuffle_files(spark, tmp_root):
    import glob
    import os
    import tempfile
    import time
    local = spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())
    files = lambda: set(glob.glob(f"{local}/**/shuffle_*.data", recursive=True))
    old = files()
    SilverStore(spark, tmp_root).merge("customers", customers(spark, base(4000)), "1", T[0])
    for _ in range(50):
        left = sum(os.path.getsize(f) for f in files() - old if os.path.exists(f))
        if left < 2000:
            break
        time.sleep(0.1)
    assert left < 2000
