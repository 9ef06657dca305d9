"""Named tables: made once, left alone after that, refused under another schema."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from strata.plans.silver import SilverStore
from strata.schemas import BRONZE, silver_schema
from strata.sinks.catalog import (
    SchemaMismatch, create_database, create_if_absent, ctas_if_absent, insert, publish_silver,
)

T = [dt.datetime(2024, 1, 2 + i) for i in range(4)]


@pytest.fixture()
def database(spark, tmp_root):
    name = f"db_{uuid.uuid4().hex[:8]}"
    create_database(spark, name, f"{tmp_root}/db")
    return name


def test_a_table_is_made_once_and_outlives_its_session(spark, tmp_root, database):
    name, schema = f"{database}.orders", silver_schema("orders")
    assert create_if_absent(spark, name, schema, f"{tmp_root}/t") and spark.table(name).count() == 0
    assert spark.table(name).schema.fieldNames() == schema.fieldNames()
    row = (1, 2, "3", 4.0, "5", False, T[0], None, True)
    insert(spark.createDataFrame([row], schema).select(*reversed(schema.fieldNames())), name)
    assert not create_if_absent(spark, name, schema, f"{tmp_root}/t") and tuple(spark.table(name).first()) == row
    with pytest.raises(SchemaMismatch):
        create_if_absent(spark, name, silver_schema("customers"), f"{tmp_root}/t")
    with pytest.raises(SchemaMismatch):
        insert(spark.range(1), name)
    spark.sql(f"DROP TABLE {name}")
    assert create_if_absent(spark, name, schema, f"{tmp_root}/t") and spark.table(name).count() == 1


def test_ctas_runs_once_and_a_failed_one_leaves_nothing(spark, tmp_root, database):
    from pyspark.sql import functions as F
    name = f"{database}.mart"
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        ctas_if_absent(broken, name, f"{tmp_root}/m")
    assert not spark.catalog.tableExists(name)
    assert ctas_if_absent(spark.range(3), name, f"{tmp_root}/m") and spark.table(name).count() == 3
    assert not ctas_if_absent(broken, name, f"{tmp_root}/m") and spark.table(name).count() == 3
    with pytest.raises(SchemaMismatch):
        ctas_if_absent(spark.range(3).withColumnRenamed("id", "x"), name, f"{tmp_root}/m")


def test_silver_by_name_equals_the_store(spark, tmp_root, database):
    store = SilverStore(spark, f"{tmp_root}/silver")
    names = publish_silver(store, database)
    assert len(names) == 8 and all(spark.table(n).count() == 0 for n in names)
    rows = [[(i, "a", f"{i}@x", "1") for i in range(20)] + [(None, "n", "n", "1")],
            [(i, "b", "b", "2") for i in range(5)], [(i, "c", "c", "3") for i in range(18)], [(3, "d", "d", "4")]]
    for i, r in enumerate(rows):
        store.merge("customers", spark.createDataFrame(r, BRONZE["customers"]), str(i), T[i])
        publish_silver(store, database)
        key = lambda x: repr(tuple(x))
        assert sorted(spark.table(f"{database}.customers").collect(), key=key) == \
            sorted(store.read("customers").collect(), key=key)
    store.refresh("categories", spark.createDataFrame([(1, "x", "1")], BRONZE["categories"]), "1")
    publish_silver(store, database)
    assert spark.table(f"{database}.categories").count() == 1
