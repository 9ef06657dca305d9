"""Equal-depth extracts, snapshot feeds and mergeable distinct counts against their plain forms."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.distinct import distinct_counts, distinct_state, merged
from strata.plans.silver import SilverStore
from strata.plans.snapshots import changes, feed, merge_snapshots
from strata.schemas import BRONZE
from strata.sources.balanced import equal_depth_predicates, sql_literal

T = [dt.datetime(2024, 1, 2 + i) for i in range(6)]


# --- equal-depth parts ----------------------------------------------------------

def sizes(df, predicates):
    """Rows of each part; every row must fit exactly one predicate."""
    fits = sum((F.when(F.expr(p), 1).otherwise(0) for p in predicates), F.lit(0))
    assert df.where(fits != 1).count() == 0
    return list(df.agg(*[F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(predicates)]).first())


LUMPY = {
    "even": "id", "gaps": "id * id * id", "low": "cast(sqrt(id) as bigint) * 100000", "negative": "500 - id",
    "nulls": "case when id % 3 > 0 then id end", "double": "cast(id as double) / 7", "time": "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id*id as int))",
    "text": "'o''' || lpad(id, 6, '0')", "day": "date_add(date'2020-01-01', cast(id as int))",
}


@pytest.mark.parametrize("kind", [k for k in LUMPY if k != "text"])
def test_parts_are_complete_disjoint_and_even(spark, kind):
    df = spark.range(4000).selectExpr("id", f"{LUMPY[kind]} AS k")
    got = sizes(df, equal_depth_predicates(df, "k", 8, then="id"))
    assert max(got) <= 2 * 4000 / 8
    # also for rows that the bounds have not seen
    more = spark.range(9000).selectExpr("id", f"{LUMPY[kind]} AS k") if kind != "time" else df
    sizes(more, equal_depth_predicates(df.where("id % 5 = 1"), "k", 8, then="id"))


def test_one_value_with_a_third_of_the_rows_is_cut_by_the_second_column(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 77 when id % 30 = 1 then null else id end AS k")
    alone = sizes(df, equal_depth_predicates(df, "k", 10))
    assert max(alone) >= 1000
    assert max(sizes(df, equal_depth_predicates(df, "k", 10, then="id"))) <= 600


def test_small_tables(spark):
    for rows in ([], [(1,)], [(None,)], [(1,)] * 5):
        df = spark.createDataFrame(rows, "k long")
        assert sum(sizes(df, equal_depth_predicates(df, "k", 4))) == len(rows)


def test_literals():
    assert [sql_literal(x) for x in (1, 2.5, "o'x", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3))] == \
        ["1", "2.5", "'o''x'", "DATE '2024-01-02'", "TIMESTAMP '2024-01-02 03:00:00'"]
    with pytest.raises(ValueError):
        sql_literal(None)


# --- snapshots ---------------------------------------------------------------------

def reviews(spark, rows):
    return spark.createDataFrame(rows, BRONZE["customer_reviews"])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_feeds_give_what_whole_snapshots_give(spark, tmp_root, seed):
    rng = random.Random(seed)
    state = {i: (f"r{i}", 1, 2, 3, "x", "1") for i in range(30)}
    days = []
    for _ in range(6):
        for i in rng.sample(range(36), 10):  # change, change back, add, delete, NULLs
            state[i] = (f"r{i}", 1, 2, rng.choice([1, 2, 3, None]), rng.choice(["x", "y", None]), "1")
        for i in rng.sample(sorted(state), 2):
            del state[i]
        days.append([*state.values(), (None, 1, 1, 1, "no key", "1")])
    whole, fed = SilverStore(spark, f"{tmp_root}/whole"), SilverStore(spark, f"{tmp_root}/fed")
    for i, rows in enumerate(days):
        whole.merge("customer_reviews", reviews(spark, rows), str(i), T[i])
    merge_snapshots(fed, "customer_reviews", [(str(i), reviews(spark, r), T[i]) for i, r in enumerate(days)])
    assert rows_of(fed.read("customer_reviews")) == rows_of(whole.read("customer_reviews"))


def test_a_feed_holds_what_changed_and_what_is_due(spark):
    row = lambda i, rating=1: (f"r{i}", 1, 1, rating, None, None)
    days = [[row(i) for i in range(100)], [row(i) for i in range(99)] + [row(99, 5)], [row(0, 2)] + [row(i) for i in range(1, 99)] + [row(99, 5)]]
    frames = [reviews(spark, d) for d in days]
    assert feed(frames[:1], "customer_reviews").count() == 100
    assert rows_of(feed(frames[:2], "customer_reviews")) == [row(99, 5)]
    assert rows_of(feed(frames, "customer_reviews")) == sorted([row(0, 2), row(99, 5)])
    assert changes(frames[0], reviews(spark, [row(1)] * 3 + [row(1, 9)] * 2)).count() == 2


# --- distinct counts ------------------------------------------------------------------

def test_merged_states_count_like_the_whole(spark):
    df = spark.range(60_000).selectExpr("id % 4 AS g", "case when id % 50 = 0 then null else (id * 7919) % 40000 - 100 end AS v", "id % 3 AS batch")
    batches = [df.where(f"batch = {i}") for i in range(3)]
    states = [distinct_state(b, ["g"], "v") for b in batches]
    got = distinct_counts(merged([*states, states[0]], ["g"]), ["g"], "n")
    assert rows_of(got) == rows_of(df.groupBy("g").agg(F.count_distinct("v").alias("n")))
    assert distinct_counts(merged(states[:1], ["g"]), ["g"], "n").count() == 4


def test_the_state_is_smaller_than_its_keys(spark, tmp_root):
    df = spark.range(200_000).selectExpr("id % 5 AS g", "(id * 48271) % 30000 AS v")
    distinct_state(df, ["g"], "v").write.parquet(f"{tmp_root}/state")
    df.distinct().write.parquet(f"{tmp_root}/keys")
    size = lambda p: spark.read.format("binaryFile").load(f"{p}/*.parquet").agg(F.sum("length")).first()[0]
    assert size(f"{tmp_root}/state") < size(f"{tmp_root}/keys")


def test_a_state_of_few_values_far_apart_is_no_larger_than_its_keys(spark, tmp_root):
    df = spark.range(20_000).selectExpr("id AS g", "(id * 48271) % 900000 * 1000 - 77 AS v")
    distinct_state(df, ["g"], "v").write.parquet(f"{tmp_root}/state")
    state = spark.read.parquet(f"{tmp_root}/state")
    assert dict(state.dtypes)["bits"] == "bigint" and state.count() == 20_000
    size = spark.read.format("binaryFile").load(f"{tmp_root}/state/*.parquet").agg(F.sum("length")).first()[0]
    assert size < 24 * 20_000 + 100_000
    assert distinct_counts(merged([state, state], ["g"]), ["g"], "n").where("n = 1").count() == 20_000


def test_empty_groups_and_values(spark):
    none = spark.createDataFrame([], "g string, v long")
    assert distinct_counts(distinct_state(none, ["g"], "v"), ["g"], "n").collect() == []
    some = spark.createDataFrame([(None, 3), (None, 3), ("a", None), ("b", -5), ("b", 2**40)], "g string, v long")
    assert rows_of(distinct_counts(distinct_state(some, ["g"], "v"), ["g"], "n")) == [("b", 2), (None, 1)]
