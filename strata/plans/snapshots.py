"""Daily snapshots as a change feed.

The reviews feed lands the whole table every day, and its bronze glob reads
all days at once: one review then has several source rows, which the merge
refuses. Merged one by one the snapshots are right, but each merge reads a
whole snapshot to find the few rows that changed.

The feed of a day is what the merge of that day can act on:

* rows that the snapshot before does not hold like this (new or changed);
* rows that changed the day before and are still the same: that merge only
  expired the old version, the new one is due now;
* rows with a NULL key, which a merge inserts each time.

All others met an equal version, or one they cannot change, the day before and
would do so again. Merging the feeds gives the rows that merging the snapshots
gives.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.scd2 import SPECS
from strata.plans.silver import SilverStore


def _same(a: DataFrame, b: DataFrame):
    return reduce(lambda p, q: p & q, [a[c].eqNullSafe(b[c]) for c in a.columns])


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``after`` that ``before`` does not hold, repeated ones as often as they are there.

    ``before`` is reduced to distinct rows in the map tasks; whole rows are
    compared, so a hash collision cannot hide a change.
    """
    b = before.distinct().alias("b")
    return after.join(b, _same(after, b), "left_anti")


def feed(snapshots: list[DataFrame], table: str) -> DataFrame:
    """The feed of the last of up to three consecutive snapshots, oldest first."""
    last = snapshots[-1]
    if len(snapshots) == 1:
        return last
    keys = SPECS[table].keys
    unkeyed = reduce(lambda p, q: p | q, [F.col(k).isNull() for k in keys])
    now = last.where(~unkeyed)
    fresh = changes(snapshots[-2].where(~unkeyed), now)
    out = fresh.unionByName(last.where(unkeyed))
    if len(snapshots) == 2:
        # The first merge into an empty table only inserts: nothing is due.
        return out
    due = changes(snapshots[-3].where(~unkeyed), snapshots[-2].where(~unkeyed)).distinct().alias("d")
    return out.unionByName(now.join(due, _same(now, due), "left_semi"))


def merge_snapshots(store: SilverStore, table: str, days: list[tuple[str, DataFrame, dt.datetime]]) -> None:
    """Merge (batch, snapshot, clock) of consecutive days by their feeds."""
    frames = [df for _, df, _ in days]
    for i, (batch, _, now) in enumerate(days):
        store.merge(table, feed(frames[max(0, i - 2):i + 1], table), batch, now)
