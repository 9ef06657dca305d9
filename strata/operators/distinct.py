"""Distinct counts that can be kept and merged, exactly.

The distinct values of a group are bits of bitmaps, one of 64 bits for each
range of 64 values. A batch's bitmaps are its state. States are merged by OR,
in any order and however often, so a later batch reads the state instead of all
earlier rows, and values that come again count once. Values are integers;
dense keys share bitmaps. A group with few values far apart has one bitmap a
value, so a state has never more rows than distinct (group, value) pairs, all
of them of one size, whatever the range of the values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_state(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """(group, bucket, bits): the values of each group; NULL values count nowhere."""
    keyed = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("long").alias("_v"))
    bits = keyed.select(*group, F.shiftright("_v", 6).alias("bucket"),
                        F.expr("shiftleft(1L, CAST(_v & 63 AS INT))").alias("bits"))
    return _joined(bits, group)


def _joined(bits: DataFrame, group: list[str]) -> DataFrame:
    """The OR of each bitmap. Rows are dealt before they are aggregated: most
    bitmaps hold few values, so a map-side aggregate would hold nearly all rows of its task."""
    n = int(bits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bits.repartition(n, *group, "bucket").groupBy(*group, "bucket").agg(F.bit_or("bits").alias("bits"))


def merged(states: list[DataFrame], group: list[str]) -> DataFrame:
    """One state out of several."""
    return _joined(reduce(DataFrame.unionByName, states), group)


def distinct_counts(state: DataFrame, group: list[str], name: str) -> DataFrame:
    return state.groupBy(*group).agg(F.sum(F.bit_count("bits").cast("long")).alias(name))
