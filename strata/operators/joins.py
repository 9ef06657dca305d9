"""Join shapes that stay balanced when one key is hot."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that one sketch reports, and items it tracks: every key with more than a
#: TRACKED-th of all rows is tracked, so none that fills a task is missed.
MOST_HEAVY, TRACKED = 256, 10_000


def heavy_keys(df: DataFrame, key: str, partitions: int | None = None) -> list[tuple[object, int]]:
    """(key, copies) of keys with more rows than half a task's even share.

    One pass with a frequent-items sketch, which tasks merge before the
    shuffle; only the few keys found reach the driver. ``copies`` is how many
    half shares the key's rows fill: it follows the measured skew, and evenly
    spread keys give an empty list.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(`{key}`, {MOST_HEAVY}, {TRACKED})").alias("top")).first()
    share = max(row["rows"] / n / 2, 1)
    return [(x["item"], math.ceil(x["count"] / share)) for x in row["top"] or [] if x["count"] > 2 * share]


def left_join_dealt(left: DataFrame, right: DataFrame, key: str, heavy: Sequence[tuple[object, int]]) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` with the rows of heavy keys of
    ``right`` dealt over as many copies of their left rows.

    A row's copy is a hash of the whole row, so a repeated task deals it the
    same way. A heavy key is in ``right`` by definition; a copy of its left row
    that got no right row is dropped, the outer join's empty rows stay for all
    other keys. Left rows of a heavy key are what the copies cost.
    """
    if not heavy:
        return left.join(right, key, "left")
    kind = right.schema[key].dataType
    copies = F.lit(None).cast("int")
    for k, n in heavy:
        copies = F.when(F.col(key) == F.lit(k).cast(kind), F.lit(n)).otherwise(copies)
    dealt = right.withColumn("_copy", F.coalesce(F.pmod(F.xxhash64(*right.columns), copies), F.lit(0)).cast("int")) \
        .withColumn("_found", F.lit(True))
    every = left.withColumn("_copies", copies).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_copies"), F.lit(1)) - 1)))
    out = every.join(dealt, [key, "_copy"], "left").where(F.col("_copies").isNull() | F.col("_found"))
    return out.drop("_copy", "_copies", "_found")


def left_join_copied(left: DataFrame, right: DataFrame, key: str, heavy: Sequence[tuple[object, int]]) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` with the rows of heavy keys of
    ``left`` dealt over copies of the right rows, of which there are few a key.
    Needed where a later step reuses the join's partitioning, which keeps
    adaptive execution from splitting it."""
    if not heavy:
        return left.join(right, key, "left")
    kind = left.schema[key].dataType
    copies = F.lit(1)
    for k, n in heavy:
        copies = F.when(F.col(key) == F.lit(k).cast(kind), F.lit(n)).otherwise(copies)
    dealt = left.withColumn("_copy", F.pmod(F.xxhash64(*left.columns), copies).cast("int"))
    every = right.withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.join(every, [key, "_copy"], "left").drop("_copy")


def left_join_hot_right(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` when ``right`` may be skewed.

    Adaptive execution can split a skewed partition only on the preserved
    side of an outer join, so a key that holds a third of ``right`` would
    land in one task. Written as an inner join (both sides splittable) plus
    the unmatched left rows (an anti join against the distinct keys, which
    a map-side partial aggregate shrinks before the shuffle), the result is
    the same rows.
    """
    matched = left.join(right, key, "inner")
    keys = right.select(key).where(F.col(key).isNotNull()).distinct()
    unmatched = left.join(keys, key, "left_anti")
    pad = [F.lit(None).cast(t).alias(n) for n, t in right.dtypes if n != key]
    return matched.unionByName(unmatched.select("*", *pad))
