"""Contiguous shards of near-equal byte size.

Rows in ``doc_id`` order get the global prefix sum of their sizes (local sums
in range partitions plus the totals of the partitions before), and the line
of all bytes is cut at equal targets: a row goes to the shard in which its
middle byte falls. A shard so misses its target by no more than half the
largest row at either end.

Defined cases: a null text has no bytes (size 16, the overhead); null ids
come first; rows with equal id are ordered by size and checksum, and equal
rows may take each other's place; an empty table gives an empty result; a
shard can be empty when there are fewer rows than shards. Only ``doc_id`` and
``text`` are read; further columns do not matter. Groups of equal texts are not
kept together: their rows go where their ids put them, so a group of any size
is cut like the rest and shards stay balanced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import with_prefix, written

#: Bytes that a stored row takes besides its text.
OVERHEAD = 16


def shards(docs: DataFrame, n: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row.

    The law is ``bytes``. ``slot`` numbers a shard's rows from 0, without gaps.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
                       F.crc32(text).alias("text_crc32"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    placed = with_prefix(rows, order, {"_start": "size"}, "shards")
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # floor((start + size / 2) * n / total), in exact arithmetic
    placed = placed.withColumn("shard", F.expr(
        f"cast(((2 * cast(_start as decimal(38, 0)) + size) * {n}) div (2 * {max(total, 1)}L) as int)"))
    # One row a shard.
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_rank") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
