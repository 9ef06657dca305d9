"""Helpers shared by the operators: words, written intermediate tables,
global numbering of ordered rows.
"""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from strata.storage import shuffles_dropped

#: A word is a run of characters other than space and \t..\r (ASCII only).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Folders written for the running job; ``release`` deletes them.
_written: list[str] = []


def scratch(spark: SparkSession, tag: str, keep: bool = False) -> str:
    """A fresh folder for one intermediate table, below ``spark.checkpoint.dir``.

    The setting names storage that driver and executors share. It is set here
    only if it is absent, which is the case in local tests. ``release`` spares
    folders to ``keep``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="strata-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/llm/{tag}-{uuid.uuid4().hex[:12]}"
    if not keep:
        _written.append(path)
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, and a lost
    executor costs a reread, not a recomputation."""
    path = scratch(df.sparkSession, tag)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, df_or_path) -> None:
    """Delete one intermediate table that no later step reads."""
    paths = [df_or_path] if isinstance(df_or_path, str) else \
        sorted({f.rsplit("/", 1)[0] for f in df_or_path.inputFiles()})
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table written so far. Call it only when all
    results that read them have been written."""
    while _written:
        drop_written(spark, _written.pop())


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_prefix(df: DataFrame, order: list[Column], sums: dict[str, str], tag: str,
                parts: int | None = None, within: list[Column] = ()) -> DataFrame:
    """Rows in global ``order`` with exclusive prefix sums over all rows before.

    ``sums`` maps a new column to the long column it sums. A ``_rank`` column
    numbers the rows from 0. Rows are range-partitioned and sorted; every task
    adds up its own partition; the per-partition totals (one row a partition)
    give each partition its offset. Rows equal in all order columns may take
    each other's place. Rows equal in ``order`` share a partition, in which
    ``within`` orders them further.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ["_rank", *sums]
    schema = StructType(list(df.schema.fields))
    for c in names:
        schema.add(c, LongType())
    schema.add("_part", IntegerType())
    inputs = list(sums.values())

    def local(batches):
        import numpy as np
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        seen = dict.fromkeys(names, 0)
        for b in batches:
            cols = list(b.columns)
            for name, src in zip(names, [None, *inputs]):
                v = np.ones(b.num_rows, np.int64) if src is None else \
                    b.column(b.schema.get_field_index(src)).fill_null(0).to_numpy(False).astype(np.int64)
                run = np.cumsum(v)
                cols.append(pa.array(run - v + seen[name]))
                seen[name] += int(run[-1]) if len(run) else 0
            cols.append(pa.array(np.full(b.num_rows, part, np.int32)))
            yield pa.RecordBatch.from_arrays(cols, [*b.schema.names, *names, "_part"])

    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order, *within)
    rows = written(ordered.mapInArrow(local, schema), tag)
    last = {"_rank": F.max(F.col("_rank") + 1)}
    last |= {c: F.max(F.col(c) + F.coalesce(F.col(src), F.lit(0))) for c, src in sums.items()}
    totals = rows.groupBy("_part").agg(*[v.alias(f"_t{c}") for c, v in last.items()])
    # One row a partition: the driver turns the totals into offsets.
    offsets, run = [], dict.fromkeys(names, 0)
    for r in sorted(totals.collect(), key=lambda r: r["_part"]):
        offsets.append((r["_part"], *[run[c] for c in names]))
        for c in names:
            run[c] += r[f"_t{c}"] or 0
    off = spark.createDataFrame(offsets, ", ".join(["_part int", *[f"_o{c} long" for c in names]]))
    out = rows.join(F.broadcast(off), "_part")
    return out.select(*df.columns, *[(F.col(c) + F.col(f"_o{c}")).alias(c) for c in names])
