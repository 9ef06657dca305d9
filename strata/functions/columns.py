"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen. Money is handled as decimals so that sums are exact and
independent of the order in which partitions are combined.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

_EPOCH_NTZ = dt.datetime(1970, 1, 1)
MILLIS_PER_DAY = 86_400_000


def ntz_lit(v: dt.datetime) -> Column:
    """A ``TIMESTAMP_NTZ`` literal of a wall-clock time.

    Built from text: a Python datetime literal is an instant in the local
    zone and its cast to NTZ would depend on the session time zone.
    """
    return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(TimestampNTZType())


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis(c: str | Column, dtype: DataType | None = None) -> Column:
    """Epoch milliseconds (floored for post-1970 values) of a timestamp.

    ``TIMESTAMP`` is an instant and converts directly; ``TIMESTAMP_NTZ`` is
    read as UTC wall-clock time, whatever the session time zone is.
    """
    c = col_(c)
    if isinstance(dtype, TimestampType):
        return F.unix_millis(c)
    return F.timestamp_diff("MILLISECOND", ntz_lit(_EPOCH_NTZ),
                            c.cast(TimestampNTZType()))


def line_amount(price: str | Column, quantity: str | Column) -> Column:
    """``price * quantity`` as an exact decimal (prices keep six digits after
    the point, nothing is rounded to cents); NULL when either side is NULL."""
    return col_(price).cast("decimal(18,6)") * col_(quantity).cast("decimal(18,0)")


def scaled(amount: Column, times: Column) -> Column:
    """An exact amount, so many times over, as DOUBLE."""
    return (amount * times).cast("double")


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as DOUBLE, NULL when the denominator is 0 or NULL."""
    den = col_(den)
    return F.when(den != 0, col_(num).cast("double") / den)


def millis_text_to_date(c: str | Column) -> Column:
    """UTC calendar date of an epoch-millisecond digit string.

    ``CAST(x AS BIGINT)`` raises on bad text under ANSI mode, like the
    INT64 cast in the original SQL.
    """
    ms = col_(c).cast("bigint")
    return F.date_from_unix_date(F.floor(ms / MILLIS_PER_DAY).cast("int"))


def days_between(as_of: dt.date | Column, d: Column) -> Column:
    """``DATE_DIFF(as_of, d, DAY)`` as BIGINT."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.datediff(as_of, d).cast("bigint")


def any_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds)


def flag(pred: Column) -> Column:
    """``CASE WHEN pred THEN TRUE ELSE FALSE END``: unknown becomes FALSE."""
    return F.when(pred, F.lit(True)).otherwise(F.lit(False))


def empty_frame(spark, schema) -> "DataFrame":
    """An empty DataFrame the optimizer can see is empty.

    ``createDataFrame([])`` scans an RDD whose emptiness Catalyst cannot
    know; a ``WHERE FALSE`` over a one-row range folds to an empty local
    relation, so joins against it are pruned from the plan.
    """
    return (spark.range(1)
            .select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
            .where(F.lit(False)))
