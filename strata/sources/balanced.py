"""Equal-depth parts of a table for a parallel extract.

``partitionColumn/lowerBound/upperBound`` cuts a column's range into equal
widths, so lumpy keys land in few parts. Here the bounds are approximate
quantiles of a copy the lake already holds (or any frame of the column), and
become predicates that are complete and disjoint for *every* row of the
source, also for rows the copy has not seen: the first part is open below, the
last one open above, NULLs have a part of their own. A part that one frequent
value makes too large is cut again by a second column.
"""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Relative error of the quantiles is one in so many.
ACCURACY = 10_000


def sql_literal(v) -> str:
    if isinstance(v, bool) or v is None:
        raise ValueError(f"no bound: {v!r}")
    if isinstance(v, (int, float, decimal.Decimal)):
        return str(v)
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v}'"
    if isinstance(v, dt.date):
        return f"DATE '{v}'"
    return "'" + str(v).replace("'", "''") + "'"


def _ranges(column: str, bounds: list) -> list[str]:
    if not bounds:
        return [f"{column} IS NOT NULL"]
    lits = [sql_literal(b) for b in bounds]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(lits, lits[1:])]
    return [f"{column} < {lits[0]}", *inner, f"{column} >= {lits[-1]}"]


def _bounds(df: DataFrame, column: str, parts: int) -> list:
    """Distinct inner quantiles; the least value is no bound, as nothing is below it."""
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    row = df.agg(F.percentile_approx(column, at, ACCURACY).alias("q"), F.min(column).alias("least")).first()
    return sorted({q for q in row["q"] or [] if q != row["least"]})


def equal_depth_predicates(df: DataFrame, column: str, parts: int, then: str | None = None) -> list[str]:
    """Predicates over ``column`` (a number, date or time) of about equally many rows of ``df`` each.

    ``then`` names a second column, by which parts that stay above twice the
    mean, as one value fills them, are cut again. NULLs of either column keep
    a part of their own, so every row fits exactly one predicate.
    """
    ranges = _ranges(column, _bounds(df, column, parts))
    held = df.agg(*[F.count_if(F.expr(p)).alias(f"p{i}") for i, p in enumerate(ranges)],
                  F.count(F.lit(1)).alias("rows")).first()
    mean = max(held["rows"] / parts, 1)
    out = []
    for i, p in enumerate(ranges):
        n = held[f"p{i}"]
        if then is None or n <= 1.5 * mean:
            out.append(p)
            continue
        inner = _bounds(df.where(p), then, min(parts, -(-n // int(mean)) + 1))
        out += [f"{p} AND {q}" for q in _ranges(then, inner)] + [f"{p} AND {then} IS NULL"]
    nulls = f"{column} IS NULL"
    if then is None:
        return [*out, nulls]
    inner = _bounds(df.where(nulls), then, parts) if df.where(nulls).count() > 1.5 * mean else []
    return [*out, *[f"{nulls} AND {q}" for q in _ranges(then, inner)], f"{nulls} AND {then} IS NULL"]
