"""SCD2 merge expressed as joins, for plain Parquet tables.

Plain Parquet tables do not accept ``MERGE INTO``, so the merge is the
join form below. Per *target row* (not per key):

    active   = target rows with is_active = TRUE   (the rest is history, untouched)
    M        = keys equal AND <change predicate>
    expired  = active rows that M holds for with some source row -> is_active = FALSE, end = now
    kept     = the other active rows
    inserted = source rows whose key has no active row    (NULL keys never match)

``semantics="reference"`` reproduces the original statements exactly: a
changed row is only expired (its new version arrives on a later run that
still offers it), ``!=`` is NULL-blind, NULL keys are inserted again on
every run, and the product-supplier merge matches on supplier alone, tests
``last_updated`` with ``=`` and expires with a NULL end date.
``semantics="corrected"`` inserts the new version in the same pass, uses
``IS DISTINCT FROM`` and NULL-safe keys, and takes the full pair key.

With at most one source row a key, one outer join decides everything
(``_one_pass``). Otherwise target and source rows of a key are never paired:
``hit_counts`` joins counts of the source with the target.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from strata.functions.columns import ntz_lit
from strata.operators.quality import quarantine


@dataclass(frozen=True)
class MergeSpec:
    table: str
    keys: tuple[str, ...]
    changed: tuple[str, ...]              # target.c != source.c
    unchanged: tuple[str, ...] = ()       # target.c = source.c (counts as a hit)
    end_on_expire: str = "now"            # "now" or "null"
    distinct_source: bool = True
    insert_flag: bool = True              # False: is_quarantined is not inserted
    corrected_keys: tuple[str, ...] | None = field(default=None)


# Match keys and compared columns of the five merges.
SPECS: dict[str, MergeSpec] = {
    "customers": MergeSpec("customers", ("customer_id",),
                           ("email", "name", "updated_at")),
    "orders": MergeSpec("orders", ("order_id",),
                        ("customer_id", "order_date", "total_amount", "updated_at")),
    "order_items": MergeSpec("order_items", ("order_item_id",),
                             ("order_id", "product_id", "quantity", "price", "updated_at")),
    "product_suppliers": MergeSpec("product_suppliers", ("supplier_id",),
                                   ("supply_price",), unchanged=("last_updated",),
                                   end_on_expire="null",
                                   corrected_keys=("supplier_id", "product_id")),
    "customer_reviews": MergeSpec("customer_reviews", ("id",),
                                  ("customer_id", "product_id", "rating", "review_text",
                                   "review_date"),
                                  distinct_source=False, insert_flag=False),
}


def corrected(spec: MergeSpec) -> MergeSpec:
    """The corrected variant of a spec (pair key, ``!=`` only, end = now)."""
    return replace(spec, keys=spec.corrected_keys or spec.keys,
                   changed=spec.changed + spec.unchanged, unchanged=(),
                   end_on_expire="now", insert_flag=True)


@dataclass
class MergeResult:
    expired: DataFrame      # target rows closed by this run
    kept: DataFrame         # active rows that stay as they are
    inserted: DataFrame     # new active rows
    one_plan: DataFrame | None = None   # expired and inserted in one plan, with a "kind"
    hits: DataFrame | None = None       # expired rows with their number of hits, where counted

    @property
    def current(self) -> DataFrame:
        """The next active set."""
        return self.kept.unionByName(self.inserted)

    def changes(self) -> DataFrame:
        """What the merge adds: rows with ``kind`` = "history" (expired) or "active",
        and ``n_hits``, the number of source rows that expired the row."""
        if self.one_plan is not None:
            return self.one_plan.withColumn("n_hits", F.lit(1).cast("long"))
        return (self.hits.withColumn("kind", F.lit("history"))
                .unionByName(self.inserted.select("*", F.lit(0).cast("long").alias("n_hits"),
                                                  F.lit("active").alias("kind"))))


def merge_source(bronze: DataFrame, spec: MergeSpec) -> DataFrame:
    """The USING clause: bronze rows plus the quarantine flag."""
    src = quarantine(bronze, spec.table)
    return src.distinct() if spec.distinct_source else src


def _t(c: str) -> Column:
    return F.col(f"t.{c}")


def _s(c: str) -> Column:
    return F.col(f"s.{c}")


def _key_match(keys: tuple[str, ...], null_safe: bool) -> Column:
    eq = [(_t(k).eqNullSafe(_s(k)) if null_safe else _t(k) == _s(k)) for k in keys]
    return reduce(lambda a, b: a & b, eq)


def _change(spec: MergeSpec, null_safe: bool) -> Column:
    preds = [(~_t(c).eqNullSafe(_s(c)) if null_safe else _t(c) != _s(c))
             for c in spec.changed]
    preds += [_t(c) == _s(c) for c in spec.unchanged]
    return reduce(lambda a, b: a | b, preds)


def scd2_merge(active: DataFrame, source: DataFrame, spec: MergeSpec,
               now: dt.datetime, semantics: str = "reference",
               unique_source_keys: bool = False, stored_by_key: bool = True) -> MergeResult:
    """Merge ``source`` (already flagged, see ``merge_source``) into ``active``.

    ``active`` holds only the target's active rows, with the silver schema.
    ``unique_source_keys=True`` promises at most one source row per non-NULL
    key; the expire/keep split then takes one left join instead of a semi
    and an anti join (see ``_one_pass``; ``_small_source`` if the target is
    not ``stored_by_key``).
    """
    if unique_source_keys and semantics == "reference":
        return (_one_pass if stored_by_key else _small_source)(active, source, spec, now)
    if semantics not in ("reference", "corrected"):
        raise ValueError(f"unknown semantics {semantics!r}")
    fixed = semantics == "corrected"
    if fixed:
        spec = corrected(spec)
    cols = active.columns
    counted = hit_counts(active, source, spec, null_safe=fixed)
    hits = _as_expired(counted.where("n_hits > 0"), spec, now, cols)
    kept = counted.where("n_hits = 0").select(cols)
    # Reference: insert only keys with no active row. Corrected: also the new
    # version of every changed row (no active row that is equal to it).
    if fixed:
        t, s = active.alias("t"), source.alias("s")
        same = _key_match(spec.keys, True) & ~_change(spec, null_safe=True)
        fresh = s.join(t, same, "left_anti")
    else:
        fresh = _unknown_keys(active, source, spec)
    return MergeResult(hits.select(cols), kept, _as_inserted(fresh, spec, now, cols), hits=hits)


def _known(keys: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _null_mask(cols: tuple[str, ...]) -> Column:
    """Bit i is set where column i is NULL."""
    bits = [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(cols)]
    return reduce(lambda a, b: a + b, bits, F.lit(0))


def _bits(mask: int, cols: tuple[str, ...]) -> list[str]:
    return [c for i, c in enumerate(cols) if mask >> i & 1]


def hit_counts(active: DataFrame, source: DataFrame, spec: MergeSpec,
               null_safe: bool = False) -> DataFrame:
    """The active rows with ``n_hits``: how many source rows M holds for.

    A source row of the key is *no* hit if every ``changed`` column is equal
    or NULL on one side, and no ``unchanged`` column is equal. Such rows are
    counted, not paired: the source is counted by key and the values of the
    columns that are non-NULL on both sides, one count for each pattern of
    NULLs that occurs (a handful, read from the data), and ``unchanged``
    columns enter by inclusion and exclusion. Distinct target values look
    their counts up, at most one row a count, so a key with a thousand rows on
    both sides costs a few thousand rows and not a million.
    """
    keys, changed, unchanged = spec.keys, spec.changed, spec.unchanged
    values = [*keys, *changed, *unchanged]
    if null_safe:
        src, tgt = source, active
    else:
        src, tgt = source.where(_known(keys)), active.where(_known(keys))
    n_key = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_key"))
    if null_safe:
        # IS DISTINCT FROM: a row that is no hit is equal in every column.
        alike = src.groupBy(*values).agg(F.count(F.lit(1)).alias("_n_alike"))
    else:
        full = (1 << len(changed)) - 1
        mask = _null_mask(changed).alias("mask")
        seen = src.select(F.lit(0).alias("side"), mask).unionByName(tgt.select(F.lit(1).alias("side"), mask)).distinct().collect()
        in_source, in_target = (sorted(r["mask"] for r in seen if r["side"] == side) for side in (0, 1))
        subsets = range(1 << len(unchanged))
        # (NULLs of the source row, columns that must be equal, unchanged columns that are)
        terms = sorted({(ps, full & ~(ps | pt), w) for ps in in_source for pt in in_target for w in subsets})
        known = lambda w: reduce(lambda a, b: a & b, [F.col(u).isNotNull() for u in _bits(w, unchanged)], F.lit(True))
        term = lambda ps, k, w: F.struct(F.lit(ps).alias("ps"), k.alias("k"), F.lit(w).alias("w"))
        listed = lambda xs: F.explode(F.filter(F.array(*xs), lambda x: x.isNotNull())).alias("_t")
        none = F.lit(None).cast("struct<ps:int,k:int,w:int>")
        rows = src.groupBy(*values).agg(F.count(F.lit(1)).alias("_n"))
        pattern = _null_mask(changed)
        of_source = [F.when((pattern == ps) & known(w), term(ps, F.lit(k), w)) for ps, k, w in terms] or [none]
        of_target = [F.when(known(w), term(ps, F.lit(full & ~ps).bitwiseAND(F.lit(full) - pattern), w))
                     for ps in in_source for w in subsets] or [none]

        def spread(df: DataFrame, xs: list[Column], more: list[str]) -> DataFrame:
            out = df.select(*values, *more, listed(xs))
            bit = lambda name, i: F.col(f"_t.{name}").bitwiseAND(1 << i) != 0
            asked = [F.when(bit("k", i), F.col(c)).alias(f"_c{i}") for i, c in enumerate(changed)]
            asked += [F.when(bit("w", i), F.col(u)).alias(f"_u{i}") for i, u in enumerate(unchanged)]
            return out.select(*values, *more, "_t", *asked)

        looked = [f"_c{i}" for i in range(len(changed))] + [f"_u{i}" for i in range(len(unchanged))]
        counts = spread(rows, of_source, ["_n"]).groupBy(*keys, "_t", *looked).agg(F.sum("_n").alias("_n"))
        asks = spread(tgt.select(*values).distinct(), of_target, [])
        a, c = asks.alias("a"), counts.alias("c")
        on = [F.col(f"a.{x}") == F.col(f"c.{x}") for x in (*keys, "_t")]
        on += [F.col(f"a.{x}").eqNullSafe(F.col(f"c.{x}")) for x in looked]
        sign = reduce(lambda x, y: x * y, [F.when(F.col("a._t.w").bitwiseAND(1 << i) != 0, -1).otherwise(1)
                                           for i in range(len(unchanged))], F.lit(1))
        alike = a.join(c, reduce(lambda x, y: x & y, on)).groupBy(*[F.col(f"a.{v}") for v in values]) \
            .agg(F.sum(sign * F.col("c._n")).alias("_n_alike"))
    t, k, x = active.alias("t"), n_key.alias("k"), alike.alias("x")
    on_key = [F.col(f"t.{c}").eqNullSafe(F.col(f"k.{c}")) if null_safe else F.col(f"t.{c}") == F.col(f"k.{c}")
              for c in keys]
    on_all = [F.col(f"t.{c}").eqNullSafe(F.col(f"x.{c}")) for c in values]
    n = F.coalesce("k._n_key", F.lit(0)) - F.coalesce("x._n_alike", F.lit(0))
    return t.join(k, reduce(lambda p, q: p & q, on_key), "left") \
        .join(x, reduce(lambda p, q: p & q, on_all), "left").select("t.*", n.alias("n_hits"))


def _as_expired(counted: DataFrame, spec: MergeSpec, now: dt.datetime, cols: list[str]) -> DataFrame:
    end = ntz_lit(now) if spec.end_on_expire == "now" else F.lit(None).cast(TimestampNTZType())
    return counted.withColumn("is_active", F.lit(False)).withColumn("effective_end_date", end) \
        .select(*cols, F.col("n_hits").cast("long").alias("n_hits"))


def _unknown_keys(active: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Source rows whose key has no active row (reference semantics).

    Rows with a NULL key match nothing, so they pass by the join: a third of
    the source under NULL would otherwise meet in one task. Only the keys of
    the active rows matter, and as distinct keys (combined in the map tasks) a
    hot key of the target is one row.
    """
    known = _known(spec.keys)
    active_keys = active.select(*spec.keys).where(known).distinct().alias("t")
    keyed = source.where(known).alias("s").join(active_keys, _key_match(spec.keys, False), "left_anti")
    return source.where(~known).unionByName(keyed)


def _as_inserted(fresh: DataFrame, spec: MergeSpec, now: dt.datetime, cols: list[str]) -> DataFrame:
    """Source rows as new active rows of the target."""
    flag_col = F.col("is_quarantined") if spec.insert_flag else F.lit(None).cast("boolean")
    return fresh.select(
        *[F.col(c) for c in cols if c not in ("is_quarantined", "effective_start_date",
                                               "effective_end_date", "is_active")],
        flag_col.alias("is_quarantined"),
        ntz_lit(now).alias("effective_start_date"),
        F.lit(None).cast(TimestampNTZType()).alias("effective_end_date"),
        F.lit(True).alias("is_active")).select(cols)


def _one_pass(active: DataFrame, source: DataFrame, spec: MergeSpec,
              now: dt.datetime) -> MergeResult:
    """Expired and new rows in one outer join when each key has one source row.

    Every active row meets at most one source row, and a source row that meets
    none is new. Only keys that are NULL pass by the join. The active side
    keeps its own partitioning when it is stored by the key, and rows that
    stay as they are leave no trace in the output.
    """
    cols, known = active.columns, _known(spec.keys)
    keyed = source.where(known)
    given = lambda c: F.col(f"s.{c}")
    j = active.where(known).withColumn("_t", F.lit(True)).alias("t").join(
        keyed.withColumn("_s", F.lit(True)).alias("s"), _key_match(spec.keys, False), "full_outer")
    hit = F.coalesce(F.col("_t") & F.col("_s") & _change(spec, False), F.lit(False))
    new = F.col("_t").isNull()
    end = ntz_lit(now) if spec.end_on_expire == "now" else F.lit(None).cast(TimestampNTZType())
    nothing = F.lit(None).cast(TimestampNTZType())
    out = {c: F.when(new, given(c)).otherwise(_t(c)) if c in source.columns else _t(c) for c in cols}
    if not spec.insert_flag:
        out["is_quarantined"] = F.when(~new, _t("is_quarantined"))
    out["effective_start_date"] = F.when(new, ntz_lit(now)).otherwise(_t("effective_start_date"))
    out["effective_end_date"] = F.when(new, nothing).otherwise(end)
    out["is_active"] = new
    changes = j.where(hit | new).select(*[out[c].alias(c) for c in cols],
                                        F.when(new, "active").otherwise("history").alias("kind"))
    unkeyed = _as_inserted(source.where(~known), spec, now, cols)
    kept = active.alias("t").join(keyed.alias("s"), _key_match(spec.keys, False) & _change(spec, False), "left_anti")
    return MergeResult(
        expired=changes.where("kind = 'history'").drop("kind"), kept=kept.select(cols),
        inserted=changes.where("kind = 'active'").drop("kind").unionByName(unkeyed),
        one_plan=changes.unionByName(unkeyed.withColumn("kind", F.lit("active"))))


def _small_source(active: DataFrame, source: DataFrame, spec: MergeSpec, now: dt.datetime) -> MergeResult:
    """The same where the target would be shuffled for the outer join: an inner
    join for the expired rows, which may broadcast the source, and the distinct
    keys of the target (combined in the map tasks) for the new ones."""
    cols = active.columns
    on = _key_match(spec.keys, False) & _change(spec, False)
    hit = active.alias("t").join(source.where(_known(spec.keys)).alias("s"), on).select(
        *[_t(c).alias(c) for c in cols], F.lit(1).alias("n_hits"))
    kept = active.alias("t").join(source.alias("s"), on, "left_anti")
    hits = _as_expired(hit, spec, now, cols)
    inserted = _as_inserted(_unknown_keys(active, source, spec), spec, now, cols)
    return MergeResult(hits.select(cols), kept.select(cols), inserted, hits=hits)


def insert_all(source: DataFrame, spec: MergeSpec, now: dt.datetime, cols: list[str]) -> DataFrame:
    """The merge into an empty target: every source row is new."""
    return _as_inserted(source, spec, now, cols)
