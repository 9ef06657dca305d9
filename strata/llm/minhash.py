"""MinHash near-duplicates with sequential Bayesian verification.

1. Every text becomes the set of its distinct 5-word shingles (64-bit hashes),
   a signature of ROWS * BANDS minima and one key a band. Texts with equal
   sets form a class; only classes go on.
2. Classes that share a band key are candidates. No bucket is paired out:
   first every class meets one bucket leader (the one it shares most bands
   with), then members of large buckets meet in a few rounds of random
   couples, and the links found merge classes into components. Then only
   members of a bucket that are in different components still meet, the
   bucket's largest component on one side only. Two members of which exact
   distances to the same leader are known and differ by more than the link
   distance cannot be linked (Jaccard distance is a metric) and do not meet.
3. A candidate pair's signatures are compared batch by batch. It is dropped as
   soon as the posterior probability (uniform prior) that its similarity
   reaches the threshold falls under MISS.
4. Survivors are verified on their full sets; links give components.

A pair at the threshold itself escapes all bands with probability
(1 - 0.75 ** 6) ** 56 < 2e-5, at similarity 0.8 with 4e-8.

Defined cases: a null text, or one without words, has an empty set and is
linked with nothing; fewer than five words are one shingle; repeated rows are
copies of each other; null ids come after all others when the smallest id of a
component is taken; an empty table gives an empty result. Other columns pass
through ``near_dedup`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.graph import components

SHINGLE = 5
ROWS, BANDS = 6, 56
#: Hashes of a signature; the bands take the first ROWS * BANDS.
HASHES = 784
#: Link when PERCENT * |union| <= 100 * |intersection|.
PERCENT = 75
MISS = 1e-5
#: Hashes compared between two looks at the posterior.
BATCH = 56
#: Below this similarity the first meeting with a leader stays a bound.
FAR = 0.5
#: Buckets of so many classes let their members meet in random couples first.
LARGE, ROUNDS = 16, 3
#: Rows of a bucket that a task holds while the others pass.
BLOCK = 4096
#: Texts are refetched by a broadcast key list up to so many keys (16 bytes each).
BROADCAST_KEYS = 1_000_000


class Shingler:
    """Distinct shingle hashes of texts; word hashes are remembered up to a limit."""

    def __init__(self, size: int = SHINGLE, limit: int = 500_000):
        self.size, self.limit, self.known = size, limit, {}
        rng = np.random.default_rng(20240)
        self.mult = rng.integers(1, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1)

    def words(self, text: str | None) -> list[bytes]:
        """A-Z lower-cased words between the six ASCII white-space characters."""
        return (text or "").encode("utf-8", "surrogatepass").lower().split()

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        import xxhash
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def windows(self, h: np.ndarray) -> np.ndarray:
        """A hash of every window; of the whole when it is shorter."""
        k = min(self.size, len(h))
        if k == 0:
            return h
        n = len(h) - k + 1
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out += h[i:i + n] * self.mult[i]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))

    def shingles(self, text: str | None) -> np.ndarray:
        return np.unique(self.windows(self.word_hashes(self.words(text))))


class Signer:
    """Signatures and band keys of shingle sets."""

    def __init__(self):
        rng = np.random.default_rng(77)
        n = HASHES
        self.a = (rng.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, n, np.uint32)[:, None]
        self.mult = rng.integers(1, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, s: np.ndarray) -> np.ndarray:
        low = (s ^ (s >> np.uint64(32))).astype(np.uint32)
        best = None
        for i in range(0, len(low), 256):  # blocks that stay in the cache
            v = self.a * low[None, i:i + 256]
            v += self.b
            m = v.min(axis=1)
            best = m if best is None else np.minimum(best, m)
        return best

    def bands(self, minima: np.ndarray) -> np.ndarray:
        m = minima[:ROWS * BANDS].reshape(BANDS, ROWS).astype(np.uint64)
        key = (m * self.mult).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
        key *= np.uint64(0x9E3779B97F4A7C15)
        return (key ^ (key >> np.uint64(31))).view(np.int64)

    def short(self, minima: np.ndarray) -> bytes:
        """One byte a hash: chance agreement only makes pairs look more alike."""
        mixed = minima * np.uint32(0x9E3779B1)
        return (mixed >> np.uint32(24)).astype(np.uint8).tobytes()


def least_matches(threshold: float, miss: float = MISS, n: int = HASHES,
                  batch: int = BATCH) -> list[tuple[int, int]]:
    """(compared, fewest matches that keep P(similarity >= threshold) >= miss).

    With a uniform prior the posterior after m of n matches is Beta(m + 1,
    n - m + 1), whose upper tail is P(Binomial(n + 1, threshold) <= m).
    """
    from math import exp, lgamma, log
    out = []
    for k in range(batch, n + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += exp(lgamma(k + 2) - lgamma(m + 1) - lgamma(k + 2 - m)
                        + m * log(threshold) + (k + 1 - m) * log(1 - threshold))
        out.append((k, m))
    return out


def signed(docs: DataFrame) -> DataFrame:
    """_rk, doc_id, n_shingles, digest, bands, sig of every row (written)."""
    import hashlib

    def run(batches):
        shingler, signer = Shingler(), Signer()
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                n, digest, bands, sig = [], [], [], []
                for text in part.column(2).to_pylist():
                    s = shingler.shingles(text)
                    n.append(len(s))
                    if len(s) == 0:
                        for x in (digest, bands, sig):
                            x.append(None)
                        continue
                    m = signer.minima(s)
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    bands.append(signer.bands(m))
                    sig.append(signer.short(m))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()),
                     pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                     pa.array(sig, pa.binary())],
                    ["_rk", "doc_id", "n_shingles", "digest", "bands", "sig"])

    rows = docs.select(row_key().alias("_rk"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return written(rows.mapInArrow(
        run, "_rk long, doc_id long, n_shingles long, digest binary, bands array<long>, sig binary"), "signed")


def row_key():
    """Rows with equal id and text share it."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def classes_of(rows: DataFrame) -> DataFrame:
    """One row a distinct set: cid, digest, rep (smallest id), rk, bands, sig."""
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_rk")
    one = rows.where("digest is not null").groupBy("digest").agg(
        F.min(order).alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    return written(one.select(F.monotonically_increasing_id().alias("cid"), "digest",
                              F.col("rep.doc_id").alias("rep"), F.col("rep._rk").alias("rk"),
                              "bands", "sig"), "classes")


def looked_at(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, ...) with ``alive``: the posterior never fell under MISS."""
    limits = least_matches(threshold)
    sig = classes.select("cid", "sig")
    joined = pairs.join(sig.withColumnRenamed("cid", "a").withColumnRenamed("sig", "_sa"), "a") \
        .join(sig.withColumnRenamed("cid", "b").withColumnRenamed("sig", "_sb"), "b")
    keep = pairs.columns

    def run(batches):
        for b in batches:
            sa, sb = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8)
                      .reshape(b.num_rows, -1) for i in (len(keep), len(keep) + 1))
            live, matches, at = np.arange(b.num_rows), np.zeros(b.num_rows, np.int64), 0
            for upto, least in limits:
                matches[live] += (sa[live, at:upto] == sb[live, at:upto]).sum(axis=1)
                live, at = live[matches[live] >= least], upto
            alive = np.zeros(b.num_rows, bool)
            alive[live] = True
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(alive)], [*keep, "alive"])

    kinds = dict(pairs.dtypes)
    return joined.select(*keep, "_sa", "_sb").mapInArrow(
        run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", alive boolean")


def full_sets(docs: DataFrame, classes: DataFrame, cids: DataFrame) -> DataFrame:
    """(cid, set) of the classes in ``cids``: their texts are read once more."""
    import hashlib
    need = written(classes.join(cids, "cid", "left_semi").select("cid", "digest", F.col("rk").alias("_rk")), "need")
    few = need.count() <= BROADCAST_KEYS
    rows = docs.select(row_key().alias("_rk"), F.col("text").cast("string"))
    rows = rows.join(F.broadcast(need) if few else need, "_rk").select("cid", "digest", "text")

    def run(batches):
        shingler = Shingler()
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                cid, sets = [], []
                for c, digest, text in zip(*[x.to_pylist() for x in part.columns]):
                    s = shingler.shingles(text).tobytes()
                    if hashlib.blake2b(s, digest_size=16).digest() == digest:
                        cid.append(c)
                        sets.append(s)
                yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array(sets, pa.binary())],
                                                 ["cid", "set"])

    got = rows.mapInArrow(run, "cid long, set binary")
    return written(got.groupBy("cid").agg(F.first("set").alias("set")), "sets")


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, joint): sizes of intersection and union of each pair's sets."""
    joined = pairs.select("a", "b") \
        .join(sets.withColumnRenamed("cid", "a").withColumnRenamed("set", "_x"), "a") \
        .join(sets.withColumnRenamed("cid", "b").withColumnRenamed("set", "_y"), "b")

    def run(batches):
        for b in batches:
            common, joint = [], []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                c = len(np.intersect1d(x, y, assume_unique=True))
                common.append(c)
                joint.append(len(x) + len(y) - c)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(common, pa.int64()), pa.array(joint, pa.int64())],
                ["a", "b", "common", "joint"])

    return joined.select("a", "b", "_x", "_y").mapInArrow(run, "a long, b long, common long, joint long")


def class_components(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, component) of the classes that are linked with another."""
    linked = F.col("common") * 100 >= F.col("joint") * PERCENT
    keys = classes.select("cid", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("cid").alias("leader"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1")
    members = written(keys.join(written(buckets, "buckets"), "key"), "members")

    # Every class meets one leader.
    meets = members.where("cid <> leader").groupBy("cid", "leader").agg(F.count(F.lit(1)).alias("shared")) \
        .groupBy("cid").agg(F.max(F.struct("shared", (-F.col("leader")).alias("lead"))).alias("best"))
    meets = meets.select(F.col("cid").alias("a"), (-F.col("best.lead")).alias("b"))
    first = written(looked_at(meets, classes, FAR), "meets")
    alive = first.where("alive").select("a", "b")
    sets = full_sets(docs, classes, _ends(alive))
    exact = written(measured(alive, sets), "measured")
    links = written(exact.where(linked).select("a", "b"), "links")
    merged = components(links)

    # In large buckets that still hold several components, members meet in
    # random couples: a group of near copies then falls together although its
    # members do not all resemble one leader.
    large = written(members.where(F.col("n") >= LARGE).select("key", "cid", "n"), "large")
    if large.limit(1).count():
        sets = full_sets(docs, classes, large.select("cid").distinct())
    else:
        large = None
    for turn in range(ROUNDS if large is not None else 0):
        placed = large.join(merged.withColumnRenamed("node", "cid"), "cid", "left").select(
            "key", "cid", "n", F.coalesce("component", "cid").alias("comp"))
        seat = F.pmod(F.xxhash64("cid", F.lit(turn)), F.greatest(F.col("n") / 2, F.lit(1)).cast("long"))
        who = F.struct("comp", "cid")
        couples = placed.groupBy("key", seat.alias("seat")).agg(F.min(who).alias("x"), F.max(who).alias("y")) \
            .where("x.comp <> y.comp").select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b"))
        near = looked_at(couples.distinct(), classes, PERCENT / 100).where("alive")
        more = written(measured(near, sets).where(linked).select("a", "b"), "links")
        if not more.limit(1).count():
            break
        links = links.unionByName(more)
        merged = components(links)

    # Members of one bucket in different components meet, unless their
    # distances to a common leader rule a link out.
    near = first.join(exact, ["a", "b"], "left").select(
        F.col("a").alias("cid"), F.col("b").alias("met"),
        F.coalesce(1 - F.col("common") / F.col("joint"), F.lit(FAR)).alias("low"),
        F.coalesce(1 - F.col("common") / F.col("joint"), F.lit(1.0)).alias("high"))
    placed = written(
        members.select("key", "cid").join(merged.withColumnRenamed("node", "cid"), "cid", "left")
        .join(near, "cid", "left")
        .select("key", "cid", F.coalesce("component", "cid").alias("comp"), F.coalesce("met", F.lit(-1)).alias("met"),
                F.coalesce("low", F.lit(0.0)).alias("low"), F.coalesce("high", F.lit(1.0)).alias("high")), "placed")
    again = written(mixed_pairs(placed, classes), "again")
    more = measured(again, full_sets(docs, classes, _ends(again))).where(linked)
    return components(links.unionByName(more.select("a", "b"))).withColumnRenamed("node", "cid")


def mixed_pairs(placed: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): members of one bucket in different components that survive the
    posterior test, each pair from the first bucket the two share.

    The bucket's largest component stands on one side only. That side is dealt
    over blocks of about BLOCK rows, which tasks hold in memory one at a time;
    the other side is copied to every block of its bucket and streams past it.
    So no task holds a bucket, and no row is made for a pair that the test drops.
    A bucket of two whose one member has met the other before is done.
    """
    sizes = placed.groupBy("key", "comp").agg(
        F.count(F.lit(1)).alias("n"), F.min("cid").alias("low"), F.max(F.struct("cid", "met")).alias("top")) \
        .groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("n", "comp")).alias("big"),
                            F.sum("n").alias("all"), F.min("low").alias("low"), F.max("top").alias("top"))
    sizes = written(sizes.where("comps > 1 and not (all = 2 and top.met = low)").select(
        "key", F.col("big.comp").alias("big"), F.ceil(F.col("all") / BLOCK).alias("blocks")), "sizes")
    inside = placed.join(sizes, "key")
    held = inside.withColumn("block", F.pmod(F.xxhash64("cid"), "blocks")).withColumn("side", F.lit(0))
    passing = inside.where("comp <> big").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)"))) \
        .withColumn("side", F.lit(1))
    columns = ["key", "block", "side", "cid", "comp", "big", "met", "low", "high"]
    payload = classes.select("cid", F.transform("bands", lambda x: F.hash(x)).alias("bands"), "sig")
    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = held.select(*columns).unionByName(passing.select(*columns)) \
        .withColumn("name", F.hash("key")).join(payload, "cid") \
        .repartition(n, "key", "block").sortWithinPartitions("key", "block", "side")
    limits = least_matches(PERCENT / 100)
    slack = (100 - PERCENT) / 100 + 1e-9

    def run(batches):
        here, kept, ready = None, [], None
        for b in batches:
            t = {c: b.column(c).to_numpy(zero_copy_only=False)
                 for c in ("key", "block", "side", "cid", "comp", "big", "met", "low", "high", "name")}
            bands = b.column("bands").flatten().to_numpy().reshape(b.num_rows, -1)
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            out_a, out_b = [], []
            for i in range(b.num_rows):
                place = t["key"][i], t["block"][i]
                if place != here:
                    here, kept, ready = place, [], None
                me = {c: t[c][i] for c in ("cid", "comp", "met", "low", "high")} | {"bands": bands[i], "sig": sig[i]}
                if t["side"][i] == 0:
                    kept.append(me)
                    continue
                if not kept:
                    continue
                if ready is None:
                    ready = {c: np.array([k[c] for k in kept]) for c in kept[0]}
                r = ready
                on = (r["comp"] != me["comp"]) & ((r["comp"] == t["big"][i]) | (me["cid"] < r["cid"]))
                on &= ~((r["met"] == me["met"]) & (me["met"] >= 0)
                        & ((me["low"] - r["high"] > slack) | (r["low"] - me["high"] > slack)))
                live = np.flatnonzero(on)
                if len(live):
                    same = r["bands"][live] == me["bands"]
                    live = live[me["bands"][same.argmax(axis=1)] == t["name"][i]]
                matches, at = np.zeros(len(live), np.int64), 0
                for upto, least in limits:
                    if not len(live):
                        break
                    matches += (r["sig"][live, at:upto] == me["sig"][at:upto]).sum(axis=1)
                    stay = matches >= least
                    live, matches, at = live[stay], matches[stay], upto
                out_a.append(np.minimum(r["cid"][live], me["cid"]))
                out_b.append(np.maximum(r["cid"][live], me["cid"]))
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a), pa.int64()),
                                                  pa.array(np.concatenate(out_b), pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()


def grouped(docs: DataFrame) -> DataFrame:
    """_rk, doc_id, n_shingles, digest, component_id, chosen of every row;
    ``chosen`` is the row key of the one row that stands for its component."""
    rows = signed(docs)
    classes = classes_of(rows)
    comp = class_components(docs, classes)
    names = classes.select("cid", "digest", "rep", "rk").join(comp, "cid", "left") \
        .withColumn("component", F.coalesce("component", "cid"))
    names = written(names, "names")
    best = names.groupBy("component").agg(
        F.min(F.struct(F.col("rep").isNull().alias("no"), "rep", "rk")).alias("best"))
    named = written(names.join(best, "component").select(
        "digest", F.col("best.rep").alias("component_id"), F.col("best.rk").alias("chosen")), "named")
    return rows.select("_rk", "doc_id", "n_shingles", "digest").join(named, "digest", "left") \
        .withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    return grouped(docs).select("doc_id", "n_shingles", "component_id",
                                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component; rows without words all stay."""
    stay = written(grouped(docs).where("digest is not null and _rk = chosen").select("_rk").distinct(), "stay")
    packed = docs.select(F.struct("*").alias("_row"), row_key().alias("_rk"),
                         F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("_some"))
    one = packed.where("_some").join(stay, "_rk").groupBy("_rk").agg(F.first("_row").alias("_row"))
    return packed.where("not _some").select("_row.*").unionByName(one.select("_row.*"))
