"""Words that differ by one letter, found in a trie of letter-group counts.

A word is described by how many of its letters fall into each of ``GROUPS``.
The trie has one level a group; its branches are the counts. One inserted,
deleted or replaced letter changes one count by one, or two by one each in
opposite directions, so a search walks the trie depth first with a budget of
one surplus and one deficit, and only words at the leaves it reaches are
compared letter by letter. Nearness is symmetric: a search lets the surplus
come at an earlier level than the deficit, so each pair is met from one side.

The trie's upper part is cut from the counts of all words: a node with more
than a node's share of words is opened, the others are its leaves
(``frontier``). Those leaves are the shuffle key. A word goes home to its own
leaf and as a search to all leaves that its budget reaches; a task builds the
lower part of one leaf at a time from the words at home there, and the
searches of that leaf stream through it in batches. A share is ``NODE_WORDS``,
or one ``NODES``-th of all words if that is more, so that the upper part, which
the driver and every task hold, never has more than ``NODES`` open nodes a
level.

Counts of ``MOST`` or more are one branch. A word that has such a count may
hide its surplus there and is searched without the order of the two budgets.

Defined cases: a null text has no words; a null id counts as an empty one in
the checksum; repeated rows all count; an empty table gives an empty result.
Words are runs of Latin-1 letters, so any length and any text is possible, and
a word is one byte a letter here. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import drop_written, lower_ascii, written

# What is a word, which runs lose a letter, least length and count.
RUN = "([A-Za-zÀ-ÿ]+)"
EVERY, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3

#: One level of the trie each; letters that stand in none make one more group.
GROUPS = ("e", "a", "i", "t", "o", "n", "s", "r", "l", "h", "dg", "cu", "mp", "bvw", "fyk")
LEVELS = len(GROUPS) + 1
LEVEL_OF = np.full(256, LEVELS - 1, np.int64)
for _level, _letters in enumerate(GROUPS):
    for _letter in _letters:
        LEVEL_OF[ord(_letter)] = _level
MOST = 15
NODE_WORDS, NODES = 4096, 2000
#: Words up to this length are compared in blocks, longer ones one by one.
WIDTH = 32
#: A branch is not opened further when so few pairs are left in it.
FEW_PAIRS = 256


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of at least five letters and three occurrences."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
                       F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(1))).alias("_run"))
    low = runs.where(F.length("_run") >= LEAST_LENGTH).select("_id", lower_ascii(F.col("_run")).alias("_run"))
    hashed = low.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "_run")))
    at = (F.col("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.substring(F.col("_run"), F.lit(1), at), F.substring(F.col("_run"), at + 2, F.length("_run")))
    words = hashed.select(F.when(F.col("_h") % EVERY == 0, cut).otherwise(F.col("_run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- words as numbers ---------------------------------------------------------------

def counts_of(words: list[bytes]) -> np.ndarray:
    """One row of letter-group counts a word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    letters = LEVEL_OF[np.frombuffer(b"".join(words), np.uint8)]
    out = np.bincount(owner * LEVELS + letters, minlength=len(words) * LEVELS)
    return np.minimum(out, MOST).astype(np.int8).reshape(-1, LEVELS)


def near(a: bytes, b: bytes) -> bool:
    """Whether ``a`` becomes ``b`` by one insertion, or one replacement whose
    new letter comes first by (level, letter): one of the two directions."""
    if len(b) - len(a) not in (0, 1) or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) < len(b):
        return a[i:] == b[i + 1:]
    return a[i + 1:] == b[i + 1:] and (LEVEL_OF[b[i]], b[i]) < (LEVEL_OF[a[i]], a[i])


def near_blocks(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """``near`` of rows of zero-padded letters, which are ``la`` and ``lb`` long."""
    rows, wide = np.arange(len(a)), a.shape[1]
    same = a == b
    lead = np.where(same.all(1), wide, same.argmin(1))
    i = np.minimum(lead, wide - 1)
    x, y = a[rows, i], b[rows, i]
    order = (LEVEL_OF[y] << 8 | y) < (LEVEL_OF[x] << 8 | x)
    replaced = (la == lb) & ((~same).sum(1) == 1) & order
    moved = (a[:, :-1] == b[:, 1:])[:, ::-1]
    trail = np.where(moved.all(1), wide - 1, moved.argmin(1))
    # the padding is equal, too, so what fits from the end starts behind it
    return replaced | (lb == la + 1) & (lead + trail >= wide - 1)


def padded(words: list[bytes]) -> np.ndarray:
    """Zero-padded letters, cut after ``WIDTH`` + 1 (longer words are compared otherwise)."""
    return np.array([w[:WIDTH + 1] for w in words], f"S{WIDTH + 2}").view(np.uint8).reshape(len(words), WIDTH + 2)


def spend(diff: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, loose: np.ndarray) -> np.ndarray:
    """Which searches may take a branch whose count differs by ``diff``."""
    return (diff == 0) | (diff == 1) & ~surplus & (~deficit | loose) | (diff == -1) & ~deficit & (surplus | loose)


# --- the upper part -------------------------------------------------------------------

def frontier(counted: DataFrame, share: int) -> set[bytes]:
    """Prefixes of counts below which more than ``share`` words stand.

    At most ``words / share`` of each length, which ``share`` keeps to
    ``NODES``; the empty prefix is always there, and no full-length one.
    """
    shapes = counted.groupBy("_counts").agg(F.count(F.lit(1)).alias("_words"))
    prefixes = shapes.select("_words", F.explode(F.sequence(F.lit(1), F.lit(LEVELS - 1))).alias("_level"), "_counts") \
        .select("_words", F.substring(F.col("_counts"), F.lit(1), F.col("_level")).alias("_prefix"))
    heavy = prefixes.groupBy("_prefix").agg(F.sum("_words").alias("_words")).where(F.col("_words") > share)
    return {b""} | {bytes(r["_prefix"]) for r in heavy.select("_prefix").collect()}


def route(counts: np.ndarray, open_: set[bytes]) -> list[tuple[int, bytes, bool, bool, bool]]:
    """(word, leaf, surplus spent, deficit spent, home) of all leaves within
    the budget, depth first through the open nodes, all words at once."""
    loose = (counts >= MOST).any(1)
    out = []

    def walk(node, level, who, surplus, deficit):
        if node not in open_:
            home = ~(surplus | deficit)
            out.extend(zip(who.tolist(), [node] * len(who), surplus.tolist(), deficit.tolist(), home.tolist()))
            return
        own = counts[who, level]
        present = np.unique(own)
        for c in range(max(0, int(present[0]) - 1), min(MOST, int(present[-1]) + 1) + 1):
            diff = c - own
            may = spend(diff, surplus, deficit, loose[who])
            if may.any():
                walk(node + bytes([c]), level + 1, who[may], surplus[may] | (diff[may] == 1), deficit[may] | (diff[may] == -1))

    start = np.arange(len(counts))
    walk(b"", 0, start, np.zeros(len(start), bool), np.zeros(len(start), bool))
    return out


# --- the lower part ------------------------------------------------------------------------

class Leaf:
    """The trie below one leaf of the upper part."""

    def __init__(self, words: list[bytes], ns: list[int], level: int):
        counts = counts_of(words)
        order = np.lexsort(counts.T[::-1])
        self.counts, self.level = np.ascontiguousarray(counts[order]), level
        self.words = [words[i] for i in order]
        self.ns = np.array(ns, np.int64)[order]
        self.letters, self.sizes = padded(self.words), np.array([len(w) for w in self.words])

    def pairs(self, words: list[bytes], surplus: np.ndarray, deficit: np.ndarray):
        """(searched, found) places of all near pairs."""
        counts = counts_of(words)
        loose = (counts >= MOST).any(1)
        met: list[tuple[np.ndarray, np.ndarray]] = []
        # Depth first; a branch carries all searches that are still alive in it.
        stack = [(0, len(self.words), self.level, np.arange(len(words)), surplus, deficit)]
        while stack:
            lo, hi, level, who, plus, minus = stack.pop()
            if level == LEVELS or (hi - lo) * len(who) <= FEW_PAIRS:
                met.append((np.repeat(who, hi - lo), np.tile(np.arange(lo, hi), len(who))))
                continue
            column, own = self.counts[lo:hi, level], counts[who, level]
            cuts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), hi - lo]
            for b, e in zip(cuts, cuts[1:]):
                diff = int(column[b]) - own
                may = spend(diff, plus, minus, loose[who])
                if may.any():
                    stack.append((lo + b, lo + e, level + 1, who[may], plus[may] | (diff[may] == 1),
                                  minus[may] | (diff[may] == -1)))
        if not met:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, w = np.concatenate([x for x, _ in met]), np.concatenate([x for _, x in met])
        return self._verified(words, q, w)

    def _verified(self, words, q, w):
        letters, sizes = padded(words), np.array([len(x) for x in words])
        fits = (self.sizes[w] - sizes[q] >> 1) == 0  # equally long or one longer
        q, w = q[fits], w[fits]
        good = np.zeros(len(q), bool)
        short = self.sizes[w] <= WIDTH
        for at in range(0, len(q), 1 << 16):
            part = np.flatnonzero(short[at:at + (1 << 16)]) + at
            if len(part):
                good[part] = near_blocks(letters[q[part]], self.letters[w[part]], sizes[q[part]], self.sizes[w[part]])
        for i in np.flatnonzero(~short).tolist():
            good[i] = near(words[q[i]], self.words[w[i]])
        return q[good], w[good]


def near_pairs(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """(word, other, other_n) for both directions of every near pair."""
    spark = words.sparkSession

    def describe(batches):
        for b in batches:
            names = [w.encode("latin-1") for w in b.column(0).to_pylist()]
            made = [r.tobytes() for r in counts_of(names)] if names else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.binary())],
                                             ["word", "n", "_counts"])

    counted = written(words.select("word", "n").mapInArrow(describe, "word string, n long, _counts binary"), "shapes")
    total = counted.count()
    open_ = frontier(counted, max(node_words, total // NODES))

    def send(batches):
        for b in batches:
            if not b.num_rows:
                continue
            counts = np.frombuffer(b"".join(b.column(2).to_pylist()), np.int8).reshape(-1, LEVELS)
            who, leaf, plus, minus, home = (list(x) for x in zip(*route(counts, open_)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf, pa.binary()), b.column(0).take(pa.array(who)), b.column(1).take(pa.array(who)),
                 pa.array(plus), pa.array(minus), pa.array(home)],
                ["leaf", "word", "n", "surplus", "deficit", "home"])

    sent = counted.mapInArrow(send, "leaf binary, word string, n long, surplus boolean, deficit boolean, home boolean")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = sent.repartition(parts, "leaf").sortWithinPartitions("leaf", F.desc("home"))

    def look(batches):
        """Home words of a leaf come before its other searches, and are searches, too."""
        leaf, home, trie = None, [], None

        def found(b, trie):
            names = [w.encode("latin-1") for w in b.column(1).to_pylist()]
            q, w = trie.pairs(names, b.column(3).to_numpy(False), b.column(4).to_numpy(False))
            own = b.column(1).take(pa.array(q))
            other = pa.array([trie.words[i].decode("latin-1") for i in w.tolist()], pa.string())
            own_n, other_n = b.column(2).take(pa.array(q)), pa.array(trie.ns[w])
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([own, other]), pa.concat_arrays([other, own]), pa.concat_arrays([other_n, own_n])],
                ["word", "other", "other_n"])

        def built():
            words = [w.encode("latin-1") for b in home for w in b.column(1).to_pylist()]
            return Leaf(words, [n for b in home for n in b.column(2).to_pylist()], len(leaf))

        for batch in batches:
            leaves = batch.column(0).to_pylist()
            cuts = [0, *(i for i in range(1, len(leaves)) if leaves[i] != leaves[i - 1]), len(leaves)]
            for b, e in zip(cuts, cuts[1:]):
                if b == e:
                    continue
                if leaves[b] != leaf:
                    if home and trie is None:
                        trie = built()
                        yield from (found(x, trie) for x in home)
                    leaf, home, trie = leaves[b], [], None
                at_home = int(np.count_nonzero(batch.column(5).slice(b, e - b).to_numpy(False)))
                if at_home:
                    home.append(batch.slice(b, at_home))
                if at_home < e - b and home:  # a leaf without words of its own has nothing to find
                    if trie is None:
                        trie = built()
                        yield from (found(x, trie) for x in home)
                    yield found(batch.slice(b + at_home, e - b - at_home), trie)
        if home and trie is None:
            trie = built()
            yield from (found(x, trie) for x in home)

    return sent.mapInArrow(look, "word string, other string, other_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: forms followed to the last.
    Counts at least double from a word to its form, so there are no cycles,
    and a jump to the form's own root halves the way in every round."""
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        far = state.select(F.col("word").alias("root"), F.col("root").alias("_far"))
        new = written(state.join(far, "root", "left").select(
            "word", F.coalesce("_far", "root").alias("root"), F.col("_far").isNotNull().alias("_moved")), "roots")
        moved = not new.where("_moved").isEmpty()
        drop_written(state.sparkSession, state)
        state = new.drop("_moved")
        if not moved:
            return state


def spelling_variants(docs: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = written(word_counts(docs), "words")
    pairs = near_pairs(words, node_words)
    # the largest count, then the smallest word by its code points (UTF-8 keeps their order)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("_best")
    about = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    known = words.join(about, "word", "left")
    holds = -F.col("_best.less") >= 2 * F.col("n")
    known = written(known.select(
        "word", F.when(holds, F.col("_best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(holds, -F.col("_best.less")).alias("form_n")), "forms")
    root = roots(known.where("form is not null"))
    return known.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
