"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items are turned into templates: every word loses case and
outer punctuation, and numbers, units and names become the placeholders
<num>, <unit> and <name> with the words they replace kept as slots. Windows of
WINDOW template words are hashed and joined. Where a document and an item
share windows on one diagonal they are looked at word by word: plain words must
agree, and slots must be re-filled consistently, one filling of the item always
by the same filling of the document, over the whole diagonal. What most places
of a filling have is its filling; windows with another do not count. A question
with other numbers and names is so caught, while a text of the same shape with
mixed-up fillings loses the windows in which they clash.

A document is contaminated when consistent windows cover SHARE of some item's
windows. Items shorter than a window are one window of their whole length, and
are found in documents of that length only. A name that begins a sentence is a
plain word, as nothing near it tells it from any other first word.

Defined cases: null texts are empty and match nothing, on either side; of
equally frequent fillings the first one counts; texts of any length are read
whole; an item without words is ignored; repeated items and documents are judged alike; empty
tables give an empty result; other columns pass through ``without_leaks``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.minhash import row_key

WINDOW, SHARE = 5, 0.75
#: Hashes of item windows that tasks hold as a prefilter (8 bytes each).
BROADCAST_WINDOWS = 4_000_000

NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    " sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety"
    " hundred thousand million billion half dozen".split())
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles g kg mg gram grams kilogram kilograms lb"
    " lbs pound pounds oz ounce ounces ton tons l ml liter liters litre litres gallon gallons s sec"
    " second seconds min minute minutes h hr hour hours day days week weeks month months year years"
    " percent % degree degrees dollar dollars euro euros cent cents usd eur mph kmh km/h".split())
NUMBER = re.compile(r"[+\-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?")
OUTER = ".,;:!?\"'()[]{}<>«»“”‘’„…*#&|_`~"


def template(text: str | None) -> tuple[list[str], list[str]]:
    """(template words, fillings). A plain word fills itself with ''.

    A name is a capitalised word that begins neither a sentence nor a line.
    """
    words = re.sub(r"[\x09\x0B-\x0D]", " ", text or "").replace("\n", " \n ").split(" ")
    out, slots, begins = [], [], True
    for w in words:
        if "\n" in w:
            begins = True
            continue
        bare = w.strip(OUTER)
        if not bare:
            begins = begins or (w != "" and w[-1] in ".!?")
            continue
        low = bare.lower()
        if NUMBER.fullmatch(bare) or low in NUMBER_WORDS:
            out.append("<num>")
            slots.append(low)
        elif low in UNITS and out and out[-1] == "<num>":
            out.append("<unit>")
            slots.append(low)
        elif not begins and bare[0].isupper() and len(bare) > 1 and bare[1:].islower():
            out.append("<name>")
            slots.append(low)
        else:
            out.append(low)
            slots.append("")
        begins = w[-1] in ".!?:"
    return out, slots


class Hasher:
    def __init__(self, limit: int = 500_000):
        self.known, self.limit = {}, limit
        self.mult = np.random.default_rng(4).integers(1, 1 << 63, WINDOW, np.uint64) * np.uint64(2) + np.uint64(1)

    def windows(self, words: list[str]) -> np.ndarray:
        import xxhash
        if len(self.known) > self.limit:
            self.known.clear()
        for w in set(words).difference(self.known):
            self.known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        k = min(WINDOW, len(h))
        if k == 0:
            return h.view(np.int64)
        out = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            out += h[i:i + len(out)] * self.mult[i]
        out ^= out >> np.uint64(29)
        return (out * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def filling(words: list[str], pairs: list[tuple[int, str, str]]) -> dict[str, str]:
    """The one filling of each of the item's fillings in a document: what most
    of its aligned places have, the first of equals. ``pairs`` are (item
    position, item's, document's). Two names of the item stay two: a name of the
    document goes to the one that it replaces most often."""
    votes: dict[str, dict[str, int]] = {}
    names = set()
    for at, x, y in pairs:
        of = votes.setdefault(x, {})
        of[y] = of.get(y, 0) + 1
        if words[at] == "<name>":
            names.add(x)
    out, taken = {}, set()
    for x in sorted(votes, key=lambda x: -max(votes[x].values())):
        free = {y: n for y, n in votes[x].items() if x not in names or y not in taken}
        if free:
            out[x] = max(free, key=free.get)
            if x in names:
                taken.add(out[x])
    return out


def covered(item: tuple[list[str], list[str]], doc: tuple[list[str], list[str]],
            hits: list[tuple[int, int]]) -> set[int]:
    """Item windows matched by (item position, document position) hits that are
    really equal and whose slots agree with one filling over their whole
    diagonal. A window with a slot filled otherwise does not count."""
    (words, slots), (dwords, dslots) = item, doc
    k = min(WINDOW, len(words))
    lines: dict[int, set[int]] = {}
    for i, d in set(hits):
        if words[i:i + k] == dwords[d:d + k]:
            lines.setdefault(d - i, set()).add(i)
    best: set[int] = set()
    for shift, at in lines.items():
        places = sorted({p for i in at for p in range(i, i + k) if slots[p]})
        one = filling(words, [(p, slots[p], dslots[p + shift]) for p in places])
        clash = {p for p in places if one.get(slots[p]) != dslots[p + shift]}
        best |= {i for i in at if not clash.intersection(range(i, i + k))}
    return best


def item_windows(items: DataFrame) -> DataFrame:
    """(hash, item, pos, n): the windows of all distinct items' templates."""
    def run(batches):
        hasher = Hasher()
        for b in batches:
            rows = [[], [], [], []]
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = hasher.windows(template(text)[0]).tolist()
                for pos, x in enumerate(h):
                    for r, v in zip(rows, (x, item, pos, len(h))):
                        r.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], ["hash", "item", "pos", "n"])

    keyed = items.select(row_key_of_item().alias("item"), F.col("text").cast("string")).dropDuplicates(["item"])
    return written(keyed.mapInArrow(run, "hash long, item long, pos long, n long"), "items")


def row_key_of_item():
    return F.xxhash64(F.col("text").cast("string"))


def document_windows(docs: DataFrame, held: np.ndarray | None) -> DataFrame:
    """(hash, rk, pos) of the documents' windows; only hashes in ``held`` when given."""
    wanted = docs.sparkSession.sparkContext.broadcast(held) if held is not None else None

    def run(batches):
        hasher = Hasher()
        keep = wanted.value if wanted is not None else None
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                hashes, rows, at = [], [], []
                for rk, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    h = hasher.windows(template(text)[0])
                    pos = np.arange(len(h))
                    if keep is not None and len(h):
                        near = np.minimum(np.searchsorted(keep, h), len(keep) - 1)
                        on = keep[near] == h
                        h, pos = h[on], pos[on]
                    hashes.append(h)
                    at.append(pos)
                    rows.append(np.full(len(h), rk, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x), pa.int64()) for x in (hashes, rows, at)], ["hash", "rk", "pos"])

    rows = docs.select(row_key().alias("rk"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "hash long, rk long, pos long")


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, covered, windows, share for every document and item
    of which consistent windows cover SHARE or more."""
    found = written(_leaks(docs, items), "leaks")
    ids = docs.select(row_key().alias("rk"), "doc_id").join(found, "rk")
    named = items.select(row_key_of_item().alias("item"), "item_id")
    return ids.join(named, "item").select("doc_id", "item_id", "covered", "windows",
                                          F.round(F.col("covered") / F.col("windows"), 6).alias("share"))


def _leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    wins = item_windows(items)
    few = wins.count()
    held = None
    if few == 0:
        return docs.sparkSession.createDataFrame([], "rk long, item long, covered long, windows long")
    if few <= BROADCAST_WINDOWS:
        held = np.sort(wins.select("hash").distinct().toArrow().column(0).to_numpy())
    hits = document_windows(docs, held).join(
        wins.withColumnRenamed("pos", "ipos"), "hash").select("rk", "item", "ipos", "pos", "n")
    # Windows in common, counted before anything is gathered: a pair that
    # shares too few distinct item windows cannot reach the share.
    hits = written(hits, "hits")
    able = written(hits.groupBy("rk", "item").agg(F.count_distinct("ipos").alias("w"), F.first("n").alias("n"))
                   .where(F.col("w") >= F.col("n") * SHARE).select("rk", "item"), "able")
    pairs = hits.join(able, ["rk", "item"]).groupBy("rk", "item").agg(
        F.collect_list(F.struct("ipos", "pos")).alias("hits"))
    need = written(able.select("rk").distinct(), "need")
    texts = docs.select(row_key().alias("rk"), F.col("text").cast("string"))
    texts = texts.join(F.broadcast(need) if need.count() <= BROADCAST_WINDOWS // 4 else need, "rk") \
        .groupBy("rk").agg(F.first("text").alias("text"))
    itexts = items.select(row_key_of_item().alias("item"), F.col("text").cast("string").alias("itext")) \
        .dropDuplicates(["item"])

    def run(batches):
        for b in batches:
            out = []
            for rk, item, at, text, itext in zip(*[c.to_pylist() for c in b.columns]):
                t = template(itext)
                n = max(1, len(t[0]) - WINDOW + 1)
                got = len(covered(t, template(text), [(h["ipos"], h["pos"]) for h in at]))
                if got >= SHARE * n:
                    out.append((rk, item, got, n))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)],
                                             ["rk", "item", "covered", "windows"])

    return pairs.join(texts, "rk").join(itexts, "item").select("rk", "item", "hits", "text", "itext") \
        .mapInArrow(run, "rk long, item long, covered long, windows long")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones, whole rows and all columns."""
    bad = written(_leaks(docs, items).select(F.col("rk").alias("_rk")).distinct(), "bad")
    rows = docs.select(F.struct("*").alias("_row"), row_key().alias("_rk"))
    return rows.join(bad, "_rk", "left_anti").select("_row.*")
