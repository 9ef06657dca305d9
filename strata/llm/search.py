"""Ranked lexical search of a set of items over all documents.

Texts become postings of the items' terms in one pass over the documents.
A second pass sums up how many documents hold each term. Then every task
ranks all items over the documents it holds, segment by segment, and Spark
keeps the best rows of all segments.

A segment is ranked by a hybrid of the two classic orders. *Term at a time*,
the short posting lists of an item are summed into accumulators. These are
then one more iterator with a known bound, beside the long lists, and the
segment is walked *document at a time*, in waves of ascending documents: a
document whose bound does not beat the k-th score so far is skipped, lists
that cannot lift a document over it by themselves are only looked into for
documents that others bring, and a list is left as soon as its own bound no
longer helps. Skipping compares bounds with ``<=``: later documents lose ties.

Memory: a task holds the items' vocabulary and one segment
(``SEGMENT_POSTINGS``). Items are taken in blocks of ``BLOCK_BYTES`` of text,
one pass over the documents a block, so a vocabulary is bounded as well.

Defined cases: null and empty texts have no terms and are never found; an
item without terms has no rows; equal rows of the items are ranked once; equal
documents are all ranked, null ids after the others; an empty table gives an
empty result. Only doc_id, text, item_id and the item's text are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import drop_written, with_prefix, written

#: Bytes of item texts whose terms one pass over the documents serves.
BLOCK_BYTES = 16 << 20
#: A segment is closed after so many postings, or so many documents.
SEGMENT_POSTINGS, SEGMENT_DOCS = 1 << 22, 1 << 16
#: A list is short if it names at most one document in so many.
SHORT = 16
#: Documents in the first wave and in the largest.
WAVES = 256, 8192

# Term characters are letters, digits and everything beyond
# ASCII; only A-Z is lower-cased; the score's scale and length normalisation.
TERM_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else
                   b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
SCALE, LENGTH_SHARE = 1_000_000_000, 75


def terms(text: bytes | None) -> list[bytes]:
    """The terms of UTF-8 text. Every byte of a non-ASCII character is above
    0x7F, so a byte table does what the character class says."""
    return text.translate(TERM_BYTES).split() if text else []


# --- postings --------------------------------------------------------------------

POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms) and the items' terms in each document with terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                ids, ns, ts, fs = [], [], [], []
                for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    words = terms(text)
                    if not words:
                        continue
                    held = {known[w]: c for w, c in Counter(words).items() if w in known}
                    ids.append(doc)
                    ns.append(len(words))
                    ts.append(list(held))
                    fs.append(list(held.values()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(ts, pa.list_(pa.int32())),
                     pa.array(fs, pa.list_(pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, POSTINGS)


def document_frequencies(posted: DataFrame, size: int) -> DataFrame:
    """(term, df); each task adds up its own documents before the shuffle."""
    def run(batches):
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(b.column(0).flatten().to_numpy(False), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(df[held])], ["term", "df"])

    return posted.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# --- ranking -----------------------------------------------------------------------

class Segment:
    """Some documents in rank order of ties, and their postings by term."""

    def __init__(self, doc_ids, ns, counts, term, tf, n_docs: int, n_terms: int):
        order = np.lexsort((doc_ids.filled(0), doc_ids.mask))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.doc_ids, self.size = doc_ids[order], len(order)
        if len(ns) and int(ns.max()) * LENGTH_SHARE * n_docs < 1 << 62:
            length = LENGTH_SHARE * ns * n_docs // n_terms
        else:  # beyond 64 bits
            length = np.array([LENGTH_SHARE * int(x) * n_docs // n_terms for x in ns], np.int64)
        m = 100 - LENGTH_SHARE + length
        doc = np.repeat(np.arange(len(ns)), counts)
        tf = tf.astype(np.int64)
        gain = SCALE * tf // (1000 * tf + 8 * m[doc])
        doc = place[doc]
        by = np.lexsort((doc, term))
        self.docs, self.gains = doc[by], gain[by]
        self.terms, self.begins = np.unique(term[by], return_index=True)
        self.ends = np.append(self.begins[1:], len(by))
        self.best = np.maximum.reduceat(self.gains, self.begins) if len(by) else np.zeros(0, np.int64)

    def lists(self, asked: dict[int, int]):
        """(documents, gains, weight, bound) of each asked term held here."""
        want = np.fromiter(asked, np.int64, len(asked))
        at = np.searchsorted(self.terms, want)
        for t, i in zip(want.tolist(), at.tolist()):
            if i < len(self.terms) and self.terms[i] == t and asked[t] > 0:
                b, e = self.begins[i], self.ends[i]
                yield self.docs[b:e], self.gains[b:e], asked[t], asked[t] * int(self.best[i])

    def top(self, asked: dict[int, int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best for weighted terms, exactly."""
        short, long_ = [], []
        for x in self.lists(asked):
            (short if len(x[0]) * SHORT <= self.size else long_).append(x)
        # Term at a time: the short lists become one list of summed accumulators.
        acc_docs, acc = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if short:
            docs = np.concatenate([d for d, _, _, _ in short])
            gains = np.concatenate([g * w for _, g, w, _ in short])
            acc_docs, place = np.unique(docs, return_inverse=True)
            acc = np.zeros(len(acc_docs), np.int64)
            np.add.at(acc, place, gains)
        lists = sorted([*long_, (acc_docs, acc, 1, int(acc.max()))] if len(acc) else long_, key=lambda x: -x[3])
        if not lists:
            return acc_docs, acc
        # reach[i]: the most that lists i.. can add to a document
        reach = np.append(np.cumsum([x[3] for x in lists][::-1])[::-1], 0).tolist()
        ends = [0] * len(lists)
        best_docs, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        floor, at, wave = 0, 0, WAVES[0]
        # Document at a time, in waves of ascending documents.
        while at < self.size and reach[0] > floor:
            until = min(at + wave, self.size)
            spans = []
            for i, x in enumerate(lists):
                begin, ends[i] = ends[i], int(np.searchsorted(x[0], until))
                spans.append((begin, ends[i]))
            # Lists that can beat the floor only together with earlier ones
            # bring no documents of their own.
            leading = [i for i in range(len(lists)) if reach[i] > floor]
            found = np.unique(np.concatenate([lists[i][0][slice(*spans[i])] for i in leading]))
            score = np.zeros(len(found), np.int64)
            for i, (docs, gains, w, _) in enumerate(lists):
                alive = score + reach[i] > floor
                if not alive.all():
                    found, score = found[alive], score[alive]
                if not len(found):
                    break
                docs, gains = docs[slice(*spans[i])], gains[slice(*spans[i])]
                if len(docs):
                    place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                    score += np.where(docs[place] == found, gains[place] * w, 0)
            over = score > floor
            if over.any():
                best_docs, best = np.append(best_docs, found[over]), np.append(best, score[over])
                keep = np.lexsort((best_docs, -best))[:k]
                best_docs, best = best_docs[keep], best[keep]
                if len(best) == k:
                    floor = int(best[-1])
            at, wave = until, min(wave * 2, WAVES[1])
        return best_docs, best


def rank_segments(posted: DataFrame, asked: list[dict[int, int]], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of every segment for every item."""
    shared = posted.sparkSession.sparkContext.broadcast(asked)

    def ranked(held):
        ids = pa.concat_arrays([b.column(0) for b in held])
        doc_ids = np.ma.masked_array(ids.fill_null(0).to_numpy(False), ids.is_null().to_numpy(False))
        column = lambda i: np.concatenate([b.column(i).flatten().to_numpy(False) for b in held])
        counts = np.concatenate([b.column(2).value_lengths().to_numpy(False) for b in held])
        ns = np.concatenate([b.column(1).to_numpy(False) for b in held])
        seg = Segment(doc_ids, ns, counts, column(2), column(3), n_docs, n_terms)
        items, docs, scores = [], [], []
        for i, weights in enumerate(shared.value):
            d, s = seg.top(weights, k)
            items.append(np.full(len(d), i, np.int32))
            docs.append(d)
            scores.append(s)
        docs = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        found = seg.doc_ids[docs]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(items)), pa.array(found.filled(0), mask=np.ma.getmaskarray(found)),
             pa.array(np.concatenate(scores))], ["item", "doc_id", "score"])

    def run(batches):
        held, size, docs = [], 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size, docs = size + len(b.column(2).flatten()), docs + b.num_rows
            if size >= SEGMENT_POSTINGS or docs >= SEGMENT_DOCS:
                yield ranked(held)
                held, size, docs = [], 0, 0
        if held:
            yield ranked(held)

    return posted.mapInArrow(run, "item int, doc_id long, score long")


def _block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """Rank one block of items: (item_id, text) rows, fitting the driver by ``BLOCK_BYTES``."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    wanted = [{vocabulary.setdefault(w, len(vocabulary)): c for w, c in Counter(terms(text)).items()}
              for _, text in items]
    posted = written(postings(docs, vocabulary), "postings")
    n_docs, n_terms = posted.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row a term of this block's items.
    df = {r["term"]: r["df"] for r in document_frequencies(posted, len(vocabulary)).collect()}
    asked = [{t: c * weight(n_docs, df[t]) for t, c in item.items() if t in df} for item in wanted]
    best = written(rank_segments(posted, asked, n_docs, n_terms, k), "best")
    drop_written(spark, posted)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # As small as the block's list of ids.
    names = spark.createDataFrame([(i, x[0]) for i, x in enumerate(items)], "item int, item_id long")
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"),
                         F.col("text").cast("string").cast("binary").alias("text")).distinct()
    asked = asked.where(F.octet_length("text") > 0).withColumn("_size", F.octet_length("text").cast("long"))
    numbered = with_prefix(asked, [F.col("item_id"), F.xxhash64("text")], {"_at": "_size"}, "items")
    numbered = numbered.withColumn("_block", F.expr(f"_at div {BLOCK_BYTES}"))
    last = numbered.agg(F.max("_block")).first()[0]
    out = None
    for block in range(0 if last is None else last + 1):
        rows = numbered.where(F.col("_block") == block).select("item_id", "text").collect()
        if rows:
            got = _block(docs, [(r["item_id"], bytes(r["text"])) for r in rows], k)
            out = got if out is None else out.unionByName(got)
    return out if out is not None else \
        spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
