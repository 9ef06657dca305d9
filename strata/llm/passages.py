"""Fuzzy repeated passages by collinear chaining.

1. Seeds are hashes of windows of several lengths (SIZES): of every WINDOW
   consecutive windows the one with the smallest hash (a minimiser), and all
   windows of K and of MIN_WORDS words. Where n words have n / 4 of them
   replaced, n / 4 - 2 windows of K = 3 words or more are equal. A first pass
   over all texts counts the windows of K words; those seen twice set a bit in
   a bitmap that grows with the texts up to a fixed size. A seed all of whose
   windows of K words have their bit set may be repeated; the others are not.
2. A repeated seed's first occurrence (by document id) stands for it. Every
   other occurrence is joined to it alone, so a passage in m documents makes
   m - 1 matches a seed, not m squared. Each length has first occurrences of
   its own: where the sentences of a passage stand earlier in other documents,
   the longer windows still lead to the document that has them together, and
   no MIN_WORDS equal words of an earlier document are missed. Documents are
   numbered in order; seeds and matches are shuffled as compressed columns in
   sorted blocks, one round of lengths and one part of the documents at a time.
3. The matches of a document with one earlier document are chained: a Fenwick
   tree of prefix maxima over the earlier document's positions finds for each
   match its best collinear predecessor under a linear gap cost.
4. Chains are aligned on the words: anchors joined over short gaps by their
   longest common subsequence, and both ends extended while words agree.
   The longest stretch of MIN_WORDS words and more, IDENTITY of them equal, is
   reported for the later document, then the same in what is left on its sides.

Defined cases: a null or short text (under MIN_WORDS words) has no passage;
rows with equal id and text count as one document; null ids come after all
others; ties between occurrences go to the smaller row hash; an empty table
gives an empty result. Other columns pass through ``without_repeats``; of
those only ``n_chars`` is brought up to date where a text was cut.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from strata.llm.common import drop_written, shuffles_dropped, written
from strata.llm.minhash import BROADCAST_KEYS, Shingler, row_key

#: Words of an anchor; words of a usual seed, one of so many windows in a row.
K, SEED, WINDOW = 3, 5, 8
MIN_WORDS, IDENTITY = 50, 0.75
#: Window length of the seeds, and of how many in a row one is taken.
SIZES = {K: 1, SEED: WINDOW, 10: WINDOW, 20: WINDOW, MIN_WORDS: 1}
#: A chain worth aligning has so many equal words; a run of them has an anchor every STEP words.
MIN_COVER, STEP = 10, 8
#: Seeds of SEED words, and words from their first to their last, that make a document the usual partner.
MIN_SEEDS, MIN_SPAN = 3, 20
#: Score of a match, cost of a skipped word on either side, longest gap in words.
GAIN, GAP_COST, MAX_GAP = 5.0, 0.1, 25
#: The bitmap of repeated windows of K words has at least two bits for each byte of text, which
#: holds about 0.3 of them, but never more than 2 ** MOST_BITS (128 MB); it is made in RANGES parts.
LEAST_BITS, MOST_BITS, RANGES = 20, 30, 1024
#: Seeds that a task holds at a time, and texts that it cuts at a time.
HOLD, TEXTS = 2_000_000, 500
#: Sizes whose seeds are dealt together, one round after the other.
ROUNDS = ((K,), (SEED, 10, 20), (MIN_WORDS,))
#: Matches are chained in so many parts, one after the other, where there is more text than PARTED bytes.
PARTS, PARTED = 4, 64 << 20


def squeezed(a: np.ndarray) -> bytes:
    """An array byte by byte, compressed: bytes that hardly change cost next to nothing."""
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize)
    return pa.compress(np.ascontiguousarray(raw.T).tobytes(), codec="zstd", asbytes=True)


def unsqueezed(b: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.decompress(b, n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def rises(a: np.ndarray) -> np.ndarray:
    """A rising array as its steps."""
    return np.diff(a, prepend=a.dtype.type(0))


def minimisers(h: np.ndarray, stop: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the smallest (the first of them) of every ``window`` hashes
    of one text; the hashes of the text that holds position i end before ``stop[i]``."""
    if window == 1:
        return np.flatnonzero(np.arange(len(h)) < stop[:len(h)])
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, step = h[:n].copy(), np.zeros(n, np.int64)
    for s in range(1, window):
        less = h[s:s + n] < best
        np.copyto(best, h[s:s + n], where=less)
        step[less] = s
    at = np.arange(n)
    at = (at + step)[at + window <= stop[:n]]
    return at[np.append(True, at[1:] != at[:-1])] if len(at) else at


def nth_of_row(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values stand in the same row before, and how often."""
    mixed = values + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    ranked = np.sort(mixed)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    at = np.flatnonzero(np.isin(mixed, twice)) if len(twice) else np.zeros(0, np.int64)
    at = at[np.lexsort((at, values[at], row[at]))]
    begin = np.append(True, (values[at][1:] != values[at][:-1]) | (row[at][1:] != row[at][:-1]))[:len(at)]
    nth = np.arange(len(at)) - np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
    return at[nth > 0], nth[nth > 0].astype(np.uint64)


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def hashes_of(buffer: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """xxHash64 of pieces of a buffer that goes on for 8 bytes behind them; all short ones of a size at once."""
    import xxhash
    lanes = [np.ndarray(len(buffer) - w + 1, f"<u{w}", buffer, strides=(1,)) for w in (1, 4, 8)]
    out = np.empty(len(start), np.uint64)
    order = np.argsort(size.astype(np.uint16) if len(size) and size.max() < 1 << 16 else size, kind="stable")
    cut = np.flatnonzero(np.diff(size[order], prepend=-1))
    for s, e in zip(cut, np.append(cut[1:], len(order))):
        which, n = order[s:e], int(size[order[s]])
        if n >= 32:
            out[which] = [xxhash.xxh64_intdigest(buffer[i:i + n]) for i in start[which].tolist()]
            continue
        at, left = start[which], n
        h = np.full(len(at), _P5 + np.uint64(n), np.uint64)
        while left >= 8:
            h = _turned(h ^ (_turned(lanes[2][at] * _P2, 31) * _P1), 27) * _P1 + _P4
            at, left = at + 8, left - 8
        if left >= 4:
            h = _turned(h ^ (lanes[1][at].astype(np.uint64) * _P1), 23) * _P2 + _P3
            at, left = at + 4, left - 4
        for i in range(left):
            h = _turned(h ^ (lanes[0][at + i].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        out[which] = h ^ (h >> np.uint64(32))
    return out


class Texts:
    """The words of many texts in a row, as hashes; texts under MIN_WORDS words are left out."""

    def __init__(self, shinglers: dict[int, Shingler], texts: list[str | None]):
        self.shinglers = shinglers
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        buffer = b"\n".join([b"", *parts, b" " * 8]).lower()
        space = _SPACE[np.frombuffer(buffer, np.uint8)]
        start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        size = np.flatnonzero(~space[:-1] & space[1:]) + 1 - start
        begins = np.cumsum([0, *[len(p) + 1 for p in parts]]) + 1
        n = np.diff(np.searchsorted(start, begins))
        whole = np.repeat(n >= MIN_WORDS, n)
        rows = np.flatnonzero(n >= MIN_WORDS)
        n = n[rows]
        self.hashes = hashes_of(buffer, start[whole], size[whole])
        ends = np.cumsum(n)
        self.row, self.end = np.repeat(rows, n), np.repeat(ends, n)
        self.place = np.arange(len(self.hashes)) - np.repeat(ends - n, n)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of K words, and whether each lies in one text."""
        h = self.shinglers[K].windows(self.hashes)
        return h, np.arange(len(h)) + K <= self.end[:len(h)]

    def seeds(self, k: int, on: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(seed, place of its first word among all) of the seeds of ``k`` words;
        with ``on`` only those of which every window of K words is on."""
        if not len(self.hashes):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = self.shinglers[k].windows(self.hashes)
        at = minimisers(h, self.end - k + 1, SIZES[k])
        if on is not None:
            upto = np.append(0, np.cumsum(on))
            at = at[upto[at + k - K + 1] - upto[at] == k - K + 1]
        values = h[at]
        if SIZES[k] == 1:
            return values, at
        # Where a text says one thing over and over, the n-th seed of a value also
        # meets the n-th one elsewhere, so that copies of it match place by place.
        again, nth = nth_of_row(values, self.row[at])
        return np.append(values, values[again] + nth * np.uint64(0x9E3779B97F4A7C15)), np.append(at, at[again])


class Seeder:
    """Seeds of texts; word hashes are shared by all sizes."""

    def __init__(self):
        self.shinglers = {k: Shingler(k) for k in SIZES}

    def texts(self, texts: list[str | None]) -> Texts:
        return Texts(self.shinglers, texts)

    def seeds(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(seed, position, words) of one text's seeds."""
        got = [(*self.texts([text]).seeds(k), k) for k in SIZES]
        return (np.concatenate([s for s, _, _ in got]), np.concatenate([p for _, p, _ in got]),
                np.concatenate([np.full(len(s), k) for s, _, k in got]))


def numbered(docs: DataFrame) -> DataFrame:
    """(num, id, rk, text) of the rows whose text may have MIN_WORDS words, written;
    equal rows are one. ``num`` rises by id, null ids last, then by row hash."""
    def run(batches):
        from pyspark import TaskContext
        at, before = TaskContext.get().partitionId() << 40, None
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            new = [i for i, (k, p) in enumerate(zip(keys, [before, *keys])) if k != p]
            before = keys[-1] if keys else before
            nums = pa.array(range(at, at + len(new)), pa.int64())
            at += len(new)
            yield pa.RecordBatch.from_arrays([nums, *[c.take(pa.array(new, pa.int64())) for c in b.columns]],
                                             ["num", "id", "rk", "text"])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), row_key().alias("rk"), F.col("text").cast("string"))
    rows = rows.where(F.octet_length("text") >= 2 * MIN_WORDS - 1)
    order = [F.col("id").isNull(), "id", "rk"]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return written(rows.mapInArrow(run, "num long, id long, rk long, text string"), "corpus")


def repeated_anchors(texts: DataFrame, held: int) -> np.ndarray:
    """The bitmap: a bit for every window of K words that ``texts``, ``held`` bytes, have twice or more.

    All windows of K words in a longer window that occurs twice occur twice."""
    power = min(max((2 * held).bit_length(), LEAST_BITS), MOST_BITS)
    part = (1 << power) // RANGES

    def count(batches):
        seeder, held, n = Seeder(), [], 0

        def flush():
            bits, times = np.unique(np.concatenate(held) >> np.uint64(64 - power), return_counts=True)
            ends = np.searchsorted(bits, np.arange(RANGES + 1, dtype=np.uint64) * np.uint64(part))
            # The bit's place in its range, and whether it was seen twice here.
            code = ((bits % np.uint64(part)).astype(np.uint32) << 1) | (times > 1)
            blocks = [code[s:e].astype(np.uint32) for s, e in zip(ends, ends[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(RANGES), pa.int32()), pa.array([len(x) for x in blocks], pa.int32()),
                 pa.array([squeezed(rises(x)) for x in blocks], pa.binary())], ["range", "n", "block"])

        for b in batches:
            for i in range(0, b.num_rows, TEXTS):
                h, inside = seeder.texts(b.slice(i, TEXTS).column(0).to_pylist()).anchors()
                held.append(h[inside])
                n += len(held[-1])
                if n >= HOLD:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    def merge(batches):
        now, once, twice = None, None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())],
                ["range", "bits"])

        for b in batches:
            for r, n, block in zip(*[c.to_pylist() for c in b.columns]):
                if r != now:
                    if now is not None:
                        yield done()
                    now, once, twice = r, np.zeros(part, bool), np.zeros(part, bool)
                code = np.cumsum(unsqueezed(block, np.uint32, n), dtype=np.uint32)
                at = code >> 1
                twice[at] |= once[at] | (code & 1 == 1)
                once[at] = True
        if now is not None:
            yield done()

    blocks = texts.select("text").mapInArrow(count, "range int, n int, block binary")
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # RANGES rows of part / 8 bytes each reach the driver.
    with shuffles_dropped(texts.sparkSession):
        got = blocks.repartition(n, "range").sortWithinPartitions("range").mapInArrow(merge, "range int, bits binary").toArrow()
    out = np.zeros((RANGES, part // 8), np.uint8)
    for r, bits in zip(got.column(0).to_pylist(), got.column(1)):
        out[r] = np.frombuffer(bits.as_buffer(), np.uint8)
    return out.reshape(-1).view(np.uint64)


#: Blocks of seeds that begin alike, in order: of which documents (``docs``, ``which`` of them), where, of how many words.
BLOCK = "part int, n int, n_docs int, seeds binary, docs binary, which binary, pos binary, words binary"
#: Blocks of matches of some documents: a seed's place, and that of its first occurrence.
MATCHES = "part int, n int, num binary, r_num binary, pos binary, r_pos binary, words binary"


def occurrences(texts: DataFrame, held, sizes: tuple[int, ...], n: int) -> DataFrame:
    """Blocks of the seeds of these sizes, dealt to ``n`` parts by their first bits.
    Seeds with a window of K words that occurs once are left out (``held``: the bitmap)."""
    def run(batches):
        seeder, bits = Seeder(), held.value
        power = (64 * len(bits)).bit_length() - 1
        rows, count = [], 0

        def flush():
            table = np.unique(np.concatenate([nums for nums, *_ in rows]))
            seed, pos, words = (np.concatenate([r[i] for r in rows]) for i in (1, 3, 4))
            which = np.concatenate([np.searchsorted(table, nums).astype(np.uint32)[row] for nums, _, row, *_ in rows])
            order = np.argsort(seed)
            seed, which, pos, words = seed[order], which[order], pos[order], words[order]
            part = ((seed >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
            ends = np.searchsorted(part, np.arange(n + 1))
            out = []
            for p, (s, e) in enumerate(zip(ends, ends[1:])):
                if s < e:
                    used = np.zeros(len(table), bool)
                    used[which[s:e]] = True
                    docs, local = table[used], (np.cumsum(used, dtype=np.uint32) - np.uint32(1))[which[s:e]]
                    out.append((p, e - s, len(docs), squeezed(rises(seed[s:e])), squeezed(rises(docs)),
                                squeezed(local), squeezed(pos[s:e]), squeezed(words[s:e])))
            return batch_of(out, BLOCK)

        for b in batches:
            for i in range(0, b.num_rows, TEXTS):
                part = b.slice(i, TEXTS)
                nums, texts = part.column(0).to_numpy(), seeder.texts(part.column(1).to_pylist())
                h, _ = texts.anchors()
                x = h >> np.uint64(64 - power)
                on = (bits[(x >> np.uint64(6)).astype(np.int64)] >> (x & np.uint64(63))) & np.uint64(1) == 1
                for k in sizes:
                    s, at = texts.seeds(k, on)
                    rows.append((nums, s, texts.row[at], texts.place[at].astype(np.uint32), np.full(len(s), k, np.uint8)))
                    count += len(s)
                if count >= HOLD:
                    yield flush()
                    rows, count = [], 0
        if count:
            yield flush()

    return texts.select("num", "text").mapInArrow(run, BLOCK)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = [c.split(" ") for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], pa.int32() if kind == "int" else pa.binary()) for i, (_, kind) in enumerate(kinds)],
        [name for name, _ in kinds])


def first_matches(blocks: DataFrame, n: int, parts: int) -> DataFrame:
    """Every occurrence of a seed with the seed's first one, if that is in another
    document, in blocks of the documents dealt to ``parts`` parts."""
    def run(batches):
        got = [[], [], [], []]
        for b in batches:
            for _, m, docs, *x in zip(*[c.to_pylist() for c in b.columns]):
                nums = np.cumsum(unsqueezed(x[1], np.int64, docs))
                for v, add in zip(got, (np.cumsum(unsqueezed(x[0], np.uint64, m), dtype=np.uint64),
                                        nums[unsqueezed(x[2], np.uint32, m)], unsqueezed(x[3], np.uint32, m),
                                        unsqueezed(x[4], np.uint8, m))):
                    v.append(add)
        if not got[0]:
            return
        seed = np.concatenate(got[0])
        order = np.argsort(seed, kind="stable")
        seed = seed[order]
        num, pos, words = (np.concatenate(v)[order] for v in got[1:])
        got.clear()
        begin = np.flatnonzero(np.append(True, seed[1:] != seed[:-1]))
        many = np.diff(np.append(begin, len(seed)))
        r_num = np.minimum.reduceat(num, begin)
        first = num == np.repeat(r_num, many)
        r_pos = np.minimum.reduceat(np.where(first, pos, np.uint32(0xFFFFFFFF)), begin)
        # Blocks hold at most HOLD matches, whatever one seed has.
        r_num, r_pos = np.repeat(r_num, many), np.repeat(r_pos, many)
        later = np.flatnonzero(~first)
        for s in range(0, len(later), HOLD):
            at = later[s:s + HOLD]
            part = (num[at] & ((1 << 40) - 1)) % parts
            order = np.lexsort((r_num[at], num[at], part))
            at, part = at[order], part[order]
            ends = np.searchsorted(part, np.arange(parts + 1))
            yield batch_of([(p, e - s, squeezed(rises(num[at[s:e]])), squeezed(r_num[at[s:e]]), squeezed(pos[at[s:e]]),
                             squeezed(r_pos[at[s:e]]), squeezed(words[at[s:e]]))
                            for p, (s, e) in enumerate(zip(ends, ends[1:])) if s < e], MATCHES)

    return blocks.repartitionById(n, "part").mapInArrow(run, MATCHES)


class Fenwick:
    """Prefix maxima over positions 0..n-1, each with the match that set it."""

    def __init__(self, n: int):
        self.best = [(float("-inf"), -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def upto(self, i: int) -> tuple[float, int]:
        """The largest value at positions before ``i``."""
        out = (float("-inf"), -1)
        while i > 0:
            if self.best[i] > out:
                out = self.best[i]
            i -= i & -i
        return out


def chains(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Collinear chains of (pos, other pos) matches, best first, none shared.

    score(i) = GAIN + max(0, max over j before i on both sides of
    score(j) - GAP_COST * (words skipped on either side)). The cost is a
    difference of coordinate sums, so the tree holds score(j) + GAP_COST *
    (x_j + y_j). A finished chain is cut where it skips more than MAX_GAP words:
    a limit inside the recursion would hide near predecessors behind far ones.
    """
    matches = sorted(set(matches))
    rank = {y: i for i, y in enumerate(sorted({y for _, y in matches}))}
    tree, score, before = Fenwick(len(rank)), [], []
    i = 0
    while i < len(matches):
        j = i
        while j < len(matches) and matches[j][0] == matches[i][0]:
            x, y = matches[j]
            value, at = tree.upto(rank[y])
            value -= GAP_COST * (x + y)
            if value <= 0:
                at = -1
            score.append(GAIN + max(value, 0.0))
            before.append(at)
            j += 1
        for m in range(i, j):  # matches at one place are no predecessors of each other
            x, y = matches[m]
            tree.put(rank[y], (score[m] + GAP_COST * (x + y), m))
        i = j
    used, out = set(), []
    for m in sorted(range(len(matches)), key=lambda m: -score[m]):
        chain = []
        while m >= 0 and m not in used:
            used.add(m)
            chain.append(matches[m])
            m = before[m]
        chain.reverse()
        cut = [i for i in range(1, len(chain)) if chain[i][0] - chain[i - 1][0] > MAX_GAP
               or chain[i][1] - chain[i - 1][1] > MAX_GAP]
        out += [chain[s:e] for s, e in zip([0, *cut], [*cut, len(chain)]) if s < e]
    return out


def common_words(a: list, b: list) -> list[tuple[int, int]]:
    """A longest common subsequence, as (place, other place) of its words."""
    s = 0
    while s < min(len(a), len(b)) and a[s] == b[s]:
        s += 1
    t = 0
    while t < min(len(a), len(b)) - s and a[-1 - t] == b[-1 - t]:
        t += 1
    n, m = len(a) - s - t, len(b) - s - t
    rows = [[0] * (m + 1)]
    for i in range(n if m else 0):
        up, row = rows[-1], [0]
        for j in range(m):
            row.append(up[j] + 1 if a[s + i] == b[s + j] else max(up[j + 1], row[j]))
        rows.append(row)
    middle, i, j = [], len(rows) - 1, m
    while i and j:
        if a[s + i - 1] == b[s + j - 1]:
            i, j = i - 1, j - 1
            middle.append((s + i, s + j))
        elif rows[i - 1][j] >= rows[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return [(k, k) for k in range(s)] + middle[::-1] + [(len(a) - k, len(b) - k) for k in range(t, 0, -1)]


#: Steps over unequal words, tried in this order, and words that must agree after one;
#: after a single replaced word one is enough.
STEPS, AGREE = ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (2, 0), (0, 2), (3, 3)), 2


def extend(a: list, b: list, i: int, j: int, way: int, drop: int = 4) -> list[tuple[int, int]]:
    """Walk from (i, j) one way while words agree; over a few unequal words
    when the words after them agree. Returns the words matched up to the best
    place; the walk gives up when it has lost ``drop`` more than it gained
    since then."""
    word = lambda s, k: s[k] if 0 <= k < len(s) else None
    score = top = best = 0
    matched = []
    while top - score < drop:
        x = word(a, i)
        if x is not None and x == word(b, j):
            matched.append((i, j))
            i, j, score = i + way, j + way, score + 1
            if score >= top:
                top, best = score, len(matched)
            continue
        for p, q in STEPS:
            if all(word(a, i + way * (p + k)) is not None
                   and word(a, i + way * (p + k)) == word(b, j + way * (q + k)) for k in range(1 if p == q == 1 else AGREE)):
                i, j, score = i + way * p, j + way * q, score - max(p, q)
                break
        else:
            break
    return matched[:best]


def align(a: list, b: list, chain: list[tuple[int, int]]) -> np.ndarray:
    """(place, other place) of every word that a chain's alignment matches, in order."""
    x, y = chain[0]
    matched = extend(a, b, x - 1, y - 1, -1)[::-1]
    for p, q in chain:
        if p >= x and q >= y:
            matched += [(x + i, y + j) for i, j in common_words(a[x:p], b[y:q])]
            matched += [(p + i, q + i) for i in range(K)]
            x, y = p + K, q + K
        elif p - x == q - y and p + K > x:  # overlaps the match before, on its diagonal
            matched += [(x + i, y + i) for i in range(p + K - x)]
            x, y = p + K, q + K
    return np.array(matched + extend(a, b, x, y, 1), np.int64)


def parts(matched: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(start, end, other start, other end, words matched) of the passages in an
    alignment: the longest stretch that has MIN_WORDS words, IDENTITY of them
    equal on both sides, then the same in what is left before and after it.

    A longest stretch begins and ends with a run of equal words, and no run
    that it touches stays outside: more equal words only raise its identity.
    """
    x, y = matched.T
    cut = np.flatnonzero((np.diff(x) != 1) | (np.diff(y) != 1)) + 1
    first, last = np.append(0, cut), np.append(cut, len(x)) - 1
    out, todo = [], [(0, len(first))]
    while todo:
        lo, hi = todo.pop()
        if lo >= hi or x[last[hi - 1]] + 1 - x[first[lo]] < MIN_WORDS:
            continue
        best = MIN_WORDS - 1, -1, -1
        for i in range(lo, hi):
            if x[last[hi - 1]] + 1 - x[first[i]] <= best[0]:
                break
            ends = last[i:hi]
            wide = x[ends] + 1 - x[first[i]]
            ok = ends + 1 - first[i] >= IDENTITY * np.maximum(wide, y[ends] + 1 - y[first[i]])
            ok &= wide > best[0]
            if ok.any():
                k = int(np.flatnonzero(ok)[-1])
                best = int(wide[k]), i, i + k
        n, i, j = best
        if i >= 0:
            s, e = first[i], last[j]
            out.append((int(x[s]), int(x[e]) + 1, int(y[s]), int(y[e]) + 1, int(e + 1 - s)))
            todo += [(lo, i), (j + 1, hi)]
    return sorted(out)


def words_of(text: str) -> list[bytes]:
    """Words with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the words begin and end in the text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    space = np.concatenate([[True], _SPACE[raw], [True]])
    chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
    return chars[np.flatnonzero(space[:-1] & ~space[1:])], chars[np.flatnonzero(~space[:-1] & space[1:])]


def runs_of(group: np.ndarray, x: np.ndarray, y: np.ndarray, words: np.ndarray):
    """Matches of ``words`` equal words, joined where they touch on one diagonal:
    (group, start, other start, words, longest match in it) of each run, by group."""
    shift = x - y
    order = np.lexsort((x, shift, group))
    group, x, shift, words = group[order], x[order], shift[order], words[order]
    line = np.cumsum(np.append(True, (group[1:] != group[:-1]) | (shift[1:] != shift[:-1]))) << 32
    reach = np.maximum.accumulate(line + x + words)
    begin = np.flatnonzero(np.append(True, line[1:] + x[1:] > reach[:-1]))
    last = np.append(begin[1:], len(x)) - 1
    start = x[begin]
    return group[begin], start, start - shift[begin], reach[last] - line[last] - start, np.maximum.reduceat(words, begin)


def anchors(x: int, y: int, n: int) -> list[tuple[int, int]]:
    """Places of a run every STEP words, its last K words the last."""
    at = [*range(0, n - K, STEP), n - K]
    return [(x + i, y + i) for i in at]


def group_chains(xs: list[int], ys: list[int], ns: list[int], longest: list[int]) -> list[list[tuple[int, int]]]:
    """Chains of MIN_COVER equal words over the runs of one pair of documents.
    A run that holds MIN_WORDS words of one window is also a chain by itself,
    which no better chain can take words from."""
    points = [anchors(x, y, n) for x, y, n in zip(xs, ys, ns)]
    if len(points) == 1:
        return points
    of = {p: i for i, ps in enumerate(points) for p in ps}
    out = [ps for ps, k in zip(points, longest) if k >= MIN_WORDS]
    for c in chains(list(of)):
        cover = K + sum(q[0] - p[0] if of[p] == of[q] else min(K, q[0] - p[0], q[1] - p[1]) for p, q in zip(c, c[1:]))
        if cover >= MIN_COVER:
            out.append(c)
    return out


def candidate_chains(matches: DataFrame, n: int) -> DataFrame:
    """(num, r_num, xs, ys, further): chains long enough to align; ``further``
    where the seeds of SEED words alone would not have led to the other document."""
    def run(batches):
        got = [[], [], [], [], []]
        for b in batches:
            for _, m, *x in zip(*[c.to_pylist() for c in b.columns]):
                for v, add in zip(got, (np.cumsum(unsqueezed(x[0], np.int64, m)), unsqueezed(x[1], np.int64, m),
                                        unsqueezed(x[2], np.uint32, m), unsqueezed(x[3], np.uint32, m),
                                        unsqueezed(x[4], np.uint8, m))):
                    v.append(add)
        if not got[0]:
            return
        order = np.lexsort((np.concatenate(got[1]), np.concatenate(got[0])))
        rk, other, x, y, words = (np.concatenate(v)[order].astype(np.int64) for v in got)
        got.clear()
        # Whole documents at a time, so many that a batch has about HOLD / 10 matches.
        docs = np.flatnonzero(np.append(True, rk[1:] != rk[:-1]))
        cuts = np.unique(docs[np.searchsorted(docs, np.arange(0, len(rk), HOLD // 10), "right") - 1])
        for s, e in zip(cuts, np.append(cuts[1:], len(rk))):
            yield solve(rk[s:e], other[s:e], x[s:e], y[s:e], words[s:e])

    def solve(rk, other, x, y, words):
        out = {c: [] for c in ("num", "r_num", "xs", "ys", "further")}
        cut = np.append(0, np.flatnonzero((rk[1:] != rk[:-1]) | (other[1:] != other[:-1])) + 1)
        usual = np.add.reduceat(words == SEED, cut, dtype=np.int64) >= MIN_SEEDS
        far = np.maximum.reduceat(np.where(words == SEED, x, -1), cut)
        near = np.minimum.reduceat(np.where(words == SEED, x, 1 << 40), cut)
        usual &= far - near + SEED >= MIN_SPAN
        group, x, y, n, longest = runs_of(np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(rk)))), x, y, words)
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        end = np.append(begin[1:], len(group))
        ok = np.add.reduceat(n, begin) >= MIN_COVER
        for s, e in zip(begin[ok].tolist(), end[ok].tolist()):
            key, further = (int(rk[cut[group[s]]]), int(other[cut[group[s]]])), not usual[group[s]]
            for c in group_chains(*(v[s:e].tolist() for v in (x, y, n, longest))):
                for name, v in zip(out, (*key, [p for p, _ in c], [q for _, q in c], bool(further))):
                    out[name].append(v)
        return pa.RecordBatch.from_arrays(
            [pa.array(out["num"], pa.int64()), pa.array(out["r_num"], pa.int64()),
             pa.array(out["xs"], pa.list_(pa.int32())), pa.array(out["ys"], pa.list_(pa.int32())),
             pa.array(out["further"], pa.bool_())], list(out))

    return matches.repartitionById(n, F.col("part") % n).mapInArrow(
        run, "num long, r_num long, xs array<int>, ys array<int>, further boolean")


def texts_of(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(num, id, rk, text) of the documents with these numbers, written."""
    keys = written(keys.distinct(), "keys")
    got = written(texts.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, "num"), "texts")
    drop_written(texts.sparkSession, keys)
    return got


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word, start_char, end_char, matched_words,
    first_id, first_start, first_end: for every document the passages that
    some earlier document has too. Word and character ends are exclusive.
    Passages of further documents are left out inside those of usual ones."""
    rows = _passages(docs)
    ps = rows.groupBy("rk").agg(F.collect_list(F.struct(*rows.columns[1:])).alias("ps"))
    kept = ps.select(F.explode(F.expr(
        "filter(ps, p -> not p.further or not exists(ps, q -> not q.further"
        " and q.start_word <= p.start_word and q.end_word >= p.end_word))")).alias("p"))
    return kept.select("p.*").drop("further")


def _chains(texts: DataFrame) -> list[DataFrame]:
    """The chains of all documents, written, in parts. A round of sizes leaves
    only its matches on disk, and a part of them is shuffled at a time."""
    spark = texts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    parts = PARTS if held > PARTED else 1
    bitmap = spark.sparkContext.broadcast(repeated_anchors(texts, held))
    rounds = [written(first_matches(occurrences(texts, bitmap, sizes, n), n, n * parts), "matches") for sizes in ROUNDS]
    bitmap.unpersist()
    matches = reduce(DataFrame.unionByName, rounds)
    found = [written(candidate_chains(matches.where(F.col("part").between(n * i, n * i + n - 1)), n), "chains")
             for i in range(parts)]
    for r in rounds:
        drop_written(spark, r)
    return found


def _passages(docs: DataFrame) -> DataFrame:
    corpus = numbered(docs)
    found = [_aligned(corpus, chains) for chains in _chains(corpus)]
    drop_written(docs.sparkSession, corpus)
    return reduce(DataFrame.unionByName, found)


def _aligned(corpus: DataFrame, found: DataFrame) -> DataFrame:
    """The passages that these chains lead to, written."""
    texts = texts_of(corpus, found.select("num").unionByName(found.select(F.col("r_num").alias("num"))))
    pairs = found.groupBy("num", "r_num", "further").agg(F.collect_list(F.struct("xs", "ys")).alias("cs"))
    both = pairs.join(texts, "num").join(texts.select(
        F.col("num").alias("r_num"), F.col("id").alias("r_id"), F.col("text").alias("r_text")), "r_num")

    def run(batches):
        names = ["rk", "doc_id", "start_word", "end_word", "start_char", "end_char", "matched_words",
                 "first_id", "first_start", "first_end", "further"]
        last, w = None, []
        for b in batches:
            out = []
            for rk, doc, text, other_id, other, cs, further in zip(*[c.to_pylist() for c in b.columns]):
                if other != last:  # pairs come by their earlier document
                    last, w = other, words_of(other)
                a, got = words_of(text), []
                for c in sorted(cs, key=lambda c: -len(c["xs"])):
                    chain = list(zip(c["xs"], c["ys"]))
                    if any(s <= chain[0][0] and chain[-1][0] < e for s, e, *_ in got):
                        continue  # inside a passage that another chain gave
                    got += parts(align(a, w, chain))
                if got:
                    begin, end = spans(text)
                for s, e, u, v, m in got:
                    out.append((rk, doc, s, e, int(begin[s]), int(end[e - 1]), m, other_id, u, v, further))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], pa.bool_() if c == "further" else pa.int64())
                 for i, c in enumerate(names)], names)

    done = written(both.select("rk", "id", "text", "r_id", "r_text", "cs", "further").mapInArrow(
        run, "rk long, doc_id long, start_word long, end_word long, start_char long, end_char long,"
             " matched_words long, first_id long, first_start long, first_end long,"
             " further boolean"), "passages")
    for df in (found, texts):
        drop_written(corpus.sparkSession, df)
    return done


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with every repeated passage cut from all documents but the
    first; the pieces around a cut are joined by a new line. No row goes."""
    cuts = written(_passages(docs).groupBy("rk").agg(
        F.sort_array(F.collect_set(F.struct("start_char", "end_char"))).alias("_cuts")), "cuts")
    rows = docs.select(F.struct("*").alias("_row"), F.col("text").cast("string"), row_key().alias("rk"))
    rows = rows.join(F.broadcast(cuts) if cuts.count() <= BROADCAST_KEYS // 10 else cuts, "rk", "left")

    def run(batches):
        for b in batches:
            new = [t if cs is None else without(t, [(c["start_char"], c["end_char"]) for c in cs])
                   for t, cs in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.string()), b.column(2).is_valid()],
                                             ["_row", "_new", "_cut"])

    schema = StructType([StructField("_row", docs.schema), StructField("_new", StringType()),
                         StructField("_cut", BooleanType())])
    done = rows.select("_row", "text", "_cuts").mapInArrow(run, schema)
    columns = []
    for c, kind in docs.dtypes:
        col = F.col("_row").getField(c)
        if c == "text":
            col = F.col("_new")
        elif c == "n_chars":
            col = F.when(F.col("_cut"), F.length("_new").cast(kind)).otherwise(col)
        columns.append(col.alias(c))
    return done.select(*columns)


def without(text: str, cuts: list[tuple[int, int]]) -> str:
    """The pieces around the cuts, trimmed and joined by new lines."""
    pieces, at = [], 0
    for s, e in sorted(cuts):
        pieces.append(text[at:max(at, s)])
        at = max(at, e)
    return "\n".join(p for p in (x.strip(" \t\n\x0b\x0c\r") for x in [*pieces, text[at:]]) if p)
