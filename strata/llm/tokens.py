"""Token ids in word-aligned binary files (Simple-8b).

Documents are range-partitioned by ``doc_id``; every task encodes its sorted
rows and writes files of bounded size to the shared folder. A file is complete
when the manifest (a table that Spark commits) lists it, so files of lost or
repeated tasks are never read. Reading starts from the manifest.

File layout, little-endian: eight 64-bit numbers (magic, version, documents,
ids, ids a block, blocks, words, first document's rank in the partition); per
document its id (int64), its count of ids (uint64) and whether its id is
known (uint8, padded to 8 bytes); per block the offset of its first word; the
words. The top 4 bits of a word select how many ids of how many bits the other
60 hold; selector 15 is an escape: the next word is one raw 64-bit id. Blocks
start on a word, so blocks encode and decode side by side in numpy.

Defined cases: a null text counts as empty (only the end id); null ids come
first; equal ids are ordered by the hash of the text; repeated rows are each
written; an empty table gives no file and an empty result. Only doc_id and
text are read.
"""

from __future__ import annotations

import re
import string
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import scratch, written

#: (ids, bits each) of selectors 0 to 14; selector 0 is a run of zeros.
PACK = ((120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10),
        (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
BLOCK = 4096
MAGIC, VERSION = 0x38424D5341525453, 1
HEAD = "<8Q"
#: A file is closed after so many ids (a longer document still stays whole).
FILE_IDS = 1 << 21
#: Bytes of text that are encoded at a time.
SLICE = 8 << 20


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, offset of each block's first word) of uint64 ids."""
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64)
    ids = ids.astype(np.uint64)
    width = np.searchsorted(1 << np.arange(64, dtype=np.uint64), ids, "right").astype(np.uint8) \
        if ids.max() >> np.uint64(52) else np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    at = np.arange(n, dtype=np.int32)
    room = np.minimum(np.minimum((at // block + 1) * block, n) - at, PACK[0][0]).astype(np.uint8)
    # The widest of the next 1, 2, 4, ... ids; two such runs cover any number of ids.
    widest = [width]
    while 2 << len(widest) <= PACK[0][0] * 2:
        k, w = 1 << len(widest) - 1, widest[-1]
        widest.append(np.maximum(w, np.append(w[k:], w[:k])[:n]))
    best = np.full(n, ESCAPE, np.uint8)
    for s in range(len(PACK) - 1, -1, -1):  # a selector that holds more comes later
        count, bits = PACK[s]
        if n < count:
            continue
        w = widest[count.bit_length() - 1] <= bits
        more = count - (1 << count.bit_length() - 1)
        fits = (room >= count) & w
        fits[:n - more] &= w[more:]
        np.copyto(best, np.uint8(s), where=fits)
    step = np.array([c for c, _ in PACK] + [1])
    # Follow the chosen steps in all blocks at once.
    pos = np.arange(0, n, block)
    live, last = np.arange(len(pos)), np.minimum(pos + block, n)
    starts, owners = [], []
    while len(live):
        starts.append(pos[live])
        owners.append(live)
        pos[live] += step[best[pos[live]]]
        live = live[pos[live] < last[live]]
    starts = np.concatenate(starts)
    order = np.argsort(starts, kind="stable")
    starts, owner = starts[order], np.concatenate(owners)[order]
    kind = best[starts]
    size = np.where(kind == ESCAPE, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in np.unique(kind):
        on = kind == s
        value = np.full(int(on.sum()), int(s) << 60, np.uint64)
        if s == ESCAPE:
            words[place[on] + 1] = ids[starts[on]]
        else:
            count, bits = PACK[s]
            for k in range(count if bits else 0):
                value |= ids[starts[on] + k] << np.uint64(k * bits)
        words[place[on]] = value
    first = np.searchsorted(owner, np.arange(len(pos)))
    return words, np.append(place[first], len(words)).astype(np.uint64)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids. Which words are escapes' raw values is settled from each
    block's start on, as a raw value may look like any selector."""
    out = np.zeros(n, np.uint64)
    if n == 0:
        return out
    kind = (words >> np.uint64(60)).astype(np.uint8)
    raw = np.zeros(len(words), bool)
    if (kind == ESCAPE).any():
        pos, last = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
        live = np.arange(len(pos))
        while len(live):
            escaped = kind[pos[live]] == ESCAPE
            raw[pos[live][escaped] + 1] = True
            pos[live] += 1 + escaped
            live = live[pos[live] < last[live]]
    real = np.flatnonzero(~raw)
    kind = kind[real]
    count = np.array([c for c, _ in PACK] + [1])[kind]
    at = np.cumsum(count) - count
    low = np.uint64((1 << 60) - 1)
    for s in np.unique(kind):
        on = kind == s
        if s == ESCAPE:
            out[at[on]] = words[real[on] + 1]
        else:
            size, bits = PACK[s]
            value = words[real[on]] & low
            mask = np.uint64((1 << bits) - 1)
            for k in range(size if bits else 0):
                out[at[on] + k] = value >> np.uint64(k * bits) & mask
    return out


def file_bytes(doc_ids: list, counts: list[int], ids: np.ndarray, first: int) -> bytes:
    words, offsets = pack(ids)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    head = struct.pack(HEAD, MAGIC, VERSION, len(doc_ids), len(ids), BLOCK, len(offsets) - 1,
                       len(words), first)
    return b"".join([head, np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
                     np.array(counts, "<u8").tobytes(), known.tobytes() + bytes(-len(known) % 8),
                     offsets.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def parse_file(data) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc ids, counts, all ids) of one file's bytes."""
    magic, version, docs, n, block, blocks, words, _ = struct.unpack_from(HEAD, data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token file")
    at = struct.calcsize(HEAD)
    take = lambda kind, k: np.frombuffer(data, kind, k, at)
    doc_ids = take("<i8", docs)
    at += 8 * docs
    counts = take("<u8", docs)
    at += 8 * docs
    known = take("u1", docs)
    at += docs + -docs % 8
    offsets = take("<u8", blocks + 1)
    at += 8 * (blocks + 1)
    ids = unpack(take("<u8", words), offsets, n, block)
    return [int(x) if k else None for x, k in zip(doc_ids, known)], counts.astype(np.int64), ids


def open_store(uri: str):
    """(pyarrow file system, path in it) of a folder that executors share."""
    from pyarrow import fs
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class WordEncoder:
    """The tokenizer with a bounded memory of white-space-separated words.

    The memory has two halves: when the newer one is full it becomes the older
    one, and words of the older one that occur again move over, so frequent
    words are learned once. A worker process keeps it from task to task.

    The tokenizer splits at white space, lower-cases and drops it, so the ids
    of a text are those of its words one after another. It also splits letters
    from a run of punctuation after them, so a word of this form needs no
    entry beyond those of its two parts, and it keeps letters together: new
    words of letters are encoded many at a time as one text and told apart by
    their last pieces, which the vocabulary marks.
    """

    #: letters whose lower case is one letter, and what may come after them
    LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+")
    PUNCTUATION = string.punctuation
    MANY = 1000

    def __init__(self, path: str, limit: int = 500_000, last: str = "</w>"):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, i in vocabulary.items():
            self.ends[i] = piece.endswith(last)
        self.limit, self.known, self.older = limit // 2, {"": b""}, {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, stems: list[str], rest: list[str]) -> None:
        groups = [stems[i:i + self.MANY] for i in range(0, len(stems), self.MANY)]
        for words, ids in zip(groups, self._encode([" ".join(g) for g in groups])):
            cut = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cut) != len(words):
                rest = rest + words
                continue
            raw, at = ids.tobytes(), 0
            for w, e in zip(words, cut.tolist()):
                self.known[w] = raw[at:e]
                at = e
        for w, ids in zip(rest, self._encode(rest)):
            self.known[w] = ids.tobytes()

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text. Texts are cut and their distinct words found by
        Arrow; a word is looked up once a call, its ids are copied to its places."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        flat = pc.ascii_lower(pc.fill_null(texts, ""))  # the tokenizer does so, too
        for space in "\n\t":
            flat = pc.replace_substring(flat, space, " ")
        lists = pc.split_pattern(flat, " ")
        found = lists.flatten().dictionary_encode()
        words = found.dictionary.to_pylist()
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.older, self.known = self.known, {"": b""}
            new = set(words)
            new.discard("")
        known, older = self.known, self.older
        if older:
            known.update((w, older[w]) for w in new.intersection(older))
            new = new.difference(known)
        stems, rest, joined = set(), set(), []
        for w in new:
            stem = w.rstrip(self.PUNCTUATION)
            if not (stem.isalpha() and (stem.isascii() or self.LETTERS.fullmatch(stem))):
                rest.add(w)
                continue
            low = stem.lower()
            stems.add(low)
            if low != w:
                joined.append((w, low, w[len(low):]))
        rest.update(tail for _, _, tail in joined)
        self._learn(list(stems.difference(known)), list(rest.difference(known)))
        known.update((w, known[low] + known[tail]) for w, low, tail in joined)
        raw = [known[w] for w in words]
        ids = np.frombuffer(b"".join(raw), np.uint32)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        which = found.indices.to_numpy()
        each = size[which]
        ends = np.cumsum(each)
        place = np.repeat((np.cumsum(size) - size)[which] - ends + each, each)
        place += np.arange(len(place))
        cut = np.append(0, ends)[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return np.split(ids[place], cut[1:-1]) if len(texts) else []


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, about SLICE bytes of a text column at a time."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False).astype(np.int64)
    cut = np.flatnonzero(np.diff(np.cumsum(size) // SLICE)) + 1
    for s, e in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
        if s < e:
            yield batch.slice(s, e - s)


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """The worker process's encoder."""
    return WordEncoder(path)


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 1) -> tuple[str, DataFrame]:
    """Write the files; (folder, manifest: part, file_no, file, n_docs, n_ids)."""
    spark = docs.sparkSession
    folder = scratch(spark, "tokens")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .repartitionByRange(n, *order).sortWithinPartitions(*order)

    def run(batches):
        from pyspark import TaskContext
        part, mine = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        encoder, store = encoder_of(tokenizer), None
        doc_ids, counts, ids, held, seen, no = [], [], [], 0, 0, 0

        def close():
            nonlocal store, doc_ids, counts, ids, held, seen, no
            if store is None:
                store = open_store(folder)
                store[0].create_dir(store[1], recursive=True)
            name = f"part-{part:06d}-{no:05d}-{mine}.ids"
            with store[0].open_output_stream(f"{store[1]}/{name}") as f:
                f.write(file_bytes(doc_ids, counts, np.concatenate(ids), seen))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                              "file_no": pa.array([no], pa.int32()), "file": [name],
                                              "n_docs": [len(doc_ids)], "n_ids": [held]})
            seen, no = seen + len(doc_ids), no + 1
            doc_ids, counts, ids, held = [], [], [], 0
            return row

        for b in batches:
            for some in slices(b, 1):
                for doc, got in zip(some.column(0).to_pylist(), encoder.encode(some.column(1))):
                    doc_ids.append(doc)
                    ids += [got, np.array([end_id], np.uint32)]
                    counts.append(len(got) + 1)
                    held += len(got) + 1
                    if held >= FILE_IDS:
                        yield close()
        if doc_ids:
            yield close()
        pa.default_memory_pool().release_unused()  # the worker stays, with its encoder

    manifest = rows.mapInArrow(run, "part int, file_no int, file string, n_docs long, n_ids long")
    return folder, written(manifest, "manifest")


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    # One row a file of some millions of ids: the driver adds up their counts.
    files, start = [], 0
    for r in manifest.select("part", "file_no", "file", "n_ids").orderBy("part", "file_no").collect():
        files.append((r["file"], start))
        start += r["n_ids"]
    listed = spark.createDataFrame(files, "file string, start long")
    listed = listed.repartition(max(1, len(files)), "file")

    def run(batches):
        store, root = open_store(folder)
        for b in batches:
            for name, begin in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_file(f"{root}/{name}") as f:
                    doc_ids, counts, ids = parse_file(f.read())
                ends = np.cumsum(counts)
                ids = ids.astype("<u4")
                crc = [zlib.crc32(ids[e - c:e]) for c, e in zip(counts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(begin + ends - counts, pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    return read_tokens(docs.sparkSession, *write_tokens(docs, tokenizer, end_id))
