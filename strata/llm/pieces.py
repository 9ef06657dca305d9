"""Subword encoding and decoding with a SentencePiece vocabulary by a
shared-prefix lattice pass.

A text is normalised as the model says (runs of spaces become one, outer ones
go) and cut into marked words: no piece of the vocabulary holds the word mark
after another character, so words are encoded on their own. A batch's distinct
words are sorted, which lays out their trie depth-first, and every word starts
from the forward scores of the prefix it shares with the one before.

The forward step at a position takes the best-scored piece that ends there and
is allowed after the piece that ends where it begins. For a vocabulary of the
merge kind (BPE) a piece is allowed after another exactly if encoding the two
together leaves them as they are; this makes the one surviving path the merge
encoding itself, not the path of the greatest sum. For the unigram kind every
pair is allowed and the pass is plain Viterbi. Characters without a piece
become their bytes' pieces.

Defined cases: a null or empty text has no ids and decodes to an empty text;
repeated rows are encoded each; an empty table gives an empty result. Only
doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"


class Pieces:
    """A model file's vocabulary."""

    def __init__(self, path: str, limit: int = 600_000):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto
        sp = SentencePieceProcessor(model_file=path)
        spec = proto.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        n = sp.vocab_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id = {sp.id_to_piece(i): i for i in plain}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.longest = max(map(len, self.id))
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.merges = spec.trainer_spec.model_type == proto.TrainerSpec.BPE
        self.squeeze = spec.normalizer_spec.remove_extra_whitespaces
        self.prefix = spec.normalizer_spec.add_dummy_prefix
        if spec.normalizer_spec.precompiled_charsmap:
            raise ValueError("only models without a character map are supported")
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece goes on over a word's beginning")
        self.lone_line = not any("\n" in p for p in self.id)
        self.text = [b""] * n
        for p, i in self.id.items():
            self.text[i] = p.encode()
        for b, i in self.byte.items():
            self.text[i] = bytes([b])
        self.worst = min(self.score.values()) - 10.0
        self.limit, self.known, self.pairs = limit, {}, {}

    def normal(self, text: str | None) -> str:
        text = text or ""
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if self.prefix and text:
            text = " " + text
        text = text.replace(" ", MARK)
        return text.rstrip(MARK) if self.squeeze else text

    def words(self, normal: str) -> list[str]:
        """Marked words; a line end that no piece holds is one of its own."""
        if self.lone_line:
            normal = normal.replace("\n", "\0\n\0")
        parts = normal.replace(MARK, "\0" + MARK).split("\0") if MARK * 2 not in normal and "\0" not in \
            normal.replace("\0\n\0", "") else None
        if parts is None:  # literal marks or null characters: cut by rule
            normal = normal.replace("\0\n\0", "\n")
            parts = re.findall(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+" if self.lone_line
                               else f"{MARK}+[^{MARK}]*|[^{MARK}]+", normal)
        return [p for p in parts if p]

    def merged(self, s: str) -> list[str]:
        """The merge encoding of a short string: always the best-scored pair, leftmost first."""
        parts, score = list(s), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                x = score.get(parts[i] + parts[i + 1])
                if x is not None and (best is None or x > best):
                    best, at = x, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def allowed(self, before: str, piece: str) -> bool:
        """May ``piece`` follow ``before`` ('' at a word's beginning)?"""
        if not self.merges:
            return True
        key = before, piece
        out = self.pairs.get(key)
        if out is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            out = self.pairs[key] = self.merged(before + piece) == ([before, piece] if before else [piece])
        return out

    def learn(self, words: list[str]) -> None:
        """Encode sorted distinct words, each from the prefix shared with the last."""
        score, longest, allowed, id_of = self.score, self.longest, self.allowed, self.id
        last = ""
        forward, begin, piece = [0.0], [0], [""]
        for word in words:
            same, most = 0, min(len(last), len(word))
            while same < most and last[same] == word[same]:
                same += 1
            del forward[same + 1:], begin[same + 1:], piece[same + 1:]
            for i in range(same + 1, len(word) + 1):
                best, at, what = None, i - 1, word[i - 1]
                for j in range(i - 1, max(0, i - longest) - 1, -1):
                    p = word[j:i]
                    x = score.get(p)
                    if x is None:
                        if j < i - 1:
                            continue
                        x = self.worst
                    x += forward[j]
                    if (best is None or x > best) and allowed(piece[j], p):
                        best, at, what = x, j, p
                        if self.merges:  # no other piece is allowed here
                            break
                forward.append(forward[at] + self.worst if best is None else best)
                begin.append(at)
                piece.append(what)
            ids, i = [], len(word)
            while i > 0:
                p = piece[i]
                x = id_of.get(p)
                if x is not None:
                    ids.append(x)
                elif self.byte:
                    ids += [self.byte[b] for b in reversed(p.encode("utf-8", "surrogatepass"))]
                else:
                    ids.append(self.unknown)
                i = begin[i]
            self.known[word] = np.array(ids[::-1], np.int32).tobytes()
            last = word

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        lists = [self.words(self.normal(t)) for t in texts]
        distinct = set(chain.from_iterable(lists))
        new = distinct.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = distinct
        self.learn(sorted(new))
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, ws)), np.int32) for ws in lists]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.text.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text[:1] == " " else text


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), round_trip (decoding gives the normalised text back)."""
    def run(batches):
        pieces = Pieces(model)
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                part = b.slice(i, 2000)
                texts = part.column(1).to_pylist()
                got = pieces.encode(texts)
                back = [pieces.decode(g) == pieces.normal(t).replace(MARK, " ").removeprefix(" " if pieces.prefix else "")
                        for g, t in zip(got, texts)]
                n = np.array([len(g) for g in got], np.int64)
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()),
                                               pa.array(np.concatenate(got), pa.int32()))
                crc = [zlib.crc32(g.tobytes()) for g in got]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), ids, pa.array(n), pa.array(crc, pa.int64()), pa.array(back)],
                    ["doc_id", "ids", "n_tokens", "ids_crc32", "round_trip"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>, n_tokens long, ids_crc32 long, round_trip boolean")


def decoded(tokens: DataFrame, model: str) -> DataFrame:
    """doc_id, text of rows with doc_id and ids (null ids: empty text)."""
    def run(batches):
        pieces = Pieces(model)
        for b in batches:
            text = [pieces.decode(np.array(x or [], np.int32)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
