"""Secret scans, spelling variants, ranked search and shards against brute force, and their defined cases."""

from __future__ import annotations

import base64
import collections
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pytest
from tests.llm.conftest import HARD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 11: secrets ------------------------------------------------------------------

def element(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + content


def integer(x):
    return element(2, x.to_bytes(x.bit_length() // 8 + 1, "big"))


RNG = random.Random(11)
P, Q = (RNG.getrandbits(512) | 1 << 511 | 1 for _ in range(2))
RSA = element(0x30, b"".join(map(integer, [0, P * Q, 65537, RNG.getrandbits(1023), P, Q, 3, 5, 7])))
EC = element(0x30, integer(1) + element(4, RNG.randbytes(32)) + element(0xA0, element(6, bytes.fromhex("2a8648ce3d030107")))
             + element(0xA1, element(3, b"\0\4" + RNG.randbytes(64))))
ED = element(0x30, integer(0) + element(0x30, element(6, bytes.fromhex("2b6570"))) + element(4, element(4, RNG.randbytes(32))))
PKCS8 = element(0x30, integer(0) + element(0x30, element(6, bytes.fromhex("2a864886f70d010101")) + element(5, b"")) + element(4, RSA))
ENCRYPTED = element(0x30, element(0x30, element(6, bytes.fromhex("2a864886f70d01050d")) + element(0x30, integer(2048)))
                    + element(4, RNG.randbytes(64)))


def ssh():
    text = lambda b: len(b).to_bytes(4, "big") + b
    check = RNG.randbytes(4)
    public = text(b"ssh-ed25519") + text(RNG.randbytes(32))
    return b"openssh-key-v1\0" + text(b"none") + text(b"none") + text(b"") + (1).to_bytes(4, "big") + text(public) \
        + text(check * 2 + text(b"ssh-ed25519") + text(RNG.randbytes(64)) + b"\1\2\3")


KEYS = {"RSA 1024": RSA, "EC 256": EC, "Edwards": ED, "encrypted PKCS 8": ENCRYPTED, "OpenSSH ssh-ed25519": ssh()}


def lines(data, width=64, end="\n"):
    s = base64.b64encode(data).decode()
    return end.join(s[i:i + width] for i in range(0, len(s), width))


def armour(data, label="PRIVATE KEY", end="\n"):
    return f"-----BEGIN {label}-----{end}{lines(data, 64, end)}{end}-----END {label}-----"


def added(text):
    from strata.llm.secrets import spans
    return [(k, b, e, w) for k, b, e, w in spans(text) if k not in ("assign", "access", "hex")]


@pytest.mark.parametrize("what", KEYS)
def test_keys_are_found_in_every_coat(what):
    data = KEYS[what]
    one, wrapped, literal = lines(data, 1 << 20), lines(data), armour(data, end="\\n")
    for before, secret, after, kind in [
            ("see ", armour(data), " ok", "pem"), ('{"k": "', literal, '"}', "pem"), ("k=", one, " end", "key"),
            ("x\n", wrapped, "\nplain words follow", "key"), ('a "', lines(data, 76, "\\n"), '" b', "key"),
            ("path/", one, "", "key"), ("é🙂 ", one, " é", "key")]:
        assert added(before + secret + after) == [(kind, len(before), len(before + secret), what)]
    nested = base64.b64encode(armour(data).encode()).decode()
    got = added("data: " + nested)
    assert [(k, b, w) for k, b, e, w in got] == [("key", 6, what)] and got[0][2] >= 6 + len(nested) - 4
    if data[0] == 0x30:
        assert added(f"h {data.hex()}00ff z") == [("key", 2, 2 + 2 * len(data), what)]
        assert added(data.hex().upper()) == [("key", 0, 2 * len(data), what)]


def test_pkcs8_names_the_inner_key():
    assert [x[3] for x in added(armour(PKCS8))] == ["RSA 1024"]


def test_what_does_not_parse_is_not_reported():
    broken = bytearray(RSA)
    broken[3] ^= 1                                              # the outer length is off by one
    other = bytearray(RSA)
    other[30] ^= 1                                              # the modulus is not the primes' product
    for data in (bytes(broken), bytes(other), RSA[:-3], RNG.randbytes(600), EC[:20] + EC, ssh()[:-1]):
        assert added(armour(data)) == []
    assert [x[0] for x in added(armour(ED + b"\0" * 5))] == ["key"]   # no armoured key, but a key is in it
    for data in (bytes(broken), bytes(other), RSA[:-3], RNG.randbytes(600), ssh()[:-1]):
        assert added(lines(data)) == [] and added("x " + base64.b64encode(data).decode()) == []
    public = element(0x30, element(0x30, element(6, bytes.fromhex("2a864886f70d010101")) + element(5, b"")) + element(3, b"\0" + RSA[:150]))
    assert added(armour(public, "PUBLIC KEY")) == [] and added(lines(public)) == []
    assert added("-----BEGIN PRIVATE KEY-----\n" * 3000 + "-----END PUBLIC KEY-----") == []
    legacy = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n" + lines(RNG.randbytes(64)) \
        + "\n-----END RSA PRIVATE KEY-----"
    assert [x[3] for x in added(legacy)] == ["encrypted"] and added(legacy.replace("4,ENCRYPTED", "4,CLEAR")) == []


def test_openpgp_packets():
    body = b"\4" + RNG.randbytes(300)
    key = b"\x95" + len(body).to_bytes(2, "big") + body + b"\xcd\x05hello"
    text = armour(key, "PGP PRIVATE KEY BLOCK")
    assert [x[::3] for x in added(text)] == [("pem", "OpenPGP")]
    assert added(armour(key + b"\0", "PGP PRIVATE KEY BLOCK")) == [] and added(armour(b"\x99" + key[1:], "PGP PRIVATE KEY BLOCK")) == []


def part(x):
    return base64.urlsafe_b64encode(x if isinstance(x, bytes) else json.dumps(x).encode()).decode().rstrip("=")


def test_signed_tokens():
    def token(alg, size, payload={"sub": "1"}):
        return ".".join([part({"alg": alg, "typ": "JWT"}), part(payload), part(RNG.randbytes(size))])
    for alg, size in (("HS256", 32), ("ES512", 132), ("RS256", 256), ("EdDSA", 64), ("Mine", 9)):
        t = token(alg, size)
        assert added(f"Bearer {t}. Next") == [("jwt", 7, 7 + len(t), alg)]
        assert added(f"a.b-{'c' * 30}.{t}") == [("jwt", 35, 35 + len(t), alg)]
    for bad in (token("HS256", 31), token("none", 32), token("RS256", 64), token("HS256", 32, [1]), token("HS256", 32)[:-40],
                part({"typ": "JWT"}) + "." + part({"a": 1}) + "." + part(b"x" * 32), "eyJhbGciOi.aaaa.bbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbb"):
        assert added(bad) == []
    sealed = ".".join([part({"alg": "dir", "enc": "A256GCM"}), "", part(b"i" * 12), part(b"c" * 9), part(b"t" * 16)])
    assert added(sealed) == [("jwt", 0, len(sealed), "encrypted dir")]


def base_spans(text):
    """The contract's three patterns, one scan each."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return [f"{k}:{b}:{e}" for b, _, k, e in sorted(out)]


def test_report_equals_the_patterns_on_random_texts(spark):
    from strata.llm.secrets import secret_report
    rng = random.Random(5)
    bits = ["password", "PassWD", "api_key", "apikey", "toKen", "ſecret", "secret", " ", "  ", "=", ":", '"', "'", "AKIA", "ABCDEF0123456789",
            "0123456789abcdef", "abc", "+/", "_.-", "é", "🙂", "\n", "x", "7", "token=abc", "AKIAAKIA", "K"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += [armour(RSA) + " token = " + part({"alg": "HS256"}) + "." + part({}) + "." + part(b"s" * 32)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    for r in secret_report(df).collect():
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        kinds = collections.Counter(x.split(":")[0] for x in want)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        every = r.spans.split(",") if r.spans else []
        assert [x for x in every if x.split(":")[0] in ("assign", "access", "hex")] == want
        assert [int(x.split(":")[1]) for x in every] == sorted(int(x.split(":")[1]) for x in every)
        assert len(r.confirmed) == len(every) - len(want)


def test_secrets_defined_cases(spark, hard, none):
    from strata.llm.secrets import secret_report
    got = secret_report(hard).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in HARD)
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty and r.spans == "" and r.confirmed == [] for r in got)
    assert secret_report(none).collect() == []
    long = "word " * 200_000 + armour(RSA) + " A" * 100_000 + "f" * 500_000
    (r,) = secret_report(spark.createDataFrame([(1, long)], "doc_id long, text string")).collect()
    assert r.spans.split(",") == [f"pem:{1_000_000}:{1_000_000 + len(armour(RSA))}", f"hex:{len(long) - 500_000}:{len(long)}"]


# --- 12: spelling ------------------------------------------------------------------

def words_by_hand(docs):
    seen = collections.Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            seen[w] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_hand(docs):
    words, near = words_by_hand(docs), collections.defaultdict(list)
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) <= 1 and distance_one(a, b):
                near[a].append(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w
    return sorted(((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()), key=repr)


def variants(df, **kw):
    from strata.llm.spelling import spelling_variants
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("node_words", [1, 7, 4096])
def test_variants_equal_all_pairs(spark, node_words):
    """Also where the upper part of the trie is opened down to single words."""
    rng = random.Random(node_words)
    words = ["".join(rng.choice("abeéxzÿ") for _ in range(rng.randrange(4, 8))) for _ in range(120)]
    words += ["e" * k + "b" for k in range(11, 20)] + ["e" * k for k in range(12, 20)]       # counts beyond a branch
    words += ["ba" * 20, "ba" * 20 + "c", "ba" * 19 + "bc", "ba" * 16, "ba" * 15 + "b", "ba" * 16 + "e"]  # around the width
    docs = [(i, " ".join(rng.choice(words).upper() if rng.random() < .2 else rng.choice(words[:40] * 2 + words)
                         for _ in range(rng.randrange(300)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert variants(df, node_words=node_words) == variants_by_hand(docs)


def test_chains_of_forms_end_at_the_last(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    docs = [(None, " ".join(w for k, w in enumerate(chain) for _ in range(3 * 2 ** k)))]
    got = {r[0]: r[2] for r in variants(spark.createDataFrame(docs, "doc_id long, text string"))}
    assert got == {x[0]: x[2] for x in variants_by_hand(docs)} and len(set(got.values())) == 1


def test_spelling_of_a_whole_table(spark, small):
    docs = [(r.doc_id, r.text) for r in small.collect()]
    words = words_by_hand(docs)
    got = variants(small)
    assert {(w, n) for w, _, _, n, _, _ in got} == set(words.items())
    some = random.Random(2).sample(sorted(words), 60)
    by_word = {x[0]: x for x in got}
    for w in some:
        near = [x for x in words if abs(len(x) - len(w)) <= 1 and distance_one(x, w)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        assert by_word[w][4] == len(near)
        assert by_word[w][1] == (best if best and words[best] >= 2 * words[w] else None)


def test_spelling_defined_cases(spark, hard, none):
    assert variants(none) == []
    assert variants(hard) == variants_by_hand(HARD)
    long = "q" * 50_000
    docs = [(1, f"{long} {long} {long} {long}r {long}r {long}r"), (2, None)] + [(3, "×÷×÷× " * 3)] * 2
    assert variants(spark.createDataFrame(docs, "doc_id long, text string")) == variants_by_hand(docs)


def test_blocks_equal_the_plain_comparison():
    from strata.llm.spelling import near, near_blocks, padded
    rng = random.Random(3)
    words = [bytes(rng.choice(b"ab\xe9") for _ in range(rng.randrange(5, 33))) for _ in range(150)]
    words += [w[:i] + w[i + 1:] for w in words[:50] for i in (0, len(w) // 2, len(w) - 1)]
    q, w = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    sizes = np.array([len(x) for x in words])
    fits = (sizes[w] - sizes[q] >> 1) == 0
    q, w = q[fits], w[fits]
    letters = padded(words)
    got = near_blocks(letters[q], letters[w], sizes[q], sizes[w])
    assert got.tolist() == [near(words[i], words[j]) for i, j in zip(q, w)] and got.any()
    for i, j in zip(q[got], w[got]):
        assert distance_one(words[i].decode("latin-1"), words[j].decode("latin-1"))


# --- 13: search ------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def ranked_by_hand(docs, items, k=10):
    held = [(d, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total, df = len(held), sum(x[2] for x in held), collections.Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        asked = collections.Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for d, c, size in held:
            m = 100 - 75 + 75 * size * n // total
            s = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                    for t, times in asked.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def ranked(docs, items, k=10):
    from strata.llm.search import search
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in search(docs, items, k).collect()), key=repr)


def test_terms_are_the_classes_matches():
    from strata.llm.search import terms
    rng = random.Random(1)
    letters = list("aZ09 _-é日🙂\x00\x7f\x80\xa0 @[`{ÀİK\n")
    for _ in range(2000):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        assert [x.decode() for x in terms(t.encode())] == TERM.findall(t.translate(LOWER))
    assert terms(None) == terms(b"") == []


@pytest.mark.parametrize("segment", [None, 40])
def test_search_equals_scoring_all(spark, monkeypatch, segment):
    """With documents in one segment, and in many whose floors differ."""
    import strata.llm.search as s
    if segment:
        monkeypatch.setattr(s, "SEGMENT_DOCS", segment)
        monkeypatch.setattr(s, "WAVES", (4, 16))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        rng = random.Random(9)
        words = [f"w{i}" for i in range(300)] + ["É", "日本", "the"]
        weights = [1 / (i + 1) for i in range(len(words))]
        docs = [(i // 2, " ".join(rng.choices(words, weights, k=rng.randrange(80)))) for i in range(900)] + HARD
        items = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(30)))) for i in range(25)]
        items += [(3, "W1 w1 w1"), (3, "W1 w1 w1"), (None, "w5 the"), (7, None), (8, ""), (9, "?!"), (10, "unseen words")]
        got = ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                     spark.createDataFrame(items, "item_id long, text string"))
        assert got == ranked_by_hand(docs, items)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_items_in_blocks(spark, small, monkeypatch):
    import strata.llm.search as s
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = ranked(small, items)
    assert whole == ranked_by_hand([(r.doc_id, r.text) for r in small.collect()], [(r.item_id, r.text) for r in items.collect()])
    monkeypatch.setattr(s, "BLOCK_BYTES", 900)
    assert ranked(small, items) == whole


def test_skipping_reads_less_and_loses_nothing():
    """A rare term settles the ten best: the long list is not walked through."""
    from strata.llm.search import Segment
    rng = np.random.default_rng(4)
    n = 20_000
    rare = np.sort(rng.choice(3000, 30, replace=False))
    doc = np.concatenate([np.arange(n), rare])
    term = np.concatenate([np.zeros(n, np.int32), np.ones(30, np.int32)])
    order = np.lexsort((term, doc))
    counts = np.bincount(doc, minlength=n)
    seg = Segment(np.ma.masked_array(np.arange(n), np.zeros(n, bool)), np.full(n, 50), counts, term[order],
                  rng.integers(1, 9, len(doc)), n, 50 * n)
    asked = {0: 3, 1: 9000}
    docs, scores = seg.top(asked, 10)
    every = np.zeros(n, np.int64)
    for d, g, w, _ in seg.lists(asked):
        every[d] += g * w
    want = np.lexsort((np.arange(n), -every))[:10]
    assert docs.tolist() == want.tolist() and scores.tolist() == every[want].tolist()


def test_search_of_an_empty_table(spark, none, small):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked(none, items) == []
    assert ranked(small, items.limit(0)) == []


def test_search_ignores_clashing_columns(spark, hard):
    items = spark.createDataFrame([(1, "same one two", 5, 6)], "item_id long, text string, doc_id long, score long")
    assert ranked(hard, items) == ranked_by_hand(HARD, [(1, "same one two")])


# --- 9: shards by hand ------------------------------------------------------------------

def shards_by_hand(docs, n=40):
    """Rows in order of id, size and checksum, cut where the middle byte of a row passes a target."""
    rows = []
    for doc, text in docs:
        data = (text or "").encode()
        rows.append((doc is not None, doc or 0, len(data) + 16, zlib.crc32(data), doc))
    total, start, seen, out = sum(r[2] for r in rows), 0, collections.Counter(), []
    for _, _, size, crc, doc in sorted(rows):
        shard = (2 * start + size) * n // (2 * total)
        out.append((doc, size, crc, "bytes", shard, seen[shard], None))
        seen[shard] += 1
        start += size
    return sorted(out, key=repr)


@pytest.mark.parametrize("extra", [[], [(5, "again")] * 300 + [(None, None)] * 20])
def test_shards_equal_the_prefix_sums(spark, small, extra):
    from strata.llm.sharding import shards
    docs = [(r.doc_id, r.text) for r in small.collect()] + HARD + extra
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert sorted(map(tuple, shards(df).collect()), key=repr) == shards_by_hand(docs)
