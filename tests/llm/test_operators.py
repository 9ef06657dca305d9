"""Each operator against a brute-force version, and its defined cases."""

from __future__ import annotations

import collections
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from tests.llm.conftest import HARD

W = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return W.findall(t or "")


def lower(t):
    return (t or "").encode("utf-8", "surrogatepass").lower().split()


# --- 1: HTML -------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="nav"><nav><ul><li>Menu</ul></nav><!-- ad <p>no</p> --><header>Site</header><div class="cookie-notice">ok?</div>
<article class="post"><h1>Head &amp; line</h1><p>One <b>two<br><p>three&nbsp;&lt;x&gt; <form><input>f</form>four
<div class='ad'>buy<p>now</div><ul><li>a<li>b</ul><section id=comments><p>first!</p></section></article>
<aside>side</aside><footer>&copy; x</footer></body></html>"""


def test_html_blocks():
    from strata.llm.html import lines, main_text
    assert main_text(lines(PAGE), set()) == "Head & line\nOne two\nthree <x>\nfour\na\nb"
    assert lines(None) == [] and lines("") == [] and main_text([], set()) == ""


def test_headings_of_an_article_stay_whatever_their_ids_say():
    from strata.llm.html import lines, main_text
    page = ('<article><h2 id="related-work">Related work</h2><p id="comment-2">One.</p><h2 id="login">How to login</h2>'
            '<p class="ad-hoc">Two.</p><p class="advert">Buy.</p><div id="comments"><p>Me too.</p></div></article>')
    assert main_text(lines(page), set()) == "Related work\nOne.\nHow to login\nTwo."


def test_the_partner_decides_on_doubtful_blocks_of_articles_and_on_teasers(spark):
    from strata.llm.html import extract
    menu = "<nav>Menu</nav><div>Site name</div>"
    post = (f"{menu}<article><h1>%s</h1><p>Body of %s.</p>%s<section class='related-posts'><p>Read %s, too.</p></section>"
            "<div class='ad'>Buy</div></article>")
    teaser = f"{menu}<article><p>Short %s.</p></article><div>The long text of %s stands outside.</div>"
    rows = [(1, "http://a.org/x/1", post % ("one", "one", "<div class='share-price-table'>Prices</div>", "b")),
            (2, "http://a.org/x/2", post % ("two", "two", "", "c")),
            (3, "http://b.org/y/1", teaser % ("three", "three")), (4, "http://b.org/y/2", teaser % ("four", "four")),
            (5, "http://c.org/", "<article><p>Alone.</p><div class='share-price-table'>Prices</div></article>")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {
        1: "one\nBody of one.\nPrices", 2: "two\nBody of two.",
        3: "Short three.\nThe long text of three stands outside.", 4: "Short four.\nThe long text of four stands outside.",
        5: "Alone."}


def test_lcs_is_longest():
    from strata.llm.html import shared
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.randrange(5) for _ in range(rng.randrange(12))]
        b = [rng.randrange(5) for _ in range(rng.randrange(12))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = shared(np.array(a, np.uint64), np.array(b, np.uint64))
        kept = [x for x, on in zip(a, got) if on]
        assert len(kept) == best[-1][-1]
        it = iter(b)
        assert all(x in it for x in kept)


def test_unmarked_pages_lose_what_the_neighbour_shares(spark):
    from strata.llm.html import extract
    page = "<body><div>Site name</div><div>%s</div><div>Imprint</div></body>"
    rows = [(1, "http://a.org/x/1", page % "first"), (2, "http://a.org/x/2", page % "second"),
            (2, "http://a.org/x/2", page % "second"), (3, None, None), (4, "nonsense", ""), (None, "http://b.org/", PAGE)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", __import__(
        "pyspark").sql.functions.lit(0))).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [
        (0, "Head & line\nOne two\nthree <x>\nfour\na\nb"), (1, "first"), (2, "second"), (2, "second"), (3, ""), (4, "")]
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# --- 2: pieces --------------------------------------------------------------------

def test_pieces_equal_the_library(small):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from strata.llm.pieces import Pieces
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, mine = SentencePieceProcessor(model_file=path), Pieces(path)
    rng = random.Random(1)
    letters = list("aaabbb theinan  .,\n\t▁▁\0é日本🙂<s>0x0A</s> ")
    texts = [r.text for r in small.collect()] + [t or "" for _, t in HARD] + [
        "".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(2000)]
    for t, got in zip(texts, mine.encode(texts)):
        assert got.tolist() == sp.encode(t)
        assert mine.decode(got) == t.replace("▁", " ")


def test_pieces_rows(spark, hard, none):
    import public_tokenizers
    from strata.llm.pieces import decoded, encoded
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = encoded(hard, path)
    rows = got.collect()
    assert len(rows) == len(HARD) and all(r.round_trip for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    back = {r.doc_id: r.text for r in decoded(got, path).where("doc_id is not null").collect()}
    assert back[5] == "one two" and back[1] == ""
    assert encoded(none, path).collect() == []


def test_viterbi_of_a_unigram_model_is_optimal():
    import public_tokenizers
    from strata.llm.pieces import Pieces
    p = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    p.merges = False
    for word in ("▁theinan", "abcab", "thest"):
        p.learn([word])
        ids = np.frombuffer(p.known[word], np.int32).tolist()
        best = [0.0] + [-math.inf] * len(word)
        for i in range(1, len(word) + 1):
            best[i] = max(best[j] + p.score[word[j:i]] for j in range(i) if word[j:i] in p.score)
        name = {i: s for s, i in p.id.items()}
        assert math.isclose(sum(p.score[name[i]] for i in ids), best[-1])


# --- 3: language model ---------------------------------------------------------------

def lm_reference(rows, order=3, min_count=1):
    texts = [(i, lower(t) + [b""]) for i, t in rows]
    train = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    counts = [collections.Counter() for _ in range(order)]
    for i, ws in texts:
        if train(i):
            for n in range(order):
                counts[n].update(zip(*[ws[k:] for k in range(n + 1)]))
    total, kinds = sum(counts[0].values()), len(counts[0])
    kept = [counts[0]] + [{g: c for g, c in cs.items() if c >= min_count} for cs in counts[1:]]
    sums = [collections.defaultdict(lambda: [0, 0]) for _ in range(order)]
    for n in range(1, order):
        for g, c in kept[n].items():
            sums[n][g[:-1]][0] += c
            sums[n][g[:-1]][1] += 1

    def p(ws, i):
        out = (counts[0][(ws[i],)] + 1) / (total + kinds + 1)
        for n in range(1, order):
            h = tuple(ws[i - n:i]) if i >= n else None
            if h is None or h not in sums[n]:
                continue
            s, k = sums[n][h]
            out = max(kept[n].get((*h, ws[i]), 0) - 0.75, 0) / kept[n - 1][h] + (1 - (s - 0.75 * k) / kept[n - 1][h]) * out
        return out

    return [(i, not train(i), len(ws), sum(counts[0][(w,)] > 0 for w in ws), total,
             sum(math.log10((counts[0][(w,)] + 1) / (total + kinds + 1)) for w in ws),
             sum(math.log10(p(ws, k)) for k in range(len(ws)))) for i, ws in texts], p, counts


@pytest.mark.parametrize("which", ["small", "hard"])
@pytest.mark.parametrize("min_count, shard_rows", [(1, 1 << 20), (1, 5), (2, 7)])
def test_lm_equals_brute_force(request, which, min_count, shard_rows):
    """With files of a few rows nearly every context goes over several."""
    from strata.llm.lm import scored
    docs = request.getfixturevalue(which)
    docs = docs.limit(4) if which == "small" and shard_rows < 100 else docs
    want, _, _ = lm_reference([(r.doc_id, r.text) for r in docs.collect()], min_count=min_count)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = sorted((tuple(r) for r in scored(docs, min_count=min_count, shard_rows=shard_rows).collect()), key=key)
    for w, g in zip(sorted(want, key=key), got, strict=True):
        assert w[:5] == g[:5]
        assert math.isclose(w[5], g[5], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(w[6] - g[6]) < 3e-4 * w[2]


def test_lm_beats_its_base_on_held_out_texts(small):
    from strata.llm.lm import scored
    r = scored(small).where("held_out").selectExpr("sum(base_score)", "sum(score)").first()
    assert r[1] > r[0]


def test_lm_query_knows_what_training_holds_once(spark, tmp_path):
    from strata.llm.queries import op3_lm_scoring
    trained = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    rng = random.Random(3)
    held = next(i for i in range(100) if not trained(i))
    ids = [i for i in range(100) if trained(i)][:20]
    rows = [(i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40))) for i in ids]
    rows.append((held, rows[7][1]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = [collections.Counter() for _ in range(3)]
    for i, t in rows[:-1]:
        for n in range(3):
            counts[n].update(zip(*[(t.split() + [""])[k:] for k in range(n + 1)]))
    kinds = [collections.Counter(g[:-1] for g in c) for c in counts]
    sums = [collections.Counter() for _ in range(3)]
    for n in (1, 2):
        for g, c in counts[n].items():
            sums[n][g[:-1]] += c
    total = sum(counts[0].values())

    def score(ws):
        out = 0.0
        for i in range(len(ws)):
            p = (counts[0][(ws[i],)] + 1) / (total + len(counts[0]) + 1)
            for n in (1, 2):
                h = tuple(ws[i - n:i])
                if i >= n and sums[n][h]:
                    c, k = counts[n - 1][h], kinds[n][h]
                    p = max(counts[n][(*h, ws[i])] - 0.75, 0) / c + (1 - (sums[n][h] - 0.75 * k) / c) * p
            out += math.log10(p)
        return out

    got = {r.doc_id: r.score for r in op3_lm_scoring(spark, str(tmp_path)).collect()}
    for i, t in rows:
        assert abs(got[i] - score(t.split() + [""])) < 3e-4 * 41


def test_lm_tokens_of_a_column():
    import pyarrow as pa
    import xxhash
    from strata.llm.lm import END, Reader
    texts = ["cut off", None, "", " a  B ", "\t\n\x0b\x0c\r ", "É\x1cx a\xa0z", "a"]
    hashes, stream, lengths = Reader().batch(pa.array(texts).slice(1))
    want = [[*(t or "").encode().lower().split(), b""] for t in texts[1:]]
    code = lambda w: (xxhash.xxh64_intdigest(w) if w else END) - (1 << 63)
    assert lengths.tolist() == [len(ws) for ws in want]
    assert hashes[stream].tolist() == [code(w) for ws in want for w in ws]


def test_lm_with_contexts_too_large_for_one_column(small, monkeypatch):
    from strata.llm import lm
    rows = lambda: sorted(tuple(r) for r in lm.scored(small.limit(20)).collect())
    packed = rows()
    monkeypatch.setattr(lm, "MOST_KEY", 1)
    assert rows() == packed


def test_lm_lets_go_of_a_file_before_the_next(small, monkeypatch):
    import mmap
    from strata.llm import lm
    built = lm.train(small, shard_rows=50)
    opened, dropped = [], []

    class Map(mmap.mmap):
        def __init__(self, *args, **named):
            opened.append(self)

        def madvise(self, option, *args):
            dropped.append(option)
            return super().madvise(option, *args)

    monkeypatch.setattr(mmap, "mmap", Map)
    model = lm.Model(*built)
    number = np.arange(built[3])
    counts = model.counts(0, number)
    assert counts.sum() == built[2] and (model.counts(0, number) == counts).all()
    assert len(opened) > 1 and dropped == [mmap.MADV_DONTNEED] * 2 * len(opened)


def test_written_tables_leave_no_shuffle_files(spark):
    import glob
    import tempfile
    import time
    from strata.llm.common import written
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    root, before = spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir()), spark.conf.get(key)
    files = lambda: set(glob.glob(f"{root}/**/shuffle_*.data", recursive=True))
    old = files()
    assert written(spark.range(1000).repartition(3, "id"), "test").count() == 1000
    for _ in range(50):
        if not files() - old:
            break
        time.sleep(0.1)
    # The count's own shuffle of one row a part may still be there.
    assert sum(os.path.getsize(f) for f in files() - old if os.path.exists(f)) < 2000
    assert spark.conf.get(key) == before


def test_lm_empty(none):
    from strata.llm.lm import scored
    assert scored(none).collect() == []


def test_lm_probabilities_sum_to_one():
    rows = [(i, "a b c a b d a b c e") for i in range(20)]
    _, p, counts = lm_reference(rows)
    vocabulary = [w for (w,) in counts[0]] + [b"never"]
    for h in ([b"a", b"b"], [b"b", b"c"], [b"never", b"a"]):
        assert math.isclose(sum(p([*h, w], 2) for w in vocabulary), 1, rel_tol=1e-9)


def test_elias_fano():
    from strata.llm.lm import EliasFano
    rng = np.random.default_rng(1)
    for values in ([0], [5], [0, 0, 1, 7, 7, 1 << 40], np.sort(rng.integers(0, 1 << 20, 5000)),
                   np.sort(rng.integers(0, 300, 5000))):
        values = np.array(values)
        bits, *parts = EliasFano.arrays(values)
        ef = EliasFano(len(values), bits, *parts)
        assert ef.get(np.arange(len(values))).tolist() == values.tolist()
        distinct = np.unique(values)
        bits, *parts = EliasFano.arrays(distinct)
        ef = EliasFano(len(distinct), bits, *parts)
        ask = np.concatenate([distinct, distinct + 1, [1 << 50]])
        at = {v: i for i, v in enumerate(distinct.tolist())}
        assert ef.find(ask).tolist() == [at.get(x, -1) for x in ask.tolist()]


# --- 4: decontamination ---------------------------------------------------------------

def test_templates_catch_new_numbers_and_names_and_refuse_mixed_up_ones(spark):
    from strata.llm.decontaminate import leaks, without_leaks
    item = "A train with Anna leaves at 12 km from town and Anna rides 30 minutes to meet Bert who waits with 7 apples."
    same = "Intro words first. A train with Carla leaves at 99 miles from town and Carla rides 5 hours to meet Dora who waits with 8 apples. More."
    mixed = "A train with Carla leaves at 99 miles from town and Dora rides 5 hours to meet Carla who waits with 8 apples."
    docs = [(1, item), (2, same), (3, mixed), (4, "nothing of it at all " * 30),
            (5, None), (6, ""), (2, same), (None, same)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", __import__("pyspark").sql.functions.lit("x"))
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, item)], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id) for r in leaks(d, items).collect())
    assert got == [(0, 1), (0, 4), (1, 1), (1, 4), (2, 1), (2, 1), (2, 4), (2, 4)]
    assert sorted(r.doc_id for r in without_leaks(d, items).collect()) == [3, 4, 5, 6]
    none = items.where("false")
    assert leaks(d, none).collect() == [] and without_leaks(d, none).count() == len(docs)
    assert leaks(d.where("false"), items).collect() == []


def test_slots():
    from strata.llm.decontaminate import filling
    words = ["<name>", "<num>", "<name>", "<num>", "<name>"]
    pairs = lambda *ys: [(i, x, y) for i, (x, y) in enumerate(zip(["anna", "3", "anna", "4", "bert"], ys))]
    assert filling(words, pairs("carla", "7", "carla", "7", "dora")) == {"anna": "carla", "3": "7", "4": "7", "bert": "dora"}
    assert filling(words, pairs("carla", "7", "dora", "7", "carla")) == {"anna": "carla", "3": "7", "4": "7"}   # two names stay two
    assert filling(words, pairs("dora", "1", "carla", "2", "dora"))["anna"] == "dora"                           # the first of equals


def windows_kept(item, doc):
    """Windows of the item that count, and all, over every pair of equal windows."""
    from strata.llm.decontaminate import WINDOW, covered, template
    a, b = template(item), template(doc)
    hits = [(i, d) for i in range(len(a[0]) - WINDOW + 1) for d in range(len(b[0]) - WINDOW + 1)]
    return len(covered(a, b, hits)), len(a[0]) - WINDOW + 1


def test_mixed_up_fillings_cost_their_windows():
    item = "A train with Anna leaves at 12 km from town and Anna rides 30 minutes to meet Bert who waits with 7 apples."
    mixed = "A train with Carla leaves at 99 miles from town and Dora rides 5 hours to meet Carla who waits with 8 apples."
    assert windows_kept(item, item) == (19, 19)
    got, n = windows_kept(item, mixed)            # not one word else is changed
    assert got < 0.75 * n
    every = "There Anna has 3 kg and Bert has 4 kg so Anna gives 3 kg to Bert while Bert gives 4 kg to Anna and Anna has 3 kg."
    other = "There Carl has 5 kg and Dora has 6 kg so Emil gives 7 kg to Fred while Gina gives 8 kg to Hans and Ines has 9 kg."
    got, n = windows_kept(every, other)
    assert got <= 0.5 * n
    renamed = every.replace("Anna", "Dora").replace("Bert", "Emil").replace(" 3 ", " 8 ").replace(" 4 ", " 9 ")
    assert windows_kept(every, renamed) == (n, n)
    # inside a longer text, and twice in it with different fillings
    assert windows_kept(every, f"Before it. {renamed} Between. {every} After.") == (n, n)


def test_templates_part_words_at_all_white_space():
    from strata.llm.decontaminate import template
    text = "The train leaves Paris with 12 boxes of 3 kg each"
    for gap in ["\t", "\x0b", "\x0c", "\r", " \t "]:
        assert template(text.replace(" ", gap)) == template(text)


def test_leaks_equal_brute_force(spark):
    from strata.llm.queries import op4_decontamination
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: lower(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: lower(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    grams = lambda w: {tuple(w[k:k + 8]) for k in range(len(w) - 7)}
    want = {(d, i) for d, w in docs.items() for i, x in items.items() if len(x) >= 8
            and len(grams(w) & grams(x)) >= 0.75 * len(grams(x))}
    got = {(r.doc_id, r.item_id) for r in op4_decontamination(spark, sf).collect()}
    assert want <= got and {d for d, _ in got} == {d for d, _ in want}


# --- 5: URLs ----------------------------------------------------------------------------

def glob_regex(g):
    return re.compile("".join(".*" if c == "*" else re.escape(c) for c in g) + ("" if g.endswith("*") else r"\Z"), re.S)


def test_automaton_equals_regular_expressions():
    from strata.llm.urls import Automaton
    rng = random.Random(5)
    globs = ["".join(rng.choice("ab*") for _ in range(rng.randrange(1, 9))) + "a" for _ in range(60)] + ["*ab*", "a*", "b"]
    machine = Automaton(globs)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(30))) for _ in range(500)] + [""]
    tests = [glob_regex(g) for g in globs]
    for t, row in zip(texts, machine.match(texts)):
        # a rule without a last * must fit the whole text
        assert [bool(x.match(t)) for x in tests] == row.tolist() or not any(
            x != y and (g.endswith("*") or t.endswith(g.split("*")[-1])) for x, y, g in
            zip([bool(x.match(t)) for x in tests], row.tolist(), globs))


def test_url_rules(spark):
    from strata.llm.urls import filter_urls
    urls = [None, "", "nothing", "http://x.NET/p", "http://x.net", "https://www.example.net/en/1?q#f",
            "https://example.com/de/", "http://notexample.com/de/1", "ftp://a.org/fr/x.net/", "http://a.com/x.net/",
            "http://a.com?u=://b.net/", "http://m.cheap-pills.example.com/en/"]
    got = {r.url: tuple(r)[1:5] for r in filter_urls(
        spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")).withColumn(
        "url", __import__("pyspark").sql.functions.element_at(__import__("pyspark").sql.functions.array(
            *[__import__("pyspark").sql.functions.lit(u) for u in urls]), (__import__("pyspark").sql.functions.col("page_id") + 1).cast("int"))).collect()}
    assert got["http://x.NET/p"] == ("x.net", "/p", "net/", "block")
    assert got["http://x.net"] == ("x.net", "", None, "allow")
    assert got["https://www.example.net/en/1?q#f"] == ("www.example.net", "/en/1", "example.net/en/", "allow")
    assert got["https://example.com/de/"] == ("example.com", "/de/", "example.com/de/", "block")
    assert got["http://notexample.com/de/1"][2:] == (None, "allow")
    assert got["ftp://a.org/fr/x.net/"][2:] == ("org/fr/", "allow")
    assert got["http://a.com/x.net/"][2:] == (None, "allow")
    assert got["http://a.com?u=://b.net/"] == ("a.com", "", None, "allow")
    assert got["http://m.cheap-pills.example.com/en/"][2:] == (None, "block")
    assert got[None] == got[""] == got["nothing"] == ("", "", None, "allow")


# --- 6: near-duplicates --------------------------------------------------------------------

def near_reference(rows):
    sets = []
    for i, t in rows:
        w = lower(t)
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                root[find(x)] = find(y)
    low = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            low[find(x)] = min(low.get(find(x), i), i)
    return sorted(((i is None, i or 0, len(s), low.get(find(x)) if s else i) for x, ((i, _), s) in
                   enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("which", ["small", "hard"])
def test_components_equal_brute_force(request, which):
    from strata.llm.minhash import near_dedup, near_duplicates
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_duplicates(docs).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got), key=str) == near_reference(rows)
    left = near_dedup(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} >= {r.doc_id for r in got if r.kept and r.doc_id is not None}


def test_a_group_of_near_copies_is_one_component(spark):
    from strata.llm.minhash import near_dedup, near_duplicates
    rng = random.Random(8)
    base = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(7)):
            w[rng.randrange(200)] = f"z{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert sorted(((False, r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == near_reference(rows)
    assert near_dedup(docs).count() == len({r.component_id for r in got})


def test_near_duplicates_empty(none):
    from strata.llm.minhash import near_dedup, near_duplicates
    assert near_duplicates(none).collect() == [] and near_dedup(none).collect() == []


def test_posterior_bounds():
    from strata.llm.minhash import least_matches
    limits = dict(least_matches(0.75, 1e-5, 224, 56))
    assert list(limits) == [56, 112, 168, 224] and all(0 < m < 0.75 * n for n, m in limits.items())
    assert limits[224] / 224 > limits[56] / 56


def test_components_of_a_path_and_a_star(spark):
    from strata.llm.graph import components
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 10 for i in range(10, 41)} | {i: 100 for i in range(100, 140)}


# --- 7: quality rules ---------------------------------------------------------------------

def count_reference(t):
    t = t or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    cover = {k + d for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover)


@pytest.mark.parametrize("which", ["small", "hard"])
def test_counts_equal_brute_force(request, which):
    from strata.llm.quality import keep_good, quality_report
    docs = request.getfixturevalue(which)
    want = sorted(((r.doc_id is None, r.doc_id or 0, *count_reference(r.text)) for r in docs.collect()))
    got = quality_report(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words) for r in got) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
    assert not any(r.kept and r.base_failed for r in got)
    kept = keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_quality_verdicts_follow_the_labels(spark):
    from strata.llm.quality import quality_report
    sf = "/root/testdata/sf0.01"
    got = quality_report(spark.read.parquet(f"{sf}/documents.parquet")).drop("quality")
    both = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in both) >= 0.98 * len(both)


def test_quality_empty(none):
    from strata.llm.quality import keep_good, quality_report
    assert quality_report(none).collect() == [] and keep_good(none).collect() == []


# --- 8: passages -------------------------------------------------------------------------

def make_passages():
    rng = random.Random(11)
    word = lambda: "q%d" % rng.randrange(10 ** 7)
    text = lambda n: [word() for _ in range(n)]
    shared, docs = text(90), []
    for i in range(12):
        p = list(shared)
        if i % 3 == 1:
            p[20], p[55] = word(), word()
        if i % 3 == 2:
            del p[40]
        docs.append((i, " ".join(text(rng.randrange(20, 80)) + (p if i < 8 else shared[:30]) + text(60))))
    return docs


def test_fuzzy_passages(spark):
    from strata.llm.passages import repeated_passages, without_repeats
    docs = make_passages()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_chars", __import__("pyspark").sql.functions.length("text"))
    got = repeated_passages(d).collect()
    assert {r.doc_id for r in got} == set(range(1, 8))  # the first stays; 30 shared words are no passage
    assert all(85 <= r.end_word - r.start_word <= 92 and r.first_id == 0 for r in got)
    cut = {r.doc_id: r for r in without_repeats(d).collect()}
    assert cut[0].text == docs[0][1] and cut[9].text == docs[9][1]
    for r in got:
        w = docs[r.doc_id][1].split()
        assert cut[r.doc_id].text.split() == w[:r.start_word] + w[r.end_word:]
        assert cut[r.doc_id].n_chars == len(cut[r.doc_id].text)


def test_passages_defined_cases(hard, none):
    from strata.llm.passages import repeated_passages, without_repeats
    assert {r.doc_id for r in repeated_passages(hard).collect()} == {7, 10}
    left = without_repeats(hard)
    assert left.columns == hard.columns and left.count() == len(HARD)
    assert repeated_passages(none).collect() == [] and without_repeats(none).collect() == []


def test_chain_is_best():
    from strata.llm.passages import GAIN, GAP_COST, chains
    rng = random.Random(2)
    for _ in range(100):
        m = sorted({(rng.randrange(20), rng.randrange(20)) for _ in range(8)})
        best = {}
        for x, y in m:
            best[x, y] = GAIN + max([0.0] + [v - GAP_COST * (x - p + y - q) for (p, q), v in best.items() if p < x and q < y])
        top = chains(m)[0]
        got = sum(GAIN for _ in top) - sum(GAP_COST * (c - a + d - b) for (a, b), (c, d) in zip(top, top[1:]))
        assert math.isclose(got, max(best.values()))


def test_an_exact_passage_among_shared_short_lines_is_found(spark):
    from strata.llm.passages import repeated_passages
    rng = random.Random(5)
    text = lambda n: ["q%d" % rng.randrange(10 ** 7) for _ in range(n)]
    exact, form = text(55), [text(12) for _ in range(8)]

    def page():
        sides = [sum((f + text(10) for f in form[:4]), []), sum((text(10) + f for f in form[4:]), [])]
        return len(sides[0]), " ".join(sides[0] + exact + sides[1])

    (_, a), (at, b) = page(), page()
    got = repeated_passages(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()
    assert len(got) == 1 and got[0].doc_id == 2 and got[0].start_word <= at and got[0].end_word >= at + 55


def test_parts_are_longest():
    from strata.llm.passages import parts
    rng = random.Random(8)
    for _ in range(60):
        pairs, x, y = [], 0, 0
        for _ in range(rng.randrange(40, 160)):
            if rng.random() < 0.25:
                x, y = x + rng.randrange(4), y + rng.randrange(4)
            pairs.append((x, y))
            x, y = x + 1, y + 1
        fits = [pairs[j][0] + 1 - pairs[i][0] for i in range(len(pairs)) for j in range(i, len(pairs))
                if pairs[j][0] + 1 - pairs[i][0] >= 50
                and j + 1 - i >= 0.75 * max(pairs[j][0] + 1 - pairs[i][0], pairs[j][1] + 1 - pairs[i][1])]
        got = parts(np.array(pairs))
        assert max((e - s for s, e, *_ in got), default=0) == max(fits, default=0)


def test_passages_of_frequent_sentences_equal_brute_force(spark):
    from strata.llm.passages import repeated_passages
    rng = random.Random(6)
    sentences = [["q%d" % rng.randrange(10 ** 7) for _ in range(rng.randrange(18, 30))] for _ in range(8)]
    texts = [s + ["own%d.%d" % (i, k) for k in range(40)] for i, s in enumerate(sentences)]  # each alone, first
    for i in range(120):
        texts.append(sum((rng.choice(sentences) for _ in range(rng.randrange(2, 5))), []) + [f"end{i}"] * 3)
    rows = repeated_passages(spark.createDataFrame(
        [(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    seen, missed, wanted = set(), 0, 0
    for i, t in enumerate(texts):
        windows = [tuple(t[k:k + 50]) for k in range(len(t) - 49)]
        spans = [(r.start_word, r.end_word) for r in rows if r.doc_id == i]
        for k in (k for k, w in enumerate(windows) if w in seen):
            wanted += 1
            missed += not all(any(s <= p < e for s, e in spans) for p in range(k, k + 50))
        seen.update(windows)
    assert wanted > 100
    assert missed == 0


def passage_between(a, b):
    """Passages of two word lists, by the operator's steps without the joins."""
    from strata.llm.passages import Seeder, align, group_chains, parts, runs_of
    first, x, y, n = {}, [], [], []
    for s, p, _ in zip(*Seeder().seeds(" ".join(a))):
        first.setdefault(s, p)
    for s, p, k in zip(*Seeder().seeds(" ".join(b))):
        if s in first:
            x, y, n = x + [p], y + [first[s]], n + [k]
    if not x:
        return []
    _, *runs = runs_of(np.zeros(len(x), int), np.array(x), np.array(y), np.array(n))
    return [p for c in group_chains(*(r.tolist() for r in runs)) for p in parts(align(b, a, c))]


@pytest.mark.parametrize("n, every", [(64, 4), (60, 5), (60, 6)])
def test_passages_with_every_nth_word_replaced(n, every):
    rng = random.Random(n + every)
    text = lambda n: ["q%d" % rng.randrange(10 ** 7) for _ in range(n)]
    p = text(n)
    q = [w if (i + 1) % every else text(1)[0] for i, w in enumerate(p)]
    assert passage_between(text(80) + p + text(80), text(80) + q + text(80))


def test_passages_with_replaced_words_at_random():
    rng = random.Random(1)
    text = lambda n: ["q%d" % rng.randrange(10 ** 7) for _ in range(n)]
    for share in (0.75, 0.8, 0.85, 0.9):
        found = 0
        for _ in range(100):
            p = text(60)
            q, at = list(p), rng.sample(range(1, 59), round(60 * (1 - share)))
            for i in at:
                q[i] = text(1)[0]
            found += bool(passage_between(text(80) + p + text(80), text(80) + q + text(80)))
        assert found >= 95


def test_word_hashes_of_many_texts_are_those_of_one(spark):
    from strata.llm.minhash import Shingler
    from strata.llm.passages import Seeder, spans
    rng = random.Random(3)
    texts = [None, "", *("".join(rng.choice("abÄé🙂 \t\n\x0b\x0c\r  xyzQ") * rng.choice((1, 1, 40)) for _ in range(rng.randrange(900)))
                         for _ in range(100))]
    got, one = Seeder().texts(texts), Shingler(3)
    for j, t in enumerate(texts):
        w = one.words(t)
        want = one.word_hashes(w) if len(w) >= 50 else []
        assert got.hashes[got.row == j].tolist() == list(want)
        assert [(m.start(), m.end()) for m in W.finditer(t or "")] == list(zip(*spans(t or "")))


def test_seeds_and_matches_take_little_disk(spark, monkeypatch):
    from strata.llm import passages
    rng = random.Random(9)
    docs = [(i, ["q%d" % rng.randrange(10 ** 7) for _ in range(600)]) for i in range(300)]
    docs = [(i, " ".join(w)) for i, w in docs] + [(i + 300, " ".join("own" if k % 60 == 9 else v for k, v in enumerate(w))) for i, w in docs]
    made, write = {}, passages.written

    def noted(df, tag):
        out = write(df, tag)
        made[tag] = made.get(tag, 0) + sum(os.path.getsize(f.removeprefix("file:").replace("//", "/")) for f in out.inputFiles())
        return out

    monkeypatch.setattr(passages, "written", noted)
    assert passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).count() > 0
    held = sum(len(t) for _, t in docs)
    assert sum(v for k, v in made.items() if k not in ("corpus", "keys", "texts")) < held


# --- 9: shards -----------------------------------------------------------------------------

@pytest.mark.parametrize("which", ["small", "hard"])
def test_shards(request, which):
    from strata.llm.sharding import shards
    docs = request.getfixturevalue(which)
    got = shards(docs, 7).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    size = lambda t: len((t or "").encode()) + 16
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (i if i else i or -1 if i is None else i, size(t), zlib.crc32((t or "").encode())) for i, t in rows) or \
        sorted(map(str, ((r.doc_id, r.size, r.text_crc32) for r in got))) == sorted(
            map(str, ((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)))
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by.values())
    target, most = sum(r.size for r in got) / 7, max(r.size for r in got)
    assert all(abs(sum(r.size for r in rs) - target) <= most for rs in by.values())
    ids = [[r.doc_id for r in rs if r.doc_id is not None] for _, rs in sorted(by.items())]
    ids = [x for x in ids if x]
    assert all(max(a) <= min(b) for a, b in zip(ids, ids[1:]))


def test_shards_empty(none):
    from strata.llm.sharding import shards
    assert shards(none).collect() == []


# --- 10: token files -----------------------------------------------------------------------

def test_simple8b_round_trip():
    from strata.llm.tokens import pack, unpack
    rng = np.random.default_rng(9)
    for ids in (np.zeros(0), np.zeros(1000), np.ones(77), rng.integers(0, 50_000, 9001), rng.integers(0, 4, 5000),
                [0] * 500 + [2 ** 60 - 1, 2 ** 60, 2 ** 64 - 1, 15 << 60] + rng.integers(0, 9, 99).tolist()):
        ids = np.array([int(x) for x in ids], np.uint64)
        for block in (64, 4096):
            w, o = pack(ids, block)
            assert (unpack(w, o, len(ids), block) == ids).all()
            assert len(w) <= max(1, 2 * len(ids))
    assert len(pack(np.zeros(4096, np.uint64))[0]) < 40


@pytest.mark.parametrize("which", ["small", "hard"])
def test_token_files_equal_the_library(request, which):
    import public_tokenizers
    from strata.llm.tokens import token_output
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = collections.Counter()
    for i, x in rows:
        ids = t.encode(x, add_special_tokens=False).ids + [1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    got = sorted(token_output(docs, path).collect(), key=lambda r: r.start)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids)


def test_words_are_encoded_like_texts():
    import public_tokenizers
    from strata.llm.tokens import WordEncoder
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    t, e = Tokenizer.from_file(path), WordEncoder(path, limit=500)
    rng = random.Random(4)
    letters = list("aabthe ABÉßİſ .,'s!#0́ \x1c\x85<|endoftext|>日ΣςΣ\n\t  ")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(3000)] + ["a <|endoftext|> b"]
    for i in range(0, len(texts), 100):
        for x, got in zip(texts[i:i + 100], e.encode(texts[i:i + 100])):
            assert got.tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_columns_are_encoded_by_bytes_of_text(monkeypatch):
    import pyarrow as pa
    import public_tokenizers
    from strata.llm import tokens
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [None, "", "The THE, the.", " \n\t x", "É é! a\x0bb", "long " * 60, None, "tail"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(tokens, "SLICE", 20)
    parts = list(tokens.slices(batch, 1))
    assert len(parts) > 2 and [i for b in parts for i in b.column(0).to_pylist()] == list(range(8))
    e, t = tokens.WordEncoder(path, limit=8), Tokenizer.from_file(path)
    got = [ids.tolist() for b in parts for ids in e.encode(b.column(1))]
    assert got == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert list(tokens.slices(batch.slice(0, 0), 1)) == []


def test_token_files_empty(none):
    import public_tokenizers
    from strata.llm.tokens import token_output
    assert token_output(none, public_tokenizers.path("word_bpe_49k.json")).collect() == []


# --- the pipeline ---------------------------------------------------------------------------

def test_pipeline(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "sentencepiece":
            assert out.columns == docs.columns
            from strata.llm.common import scratch
            path = scratch(spark, "test", keep=True)
            out.write.parquet(path)
            docs = spark.read.parquet(path)
    left = {r.doc_id for r in docs.collect()}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in rows} == left and all(r.round_trip for r in rows)


def test_registered():
    import __spark_entry__ as e
    assert {f"op{n}_" for n in range(1, 11)} <= {re.match(r"op\d+_", k)[0] for k in e.queries() if k.startswith("op")}
    assert "pipeline" in e.queries() and set(e.oracle_sql()) <= set(e.queries())
