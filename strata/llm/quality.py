"""Quality rules by weak supervision (DataFrame functions only).

Every rule looks at a few counts of a text and votes good (1), bad (-1) or
abstains (0). Votes are reduced to counts of vote patterns (at most 3 ** 9
rows, whatever the input), and expectation-maximisation over those counts
estimates how often each rule votes what on good and on bad documents. The
posterior probability of "good" then decides, so that no single rule has to
be passed.

Defined cases: a null text counts as empty (no words; every count 0). Ties
and repeated rows get equal verdicts, as a verdict depends on the text alone.
An empty table gives an empty result. All input columns pass through;
an input column that bears an output's name is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import GAP, written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Counts that only the votes need.
INNER = ["_lines", "_distinct", "_short", "_upper", "_shouts"]


#: Up to so many repeated windows of a text are looked up one by one.
FEW = 16


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add COUNTS and INNER, row by row, without a shuffle.

    Words of repeated 3-word windows: equal neighbours among the sorted window
    hashes give the repeated ones, and the gaps between these windows'
    positions say how many words they cover together. Few repeated hashes are
    looked up one by one; for many, the positions are sorted along.
    """
    t = "_t"
    d = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    d = d.withColumn("_w", F.expr(f"filter(split(_t, r'{GAP}'), w -> w != '')"))
    d = d.withColumn("_l", F.expr(r"filter(split(_t, r'\n'), l -> rlike(l, r'[^\x20\x09-\x0D]'))"))
    d = d.withColumn("_k", F.expr("transform(_w, w -> xxhash64(w))"))
    d = d.withColumn("_h", F.expr(
        "if(size(_k) < 3, cast(array() as array<bigint>),"
        " transform(sequence(0, size(_k) - 3), i -> xxhash64(_k[i], _k[i + 1], _k[i + 2])))"))
    d = d.withColumn("_o", F.expr("sort_array(_h)"))
    d = d.withColumn("_r", F.expr(
        "array_distinct(filter(_o, (h, k) -> k > 0 and _o[greatest(k - 1, 0)] = h))"))
    d = d.withColumn("_s", F.expr(
        f"if(size(_r) <= {FEW}, null, sort_array(transform(_h, (h, i) -> struct(h, i))))"))
    d = d.withColumn("_p", F.expr(
        "case when size(_r) = 0 then null when _s is null then"
        " filter(sequence(0, size(_h) - 1), i -> array_contains(_r, _h[i])) else"
        " sort_array(transform(filter(sequence(0, size(_s) - 1), k ->"
        " (k > 0 and _s[greatest(k - 1, 0)].h = _s[k].h)"
        " or (k < size(_s) - 1 and _s[least(k + 1, size(_s) - 1)].h = _s[k].h)), k -> _s[k].i)) end"))
    return d.withColumns({
        "n_words": F.expr("cast(size(_w) as bigint)"),
        "word_chars": F.expr("aggregate(_w, 0L, (a, w) -> a + length(w))"),
        "n_symbols": F.expr("cast(regexp_count(_t, r'[#*$%&|<>]') as bigint)"),
        "n_dup_lines": F.expr("cast(size(_l) - size(array_distinct(_l)) as bigint)"),
        "n_repeat_words": F.expr(
            "if(_p is null, 0L, 3L + aggregate(sequence(0, size(_p) - 1), 0L,"
            " (a, k) -> a + if(k = 0, 0, least(3, _p[k] - _p[greatest(k - 1, 0)]))))"),
        "_lines": F.expr("size(_l)"),
        "_distinct": F.expr("size(array_distinct(_k))"),
        "_short": F.expr("aggregate(_w, 0, (a, w) -> a + if(length(w) <= 3, 1, 0))"),
        "_upper": F.expr(r"regexp_count(_t, r'\p{Lu}')"),
        "_shouts": F.expr("regexp_count(_t, '!')"),
    }).drop("_t", "_w", "_l", "_k", "_h", "_o", "_r", "_s", "_p")


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds."""
    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.expr(f"case when {self.bad} then -1 when {self.good} then 1 else 0 end")


RULES = (
    Rule("length", "n_words < 50", "n_words >= 100"),
    Rule("symbols", "n_symbols * 10 > n_words", "n_symbols * 100 <= n_words"),
    Rule("lines", "n_dup_lines * 5 > _lines * 2", "n_dup_lines * 5 <= _lines"),
    Rule("repeats", "n_repeat_words * 10 > n_words * 3", "n_repeat_words * 10 <= n_words"),
    Rule("capitals", "_upper * 10 > word_chars * 3", "_upper * 10 <= word_chars"),
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words",
         "word_chars <= 8 * n_words"),
    Rule("vocabulary", "n_words >= 50 and _distinct * 4 < n_words",
         "n_words >= 50 and _distinct * 5 > n_words * 2"),
    Rule("shouting", "_shouts * 5 > n_words", "_shouts * 20 <= n_words"),
    Rule("function_words", "n_words >= 50 and _short * 12 < n_words",
         "n_words >= 50 and _short * 6 >= n_words"),
)


def em(patterns: list[tuple[tuple[int, ...], int]], m: int, rounds: int = 100,
       strength: float = 20.0, most: float = 0.01) -> list[float]:
    """Posterior probability of "good" for each (votes, count) pair.

    The classes are "good" and, as junk comes in unlike kinds, one kind of
    "bad" for each rule. Estimated are the classes' shares and, for every rule
    and class, the share of bad votes among the votes cast: the rule's
    accuracies. Abstentions count as missing, else documents too short for
    some rules would form a class of their own. Rules are written to be
    precise, so their share of bad votes on good documents stays at ``most``
    or below. The start (a bad vote makes a document suspect of that kind) and
    a prior of ``strength`` votes tie the classes to their meaning.
    """
    q = []
    for vs, _ in patterns:
        against = [j for j in range(m) if vs[j] < 0]
        good = 0.1 if against else 0.97
        q.append([good] + [(1 - good) * ((j in against) / len(against) if against else 1 / m)
                           for j in range(m)])
    last = None
    for _ in range(rounds):
        share, odds = [], []
        for y in range(m + 1):
            w = [n * p[y] for (_, n), p in zip(patterns, q)]
            seed = [most if y == 0 else 0.9 if y == j + 1 else 0.2 for j in range(m)]
            bad = [(strength * seed[j] + sum(x for (vs, _), x in zip(patterns, w) if vs[j] < 0))
                   / (strength + sum(x for (vs, _), x in zip(patterns, w) if vs[j]))
                   for j in range(m)]
            if y == 0:
                bad = [min(x, most) for x in bad]
            share.append(math.log(sum(w) + (strength if y == 0 else strength / m / 4)))
            odds.append([(math.log(x), math.log(1 - x)) for x in bad])
        q = []
        for vs, _ in patterns:
            z = [s + sum(o[v > 0] for o, v in zip(os, vs) if v) for s, os in zip(share, odds)]
            e = [math.exp(x - max(z)) for x in z]
            q.append([x / sum(e) for x in e])
        good = [p[0] for p in q]
        if last and max(abs(a - b) for a, b in zip(good, last)) < 1e-9:
            break
        last = good
    return [p[0] for p in q]


def pattern(rules=RULES) -> Column:
    """The votes as one number: digits 0 (bad), 1 (none), 2 (good) to base 3."""
    code = F.lit(0)
    for r in rules:
        code = code * 3 + r.vote() + 1
    return code


def fit(counted: DataFrame, rules=RULES) -> DataFrame:
    """(_pattern, quality) for every vote pattern of a table with the counts.

    All rows count. A pattern is one of 3 ** 9, so the driver sees at most
    19,683 rows and the returned table is as small.
    """
    rows = counted.groupBy(pattern(rules).alias("_pattern")).count().collect()
    rows = sorted((r[0], r[1]) for r in rows)
    m = len(rules)
    votes = [(tuple(code // 3 ** (m - 1 - j) % 3 - 1 for j in range(m)), n) for code, n in rows]
    good = em(votes, m) if votes else []
    return counted.sparkSession.createDataFrame(
        [(code, round(g, 9)) for (code, _), g in zip(rows, good)], "_pattern int, quality double")


def judged(counted: DataFrame, model: DataFrame) -> DataFrame:
    """Add base_failed, quality (the posterior) and kept."""
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    d = counted.withColumns({"base_failed": failed, "_pattern": pattern()})
    d = d.drop("quality").join(F.broadcast(model), "_pattern").drop("_pattern")
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)).drop(*INNER)


def quality_report(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, the counts, base_failed, quality, kept.

    The counts are written once (no texts) and serve the fit and the verdict.
    """
    counted = written(with_counts(docs.select("doc_id", "text")).drop("text"), "quality")
    return judged(counted, fit(counted))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules accept, with the columns they came with.

    The condition on a row number, which always holds, keeps the optimizer
    from pushing the filter below the counts: that would copy their nested
    expressions into each other.
    """
    model = fit(written(with_counts(docs.select("text")).drop("text"), "counts"))
    marked = judged(with_counts(docs.select(F.struct("*").alias("_row"), "text")), model)
    return marked.withColumn("_good", F.col("kept") & (F.monotonically_increasing_id() >= 0)) \
        .where("_good").select("_row.*")
