"""Phrase mining: against plain counting, with hot prefixes split over buckets, and edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import phrase_sort as P


def plain(rows, least):
    """{(lang, phrase): n} of all phrases of 1 to 5 words."""
    out = Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            out.update((lang or "und", " ".join(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    return {k: n for k, n in out.items() if n >= least}


def texts(n, seed, words=12):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(words)] + ["É", "ABC", "x　y", " ", "\x1c", "a\x85b"]
    line = lambda: " ".join(rng.choices(pool, [1 / (i + 1) for i in range(len(pool))], k=rng.randrange(12))) + rng.choice([".", ",", "\n", "\r\n", "\x0b", " \t", "?"])
    return [(rng.choice(["en", "de", None]), "".join(line() for _ in range(rng.randrange(6)))) for _ in range(n)]


@pytest.mark.parametrize("hot", [P.HOT, 30])
def test_frequencies_equal_plain_counting(spark, hot, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 4000)
    rows = texts(400, 1) + [("en", "the very common line of all\n" * 40)] * 30 + [("en", None), ("en", ""), (None, None)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    counts, totals = P.frequencies(df, least=20, hot=hot, per_bucket=300)
    got = {(r["lang"], r["phrase"]): r["n"] for r in counts.collect()}
    assert got == plain(rows, 20)
    words = Counter({k: 0 for k in ("en", "de", "und")})
    for (lang, phrase), n in plain(rows, 1).items():
        words[lang] += n * (" " not in phrase)
    assert {r["lang"]: r["n"] for r in totals.collect()} == dict(words)


def test_quicksort_counts_and_abandons():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 6, (5000, 5)).astype(np.int32)
    for j in range(1, 5):
        rows[rows[:, j - 1] == 0, j] = 0
    rows = rows[rows[:, 1] > 0]
    weight = rng.integers(1, 4, len(rows))
    want = Counter()
    for r, n in zip(rows.tolist(), weight.tolist()):
        for k in range(2, 6):
            if r[k - 1]:
                want[tuple(r[:k])] += n
    got = {tuple(rows[p, :k].tolist()): int(n) for at, total, k in P.quicksorted(rows, weight, np.full(len(rows), 2), 40, rng) for p, n in zip(at, total)}
    assert got == {k: n for k, n in want.items() if n >= 40}
    every = {tuple(rows[p, :k].tolist()): int(n) for at, total, k in P.quicksorted(rows, weight, np.full(len(rows), 5), 40, rng) for p, n in zip(at, total)}
    assert all(every[k] == n for k, n in want.items() if len(k) < 5 or n >= 40)


def test_scores_and_parts(spark):
    counts = spark.createDataFrame([("x", "a", 1, 10**14), ("x", "b", 1, 10**14), ("x", "a b", 2, 9 * 10**13), ("x", "c", 1, 500),
                                    ("x", "b c", 2, 400), ("x", "a b c", 3, 400)], "lang string, phrase string, size int, n long")
    totals = spark.createDataFrame([("x", 10**17)], "lang string, n long")
    found = P.scored(counts, totals)
    got = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in found.collect()}
    assert got["a b"] == (10**14, 10**14, 1000 * 9 * 10**13 * 10**17 // 10**28)
    assert got["a b c"] == (9 * 10**13, 500, 1000 * 400 * 10**17 // (9 * 10**13 * 500))  # its first cut scores higher
    assert {r["phrase"] for r in P.maximal(found).collect()} == {"a b", "a b c"}


def test_edges(spark):
    empty = spark.createDataFrame([], "lang string, text string, n long, phrase string, size int")
    assert P.collocations(empty).collect() == []
    rows = [("en", "one two " * 300_000, 1, "p", 2), ("en", "x" * 500_000, 1, "p", 2), (None, None, 1, "p", 2)]
    got = P.collocations(spark.createDataFrame(rows, empty.schema), first=3).collect()
    assert [r["rank"] for r in got] == [1, 2, 3] and got[0]["n"] == 600_001
    assert all(r["a"] in (300_000, 299_999, 299_998) for r in got)
