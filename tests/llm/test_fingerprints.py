"""Winnowing: against a plain reading of the method, its match guarantee, order and edge cases."""

import hashlib
import random

import regex
import xxhash
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tessera.llm import winnowing as W

M = (1 << 64) - 1


ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
PLAIN = regex.compile(rf"[{ALONE}--\p{{P}}]|[^ \t\n\x0b\f\r\p{{Z}}\p{{P}}{ALONE}]+", regex.V1)


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def words(text):
    return [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in PLAIN.findall((text or "").lower())]


def plain(text, k=W.K, w=W.W):
    t = words(text)
    if len(t) < k:
        h = [signed(xxhash.xxh64(" ".join(str(signed(x)) for x in t).encode(), seed=42).intdigest())] if t else []
    else:
        h = []
        for i in range(len(t) - k + 1):
            v = 0
            for x in t[i:i + k]:
                v = (((v << 1) | (v >> 63)) & M) ^ x
            h.append(signed(v))
    out = []
    for i in range(max(len(h) - w + 1, min(len(h), 1))):
        part = h[i:i + w]
        place = i + max(j for j, x in enumerate(part) if x >> 29 == min(part) >> 29)
        if not out or out[-1][1] != place:
            out.append((h[place], place))
    return out


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = ["", None, " ,. ", "one", "One two three FOUR", "a b c d e", "a a a a a a a a a a a a a a a a a a a a a a", "x y " * 60,
         "漢字かな交じりの文を書いて十分に長くする必要があります", "mixed 漢字 and words, é😀 ok", "word word word " * 9, "z" * 5000]


def test_fingerprints_equal_the_plain_reading(spark):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for k, w in ((W.K, W.W), (1, 1), (2, 3), (3, 5), (4, 4), (6, 7), (7, 2)):
        got = {r["i"]: [tuple(x) for x in r["f"]] for r in df.select("i", W.fingerprint(F.col("text"), k, w).alias("f")).collect()}
        assert got == {i: plain(t, k, w) for i, t in enumerate(texts)}


def test_shared_runs_are_found_wherever_they_stand(spark):
    rng = random.Random(5)
    new = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    rows = []
    for i in range(60):
        run = new(W.guarantee())
        rows.append((i, f"{new(rng.randrange(30))} {run} {new(rng.randrange(30))}", f"{new(rng.randrange(30))} {run.upper()}, {new(rng.randrange(30))}"))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    near = df.select(W.likeness(W.fingerprint(F.col("a")), W.fingerprint(F.col("b"))).alias("x")).collect()
    assert all(r["x"] > 0 for r in near)
    other = df.select(W.likeness(W.fingerprint(F.col("a")), W.fingerprint(F.lit(new(80)))).alias("x")).collect()
    assert all(r["x"] == 0 for r in other)


def brute(rows):
    """Results by doc_id for rows without repeated ids."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        own = plain(text)
        out[i] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), " ".join(f"{h & M:X}@{p:X}" for h, p in own),
                  " ".join(f"{h & M:X}@{p:X}" for h, p in plain(changed)), alike(own, plain(changed)), alike(own, plain(after)))
    return out


def test_query_equals_brute_force(spark):
    from tessera.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: tuple(r)[1:7] for r in QUERIES["op13_winnowing"](spark, SF001).collect()}
    assert got == brute(rows)
    alike_all = QUERIES["op13_winnowing"](spark, SF01).agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert alike_all[0] > 0.25 and alike_all[1] < 0.05


def test_edges(spark):
    schema = "doc_id long, text string, key string, next string, range int, copies string, own string"
    more = ("k", "n", 1, "c", "o")
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id " * 20)]
    df = spark.createDataFrame([r + more for r in rows], schema)
    got = {r["doc_id"]: tuple(r)[1:7] for r in W.compared(df).collect()}
    assert got == brute(rows)
    # Repeated rows are one document; texts of one id are told apart.
    twice = spark.createDataFrame([(1, "a b c d e f g") + more] * 3 + [(1, None) + more, (1, "") + more, (None, None) + more], schema)
    out = sorted((r["doc_id"] or 0, r["n_chars"], r["copies"]) for r in W.compared(twice).collect())
    assert out == [(0, 0, 1), (1, 0, 2), (1, 13, 3)]
    alone = W.compared(df.where("doc_id = 4")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0 and alone[0]["fingerprint"]
    assert W.compared(df.limit(0)).collect() == []
    long = spark.createDataFrame([(1, "long text " * 200_000), (2, "x" * 1_000_000)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_chars"] for r in W.compared(long).collect()} == {1: 2_000_000, 2: 1_000_000}
