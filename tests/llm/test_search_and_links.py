"""Nearest neighbours and near-duplicates against brute force; components; pipeline."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tessera.llm import adaptive_scan, chosen_path
from tessera.llm.common import table
from tessera.llm.components import components


# ---------------------------------------------------------------- nearest neighbours

def nearest_by_hand(rows, is_query, k):
    good = {i: np.array(v) for i, v in rows if v is not None and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in good:
        if is_query(q):
            order = sorted((-float((good[q] * v).sum()), i) for i, v in good.items() if i != q)
            out[q] = [(i, -d) for d, i in order[:k]]
    return out


def test_nearest_edges(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(60)]
    rows += [(100 + i, [1.0, 1.0, 0.0, 0.0]) for i in range(40)]  # a hot vector, with queries in it
    rows += [(200, None), (220, [0.0] * 4), (240, [1.0, None, 0.0, 0.0]), (260, [1.0, float("nan"), 0.0, 0.0]), (280, [float("inf"), 0.0, 0.0, 0.0]), (300, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    every = adaptive_scan.Settings(probed=1.0, confidence=50.0)
    got = {}
    for r in adaptive_scan.nearest(df.union(df.limit(5)), F.col("vec_id") % 20 == 0, s=every).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == nearest_by_hand(rows, lambda i: i % 20 == 0, 20)
    assert adaptive_scan.nearest(df.limit(0), F.lit(True)).collect() == []
    few = adaptive_scan.nearest(df.where("vec_id < 6"), F.col("vec_id") == 0).collect()
    assert len(few) == sum(any(v) for i, v in rows if 0 < i < 6) if any(rows[0][1]) else not few


def test_recall(spark):
    from tessera.llm.queries import QUERIES

    got = {}
    for r in QUERIES["op5_adaptive_scan"](spark, SF01).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    rows = table(spark, SF01, "embeddings").orderBy("vec_id").collect()
    x, ids = np.array([r["embedding"] for r in rows], dtype=float), np.array([r["vec_id"] for r in rows])
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -9
        hits.append(len(got[int(ids[q])] & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
        assert len(got[int(ids[q])]) == 20
    assert np.mean(hits) >= 0.9


# ---------------------------------------------------------------- near-duplicates

def classes_by_hand(rows):
    sets = []
    for _, x in rows:
        w = (x or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                up[root(i)] = root(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            smallest[root(i)] = min(d, smallest.get(root(i), d))
    return sorted(((d, len(s), None if d is None else smallest[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("settings", [chosen_path.Settings(), chosen_path.Settings(small=3, depth=6), chosen_path.Settings(small=2, depth=1)])
def test_classes_against_brute_force(spark, settings):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    shared = " ".join(rng.choice(words, 30))  # a passage that many texts hold
    rows, n = [], 0
    for group in range(30):
        base = list(rng.choice(words, rng.integers(1, 90)))
        for _ in range(int(rng.choice([1, 1, 2, 3, 12]))):
            text = list(base)
            for _ in range(int(rng.integers(0, 4))):
                text[rng.integers(0, len(text))] = str(rng.choice(words))
            rows.append((n, " ".join(text) + (" " + shared if group % 3 == 0 else "")))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "One two"), (n + 4, "one  TWO"), (None, "one two"), (n + 5, "x"), (n + 5, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1))
    got = chosen_path.classes(df, settings).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == classes_by_hand(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)


def test_classes_of_a_large_group(spark):
    """A third of all rows are near copies: one class, no loss."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(2000)]
    base = list(rng.choice(words, 120))
    rows = []
    for i in range(900):
        text = list(base) if i % 3 == 0 else list(rng.choice(words, 60))
        if i % 3 == 0:
            text[rng.integers(0, 120)] = str(rng.choice(words))
        rows.append((i, " ".join(text)))
    got = {r["doc_id"]: r["component_id"] for r in chosen_path.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 if i % 3 == 0 else i for i in range(900)}


def test_copies_short_of_the_threshold_leave_no_pairs(spark, monkeypatch):
    """Near copies of one text that are mostly not similar enough to each other: candidates stay below the
    members of tree nodes, and the classes are those of brute force."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(5000)]
    base, rows = list(rng.choice(words, 150)), []
    for i in range(360):
        text = list(base)
        for at in rng.choice(150, rng.integers(2, 8), replace=False):
            text[at] = str(rng.choice(words))
        rows.append((i, " ".join(text)))
    sizes = {}

    def counted(df, purpose, write=chosen_path.written):
        out = write(df, purpose)
        sizes.setdefault(purpose, []).append(out.count())
        return out

    monkeypatch.setattr(chosen_path, "written", counted)
    got = chosen_path.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == classes_by_hand(rows)
    assert len({r["component_id"] for r in got}) > 50
    assert sum(sizes["near-pairs"]) + sum(sizes["near-rest"]) < 20 * len(rows)


def test_joining_pairs_span_the_components():
    rng = np.random.default_rng(2)
    s = chosen_path.Settings()
    for _ in range(30):
        base = rng.choice(10_000, 40, replace=False)
        sets = [np.unique(np.concatenate((rng.choice(base, rng.integers(20, 41), replace=False), rng.integers(10_000, 20_000, rng.integers(0, 6))))) for _ in range(25)]
        up = rng.integers(0, 25, 25)
        group = lambda pairs: {tuple(sorted(i for i in range(25) if root[i] == r)) for root in [roots(pairs)] for r in set(root)}

        def roots(pairs):
            own = list(up)
            for i, j in pairs:
                own = [own[i] if x == own[j] else x for x in own]
            return own
        every = [(i, j) for i in range(25) for j in range(i) if 100 * (n := len(np.intersect1d(sets[i], sets[j]))) >= 75 * (len(sets[i]) + len(sets[j]) - n)]
        found = chosen_path.joining_pairs(sets, up, s)
        assert set(found) <= {*every, *((j, i) for i, j in every)} and len(found) < 25
        assert group(found) == group(every)


def test_classes_empty_table(spark):
    assert chosen_path.classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(300, 250), (250, 300), (7, 7), (500, 500)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 250: 250, 300: 250}


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from tessera.llm import bpe_tree, surrogates, template_match
    from tessera.llm.queries import PII_KEY, bpe_vocabulary

    docs = table(spark, SF001, "documents").withColumn("note", F.lit("n")).cache()
    docs = docs.union(docs.limit(3)).union(spark.createDataFrame([(None, None, None, None, None, "n")], docs.schema))
    now, seen = docs, {}
    for name, stage in P.STAGES[:4]:
        rows = stage(spark, now, SF001).collect()
        now = spark.createDataFrame(rows, docs.schema)
        seen[name] = rows
        assert now.columns == docs.columns
    clean = spark.createDataFrame(seen["toxicity"], docs.schema)
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF001, "labels").collect()}
    kept = {r["doc_id"] for r in seen["toxicity"]}
    assert sum(t == 0 and i not in kept for i, t in labels.items()) <= 0.05 * len(labels)
    groups = {(d, c) for d, _, c in classes_by_hand([(r["doc_id"], r["text"]) for r in seen["toxicity"]])}
    near = [r["doc_id"] for r in seen["near_duplicates"]]
    assert sorted(near, key=str) == sorted({d for d, c in groups if d == c}, key=str) and clean.count() >= len(near)
    leaks = {r["doc_id"] for r in template_match.alignments(spark.createDataFrame(seen["near_duplicates"], docs.schema), table(spark, SF001, "benchmark")).collect()}
    assert {r["doc_id"] for r in seen["decontamination"]} == set(near) - leaks
    assert len(seen["personal_data"]) == len(seen["decontamination"])
    texts = {r["doc_id"]: r["text"] for r in surrogates.pseudonymised(spark.createDataFrame(seen["decontamination"], docs.schema), PII_KEY).collect()}
    assert {r["doc_id"]: r["text"] for r in seen["personal_data"]} == texts
    last = P.STAGES[4][1](spark, now, SF001).collect()
    codec = bpe_tree.Codec(*bpe_vocabulary())
    assert {(r["doc_id"], r["ids_sha256"]) for r in last} == {(r["doc_id"], codec.digests(r["text"])[1]) for r in seen["personal_data"]}
