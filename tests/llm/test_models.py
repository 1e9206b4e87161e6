"""Importance resampling, language model, toxicity, page labeller: brute force and held-out accuracy."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tessera.llm import block_lstm, html_blocks, importance, katz, subword_toxic
from tessera.llm.common import table


# ---------------------------------------------------------------- importance resampling

def test_importance_weights_and_threshold(spark):
    s = importance.Settings(buckets=64)
    rows = [(1, "good text here", 0), (2, "good text there", 0), (3, "%%% !! ###", 0), (4, None, 0), (4, None, 0), (None, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = importance.resample(df, [1, 2], 0.5, s).collect()
    counter = importance.Counter(s)
    raw = sum(np.bincount(counter.buckets(t), minlength=64) for _, t, _ in rows)
    good = sum(np.bincount(counter.buckets(t), minlength=64) for i, t, _ in rows if i in (1, 2))
    ratio = importance.log_ratio(good, raw, s)
    for r in got:
        text = dict((i, t) for i, t, _ in rows)[r["doc_id"]]
        assert math.isclose(r["log_weight"], ratio[counter.buckets(text)].sum(), abs_tol=1e-9)
    keys = sorted((r["sample_key"] for r in got), reverse=True)
    assert len(got) == 6 and all(r["kept"] == (r["sample_key"] >= keys[2]) for r in got)
    assert importance.resample(df.limit(0), [], 0.5, s).collect() == []
    assert {r["log_weight"] for r in importance.resample(df, [], 1.0, s).collect()} == {0.0}


@pytest.mark.parametrize("k", [1, 2, 500, 999, 1000, 2000])
def test_kth_largest(spark, k):
    values = [float(x) for x in np.random.default_rng(0).normal(size=990) ** 9] + [7.0] * 10
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = importance.kth_largest(df, "x", k)
    assert got == sorted(values, reverse=True)[min(k, len(values)) - 1]


def test_importance_prefers_good_documents(spark):
    ids, share = importance.target_sample(table(spark, SF01, "labels"))
    got = importance.resample(table(spark, SF01, "documents"), ids, share).join(table(spark, SF01, "labels"), "doc_id")
    rate = {r["quality"]: r["avg(k)"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("avg(k)")).collect()}
    assert rate[1] > 0.95 and rate[0] < 0.3


# ---------------------------------------------------------------- language model

def katz_by_hand(rows, held):
    tokens = [[*(x or "").encode().lower().split(), None] for x in rows]
    c1, c2, ch, after = collections.Counter(), collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for t, out in zip(tokens, held):
        h = 0
        for w in ([] if out else t):
            c1[w] += 1
            c2[h, w] += 1
            ch[h] += 1
            after[h].add(w)
            h = w
    n_of = lambda c: np.array([0] + [sum(v == r for v in c.values()) for r in range(1, 7)])
    d1, d2 = katz.discounts(n_of(c1), 5), katz.discounts(n_of(c2), 5)
    less = lambda c, d: d[c] if c <= 5 else c - (5 - d[5])
    total = sum(c1.values())
    p1 = {w: less(c, d1) / total for w, c in c1.items()}
    rest = 1 - sum(p1.values()) if total else 1.0
    alpha = {h: (1 - sum(less(c2[h, w], d2) for w in ws) / ch[h]) / (1 - sum(p1[w] for w in ws)) for h, ws in after.items()}
    for h, ws in after.items():  # each history's probabilities sum to one
        assert math.isclose(sum(less(c2[h, w], d2) / ch[h] for w in ws) + alpha[h] * (sum(p for w, p in p1.items() if w not in ws) + rest), 1, rel_tol=1e-9)
    out = []
    for t in tokens:
        score, base, h = 0.0, 0.0, 0
        for w in t:
            base += math.log10((c1[w] + 1) / (total + len(c1) + 1))
            score += math.log10(less(c2[h, w], d2) / ch[h] if c2[h, w] else alpha.get(h, 1) * p1.get(w, rest))
            h = w
        out.append((len(t), sum(c1[w] > 0 for w in t), total, base, score))
    return out


@pytest.mark.parametrize("case", ["mixed", "hot", "no training"])
def test_katz_against_brute_force(spark, case):
    rng = np.random.default_rng(2)
    words = np.array([f"w{i}" for i in range(60)])
    texts = [" ".join(words[np.minimum(rng.zipf(1.3, rng.integers(0, 40)) - 1, 59)]) for _ in range(80)] + [None, "", "The THE the", "same text"] + ["same text"] * 5
    if case == "hot":
        texts = ["a a a a a b" for _ in range(60)] + texts[:30]
    ids = [None if i == 3 else i for i in range(len(texts))]
    held = [case == "no training" or i % 5 == 2 for i in range(len(texts))]
    schema = "doc_id long, text string, out boolean, score string"
    df = spark.createDataFrame([(i, t, h, "x") for i, t, h in zip(ids, texts, held)], schema).repartition(3)
    small = katz.Settings(batch_tokens=200, bucket_tokens=50, hot_sample=30)
    got = sorted(katz.scores(df, F.col("out"), 5, small).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    want = dict(zip(ids, katz_by_hand(texts, held)))
    assert [r["doc_id"] for r in got] == sorted(want, key=lambda i: (i is None, i))
    for r in got:
        n, known, total, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert math.isclose(r["base_score"], base, abs_tol=1e-8) and math.isclose(r["score"], score, abs_tol=1e-7)


def test_katz_tables_evaluate_to_the_same_scores(spark, workdir):
    docs = table(spark, SF001, "documents").select("doc_id", "text").limit(120)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    held = F.col("doc_id") % 5 == 2
    small = katz.Settings(batch_tokens=5000, hot_sample=30)
    katz.store(docs, held, 6, workdir, small)
    read = lambda name: spark.read.parquet(f"{workdir}/{name}").collect()
    pairs = {(r["h"], r["w"]): r["discounted"] for r in read("pairs")}
    words = {r["w"]: r["log10_p"] for r in read("words")}
    past = {r["h"]: r for r in read("histories")}
    assert len(pairs) == spark.read.parquet(f"{workdir}/pairs").count() and len(words) == spark.read.parquet(f"{workdir}/words").count()
    scores = {r["doc_id"]: r["score"] for r in katz.scores(docs, held, 6, small).collect()}
    for r in docs.collect():
        total, h = 0.0, katz.START
        for w in [*map(katz.token_digest, r["text"].encode().lower().split()), katz.END]:
            if (h, w) in pairs:
                total += math.log10(pairs[h, w] / past[h]["count"])
            else:
                total += (past[h]["log10_alpha"] if h in past else 0.0) + words.get(w, words[None])
            h = w
        assert math.isclose(total, scores[r["doc_id"]], abs_tol=1e-6)


def test_katz_rows_of_a_bucket_do_not_multiply_with_batches(spark):
    """Uses of unseen pairs: one row for each bucket of histories, however many batches; few documents of a batch: only those."""
    docs, s, buckets = table(spark, SF001, "documents").repartition(4).cache(), katz.Settings(batch_tokens=400, hot_sample=30), 7
    hot = katz.hot_words(docs, s)
    cut = katz.blocks(docs, F.col("doc_id") % 7 == 2, hot, buckets, s).toPandas()
    assert cut["batch"].nunique() > 50
    parts = [cut[cut["bucket"] == b] for b in range(buckets)]
    sums = sum(katz.counts_of_counts(p, hot, s) for p in parts)
    rows = [katz.score_bucket(p, sums, hot, buckets, s) for p in parts]
    assert all(len([r for r in out if r["kind"] == "use"]) <= buckets for out in rows)
    many = 1500
    few = dict(list(katz.blocks(docs, F.col("doc_id") % 7 == 2, hot, many, katz.Settings(hot_sample=30)).toPandas().groupby("bucket")))
    sums = sum(katz.counts_of_counts(p, hot, s) for p in few.values())
    entries = sum(len(r["score"]) for p in few.values() for r in katz.score_bucket(p, sums, hot, many, s) if r["kind"] == "doc")
    tokens = sum(len((r["text"] or "").split()) + 1 for r in docs.collect())
    assert entries <= tokens < many * docs.count()


def test_katz_empty_table(spark):
    assert katz.scores(spark.createDataFrame([], "doc_id long, text string"), F.lit(False), 4).collect() == []


def test_katz_beats_add_one_on_held_out(spark):
    from tessera.llm.queries import QUERIES

    got = QUERIES["op7_katz_backoff"](spark, SF01).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


# ---------------------------------------------------------------- toxicity

def test_toxicity_misspellings_and_edges(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    bad = ["gruntled", "snorkish", "wabblest"]
    text = lambda toxic: " ".join([*rng.choice(words, 30), *([rng.choice(bad)] * toxic), *rng.choice(words, 30)])
    rows = [(i, text(i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, ""), (None, rows[0][1])], "doc_id long, text string").withColumn("score0", F.lit(1))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (5, None), (6, 7)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in subword_toxic.scored(docs, labels, F.lit(True)).collect()}
    assert len(got) == 404 and all(0 <= r["score"] <= 1 and r["score0"] == 1 for r in got.values())
    hits = [(got[i]["score"] >= 0.5) == (i % 4 == 0) for i in range(300, 400)]
    assert sum(hits) >= 92
    assert got[900]["score"] == got[901]["score"] == got[902]["score"] < 0.5 and got[None]["score"] == got[0]["score"]
    none = subword_toxic.scored(docs, labels.limit(0), F.lit(True)).select("score").distinct().collect()
    assert len(none) == 1
    assert subword_toxic.scored(docs.limit(0), labels, F.lit(True)).collect() == []


def misspelt(word):
    """A letter doubled, left out, or changed with the next one."""
    out = {word[:i] + x for i in range(1, len(word)) for x in (word[i] + word[i:], word[i + 1:], word[i + 1:i + 2] + word[i] + word[i + 2:])}
    return sorted(out - {word, word[:-1]})


@pytest.mark.parametrize("seed", range(1, 6))
def test_toxicity_knows_unseen_misspellings(seed):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    bad = ["gruntled", "snorkish", "wabblest"]
    text = lambda toxic: " ".join([*rng.choice(words, 30), *([rng.choice(bad)] * toxic), *rng.choice(words, 30)])
    model = subword_toxic.train([text(i % 4 == 0) for i in range(400)], np.arange(400) % 4 == 0, subword_toxic.Settings())
    score = lambda among: model.scores(among, {})
    assert (score([f"{words[0]} {words[1]} {w} {words[2]}" for w in bad]) > 0.5).all()
    assert (score([f"{words[0]} {words[1]} {x} {words[2]}" for w in bad for x in misspelt(w)]) > 0.5).mean() >= 0.9
    assert (score([" ".join(words[i:i + 4]) for i in range(0, 300, 4)]) > 0.5).mean() <= 0.02


@pytest.mark.parametrize("folder", [SF001, SF01])
def test_toxicity_leaves_clean_documents_of_small_samples_alone(spark, folder):
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id").orderBy("doc_id").collect()
    toxic = np.array([r["toxic"] for r in rows])
    said = subword_toxic.train([r["text"] for r in rows], toxic, subword_toxic.Settings()).scores([r["text"] for r in rows], {}) >= 0.5
    assert said[toxic == 0].mean() <= 0.02 and said[toxic == 1].mean() >= 0.95


def test_toxicity_takes_one_text_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(1, "b b b"), (1, "a a a"), (2, "c c c")], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    one, two = (subword_toxic.fit(d, labels, F.lit(True)) for d in (docs, docs.where("text <> 'b b b'")))
    assert (one.share == two.share).all() and one.bias == two.bias


# ---------------------------------------------------------------- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href='/b'>More</a></ul></nav><!-- <p>no</p> --><article><h1>Head &amp; tail</h1>
<p><b>Bold</b> te<i>x</i>t<br>goes   on &lt;here&gt;&nbsp;now.<p>Second</article><footer>&copy; x</footer>"""


def test_blocks():
    got = html_blocks.blocks(PAGE)
    assert [b.text for b in got] == ["T", "Home", "More", "Head & tail", "Bold text goes on <here> now.", "Second", "© x"]
    assert got[1].linked == 1 and "article" in got[4].path and "nav" not in got[4].path
    assert html_blocks.blocks(None) == html_blocks.blocks("") == html_blocks.blocks("<p></p><!--") == []
    assert [b.text for b in html_blocks.blocks("a < b <i x='>'>c</i> & <p")] == ["a < b c &"]
    html_blocks.blocks("<" * 50_000), html_blocks.blocks("<a '" * 20_000), html_blocks.blocks("<div>" * 20_000 + "x")


def test_lstm_gradients():
    rng = np.random.default_rng(0)
    m = block_lstm.Model(block_lstm.Settings(hidden=3))
    m.start(rng)
    x, live = block_lstm.padded([rng.normal(size=(n, block_lstm.WIDTH)) for n in (4, 2)])
    y = rng.random(live.shape) < 0.5
    _, grads = m.gradients(x, live, y)
    for name, w in m.weights.items():
        at = tuple(rng.integers(0, d) for d in w.shape)
        old, sides = w[at], []
        for d in (1e-5, -1e-5):
            w[at] = old + d
            sides.append(m.gradients(x, live, y)[0])
        w[at] = old
        assert math.isclose((sides[0] - sides[1]) / 2e-5, grads[name][at], rel_tol=1e-4, abs_tol=1e-8)


def test_pages_main_text(spark):
    pages = table(spark, SF01, "pages")
    rows = pages.union(spark.createDataFrame([(-1, "u", None), (-2, "u", ""), (-2, "u", "")], pages.schema)).withColumn("text0", F.lit(0))
    got = block_lstm.extracted(rows).collect()
    right = 0
    for r in got:
        if r["page_id"] >= 0:
            want = "\n\n".join(b.text for b in html_blocks.blocks(r["html"]) if "article" in b.path)
            right += want == r["text"]
        else:
            assert r["text"] == ""
    assert right >= 0.98 * (len(got) - 3) and len(got) == pages.count() + 3
    assert block_lstm.extracted(pages.limit(0)).collect() == []


def test_labeller_in_other_layouts(spark):
    htmls = [r["html"] for r in table(spark, SF001, "pages").orderBy("page_id").collect()]
    model = block_lstm.train(htmls[:120])
    rng, features = np.random.default_rng(9), block_lstm.Features()
    pool = [b.text for h in htmls[120:] for b in html_blocks.blocks(h)]
    wrong = n = 0
    for h in htmls[120:220]:
        texts = [b.text for b in html_blocks.blocks(h) if block_lstm.is_main(b)]
        if texts:
            bs = html_blocks.blocks(block_lstm.relaid(texts, pool, rng))
            got = model.label(features.of([bs]))[0]
            wrong += int((got != np.array([b.label == "1" for b in bs])).sum())
            n += len(bs)
    assert wrong <= 0.02 * n


def test_folds_follow_crc32(spark):
    from tessera.llm.common import fold_of

    got = spark.range(500).select("id", fold_of(F.col("id"), 7).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 7 for r in got)
