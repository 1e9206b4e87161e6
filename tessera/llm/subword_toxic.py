"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of its hashed character n-grams (with word
marks) and of the word itself; a bag of words is the mean of its words' vectors; a
two-class softmax reads the bag. Vectors and softmax are trained jointly by Adagrad in
numpy. A misspelling that was never seen shares most n-grams with the word it stands
for, hence most of its vector. So that the vector lies in all n-grams and not in a few, training reads
most words with one letter unreadable: n-grams over it, and the word itself, add nothing to that step.

A document is read in overlapping windows of ``window`` words, so that a few words
weigh alike in short and long texts; its score is the largest window probability. As
only whole documents carry labels, training alternates: all windows of clean documents
are clean, the highest-scoring window of a toxic document is toxic (the first round
takes whole documents), also with its strongest word among words of clean documents, so that the
word decides and not its neighbours. A small sample takes more rounds, until nearly all of its clean documents score as
clean. After averaging, the softmax is linear in the words, so a
word's share of the logit is one number, kept in a bounded cache of the worker.

The training sample is bounded: at most ``max_docs`` labelled documents (smallest keyed
hashes of doc_id), each label's documents alike; each contributes its whole text.
Defined results: null and empty texts, and texts without words, score the softmax of an
empty bag; repeated rows score alike; of several texts of one id the least is learnt from; no labels at all, or one class only, give every
document the smoothed share of label 1. Labels that are null or not 0/1 are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHED = 1_500_000  # word logits kept by a worker
START = 1e-6  # Adagrad's memory before the first step
BATCH = 256  # documents scored at a time

WORD = re.compile(r"[^\W_]+(?:['’@$0-9][^\W_]+)*")


@dataclass(frozen=True)
class Settings:
    dim: int = 12
    buckets: int = 1 << 17  # rows of the hashed embedding table
    shortest: int = 3
    longest: int = 5
    window: int = 5  # words averaged at a time; windows overlap by half
    max_docs: int = 3500  # bound on the training sample
    epochs: int = 2
    rounds: int = 6  # at least; more while clean documents of the sample still score as toxic
    most_rounds: int = 24
    quiet: float = 0.01  # part of the clean documents that may
    batch: int = 512
    rate: float = 0.5
    seed: int = 17
    others: int = 4  # other contexts in which a toxic window's strongest word is read, each round
    prior: float = 5.0  # logit of a window without any evidence, below zero
    drop: float = 0.8  # part of the words that a training step reads with one letter unreadable


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def _bucket(h: np.ndarray, n: int, buckets: int) -> np.ndarray:
    h = (h + np.uint64(n)) * _MIX
    return ((h ^ (h >> np.uint64(29))) * _MIX >> np.uint64(24)).astype(np.int64) % buckets


def subwords(words: list[str], s: Settings, spans: bool = False) -> tuple[np.ndarray, ...]:
    """Bucket numbers of each word's character n-grams, and of the marked word itself, with the
    number of the word that each belongs to (and the first letter of its span and the one behind it, if
    asked for). Rolling polynomial hashes over code points."""
    if not words:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((2, 0), np.int64))[:2 + spans]
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - first[owner]
    left = sizes[owner] - place
    powers = np.cumprod(np.concatenate(([1], np.full(sizes.max() - 1, _STEP))).astype(np.uint64), dtype=np.uint64)
    rows, owners = [_bucket(np.add.reduceat(codes * powers[place], first), 0, s.buckets)], [np.arange(len(words))]
    covered = [np.stack([np.zeros(len(words), np.int64), sizes])]
    for n in range(s.shortest, s.longest + 1):
        at = np.flatnonzero(left >= n)
        h = np.zeros(len(at), np.uint64)
        for j in range(n):
            h = h * _STEP + codes[at + j]
        rows.append(_bucket(h, n, s.buckets))
        owners.append(owner[at])
        covered.append(np.stack([place[at], place[at] + n]))
    return (np.concatenate(rows), np.concatenate(owners), np.concatenate(covered, axis=1))[:2 + spans]


@dataclass
class Model:
    settings: Settings
    share: np.ndarray  # (buckets,) each n-gram's part of the logit: its vector through the softmax
    bias: float

    def word_logits(self, words: list[str]) -> np.ndarray:
        rows, owner = subwords(words, self.settings)
        n = np.bincount(owner, minlength=len(words))
        return np.bincount(owner, self.share[rows], len(words)) / np.maximum(n, 1)

    def window_logits(self, values: np.ndarray) -> np.ndarray:
        """Mean word logit of every window of a text's words."""
        w, n = self.settings.window, len(values)
        if n <= w:
            return np.array([values.mean() if n else 0.0])
        starts = np.arange(0, n - w + 1, w // 2)
        if starts[-1] != n - w:
            starts = np.append(starts, n - w)
        total = np.concatenate(([0.0], np.cumsum(values)))
        return (total[starts + w] - total[starts]) / w

    def scores(self, texts: Iterable[str | None], cache: dict[str, float]) -> np.ndarray:
        """Toxicity of whole texts; ``cache`` keeps word logits between calls and is bounded here."""
        lists = [words_of(t) for t in texts]
        new = list(set().union(*lists).difference(cache)) if lists else []
        if len(cache) + len(new) > CACHED:
            cache.clear()
            new = list(set().union(*lists))
        cache.update(zip(new, self.word_logits(new).tolist()))
        top = [self.window_logits(np.array([cache[w] for w in words])).max() for words in lists]
        return 1.0 / (1.0 + np.exp(-np.clip(np.array(top, dtype=float) + self.bias, -500, 500)))


def _windows(words: np.ndarray, w: int) -> list[np.ndarray]:
    if len(words) <= w:
        return [words]
    starts = list(range(0, len(words) - w + 1, w // 2))
    if starts[-1] != len(words) - w:
        starts.append(len(words) - w)
    return [words[i:i + w] for i in starts]


def train(texts: list[str], labels: np.ndarray, s: Settings) -> Model:
    """Fit embeddings and softmax jointly; ``labels`` are 0 or 1, ``texts`` whole."""
    labels = np.asarray(labels, dtype=int)
    if len(set(labels.tolist())) < 2:
        rate = (labels.sum() + 1) / (len(labels) + 2)
        return Model(s, np.zeros(s.buckets), float(np.log(rate / (1 - rate))))
    rng = np.random.default_rng(s.seed)
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], dtype=np.int32) for t in texts]
    names, pieces, counts, spans = list(vocabulary), [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros((2, 0), np.int16)]
    for k in range(0, len(names), 20_000):  # in parts: the hashes take much room on the way
        rows, owner, span = subwords(part := names[k:k + 20_000], s, spans=True)
        order = np.argsort(owner, kind="stable")
        pieces.append(rows[order].astype(np.int32))
        spans.append(np.minimum(span[:, order], 30_000).astype(np.int16))
        counts.append(np.bincount(owner, minlength=len(part)))
    flat, size, (begin, end) = np.concatenate(pieces), np.concatenate(counts), np.concatenate(spans, axis=1)
    letters = np.array([min(len(w) + 2, 30_000) for w in names] or [0])
    del names, vocabulary, pieces, spans
    first = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    table = rng.uniform(-1, 1, (s.buckets, s.dim)) / s.dim
    out = np.zeros((s.dim, 2))
    bias = np.zeros(2)
    memory, memory_out, memory_bias = np.full(s.buckets, START), np.full((s.dim, 2), START), np.full(2, START)

    def spread(bag_words: np.ndarray):
        """Places of the n-grams of words, and which word each belongs to."""
        n = size[bag_words]
        owner = np.repeat(np.arange(len(bag_words)), n)
        start = np.repeat(first[bag_words] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
        return np.arange(len(owner)) + start, owner

    def epoch(bags: list[np.ndarray], y: np.ndarray, batch: int) -> None:
        order = rng.permutation(len(bags))
        batch = max(16, min(batch, len(bags) // 40))  # small samples get as many steps
        for k in range(0, len(order), batch):
            pick = order[k:k + batch]
            sizes = np.array([len(bags[i]) for i in pick])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            words, at = np.unique(np.concatenate([bags[i] for i in pick]), return_inverse=True)
            place, own = spread(words)
            g = flat[place]
            n = size[words]
            ends = np.concatenate(([0], np.cumsum(n)[:-1]))
            at_letter = 1 + (rng.random(len(words)) * (letters[words] - 2)).astype(int)
            at_letter[rng.random(len(words)) >= s.drop] = -1
            seen = ((at_letter[own] < begin[place]) | (at_letter[own] >= end[place])).astype(float)[:, None]
            vectors = np.add.reduceat(table[g] * seen, ends) / n[:, None]
            hidden = np.add.reduceat(vectors[at], starts) / sizes[:, None]
            z = hidden @ out + bias
            d = np.exp(z - z.max(1, keepdims=True))
            d /= d.sum(1, keepdims=True)
            d[np.arange(len(pick)), y[pick]] -= 1
            d /= len(pick)
            d_hidden = (d @ out.T) / sizes[:, None]
            d_out, d_bias = hidden.T @ d, d.sum(0)
            by_word = np.argsort(at, kind="stable")
            first_of = np.searchsorted(at[by_word], np.arange(len(words)))
            d_words = np.add.reduceat(np.repeat(d_hidden, sizes, axis=0)[by_word], first_of) / n[:, None]
            by_row = np.argsort(g, kind="stable")
            rows, first_row = np.unique(g[by_row], return_index=True)
            d_rows = np.add.reduceat((np.repeat(d_words, n, axis=0) * seen)[by_row], first_row)
            memory[rows] += (d_rows ** 2).mean(1)
            table[rows] -= s.rate * d_rows / np.sqrt(memory[rows])[:, None]
            memory_out[...] += d_out ** 2
            out[...] -= s.rate * d_out / np.sqrt(memory_out)
            memory_bias[...] += d_bias ** 2
            bias[...] -= s.rate * d_bias / np.sqrt(memory_bias)

    def model() -> Model:
        learnt = memory > START  # n-grams that no step has seen say nothing
        return Model(s, np.where(learnt, table @ (out[:, 1] - out[:, 0]), 0.0), float(bias[1] - bias[0]))

    kept = [i for i in range(len(docs)) if len(docs[i])]
    bags, y = [docs[i] for i in kept], labels[kept]
    epoch(bags, y, 32)  # whole documents: small batches bound the memory
    bias[:] = np.array([0.5, -0.5]) * s.prior  # a window is clean unless its words say otherwise, so clean words need say little
    memory_bias[:] = 1.0
    clean = np.concatenate([docs[i] for i in kept if not labels[i]] or [np.zeros(0, np.int32)])
    hard: dict[tuple[int, int], np.ndarray] = {}
    for turn in range(max(s.rounds, s.most_rounds)):
        now = model()
        logit = np.concatenate([np.add.reduceat(now.share[flat[first[k]:first[min(k + 20_000, len(size))]]],
                                                first[k:min(k + 20_000, len(size))] - first[k])
                                for k in range(0, len(size), 20_000)] or [np.zeros(0)]) / size
        windows = {i: now.window_logits(logit[docs[i]]) for i in kept}
        loud = sum(windows[i].max() + now.bias >= 0 for i in kept if not labels[i])
        if turn >= s.rounds and loud <= s.quiet * sum(not labels[i] for i in kept):
            break
        toxic = []
        for i in kept:
            cut = _windows(docs[i], s.window)
            best = int(windows[i].argmax())
            if labels[i]:
                toxic.append(cut[best])
                for _ in range(s.others if len(clean) else 0):  # its strongest word among words of clean documents
                    moved = rng.choice(clean, len(cut[best]))
                    strongest = int(logit[cut[best]].argmax())
                    moved[strongest] = cut[best][strongest]
                    toxic.append(moved)
            else:  # its hardest window of each round, and another
                for j in (best, int(rng.integers(0, len(cut)))):
                    hard[i, j] = cut[j]
        bags = [*toxic, *hard.values()]
        y = np.repeat([1, 0], [len(toxic), len(hard)])
        for _ in range(s.epochs):
            epoch(bags, y, s.batch)
    return model()


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, s: Settings) -> DataFrame:
    """At most ``max_docs`` labelled documents: (text, toxic). The chosen ids are broadcast (at most
    ``max_docs`` of them), so the texts are only filtered, never shuffled."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & usable)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = known.orderBy(F.xxhash64("doc_id", F.lit(s.seed)), "doc_id").limit(s.max_docs)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, usable: Column, s: Settings = Settings()) -> Model:
    """Train on a bounded sample, in one task: the driver gets the model only, a number for each bucket.
    ``usable``: which rows of ``labels`` may be learnt from."""
    rows = training_rows(docs, labels, usable, s).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([*frames, pd.DataFrame({"doc_id": [], "toxic": [], "text": []})]).sort_values("doc_id")
        model = train(pdf["text"].tolist(), pdf["toxic"].to_numpy(dtype=int), s)
        yield pd.DataFrame({"share": [model.share.tobytes()], "bias": [model.bias]})

    made = rows.coalesce(1).mapInPandas(learn, "share binary, bias double").first()
    if made is None:  # no partition at all: nothing to learn from
        return train([], np.zeros(0, int), s)
    return Model(s, np.frombuffer(made["share"]).copy(), made["bias"])


def score_column(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """The toxicity of each whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = sent.value
        cache: dict[str, float] = {}
        for texts in frames:
            yield pd.Series(np.concatenate([own.scores(texts.iloc[i:i + BATCH], cache) for i in range(0, len(texts), BATCH)])
                            if len(texts) else [], dtype=float)

    return score(F.col(text))


def scored(docs: DataFrame, labels: DataFrame, usable: Column, s: Settings = Settings(), text: str = "text",
           into: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the score added as ``into``."""
    return docs.withColumn(into, score_column(fit(docs, labels, usable, s), docs, text))
