"""Quality by importance resampling.

Two bag-of-n-grams models over hashed word n-grams are estimated: one of target text
(documents labelled good), one of all raw text. A document's log weight is the log ratio
of the two models' probabilities of its n-grams. Adding keyed Gumbel noise and taking
the k largest keys samples k documents without replacement, in proportion to their
weights.

Target documents are a bounded sample (``max_target`` labelled ids by keyed hash, so the
ids can be broadcast); the raw model counts every document. Both models are arrays of
``buckets`` counts, whatever the corpus. The k-th largest key is found exactly, by
refining a histogram over the keys' bits, so no ordering of all rows is needed.

Defined results: null and empty texts have weight 0 (ratio 1); repeated rows share weight
and noise; all rows whose key equals the k-th largest are kept, so ties may give a few
more than k; without target documents every weight is 0. A null doc_id has its own noise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Interned, batches, digest64, written

PIECE = re.compile(r"[^\W_]+|[^\w\s]+|_+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    longest: int = 2  # n-grams of 1 to this many words
    max_target: int = 20_000  # bound on the sample of labelled target ids
    smoothing: float = 1.0
    seed: int = 29


class Counter:
    """Hashed n-gram counts of texts, with a bounded cache of word digests."""

    def __init__(self, s: Settings):
        self.s, self.cache = s, Interned(digest64, 500_000)

    def buckets(self, text: str | None) -> np.ndarray:
        """The bucket of every n-gram of a whole text."""
        words = PIECE.findall((text or "").lower())
        cache = self.cache
        one = np.fromiter([cache[w] for w in words], np.uint64, len(words))
        out, gram = [one], one
        for n in range(2, self.s.longest + 1):
            if len(words) < n:
                break
            gram = (gram[:-1] * MULTIPLIER) ^ one[n - 1:] ^ np.uint64(n)
            out.append(gram)
        mixed = np.concatenate(out) * MULTIPLIER
        return ((mixed >> np.uint64(20)) % np.uint64(self.s.buckets)).astype(np.int64)


def n_gram_counts(docs: DataFrame, is_target: Column, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket of target and of all documents, added up in Spark; ``buckets`` rows return."""
    def run(frames):
        counter = Counter(s)
        target, raw = np.zeros(s.buckets, np.int64), np.zeros(s.buckets, np.int64)
        for pdf in batches(frames, 256):
            for text, own in zip(pdf["text"], pdf["target"]):
                n = np.bincount(counter.buckets(text), minlength=s.buckets)
                raw += n
                if own:
                    target += n
        yield pd.DataFrame({"bucket": np.arange(s.buckets), "target": target, "raw": raw})

    counted = docs.select("text", F.coalesce(is_target, F.lit(False)).alias("target")).mapInPandas(
        run, "bucket long, target long, raw long")
    rows = counted.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toPandas()
    out = np.zeros((2, s.buckets))
    out[:, rows["bucket"]] = rows["target"], rows["raw"]
    return out[0], out[1]


def log_ratio(target: np.ndarray, raw: np.ndarray, s: Settings) -> np.ndarray:
    if not target.sum():
        return np.zeros(s.buckets)
    share = lambda c: (c + s.smoothing) / (c.sum() + s.smoothing * s.buckets)
    return np.log(share(target)) - np.log(share(raw))


def log_weights(docs: DataFrame, ratio: np.ndarray, s: Settings, into: str = "log_weight") -> DataFrame:
    """All rows and columns of ``docs`` with the log importance weight of their whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)

    @F.pandas_udf(T.DoubleType())
    def weigh(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(s)
        for texts in frames:
            yield pd.Series([float(sent.value[counter.buckets(t)].sum()) for t in texts], dtype=float)

    return docs.withColumn(into, weigh(F.col("text")))


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel noise keyed by ``key``."""
    half = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double")
    uniform = (half + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def kth_largest(df: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest value of a double column, exactly: each round counts 4096 equal cells of
    the range that holds it and keeps that one, until one value is left."""
    if k <= 0:
        return None
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    if lo is None:
        return None
    need = k
    while lo < hi:
        width = (hi - lo) / 4096
        if width <= 0 or lo + width == lo:
            break
        cell = F.least(F.floor((F.col(key) - F.lit(lo)) / F.lit(width)), F.lit(4095)).cast("int")
        inside = df.where(F.col(key).between(lo, hi))
        counts = inside.groupBy(cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
        for row in sorted(counts, key=lambda r: -r["cell"]):
            if row["n"] >= need:
                new = row["lo"], row["hi"]
                break
            need -= row["n"]
        else:
            return lo  # fewer than k rows in all
        if new == (lo, hi):
            break
        lo, hi = new
    return hi


def target_sample(labels: DataFrame, s: Settings = Settings()) -> tuple[list[int], float]:
    """Ids of at most ``max_target`` documents labelled good, and the share of good ones among all
    labelled documents. Null ids and labels are ignored."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    share = known.agg(F.avg("quality")).first()[0]
    ids = known.where("quality = 1").select("doc_id").distinct().orderBy(
        F.xxhash64("doc_id", F.lit(s.seed)), "doc_id").limit(s.max_target)
    return [r[0] for r in ids.collect()], 0.5 if share is None else float(share)


def resample(docs: DataFrame, target_ids: list[int], share: float, s: Settings = Settings()) -> DataFrame:
    """``doc_id, log_weight, sample_key, kept`` of every document; ``share`` of them is sampled."""
    known = docs.sparkSession.sparkContext.broadcast(np.array(sorted(target_ids), dtype=np.int64))

    @F.pandas_udf(T.BooleanType())
    def is_target(ids: pd.Series) -> pd.Series:
        return ids.notna() & ids.isin(known.value)

    target, raw = n_gram_counts(docs, is_target(F.col("doc_id")), s)
    weighed = log_weights(docs.select("doc_id", "text"), log_ratio(target, raw, s), s).select("doc_id", "log_weight")
    keyed = written(weighed.withColumn("sample_key", F.col("log_weight") + gumbel(F.col("doc_id"), s.seed)), "importance")
    k = int(round(share * keyed.count()))
    least = kth_largest(keyed, "sample_key", k)
    return keyed.withColumn("kept", F.col("sample_key") >= F.lit(least) if least is not None else F.lit(False))
