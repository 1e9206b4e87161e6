"""Katz backoff language model over words, of order two, scored for every document.

Tokens are the words of a text and one end. A document's log probability is the sum over
its tokens w with their history h (the token before; a start mark at first):

    P(w | h) = disc(c(h, w)) / c(h)      if the pair was seen in training
             = alpha(h) * P(w)           if not (alpha is 1 for an unseen history)
    P(w)     = disc(c(w)) / N            of a word seen in training; all other words share
                                         what is left, as one class

``disc`` is Good-Turing discounting of counts up to ``cutoff`` (Katz's formula; where the
counts of counts admit none, the absolute discount n1 / (n1 + 2 n2)); larger counts lose
as much as a count of ``cutoff``, so that every history keeps some mass. The
weights ``alpha(h) = (1 - sum of P(w|h) over seen w) / (1 - sum of P(w) over seen w)`` make
each P(. | h) sum to one exactly.

The work is split by words, never by documents. Batches of documents are cut into blocks, one for each
bucket of words: the block holds its pairs (w, h), and by whom they are used. A bucket sees all of a word's
pairs, so counts c(w), c(h, w) and discounted probabilities are made there: first for the counts of counts,
then, with these, for scores. Sums by history and the uses of unseen pairs go on to buckets of histories, which hold the table
of c(h) and alpha(h). Words that are frequent in a bounded sample (``max_hot``) are spread over all buckets by
their pairs; only their few counts are shared.

Defined results: null and empty texts are one end; rows are scored one by one, so repeated rows and ties score alike;
a null doc_id counts as empty text in the fold; without training documents every token is of the unseen class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Interned, ascii_words, digest64, written

END, START = digest64("\x00end") >> 1, digest64("\x00start") >> 1  # no word holds white space or NUL marks like these
_MIX = np.uint64(0x9E3779B97F4A7C15)
REPLICAS = 16  # history buckets over which a hot history's uses are spread


@dataclass(frozen=True)
class Settings:
    cutoff: int = 5
    batch_tokens: int = 1_500_000  # tokens of the documents handled together
    bucket_tokens: int = 2_500_000  # about as many in a bucket of words
    least_buckets: int = 12
    max_hot: int = 400  # bound on the words that are spread over buckets
    hot_share: float = 0.002
    hot_sample: int = 2000  # documents read for them


def discounts(n: np.ndarray, cutoff: int) -> np.ndarray:
    """What a count of r = 0 .. cutoff is discounted to. ``n[r]``: how many have count r, up to cutoff + 1.
    A larger count loses what ``cutoff`` loses."""
    out = np.arange(cutoff + 1, dtype=float)
    n = np.asarray(n, dtype=float)
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    with np.errstate(all="ignore"):
        common = (cutoff + 1) * n[cutoff + 1] / n[1]
        for r in range(1, cutoff + 1):
            star = (r + 1) * n[r + 1] / n[r]
            d = (star / r - common) / (1 - common)
            out[r] = r * d if np.isfinite(d) and 0 < d < 1 else r - min(absolute, 0.9)
    return out


def discounted(c: np.ndarray, table: np.ndarray) -> np.ndarray:
    k = len(table) - 1
    return np.where(c <= k, table[np.minimum(c, k)], c - (k - table[k]))


def _place(x: np.ndarray, y, buckets: int) -> np.ndarray:
    h = (np.asarray(x).view(np.uint64) + (np.asarray(y).view(np.uint64) if not np.isscalar(y) else np.uint64(y))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return ((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _spread(hot: np.ndarray, key: np.ndarray, salt: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key; that of a hot one depends on the salt too."""
    return np.where(np.isin(key, hot), _place(key, salt, buckets), _place(key, 0, buckets))


def token_digest(word: bytes) -> int:
    return digest64(word) >> 1  # non-negative 63 bits


def hot_words(docs: DataFrame, s: Settings) -> np.ndarray:
    """Digests of the words that fill a share of a bounded sample; always the end. It only deals out work."""
    ids = docs.where("doc_id is not null").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.hot_sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids.distinct()), "doc_id").where("text is not null").select("text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            words = [w for t in pdf["text"] for w in ascii_words(t)]
            ids = np.array([token_digest(w) for w in words], dtype=np.int64)
            u, n = np.unique(ids, return_counts=True)
            keep = n >= max(2, s.hot_share * len(ids))
            yield pd.DataFrame({"w": u[keep], "n": n[keep]})

    found = rows.mapInPandas(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(s.max_hot).collect()
    return np.array(sorted({END, *(r["w"] for r in found)}), dtype=np.int64)


_BLOCK = ("bucket int, batch long, head boolean, held binary, w array<long>, w_pairs array<int>, h array<long>, uses array<int>, "
          "doc array<smallint>, ids array<long>, known array<boolean>, tokens array<int>")


def blocks(docs: DataFrame, held: Column, hot: np.ndarray, buckets: int, s: Settings) -> DataFrame:
    """Blocks of word pairs by bucket, and one head row a batch with its documents."""
    def cut(batch: int, ids: list, held: list[bool], texts: list[np.ndarray]) -> pd.DataFrame:
        sizes = np.array([len(t) for t in texts])
        w = np.concatenate(texts)
        h = np.concatenate(([START], w[:-1]))
        h[np.concatenate(([0], np.cumsum(sizes)[:-1]))] = START
        doc = np.repeat(np.arange(len(texts), dtype=np.int16), sizes)
        bucket = _spread(hot, w, h, buckets).astype(np.int32)
        order = np.lexsort((h, w, bucket))
        w, h, doc, bucket = w[order], h[order], doc[order], bucket[order]
        del order
        new_w = np.concatenate(([True], (w[1:] != w[:-1]) | (bucket[1:] != bucket[:-1])))
        new_pair = new_w | np.concatenate(([True], h[1:] != h[:-1]))
        pair_at, cuts = np.flatnonzero(new_pair), np.searchsorted(bucket, np.arange(buckets + 1))
        rows, mask = [], np.packbits(held).tobytes()
        for b in range(buckets):
            lo, hi = cuts[b], cuts[b + 1]
            if lo == hi:
                continue
            p = pair_at[np.searchsorted(pair_at, lo):np.searchsorted(pair_at, hi)]
            first = np.flatnonzero(new_w[p])
            rows.append((b, batch, False, mask, w[p[first]], np.diff(np.append(first, len(p))).astype(np.int32), h[p],
                         np.diff(np.append(p, hi)).astype(np.int32), doc[lo:hi], None, None, None))
        rows.append((batch % buckets, batch, True, mask, None, None, None, None, None,
                     [0 if i is None else i for i in ids], [i is not None for i in ids], sizes.astype(np.int32)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _BLOCK.split(", ")])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Interned(token_digest, 300_000)
        batch, n = TaskContext.get().partitionId() << 32, 0
        ids, flags, texts = [], [], []
        for pdf in frames:
            for i, f, text in zip(pdf["doc_id"].astype("Int64"), pdf["held"], pdf["text"]):
                words = ascii_words(text or "")
                texts.append(np.array([*[cache[x] for x in words], END], dtype=np.int64))
                ids.append(None if pd.isna(i) else int(i))
                flags.append(bool(f))
                n += len(words) + 1
                if n >= s.batch_tokens or len(ids) >= 32_000:
                    yield cut(batch, ids, flags, texts)
                    batch, n, ids, flags, texts = batch + 1, 0, [], [], []
        if ids:
            yield cut(batch, ids, flags, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), "text").mapInPandas(run, _BLOCK)


class Bucket:
    """All blocks of one bucket, with the counts of its words and pairs in training documents."""

    def __init__(self, pdf: pd.DataFrame, hot: np.ndarray):
        parts = pdf[~pdf["head"].astype(bool)].sort_values("batch")
        self.batches, self.n_docs = parts["batch"].to_numpy(), [len(np.frombuffer(m, np.uint8)) * 8 for m in parts["held"]]
        cat = lambda c, t: np.concatenate([np.asarray(x, dtype=t) for x in parts[c]] or [np.zeros(0, t)])
        uses, h = cat("uses", np.int32), cat("h", np.int64)
        w = np.repeat(cat("w", np.int64), cat("w_pairs", np.int32))
        offsets = np.concatenate(([0], np.cumsum(self.n_docs)))
        self.doc = np.concatenate([np.asarray(d, dtype=np.int32) + np.int32(o) for d, o in zip(parts["doc"], offsets)] or [np.zeros(0, np.int32)])
        held = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8)).astype(bool) for m in parts["held"]] or [np.zeros(0, bool)])
        order = np.lexsort((h, w))
        w, h = w[order], h[order]
        new_w = np.concatenate(([True], w[1:] != w[:-1])) if len(w) else np.zeros(0, bool)
        new = new_w | np.concatenate(([True], h[1:] != h[:-1])) if len(w) else new_w
        number = np.empty(len(w), np.int32)
        number[order] = np.cumsum(new, dtype=np.int32) - 1
        self.pair = np.repeat(number, uses)  # the pair of each use
        self.held = held[self.doc]
        self.w, self.h = w[new], h[new]
        self.word = np.cumsum(new_w[new]) - 1  # the word of each pair
        self.words = self.w[new_w[new]]
        self.c2 = np.bincount(self.pair[~self.held], minlength=len(self.w))
        self.c1 = np.bincount(self.word, self.c2, len(self.words)).astype(np.int64)
        self.hot = np.isin(self.words, hot)


def count_columns(hot: np.ndarray, s: Settings) -> int:
    return 2 * (s.cutoff + 2) + 2 + len(hot)


def counts_of_counts(pdf: pd.DataFrame, hot: np.ndarray, s: Settings) -> np.ndarray:
    """Of one bucket: pairs by count, words by count (hot ones not), tokens and words (hot ones not), and
    the counts of the hot words here."""
    b, k = Bucket(pdf, hot), s.cutoff + 2
    of = lambda c: np.bincount(c[(c > 0) & (c < k)], minlength=k)
    own = np.zeros(len(hot), np.int64)
    own[np.searchsorted(hot, b.words[b.hot])] = b.c1[b.hot]
    cold = b.c1[~b.hot]
    return np.concatenate((of(b.c2), of(cold), [b.c1.sum(), (cold > 0).sum()], own)).astype(np.int64)


@dataclass
class Counts:
    """The model's few shared numbers, from the summed counts of counts."""

    total: int
    words: int
    hot: np.ndarray
    hot_counts: np.ndarray
    pairs: np.ndarray  # discounts
    singles: np.ndarray
    unseen: float  # log10 probability of the class of unseen words

    @classmethod
    def of(cls, sums: np.ndarray, hot: np.ndarray, s: Settings) -> Counts:
        k = s.cutoff + 2
        n2, n1 = sums[:k], sums[k:2 * k].copy()
        own = sums[2 * k + 2:]
        small = own[(own > 0) & (own < k)]
        n1 += np.bincount(small, minlength=k)
        total, words = int(sums[2 * k]), int(sums[2 * k + 1] + (own > 0).sum())
        singles = discounts(n1, s.cutoff)
        # Mass of the unseen class: what all words lose. Words above the cutoff lose one amount each.
        loss = float((n1[1:-1] * (np.arange(1, s.cutoff + 1) - singles[1:])).sum()) + (words - n1[1:-1].sum()) * (s.cutoff - singles[-1])
        return cls(total, words, hot, own, discounts(n2, s.cutoff), singles, float(np.log10(loss / total)) if total and loss > 0 else 0.0)

    def p1(self, c: np.ndarray) -> np.ndarray:
        return discounted(c, self.singles) / max(self.total, 1)


_PART = ("place int, kind string, batch long, h array<long>, seen array<double>, lower array<double>, count array<long>, doc array<int>, "
         "score array<double>, base array<double>, known array<int>, ids array<long>, has_id array<boolean>, tokens array<int>, held binary, total long, words long, "
         "batches array<long>, uses array<int>")
_NAMES = [c.split()[0] for c in _PART.split(", ")]


def _rows(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame([[r.get(c) for c in _NAMES] for r in rows], columns=_NAMES).astype({"total": "Int64", "words": "Int64", "batch": "Int64"})


def score_bucket(pdf: pd.DataFrame, sums: np.ndarray, hot: np.ndarray, buckets: int, s: Settings) -> list[dict]:
    """Of one bucket: each batch's partial scores, sums by history, and the uses of unseen pairs."""
    m, b = Counts.of(sums, hot, s), Bucket(pdf, hot)
    c1 = b.c1.copy()
    c1[b.hot] = m.hot_counts[np.searchsorted(hot, b.words[b.hot])]
    p1 = m.p1(c1)
    with np.errstate(divide="ignore"):
        log_c1, log_p1 = np.log10(np.maximum(c1, 1)), np.where(c1 > 0, np.log10(p1), m.unseen)
        log_pair = np.where(b.c2 > 0, np.log10(discounted(b.c2, m.pairs)), 0.0)
    start = np.log10(max(int(m.hot_counts[np.searchsorted(hot, END)]), 1))
    # A seen pair costs its history's count; summed over a text that is the count of each token but the
    # end, as the next one's history. Uses of unseen pairs get theirs back from the history's bucket.
    as_history = np.where(b.words == END, start, log_c1)
    seen = b.c2 > 0
    by_pair = np.where(seen, log_pair, log_p1[b.word]) - as_history[b.word]
    n = sum(b.n_docs)
    score = np.bincount(b.doc, by_pair[b.pair], n)
    base = np.bincount(b.doc, np.log10(c1 + 1)[b.word][b.pair], n)
    known = np.bincount(b.doc, (c1 > 0)[b.word][b.pair], n).astype(np.int32)
    used = np.bincount(b.doc, minlength=n) > 0
    out, at = [], 0
    for batch, size in zip(b.batches, b.n_docs):
        cut = slice(at, at + size)
        own = np.flatnonzero(used[cut])
        part = {"place": -1, "kind": "doc", "batch": int(batch)}
        if len(own) > 0.8 * size:  # nearly all documents: their numbers are left out
            out.append(part | {"score": score[cut], "base": base[cut], "known": known[cut]})
        else:
            out.append(part | {"doc": own.astype(np.int32), "score": score[cut][own], "base": base[cut][own], "known": known[cut][own]})
        at += size
    heads = pdf[pdf["head"].astype(bool)]
    for r in heads.itertuples():
        out.append({"place": -1, "kind": "head", "batch": int(r.batch), "ids": r.ids, "has_id": r.known, "tokens": r.tokens, "held": r.held,
                    "total": m.total, "words": m.words})
    p = np.flatnonzero(seen)
    order = p[np.argsort(b.h[p], kind="stable")]
    if len(order):
        h = b.h[order]
        at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        sums_of = [np.add.reduceat(x, at) for x in (discounted(b.c2[order], m.pairs), p1[b.word[order]], b.c2[order])]
        out += _by_place(h[at], sums_of, hot, buckets)
    lost = np.flatnonzero(~seen[b.pair])
    if len(lost):
        out += _uses(b, lost, hot, buckets)
    return out


def _uses(b: Bucket, lost: np.ndarray, hot: np.ndarray, buckets: int) -> list[dict]:
    """One row for each bucket of histories: the uses of unseen pairs that it weighs, in order of their batches."""
    edges = np.concatenate(([0], np.cumsum(b.n_docs)))
    doc, h = b.doc[lost], b.h[b.pair[lost]]
    batch = np.searchsorted(edges, doc, side="right") - 1
    place = _spread(hot, h, (batch % REPLICAS).astype(np.int64), buckets)
    order = np.lexsort((batch, place))
    h, place, batch = h[order], place[order], batch[order]
    doc = (doc[order] - edges[batch]).astype(np.int32)
    new = np.concatenate(([True], place[1:] != place[:-1]))
    cuts = np.append(np.flatnonzero(new), len(place))
    runs = np.append(np.flatnonzero(new | np.concatenate(([True], batch[1:] != batch[:-1]))), len(place))
    at = np.searchsorted(runs, cuts)  # the first run of each place
    sizes = np.diff(runs).astype(np.int32)
    return [{"place": int(place[lo]), "kind": "use", "h": h[lo:hi], "doc": doc[lo:hi], "batches": b.batches[batch[runs[i:j]]], "uses": sizes[i:j]}
            for lo, hi, i, j in zip(cuts[:-1], cuts[1:], at[:-1], at[1:])]


def _by_place(h: np.ndarray, sums: list[np.ndarray], hot: np.ndarray, buckets: int) -> list[dict]:
    """Rows of history sums by bucket of histories; a hot history goes to all its replicas."""
    is_hot = np.isin(h, hot)
    place, row = [_place(h[~is_hot], 0, buckets)], [np.flatnonzero(~is_hot)]
    for r in range(REPLICAS):
        place.append(_place(h[is_hot], np.full(is_hot.sum(), r, np.int64), buckets))
        row.append(np.flatnonzero(is_hot))
    place, row = np.concatenate(place), np.concatenate(row)
    order = np.lexsort((row, place))
    place, row = place[order], row[order]
    keep = np.concatenate(([True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])))  # replicas may share a bucket
    place, row = place[keep], row[keep]
    cuts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1], [True])))
    return [{"place": int(place[a]), "kind": "history", "h": h[row[a:b]], "seen": sums[0][row[a:b]], "lower": sums[1][row[a:b]], "count": sums[2][row[a:b]]}
            for a, b in zip(cuts[:-1], cuts[1:])]


def histories(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``h, c(h), alpha(h)`` of one bucket of histories, by h."""
    parts = pdf[pdf["kind"] == "history"]
    cat = lambda c, t: np.concatenate([np.asarray(x, dtype=t) for x in parts[c]] or [np.zeros(0, t)])
    h, back = np.unique(cat("h", np.int64), return_inverse=True)
    seen, lower, count = (np.bincount(back, cat(c, float), len(h)) for c in ("seen", "lower", "count"))
    with np.errstate(all="ignore"):
        return h, count, np.maximum(1 - seen / count, 1e-300) / np.maximum(1 - lower, 1e-300)


def back_off(pdf: pd.DataFrame) -> list[dict]:
    """What the uses of unseen pairs add to their documents: log10 of alpha(h), and c(h) given back."""
    h, count, alpha = histories(pdf)
    add = np.append(np.log10(alpha) + np.log10(np.maximum(count, 1)), 0.0)
    parts = pdf[pdf["kind"] == "use"]
    if not len(parts):
        return []
    cat = lambda c, t: np.concatenate([np.asarray(x, dtype=t) for x in parts[c]])
    own, doc = cat("h", np.int64), cat("doc", np.int64)
    at = np.minimum(np.searchsorted(h, own), max(len(h) - 1, 0))
    value = add[np.where(h[at] == own, at, len(h))] if len(h) else np.zeros(len(own))
    batches, number = np.unique(cat("batches", np.int64), return_inverse=True)
    keys, back = np.unique(np.repeat(number, cat("uses", np.int64)) << 32 | doc, return_inverse=True)
    score, doc = np.bincount(back, value, len(keys)), (keys & 0xFFFFFFFF).astype(np.int32)
    cuts = np.searchsorted(keys >> 32, np.arange(len(batches) + 1))
    return [{"place": -1, "kind": "more", "batch": int(x), "doc": doc[lo:hi], "score": score[lo:hi]} for x, lo, hi in zip(batches, cuts[:-1], cuts[1:])]


def finish(pdf: pd.DataFrame) -> pd.DataFrame:
    """The documents of one batch from all their parts."""
    head = pdf[pdf["kind"] == "head"].iloc[0]
    n = len(head["tokens"])
    score, base, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    for r in pdf[pdf["kind"] == "doc"].sort_values("place").itertuples():
        own = np.arange(n) if r.doc is None else np.asarray(r.doc)  # without numbers: all documents
        score[own] += np.asarray(r.score)[:n]
        base[own] += np.asarray(r.base)[:n]
        known[own] += np.asarray(r.known)[:n]
    for r in pdf[pdf["kind"] == "more"].itertuples():
        score[np.asarray(r.doc)] += np.asarray(r.score)
    tokens = np.asarray(head["tokens"], dtype=np.int64)
    total, words = int(head["total"]), int(head["words"])
    return pd.DataFrame({
        "doc_id": pd.array(np.asarray(head["ids"]), dtype="Int64").copy() if all(head["has_id"]) else pd.array(
            [i if k else None for i, k in zip(head["ids"], head["has_id"])], dtype="Int64"),
        "held_out": np.unpackbits(np.frombuffer(head["held"], np.uint8))[:n].astype(bool), "n_tokens": tokens, "n_known": known,
        "train_tokens": np.full(n, total, np.int64), "base_score": base - tokens * np.log10(total + words + 1), "score": score})


def _shared(cut: DataFrame, hot: np.ndarray, n_buckets: int, s: Settings) -> DataFrame:
    """One row a bucket with the summed counts of counts. They are as many numbers as ``count_columns``."""
    width = count_columns(hot, s)

    def stats(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"place": np.arange(width), "n": counts_of_counts(pdf, hot, s)})

    summed = cut.groupBy("bucket").applyInPandas(stats, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    summed = summed.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "n"))), lambda x: x["n"]).alias("sums"))
    return summed.select("sums", F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1))).alias("bucket"))


def store(docs: DataFrame, held_out: Column, n_buckets: int, path: str, s: Settings = Settings()) -> None:
    """The model as tables under ``path``, each partitioned by bucket: ``pairs`` (h, w, count, discounted),
    ``words`` (w, count, log10_p; w null: the class of unseen words) and ``histories`` (h, count,
    log10_alpha). Words and histories are named by ``token_digest``, END and START. Then P(w | h) is
    discounted / count(h) for a pair of the table, else alpha(h) * P(w)."""
    hot = hot_words(docs, s)
    cut = blocks(docs, held_out, hot, n_buckets, s)

    def rows(pdf: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "kind", "h", "w", "count", "value", "lower"]
        bucket, m = int(shared["bucket"].iat[0]), Counts.of(np.asarray(shared["sums"].iat[0]), hot, s)
        parts = []
        if len(pdf):
            b = Bucket(pdf, hot)
            c1 = b.c1.copy()
            c1[b.hot] = m.hot_counts[np.searchsorted(hot, b.words[b.hot])]
            seen, p1, here = np.flatnonzero(b.c2), m.p1(c1), np.flatnonzero((c1 > 0) & ~b.hot)
            parts.append(pd.DataFrame({"kind": "pair", "h": b.h[seen], "w": b.w[seen], "count": b.c2[seen], "value": discounted(b.c2[seen], m.pairs),
                                       "lower": p1[b.word[seen]]}))
            parts.append(pd.DataFrame({"kind": "word", "h": 0, "w": b.words[here], "count": c1[here], "value": np.log10(p1[here]), "lower": 0.0}))
        if bucket == 0:  # hot words are spread over buckets: one names them all, and the unseen class
            n = np.flatnonzero(m.hot_counts)
            parts.append(pd.DataFrame({"kind": "word", "h": 0, "w": hot[n], "count": m.hot_counts[n], "value": np.log10(m.p1(m.hot_counts[n])), "lower": 0.0}))
            parts.append(pd.DataFrame([{"kind": "unseen", "h": 0, "w": 0, "count": 0, "value": m.unseen, "lower": 0.0}]))
        parts = [x for x in parts if len(x)]
        if not parts:
            return pd.DataFrame(columns=columns)
        return pd.concat(parts, ignore_index=True).assign(bucket=bucket)[columns].astype({"h": np.int64, "w": np.int64, "count": np.int64})

    grouped = cut.groupBy("bucket").cogroup(_shared(cut, hot, n_buckets, s).groupBy("bucket"))
    made = written(grouped.applyInPandas(rows, "bucket int, kind string, h long, w long, count long, value double, lower double"), "katz-model")
    pairs = made.where("kind = 'pair'")
    pairs.select("bucket", "h", "w", "count", F.col("value").alias("discounted")).write.partitionBy("bucket").parquet(f"{path}/pairs")
    words = made.where("kind <> 'pair'").select("bucket", F.when(F.col("kind") == "word", F.col("w")).alias("w"), "count", F.col("value").alias("log10_p"))
    words.write.partitionBy("bucket").parquet(f"{path}/words")
    sums = pairs.groupBy("h").agg(F.sum("count").alias("count"), F.sum("value").alias("seen"), F.sum("lower").alias("lower"))
    alpha = F.log10((1 - F.col("seen") / F.col("count")) / (1 - F.col("lower")))
    sums.select(F.pmod(F.xxhash64("h"), F.lit(n_buckets)).cast("int").alias("bucket"), "h", "count", alpha.alias("log10_alpha")).write.partitionBy(
        "bucket").parquet(f"{path}/histories")


def bucket_count(docs: DataFrame, s: Settings = Settings()) -> int:
    """Buckets of words for about ``bucket_tokens`` tokens each, from the number of characters."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(s.least_buckets, int(chars / 6 / s.bucket_tokens) + 1)


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(docs: DataFrame, held_out: Column, n_buckets: int, s: Settings = Settings()) -> DataFrame:
    """Scores of every row of ``docs``; the model learns from those where ``held_out`` is false."""
    hot = hot_words(docs, s)
    cut = blocks(docs, held_out, hot, n_buckets, s)
    # One plan: both readings of the blocks, for counts and for scores, share one shuffle.
    shared = _shared(cut, hot, n_buckets, s)

    def score(pdf: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return _rows([])
        return _rows(score_bucket(pdf, np.asarray(shared["sums"].iat[0]), hot, n_buckets, s))

    parts = written(cut.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInPandas(score, _PART), "katz-parts")
    more = parts.where("place >= 0").groupBy("place").applyInPandas(lambda pdf: _rows(back_off(pdf)), _PART)
    mine = parts.where("place < 0").unionByName(more)
    return mine.groupBy("batch").applyInPandas(finish, RESULT)
