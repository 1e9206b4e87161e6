"""Phrase collocations by multikey three-way quicksort of suffix pointers.

Texts become pieces and pieces words (``words_and_breaks``). A suffix is the up to ``longest``
words that begin at one place of a piece, cut before the first word that is rarer than
``least``: no frequent phrase crosses such a word.

1. One pass counts the words of each language and notes leading words (prefixes of two words
   and more) that are frequent inside a batch.
2. Another pass makes each batch's suffixes, joins equal ones into one with a weight, and sends
   them to buckets by a hash of their leading two words. Where those are too many for a bucket (a noted
   prefix), three, four or five leading words count, so that no bucket gets more than about ``HOT``
   distinct suffixes of one prefix. That list only plans the load.
3. A bucket sorts pointers to its suffixes by multikey three-way quicksort: partitions are split
   by the word at their depth into smaller, equal and larger, equal ones go one word deeper. The weight
   of an equal partition is the count of the phrase that its suffixes share, and a partition lighter
   than ``least`` is abandoned, as all phrases in it are complete in this bucket. Where a bucket holds a
   part of a prefix only, the partial counts are kept and added up over buckets.

Suffixes travel as sorted columns, compressed, with the words they use once for each batch and bucket.
All partitions of one depth or another are split together, in numpy, one comparison a pointer and
round, so a bucket costs about its pointers times the entropy of their words.

Counts cover all documents and are exact: hashes only choose buckets or let a rare word pass the
screen. Memory: a batch (``CHUNK`` characters), a bucket (``BUCKET`` words of the table on average; a prefix of up to
``HOT`` more), the screen of frequent words (2 MB, a bit for each hash) and at most 4 * ``PARTS`` noted prefixes are all
that a task holds.

Defined results: null texts are empty, a null language is ``und``; empty tables give no rows; repeated rows
count each; equal scores are ranked by count and phrase; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

LEAST, LONGEST = 100, 5
CHUNK = 4_000_000  # bytes of text in a batch
BUCKET = 500_000  # words of the table for each bucket
HOT, PARTS = 250_000, 100_000  # a prefix is split beyond HOT occurrences and a PARTS-th of all words
NOTED = 200_000  # a batch notes prefixes above this part of its words
BITS = 24  # of the hashes in the screen

_BREAKS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)


def words_and_breaks(texts: list[str | None]) -> list[bytes]:
    """All words of the texts, A-Z lower-cased, with ``.`` between pieces and behind each text."""
    raw = "\n".join([*[t or "" for t in texts], ""]).encode("utf-8", "surrogatepass")
    return raw.lower().translate(_BREAKS).replace(b".", b" . ").split()


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, list[str | None]]]:
    """Texts of one language at a time, about ``CHUNK`` bytes together."""
    held: dict[str, list] = {}
    size: dict[str, int] = {}
    for pdf in frames:
        for lang, text in zip(pdf["lang"], pdf["text"]):
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text or "")
            if size[lang] > CHUNK or sum(size.values()) > 2 * CHUNK:
                full = max(size, key=size.get)
                del size[full]
                yield full, held.pop(full)
    yield from held.items()


class Batch:
    """Numbered words of a batch: 0 is a break, words count from 1."""

    def __init__(self, texts: list[str | None]):
        listed = words_and_breaks(texts)
        codes, names = pd.factorize(np.array([b".", *listed], dtype=object))
        self.codes, self.names = codes.astype(np.int64)[1:], names
        self.n_words = int((self.codes > 0).sum())

    def keep_only(self, kept: np.ndarray) -> None:
        """Words that are not kept become breaks; the others are numbered anew."""
        kept[0] = False
        number = np.where(kept, np.cumsum(kept), 0)
        self.codes, self.names = number[self.codes], np.concatenate(([b"."], self.names[kept]))

    def prefixes(self, longest: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Suffixes of two words and more: (n, longest) word numbers, 0 behind their end; the
        number of each suffix's prefix of every length from 2, and the keys that these number."""
        padded = np.concatenate((self.codes, np.zeros(longest, np.int64)))
        columns = [padded[j:j + len(self.codes)].copy() for j in range(longest)]
        for a, b in zip(columns, columns[1:]):
            b[a == 0] = 0
        at = np.flatnonzero(columns[1])
        rows = np.stack([c[at] for c in columns], axis=1) if len(at) else np.zeros((0, longest), np.int64)
        numbers, keys = [], []
        last = rows[:, 0]
        for j in range(1, longest):
            code, key = pd.factorize(last * len(self.names) + rows[:, j])
            numbers.append(code)
            keys.append(key)
            last = code.astype(np.int64)
        return rows, numbers, keys


def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words of each batch with their counts, and prefixes that are frequent in it."""
    for lang, texts in _batches(frames):
        batch = Batch(texts)
        if not batch.n_words:
            continue
        n = np.bincount(batch.codes, minlength=len(batch.names))[1:]
        names = [w.decode("utf-8", "surrogatepass") for w in batch.names[1:]]
        yield pd.DataFrame({"lang": lang, "phrase": names, "size": np.int32(1), "n": n.astype(np.int64)})
        floor = max(16, batch.n_words // NOTED)
        batch.keep_only(np.concatenate(([False], n >= floor)))
        rows, numbers, _ = batch.prefixes(LONGEST - 1)
        for j, code in enumerate(numbers):
            size = np.bincount(code)
            first = np.zeros(len(size), np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            heavy = first[(size >= floor)]
            heavy = heavy[rows[heavy, j + 1] > 0] if len(heavy) else heavy
            if len(heavy):
                names = [b" ".join(batch.names[r[:j + 2]]).decode("utf-8", "surrogatepass") for r in rows[heavy]]
                yield pd.DataFrame({"lang": lang, "phrase": names, "size": np.int32(j + 2), "n": size[code[heavy]].astype(np.int64)})


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), seed=42)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def dealt(screen: np.ndarray, hot: dict[str, list[bytes]], buckets: int):
    """The function that turns texts into weighted suffixes by bucket."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for lang, texts in _batches(frames):
            batch = Batch(texts)
            seed = _seed(lang)
            h = np.fromiter((xxhash.xxh64_intdigest(w, seed=seed) for w in batch.names), np.uint64, len(batch.names))
            bit = (h & np.uint64((1 << BITS) - 1)).astype(np.int64)
            kept = (screen[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) > 0
            batch.keep_only(kept)
            h = np.concatenate((np.zeros(1, np.uint64), h[kept]))  # keep_only has cleared the break
            rows, numbers, keys = batch.prefixes(LONGEST)
            if not len(rows):
                continue
            weight = np.bincount(numbers[-1])
            first = np.zeros(len(weight), np.int64)
            first[numbers[-1][::-1]] = np.arange(len(rows))[::-1]
            depth = _depths(batch, rows, numbers, keys, hot.get(lang, []))[first]
            rows = rows[first]
            route = np.full(len(rows), np.uint64(seed))
            for j in range(LONGEST):
                step = (route ^ h[rows[:, j]]) * _MIX
                route = np.where(j < depth, step ^ (step >> np.uint64(29)), route)
            bucket = (route % np.uint64(buckets)).astype(np.int64)
            v = len(batch.names)
            order = np.lexsort((rows[:, 3] * v + rows[:, 4], rows[:, 1] * v + rows[:, 2], rows[:, 0], bucket))
            ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
            out = []
            for a, b in zip([0, *ends[:-1]], ends):
                part = order[a:b]
                used, local = np.unique(np.append(rows[part].ravel(), 0), return_inverse=True)
                small = np.uint16 if len(used) < 1 << 16 else np.uint32
                by_column = local[:-1].reshape(-1, LONGEST).T.astype(small)
                packed = [x.tobytes() for x in (by_column, weight[part].astype(np.uint32), depth[part].astype(np.uint8))]
                out.append((int(bucket[part[0]]), lang, pack(b" ".join(batch.names[used])), *map(pack, packed)))
            yield pd.DataFrame(out, columns=["bucket", "lang", "names", "rows", "weights", "depths"])

    return run


def _depths(batch: Batch, rows: np.ndarray, numbers: list, keys: list, hot: list[bytes]) -> np.ndarray:
    """How many leading words route each suffix: two, or one more than its longest hot prefix."""
    depth = np.full(len(rows), 2)
    place = {w: i for i, w in enumerate(batch.names)}
    known = [ids for ids in ([place.get(w, 0) for w in p.split(b" ")] for p in hot) if all(ids)]
    index = [pd.Index(k) for k in keys[:-1]] if known else []
    for j in range(LONGEST - 2):  # prefixes of j + 2 words
        ids = np.array([x for x in known if len(x) == j + 2], np.int64).reshape(-1, j + 2)
        if not len(ids):
            continue
        last = ids[:, 0]
        for i in range(1, j + 2):
            last = np.where(last < 0, -1, index[i - 1].get_indexer(last * len(batch.names) + ids[:, i]))
        flag = np.zeros(len(keys[j]) + 1, bool)
        flag[last] = True
        flag[-1] = False  # -1: not in this batch
        depth = np.where(flag[numbers[j]] & (depth == j + 2), j + 3, depth)
    return depth


def quicksorted(rows: np.ndarray, weight: np.ndarray, depths: np.ndarray, least: int, rng) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Multikey three-way quicksort of pointers to ``rows``; (one pointer, weight, words) of each equal partition
    of two words and more that weighs ``least``, or that may have further parts elsewhere."""
    found: list[tuple[np.ndarray, np.ndarray, int]] = []
    longest = rows.shape[1]
    columns = [np.ascontiguousarray(rows[:, j]) for j in range(longest)]
    split_somewhere = bool((depths > 2).any())
    for depth in range(longest):
        if depth == 0:
            pointers, sizes = np.arange(len(rows)), np.array([len(rows)])
            deeper: list[tuple[np.ndarray, np.ndarray]] = []
        else:
            pointers = np.concatenate([p for p, _ in deeper]) if deeper else np.zeros(0, np.int64)
            sizes = np.concatenate([s for _, s in deeper]) if deeper else np.zeros(0, np.int64)
            deeper = []
        word = columns[depth]
        while len(sizes):
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            pivot = word[pointers[starts + (rng.random(len(sizes)) * sizes).astype(np.int64)]]
            seen, part = word[pointers], np.repeat(np.arange(len(sizes)), sizes)
            side = np.sign(seen - pivot[part])
            next_pointers, next_sizes = [], []
            for way in (-1, 0, 1):
                at = np.flatnonzero(side == way)
                if not len(at):
                    continue
                mine, owner = pointers[at], part[at]  # still grouped by partition
                size = np.bincount(owner, minlength=len(sizes))
                heavy = np.bincount(owner, weight[mine], len(sizes)) >= least
                if split_somewhere:  # a prefix that other buckets share is never abandoned
                    partial = np.zeros(len(sizes), bool)
                    partial[owner[depths[mine] > depth + 1]] = True
                    heavy |= partial
                if way == 0:
                    heavy &= pivot > 0  # suffixes that end here share no longer phrase
                live = heavy[owner]
                mine, size = mine[live], size * heavy
                if way:
                    next_pointers.append(mine)
                    next_sizes.append(size[size > 0])
                elif len(mine):
                    deeper.append((mine, size[size > 0]))
                    if depth:
                        ends = np.cumsum(size[size > 0])
                        total = np.add.reduceat(weight[mine], np.concatenate(([0], ends[:-1])))
                        found.append((mine[ends - 1], total, depth + 1))
            pointers = np.concatenate(next_pointers) if next_pointers else np.zeros(0, np.int64)
            sizes = np.concatenate(next_sizes) if next_sizes else np.zeros(0, np.int64)
    return found


def bucket_phrases(least: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        names: dict[bytes, int] = {b".": 0}
        rows = []
        for listed, raw in zip(pdf["names"], pdf["rows"]):
            words = unpack(listed).split(b" ")
            own = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
            local = np.frombuffer(unpack(raw), np.uint16 if len(words) < 1 << 16 else np.uint32)
            rows.append(own.astype(np.int32)[local].reshape(LONGEST, -1).T)
        weight = np.concatenate([np.frombuffer(unpack(w), np.uint32) for w in pdf["weights"]]).astype(np.int64)
        depths = np.concatenate([np.frombuffer(unpack(d), np.uint8) for d in pdf["depths"]])
        rows = np.concatenate(rows)
        word = np.array(list(names), dtype=object)
        out = [(b" ".join(word[rows[p, :k]]).decode("utf-8", "surrogatepass"), k, int(n))
               for at, total, k in quicksorted(rows, weight, depths, least, np.random.default_rng(int(key[0])))
               for p, n in zip(at, total)]
        out = [(key[1], *r) for r in out]
        return pd.DataFrame(out, columns=["lang", "phrase", "size", "n"]).astype({"lang": object, "phrase": object, "size": np.int32, "n": np.int64})

    return run


COUNTS = "lang string, phrase string, size int, n long"
PARTED = "bucket int, lang string, names binary, rows binary, weights binary, depths binary"


def frequencies(docs: DataFrame, least: int = LEAST, hot: int = HOT, per_bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of 1 to 5 words that occur ``least`` times, and (lang, n) of all words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counts = written(texts.mapInPandas(counted, COUNTS).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")), "phrase-words")
    words = counts.where("size = 1")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    everything = words.agg(F.sum("n")).first()[0] or 0
    often = words.where(F.col("n") >= least)
    screen = np.zeros(1 << (BITS - 6), np.uint64)
    bit = F.xxhash64("lang", "phrase").bitwiseAND(F.lit((1 << BITS) - 1))
    cells = often.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits"))
    for r in cells.toLocalIterator():  # at most 2^18 rows
        screen[r["cell"]] = np.uint64(r["bits"] & ((1 << 64) - 1))
    limit = max(hot, everything // PARTS)
    crowded: dict[str, list[bytes]] = {}
    for r in counts.where((F.col("size") > 1) & (F.col("n") > limit)).select("lang", "phrase").toLocalIterator():
        crowded.setdefault(r["lang"], []).append(r["phrase"].encode("utf-8", "surrogatepass"))
    buckets = max(64, -(-everything // per_bucket))
    suffixes = texts.mapInPandas(dealt(screen, crowded, buckets), PARTED)
    found = suffixes.groupBy("bucket", "lang").applyInPandas(bucket_phrases(least), COUNTS)
    longer = found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return written(often.unionByName(longer), "phrase-counts"), totals


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates (two words and more) with the cut that scores lowest: a, l, r, n, score.

    Products are decimals of 38 digits: exact while counts are below 10^15 and all words of a language below 10^18."""
    part = counts.select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    cuts = counts.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")).withColumn(
        "right", F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "))
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    score = F.expr("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(18, 0)))")
    cuts = cuts.withColumn("score", score.cast("long"))
    return cuts.groupBy("lang", "phrase", "size").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")).select(
        "lang", "phrase", "size", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def maximal(found: DataFrame) -> DataFrame:
    """Without phrases that stand inside a longer one as often. A longer phrase is never more frequent than a part of
    it, so all phrases between the two are as frequent too, and those one word longer decide."""
    words = F.split("phrase", " ")
    inner = F.array(F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " "))
    covers = found.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    covers = covers.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = found.join(covers, ["lang", "phrase"], "left")
    return kept.where(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).drop("longer")


def collocations(docs: DataFrame, first: int = 2000, least: int = LEAST, hot: int = HOT, per_bucket: int = BUCKET) -> DataFrame:
    """Each language's ``first`` phrases by score, count and phrase."""
    counts, totals = frequencies(docs, least, hot, per_bucket)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = maximal(scored(counts, totals)).withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
