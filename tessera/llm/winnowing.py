"""Document fingerprints by winnowing, in DataFrame functions only.

A text becomes words: lower-cased runs free of white space and punctuation, and single
characters of scripts written without spaces. Every ``k`` neighbouring words have one rolling
hash, a cyclic polynomial over the words' 64-bit hashes: the hash of a longer run is that of
its first part, rotated by the length of the second, xor that of the second, so k-grams come
from about log2(k) passes over the text. In every window of ``w`` neighbouring k-grams the
smallest hash is chosen (by its upper 35 bits), the rightmost of equal ones; chosen hashes are kept
once for each place, with that place. Two texts that share ``guarantee(k, w)`` words in a row therefore share
a chosen hash, and a shared run of fewer than ``k`` words is never found (but by a collision).

Work and memory are linear in a text; a text is one row and handled by one task. Nothing
compares all documents: the next document of each is found in ranges of keys, to which the
texts are shuffled once.

Defined results: null texts are empty; a text without words has no fingerprint (an empty list),
one of fewer than ``k`` words a single hash of them all, one of fewer than ``w`` k-grams a single
window. Equal texts have equal fingerprints. Two fingerprints without hashes are alike to 1, one
with and one without to 0. Order of documents: descending doc_id, null last; rows of one doc_id
by a hash of their texts. Rows that repeat both doc_id and text are one document and give one row
(``copies`` counts them). A single document is its own next. Other columns are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

K, W = 5, 8  # words of a gram, grams of a window
MOST_RANGES = 1 << 16  # of the key order

PLACE_BITS = 29  # of a place in a text; hashes are compared by their other, upper bits

#: Blocks of scripts written without spaces (Thai and Lao, Myanmar, Khmer, kana, Han): each character counts as a word.
UNSPACED = r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
SPACED_WORD = r"[^\s\p{Z}\p{P}]+"
WORD = rf"[{UNSPACED}&&[^\p{{P}}]]|[^\s\p{{Z}}\p{{P}}{UNSPACED}]+"


def guarantee(k: int = K, w: int = W) -> int:
    """Two texts that share so many words in a row share a chosen hash."""
    return k + w - 1


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _behind(items: Column, n: int) -> Column:
    return F.slice(items, n + 1, F.size(items))


def _turned(h: Column, n: int) -> Column:
    """``h`` rotated left by ``n`` bits."""
    n %= 64
    return F.shiftleft(h, n).bitwiseOR(F.shiftrightunsigned(h, 64 - n)) if n else h


def word_hashes(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    found = lambda pattern: F.regexp_extract_all(low, F.lit(pattern), F.lit(0))
    words = F.when(text.rlike(f"[{UNSPACED}]"), found(WORD)).otherwise(found(SPACED_WORD))  # the second is the first without such characters
    return F.transform(words, lambda w: F.xxhash64(w))


def gram_hashes(words: Column, k: int = K) -> Column:
    """Rolling hashes of all runs of ``k`` word hashes; null where a run passes the end."""
    if k == 1:
        return words
    a, b = k - k // 2, k // 2
    join = lambda left, right: F.zip_with(left, _behind(right, a), lambda x, y: _turned(x, b).bitwiseXOR(y))
    if a == b:
        return let(gram_hashes(words, a), lambda g: join(g, g))
    # An odd run: one word more than twice the half.
    twice = let(gram_hashes(words, b), lambda g: F.zip_with(g, _behind(g, b), lambda x, y: _turned(x, b).bitwiseXOR(y)))
    return F.zip_with(twice, _behind(words, 2 * b), lambda x, y: _turned(x, 1).bitwiseXOR(y))


def chosen(grams: Column, w: int = W) -> Column:
    """Winnowing: (hash, place) of each window's smallest hash, rightmost of equals, in order of place.

    A gram's rank is its hash with the lowest bits replaced by its place, counted backwards, so the
    least rank of a window is the rightmost of its smallest hashes."""
    low = (1 << PLACE_BITS) - 1
    ranks = F.transform(grams, lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR((F.lit(low) - i).cast("long")))

    def over(n: int) -> Column:
        """Minima of windows of n grams: of two windows half as long, which may overlap."""
        if n == 1:
            return ranks
        half = 1 << ((n - 1).bit_length() - 1)
        return let(over(half), lambda m: F.zip_with(m, _behind(m, n - half), lambda x, y: F.least(x, y)))

    def once(m: Column) -> Column:
        return F.filter(F.zip_with(m, _behind(m, 1), lambda x, y: F.when(y.isNull() | (x != y), x)), lambda x: x.isNotNull())

    windows = let(over(w), lambda m: F.slice(m, 1, F.greatest(F.size(m) - (w - 1), F.least(F.size(m), F.lit(1)))))
    place = lambda x: (F.lit(low) - x.bitwiseAND(F.lit(low))).cast("int")
    return F.transform(let(windows, once), lambda x: F.struct(F.get(grams, place(x)).alias("hash"), place(x).alias("place")))


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """The chosen (hash, place) pairs of a text."""
    whole = lambda t: F.when(F.size(t) == 0, t).otherwise(F.array(F.xxhash64(F.concat_ws(" ", F.transform(t, lambda h: h.cast("string"))))))
    grams = let(word_hashes(text), lambda t: F.when(F.size(t) < k, whole(t)).otherwise(
        F.slice(gram_hashes(t, k), 1, F.greatest(F.size(t) - (k - 1), F.lit(0)))))
    return let(grams, lambda g: chosen(g, w))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes of two fingerprints as a part of all their hashes, 0 to 1."""
    return let(F.struct(F.transform(a, lambda x: x["hash"]).alias("a"), F.transform(b, lambda x: x["hash"]).alias("b")), lambda p: let(
        F.size(F.array_union(p["a"], p["b"])), lambda n: F.when(n == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(p["a"], p["b"])) / n)))


def as_text(print_: Column) -> Column:
    """A fingerprint as ``hash@place`` in hexadecimal, divided by spaces."""
    return F.array_join(F.transform(print_, lambda x: F.concat(F.hex(x["hash"]), F.lit("@"), F.hex(x["place"]))), " ")


def _key(doc_id: Column, text: Column) -> Column:
    """Ascending in the order of documents: descending doc_id, null last, then a hash of the text."""
    back = F.bitwise_not(F.coalesce(doc_id.cast("long"), F.lit(-1)))
    return F.struct(doc_id.isNull().cast("int").alias("unnamed"), back.alias("back"), F.xxhash64(text).alias("digest"))


def _range_starts(keys: DataFrame, ranges: int) -> list[tuple[int, int, int]]:
    """The first key of each of about ``ranges`` ranges of like size, in order: all that reaches the driver."""
    dealt = keys.select("key").repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("range")).agg(F.min("key").alias("key"))
    return sorted(tuple(r["key"]) for r in dealt.collect())


def _starts(starts: list[tuple[int, int, int]]) -> Column:
    """The ordered starts as one constant."""
    rows = json.dumps([dict(zip(("unnamed", "back", "digest"), s)) for s in starts])
    return F.from_json(F.lit(rows), "array<struct<unnamed:int,back:bigint,digest:bigint>>")


def _range_of(key: Column, starts: list[tuple[int, int, int]]) -> Column:
    """Number of the range a key belongs to, by binary search in the ordered starts."""
    listed = _starts(starts)
    steps = [1 << i for i in range(len(starts).bit_length() - 1, -1, -1)]
    reach = lambda at, step: (at + step < len(starts)) & (F.get(listed, at + step) <= key)
    return F.aggregate(F.array(*[F.lit(n) for n in steps]), F.lit(0), lambda at, step: F.when(reach(at, step), at + step).otherwise(at))


def with_next(docs: DataFrame, columns: dict[str, Column], per_range: int = 2000) -> DataFrame:
    """One row for each document: ``doc_id``, ``text``, ``copies`` and ``columns`` computed from its text, with
    ``next_text`` and ``next_<column>`` of the next document.

    Ranges of keys hold about ``per_range`` documents each (more beyond ``MOST_RANGES`` ranges, whose starts are
    all that is sent to every task). Texts are shuffled once, by range; the first document of a
    range is sent to the range before it too. Copies of a row that are many are joined into one before.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", _key(F.col("doc_id"), F.col("text")).alias("key"))
    keys = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies")), "winnow-keys")
    n = keys.count()
    starts = _range_starts(keys, max(1, min(MOST_RANGES, -(-n // per_range))))
    many = keys.where(F.col("copies") > F.lit(max(1000, n // 100_000)))  # under 100,000 keys, whatever the table
    single = rows.withColumn("copies", F.lit(1).cast("long"))
    if not many.isEmpty():
        joined = rows.join(F.broadcast(many), "key").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("text").alias("text"), F.max("copies").alias("copies"))
        single = single.join(F.broadcast(many.select("key")), "key", "left_anti").unionByName(joined)
    starts = starts or [(0, 0, 0)]
    listed = single.withColumn("range", _range_of(F.col("key"), starts))
    ahead = F.when(F.col("range") == 0, F.lit(len(starts) - 1)).otherwise(F.col("range") - 1)
    place = lambda r, extra: F.struct(r.alias("range"), F.lit(extra).alias("extra"))
    here, there = place(F.col("range"), False), place(ahead, True)
    heads = F.get(_starts(starts), F.col("range")) == F.col("key")
    dealt = listed.withColumn("at", F.explode(F.when(heads, F.array(here, there)).otherwise(F.array(here)))).select("doc_id", "text", "key", "copies", "at.*")
    order = Window.partitionBy("range").orderBy("extra", "key")
    first = F.lag("key").over(order).isNull() | (F.lag("key").over(order) != F.col("key")) | (F.lag("extra").over(order) != F.col("extra"))
    one = dealt.withColumn("first", first).withColumn("copies", F.sum("copies").over(Window.partitionBy("range", "extra", "key"))).where("first")
    one = one.select("doc_id", "text", "copies", "range", "extra", "key", *[c.alias(n) for n, c in columns.items()])
    after = [F.lead(n).over(order).alias(f"next_{n}") for n in ("text", *columns)]
    return one.select("*", *after).where(~F.col("extra")).drop("range", "extra", "key")


def edited(text: Column, other: Column) -> Column:
    """``text`` with the last half of its code points (rounded down) replaced by the first as many of ``other``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(other, F.lit(1), half))


def compared(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and the likenesses."""
    rows = with_next(docs, {"own": fingerprint(F.col("text"), k, w)}).withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
                       "own", fingerprint(F.col("edited_text"), k, w).alias("changed"), F.col("next_own").alias("behind"), "copies")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("behind")).alias("near_next"), "copies")
