"""Benchmark decontamination by template canonicalisation.

Texts become template tokens: numbers (digits or number words), units beside numbers and
names (capitalised words inside a sentence, runs merged) are replaced by typed
placeholders, other words are lower-cased. A capitalised word that opens a sentence may be a name or not,
so texts are matched in two readings: opening words as plain words, and as names. Windows of template tokens of the benchmark
items are hash-joined with those of the documents. Matched windows on one diagonal (same
distance between document and item positions) form a line; its slots must be
consistent: each item value of a type stands for one document value throughout. Inserted or dropped words
move the diagonal, so neighbouring lines (``drift`` apart) that agree are added to the largest one. An
alignment that covers enough of an item is a leak, whether copied or re-parameterised, and so is one with ``run`` windows in
a row, whatever its share of the item. Pieces shorter than a window match nothing.

Only windows that may match leave a document's task: a bitmap of ``2**BITS`` flags over
the items' window hashes, of fixed size whatever the benchmark, is sent to the tasks; the
join then decides exactly.

Defined results: null, empty and word-free texts match nothing, nor do items of fewer than
``least`` template tokens; an item shorter than a window is one window of its own length;
repeated document rows give equal rows once; several items with one text all match; a
null doc_id is reported as null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import Interned, batches, digest64, written

BITS = 20

# Number words and units in the languages of the corpus.
NUMBER_WORDS = frozenset(
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion "
    "zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig hundert tausend "
    "deux trois quatre cinq sept huit neuf dix onze douze vingt cent mille "
    "dos tres cuatro cinco seis siete ocho nueve diez once doce veinte cien mil".split())
UNITS = frozenset(
    "% ° $ € £ mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs "
    "pound pounds ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour "
    "hours day days week weeks month months year years meter meters metre metres kilometer kilometers dollar dollars cent "
    "cents euro euros percent degree degrees mph kmh stunde stunden tag tage jahr jahre heure heures jour jours an ans hora "
    "horas día días año años".split())
PLAIN, NUMBER, UNIT, CAPITAL, STOP = range(5)
TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?\n:]|[%°$€£]")
_P = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NAMED = np.uint64(0xD6E8FEB86659FD93)  # parts the windows of the second reading from those of the first


@dataclass(frozen=True)
class Settings:
    window: int = 8
    least: int = 4  # template tokens below which an item matches nothing
    coverage: float = 0.4  # of an item's windows in one alignment
    drift: int = 16  # template tokens between neighbouring diagonals
    run: int = 43  # windows in a row (50 template tokens) that leak whatever their share


def _kind(token: str) -> int:
    low = token.lower()
    if token[0].isdigit() or low in NUMBER_WORDS:
        return NUMBER
    if token in ".!?\n:":
        return STOP
    if low in UNITS:
        return UNIT
    return CAPITAL if len(token) > 1 and token[0].isupper() and token[1:].islower() else PLAIN


class Templates:
    """Template hashes and slots of texts, with a bounded cache of token digests and kinds."""

    def __init__(self):
        self.cache = Interned(lambda t: (digest64(t.lower()) & ~7) | _kind(t), 600_000)
        self.marks = {k: np.uint64(digest64(f"<{k}>")) for k in (NUMBER, UNIT, CAPITAL)}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        """Hash and kind (PLAIN, or that of a slot) of every template token; the raw tokens; where each
        template token starts among them. Opening words are plain."""
        return self.readings(text)[0]

    def readings(self, text: str | None) -> list[tuple[np.ndarray, np.ndarray, list[str], np.ndarray]]:
        """``of``, and the same with opening capitalised words as names if there are any."""
        return self.read(TOKEN.findall(text or ""))

    def read(self, raw: list[str]) -> list[tuple[np.ndarray, np.ndarray, list[str], np.ndarray]]:
        """``readings`` of a list of tokens. Several texts may stand in it, each closed by a line feed: nothing reaches
        over one."""
        cache = self.cache
        code = np.fromiter([cache[t] for t in raw], np.uint64, len(raw))
        kind = (code & np.uint64(7)).astype(np.int8)
        before = np.concatenate(([STOP], kind[:-1])).astype(np.int8)
        opening = (kind == CAPITAL) & (before == STOP)
        out = [self._template(raw, code, kind, before, np.where(opening, PLAIN, kind))]
        if opening.any():
            out.append(self._template(raw, code, kind, before, kind))
        return out

    def _template(self, raw: list[str], code: np.ndarray, kind: np.ndarray, before: np.ndarray, slot: np.ndarray):
        after = np.concatenate((kind[1:], [STOP])).astype(np.int8)
        slot = np.where((kind == UNIT) & (before != NUMBER) & (after != NUMBER), PLAIN, slot)
        one_name = (slot == CAPITAL) & (np.concatenate(([PLAIN], slot[:-1])) == CAPITAL)
        at = np.flatnonzero((kind != STOP) & ~one_name)
        slot = slot[at]
        h = code[at] & ~np.uint64(7)
        for k, mark in self.marks.items():
            h = np.where(slot == k, mark, h)
        return h, slot, raw, at

    @staticmethod
    def value(raw: list[str], start: int, kind: int) -> str:
        """What fills the slot that starts at a raw token (a name is the whole run of names)."""
        if kind != CAPITAL:
            return raw[start].lower()
        end = start + 1
        while end < len(raw) and _kind(raw[end]) == CAPITAL:
            end += 1
        return " ".join(raw[start:end])

    def slots(self, raw: list[str], at: np.ndarray, kinds: np.ndarray, start: int, size: int) -> list[str]:
        return [f"{kinds[i]}{self.value(raw, at[i], kinds[i])}" for i in range(start, start + size) if kinds[i] != PLAIN]


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Digest of every window of ``size`` template tokens."""
    if len(h) < size or not size:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        out = out * _P + h[j:len(h) - size + 1 + j]
    out = (out ^ (out >> np.uint64(31))) * _MIX
    return out ^ (out >> np.uint64(29))


def item_windows(items: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``item_id, reading, size, n_windows, hash, item_pos, item_slots`` of every window of every item."""
    def run(frames):
        t = Templates()
        for pdf in batches(frames, 1000):
            rows = []
            for item, text in zip(pdf["item_id"].astype("Int64"), pdf["text"]):
                item = None if pd.isna(item) else int(item)
                for reading, (h, kinds, raw, at) in enumerate(t.readings(text)):
                    if len(h) < s.least:
                        continue
                    size = min(s.window, len(h))
                    w = windows(h, size) ^ (_NAMED * np.uint64(reading))
                    for pos, x in enumerate(w.view(np.int64).tolist()):
                        rows.append((item, reading, size, len(h) - size + 1, x, pos, t.slots(raw, at, kinds, pos, size)))
            if rows:
                yield pd.DataFrame(rows, columns=["item_id", "reading", "size", "n_windows", "hash", "item_pos", "item_slots"]).astype({"item_id": "Int64"})

    return items.select("item_id", "text").dropDuplicates().mapInPandas(
        run, "item_id long, reading int, size int, n_windows int, hash long, item_pos int, item_slots array<string>")


def document_windows(docs: DataFrame, sizes: list[int], flags: np.ndarray) -> DataFrame:
    """``doc_id, copy, hash, doc_pos, doc_slots`` of the windows whose flag is set, in both readings. ``copy``
    tells rows with one doc_id but different texts apart."""
    sent = docs.sparkSession.sparkContext.broadcast(flags)

    def run(frames):
        t, flags = Templates(), sent.value
        for pdf in batches(frames, 256):
            out: dict[str, list] = {k: [] for k in ("doc_id", "copy", "hash", "doc_pos", "doc_slots")}
            raw: list[str] = []  # the tokens of all texts, each closed by a line feed
            ends: list[int] = []
            for text in pdf["text"]:
                raw += TOKEN.findall(text or "")
                raw.append("\n")
                ends.append(len(raw))
            readings = t.read(raw)
            ids, copies = list(pdf["doc_id"].astype("Int64")), list(pdf["copy"])
            for reading in range(2):
                h, kinds, _, at = readings[min(reading, len(readings) - 1)]
                owner = np.searchsorted(ends, at, side="right")
                first = np.searchsorted(owner, np.arange(len(ids)))
                for size in sizes:
                    w = windows(h, size) ^ (_NAMED * np.uint64(reading))
                    inside = owner[:len(w)] == owner[len(owner) - len(w):]
                    hits = np.flatnonzero(flags[(w >> np.uint64(64 - BITS)).astype(np.int64)] & inside)
                    whose = owner[hits]
                    out["doc_id"] += [ids[i] for i in whose]
                    out["copy"] += [copies[i] for i in whose]
                    out["hash"] += w[hits].view(np.int64).tolist()
                    out["doc_pos"] += (hits - first[whose]).tolist()
                    out["doc_slots"] += [t.slots(raw, at, kinds, i, size) for i in hits.tolist()]
            if out["hash"]:
                yield pd.DataFrame(out).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("copy"), "text").mapInPandas(
        run, "doc_id long, copy long, hash long, doc_pos int, doc_slots array<string>")


def _one_way(slots: Column) -> Column:
    return F.size(slots) == F.size(F.array_distinct(F.transform(slots, lambda p: p["own"])))


def _longest(places: Column) -> Column:
    """Length of the longest run of consecutive numbers."""
    def step(a: Column, x: Column) -> Column:
        now = F.when(x == a["last"] + 1, a["now"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), now.alias("now"), F.greatest(a["best"], now).alias("best"))
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("now"), F.lit(0).alias("best"))
    return F.aggregate(F.array_sort(places), start, step, lambda a: a["best"])


def _joined(lines: Column) -> Column:
    """The largest line and, nearest first, all others of its chain that agree with what is joined so far."""
    def step(a: Column, x: Column) -> Column:
        slots = F.array_union(a["slots"], x["slots"])
        both = F.struct(F.array_union(a["places"], x["places"]).alias("places"), slots.alias("slots"))
        return F.when(_one_way(slots), both).otherwise(a)
    seed = F.array_max(lines)
    own = F.struct(seed["places"].alias("places"), seed["slots"].alias("slots"))
    near = F.array_sort(F.transform(lines, lambda x: F.struct(F.abs(x["shift"] - seed["shift"]).alias("far"), x["places"].alias("places"), x["slots"].alias("slots"))))
    return F.when(F.size(lines) == 1, own).otherwise(F.aggregate(near, own, step))


def _leaks(docs: DataFrame, items: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, copy, item_id, n, n_windows, slots`` of every alignment that is a leak."""
    of_items = written(item_windows(items, s), "template-windows")
    sizes = [r[0] for r in of_items.select("size").distinct().collect()]  # at most ``window`` values
    flag = F.shiftrightunsigned("hash", 64 - BITS).cast("int")
    flags = np.zeros(1 << BITS, bool)
    flags[[r[0] for r in of_items.select(flag).distinct().collect()]] = True  # at most 2**BITS values
    found = document_windows(docs, sizes, flags)
    pairs = found.join(of_items, "hash").where(F.size("doc_slots") == F.size("item_slots"))
    # One row for each line; a document that repeats a window sends it once per place.
    pairs = pairs.withColumn("slots", F.zip_with("item_slots", "doc_slots", lambda a, b: F.struct(a.alias("own"), b.alias("here"))))
    key = ["doc_id", "copy", "item_id", "reading", "n_windows"]
    same = F.col("doc_slots") == F.col("item_slots")
    lined = pairs.groupBy(*key, (F.col("doc_pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set("item_pos").alias("places"), F.collect_set(F.when(same, F.col("item_pos"))).alias("unchanged"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    lined = lined.withColumn("agrees", _one_way(F.col("slots")))
    # Lines that agree with themselves make chains; of the others a long unchanged run still counts.
    order = Window.partitionBy(*key, "agrees").orderBy("shift")
    lined = lined.withColumn("new", F.coalesce(~F.col("agrees") | (F.col("shift") - F.lag("shift").over(order) > s.drift), F.lit(True)).cast("long"))
    lined = lined.withColumn("chain", F.sum("new").over(order))
    line = F.struct(F.size("places").alias("n"), "shift", "places", "slots", "unchanged")
    chains = lined.groupBy(*key, "agrees", "chain").agg(F.collect_list(line).alias("lines"))
    alone = F.get("lines", F.lit(0))
    kept = F.filter(alone["slots"], lambda p: p["own"] == p["here"])
    rest = F.struct(alone["unchanged"].alias("places"), kept.alias("slots"))
    joined = chains.select(*key, "agrees", F.when(F.col("agrees"), _joined(F.col("lines"))).otherwise(rest).alias("got"))
    sized = joined.select(*key, "agrees", F.size("got.places").alias("n"), "got.places", "got.slots")
    long_run = F.when(F.col("n") >= s.run, _longest(F.col("places")) >= s.run).otherwise(False)
    covered = F.col("agrees") & (F.col("n") >= F.lit(s.coverage) * F.col("n_windows"))
    return sized.where(covered | long_run).select("doc_id", "copy", "item_id", "n", "n_windows", "slots")


def alignments(docs: DataFrame, items: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The best alignment of each leaking (document, item): ``doc_id, item_id, coverage, n_slots, n_changed``."""
    changed = F.size(F.filter("slots", lambda p: p["own"] != p["here"]))
    coverage = F.col("n") / F.col("n_windows")
    return _leaks(docs, items, s).groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct(coverage.alias("coverage"), F.size("slots").alias("n_slots"),
                          changed.alias("n_changed")), F.struct(coverage, "n", -changed)).alias("best")).select(
        "doc_id", "item_id", "best.coverage", "best.n_slots", "best.n_changed")


def decontaminated(docs: DataFrame, items: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns kept. Each row is decided by its own text, also
    where rows share a doc_id or have none."""
    leaking = _leaks(docs, items, s).select(F.col("doc_id").alias("leaking_id"), F.col("copy").alias("leaking_copy")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(leaking["leaking_id"]) & (F.xxhash64(docs["text"]) == leaking["leaking_copy"])
    return docs.join(leaking, same, "left_anti")
