"""Conversation structure repair: a cheapest sequence of edits, by rank-convergence parallel Viterbi.

The rows of a conversation, by turn, are edited until the initials of their roles read
``(s?(ua)+)?``. Keep costs nothing, Rerole to user or assistant 3, Delete 4 (required for blank and
duplicate rows), Insert an empty user or assistant row 3; a truncated row that stays adds 3.

States say which initial came last (none, s, u, a). A conversation is cut into chunks of rows; in
every chunk costs to the end are followed backwards, from a speculative vector (all states alike)
where the true one is not known yet. Costs matter up to a constant only: where two vectors come to
differ by a constant, all before them agree too (their rank has converged). So fix-up passes rerun a
chunk from its follower's vector only where that differs from the one it was run from by more than a
constant, and only until the vectors differ by one; passes end when no chunk is left. A conversation
has at most ``CHUNKS`` chunks, however long, so there are at most as many passes (two, as a rule). With
the stitched costs each chunk traces its edits from every state it may begin in, taking the
ASCII-least edit that stays cheapest; chaining these maps over a conversation's chunks says which
trace holds.

A conversation's rows are never gathered: equal rows are counted before they meet, places come from
ranges of the sorted rows, chunks hold ``CHUNK`` rows (a ``CHUNKS``-th of a longer conversation), one small
number for each. Only the thin digests of ``summary`` need one row for a conversation.

Defined results: null roles and texts are one space, a null turn sorts first and is named by one space in
the damage, a null conv_id is a conversation of its own. Rows of one turn are ordered by role and the SHA-256 of their text
(of equal rows the first counts as seen first). A row's first fault counts (blank, duplicate, truncated). A role's initial is its first
character; one other than s, u, a can only be reroled or deleted. An empty role has no initial. Empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

CHUNK, CHUNKS = 64, 64  # rows of a chunk at least; chunks of a conversation at most
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
FAR = 1 << 40  # no way to the end

NONE, S, U, A = range(4)
#: State reached by a row of each role.
AFTER = {NONE: {S: S, U: U}, S: {U: U}, U: {A: A}, A: {U: U}}
#: The role that Rerole and Insert give in each state (system rows can only be kept).
GIVEN = {NONE: U, S: U, U: A, A: U}
END = (0, FAR, FAR, 0)
BLANK = r"^[\x20\x09-\x0D]*$"
WHOLE = r"[.!?][\x20\x09-\x0D]*$"


# ---------------------------------------------------------------- rows

def damaged(rows: DataFrame) -> DataFrame:
    """Every twentieth-part fault by crc32 of ``conv_id:turn``: 0 drops, 1 empties, 2 loses ``[.!?]``, 3 repeats, 4 makes a user."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       (F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).cast("long")
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), copies.alias("copies"))


KEY = ["conv_id", "turn", "role", "digest"]


def digested(rows: DataFrame) -> DataFrame:
    """The rows that are there, with the SHA-256 of their text."""
    return rows.where("copies > 0").withColumn("digest", F.unhex(F.sha2("text", 256)))


def entries(rows: DataFrame) -> DataFrame:
    """Equal rows as one entry with ``copies``: whether it is blank, the first of its role and text, or truncated.
    Texts stay behind: a digest stands for them."""
    same = digested(rows).groupBy(*KEY).agg(F.sum("copies").alias("copies"), F.max(F.col("text").rlike(BLANK)).alias("blank"),
                                            F.max(F.col("text").rlike(WHOLE)).alias("whole"))
    # The first turn of each role and text, marked on the entry of that turn.
    turn = F.struct(F.col("turn").isNotNull().alias("named"), "turn")
    no = F.lit(False)
    first = same.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("at")).select(
        "conv_id", "at.turn", "role", "digest", F.lit(0).cast("long").alias("copies"), no.alias("blank"), no.alias("whole"), F.lit(True).alias("first"))
    both = same.withColumn("first", no).unionByName(first)
    out = both.groupBy(*KEY).agg(F.sum("copies").alias("copies"), *[F.max(c).alias(c) for c in ("blank", "whole", "first")])
    return out.withColumn("cut", ~F.col("blank") & F.col("first") & ~F.col("whole")).drop("whole")


def placed(rows: DataFrame) -> DataFrame:
    """Entries with their ``place`` in the conversation (from 0) and the conversation's number of entries, ``size``.
    Rows are sorted by range; ranges of one conversation add up."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    dealt = written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "repair-rows")
    sizes = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("here"))
    conv = Window.partitionBy("conv_id")
    sizes = sizes.select("part", F.struct("conv_id").alias("conv"), F.sum("here").over(conv).alias("size"),
                         (F.sum("here").over(conv.orderBy("part")) - F.col("here")).alias("before"))
    inside = Window.partitionBy("part", "conv").orderBy(*order[1:])
    ranked = dealt.withColumn("conv", F.struct("conv_id")).withColumn("inside", F.row_number().over(inside) - 1)
    return ranked.join(sizes, ["part", "conv"]).withColumn("place", F.col("before") + F.col("inside")).drop("part", "conv", "inside", "before")


def chunked(rows: DataFrame, chunk: int = CHUNK, chunks: int = CHUNKS) -> DataFrame:
    """One row for each chunk: codes of its entries in order and how many deletions each requires.

    A code is 0 for an entry without a row to decide on, else 1 + 2 * role + truncated (role: 0 other, S, U, A).
    Required deletions come first in their place: they cost the same wherever rows are inserted, and D is the
    least letter. ``initials`` and ``copies`` tell which neighbours are illegal."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(0)
    live = F.col("first") & ~F.col("blank")
    code = F.when(live, 1 + 2 * role + F.col("cut").cast("int")).otherwise(0)
    length = F.greatest(F.lit(chunk), F.ceil(F.col("size") / chunks))
    cell = F.struct("place", code.alias("code"), (F.col("copies") - live.cast("long")).alias("deletes"), initial.alias("initial"), "copies")
    out = rows.groupBy("conv_id", F.floor(F.col("place") / length).cast("long").alias("chunk")).agg(
        F.sort_array(F.collect_list(cell)).alias("cells"), F.max(F.floor((F.col("size") - 1) / length)).cast("long").alias("last"))
    return out.select("conv_id", "chunk", "last", F.col("cells")[0]["place"].alias("place"), "cells.code", "cells.deletes",
                      "cells.initial", "cells.copies")


# ---------------------------------------------------------------- costs

def settled(v: list[int]) -> list[int]:
    """Costs that allow for insertions here: at most one more row reaches any state, two close a pair."""
    out = list(v)
    for _ in range(2):
        out = [min(out[q], INSERT + out[GIVEN[q]]) for q in range(4)]
    return out


def decided(v: tuple[int, ...], code: int) -> list[int]:
    """Costs in front of a row that is kept, reroled or deleted at once, from those behind it."""
    role, cut = (code - 1) >> 1, (code - 1) & 1
    return [min((v[AFTER[q][role]] if role in AFTER[q] else FAR) + CUT * cut, REROLE + CUT * cut + v[GIVEN[q]], DELETE + v[q]) for q in range(4)]


def shape(v: list[int]) -> tuple[int, ...]:
    """The vector up to a constant; states without a way stay so."""
    least = min(v)
    return tuple(min(x - least, FAR) for x in v)


_STEP: dict[tuple[tuple[int, ...], int], tuple[int, ...]] = {}


def step(v: tuple[int, ...], code: int) -> tuple[int, ...]:
    """The shape in front of a row, insertions allowed; there are few shapes, so each step is worked out once."""
    if not code:
        return v
    if (v, code) not in _STEP:
        _STEP[v, code] = shape(settled(decided(v, code)))
    return _STEP[v, code]


START = shape(settled([0, 0, 0, 0]))  # speculative: all states alike
FINAL = shape(settled(list(END)))


def run_back(codes, v: tuple[int, ...], before: tuple[int, ...] | None = None, result: tuple[int, ...] | None = None) -> tuple[int, ...]:
    """The shape in front of a chunk, run from ``v`` behind it. With the ``result`` of an earlier run from ``before``,
    only until the two runs' vectors differ by a constant."""
    for code in reversed(codes):
        if v == before:
            return result
        v = step(v, code)
        if before is not None:
            before = step(before, code)
    return result if v == before else v


def trace(codes, v: tuple[int, ...], state: int) -> tuple[list[str], list[str], int]:
    """Cheapest edits of a chunk from ``state``, ASCII-least of equals: the rows inserted before each entry's row and
    the edit of that row, in letters; then the state behind the chunk. ``v``: the shape behind it."""
    behind = [v]
    for code in reversed(codes):
        behind.append(step(behind[-1], code))
    behind.reverse()
    inserted: list[str] = []
    edits: list[str] = []
    for i, code in enumerate(codes):
        rows = ""
        if code:
            after = behind[i + 1]
            role, cut = (code - 1) >> 1, (code - 1) & 1
            full = settled(decided(after, code))  # of this place, on the scale of the costs behind it
            while True:
                if DELETE + after[state] == full[state]:
                    edits.append("D")
                    break
                if INSERT + full[GIVEN[state]] == full[state]:
                    state = GIVEN[state]
                    rows += "ua"[state == A]
                    continue
                if role in AFTER[state] and after[AFTER[state][role]] + CUT * cut == full[state]:
                    edits.append("K")
                    state = AFTER[state][role]
                    break
                state = GIVEN[state]
                edits.append("R" + "ua"[state == A])
                break
        else:
            edits.append("")
        inserted.append(rows)
    return inserted, edits, state


# ---------------------------------------------------------------- passes

SHAPE = "array<int>"
RUN = f"conv_id {{id}}, chunk long, last long, code array<int>, behind {SHAPE}, front {SHAPE}"


def _ints(values) -> tuple[int, ...] | None:
    """A column's array as plain integers."""
    return None if values is None else tuple(int(x) for x in values)


def _run(schema: str):
    """Runs or reruns chunks from the column ``want``; ``behind`` and ``front`` tell of the run before, if any."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            fronts = [list(run_back(_ints(c), _ints(w), _ints(b), _ints(f)))
                      for c, w, b, f in zip(pdf["code"], pdf["want"], pdf["behind"], pdf["front"])]
            yield pdf.drop(columns=["behind", "front", "want"]).assign(behind=pdf["want"], front=fronts)
    return lambda df: df.mapInPandas(run, schema)


def converged(chunks: DataFrame, most: int = CHUNKS + 1) -> tuple[DataFrame, int]:
    """(conv_id, chunk, behind) of all chunks with the true shape behind each, and the number of fix-up passes."""
    final, start = (F.array(*[F.lit(x).cast("int") for x in v]) for v in (FINAL, START))
    alone = chunks.where("last = 0").select("conv_id", "chunk", "last", "code", final.alias("behind"))
    schema = RUN.format(id=chunks.schema["conv_id"].dataType.simpleString())
    run = _run(schema)
    none = F.lit(None).cast(SHAPE)
    several = chunks.where("last > 0").select("conv_id", "chunk", "last", "code", none.alias("behind"), none.alias("front"),
                                             F.when(F.col("chunk") == F.col("last"), final).otherwise(start).alias("want"))
    if several.isEmpty():
        return alone, 0
    runs = written(run(several), "repair-pass")
    passes = 0
    while True:
        conv = F.struct("conv_id")
        follower = runs.select(conv.alias("conv"), (F.col("chunk") - 1).alias("chunk"), F.col("front").alias("follows"))
        joined = runs.withColumn("conv", conv).join(follower, ["conv", "chunk"], "left").withColumn("want", F.coalesce("follows", final))
        joined = joined.select("conv_id", "chunk", "last", "code", "behind", "front", "want")
        if joined.where(F.col("want") != F.col("behind")).isEmpty():
            return alone.unionByName(runs.drop("front")), passes
        if passes > most:
            raise RuntimeError("fix-up passes did not converge")
        runs, passes = written(run(joined), "repair-pass"), passes + 1


def traced(chunks: DataFrame, behind: DataFrame) -> DataFrame:
    """(conv_id, place, inserted, edit) of every entry, and of the place behind the last one."""
    kind = chunks.schema["conv_id"].dataType.simpleString()

    def ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf[["conv_id", "chunk"]].assign(ends=[
                [trace(_ints(c), _ints(v), q)[2] for q in range(4)] for c, v in zip(pdf["code"], pdf["behind"])])

    several = behind.where("last > 0").select("conv_id", "chunk", "code", "behind").mapInPandas(ends, f"conv_id {kind}, chunk long, ends array<int>")
    cells = F.sort_array(F.collect_list(F.struct("chunk", "ends")))  # CHUNKS and a bit at most
    chain = F.aggregate("cells", F.array(F.lit(NONE)), lambda acc, x: F.concat(acc, F.array(F.get(x["ends"], F.element_at(acc, -1)))))
    begin = several.groupBy("conv_id").agg(cells.alias("cells")).select("conv_id", F.posexplode(chain).alias("chunk", "state"))
    begin = begin.select(F.struct("conv_id").alias("conv"), F.col("chunk").cast("long").alias("chunk"), "state")
    where = chunks.select(F.struct("conv_id").alias("conv"), "chunk", "place")
    known = behind.withColumn("conv", F.struct("conv_id")).join(begin, ["conv", "chunk"], "left").join(where, ["conv", "chunk"])
    known = known.select("conv_id", "chunk", "last", "place", "code", "behind", F.coalesce("state", F.lit(NONE)).alias("state"))

    def edits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                inserted, done, state = trace(_ints(r.code), _ints(r.behind), int(r.state))
                if r.chunk == r.last:
                    inserted.append({S: "ua", U: "a"}.get(state, ""))
                    done.append("")
                out.append((inserted, done))
            yield pdf[["conv_id", "place"]].assign(inserted=[x for x, _ in out], edit=[x for _, x in out])

    rows = known.mapInPandas(edits, f"conv_id {kind}, place long, inserted array<string>, edit array<string>")
    return rows.select("conv_id", F.col("place").alias("from"), F.posexplode(F.arrays_zip("inserted", "edit")).alias("i", "e")).select(
        "conv_id", (F.col("from") + F.col("i")).cast("long").alias("place"), "e.inserted", "e.edit")


def repaired(rows: DataFrame, chunk: int = CHUNK, chunks: int = CHUNKS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Repairs rows of ``conv_id, turn, role, text`` and ``copies`` (how often each stands there).

    Returns the edits in order (conv_id, place, step, edit, n, role, text, cost: an edit that is made ``n``
    times, with the row it leaves, null for none), the entries and the chunks. Texts are shuffled once, to the
    edits that keep them."""
    known = written(placed(entries(rows)), "repair-entries")
    cut = written(chunked(known, chunk, chunks), "repair-chunks")
    behind, _ = converged(cut, chunks + 1)
    steps = written(traced(cut, behind), "repair-steps").select(F.struct("conv_id").alias("conv"), "place", "inserted", "edit")
    both = known.withColumn("conv", F.struct("conv_id")).drop("conv_id").join(steps, ["conv", "place"], "right")
    live = F.col("edit") != ""
    letters = F.filter(F.split("inserted", ""), lambda x: x != "")
    nothing = F.lit(None).cast("string")
    cell = lambda edit, n, role, cost: F.struct(
        edit.alias("edit"), n.cast("long").alias("n"), role.alias("role"), cost.cast("long").alias("cost"))
    one, named = F.lit(1), lambda x: F.when(x == "u", F.lit("user")).otherwise(F.lit("assistant"))
    made = F.transform(letters, lambda x: cell(F.lit("I"), one, named(x), F.lit(INSERT)))
    extra = F.when(F.col("cut"), F.lit(CUT)).otherwise(F.lit(0))
    letter = F.substring("edit", 1, 1)
    done = F.when(letter == "K", cell(letter, one, F.col("role"), extra)).when(
        letter == "R", cell(letter, one, named(F.substring("edit", 2, 1)), extra + REROLE)).otherwise(
        cell(letter, one, nothing, F.lit(DELETE)))
    left = F.coalesce(F.col("copies"), F.lit(0)) - live.cast("long")
    gone = cell(F.lit("D"), left, nothing, F.lit(DELETE))
    cells = F.concat(made, F.when(live, F.array(done)).otherwise(F.filter(F.array(done), lambda _: F.lit(False))),
                     F.filter(F.array(gone), lambda x: x["n"] > 0))
    key = F.struct("conv.conv_id", "turn", F.col("role"), "digest")
    out = both.select("conv.conv_id", "place", key.alias("key"), F.posexplode(cells).alias("step", "e")).select("conv_id", "place", "key", "step", "e.*")
    stays = F.col("edit").isin("K", "R")
    texts = digested(rows).select(F.struct(*KEY).alias("key"), "text").dropDuplicates(["key"])
    kept = out.where(stays).join(texts, "key")
    other = out.where(~stays).withColumn("text", F.when(F.col("edit") == "I", F.lit("")))
    return kept.unionByName(other).drop("key"), known, cut


def summary(rows: DataFrame, chunk: int = CHUNK, chunks: int = CHUNKS) -> DataFrame:
    """Per original conv_id, after ``damaged``: faults, illegal neighbours, the audit and digests of the repair."""
    edits, known, cut = repaired(damaged(rows), chunk, chunks)
    conv = F.struct("conv_id").alias("conv")
    live = (F.col("first") & ~F.col("blank")).cast("long")
    count = lambda c: F.sum(c).cast("long")
    faults = known.groupBy(conv).agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).cast("long").alias("gaps"),
        count(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        count(F.when(F.col("blank"), 0).otherwise(F.col("copies") - live)).alias("duplicate"),
        count(F.col("cut").cast("long")).alias("truncated"))
    legal = ["su", "ua", "au"]
    wrong = lambda pairs: F.size(F.filter(pairs, lambda p: ~p.isin(legal))).cast("long")
    inner = F.zip_with(F.slice("initial", F.lit(1), F.size("initial") - 1), F.slice("initial", F.lit(2), F.size("initial")), lambda a, b: F.concat(a, b))
    again = F.aggregate("copies", F.lit(0).cast("long"), lambda acc, x: acc + x - 1)
    by_chunk = cut.select(conv, "chunk", (wrong(inner) + again).alias("wrong"), F.element_at("initial", 1).alias("a"), F.element_at("initial", -1).alias("b"))
    seams = F.sort_array(F.collect_list(F.struct("chunk", "a", "b")))  # CHUNKS and a bit at most
    by_conv = by_chunk.groupBy("conv").agg(F.sum("wrong").alias("wrong"), seams.alias("seams"))
    n = F.size("seams")
    by_conv = by_conv.select("conv", (F.col("wrong") + wrong(F.zip_with(
        F.slice("seams", F.lit(1), n - 1), F.slice("seams", F.lit(2), n), lambda x, y: F.concat(x["b"], y["a"])))).alias("illegal"))
    line = F.concat("role", F.lit(":"), "text")
    text = edits.groupBy(conv).agg(
        F.sum(F.col("n") * F.col("cost")).cast("long").alias("cost"),
        F.sort_array(F.collect_list(F.struct("place", "step", F.expr("repeat(edit, cast(n as int))").alias("edit"), line.alias("line")))).alias("cells"))
    text = text.select("conv", "cost", F.array_join(F.col("cells.edit"), "").alias("audit"), F.sha2(F.array_join(F.col("cells.line"), "\n"), 256).alias("repaired_sha256"))
    every = rows.select(conv).distinct()
    out = every.join(faults, "conv", "left").join(by_conv, "conv", "left").join(text, "conv", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv.conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
