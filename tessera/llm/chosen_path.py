"""MinHash near-dedup by a chosen-path set similarity join.

A document's set holds its distinct word shingles. Equal sets are one node. Each node
carries a sketch of ``width`` minwise tokens. A tree branches the nodes: at each tree
node, hashes of its path choose one or two sketch coordinates (``1 / similarity`` in the
mean), and each document goes to the children named by its tokens there; so two sets as
similar as the threshold are expected to stay together in one child. Tree nodes of at
most ``small`` documents are compared exhaustively, each within a task, larger ones branch on; independent
trees are repeated for the target recall: a pair at the threshold is missed by all
``trees`` at the first level with a chance of ``0.1875 ** trees``.

Only components are asked for, so first the tree nodes of a few trees link their members to their
smallest one; afterwards only members of different components are compared, and large tree nodes that outlive
some branchings are linked so again, which keeps large groups of copies linear. Candidates whose sketches agree too little (``screen``,
four to five standard errors below the threshold) are dropped; the rest is confirmed on the full sets. Pairs
leave a tree node only while they are few: one with more than ``DENSE`` candidates a member (near copies
that fall a little short of the threshold) gets the full sets of its members instead and is decided there. So what is shuffled
grows with the members of tree nodes, never with the pairs among them.

Defined results: null, empty and word-free texts have no shingles and link with nothing (each is its
own component); fewer words than a shingle make one shingle of all; equal texts are linked;
rows with a null doc_id have a null component and are kept; rows that repeat a doc_id each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Interned, ascii_words, batches, digest64, written
from tessera.llm.components import components

_P, _MIX, _MIX2 = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
FLAG_BITS = 20
HOT = 2000  # members of one pivot that a task confirms at a time
DENSE = 2  # candidate pairs a member that leave a tree node as pairs


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 75  # least similarity
    width: int = 64  # minwise tokens of a sketch
    trees: int = 12
    small: int = 2000
    depth: int = 12
    star_trees: int = 3  # trees whose first level links to smallest members
    merges: tuple[int, ...] = (2, 5)  # levels after which what was found is merged
    screen: float = 0.5
    seed: int = 7


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    return (x ^ (x >> np.uint64(27))) * _MIX


class Shingler:
    def __init__(self, s: Settings):
        self.s, self.cache = s, Interned(digest64, 400_000)
        rng = np.random.default_rng(s.seed)
        self.donors = rng.integers(0, s.width, (s.width, 40 * s.width))  # densification: one sequence a bin

    def shingles(self, text: str | None) -> np.ndarray:
        """The set, as sorted distinct 64-bit digests."""
        words = ascii_words(text or "")
        if not words:
            return np.zeros(0, np.uint64)
        cache, k = self.cache, min(self.s.shingle, len(words))
        one = np.fromiter([cache[w] for w in words], np.uint64, len(words))
        h = np.full(len(words) - k + 1, k, np.uint64)
        for j in range(k):
            h = (h ^ one[j:len(words) - k + 1 + j]) * _P
            h ^= h >> np.uint64(32)
        return np.unique(_mix(h))

    def sketch(self, own: np.ndarray) -> np.ndarray:
        """One minwise token a bin of the digests' upper bits; empty bins borrow from the first full
        one of their own donor sequence."""
        width = self.s.width
        shift = np.uint64(64 - (width.bit_length() - 1))
        starts = np.searchsorted(own >> shift, np.arange(width + 1).astype(np.uint64))
        full = starts[1:] > starts[:-1]
        tokens = _mix(own[np.minimum(starts[:-1], len(own) - 1)] ^ _MIX)
        if not full.all():
            empty = np.flatnonzero(~full)
            turn = full[self.donors[empty]].argmax(1)
            source = self.donors[empty, turn]
            lost = ~full[source]
            source[lost] = np.flatnonzero(full)[0]
            tokens[empty] = tokens[source]
        return (tokens >> np.uint64(32)).astype("<u4")


def shingled(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, n_shingles, node, sketch, brief``; ``node`` digests the whole set, null for an empty one;
    ``brief`` is the lowest byte of each token, enough to screen pairs."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Shingler(s)
        for pdf in batches(frames, 512):
            sets = [own.shingles(t) for t in pdf["text"]]
            sketches = [own.sketch(x) if len(x) else None for x in sets]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"), "n_shingles": [len(x) for x in sets],
                "node": pd.array([digest64(x.tobytes()) - (1 << 63) if len(x) else None for x in sets], dtype="Int64"),
                "sketch": [None if k is None else k.tobytes() for k in sketches],
                "brief": [None if k is None else k.astype(np.uint8).tobytes() for k in sketches]})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, n_shingles long, node long, sketch binary, brief binary")


def _choice(paths: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each path: two coordinates, and whether the second is taken (so 100 / percent in the mean)."""
    h = _mix(paths + np.uint64(s.seed))
    one = (h % np.uint64(s.width)).astype(np.int64)
    step = 1 + ((h >> np.uint64(20)) % np.uint64(s.width - 1)).astype(np.int64)
    both = (h >> np.uint64(40)).astype(np.float64) / float(1 << 24) < 100 / s.percent - 1
    return one, (one + step) % s.width, both


def _children(paths: np.ndarray, sketches: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Child paths of each (path, sketch) row, and the row each comes from."""
    rows = np.arange(len(paths))
    one, two, both = _choice(paths, s)
    out = [_mix(_mix(paths ^ (i.astype(np.uint64) * _MIX)) + sketches[rows, i].astype(np.uint64)) for i in (one, two)]
    return np.concatenate((out[0], out[1][both])), np.concatenate((rows, rows[both]))


def _matrix(sketches: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), "<u4").reshape(-1, width)


def _roots(nodes: DataFrame, s: Settings) -> DataFrame:
    """``path, node``: every node at the first level of every tree."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames, 4096):
            m, ids = _matrix(pdf["sketch"], s.width), pdf["node"].to_numpy()
            for tree in range(s.trees):
                path = np.full(len(ids), _mix(np.array([tree + 1], np.uint64) * _P)[0])
                child, row = _children(path, m, s)
                yield pd.DataFrame({"path": child.view(np.int64), "node": ids[row], "star": tree < s.star_trees})
    return nodes.select("node", "sketch").mapInPandas(run, "path long, node long, star boolean")


def _branch(rows: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """The children of ``path, node, component`` rows."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames, 8192):
            child, row = _children(pdf["path"].to_numpy().view(np.uint64), _matrix(pdf["sketch"], s.width), s)
            yield pd.DataFrame({"path": child.view(np.int64), "node": pdf["node"].to_numpy()[row],
                                "component": pdf["component"].to_numpy()[row]})
    return rows.join(nodes, "node").select("path", "node", "component", "sketch").mapInPandas(
        run, "path long, node long, component long")


def _screened(pairs: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """Distinct pairs ``a, b`` whose sketches agree enough and whose sizes allow the similarity."""
    @F.pandas_udf(T.DoubleType())
    def agreement(x: pd.Series, y: pd.Series) -> pd.Series:
        cells = lambda z: np.frombuffer(b"".join(z), np.uint8).reshape(-1, s.width)
        return pd.Series((cells(x) == cells(y)).mean(1)) if len(x) else pd.Series([], dtype=float)

    side = lambda n: nodes.select(F.col("node").alias(n), F.col("brief").alias(f"s{n}"), F.col("n_shingles").alias(f"n{n}"))
    both = pairs.distinct().join(side("b"), "b").join(side("a"), "a")
    sized = both.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * s.percent)
    return sized.withColumn("like", agreement("sa", "sb")).where(F.col("like") >= s.screen).select("a", "b")


def _full_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """``node, shingles`` of the wanted nodes, from their smallest document. Flags of a fixed number of
    hash values spare the other documents; the join on the digest decides."""
    flag = F.shiftrightunsigned(F.xxhash64("rep"), 64 - FLAG_BITS).cast("int")
    reps = nodes.join(wanted, "node", "left_semi").select("node", "rep")
    flags = np.zeros(1 << FLAG_BITS, bool)
    flags[[r[0] for r in reps.select(flag).distinct().collect()]] = True  # at most 2**FLAG_BITS values
    sent = docs.sparkSession.sparkContext.broadcast(flags)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Shingler(s)
        for pdf in batches(frames, 512):
            part = pdf[sent.value[pdf["flag"].to_numpy()]]
            if len(part):
                sets = [own.shingles(t) for t in part["text"]]
                yield pd.DataFrame({"rep": part["doc_id"].astype("Int64"), "found": [digest64(x.tobytes()) - (1 << 63) for x in sets],
                                    "shingles": [x.view(np.int64) for x in sets]})

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("flag", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - FLAG_BITS).cast("int"))
    sets = rows.mapInPandas(run, "rep long, found long, shingles array<long>")
    return sets.join(reps.withColumnRenamed("node", "found"), ["rep", "found"], "left_semi").select(F.col("found").alias("node"), "shingles")


def _whole(frames: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames sorted by ``key``, cut anew so that no key spans two, and where the keys begin and end in them."""
    left = None
    for pdf in chain(frames, [None]):
        now = left if pdf is None else pdf if left is None else pd.concat([left, pdf], ignore_index=True)
        if now is None or not len(now):
            continue
        k = now[key].to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]))
        if pdf is not None:
            cuts = cuts[:-1]
        if len(cuts) > 1:
            yield now.iloc[:cuts[-1]], cuts
        left = now.iloc[cuts[-1]:]


def _near(brief: np.ndarray, size: np.ndarray, component: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs of members of one tree node, of different components, whose sketches agree enough and whose sizes
    allow the similarity; None if they are more than ``DENSE`` a member."""
    n, found, total = len(size), [], 0
    step = max(1, (1 << 17) // n)
    for lo in range(0, n - 1, step):
        x = np.arange(lo, min(lo + step, n - 1))[:, None]
        y = np.arange(lo + 1, n)[None, :]
        fits = np.minimum(size[x], size[y]) * 100 >= np.maximum(size[x], size[y]) * s.percent
        i, j = np.nonzero((x < y) & (component[x] != component[y]) & fits)
        i, j = i + lo, j + lo + 1
        alike = (brief[i] == brief[j]).sum(1) >= s.screen * s.width
        found.append((i[alike], j[alike]))
        total += len(found[-1][0])
        if total > DENSE * n:
            return None
    return tuple(np.concatenate(c) for c in zip(*found))


def _compared(rows: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """``path, node, component, other`` of tree nodes whose members are compared on their sketches: candidate pairs
    ``node, other``, and the members of those with too many candidates (``other`` is null)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, cuts in _whole(frames, "path"):
            node, component, size = (pdf[c].to_numpy() for c in ("node", "component", "n_shingles"))
            brief = np.frombuffer(b"".join(pdf["brief"]), np.uint8).reshape(-1, s.width)
            pairs, members = [], []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                near = _near(brief[lo:hi], size[lo:hi], component[lo:hi], s)
                if near is None:
                    members.append(np.arange(lo, hi))
                elif len(near[0]):
                    pairs.append((near[0] + lo, near[1] + lo))
            if pairs:
                i, j = (np.concatenate(c) for c in zip(*pairs))
                yield pd.DataFrame({"path": 0, "node": np.minimum(node[i], node[j]), "component": 0, "other": pd.array(np.maximum(node[i], node[j]), dtype="Int64")})
            if members:
                out = pdf.iloc[np.concatenate(members)][["path", "node", "component"]]
                yield out.assign(other=pd.array([None] * len(out), dtype="Int64"))

    together = rows.join(nodes.select("node", "brief", "n_shingles"), "node").repartition("path").sortWithinPartitions("path")
    return together.select("path", "node", "component", "n_shingles", "brief").mapInPandas(run, "path long, node long, component long, other long")


def joining_pairs(sets: list[np.ndarray], component: np.ndarray, s: Settings) -> list[tuple[int, int]]:
    """Similar pairs that join the components of the given sets, fewer than there are sets. Shared shingles are counted
    through the lists of their holders."""
    sizes = np.array([len(x) for x in sets])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    _, number, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(number, kind="stable")]
    first = np.concatenate(([0], np.cumsum(held)[:-1]))
    group, out = np.unique(component, return_inverse=True)[1], []
    for i in range(len(sets) - 1):
        own = number[starts[i]:starts[i + 1]]
        n = held[own]
        at = np.repeat(first[own] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        shared = np.bincount(holders[at], minlength=len(sets))
        for j in np.flatnonzero((100 * shared >= s.percent * (sizes[i] + sizes - shared)) & (group != group[i])):
            if group[j] != group[i]:
                out.append((i, int(j)))
                group[group == group[j]] = group[i]
    return out


def _decided(members: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Pairs that join the components of each tree node's members, on their full sets."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, cuts in _whole(frames, "path"):
            node, component, own = pdf["node"].to_numpy(), pdf["component"].to_numpy(), [np.asarray(x) for x in pdf["shingles"]]
            pairs = [(node[lo + i], node[lo + j]) for lo, hi in zip(cuts[:-1], cuts[1:]) for i, j in joining_pairs(own[lo:hi], component[lo:hi], s)]
            if pairs:
                yield pd.DataFrame([sorted(p) for p in pairs], columns=["a", "b"])

    together = members.join(sets, "node").repartition("path").sortWithinPartitions("path")
    return together.select("path", "node", "component", "shingles").mapInPandas(run, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs that are similar on their full sets. Each pivot ``a`` meets its partners in chunks of about HOT."""
    slices = pairs.groupBy("a").agg(F.ceil(F.count("*") / HOT).cast("int").alias("slices"))
    pairs = pairs.join(slices, "a").withColumn("slice", F.pmod(F.xxhash64("b"), F.col("slices")).cast("int"))
    partners = pairs.select("a", "slice", F.col("b").alias("node"))
    pivots = pairs.select("a", "slice").distinct().withColumn("node", F.col("a"))
    rows = pivots.unionByName(partners).join(sets, "node").withColumn("partner", F.col("node") != F.col("a"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, own = None, np.zeros(0, np.int64)
        for pdf in frames:
            out = []
            for a, part, node, partner, x in zip(pdf["a"], pdf["slice"], pdf["node"], pdf["partner"], pdf["shingles"]):
                x = np.asarray(x)
                if not partner:
                    at, own = (a, part), x
                elif at == (a, part):
                    shared = len(np.intersect1d(own, x, assume_unique=True))
                    if 100 * shared >= s.percent * (len(own) + len(x) - shared):
                        out.append((a, node))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    spread = rows.repartition("a", "slice").sortWithinPartitions("a", "slice", "partner")
    return spread.select("a", "slice", "node", "partner", "shingles").mapInPandas(run, "a long, b long").distinct()


def _merged(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` with the component of each node under the edges found so far."""
    grouped = components(edges)
    return rows.drop("component").join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))


def links(docs: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """Confirmed pairs of nodes that join all similar sets into components."""
    roots = written(_roots(nodes, s), "near-roots")
    size = roots.groupBy("path").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1")
    shared = written(roots.join(size, "path").select("path", "node", "star", "pivot"), "near-shared")
    stars = shared.where("star and node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    edges = written(_new_links([], [stars], docs, nodes, s), "near-links")
    rows, wide = _merged(shared.select("path", "node"), edges), None
    leaves, stars = [], []
    for level in range(s.depth + 1):
        # Tree nodes within one component are done with.
        open_paths = rows.groupBy("path").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"),
                                              F.min("node").alias("pivot"), F.min_by("component", "node").alias("of_pivot")).where("lo <> hi")
        rows = written(rows.join(open_paths.select("path", "n", "pivot", "of_pivot"), "path"), "near-open")
        last = level == s.depth  # what is still together then is compared whatever its size
        leaves.append((rows if last else rows.where(F.col("n") <= s.small)).select("path", "node", "component"))
        rows = rows.where(F.col("n") > s.small)
        if last or rows.isEmpty():
            break
        if level in s.merges:
            # Large tree nodes that outlive some branchings hold similar sets: their stars join most of them.
            stars = [rows.where("component <> of_pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))]
            edges = written(edges.unionByName(_new_links(leaves, stars, docs, nodes, s)), "near-links")
            rows, leaves = written(_merged(rows.select("path", "node"), edges), "near-merged"), []
        if wide is None:  # later levels read the sketches of these nodes only
            wide = written(nodes.join(rows.select("node").distinct(), "node", "left_semi").select("node", "sketch"), "near-wide")
        rows = written(_branch(rows, wide, s), "near-branch")
    return edges.unionByName(_new_links(leaves, [], docs, nodes, s))


def _new_links(leaves: list[DataFrame], stars: list[DataFrame], docs: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """Confirmed pairs among the members of tree nodes (``leaves``) and of candidate pairs (``stars``)."""
    pairs = [_screened(p, nodes, s) for p in stars]
    members = None
    if leaves:
        found = written(_compared(reduce(DataFrame.unionByName, leaves), nodes, s), "near-pairs")
        pairs.append(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
        members = found.where("other is null").drop("other")
    pairs = written(reduce(DataFrame.unionByName, pairs).distinct(), "near-rest")
    wanted = [pairs.select(F.col(c).alias("node")) for c in "ab"] + ([members.select("node")] if members is not None else [])
    sets = written(_full_sets(docs, nodes, reduce(DataFrame.unionByName, wanted).distinct(), s), "near-sets")
    links = _confirmed(pairs, sets, s)
    return links if members is None else links.unionByName(_decided(members, sets, s))


def classes(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    rows = written(shingled(docs, s), "near-sketches")
    own = rows.where("node is not null and doc_id is not null")
    nodes = written(own.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.first("brief").alias("brief"),
                                            F.first("n_shingles").alias("n_shingles")), "near-nodes")
    group = components(written(links(docs, nodes, s), "near-all"))
    named = nodes.select("node", "rep").join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_node = written(named.join(smallest, "component").select("node", "component_id"), "near-classes")
    out = rows.select("doc_id", "n_shingles", "node").join(by_node, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
