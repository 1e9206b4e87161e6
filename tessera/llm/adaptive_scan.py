"""Nearest neighbours by inner product: inverted lists scanned with adaptive dimensions.

Vectors get one more component, so that all have one length and the largest inner product
is the smallest distance; then a random rotation. An inverted file over k-means lists picks
the lists to probe. Within a probed list the rotated vectors lie in column blocks; after
each block the partial distance, scaled to all dimensions, is tested against the query's
bound (``confidence`` standard errors wide), and candidates that are almost surely farther
are given up before their other columns are read. What survives is scored exactly, in
double precision, on the original vectors.

Rotation, centroids and the bounds' sample are fitted on a bounded sample (``max_sample``
distinct vectors by keyed hash); every vector is indexed. Equal vectors are searched once:
of a group of equal vectors only the ``k + 1`` smallest ids can be among a query's nearest.
Lists are cut into blocks of about ``block`` vectors and queries into chunks, so no list,
hot or not, meets in one task.

Defined results: vectors that are null, all zero or hold null or non-finite components take
no part, nor do those of another length than the most frequent one (the smaller of two
equally frequent); rows with one vec_id and one vector count once; with fewer candidates
than k all are returned; ties go to the smaller vec_id; no valid vectors give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written


@dataclass(frozen=True)
class Settings:
    k: int = 20
    lists_per_root: float = 0.5  # lists: this times the root of the number of distinct vectors
    max_lists: int = 4096
    probed: float = 0.75  # share of the lists that a query probes: nearly isotropic vectors need many
    confidence: float = 2.1
    columns: int = 16  # of a column block
    max_sample: int = 4000  # bound on the fitting sample
    rounds: int = 8  # of k-means
    block: int = 20_000
    chunk: int = 20_000
    seed: int = 41


def valid_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, vec`` (array<double>) of the vectors that take part."""
    v = F.col(embedding).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (sizes["n"] if sizes else 0))


@dataclass
class Index:
    """What the tasks need: rotation, centroids, the longest length and the sample for bounds."""

    rotation: np.ndarray
    centroids: np.ndarray
    longest2: float
    sample: np.ndarray  # rotated

    def rotate(self, x: np.ndarray, is_query: bool) -> np.ndarray:
        rest = np.zeros(len(x)) if is_query else np.sqrt(np.maximum(self.longest2 - (x ** 2).sum(1), 0))
        return np.column_stack((x, rest)) @ self.rotation

    def nearest_lists(self, y: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids, up to a constant per row."""
        return (self.centroids ** 2).sum(1) - 2 * y @ self.centroids.T

    def bounds(self, q: np.ndarray, k: int) -> np.ndarray:
        """An upper bound of each query's k-th smallest squared distance: that within the sample."""
        if len(self.sample) < k:
            return np.full(len(q), np.inf)
        d2 = (q ** 2).sum(1)[:, None] - 2 * q @ self.sample.T + (self.sample ** 2).sum(1)
        return np.maximum(np.partition(d2, k - 1, axis=1)[:, k - 1], 0) * (1 + 1e-9) + 1e-12


def fit(distinct: DataFrame, s: Settings) -> Index | None:
    """The index's bounded parts. ``distinct``: ``rep, vec``."""
    n, longest2 = distinct.agg(F.count("*"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).first()
    if not n:
        return None
    got = distinct.select("rep", "vec").orderBy(F.xxhash64("rep", F.lit(s.seed)), "rep").limit(s.max_sample).collect()
    x = np.array([r["vec"] for r in got], dtype=float)
    rng = np.random.default_rng(s.seed)
    rotation = np.linalg.qr(rng.normal(size=(x.shape[1] + 1,) * 2))[0]
    index = Index(rotation, np.zeros((1, x.shape[1] + 1)), float(longest2), np.zeros((0, 0)))
    index.sample = y = index.rotate(x, False)
    lists = int(min(s.max_lists, len(y), max(1, round(s.lists_per_root * n ** 0.5))))
    centroids = y[rng.permutation(len(y))[:lists]].copy()
    for _ in range(s.rounds):
        index.centroids = centroids
        at = index.nearest_lists(y).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, y)
        count = np.bincount(at, minlength=lists)
        centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centroids)
    index.centroids = centroids
    return index


def nothing() -> pd.DataFrame:
    return pd.DataFrame({"query": np.zeros(0, np.int64), "rep": np.zeros(0, np.int64), "score": np.zeros(0)})


def scan(index: Index, s: Settings, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """One block of a list against one chunk of queries: ``query, rep, score`` of what may be near."""
    ids = candidates["rep"].to_numpy()
    x, q0 = np.array(candidates["vec"].tolist()), np.array(queries["vec"].tolist())
    y, q = index.rotate(x, False), index.rotate(q0, True)
    dims = y.shape[1]
    cuts = [(a, min(a + s.columns, dims)) for a in range(0, dims, s.columns)]
    cols = [np.ascontiguousarray(y[:, a:b]) for a, b in cuts]
    bound = queries["bound"].to_numpy()
    a, b = cuts[0]
    norms = (cols[0] ** 2).sum(1)
    out: list[tuple] = []
    for start in range(0, len(q), 64):
        part = q[start:start + 64, a:b]
        first = norms - 2 * part @ cols[0].T + (part ** 2).sum(1)[:, None]
        for i in range(len(part)):
            row, r2 = start + i, bound[start + i]
            alive, d2 = None, first[i]
            for n, (lo, hi) in enumerate(cuts):
                if n:
                    diff = cols[n][alive] - q[row, lo:hi]
                    d2 = d2 + (diff * diff).sum(1)
                if hi < dims:
                    test = d2 * (dims / hi) <= r2 * (1 + s.confidence / np.sqrt(hi)) ** 2
                    alive = np.flatnonzero(test) if alive is None else alive[test]
                    d2 = d2[test]
            if alive is None:
                alive = np.arange(len(ids))
            near = alive[d2 <= r2 * (1 + 1e-9) + 1e-9]
            if len(near):
                score = (x[near] * q0[row]).sum(1)
                best = np.lexsort((ids[near], -score))[:s.k + 1]
                out.append((np.full(len(best), queries["rep"].iat[row]), ids[near][best], score[best]))
    if not out:
        return nothing()
    return pd.DataFrame(dict(zip(("query", "rep", "score"), map(np.concatenate, zip(*out)))))


def _top(df: DataFrame, by: list[str], order: list[Column], n: int, into: str = "place") -> DataFrame:
    return df.withColumn(into, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(into) <= n)


def nearest(df: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding",
            s: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every query row (``is_query`` on vec_id)."""
    spark = df.sparkSession
    rows = valid_vectors(df, vec_id, embedding)
    firsts = _top(rows.distinct(), ["vec"], [F.col("vec_id")], s.k + 1)  # per task first: hot vectors shrink before the shuffle
    groups = written(firsts.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                     .select(F.get("ids", F.lit(0)).alias("rep"), "vec", "ids"), "ann-distinct")
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vec").distinct()
    members = written(asked.join(groups.select("rep", "vec"), "vec").select("query_id", "rep"), "ann-queries")
    index = fit(groups, s)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sent = spark.sparkContext.broadcast(index)
    n_lists = len(index.centroids)
    probes = max(1, int(np.ceil(s.probed * n_lists)))

    def assign(frames):
        for pdf in frames:
            if len(pdf):
                y = sent.value.rotate(np.array(pdf["vec"].tolist()), False)
                pdf["list"] = sent.value.nearest_lists(y).argmin(1).astype(np.int32)
                yield pdf[["list", "rep", "vec"]]

    def probe(frames):
        own = sent.value
        for pdf in frames:
            for i in range(0, len(pdf), 1000):
                part = pdf.iloc[i:i + 1000]
                q = own.rotate(np.array(part["vec"].tolist()), True)
                lists = np.argsort(own.nearest_lists(q), axis=1, kind="stable")
                # The nearest lists, up to k + 1 vectors, are read without a bound: k are found for sure.
                home = np.cumsum(held[lists], axis=1) - held[lists] < s.k + 1
                bound = np.where(home, np.inf, own.bounds(q, s.k + 1)[:, None])
                read = home | (np.arange(n_lists) < probes)
                pairs = [list(zip(a[r].tolist(), b[r].tolist())) for a, b, r in zip(lists, bound, read)]
                yield part.assign(lists=[[{"list": a, "bound": b} for a, b in p] for p in pairs])[["rep", "vec", "lists"]]

    placed = written(groups.select("rep", "vec").mapInPandas(assign, "list int, rep long, vec array<double>"), "ann-lists")
    sizes = {r["list"]: r["count"] for r in placed.groupBy("list").count().collect()}  # at most max_lists rows
    held = np.array([sizes.get(i, 0) for i in range(n_lists)])
    blocks = F.create_map(*[F.lit(int(x)) for k, v in sizes.items() for x in (k, -(-v // s.block))])
    distinct_queries = members.select("rep").distinct().join(groups.select("rep", "vec"), "rep")
    chunks = max(1, -(-members.select("rep").distinct().count() // s.chunk))
    candidates = placed.select(
        "list", F.pmod(F.xxhash64("rep"), F.element_at(blocks, F.col("list"))).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "rep", "vec")
    queries = distinct_queries.select("rep", "vec").mapInPandas(probe, "rep long, vec array<double>, lists array<struct<list:int,bound:double>>")
    queries = queries.select("rep", "vec", F.inline("lists"), F.pmod(F.xxhash64("rep"), F.lit(chunks)).cast("int").alias("chunk"))
    queries = queries.select("rep", "vec", "bound", "list", "chunk", F.explode(
        F.sequence(F.lit(0), F.coalesce(F.element_at(blocks, F.col("list")), F.lit(1)) - 1)).alias("block"))

    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return scan(sent.value, s, candidates, queries) if len(candidates) and len(queries) else nothing()

    keys = ["list", "block", "chunk"]
    found = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(run, "query long, rep long, score double")
    best = _top(found, ["query"], [F.desc("score"), F.col("rep")], s.k + 1)
    spread = best.join(groups.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    spread = _top(spread, ["query"], [F.desc("score"), F.col("vec_id")], s.k + 1, "near")
    hits = members.join(spread, members["rep"] == spread["query"]).where("vec_id <> query_id")
    ranked = _top(hits, ["query_id"], [F.desc("score"), F.col("vec_id")], s.k, "rank")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
