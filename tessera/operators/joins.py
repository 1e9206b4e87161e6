"""Join operators: size-checked dimension joins, panel joins, latest-row joins, pair sums."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_dir

# A side is broadcast only when the optimizer's size estimate is below this bound.
# Above it the join stays a shuffle join; AQE can still turn it into a broadcast
# join once the runtime size of the shuffled side is known.
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (an upper bound for scans + filters), or None."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # Spark Connect has no plan object: let AQE decide
        return None


def maybe_broadcast(df: DataFrame, limit: int = DEFAULT_BROADCAST_LIMIT,
                    bounded_by: Sequence[DataFrame] | None = None) -> DataFrame:
    """Hint a broadcast only for a side whose estimated size is checked to be under ``limit``.

    ``bounded_by``: frames whose summed size bounds ``df`` (e.g. a dimension joined to
    its many-to-one parent), used when the optimizer's own estimate for ``df`` is
    a loose product of its inputs.
    """
    sizes = [estimated_bytes(x) for x in (bounded_by or [df])]
    if all(s is not None for s in sizes) and sum(sizes) <= limit:
        return F.broadcast(df)
    return df


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "left",
    limit: int = DEFAULT_BROADCAST_LIMIT,
    bounded_by: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Enrich a fact frame from a dimension; broadcast the dimension when it is checked small."""
    return fact.join(maybe_broadcast(dim, limit, bounded_by), on, how)


def panel_join(panels: Sequence[DataFrame], keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join n panels that share ``keys`` into one frame with a single copy of the keys."""
    if not panels:
        raise ValueError("panel_join needs at least one panel")
    return reduce(lambda a, b: a.join(b, list(keys), how), panels)


def _keyed(df: DataFrame, columns: Sequence[str | Column], out: str = "__key") -> DataFrame:
    """Add the join key as ONE struct column. Spark then partitions by the whole key, whatever
    ``spark.sql.requireAllClusterKeysForCoPartition`` says, and NULL parts equal each other."""
    return df.withColumn(out, F.struct(*[F.col(c) if isinstance(c, str) else c for c in columns]))


def latest_rows(
    rows: DataFrame,
    entity: str,
    ts: str,
    qualifies: Column,
    label: str | None = None,
) -> DataFrame:
    """Rows of each entity whose ``ts`` equals the entity's latest qualifying ``ts``.

    Only the maximum is restricted by ``qualifies``: every row of the entity at that
    timestamp is returned (ties kept, other types included). This is the
    decorrelated form of ``WHERE ts = (SELECT max(ts) ... WHERE <qualifies> AND
    entity = outer.entity)``; see ``latest_rows_multi``.
    """
    out = latest_rows_multi(rows, entity, ts, {label or "_": qualifies})
    return out if label else out.drop("branch")


def latest_rows_multi(
    rows: DataFrame,
    entity: str,
    ts: str,
    branches: dict[str, Column],
    branch_col: str = "branch",
) -> DataFrame:
    """``latest_rows`` for several predicates with ONE aggregation pass over ``rows``.

    Result: the matching rows, each tagged with the branch whose maximum it equals
    (a row can belong to several branches). The maxima come from one partial
    aggregation; they are joined to the rows by (entity, timestamp), so an entity
    that holds a third of all rows is spread over tasks by its timestamps.
    """
    names = list(branches)
    maxima = rows.groupBy(entity).agg(
        *[F.max(F.when(branches[n], F.col(ts))).alias(f"__m{i}") for i, n in enumerate(names)])
    pairs = F.array(*[
        F.struct(F.lit(n).alias(branch_col), F.col(f"__m{i}").alias("__w")) for i, n in enumerate(names)
    ])
    winners = maxima.where(F.col(entity).isNotNull()).select(entity, F.inline(pairs)).filter(F.col("__w").isNotNull())
    winners = _keyed(winners, [entity, "__w"]).select("__key", branch_col)
    return _keyed(rows, [entity, ts]).join(winners, "__key", "inner").drop("__key")


def first_pair_with_sum(
    rows: DataFrame,
    group: Sequence[str],
    index: str,
    value: str,
    target: int | float,
    hot_rows: int | None = None,
) -> DataFrame:
    """Per group, the first pair ``(i, j)``, ``i < j`` in (i, j) order, with ``v_i + v_j = target``.

    No pairs are enumerated: the smallest ``i`` that has a partner is found by an
    equi join against the per-(group, value) maximum index, then its ``j`` is the
    smallest later index holding the complement. Groups without a pair are absent.
    Both joins attach one statistics row per key to many rows, so hot keys are
    salted (``join_back``).
    """
    g = list(group)
    salt = {} if hot_rows is None else {"hot_rows": hot_rows}
    per_value = rows.groupBy(*g, value).agg(F.max(index).alias("__last"), F.count(F.lit(1)).alias("__n"))
    # stats keyed by the probe key ``need``: last index holding ``need``, and the number
    # of probe rows asking for it (rows whose value is ``target - need``)
    last_of = per_value.select(*g, F.col(value).alias("__need"), "__last")
    askers = per_value.select(*g, (F.lit(target) - F.col(value)).alias("__need"), "__n")
    probe_stats = last_of.join(askers, [*g, "__need"], "inner")
    probe = rows.select(*g, index, (F.lit(target) - F.col(value)).alias("__need"))
    firsts = (
        join_back(probe, probe_stats, [*g, "__need"], "__n", **salt)
        .filter(F.col("__last") > F.col(index))
        .groupBy(*g)
        .agg(F.min(F.struct(F.col(index).alias("i"), F.col("__need").alias("need"))).alias("__p"))
        .select(*g, F.col("__p.i").alias("i"), F.col("__p.need").alias("__need"))
    )
    holders = per_value.select(*g, F.col(value).alias("__need"), "__n")
    first_stats = firsts.join(holders, [*g, "__need"], "inner")
    partners = (
        join_back(rows.select(*g, F.col(index).alias("j"), F.col(value).alias("__need")), first_stats,
                  [*g, "__need"], "__n", **salt)
        .filter(F.col("j") > F.col("i"))
        .groupBy(*g, "i")
        .agg(F.min("j").alias("j"))
    )
    return partners


# Salting of aggregate-join-backs. AQE splits skewed partitions only when both join
# inputs come straight from a shuffle; joining per-key statistics back to their own
# rows puts an aggregate on one side, so a hot key would stay in one task.
HOT_KEY_ROWS = 1_000_000      # a key with more rows than this is split
HOT_KEYS = 100_000            # a key is hot only with more than this fraction of all rows


def join_back(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    count_col: str,
    how: str = "inner",
    limit: int = DEFAULT_BROADCAST_LIMIT,
    hot_rows: int = HOT_KEY_ROWS,
    rows_per_key: int = 1,
) -> DataFrame:
    """Join per-key statistics (``rows_per_key`` rows per key at most, each with the
    key's row count in ``count_col``) back to the rows they were computed from. NULL
    keys meet their own statistics.

    Small statistics are broadcast after the size check. Otherwise every key with
    more rows than ``hot_rows`` and than a ``HOT_KEYS``-th of all rows is salted: its
    rows are written once with an ordinal and get a slice in ``[0, ceil(n / threshold))`` from that
    (repeated rows spread too, and a retried task deals them alike), and only its statistics are copied
    once a slice. There are fewer than ``HOT_KEYS`` such keys, whatever the data, so their list is
    broadcast; a key below the threshold fits a task.
    """
    k = list(keys)
    plain = _keyed(stats, k).drop(count_col, *k)
    # statistics hold at most ``rows_per_key`` rows per key of ``rows``, each a few
    # values wide, so 2 x rows_per_key x the rows' estimate also bounds them (the
    # optimizer's own estimate for joined aggregates is a loose product)
    own, base = estimated_bytes(plain), estimated_bytes(rows)
    keyed = _keyed(rows, k)
    if (own is not None and own <= limit) or (base is not None and 2 * rows_per_key * base <= limit):
        return keyed.join(F.broadcast(plain), "__key", how).drop("__key")
    counts = _keyed(stats, k).groupBy("__key").agg(F.max(count_col).alias("__n"))
    total = counts.select(F.sum("__n").alias("t")).scalar()
    threshold = F.greatest(F.lit(hot_rows), F.coalesce(total, F.lit(0)) / HOT_KEYS)
    hot = F.broadcast(counts.where(F.col("__n") > threshold).select(
        "__key", F.ceil(F.col("__n") / threshold).cast("int").alias("__slices")))
    cool = keyed.join(hot, "__key", "left_anti").join(plain, "__key", how).drop("__key")
    warm = _numbered(keyed.join(hot, "__key"), "hot-rows")
    slice_ = F.pmod(F.xxhash64("__ordinal"), F.col("__slices")).cast("int")
    warm = _keyed(warm, ["__key", slice_.alias("salt")], "__salted").drop("__key", "__slices", "__ordinal")
    copies = plain.join(hot, "__key").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__slices") - 1)))
    copies = _keyed(copies, ["__key", F.col("__salt").alias("salt")], "__salted").drop("__key", "__slices", "__salt")
    return cool.unionByName(warm.join(copies, "__salted", how).drop("__salted"))


def _numbered(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written once with an ordinal: a task that is run again later deals them as before."""
    path = scratch_dir(rows.sparkSession, purpose)
    rows.withColumn("__ordinal", F.monotonically_increasing_id()).write.parquet(path)
    return rows.sparkSession.read.parquet(path)
