"""Incremental house-sales rollup (batch form).

Per run: read the watermark, keep sales rows with a strictly newer stamp, enrich
them with the *current* master data, sum ``amount`` per ``(sale_date, house)`` with
the newest stamp of each group, write the result under the run's new stamp, then
advance the state. The new stamp is taken from the same frame that was
aggregated, so rows landing during the run are picked up by the next one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.stamps import hex_stamp, stamp_value
from tessera.operators.joins import join_dimension
from tessera.functions.stamps import ZERO_STAMP
from tessera.sinks.files import write_stamped, write_watermark
from tessera.session import scratch_dir
from tessera.sources.files import RANGE_COLUMNS, in_range, newest_output, read_master_json, read_master_json_lines, read_sales, read_state, read_watermark


STAMP = "stamp"  # optional numeric stamp column; derived from ``verstamp`` when absent


def with_stamp(sales: DataFrame) -> DataFrame:
    """Ensure the numeric stamp column. Fixed-width hex text and its number sort the
    same way, so comparing numbers equals the text compare (and stays right past
    8 hex digits, where text order breaks)."""
    return sales if STAMP in sales.columns else sales.withColumn(STAMP, stamp_value("verstamp"))


def fresh_rows(sales: DataFrame, watermark: str | None, until: str | None = None) -> DataFrame:
    """Rows newer than the watermark (strict), up to ``until``. On a numeric stamp column that comes
    straight from the source, the predicate reaches the Parquet scan; deliveries kept in stamp
    ranges (``sinks.files.append_delivery``) are pruned by partition, so older ranges are not read."""
    s = with_stamp(sales)
    ranged = set(RANGE_COLUMNS) <= set(s.columns)
    if watermark is not None:
        low = int(watermark, 16)
        s = s.filter(F.col(STAMP) > F.lit(low))
        s = s.filter(in_range(low, ">=")) if ranged else s
    if until is not None:
        high = int(until, 16)
        s = s.filter(F.col(STAMP) <= F.lit(high))
        s = s.filter(in_range(high, "<=")) if ranged else s
    return s


def house_sales(sales: DataFrame, master: DataFrame, watermark: str | None = None) -> DataFrame:
    """``sale_date, house, amount, last_verstamp`` sorted by date and house.

    ``sales``: ``character_id, sale_date, amount, verstamp``; ``master``:
    ``character_id, house``. Rows whose key has no house are dropped, as a NULL
    group key is dropped by the original grouping (see ``unmatched_keys``).
    """
    return _result(_by_house(fresh_rows(sales, watermark), master))


def _by_house(fresh: DataFrame, master: DataFrame) -> DataFrame:
    """Sums and newest stamp by date and house; rows without either form groups of their own."""
    enriched = join_dimension(fresh.select("character_id", "sale_date", "amount", STAMP),
                              master.select("character_id", "house"), "character_id", "left")
    # max over the numeric stamp keeps the aggregation a hash aggregation (a string
    # max would force a sort-based one); the text is formatted once per group.
    return enriched.groupBy("sale_date", "house").agg(
        F.sum("amount").cast("bigint").alias("amount"), F.max(STAMP).alias("__last"))


def _has_house() -> Column:
    return F.col("sale_date").isNotNull() & F.col("house").isNotNull()


def _result(groups: DataFrame) -> DataFrame:
    return groups.filter(_has_house()).select(
        "sale_date", "house", "amount", hex_stamp("__last").alias("last_verstamp")).orderBy("sale_date", "house")


def unmatched_keys(sales: DataFrame, master: DataFrame, watermark: str | None = None) -> DataFrame:
    """Distinct fresh keys without a house (unknown key or NULL house) and their row count:
    these rows are dropped from the rollup, so they are reported instead of lost silently."""
    fresh = fresh_rows(sales, watermark)
    keys = master.select("character_id").filter(F.col("house").isNotNull() if "house" in master.columns else F.lit(True))
    return (fresh.join(keys, "character_id", "left_anti")
            .groupBy("character_id").agg(F.count(F.lit(1)).alias("rows")))


def next_watermark(sales: DataFrame, watermark: str | None) -> DataFrame:
    """One row ``verstamp``: the newest stamp among the fresh rows (NULL when none)."""
    return fresh_rows(sales, watermark).agg(F.max(STAMP).alias("__w")).select(
        F.when(F.col("__w").isNotNull(), hex_stamp("__w")).alias("verstamp"))


def distinct_lookup(sales: DataFrame, master: DataFrame) -> DataFrame:
    """Distinct sale keys with their house (NULL when unknown): the per-key lookup set."""
    keys = sales.select("character_id").distinct()
    return join_dimension(keys, master.select("character_id", "house"), "character_id", "left")


@dataclass
class BatchResult:
    old_watermark: str
    new_watermark: str | None
    output_path: str | None
    rows_written: int


def run_batch(
    spark: SparkSession,
    sales: DataFrame,
    master: DataFrame,
    state_path: str,
    output_base: str,
) -> BatchResult:
    """One incremental run over the stamps ``(old, new]``.

    The fact rows are read once: grouped, with the rows that have no house or date as
    groups of their own, so the newest stamp comes from the same small result. The
    range is recorded as intended before anything is written and committed after; a
    run that finds an uncommitted range repeats exactly that one into the same
    directory, whatever has arrived since. Without any state the newest result
    already written tells where to go on.
    """
    state = read_state(spark, state_path)
    old = state.verstamp if state else newest_output(spark, output_base) or ZERO_STAMP
    pending = state.intended if state else None
    fresh = fresh_rows(sales, old, pending)
    staged_path = scratch_dir(spark, "house-sales")
    _by_house(fresh, master).write.parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    newest, n = staged.agg(F.max("__last"), F.count_if(_has_house())).first()
    if newest is None:  # nothing new: no output, state unchanged
        return BatchResult(old, None, None, 0)
    new = pending or staged.select(hex_stamp(F.lit(newest)).alias("s")).first()["s"]
    write_watermark(spark, state_path, old, intended=new)
    path = write_stamped(_result(staged), output_base, new)
    write_watermark(spark, state_path, new)
    return BatchResult(old, new, path, n)


def run_stream_batch(spark: SparkSession, sales: DataFrame, master: DataFrame, floor: str,
                     state_path: str, path: str) -> None:
    """One micro-batch into its own directory; the state moves up to the newest stamp seen."""
    staged_path = scratch_dir(spark, "house-sales")
    _by_house(fresh_rows(sales, floor), master).write.parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    newest = staged.agg(F.max("__last")).first()[0]
    if newest is None:
        return
    _result(staged).write.mode("overwrite").option("header", True).csv(path)
    if newest > int(read_watermark(spark, state_path), 16):
        write_watermark(spark, state_path, staged.select(hex_stamp(F.lit(newest)).alias("s")).first()["s"])


def lookup_seed(sales: DataFrame) -> DataFrame:
    """Distinct keys with an empty ``house`` column: the set a per-key lookup fills in."""
    return sales.select("character_id").distinct().withColumn("house", F.lit(""))


# ---- the three scheduled steps, as separate callables over files ---------------

def ensure_watermark(spark: SparkSession, path: str, is_restart: bool = False) -> str:
    """Step 1: create the state with the zero stamp if missing, or reset it on restart."""
    current = read_watermark(spark, path, default=None)
    if current is None or is_restart:
        write_watermark(spark, path, ZERO_STAMP)
        return ZERO_STAMP
    return current


def compute_house_sales(spark: SparkSession, path_verstamp: str, path_sales: str, path_house_sales: str,
                        master_snapshot: str, master_lines: bool = False) -> BatchResult:
    """Step 2 (+3): the rollup of fresh sales into ``<path_house_sales>/verstamp=<new>``.

    The master data is a JSON snapshot (a list, or lines) re-read on every run. The state advances in
    the same call, from the same fresh frame that was aggregated, so rows arriving
    between the two steps are not skipped.
    """
    master = (read_master_json_lines if master_lines else read_master_json)(spark, master_snapshot)
    return run_batch(spark, read_sales(spark, path_sales), master, path_verstamp, path_house_sales)
