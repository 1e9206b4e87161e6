"""A keyed lookup that is kept: each run asks only for keys that it has never met.

The lookup is a log of CSV files ``character_id,house,version`` under one directory, which a run only appends to: a run that is lost
half-way has added all of its answers or none. The newest version of a key wins; a key that was asked for
and not found is kept with an empty house, so it is not asked for again until it is asked to be refreshed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import maybe_broadcast
from tessera.session import scratch_dir
from tessera.sinks.files import append_csv
from tessera.sources.files import LOOKUP_SCHEMA, path_exists, read_header_csv

KEPT_SCHEMA = T.StructType([*LOOKUP_SCHEMA.fields, T.StructField("version", T.LongType())])


def read_kept(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row for each key, in its newest version (up to ``version``). Keys that repeat, within a version or over
    versions, come together: of one version's answers the least that is not empty holds."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], KEPT_SCHEMA)
    rows = read_header_csv(spark, path, KEPT_SCHEMA)
    if version is not None:
        rows = rows.where(F.col("version") <= version)
    # Greatest version, then an answer before none, then the least answer: max and min in one struct.
    best = F.max_by(F.struct("house", "version"), F.struct("version", F.col("house").isNotNull().alias("known"), _descending("house").alias("least")))
    return rows.groupBy("character_id").agg(best.alias("b")).select("character_id", "b.house", "b.version")


def _descending(text: str):
    """Orders texts backwards: the complement of their bytes, two hex digits each, closed by a digit above all."""
    return F.concat(F.translate(F.hex(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def refresh(spark: SparkSession, path: str, keys: DataFrame, look_up: Callable[[DataFrame], DataFrame], again: DataFrame | None = None) -> tuple[int, int]:
    """Look up the keys (column ``character_id``) that the lookup does not hold, and those of ``again`` anew.

    ``look_up`` gets a frame of distinct keys and returns ``character_id, house``. Returns the version written and
    the number of keys asked for (0: nothing was written)."""
    held = read_kept(spark, path).select("character_id", "version")
    newest = held.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    wanted = keys.select(F.col("character_id").cast("string").alias("character_id")).where("character_id IS NOT NULL").distinct()
    # A key that many rows share has met itself in the distinct; the anti join compares keys only.
    unseen = wanted.join(maybe_broadcast(held.select("character_id")), "character_id", "left_anti")
    if again is not None:
        unseen = unseen.unionByName(again.select(F.col("character_id").cast("string").alias("character_id")).where("character_id IS NOT NULL")).distinct()
    asked = scratch_dir(spark, "lookup-keys")
    unseen.write.parquet(asked)  # the lookup is asked once for each key, also if a task is run again later
    unseen = spark.read.parquet(asked)
    n = unseen.count()
    if not n:
        return newest, 0
    answers = look_up(unseen).select(F.col("character_id").cast("string").alias("character_id"), "house")
    rows = unseen.join(answers, "character_id", "left").withColumn("version", F.lit(newest + 1).cast("long"))
    append_csv(rows.select(*KEPT_SCHEMA.names), path)
    return newest + 1, n
