"""Data-quality checks that SQL constraints would enforce (Spark does not)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (UNIQUE / PK check)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent (FOREIGN KEY check), as a left anti join.

    The parent keys are not de-duplicated first: an anti join ignores duplicates,
    and with both sides coming straight from a scan AQE can split a hot child key.
    """
    p = parent.select(F.col(parent_key).alias("__pk"))
    return child.join(p, child[child_key] == p["__pk"], "left_anti")


def null_counts(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the number of NULLs per column (NOT NULL check)."""
    return rows.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])


def violation_summary(checks: dict[str, DataFrame]) -> DataFrame:
    """Union of ``(check, violations)`` rows, one per named check frame (counted lazily)."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit(name).alias("check"), "violations") for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
