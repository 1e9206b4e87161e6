"""Micro-batches folded into months, so that readers list months and not batches.

Under a target directory::

    batches/batch=<id>/month=<m>/   rows of one micro-batch; a replay overwrites its own directory
    months/month=<m>/fold=<v>/      a month as fold ``v`` left it: the month before, and the batches since
    folds/                          one appended file for each committed fold

A fold reads the batches above the last folded one, and the months they touch, writes those months anew
under its own number (dynamic partition overwrite: doing it again replaces only itself), and
commits by appending one file: its number, the last batch folded in, and for every month the fold that holds it.
A reader takes each month from the fold that the newest commit names, and the batches above the
committed one. So a crash between any two steps neither loses nor doubles a row: before the commit
nothing refers to the new months, after it nothing refers to the folded batches. ``vacuum`` removes what the
newest commit does not refer to, once no reader of an earlier one is left.

``merge`` says how the rows of a month come together: all of them (a panel), or summed by key (a rollup).
Batches are numbered upwards by one writer, as a stream's micro-batches are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sinks.files import cluster_by_month
from tessera.sources.files import file_system, path_exists

COMMIT = "fold int, through long, month string, held_by int"


@dataclass(frozen=True)
class Commit:
    fold: int = 0
    through: int = -1  # the last batch folded in
    months: tuple[tuple[str, int], ...] = ()  # (month, the fold that holds it)


class FoldedStore:
    """``schema``: of the rows, without ``month``; ``month`` is a date column of every frame written."""

    def __init__(self, spark: SparkSession, target: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame] | None = None,
                 sort_within: tuple[str, ...] = ()):
        self.spark, self.schema, self.sort_within = spark, schema, sort_within
        self.merge = merge or (lambda rows: rows)
        self.batches, self.months, self.folds = (f"{target.rstrip('/')}/{part}" for part in ("batches", "months", "folds"))

    def _read(self, path: str, *partitions: str) -> DataFrame:
        fields = [T.StructField(p, {"month": T.DateType(), "batch": T.LongType(), "fold": T.IntegerType()}[p]) for p in partitions]
        schema = T.StructType([*self.schema.fields, *fields])
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def commit(self) -> Commit:
        """What the newest committed fold says."""
        if not path_exists(self.spark, self.folds):
            return Commit()
        rows = self.spark.read.schema(COMMIT).parquet(self.folds)
        newest = rows.agg(F.max("fold")).first()[0]
        if newest is None:
            return Commit()
        listed = rows.where(F.col("fold") == newest).collect()  # one row for each month
        return Commit(newest, listed[0]["through"], tuple(sorted((r["month"], r["held_by"]) for r in listed)))

    def write_batch(self, rows: DataFrame, batch: int) -> None:
        """The rows of a micro-batch, with ``month``. One that is folded already (a replay) changes nothing."""
        if batch <= self.commit().through:
            return
        self._write(rows, mode="overwrite", path=f"{self.batches}/batch={batch}", by=["month"])

    def _write(self, rows: DataFrame, mode: str, path: str, by: list[str]) -> None:
        out = cluster_by_month(rows.select(*self.schema.names, *by), "month")
        if self.sort_within:
            out = out.sortWithinPartitions("month", *self.sort_within)
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if "fold" in by else "static").partitionBy(*by).parquet(path)

    def _folded(self, commit: Commit) -> DataFrame:
        """Months from the folds that hold them: a predicate on the directories alone."""
        rows = self._read(self.months, "month", "fold")
        if not commit.months:
            return rows.where(F.lit(False)).drop("fold")
        held = F.create_map(*[F.lit(x) for pair in commit.months for x in pair])
        return rows.where(F.col("fold") == F.element_at(held, F.col("month").cast("string"))).drop("fold")

    def _loose(self, commit: Commit) -> DataFrame:
        return self._read(self.batches, "batch", "month").where(F.col("batch") > commit.through)

    def read(self, months: Column | None = None) -> DataFrame:
        """All rows with their ``month``, each once (merged, where the store merges). ``months``: a predicate on
        ``month``, which prunes directories."""
        commit = self.commit()
        rows = self._folded(commit).unionByName(self._loose(commit).drop("batch"))
        return self.merge(rows if months is None else rows.where(months))

    def fold(self) -> Commit:
        """Fold the batches written so far into their months, and commit."""
        commit = self.commit()
        loose = self._loose(commit)
        found = loose.groupBy(F.col("month").cast("string").alias("month")).agg(F.max("batch").alias("batch")).collect()  # one row for each month
        if not found:
            return commit
        through, fold = max(r["batch"] for r in found), commit.fold + 1
        touched = sorted(r["month"] for r in found)
        # Batches written meanwhile stay loose: the same bound as in the commit.
        rows = self._folded(commit).where(F.col("month").cast("string").isin(touched)).unionByName(
            loose.where(F.col("batch") <= through).drop("batch"))
        self._write(self.merge(rows).withColumn("fold", F.lit(fold)), mode="overwrite", path=self.months, by=["month", "fold"])
        held = dict(commit.months) | {m: fold for m in touched}
        self._append_commit(Commit(fold, through, tuple(sorted(held.items()))))
        return self.commit()

    def _append_commit(self, new: Commit) -> None:
        rows = [(new.fold, new.through, month, held_by) for month, held_by in new.months]
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("append").parquet(self.folds)

    def vacuum(self) -> int:
        """Remove folded batches and replaced months; the number of directories removed."""
        commit, gone = self.commit(), []
        held = dict(commit.months)
        for path in _children(self.spark, self.batches):
            if path.rsplit("=", 1)[-1].isdigit() and int(path.rsplit("=", 1)[-1]) <= commit.through:
                gone.append(path)
        for month in _children(self.spark, self.months):
            name = month.rsplit("month=", 1)[-1]
            gone += [p for p in _children(self.spark, month) if "fold=" in p and int(p.rsplit("=", 1)[-1]) <= commit.fold
                     and int(p.rsplit("=", 1)[-1]) != held.get(name)]
        for path in gone:
            fs, p = file_system(self.spark, path)
            fs.delete(p, True)
        return len(gone)


def summed(keys: list[str], sums: list[str]) -> Callable[[DataFrame], DataFrame]:
    """A merge that adds up partial sums by key and month. Decimals and whole numbers add up exactly in any order."""
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys, "month").agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in sums])
    return merge


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
