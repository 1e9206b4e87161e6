"""Catalog-table sinks: INSERT INTO … SELECT, CSV loads into named tables, lookup files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.files import read_semicolon_csv


def append_table(df: DataFrame, table: str) -> None:
    """``INSERT INTO table SELECT …`` (K6): by position into an existing table, else create it."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.write.insertInto(table)
    else:
        df.write.mode("append").saveAsTable(table)


def load_csv_table(spark: SparkSession, path: str, table: str, drop: Sequence[str] = (),
                   mode: str = "overwrite", location: str | None = None) -> DataFrame:
    """Spreadsheet export → named table (K10): drop unneeded columns, lower-case header. ``location``
    makes it an external table."""
    df = read_semicolon_csv(spark, path)
    df = df.drop(*[c.lower() for c in drop])
    writer = df.write.mode(mode)
    (writer.option("path", location) if location else writer).saveAsTable(table)
    return spark.table(table)


def write_lookup_csv(df: DataFrame, path: str) -> None:
    """Merged per-key lookup results as one CSV file set (K9), replaced on each run."""
    df.write.mode("overwrite").option("header", True).csv(path)
