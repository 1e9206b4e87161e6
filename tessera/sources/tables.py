"""Parquet tables of a data directory (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy scan of one table; projections and filters reach the Parquet reader."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the tables of one directory: ``Tables(spark, d).lineitem``."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return table(self.spark, self.data_dir, name)


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """Whole-table read of a catalog table (``schema.name``), optionally projected."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              partitions: int = 1) -> DataFrame:
    """Row-store table over JDBC; with a partition column the read is split into parallel ranges."""
    opts = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=partitions, properties=opts)
    return spark.read.jdbc(url, table, properties=opts)
