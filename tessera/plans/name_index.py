"""Name search by pattern, over an index of trigrams.

The index holds one row for each name and distinct trigram of it (start and end of the name count as
letters, so that anchored patterns have trigrams too), in directories by a hash of the trigram and sorted by it
inside files; beside it stands the number of rows of each trigram. A search takes the trigrams that
every match must hold, looks up their numbers, and reads the rows of the rarest one only: one directory, and in
it the row groups of that trigram. Its rows carry the name, so they are verified by ``LIKE`` where they are read.
A pattern that fixes no three letters in a row has no trigram: then all names are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
START, END = "\x02", "\x03"
GRAM = 3


def trigrams(text: Column) -> Column:
    """Distinct trigrams of a text with its ends marked."""
    marked = F.concat(F.lit(START), text, F.lit(END))
    return F.array_distinct(F.regexp_extract_all(marked, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def build_name_index(people: DataFrame, path: str, name: str = "last_name", key: str = "customer_id") -> None:
    """Write the index of ``name``. Names of all lengths have trigrams but the empty one; NULL names have none.
    Rows of a frequent trigram are dealt by their key, so no task gets all of them."""
    named = people.where(F.col(name).isNotNull()).select(F.col(key).alias("key"), F.col(name).alias("name"))
    rows = named.withColumn("gram", F.explode(trigrams(F.col("name")))).withColumn("bucket", _bucket(F.col("gram")))
    out = rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "gram")
    out.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")
    counts = people.sparkSession.read.parquet(f"{path}/rows").groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
    counts.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/counts")


def required_trigrams(pattern: str) -> list[str]:
    """Trigrams that every match of a LIKE pattern holds. ``%`` is any text, ``_`` any character, ``\\`` takes the next
    character as it is."""
    parts, now, i = [], START, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            i += 1
            now += pattern[i]
        elif ch in "%_":
            parts.append(now)
            now = ""
        else:
            now += ch
        i += 1
    parts.append(now + END)
    return sorted({p[i:i + GRAM] for p in parts for i in range(len(p) - GRAM + 1)})


def search_names(spark: SparkSession, path: str, people: DataFrame, pattern: str, name: str = "last_name", key: str = "customer_id") -> DataFrame:
    """``key`` and ``name`` of everyone whose name is LIKE ``pattern``."""
    grams = required_trigrams(pattern)
    verified = F.col("name").like(pattern)
    if not grams:
        return people.select(F.col(key).alias("key"), F.col(name).alias("name")).where(verified).toDF(key, name)
    in_buckets = F.col("bucket").isin([r[0] for r in spark.createDataFrame([(g,) for g in grams], "g string").select(_bucket(F.col("g"))).collect()])
    counts = spark.read.parquet(f"{path}/counts").where(in_buckets & F.col("gram").isin(grams)).select("gram", "n", "bucket").collect()
    held = {r["gram"]: (r["n"], r["gram"], r["bucket"]) for r in counts}  # at most a pattern's length
    if len(held) < len(grams):  # some trigram occurs in no name
        return people.select(key, name).limit(0)
    _, rarest, bucket = min(held.values())
    rows = spark.read.parquet(f"{path}/rows").where((F.col("bucket") == bucket) & (F.col("gram") == rarest) & verified)
    return rows.select(F.col("key").alias(key), F.col("name").alias(name))
