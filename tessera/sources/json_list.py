"""Objects of a JSON list, read by many tasks.

A list such as ``[{…}, {…}]`` is one JSON value, and a JSON reader gives it to one task. Here the file is read as text
cut at every ``}``, which Spark splits by offsets like any text. Whether a piece lies inside a string, and how deep,
depends on all before it, but only through two things that add up: the parity of unescaped quotes and the
balance of braces. So each block sums up what it does for both ways it may begin; blocks are chained by their
sums (one row for each block), and every piece then knows its depth. An object ends where the depth returns
to zero; its pieces, which may come from two blocks, are joined and parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_dir
from tessera.sources.files import CHARACTER_SCHEMA


def _braces(plain: Column, inside: bool) -> Column:
    """Opening braces of a piece that stand outside strings, if it begins ``inside`` one or not."""
    segments = F.split(plain, '"', -1)
    outside = F.filter(segments, lambda _, i: i % 2 == int(inside))
    return F.length(F.regexp_replace(F.array_join(outside, ""), "[^{]", ""))


def read_list_objects(spark: SparkSession, path: str) -> DataFrame:
    """``file, number, object``: the text of every object of the lists in the files under ``path``, numbered from 0 in
    each file. Strings may hold braces and escaped quotes, objects may be nested; a list of other values gives none."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    # Written once: later passes see the same pieces in the same order. JSON's escapes never end in a brace, so no piece ends within one.
    work = scratch_dir(spark, "json-list")
    plain = F.regexp_replace("value", r"\\.", "")
    quotes = F.size(F.split(plain, '"', -1)) - 1
    raw.select("*", quotes.alias("quotes"), _braces(plain, False).alias("open0"), _braces(plain, True).alias("open1")).write.parquet(work)
    pieces = spark.read.parquet(work)
    inside = Window.partitionBy("file", "block").orderBy("at")  # a block is as large as a task reads
    # For a block that begins outside a string (0) or inside one (1): the state behind a piece, and the depth, relative to the block's.
    parity = F.sum("quotes").over(inside) % 2
    before = (F.sum("quotes").over(inside) - F.col("quotes")) % 2
    known = pieces.withColumn("behind", parity).withColumn("before", before)
    for start in (0, 1):
        opened = F.when((F.col("before") + start) % 2 == 0, F.col("open0")).otherwise(F.col("open1"))
        closes = ((F.col("behind") + start) % 2 == 0).cast("int")
        known = known.withColumn(f"depth{start}", F.sum(opened - closes).over(inside))
    last = F.max_by(F.struct("behind", "depth0", "depth1"), "at").alias("s")
    blocks = known.groupBy("file", "block").agg(last).select("file", "block", "s.*")
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The parity decides which of its two sums a block adds.
    blocks = blocks.withColumn("start", F.coalesce(F.sum("behind").over(along), F.lit(0)) % 2)
    blocks = blocks.withColumn("moved", F.when(F.col("start") == 0, F.col("depth0")).otherwise(F.col("depth1")))
    blocks = blocks.select("file", "block", "start", F.coalesce(F.sum("moved").over(along), F.lit(0)).alias("base"))
    placed = known.join(blocks, ["file", "block"])
    closing = (F.col("behind") + F.col("start")) % 2 == 0
    depth = F.col("base") + F.when(F.col("start") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    placed = placed.withColumn("ends", (closing & (depth == 0)).cast("long"))
    # Objects are numbered by the ends before them: within a block, and by the blocks' numbers of ends.
    ends = placed.groupBy("file", "block").agg(F.sum("ends").alias("n")).withColumn("first", F.coalesce(F.sum("n").over(along), F.lit(0)))
    number = F.sum("ends").over(inside) - F.col("ends")
    numbered = placed.withColumn("inner", number).join(ends.select("file", "block", "first"), ["file", "block"]).withColumn("number", F.col("first") + F.col("inner"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "}")
    objects = numbered.groupBy("file", "number").agg(text.alias("text"), F.max("ends").alias("whole")).where("whole = 1")
    return objects.select("file", "number", F.concat(F.regexp_replace("text", r"^[^{]*", ""), F.lit("}")).alias("object"))


def read_master_json_list(spark: SparkSession, path: str, schema: T.StructType = CHARACTER_SCHEMA) -> DataFrame:
    """Master data as a JSON list, like ``sources.files.read_master_json`` but by many tasks."""
    rows = read_list_objects(spark, path).select(F.from_json("object", schema, {"mode": "FAILFAST"}).alias("o")).select("o.*")
    return rows.select(F.col("id").alias("character_id"), "name", "house")
