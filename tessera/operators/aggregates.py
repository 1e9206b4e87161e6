"""Grouped aggregate operators (all partial-aggregation friendly)."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import bignum as B
from tessera.functions.text import common_prefix
from tessera.operators.joins import DEFAULT_BROADCAST_LIMIT, HOT_KEY_ROWS, HOT_KEYS, join_back

LIST_ROWS = 100_000  # a group of more rows is not gathered into one list
BIGINT_DIGITS = 17.5  # products of fewer digits fit a bigint
SENT = 1 << 22  # characters of products that a task sends at a time


def _product(factors: list[int]) -> int:
    """Product of whole numbers, of neighbours first, so that long ones are multiplied late."""
    while len(factors) > 1:
        pairs = [a * b for a, b in zip(factors[::2], factors[1::2])]
        factors = pairs + factors[2 * len(pairs):]
    return factors[0] if factors else 1


def _products_but_one(cells: list[dict]) -> Iterator[str]:
    """For each distinct value ``v`` of a group, which occurs ``c`` times: the product of all other values."""
    zeros = sum(x["c"] for x in cells if x["v"] == 0)
    whole = _product([int(x["v"]) ** x["c"] for x in cells if x["v"]]) if zeros < 2 else 0
    shown = str(whole)
    for x in cells:
        v = x["v"]
        yield "0" if zeros - (v == 0) > 0 else str(whole // int(v)) if v else shown


def leave_one_out_values(rows: DataFrame, group: Sequence[str], value: str, out: str = "product_except_self",
                         count: str = "n") -> DataFrame:
    """Per group and distinct value: ``group``, ``value`` (``decimal(38,0)``), how often it occurs, and the
    product of all *other* values of its group as exact decimal text, whatever its length.

    Values are counted by (group, value) first, so a hot group shrinks to its distinct values; each group's list of
    (value, count) is no longer than its product has digits. Lists are dealt over a set number of tasks (they are
    small, the products are not), which multiply once a group, divide once a value and send the texts in bounded pieces.
    """
    g = list(group)
    session = rows.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    per_value = rows.groupBy(*g, F.col(value).cast(B.WIDE).alias(value)).agg(F.count(F.lit(1)).alias(count))
    cells = F.collect_list(F.struct(F.col(value).alias("v"), F.col(count).alias("c"))).alias("__cells")
    lists = per_value.repartition(tasks, *g).groupBy(*g).agg(cells)
    fields = [*[rows.schema[c] for c in g], T.StructField(value, T.DecimalType(38, 0)), T.StructField(count, T.LongType()), T.StructField(out, T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.set_int_max_str_digits(0)
        for batch in batches:
            listed = batch.column(batch.schema.names.index("__cells"))
            parents, flat = pa.compute.list_parent_indices(listed), listed.flatten()
            keys = [batch.column(batch.schema.names.index(c)) for c in g]

            def piece(lo: int, texts: list[str]) -> pa.RecordBatch:
                own, part = parents.slice(lo, len(texts)), flat.slice(lo, len(texts))
                return pa.RecordBatch.from_arrays([*[k.take(own) for k in keys], part.field("v"), part.field("c"), pa.array(texts, pa.string())],
                                                  names=[f.name for f in fields])

            lo, texts, length = 0, [], 0
            for cells in listed:
                for text in _products_but_one(cells.as_py()):
                    texts.append(text)
                    length += len(text)
                    if length >= SENT:
                        yield piece(lo, texts)
                        lo, texts, length = lo + len(texts), [], 0
            if texts:
                yield piece(lo, texts)

    return lists.mapInArrow(run, T.StructType(fields))


def _gathered(rows: DataFrame, g: list[str], value: str) -> DataFrame:
    """One row a group: ``__rows``, the other columns of its rows, with ``__zeros`` and ``__digits`` of its product."""
    lists = rows.groupBy(*g).agg(F.collect_list(F.struct(*[c for c in rows.columns if c not in g])).alias("__rows"))
    digits = F.aggregate("__rows", F.lit(0.0), lambda acc, r: acc + _digits(r[value]))
    return lists.withColumn("__digits", digits).withColumn("__zeros", F.size(F.filter("__rows", lambda r: r[value] == 0)))


def _digits(v: Column) -> Column:
    size = F.abs(v.cast("double"))
    return F.when(size > 1, F.log10(size)).otherwise(0.0)


def leave_one_out_text(
    rows: DataFrame, group: Sequence[str], value: str, out: str = "product_except_self",
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Each row gets the product of the *other* values of its group, as exact decimal text.

    Values are whole numbers; a NULL value counts as absent and gets the product of all
    others. Rules: no zero → P / v; one zero → P for the zero row, 0 for the others;
    two or more zeros → 0. Rows of the NULL group form a group.

    Groups are measured first. Rows are then shuffled once, by group, and those whose product fits a bigint are done
    there. Groups of very many rows (fewer than ``HOT_KEYS``, whatever the data) and those with long products
    go by distinct value (``leave_one_out_values``).
    """
    g = list(group)
    sizes = rows.groupBy(*g).agg(F.count(F.lit(1)).alias("__n"), F.sum(_digits(F.col(value))).alias("__d"))
    total, most, longest = sizes.agg(F.sum("__n"), F.max("__n"), F.max("__d")).first()
    bound = max(min(hot_rows, LIST_ROWS), (total or 0) / HOT_KEYS)
    cool, special = rows, []
    if (most or 0) > bound:
        hot = F.broadcast(sizes.where(F.col("__n") > bound).select(F.struct(*g).alias("__key")))
        keyed = rows.withColumn("__key", F.struct(*g))
        cool = keyed.join(hot, "__key", "left_anti").drop("__key")
        special.append(keyed.join(hot, "__key", "left_semi").select(*rows.columns))
    lists = _gathered(cool, g, value)
    if (longest or 0) > BIGINT_DIGITS - 0.5:  # the sums may be rounded differently
        special.append(lists.where(F.col("__digits") >= BIGINT_DIGITS).select(*g, F.inline("__rows")).select(*rows.columns))
        lists = lists.where(F.col("__digits") < BIGINT_DIGITS)
    whole = F.aggregate(F.filter("__rows", lambda r: r[value] != 0), F.lit(1).cast("bigint"), lambda acc, r: acc * r[value].cast("bigint"))
    each = lists.select(*g, "__zeros", whole.alias("__p"), F.inline("__rows"))
    mine = F.col(value).cast("bigint")
    others = F.call_function("div", F.col("__p"), F.when(mine != 0, mine).otherwise(1)).cast("string")
    other_zeros = F.col("__zeros") - F.coalesce(mine == 0, F.lit(False)).cast("int")
    parts = [each.select(*rows.columns, F.when(other_zeros > 0, "0").otherwise(others).alias(out))]
    for part in special:
        values = leave_one_out_values(part, g, value, out, "__n").withColumnRenamed(value, "__v")
        # Rows meet their value's result; values that many rows share are sliced.
        joined = join_back(part.withColumn("__v", F.col(value).cast(B.WIDE)), values, [*g, "__v"], "__n", "inner", limit=broadcast_limit, hot_rows=hot_rows)
        parts.append(joined.select(*rows.columns, out))
    return reduce(DataFrame.unionByName, parts)


def leave_one_out_product(
    rows: DataFrame, group: Sequence[str], value: str, out: str = "product_except_self",
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """``leave_one_out_text`` as ``decimal(38,0)``. A product of more than 38 digits raises an error,
    it is never NULL or rounded."""
    texts = leave_one_out_text(rows, group, value, out, broadcast_limit, hot_rows)
    digits = F.length(F.ltrim(F.col(out), F.lit("-")))
    too_long = F.raise_error(F.lit("a product of more than 38 digits")).cast(B.WIDE)
    return texts.withColumn(out, F.when(digits > 38, too_long).otherwise(F.col(out).cast(B.WIDE)))


def common_prefix_per_group(rows: DataFrame, group: Sequence[str], text: str, out: str = "prefix") -> DataFrame:
    """Longest common prefix of all strings in each group.

    The prefix of a set equals the prefix of its smallest and largest member, so the
    group only needs ``min``/``max`` (partial aggregation), never a list of members.
    """
    mm = rows.groupBy(*group).agg(F.min(text).alias("__mn"), F.max(text).alias("__mx"))
    return mm.select(*group, common_prefix("__mn", "__mx").alias(out))


def sorted_distinct(rows: DataFrame, group: Sequence[str], item: str, out: str) -> DataFrame:
    """``array_agg(DISTINCT x ORDER BY x)`` per group; the set is bounded by the distinct values."""
    return rows.groupBy(*group).agg(F.sort_array(F.collect_set(item)).alias(out))


def ordered_list_text(rows: DataFrame, group: Sequence[str], item: str, sep: str, out: str,
                      by: str | None = None) -> DataFrame:
    """``string_agg(x, sep ORDER BY by)`` per group (by the item itself without ``by``). The result is
    one text a group, so groups are as small as that text: the columns of a table, say."""
    pair = F.struct(F.col(by or item).alias("by"), F.col(item).alias("item"))
    items = F.transform(F.sort_array(F.collect_list(pair)), lambda x: x["item"])
    return rows.groupBy(*group).agg(F.array_join(items, sep).alias(out))


def first_last_seen(rows: DataFrame, group: Sequence[str], ts: str) -> DataFrame:
    """``min(ts) AS first_seen, max(ts) AS last_seen`` per group."""
    return rows.groupBy(*group).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))


def sum_columns(cols: Sequence[str], suffix: str = "_sum", cast: str | None = None) -> list[Column]:
    """``sum(c) AS c<suffix>`` for each column."""
    out = []
    for c in cols:
        s = F.sum(c)
        out.append((s.cast(cast) if cast else s).alias(f"{c}{suffix}"))
    return out
