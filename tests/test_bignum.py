"""Whole numbers as limbs, against Python's; leave-one-out products of any length."""

import math
import random
import sys

from pyspark.sql import functions as F

from tessera.functions import bignum as B
from tessera.operators import aggregates as A

sys.set_int_max_str_digits(100_000)


def test_arithmetic_equals_python(spark):
    rng = random.Random(2)
    sizes = [1, 9, 10, 18, 19, 38]
    pairs = [(rng.randrange(10 ** rng.choice(sizes)), rng.randrange(1, 10**9)) for _ in range(60)]
    pairs += [(0, 1), (10**38 - 1, 10**9 - 1), (10**9, 10**9 - 1), (10**27, 1), (999999999, 999999999)]
    df = spark.createDataFrame([(str(a), b) for a, b in pairs], "a string, m long").withColumn("x", B.from_decimal(F.col("a").cast(B.WIDE)))
    m = F.col("m")
    rows = df.select("a", "m", *[B.as_text(B.carried(c)).alias(n) for n, c in {
        "same": F.col("x"), "small": B.times_small(F.col("x"), m), "square": B.times(F.col("x"), F.col("x")),
        "cube": B.times(B.times(F.col("x"), F.col("x")), F.col("x"))}.items()], B.as_text(B.divided(B.carried(F.col("x")), m)).alias("part")).collect()
    for r in rows:
        a = int(r["a"])
        assert [int(r[c]) for c in ("same", "small", "square", "cube", "part")] == [a, a * r["m"], a * a, a**3, a // r["m"]]


def test_long_products(spark):
    rng = random.Random(1)
    groups = {1: [rng.randrange(-60, 60) or 1 for _ in range(1000)], 2: [rng.randrange(1, 10**17) for _ in range(40)],
              3: [10**9, 10**9, -10**18, 2, None], 4: [0, 5, None], 5: [0, 0, 3], 6: [7], 7: [None], None: [2, 10**9 - 1, 10**9 + 1],
              8: [2] * 2000 + [0], 9: [-1, 1, -1, -2], 10: [10**17, 9, 5]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g int, v long").repartition(7)
    want = sorted(((g, v, str(math.prod(x for j, x in enumerate(vs) if j != i and x is not None)))
                   for g, vs in groups.items() for i, v in enumerate(vs)), key=str)
    for limit in ({}, {"broadcast_limit": 0, "hot_rows": 50}):
        got = sorted((tuple(r) for r in A.leave_one_out_text(df, ["g"], "v", **limit).collect()), key=str)
        assert got == want
    assert A.leave_one_out_text(df.limit(0), ["g"], "v").collect() == []


def test_short_products_take_one_shuffle_of_the_rows(spark):
    rows = [(i // 4, i % 4, i % 13 - 3, f"t{i}") for i in range(400)] + [(None, 1, None, "x"), (None, 2, 5, "y")]
    df = spark.createDataFrame(rows, "g int, i int, v int, t string").repartition(6)
    out = A.leave_one_out_text(df, ["g"], "v", broadcast_limit=0)
    want = sorted(((*r, str(math.prod(x[2] for x in rows if x[0] == r[0] and x[1] != r[1] and x[2] is not None))) for r in rows), key=str)
    assert sorted((tuple(r) for r in out.collect()), key=str) == want
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan, plan


def test_long_products_are_dealt_over_all_tasks(spark):
    """However small their lists are, and in bounded pieces."""
    df = spark.range(40_000).selectExpr("id % 500 AS g", "id % 37 + 2 AS v")
    values = A.leave_one_out_values(df, ["g"], "v", "p")
    assert values.groupBy(F.spark_partition_id()).count().count() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = values.where("g = 7 AND v = 5").first()
    assert int(r["p"]) * 5 == math.prod(i % 37 + 2 for i in range(7, 40_000, 500))
    wide = spark.range(3000).selectExpr("0 AS g", "id + 10 AS v")
    got = {r["v"]: r["p"] for r in A.leave_one_out_values(wide, ["g"], "v", "p").collect()}
    whole = math.prod(range(10, 3010))
    assert len(got) == 3000 and all(int(got[v]) == whole // v for v in (10, 999, 3009))


def test_hot_rows_are_dealt_by_a_written_ordinal(spark):
    from tessera.operators.joins import join_back

    rows = spark.createDataFrame([(1, "same")] * 300 + [(2, "x"), (None, "y")], "k int, t string")
    stats = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("m"))
    out = join_back(rows, stats, ["k"], "n", limit=0, hot_rows=20)
    assert out.count() == 302 and "rand(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert "__ordinal" in out._jdf.queryExecution().optimizedPlan().toString()
