"""Fixture cases of the small operators (expected values from the original examples)."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.stamps import hex_stamp, stamp_value
from tessera.functions.text import common_prefix, extract_uuid, is_balanced
from tessera.functions.timeparts import parse_dmy_date, parse_dmy_timestamp, trunc_ntz
from tessera.operators.aggregates import common_prefix_per_group, leave_one_out_product, sorted_distinct
from tessera.operators.joins import first_pair_with_sum, latest_rows
from tessera.operators.quality import duplicate_keys, null_counts, orphans


def _indexed(spark, values, group="g"):
    return spark.createDataFrame([(group, i, v) for i, v in enumerate(values)], "g string, i long, v long")


@pytest.mark.parametrize("values,target,pair", [([3, 2, 4], 6, (1, 2)), ([15, 2, 11, 7], 9, (1, 3)),
                                                ([3, 3], 6, (0, 1)), ([1, 5, 1, 5], 6, (0, 1)),
                                                ([1, 2], 7, None)])
def test_first_pair_with_sum(spark, values, target, pair):
    out = first_pair_with_sum(_indexed(spark, values), ["g"], "i", "v", target).collect()
    got = (out[0]["i"], out[0]["j"]) if out else None
    assert got == pair


def test_first_pair_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    rows = [(f"g{rnd.randint(0, 5)}", i, rnd.randint(0, 12)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i long, v long")
    got = {r["g"]: (r["i"], r["j"]) for r in first_pair_with_sum(df, ["g"], "i", "v", 12).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        items = sorted((i, v) for gg, i, v in rows if gg == g)
        pairs = [(a[0], b[0]) for x, a in enumerate(items) for b in items[x + 1:] if a[1] + b[1] == 12]
        if pairs:
            want[g] = min(pairs)
    assert got == want


@pytest.mark.parametrize("values,expected", [([0, 0], [0, 0]), ([1, 2, 3, 4], [24, 12, 8, 6]),
                                             ([0, 0, 5], [0, 0, 0]), ([0, 1, 2], [2, 0, 0]), ([7], [1]),
                                             ([2] * 60, [2**59] * 60),          # beyond exact doubles
                                             ([0] + [2] * 60, [2**60] + [0] * 60),
                                             ([2] * 53, [2**52] * 53)])
def test_leave_one_out(spark, values, expected):
    out = leave_one_out_product(_indexed(spark, values), ["g"], "v").orderBy("i").collect()
    assert [r["product_except_self"] for r in out] == expected


def test_common_prefix(spark):
    df = spark.createDataFrame([("a", "flower"), ("a", "flow"), ("a", "flight"), ("b", "dog"), ("b", "car"),
                                ("c", "solo")], "g string, s string")
    got = {r["g"]: r["prefix"] for r in common_prefix_per_group(df, ["g"], "s").collect()}
    assert got == {"a": "fl", "b": "", "c": "solo"}
    assert spark.range(1).select(common_prefix(F.lit("abc"), F.lit("abd")).alias("p")).first()["p"] == "ab"


@pytest.mark.parametrize("text,ok", [("()", True), ("([a)]", False), ("]", False), ("", True), ("{[x]}", True),
                                     ("((", False), ("a(b[c]{d}e)f", True), ("}{", False)])
def test_balanced(spark, text, ok):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(is_balanced("s").alias("b")).first()["b"] is ok


def test_extract_uuid(spark):
    df = spark.createDataFrame([("x c3b1f9a5-b87b-48bf-b00d-95b093ea6390 y",), ("none",)], "s string")
    got = [r["u"] for r in df.select(extract_uuid("s").alias("u")).collect()]
    assert got == ["c3b1f9a5-b87b-48bf-b00d-95b093ea6390", ""]


def test_hex_stamps(spark):
    df = spark.createDataFrame([(249327,), (0,), (0x123456789,)], "n long")
    rows = df.select(hex_stamp("n").alias("s")).select("s", stamp_value("s").alias("n")).collect()
    assert [r["s"] for r in rows] == ["0x0003cdef", "0x00000000", "0x123456789"]
    assert [r["n"] for r in rows] == [249327, 0, 0x123456789]


def test_dmy_parsing_and_trunc(spark):
    df = spark.createDataFrame([("25.01.2024 5:26:03", "19.04.2018"), ("25.01.2024 5:26", ""),
                                ("junk", None)], "t string, d string")
    rows = df.select(parse_dmy_timestamp("t").alias("t"), parse_dmy_date("d").alias("d")).collect()
    assert [str(r["t"]) for r in rows] == ["2024-01-25 05:26:03", "2024-01-25 05:26:00", "None"]
    assert [str(r["d"]) for r in rows] == ["2018-04-19", "None", "None"]
    w = spark.createDataFrame([("2024-01-03 10:00:00",)], "t string").select(
        trunc_ntz("week", F.col("t").cast("timestamp_ntz")).alias("w"))
    assert str(w.first()["w"]) == "2024-01-01 00:00:00"  # weeks start on Monday
    assert dict(w.dtypes)["w"] == "timestamp_ntz"


def test_quality_checks(spark):
    child = spark.createDataFrame([(1, 10), (1, 10), (2, 99), (3, None)], "k long, fk long")
    parent = spark.createDataFrame([(10,)], "id long")
    assert [tuple(r) for r in duplicate_keys(child, ["k", "fk"]).collect()] == [(1, 10, 2)]
    assert sorted(r["k"] for r in orphans(child, parent, "fk", "id").collect()) == [2, 3]
    assert null_counts(child, ["k", "fk"]).first().asDict() == {"k": 0, "fk": 1}


def test_sorted_distinct(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", "z")], "g string, x string")
    assert sorted_distinct(df, ["g"], "x", "xs").first()["xs"] == ["b", "z"]


def test_latest_rows_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, "t1"), ("a", 3, "t1"), ("a", 3, "t2"), ("a", 5, "t2")],
                               "e string, ts long, kind string")
    out = latest_rows(df, "e", "ts", F.col("kind") == "t1").collect()
    assert sorted((r["ts"], r["kind"]) for r in out) == [(3, "t1"), (3, "t2")]


def test_size_checked_broadcast(spark):
    from tessera.operators.joins import estimated_bytes, maybe_broadcast

    small = spark.range(3).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    size = estimated_bytes(small)
    assert isinstance(size, int) and 0 < size < 10**6
    # unknown size (local rows) is never broadcast by the check
    assert estimated_bytes(spark.createDataFrame([(1,)], "k long")) > 10**12
    big = spark.range(10).select(F.col("id").alias("k"))

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(big.join(maybe_broadcast(small, limit=10**9), "k"))
    assert "strategy=broadcast" not in plan(big.join(maybe_broadcast(small, limit=1), "k"))


@pytest.mark.parametrize("text,ok", [("(" * 3000 + ")" * 3000, True), ("(" * 3000 + "]" + ")" * 2999, False),
                                     ("x" * 10 + "{[()]}" * 200, True), ("(" * 400, False)])
def test_balanced_long_inputs(spark, text, ok):
    df = spark.createDataFrame([(text,), ("()",)], "s string")
    got = [r["b"] for r in df.select(is_balanced("s").alias("b")).collect()]
    assert got == [ok, True]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_back_salted_equals_plain_join(spark, how):
    from tessera.operators.joins import join_back

    rows = spark.range(5000).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
                                    "id")
    stats = rows.groupBy("k").agg(F.max("id").alias("mx"), F.count(F.lit(1)).alias("n")).filter("k <> 7")
    want = sorted(map(tuple, rows.join(stats.drop("n"), "k", how).collect()))
    got = sorted(map(tuple, join_back(rows, stats, ["k"], "n", how, limit=0, hot_rows=300).select(
        "k", "id", "mx").collect()))
    assert got == want


def test_first_pair_salted_matches_brute_force(spark):
    import random

    rnd = random.Random(11)
    rows = [("hot" if i % 3 == 0 else f"g{rnd.randint(0, 5)}", i, 6 if i % 3 == 0 else rnd.randint(0, 12))
            for i in range(600)]
    df = spark.createDataFrame(rows, "g string, i long, v long")
    got = {r["g"]: (r["i"], r["j"]) for r in first_pair_with_sum(df, ["g"], "i", "v", 12, hot_rows=20).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        items = sorted((i, v) for gg, i, v in rows if gg == g)
        pairs = [(a[0], b[0]) for x, a in enumerate(items) for b in items[x + 1:] if a[1] + b[1] == 12]
        if pairs:
            want[g] = min(pairs)
    assert got == want


def test_leave_one_out_is_exact_beyond_doubles(spark):
    import pytest as pt

    rows = [(1, 10**6)] * 3 + [(2, 3), (2, 3002399751580331), (None, 2), (None, 5), (3, 0), (3, 0), (3, 7), (4, 0), (4, -3), (5, -2), (5, -7), (5, 1)]
    df = spark.createDataFrame(rows, "g int, v long")
    got = sorted(((r["g"], r["v"], int(r["product_except_self"])) for r in leave_one_out_product(df, ["g"], "v").collect()), key=str)
    assert got == sorted([(1, 10**6, 10**12)] * 3 + [(2, 3, 3002399751580331), (2, 3002399751580331, 3), (None, 2, 5), (None, 5, 2), (3, 0, 0), (3, 0, 0),
                         (3, 7, 0), (4, 0, -3), (4, -3, 0), (5, -2, -7), (5, -7, -2), (5, 1, 14)], key=str)
    with pt.raises(Exception, match="38 digits"):
        leave_one_out_product(spark.createDataFrame([(1, 10**9)] * 6, "g int, v long"), ["g"], "v").collect()
    # Only the result is limited: the product of all five has 46 digits.
    five = leave_one_out_product(spark.createDataFrame([(1, 10**9)] * 5, "g int, v long"), ["g"], "v").collect()
    assert {int(r["product_except_self"]) for r in five} == {10**36}
    big = spark.range(500).select(F.lit(1).alias("g"), F.when(F.col("id") < 2, 0).otherwise(9).alias("v"))
    assert {int(r[0]) for r in leave_one_out_product(big, ["g"], "v").select("product_except_self").collect()} == {0}


def test_brackets_are_decided_in_the_jvm(spark):
    from tessera.functions.text import is_balanced

    cases = {"": True, "x": True, "()": True, "([a)]": False, "]": False, "{[x]}": True, "(" * 3000 + ")" * 3000: True, "()" * 5000 + "[": False,
             ")(": False, "(]" + "[)": False}
    df = spark.createDataFrame([*cases.items(), (None, None)], "s string, want boolean").withColumn("got", is_balanced("s"))
    assert all(r["want"] == r["got"] for r in df.collect())
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_brackets_combine_like_one_walk(spark):
    """Runs combined in halves against one stack: random strings over all run boundaries, and deep nesting."""
    import random
    import time

    from tessera.functions.text import BRACKET_RUN, bracket_residue, is_balanced

    def walk(text):
        stack, closers = [], ""
        for ch in text:
            if ch in "([{":
                stack.append(ch)
            elif stack:
                if stack.pop() + ch not in ("()", "[]", "{}"):
                    return None
            else:
                closers += ch
        return closers, "".join(stack)

    rng = random.Random(9)

    def nested(n):
        out = ""
        while n > 0:
            k = min(n, rng.randrange(1, 90))
            inner = "".join(rng.choice("([{") for _ in range(k))
            out = inner + out + inner[::-1].translate(str.maketrans("([{", ")]}")) if rng.random() < .5 else out + inner + inner[::-1].translate(str.maketrans("([{", ")]}"))
            n -= k
        return out

    texts = ["", "(", ")", ")(", "(]"] + [nested(rng.randrange(1, 400)) for _ in range(60)]
    for text in list(texts[5:]):  # cut out of the middle, and one bracket turned
        i, j = sorted((rng.randrange(len(text) + 1), rng.randrange(len(text) + 1)))
        k = rng.randrange(len(text))
        texts += [text[i:j], text[:k] + rng.choice("()[]{}") + text[k + 1:]]
    texts += ["(" * n + ")" * n for n in (BRACKET_RUN - 1, BRACKET_RUN, BRACKET_RUN + 1, 5000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").select("i", bracket_residue(F.col("s")).alias("r"), is_balanced("s").alias("ok"))
    for r in df.collect():
        want = walk(texts[r["i"]])
        assert (None if r["r"]["broken"] else (r["r"]["closers"], r["r"]["openers"])) == want and r["ok"] == (want == ("", ""))
    deep = "([{" * 333_334
    big = "a word, " * 1_000_000 + deep + deep[::-1].translate(str.maketrans("([{", ")]}"))
    one = spark.createDataFrame([(big,), (big + "(",), (big[:-1] + "]",)], "s string").repartition(3)
    one.select(F.length("s")).collect()
    start = time.time()
    assert sorted(r[0] for r in one.select(is_balanced("s")).collect()) == [False, False, True]
    assert time.time() - start < 60


def test_semicolon_first_column(spark, workdir):
    from tessera.sources.files import read_semicolon_csv

    for name, text in (("named", "KEY;VAL\na;1\n"), ("blank", ";KEY;VAL\n0;a;1\n"), ("bom", "\ufeff;KEY;VAL\n0;a;1\n")):
        with open(f"{workdir}/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)
        df = read_semicolon_csv(spark, f"{workdir}/{name}.csv")
        assert df.columns == ["key", "val"] and [tuple(r) for r in df.collect()] == [("a", "1")]


def test_panel_columns_follow_metric_ids(spark):
    from tessera.operators.aggregates import ordered_list_text
    from tessera.plans.generate import metric_catalog_range

    got = ordered_list_text(metric_catalog_range(spark, 12, 1600), ["table_name"], "name", ",", "columns", by="metric_id").collect()
    assert [r["columns"] for r in got] == [",".join(f"metric_{i}" for i in range(1, 13))]


def test_catalog_changes_are_seen(spark, workdir):
    from tessera.plans.bindings import metric_store
    from tessera.sources.tables import Tables

    from conftest import SF001

    for name in ("events", "customer", "nation"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(f"{workdir}/{name}.parquet")
    before = len(metric_store(Tables(spark, workdir)).catalog_rows())
    ev = spark.read.parquet(f"{SF001}/events.parquet").limit(3).withColumn("event_type", F.lit("zz_new"))
    ev.write.mode("append").parquet(f"{workdir}/events.parquet")
    assert len(metric_store(Tables(spark, workdir)).catalog_rows()) == before + 1
