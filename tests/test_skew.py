"""Hot keys: a client holding a third of all activities, a group holding a third of
all rows. Results stay exact under forced shuffle joins, and the hot key is salted."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.plans import channels as C

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _frames(spark):
    n = 30000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("c"), (F.col("id") % 997).cast("string")))
        .alias("con_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") % 5000))
        .alias("created"),
        F.element_at(F.array(F.lit("E"), F.lit("S"), F.lit("CALL")), (F.col("id") % 3 + 1).cast("int")).alias("todo_cd"),
        F.when(F.col("id") % 7 == 0, F.lit("bad")).otherwise(F.lit("ok")).alias("stat"),
        F.when(F.col("id") % 5 == 0, F.lit("")).otherwise(F.lit("note")).alias("comments_long"),
    )
    ids = base.select("con_id").distinct()
    contact = ids.select(F.col("con_id").alias("row_id"), F.lit("F").alias("fst_name"), F.lit("M").alias("mid_name"),
                         F.lit("L").alias("last_name"), F.lit("s").alias("x_gb_status"))
    addr = ids.select(F.col("con_id").alias("per_id"), F.explode(F.array(
        F.struct(F.lit("e@x").alias("addr"), F.lit("Email").alias("comm_medium_cd")),
        F.struct(F.lit("7900").alias("addr"), F.lit("Phone").alias("comm_medium_cd")))).alias("a")).select(
        "per_id", "a.addr", "a.comm_medium_cd")
    branches = [
        C.Branch("e", F.col("todo_cd") == "E", F.col("comm_medium_cd") == "Email"),
        C.Branch("s", F.col("todo_cd") == "S", F.col("comm_medium_cd") == "Phone"),
        C.Branch("c", (F.col("todo_cd") == "CALL") & (F.col("stat") != "bad") & (F.col("comments_long") != ""),
                 F.col("comm_medium_cd") == "Phone"),
    ]
    return base, contact, addr, branches


def test_hot_client_report_is_exact_and_spread(spark):
    base, contact, addr, branches = _frames(spark)
    old = {k: spark.conf.get(k, None) for k in list(SKEW_CONF) + ["spark.sql.adaptive.enabled"]}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        want = sorted(map(tuple, C.latest_channel_report(base, contact, addr, branches).collect()))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = C.latest_channel_report(base, contact, addr, branches)
        got = sorted(map(tuple, df.collect()))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == want and len(got) > 0


def test_hot_group_leave_one_out_is_salted_and_exact(spark):
    from tessera.operators.aggregates import leave_one_out_product

    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 2000).alias("g"),
        "id", F.when(F.col("id") % 997 == 0, 0).when(F.col("id") % 5 == 0, 2).otherwise(1).alias("v"))
    old = {k: spark.conf.get(k, None) for k in list(SKEW_CONF) + ["spark.sql.adaptive.enabled"]}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        want = sorted(map(tuple, leave_one_out_product(rows, ["g"], "v").collect()))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        # the at-scale path: statistics too big to broadcast, groups over 2,000 rows are hot
        df = leave_one_out_product(rows, ["g"], "v", broadcast_limit=0, hot_rows=2000)
        got = sorted(map(tuple, df.collect()))
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == want
    # the hot group (10,000 rows) is joined in five slices, under either value of the setting
    assert "__salted" in final
    for value in ("true", "false"):
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", value)
        try:
            df = leave_one_out_product(rows, ["g"], "v", broadcast_limit=0, hot_rows=2000)
            assert "hashpartitioning(__salted" in _shuffled_plan(spark, df)
        finally:
            spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_join_back_spreads_hot_keys_and_keeps_null_keys(spark):
    """The largest slice of the hot key stays near the threshold; rows of the NULL key keep their statistics."""
    from tessera.operators.joins import join_back

    rows = spark.range(12000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("g"), F.lit(1).alias("same"))
    stats = rows.groupBy("g").agg(F.count("*").alias("n"), F.sum("same").alias("total"))
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(k, "-1")
        out = join_back(rows, stats, ["g"], "n", limit=0, hot_rows=500)
        assert out.columns == ["g", "same", "total"]
        assert {tuple(r) for r in out.groupBy("g", "total").count().collect()} == {(None, 4000, 4000), (1, 4000, 4000), (2, 4000, 4000)}
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = join_back(rows, stats, ["g"], "n", limit=0, hot_rows=500).groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 6000 and len(sizes) > 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _shuffled_plan(spark, df):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _joins_on_whole_key(spark, df):
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        return "hashpartitioning(__key" in _shuffled_plan(spark, df)
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_hot_client_latest_rows_salted(spark):
    from tessera.operators import joins as J

    base, _, _, branches = _frames(spark)
    want = sorted(map(tuple, base.join(
        base.filter(branches[0].qualifies).groupBy("con_id").agg(F.max("created").alias("created")),
        ["con_id", "created"]).collect()))
    df = J.latest_rows(base, "con_id", "created", branches[0].qualifies)
    got = sorted(map(tuple, df.select(*base.columns).collect()))
    assert got == want
    assert _joins_on_whole_key(spark, df)
