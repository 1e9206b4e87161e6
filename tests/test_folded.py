"""Batches folded into months: replays, crashes at every step, month pruning, rollups of late rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.streaming.folded import Commit, FoldedStore
from tessera.streaming.metric_ingest import live_rollup, panel_store, partial_sums, rollup_store, write_batch

SCHEMA = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("metric_timestamp", T.TimestampNTZType()),
                       T.StructField("value", T.DecimalType(18, 2))])


def _batch(spark, seed, n=40):
    rng = random.Random(seed)
    rows = [(rng.randrange(5), dt.datetime(2023, rng.randrange(1, 4), rng.randrange(1, 4), rng.randrange(24)), rng.randrange(1000)) for _ in range(n)]
    return spark.createDataFrame(rows, "customer_id long, metric_timestamp timestamp_ntz, v int").select(
        "customer_id", "metric_timestamp", (F.col("v") / 100).cast("decimal(18,2)").alias("value"))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _expected(batches):
    out = {}
    for b in batches:
        for r in b.collect():
            key = (r["customer_id"], r["metric_timestamp"].replace(hour=0))
            total, n = out.get(key, (0, 0))
            out[key] = (total + r["value"], n + 1)
    return sorted((c, d, s, n) for (c, d), (s, n) in out.items())


def test_folds_keep_every_row_once(spark, workdir):
    batches = [_batch(spark, i) for i in range(5)]
    panel, sums = panel_store(spark, workdir, SCHEMA), rollup_store(spark, workdir, SCHEMA, ["value"])
    assert panel.read().count() == 0 and panel.fold() == Commit()
    for i, b in enumerate(batches):
        write_batch(panel, sums, ["value"], b, i)
        if i in (1, 3):
            panel.fold(), sums.fold()
        write_batch(panel, sums, ["value"], b, i)  # replayed, before or after its fold
        assert _rows(live_rollup(spark, workdir, ["value"], SCHEMA)) == _expected(batches[:i + 1])
        assert _rows(panel.read().drop("month")) == sorted(r for x in batches[:i + 1] for r in _rows(x))
    assert panel.commit().through == 3 and panel.vacuum() > 0 and sums.vacuum() > 0
    assert _rows(live_rollup(spark, workdir, ["value"], SCHEMA)) == _expected(batches)
    assert panel.read().count() == 200


@pytest.mark.parametrize("step", ["before", "months", "commit"])
def test_a_crash_neither_loses_nor_doubles(spark, workdir, step, monkeypatch):
    batches = [_batch(spark, i) for i in range(3)]
    panel, sums = panel_store(spark, workdir, SCHEMA), rollup_store(spark, workdir, SCHEMA, ["value"])
    for i in (0, 1):
        write_batch(panel, sums, ["value"], batches[i], i)
        if i == 0:
            panel.fold(), sums.fold()

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "before":
            m.setattr(FoldedStore, "_write", crash)
        elif step == "months":
            m.setattr(FoldedStore, "_append_commit", crash)
        else:  # committed, but the caller never learns of it
            append = FoldedStore._append_commit
            m.setattr(FoldedStore, "_append_commit", lambda self, new: (append(self, new), crash()))
        for store in (panel, sums):
            with pytest.raises(RuntimeError, match="lost"):
                store.fold()
    assert _rows(live_rollup(spark, workdir, ["value"], SCHEMA)) == _expected(batches[:2]) and panel.read().count() == 80
    write_batch(panel, sums, ["value"], batches[2], 2)
    for store in (panel, sums):
        store.fold()
        store.vacuum()
        assert store.commit().through == 2
    assert _rows(live_rollup(spark, workdir, ["value"], SCHEMA)) == _expected(batches) and panel.read().count() == 120


def test_months_are_pruned_and_batches_gone(spark, workdir):
    import os

    panel = panel_store(spark, workdir, SCHEMA)
    for i in range(3):
        write_batch(panel, None, [], _batch(spark, i), i)
    panel.fold()
    panel.vacuum()
    assert os.listdir(f"{workdir}/panel/batches") == [] or not any(n.startswith("batch=") for n in os.listdir(f"{workdir}/panel/batches"))
    months = [n for n in os.listdir(f"{workdir}/panel/months") if n.startswith("month=")]
    assert len(months) == 3
    one = panel.read(F.col("month") == F.lit("2023-02-01").cast("date"))
    scan = one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "month#" in scan and "fold#" in scan
    want = sum(1 for i in range(3) for r in _batch(spark, i).collect() if r["metric_timestamp"].month == 2)
    assert one.count() == want


def test_partial_sums_of_nulls(spark):
    rows = spark.createDataFrame([(1, dt.datetime(2023, 1, 31, 23), None), (1, None, 1), (None, dt.datetime(2023, 1, 31), 2)],
                                 "customer_id long, metric_timestamp timestamp_ntz, v int").select(
        "customer_id", "metric_timestamp", F.col("v").cast("decimal(18,2)").alias("value"))
    got = {(r["customer_id"], r["day"]): (r["value_sum"], r["n_rows"]) for r in partial_sums(rows, ["value"]).collect()}
    assert got[1, dt.datetime(2023, 1, 31)] == (None, 1) and got[1, None][1] == 1 and got[None, dt.datetime(2023, 1, 31)][1] == 1
