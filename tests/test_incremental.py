"""Incremental sales job: batch runs, state handling and the streaming wrapper."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tessera.functions.stamps import ZERO_STAMP
from tessera.plans.sales import fresh_rows, house_sales, run_batch, unmatched_keys
from tessera.sources.files import SALES_SCHEMA, newest_output, read_master_json, read_sales, read_watermark
from tessera.sinks.files import append_csv, append_delivery, write_watermark
from tessera.streaming.house_sales_stream import read_outputs, start_house_sales_stream

MASTER = [{"id": "a", "name": "A", "house": "Gryffindor"}, {"id": "b", "name": "B", "house": "Slytherin"},
          {"id": "c", "name": "C", "house": None}]


def _sales(spark, start_id, day, n, stamp0, keys=("a", "b", "c", "zz")):
    rows = []
    for i in range(n):
        rows.append((start_id + i, keys[i % len(keys)], day, 1 + i % 16, "0x%08x" % (stamp0 + i)))
    return spark.createDataFrame(rows, SALES_SCHEMA)


def _master(spark, path, data=MASTER):
    with open(path, "w") as f:
        json.dump(data, f)
    return read_master_json(spark, path)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_two_batches_equal_one_full_run(spark, workdir):
    m = _master(spark, f"{workdir}/m.json")
    d1 = _sales(spark, 1, dt.date(2023, 1, 1), 40, 1)
    d2 = _sales(spark, 41, dt.date(2023, 1, 2), 30, 100)
    append_csv(d1, f"{workdir}/sales")
    r1 = run_batch(spark, read_sales(spark, f"{workdir}/sales"), m, f"{workdir}/state", f"{workdir}/out")
    append_csv(d2, f"{workdir}/sales")
    r2 = run_batch(spark, read_sales(spark, f"{workdir}/sales"), m, f"{workdir}/state", f"{workdir}/out")
    assert r1.old_watermark == ZERO_STAMP and r1.new_watermark == "0x%08x" % 40
    assert r2.old_watermark == r1.new_watermark and r2.new_watermark == "0x%08x" % 129
    assert read_watermark(spark, f"{workdir}/state") == r2.new_watermark
    both = read_outputs(spark, f"{workdir}/out").select("sale_date", "house", "amount", "last_verstamp")
    full = house_sales(d1.unionByName(d2), m)
    assert _rows(both.select(F.col("sale_date").cast("date"), "house", F.col("amount").cast("bigint"),
                             "last_verstamp")) == _rows(full)
    # key "c" has a NULL house and "zz" is unknown: both dropped, but reported
    lost = {r["character_id"] for r in unmatched_keys(d1, m).collect()}
    assert lost == {"c", "zz"}


def test_no_fresh_rows_keeps_state(spark, workdir):
    m = _master(spark, f"{workdir}/m.json")
    write_watermark(spark, f"{workdir}/state", "0x000000ff")
    d = _sales(spark, 1, dt.date(2023, 1, 1), 10, 0xf0)  # stamps 0xf0..0xf9, all older
    res = run_batch(spark, d, m, f"{workdir}/state", f"{workdir}/out")
    assert res.new_watermark is None and res.output_path is None
    assert read_watermark(spark, f"{workdir}/state") == "0x000000ff"
    assert not os.path.exists(f"{workdir}/out")


def test_stamp_equal_to_watermark_is_excluded(spark, workdir):
    m = _master(spark, f"{workdir}/m.json")
    write_watermark(spark, f"{workdir}/state", "0x00000005")
    d = _sales(spark, 1, dt.date(2023, 1, 1), 8, 5, keys=("a",))  # stamps 5..12
    res = run_batch(spark, d, m, f"{workdir}/state", f"{workdir}/out")
    out = read_outputs(spark, f"{workdir}/out").collect()
    assert res.new_watermark == "0x0000000c"
    assert int(out[0]["amount"]) == sum(1 + i % 16 for i in range(1, 8))


def test_rerun_after_crash_is_idempotent(spark, workdir):
    m = _master(spark, f"{workdir}/m.json")
    d = _sales(spark, 1, dt.date(2023, 1, 1), 20, 1)
    r1 = run_batch(spark, d, m, f"{workdir}/state", f"{workdir}/out")
    first = _rows(read_outputs(spark, f"{workdir}/out"))
    write_watermark(spark, f"{workdir}/state", ZERO_STAMP)  # state write "lost"
    r2 = run_batch(spark, d, m, f"{workdir}/state", f"{workdir}/out")
    assert r1.output_path == r2.output_path
    assert _rows(read_outputs(spark, f"{workdir}/out")) == first


def test_master_change_affects_only_new_batches(spark, workdir):
    m1 = _master(spark, f"{workdir}/m1.json")
    changed = [dict(x, house="Ravenclaw") if x["id"] == "a" else x for x in MASTER]
    m2 = _master(spark, f"{workdir}/m2.json", changed)
    run_batch(spark, _sales(spark, 1, dt.date(2023, 1, 1), 8, 1, keys=("a",)), m1,
              f"{workdir}/state", f"{workdir}/out")
    old = _rows(read_outputs(spark, f"{workdir}/out"))
    run_batch(spark, _sales(spark, 9, dt.date(2023, 1, 2), 8, 9, keys=("a",)), m2,
              f"{workdir}/state", f"{workdir}/out")
    houses = {(str(r["sale_date"]), r["house"]) for r in read_outputs(spark, f"{workdir}/out").collect()}
    assert houses == {("2023-01-01", "Gryffindor"), ("2023-01-02", "Ravenclaw")}
    assert set(old) <= set(_rows(read_outputs(spark, f"{workdir}/out")))


def test_stream_processes_each_delivery_once(spark, workdir):
    mpath = f"{workdir}/m.json"
    _master(spark, mpath)
    land = f"{workdir}/landing"
    args = dict(source_path=land, source_schema=SALES_SCHEMA, to_sales=lambda df: df,
                load_master=lambda: read_master_json(spark, mpath), state_path=f"{workdir}/state",
                output_base=f"{workdir}/out", checkpoint=f"{workdir}/ckpt", source_format="csv")
    d1 = _sales(spark, 1, dt.date(2023, 1, 1), 40, 1)
    d2 = _sales(spark, 41, dt.date(2023, 1, 2), 30, 100)
    append_csv(d1, land)
    start_house_sales_stream(spark, **args).awaitTermination()
    append_csv(d2, land)
    start_house_sales_stream(spark, **args).awaitTermination()
    m = read_master_json(spark, mpath)
    got = read_outputs(spark, f"{workdir}/out").select(
        F.col("sale_date").cast("date"), "house", F.col("amount").cast("bigint"), "last_verstamp")
    assert _rows(got) == _rows(house_sales(d1.unionByName(d2), m))
    assert read_watermark(spark, f"{workdir}/state") == "0x%08x" % 129
    # forced restart: new checkpoint + reset state reprocesses everything into the same stamped dirs
    args["checkpoint"] = f"{workdir}/ckpt2"
    start_house_sales_stream(spark, restart=True, **args).awaitTermination()
    assert read_watermark(spark, f"{workdir}/state") == "0x%08x" % 129


def test_older_deliveries_are_not_read(spark, workdir):
    """Deliveries in stamp ranges: the second run's scan has partition filters, and never opens older ranges."""
    m = _master(spark, f"{workdir}/m.json")
    land = f"{workdir}/sales"
    loose = _sales(spark, 1, dt.date(2023, 1, 1), 40, 1).unionByName(_sales(spark, 41, dt.date(2023, 1, 2), 30, 100))
    append_delivery(_sales(spark, 1, dt.date(2023, 1, 1), 40, 1), land, bits=4)
    run_batch(spark, read_sales(spark, land), m, f"{workdir}/state", f"{workdir}/out")
    append_delivery(_sales(spark, 41, dt.date(2023, 1, 2), 30, 100), land, bits=5)  # another width beside the first
    with open(f"{land}/stamp_bits=4/stamp_range=0/broken.csv", "w") as f:
        f.write("id,character_id,sale_date,amount,verstamp\nnot,a,row,at,all\n")  # reading it would fail
    fresh = fresh_rows(read_sales(spark, land), "0x%08x" % 40)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stamp_range" in plan or "stamp_range#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    r = run_batch(spark, read_sales(spark, land), m, f"{workdir}/state", f"{workdir}/out")
    assert r.new_watermark == "0x%08x" % 129
    got = read_outputs(spark, f"{workdir}/out").select(
        F.col("sale_date").cast("date"), "house", F.col("amount").cast("bigint"), "last_verstamp")
    assert _rows(got) == _rows(house_sales(loose, m))
    # an interrupted run's upper bound prunes too
    assert fresh_rows(read_sales(spark, land), "0x%08x" % 63, "0x%08x" % 110).count() == 11


def test_newest_output_compares_numbers(spark, workdir):
    for stamp in ("0xffffffff", "0x100000000", "0x0000000a"):
        spark.range(1).write.option("header", True).csv(f"{workdir}/out/verstamp={stamp}")
    assert newest_output(spark, f"{workdir}/out") == "0x100000000"


def _total(spark, workdir):
    r = read_outputs(spark, f"{workdir}/out").agg(F.sum(F.col("amount").cast("long"))).first()
    return r[0]


def test_crash_between_output_and_commit_with_grown_input(spark, workdir):
    """The state of a run that wrote but did not commit names its range; new rows wait for the next run."""
    m = _master(spark, f"{workdir}/m.json")
    ones = lambda lo, hi: spark.createDataFrame(
        [(i, "a", dt.date(2023, 1, 1), 1, "0x%08x" % i) for i in range(lo, hi)], SALES_SCHEMA)
    run_batch(spark, ones(1, 11), m, f"{workdir}/state", f"{workdir}/out")
    write_watermark(spark, f"{workdir}/state", ZERO_STAMP, intended="0x%08x" % 10)  # as before the commit
    grown = ones(1, 16)
    assert run_batch(spark, grown, m, f"{workdir}/state", f"{workdir}/out").new_watermark == "0x%08x" % 10
    assert run_batch(spark, grown, m, f"{workdir}/state", f"{workdir}/out").new_watermark == "0x%08x" % 15
    assert _total(spark, workdir) == 15


def test_missing_state_beside_outputs(spark, workdir):
    m = _master(spark, f"{workdir}/m.json")
    d = _sales(spark, 1, dt.date(2023, 1, 1), 20, 1, keys=("a",))
    run_batch(spark, d, m, f"{workdir}/state", f"{workdir}/out")
    before = _total(spark, workdir)
    assert run_batch(spark, d, m, f"{workdir}/other-state", f"{workdir}/out").new_watermark is None
    assert _total(spark, workdir) == before


def test_stream_keeps_interleaved_stamps(spark, workdir):
    """Files whose stamps interleave: the same totals however many files a micro-batch takes."""
    mpath = f"{workdir}/m.json"
    _master(spark, mpath)
    full = spark.createDataFrame([(i, "a", dt.date(2023, 1, 1), 1, "0x%08x" % i) for i in range(1, 61)], SALES_SCHEMA)
    for k in range(3):
        append_csv(full.where(F.col("id") % 3 == k).coalesce(1), f"{workdir}/landing")
    for limit in (None, 1, 2):
        out = f"{workdir}/out{limit}"
        for _ in range(2):  # a second start of the same checkpoint finds nothing
            start_house_sales_stream(
                spark, f"{workdir}/landing", SALES_SCHEMA, lambda df: df, lambda: read_master_json(spark, mpath), f"{workdir}/state{limit}",
                out, f"{workdir}/ck{limit}", source_format="csv", max_files_per_trigger=limit).awaitTermination()
        assert read_outputs(spark, out).agg(F.sum(F.col("amount").cast("long"))).first()[0] == 60
        assert read_watermark(spark, f"{workdir}/state{limit}") == "0x%08x" % 60


def test_streams_read_tables_that_are_directories(spark, workdir):
    import __spark_entry__ as E
    from conftest import SF001

    for name in ("lineitem", "part", "events"):
        spark.read.parquet(f"{SF001}/{name}.parquet").repartition(3).write.parquet(f"{workdir}/t/{name}.parquet")
    for name in ("stream_house_sales", "stream_metric_ingest"):
        assert _rows(E.queries()[name](spark, f"{workdir}/t")) == _rows(E.queries()[name](spark, SF001))
    assert _rows(E.queries()["stream_house_sales"](spark, SF001)) == _rows(E.queries()["house_sales"](spark, SF001))
