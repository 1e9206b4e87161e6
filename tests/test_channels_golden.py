"""End-to-end golden test of the latest-communication report on the original input rows."""

import csv
import os

from pyspark.sql import functions as F

from tessera.functions.timeparts import parse_dmy_date, parse_dmy_timestamp
from tessera.plans import channels as C
from tessera.sources.files import read_semicolon_csv

FIX = os.path.join(os.path.dirname(__file__), "fixtures", "channel")


def _csv(spark, name):
    return (spark.read.option("header", True).option("multiLine", True).option("nullValue", "\\N")
            .option("escape", '"').csv(os.path.join(FIX, name)))


def _inputs(spark):
    activity = _csv(spark, "activity.csv").withColumn("created", parse_dmy_timestamp("created"))
    contact = _csv(spark, "contact.csv").withColumn("x_promo_date", parse_dmy_date("x_promo_date"))
    addr = _csv(spark, "per_addr.csv").withColumn("created", parse_dmy_timestamp("created"))
    return activity, contact, addr


def _golden():
    with open(os.path.join(FIX, "golden_report.csv"), encoding="utf-8") as f:
        rows = list(csv.DictReader(f))
    return rows


def _fmt(v):
    if v is None:
        return None
    if hasattr(v, "strftime"):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(v)


def test_report_matches_golden(spark):
    activity, contact, addr = _inputs(spark)
    assert activity.count() == 1388
    out = C.latest_channel_report(activity, contact, addr, C.original_branches())
    got = [[_fmt(r[c]) for c in C.REPORT_COLUMNS] for r in out.collect()]
    want = [[g[c] for c in C.REPORT_COLUMNS] for g in _golden()]
    assert len(got) == 11
    assert sorted(got) == sorted(want)
    # ORDER BY con_id, todo_cd
    assert [(r[6], r[8]) for r in got] == sorted((r[6], r[8]) for r in got)


def test_single_branch_equals_union_part(spark):
    activity, contact, addr = _inputs(spark)
    full = C.latest_channel_report(activity, contact, addr, C.original_branches())
    parts = None
    for b in C.original_branches():
        p = C.latest_by_type(activity, contact, addr, b)
        parts = p if parts is None else parts.unionByName(p)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, parts.distinct().collect()))


def test_tie_returns_foreign_type(spark):
    """Only the maximum is typed: another activity at the winning time is returned too."""
    rows = [("c1", "2024-01-01 10:00:00", "E", "ok", "x"),
            ("c1", "2024-01-01 10:00:00", "OTHER", "ok", "y"),
            ("c1", "2023-01-01 10:00:00", "E", "ok", "z"),
            ("c2", "2024-02-01 10:00:00", "E", None, None)]
    a = spark.createDataFrame(rows, "con_id string, created string, todo_cd string, stat string, comments_long string")
    a = a.withColumn("created", F.col("created").cast("timestamp_ntz"))
    contact = spark.createDataFrame([("c1", "A", "B", "C", "s")], "row_id string, fst_name string, mid_name string, "
                                    "last_name string, x_gb_status string")
    addr = spark.createDataFrame([("c1", "m@x", "Email"), ("c1", "m2@x", "Email")],
                                 "per_id string, addr string, comm_medium_cd string")
    b = C.Branch("e", F.col("todo_cd") == "E", F.col("comm_medium_cd") == "Email")
    out = C.latest_channel_report(a, contact, addr, [b]).collect()
    kinds = sorted((r["con_id"], r["todo_cd"], r["addr"]) for r in out)
    # c1: both activities at the max time x both e-mails; c2: no contact, no address -> one row, NULLs kept
    assert kinds == [("c1", "E", "m2@x"), ("c1", "E", "m@x"), ("c1", "OTHER", "m2@x"), ("c1", "OTHER", "m@x"),
                     ("c2", "E", None)]
    c2 = [r for r in out if r["con_id"] == "c2"][0]
    assert c2["fst_name"] is None and c2["stat"] is None


def test_null_rejecting_inequality(spark):
    a = spark.createDataFrame([("c1", "2024-01-01 10:00:00", "CALL", None, "text"),
                               ("c1", "2023-01-01 10:00:00", "CALL", "done", "text")],
                              "con_id string, created string, todo_cd string, stat string, comments_long string")
    a = a.withColumn("created", F.col("created").cast("timestamp_ntz"))
    out = C.latest_activity_rows(a, (F.col("stat") != "bad") & (F.col("todo_cd") == "CALL")).collect()
    assert [str(r["created"]) for r in out] == ["2023-01-01 10:00:00"]


def test_semicolon_exports(spark):
    """Spreadsheet exports: BOM, unnamed index column, DMY dates, minute-only times."""
    c = read_semicolon_csv(spark, os.path.join(FIX, "contact_export.csv"))
    assert c.columns == ["row_id", "fst_name", "mid_name", "last_name", "x_gb_status", "x_promo_date"]
    c = c.withColumn("x_promo_date", parse_dmy_date("x_promo_date"))
    dates = {r["row_id"]: r["x_promo_date"] for r in c.collect()}
    assert dates["1-8K3R-1697"] is None and str(dates["1-CS-1281"]) == "2018-04-19"
    p = read_semicolon_csv(spark, os.path.join(FIX, "per_addr_export.csv"))
    p = p.withColumn("created", parse_dmy_timestamp("created"))
    assert p.count() == 13 and p.filter(F.col("created").isNull()).count() == 0


def test_wide_form_matches_golden_winners(spark):
    activity, contact, addr = _inputs(spark)
    wide = {r["con_id"]: r for r in C.latest_channel_wide(activity, contact, C.original_branches()).collect()}
    for g in _golden():
        kind = {C.EMAIL_TYPE: "email", C.SMS_TYPE: "sms", C.CAMPAIGN_CALL_TYPE: "call"}[g["todo_cd"]]
        row = wide[g["con_id"]]
        assert _fmt(row[f"{kind}_created"]) == g["created"]
        assert row[f"{kind}_desc"] == g["comments_long"]
