"""Generators (invariants) and the metric functions on a generated store."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions.stamps import stamp_value
from tessera.plans import generate as G
from tessera.plans import metrics as M


def test_synthetic_sales_invariants(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(9)], "character_id string")
    s = G.synthetic_sales(spark, keys, "character_id", 15, dt.date(2023, 1, 1), seed=3).cache()
    per_day = {r["sale_date"]: r["n"] for r in s.groupBy("sale_date").agg(F.count("*").alias("n")).collect()}
    assert len(per_day) == 15 and all(128 <= n <= 256 for n in per_day.values())
    rows = s.select("id", "sale_date", "amount", stamp_value("verstamp").alias("v"), "character_id").orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(1, len(rows) + 1))
    steps = [b["v"] - a["v"] for a, b in zip(rows, rows[1:])]
    assert rows[0]["v"] >= 1 and all(x == 1 or 33 <= x <= 2049 for x in steps)
    assert all(1 <= r["amount"] <= 16 for r in rows)
    assert {r["character_id"] for r in rows} <= {f"k{i}" for i in range(9)}
    # a continuation starts after the resume point
    last_id, last_day, last_stamp = G.resume_point(s)
    nxt = G.synthetic_sales(spark, keys, "character_id", 1, last_day + dt.timedelta(days=1), last_id, last_stamp, seed=4)
    first = nxt.orderBy("id").first()
    assert first["id"] == last_id + 1 and int(first["verstamp"], 16) > last_stamp


def test_catalog_and_schema_sizes(spark):
    cat = G.metric_catalog_range(spark, 1700, 1600)
    rows = [(r["name"], r["table_name"]) for r in cat.orderBy("metric_id").collect()]
    owners = dict(rows)
    assert owners["metric_1"] == "customer_metric_1" and owners["metric_1590"] == "customer_metric_1"
    assert owners["metric_1591"] == "customer_metric_2" and owners["metric_1700"] == "customer_metric_2"
    s1 = G.panel_schema(rows, "customer_metric_1")
    assert len(s1.fields) == 1592
    wide = G.metric_catalog_range(spark, 2700, 1600)
    rows2 = [(r["name"], r["table_name"]) for r in wide.collect()]
    assert {t for _, t in rows2} == {"customer_metric_1", "customer_metric_2"}
    assert sum(len(G.panel_schema(rows2, t).fields) - 2 for t in {"customer_metric_1", "customer_metric_2"}) == 2700


@pytest.fixture(scope="module")
def store(spark):
    people = spark.createDataFrame(
        [(1, 1, "Ann", "Lee"), (2, 1, "Bob", "Lee"), (3, 2, "Ann", "Lee"), (4, 2, "Cy", "Ray"),
         (5, 3, "Dee", "Fox")], "customer_id long, city_id int, first_name string, last_name string")
    cities = spark.createDataFrame([(1, "North"), (2, "South"), (3, "East")], "city_id int, name string")
    cat = G.metric_catalog_range(spark, 6, 13)  # 3 metrics per panel -> two panels
    rows = [(r["name"], r["table_name"]) for r in cat.orderBy("metric_id").collect()]
    panels = G.synthetic_metric_panels(people.filter("customer_id < 5"), rows, dt.datetime(2024, 1, 29, 0),
                                       dt.datetime(2024, 2, 6, 23), filled_per_panel=2, seed=9)
    panels = {t: p.cache() for t, p in panels.items()}
    return M.MetricStore(cat, panels, people, cities)


def _sum_docs(df, key):
    import json
    from decimal import Decimal

    return sum(json.loads(r["result"], parse_float=Decimal)[key] or 0 for r in df.collect())


def test_bucket_sums_agree(store):
    names = "metric_1,metric_4,metric_3"
    dy = M.city_metrics(store, names, agg="DY")
    wk = M.city_metrics(store, names, agg="WK")
    mo = M.city_metrics(store, names, agg="MO")
    al = M.city_metrics(store, names, agg="ALL")
    totals = {_sum_docs(x, "metric_1_sum") for x in (dy, wk, mo, al)}
    assert len(totals) == 1
    assert al.count() == 2 and {str(r["result_time"]) for r in al.collect()} == {"9999-12-31 00:00:00"}
    assert mo.select("result_time").distinct().count() == 2  # a week crossing the month end
    # metric_3 is never filled -> its sums are NULL, as in SQL
    import json
    assert all(json.loads(r["result"])["metric_3_sum"] is None for r in dy.collect())


def test_person_raw_and_range(store):
    raw = M.customer_metrics(store, 1, "metric_1,metric_4")
    assert raw.count() == 9 * 24
    rng = M.customer_metrics(store, 1, "metric_1,metric_4", dt.datetime(2024, 1, 30, 0), dt.datetime(2024, 1, 30, 5))
    assert rng.count() == 6
    one = M.customer_metrics(store, 1, "metric_1", None, dt.datetime(2024, 1, 29, 5), "DY")
    assert one.count() == 1
    import json
    doc = json.loads(raw.first()["result"])
    assert list(doc) == ["metric_1", "metric_4"]


def test_errors_and_unknown_names(store):
    with pytest.raises(ValueError):
        M.customer_metrics(store, 1, "metric_1", agg="ALL")  # not a person code
    with pytest.raises(ValueError):
        M.city_metrics(store, "nope,also_nope")
    with pytest.raises(ValueError):
        M.city_metrics(store, "metric_1", formulas={"f": "metric_1 + bogus"})
    out = M.customer_metrics(store, 1, "metric_1,,metric_99", agg="MO")  # blanks/unknown dropped
    import json
    assert list(json.loads(out.first()["result"])) == ["metric_1_sum"]


def test_formula_and_find(store):
    out = M.city_metrics(store, "metric_1", agg="ALL", formulas={"f": "metric_1 + 2 * metric_4"})
    import json
    d = json.loads(out.orderBy("city").first()["result"])
    assert set(d) == {"metric_1_sum", "f_sum"}
    found = M.find_customer(store, "Lee").collect()
    assert sorted((r["city"], r["first_name"]) for r in found) == [("North", "Ann"), ("North", "Bob"), ("South", "Ann")]
    assert len(M.find_customer(store, "Lee", "Ann").collect()) == 2
    assert M.find_customer(store, "Fox").count() == 0  # no metrics -> absent (inner join)


def test_panel_join_equals_wide_table(store):
    names = "metric_1,metric_2,metric_4,metric_5"
    joined = M.metric_rows(store, names)
    wide = store.panels["customer_metric_1"].join(store.panels["customer_metric_2"], list(M.KEYS))
    cols = list(M.KEYS) + names.split(",")
    assert sorted(map(tuple, joined.select(*cols).collect())) == sorted(map(tuple, wide.select(*cols).collect()))


def test_results_do_not_depend_on_session_zone(spark, store):
    def run():
        a = M.city_metrics(store, "metric_1,metric_4", dt.datetime(2024, 1, 30, 1), dt.datetime(2024, 2, 3, 22), "WK")
        b = M.customer_metrics(store, 2, "metric_1", None, dt.datetime(2024, 2, 1, 5), "DY")
        return sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))

    base = run()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert run() == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_city_rollup_without_broadcast_matches(store):
    """Forcing the shuffle path (people too large to broadcast) gives the same sums."""
    import json
    from decimal import Decimal

    def docs(df):
        return sorted((r["city"], str(r["result_time"]), json.dumps(json.loads(r["result"], parse_float=Decimal),
                                                                     default=str)) for r in df.collect())

    for agg in ("DY", "WK", "ALL"):
        a = M.city_metrics(store, "metric_1,metric_3,metric_4", agg=agg, formulas={"f": "metric_1 + metric_4"})
        b = M.city_metrics(store, "metric_1,metric_3,metric_4", agg=agg, formulas={"f": "metric_1 + metric_4"},
                           people_broadcast_limit=0)
        assert docs(a) == docs(b)
        plan = b._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" not in plan


def test_full_width_request(spark, workdir):
    """All 1,700 metrics of the original catalog in one call (two panels, 1,590 + 110 columns)."""
    import json

    people = spark.createDataFrame([(1, 1, "a", "b"), (2, 2, "c", "d")],
                                   "customer_id long, city_id int, first_name string, last_name string")
    cities = spark.createDataFrame([(1, "North"), (2, "South")], "city_id int, name string")
    cat = G.metric_catalog_range(spark)
    rows = [(r["name"], r["table_name"]) for r in cat.orderBy("metric_id").collect()]
    panels = G.synthetic_metric_panels(people.select("customer_id"), rows, dt.datetime(2024, 1, 1, 0),
                                       dt.datetime(2024, 1, 1, 2), filled_per_panel=5, seed=1)
    paths = G.write_panels(panels, f"{workdir}/panels")  # generated once, queried from Parquet
    store = M.MetricStore(cat, {t: spark.read.parquet(p) for t, p in paths.items()}, people, cities, rows)
    names = ",".join(n for n, _ in rows)
    out = M.city_metrics(store, names, agg="DY").collect()
    assert len(out) == 2
    doc = json.loads(out[0]["result"])
    assert len(doc) == 1700 and doc["metric_1_sum"] is not None and doc["metric_6_sum"] is None
    assert doc["metric_1591_sum"] is not None  # first metric of the second panel is filled


def test_formula_with_functions(store):
    import json

    out = M.city_metrics(store, "metric_1", agg="ALL",
                         formulas={"g": "coalesce(metric_3, 0) + CASE WHEN metric_1 IS NULL THEN 0 ELSE metric_1 END"})
    d = json.loads(out.orderBy("city").first()["result"])
    assert d["g_sum"] == d["metric_1_sum"]  # metric_3 is never filled
    with pytest.raises(ValueError):
        M.city_metrics(store, "metric_1", formulas={"g": "coalesce(metric_77, 0)"})


def test_synthetic_people_counts_and_dense_ids(spark):
    people = G.synthetic_people(spark, factor=10, seed=5).cache()
    per_city = {r["city_id"]: r["n"] for r in people.groupBy("city_id").agg(F.count("*").alias("n")).collect()}
    assert per_city == {1: 800, 2: 100, 3: 60, 4: 30, 5: 10}
    ids = sorted(r["customer_id"] for r in people.select("customer_id").collect())
    assert ids == list(range(1, 1001))
    names = people.select("first_name", "last_name").collect()
    assert all(len(r["first_name"]) == 32 and len(r["last_name"]) == 32 for r in names)
