"""How the jobs map onto the driver's TPC-H-style tables.

Each function returns a lazy DataFrame with the column names a job expects;
Catalyst prunes the unused columns and pushes filters into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.stamps import hex_stamp
from tessera.sources.tables import Tables


def sales_from_lineitem(t: Tables) -> DataFrame:
    """Sales facts: one line item = one sale of part ``l_partkey``, stamped by its order key."""
    return sales_columns(t.lineitem)


def sales_columns(lineitem: DataFrame) -> DataFrame:
    """The sales view of any frame with lineitem columns (batch or stream)."""
    return lineitem.select(
        F.col("l_partkey").alias("character_id"),
        F.col("l_shipdate").cast("date").alias("sale_date"),
        F.col("l_quantity").cast("int").alias("amount"),
        hex_stamp("l_orderkey").alias("verstamp"),
        F.col("l_orderkey").alias("stamp"),
    )


def master_from_part(t: Tables) -> DataFrame:
    """Master data: the part's brand plays the character's house."""
    return t.part.select(F.col("p_partkey").alias("character_id"), F.col("p_brand").alias("house"))


# ------------------------------------------------------------------ metric store

# Metrics per panel table on the driver tables (a stand-in for the column limit
# that splits the real store into panels). Small, so queries span two panels.
PANEL_WIDTH = 3
METRIC_TYPE = "decimal(18,2)"


def metric_catalog(t: Tables, panel_width: int = PANEL_WIDTH) -> DataFrame:
    """Catalog derived from the data: one metric per event type, numbered in name order.

    ``table_name`` is ``panel_<floor((id - 1) / width) + 1>``.
    """
    from pyspark.sql import Window

    types = t.events.select("event_type").filter(F.col("event_type").isNotNull()).distinct()
    # numbering runs over the distinct types only (a handful of rows after the
    # partial + final aggregation), so the unpartitioned window is harmless
    numbered = types.select(F.row_number().over(Window.orderBy("event_type")).alias("metric_id"), "event_type")
    return numbered.select(
        F.col("metric_id").cast("int").alias("metric_id"),
        F.concat(F.lit("metric_"), F.col("metric_id").cast("string")).alias("name"),
        F.col("event_type").alias("explain"),
        F.lit("numeric").alias("data_type"),
        F.concat(F.lit("panel_"), (F.floor((F.col("metric_id") - 1) / panel_width) + 1).cast("string")).alias("table_name"),
    )


def metric_store(t: Tables, catalog: DataFrame | None = None):
    """The metric store over ``events`` (panels), ``customer`` (people) and ``nation`` (cities). With a stored
    ``catalog`` (``plans.catalog``) no fact is read to build it; without one it is derived from the events.

    Panel rows are the events keyed by ``(user_id, ts)``; metric ``k`` holds the
    event's value when the event has the type of catalog entry ``k`` (sparse, as in
    a wide table where most metrics are NULL for a given hour).
    """
    from tessera.plans.metrics import MetricStore

    cat = metric_catalog(t) if catalog is None else catalog
    # one row per metric: the columns of the panels, as many as a table's columns can be
    rows = [tuple(r) for r in cat.orderBy("metric_id").select("name", "table_name", "explain").collect()]
    ev = t.events
    panels = {}
    for table in sorted({r[1] for r in rows}):
        cols = [F.when(F.col("event_type") == F.lit(expl), F.col("value").cast(METRIC_TYPE)).alias(name)
                for name, tbl, expl in rows if tbl == table]
        panels[table] = ev.select(F.col("user_id").alias("customer_id"), F.col("ts").alias("metric_timestamp"), *cols)
    people = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("city_id"),
        F.col("c_mktsegment").alias("first_name"), F.col("c_name").alias("last_name"))
    cities = t.nation.select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("name"))
    return MetricStore(cat, panels, people, cities, [(n, tb) for n, tb, _ in rows])


# ------------------------------------------------------------- channel report

# Fixed values of the driver binding: which order priority / status stands for
# which communication type and outcome.
EMAIL_TYPE = "1-URGENT"
SMS_TYPE = "2-HIGH"
SMS_DELIVERED = "F"
CALL_TYPE = "3-MEDIUM"
CALL_BAD_NUMBER = "P"
LANDLINE_PREFIX = "734"
NO_COMMENT_BELOW = 50000.0


def activity_from_orders(t: Tables) -> DataFrame:
    """Activities: an order is one communication of its customer at the order date."""
    o = t.orders
    return o.select(
        F.col("o_orderkey").alias("activity_id"),
        F.col("o_orderdate").alias("created"),
        F.col("o_custkey").alias("con_id"),
        F.col("o_orderpriority").alias("todo_cd"),
        F.col("o_orderstatus").alias("stat"),
        F.when(F.col("o_totalprice") < NO_COMMENT_BELOW, F.lit(""))
        .otherwise(F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))).alias("comments_long"),
    )


def contact_from_customer(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("row_id"),
        F.col("c_name").alias("fst_name"),
        F.col("c_mktsegment").alias("mid_name"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("last_name"),
        F.when(F.col("c_acctbal") > 0, F.lit("active")).otherwise(F.lit("potential")).alias("x_gb_status"),
    )


def addresses_from_customer(t: Tables) -> DataFrame:
    """Per client: an e-mail (only with a non-negative balance), two mobiles and a landline."""
    c = t.customer
    k = F.col("c_custkey").cast("string")
    entries = F.array(
        F.struct(F.when(F.col("c_acctbal") >= 0, F.concat(F.lower(F.regexp_replace("c_name", "#", ".")),
                                                            F.lit("@example.com"))).alias("addr"),
                 F.lit("Email").alias("comm_medium_cd")),
        F.struct(F.concat(F.lit("7900"), k).alias("addr"), F.lit("Phone").alias("comm_medium_cd")),
        F.struct(F.concat(F.lit("7955"), k).alias("addr"), F.lit("Phone").alias("comm_medium_cd")),
        F.struct(F.concat(F.lit(LANDLINE_PREFIX), k).alias("addr"), F.lit("Phone").alias("comm_medium_cd")),
    )
    return (c.select(F.col("c_custkey").alias("per_id"), F.explode(entries).alias("e"))
            .select("per_id", "e.addr", "e.comm_medium_cd").filter(F.col("addr").isNotNull()))


def channel_branches():
    from tessera.plans.channels import report_branches

    return report_branches(EMAIL_TYPE, SMS_TYPE, SMS_DELIVERED, CALL_TYPE, CALL_BAD_NUMBER, LANDLINE_PREFIX)


def order_metric_store(t: Tables):
    """A one-panel store over ``orders``: metric_1 = order total per (customer, order date).

    Orders span several years, so month buckets are exercised; (customer, date) is
    not unique here, which is harmless with a single panel (no panel join).
    """
    from tessera.plans.metrics import MetricStore

    rows = [("metric_1", "panel_1")]
    cat = t.spark.createDataFrame([(1, "metric_1", "order total", "numeric", "panel_1")],
                                  "metric_id int, name string, explain string, data_type string, table_name string")
    panel = t.orders.select(F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("metric_timestamp"),
                            F.col("o_totalprice").cast(METRIC_TYPE).alias("metric_1"))
    people = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("city_id"),
        F.col("c_mktsegment").alias("first_name"), F.col("c_name").alias("last_name"))
    cities = t.nation.select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("name"))
    return MetricStore(cat, {"panel_1": panel}, people, cities, rows)
