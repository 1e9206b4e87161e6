"""Latest-communication report over the driver tables and its DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import bindings as B
from tessera.plans import channels as C
from tessera.plans.registry import register
from tessera.sources.tables import Tables

_BASE = f"""
WITH activity AS (
  SELECT o_orderkey AS activity_id, o_orderdate AS created, o_custkey AS con_id,
         o_orderpriority AS todo_cd, o_orderstatus AS stat,
         CASE WHEN o_totalprice < {B.NO_COMMENT_BELOW} THEN '' ELSE 'order ' || CAST(o_orderkey AS VARCHAR) END
           AS comments_long
  FROM orders),
contact AS (
  SELECT c_custkey AS row_id, c_name AS fst_name, c_mktsegment AS mid_name,
         'N' || CAST(c_nationkey AS VARCHAR) AS last_name,
         CASE WHEN c_acctbal > 0 THEN 'active' ELSE 'potential' END AS x_gb_status
  FROM customer),
per_addr AS (
  SELECT c_custkey AS per_id, lower(replace(c_name, '#', '.')) || '@example.com' AS addr,
         'Email' AS comm_medium_cd FROM customer WHERE c_acctbal >= 0
  UNION ALL SELECT c_custkey, '7900' || CAST(c_custkey AS VARCHAR), 'Phone' FROM customer
  UNION ALL SELECT c_custkey, '7955' || CAST(c_custkey AS VARCHAR), 'Phone' FROM customer
  UNION ALL SELECT c_custkey, '{B.LANDLINE_PREFIX}' || CAST(c_custkey AS VARCHAR), 'Phone' FROM customer)
"""

# What counts for a channel's latest time, and which addresses belong to it.
_QUALIFIES = {
    "email": f"todo_cd = '{B.EMAIL_TYPE}'",
    "sms": f"todo_cd = '{B.SMS_TYPE}' AND stat = '{B.SMS_DELIVERED}'",
    "call": f"comments_long <> '' AND todo_cd = '{B.CALL_TYPE}' AND stat <> '{B.CALL_BAD_NUMBER}'",
    "any_call": f"comments_long <> '' AND todo_cd = '{B.CALL_TYPE}'",
}
_ADDRESS = {"email": "comm_medium_cd = 'Email'",
            **dict.fromkeys(("sms", "call"), f"comm_medium_cd = 'Phone' AND NOT starts_with(addr, '{B.LANDLINE_PREFIX}')")}


def _latest(channel: str) -> str:
    """Activities at each client's latest qualifying time."""
    return f"""(SELECT activity.* FROM activity JOIN (
      SELECT con_id, MAX(created) AS created FROM activity WHERE {_QUALIFIES[channel]} GROUP BY con_id) newest
    USING (con_id, created))"""


def _report(channel: str, distinct: str = "DISTINCT") -> str:
    return f"""SELECT {distinct} fst_name, mid_name, last_name, x_gb_status, addr, created, con_id, stat, todo_cd, comments_long
    FROM {_latest(channel)} found
    LEFT JOIN contact ON row_id = con_id
    LEFT JOIN (SELECT per_id, addr FROM per_addr WHERE {_ADDRESS[channel]}) reached ON per_id = con_id"""


def _parts(spark: SparkSession, d: str):
    t = Tables(spark, d)
    return B.activity_from_orders(t), B.contact_from_customer(t), B.addresses_from_customer(t)


@register("latest_channel_report", _BASE + f"""
SELECT DISTINCT * FROM ({_report('email')} UNION ALL {_report('sms')} UNION ALL {_report('call')}) ORDER BY con_id, todo_cd
""")
def q_report(spark: SparkSession, d: str) -> DataFrame:
    a, c, p = _parts(spark, d)
    return C.latest_channel_report(a, c, p, B.channel_branches())


@register("latest_email", _BASE + _report("email", ""))
def q_email(spark: SparkSession, d: str) -> DataFrame:
    a, c, p = _parts(spark, d)
    return C.latest_by_type(a, c, p, B.channel_branches()[0], dedupe=False)


@register("latest_sms", _BASE + _report("sms"))
def q_sms(spark: SparkSession, d: str) -> DataFrame:
    a, c, p = _parts(spark, d)
    return C.latest_by_type(a, c, p, B.channel_branches()[1])


@register("latest_call", _BASE + _report("call"))
def q_call(spark: SparkSession, d: str) -> DataFrame:
    a, c, p = _parts(spark, d)
    return C.latest_by_type(a, c, p, B.channel_branches()[2])


@register("latest_call_rows", _BASE + f"SELECT * FROM {_latest('call')}")
def q_call_rows(spark: SparkSession, d: str) -> DataFrame:
    a, _, _ = _parts(spark, d)
    return C.latest_activity_rows(a, B.channel_branches()[2].qualifies)


@register("latest_call_rows_any_status", _BASE + f"SELECT * FROM {_latest('any_call')}")
def q_call_rows_any(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import functions as F

    a, _, _ = _parts(spark, d)
    return C.latest_activity_rows(a, (F.col("comments_long") != "") & (F.col("todo_cd") == B.CALL_TYPE))


@register("latest_channel_wide", _BASE + f"""
SELECT m.con_id, c.fst_name, c.mid_name, c.last_name, c.x_gb_status,
       m.e.created AS email_created, m.e.comments_long AS email_desc,
       m.s.created AS sms_created, m.s.comments_long AS sms_desc,
       m.k.created AS call_created, m.k.comments_long AS call_desc
FROM (SELECT con_id,
        MAX(CASE WHEN todo_cd = '{B.EMAIL_TYPE}'
                 THEN struct_pack(created := created, comments_long := comments_long) END) AS e,
        MAX(CASE WHEN todo_cd = '{B.SMS_TYPE}' AND stat = '{B.SMS_DELIVERED}'
                 THEN struct_pack(created := created, comments_long := comments_long) END) AS s,
        MAX(CASE WHEN comments_long != '' AND todo_cd = '{B.CALL_TYPE}' AND stat != '{B.CALL_BAD_NUMBER}'
                 THEN struct_pack(created := created, comments_long := comments_long) END) AS k
      FROM activity GROUP BY con_id) m
LEFT JOIN contact c ON m.con_id = c.row_id
""")
def q_wide(spark: SparkSession, d: str) -> DataFrame:
    a, c, _ = _parts(spark, d)
    return C.latest_channel_wide(a, c, B.channel_branches())
