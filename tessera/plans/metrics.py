"""Wide hourly metric store and its three query functions.

Data model: a metric *catalog* (``metric_id, name, explain, data_type,
table_name``), metric *panels* keyed by ``(customer_id, metric_timestamp)`` that
each own a slice of the metric columns, a ``people`` table (``customer_id,
city_id, first_name, last_name``) and ``cities`` (``city_id, name``).

Queries are assembled as DataFrames: only the panels that own a requested metric
are joined (panel pruning), only the requested columns are read (column pruning),
time bounds become plain range predicates pushed into each panel scan, and the
aggregation code picks the grouping expression in Python (no CASE at run time).
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.docs import ident, json_doc_expr
from tessera.functions.timeparts import ALL_BUCKET_TIME, BUCKET_UNITS, ntz_literal, trunc_ntz
from tessera.operators.aggregates import first_last_seen
from tessera.operators.joins import (
    DEFAULT_BROADCAST_LIMIT,
    join_dimension,
    maybe_broadcast,
    panel_join,
)

KEYS = ("customer_id", "metric_timestamp")
PERSON_CODES = ("DY", "WK", "MO")
CITY_CODES = ("DY", "WK", "MO", "ALL")
# identifiers not followed by "(" (function names are not metrics)
_IDENT = re.compile(r"\b([A-Za-z_][A-Za-z0-9_]*)\b(?!\s*\()")
_SQL_WORDS = {"case", "when", "then", "else", "end", "null", "and", "or", "not", "is", "in",
              "between", "true", "false", "as", "cast", "decimal", "double", "bigint", "int"}


@dataclass
class MetricStore:
    catalog: DataFrame
    panels: dict[str, DataFrame]
    people: DataFrame
    cities: DataFrame
    _catalog_rows: list | None = field(default=None, repr=False)

    @classmethod
    def from_tables(cls, spark, catalog: DataFrame, tables: dict[str, str], people: DataFrame,
                    cities: DataFrame) -> "MetricStore":
        """Store over catalog tables (e.g. bucketed panels written by ``write_panel_tables``).

        Bucketed panels share ``customer_id`` as their only bucket key. A caller who sets
        ``spark.sql.requireAllClusterKeysForCoPartition`` to false lets a join on
        ``(customer_id, metric_timestamp)`` reuse that partitioning, without a shuffle; the
        setting holds for the whole session, so it is left to the caller.
        """
        return cls(catalog, {t: spark.table(n) for t, n in tables.items()}, people, cities)

    def catalog_rows(self) -> list:
        """The catalog as driver-side rows: it is one row per metric (thousands at most)."""
        if self._catalog_rows is None:
            self._catalog_rows = [tuple(r) for r in self.catalog.select("name", "table_name").collect()]
        return self._catalog_rows


@dataclass(frozen=True)
class Resolved:
    metrics: list[tuple[str, str]]          # every needed (name, table), ordered by name
    shown: list[str]                         # metrics asked for by name, ordered by name
    formulas: list[tuple[str, str]]          # (alias, expression)

    @property
    def tables(self) -> list[str]:
        return sorted({t for _, t in self.metrics})


def resolve(store: MetricStore, metric_names: str, formulas: dict[str, str] | None = None) -> Resolved:
    """Split the comma list (no trimming), keep names found in the catalog, order by name.

    Unknown names are dropped silently. Formula identifiers must all be catalog
    metrics. An empty result is an error (there would be nothing to select).
    """
    owner = dict(store.catalog_rows())
    wanted = set(metric_names.split(",")) if metric_names else set()
    used = {n for n in wanted if n in owner}
    fs = []
    for alias, expr in (formulas or {}).items():
        idents = {i for i in _IDENT.findall(expr) if i.lower() not in _SQL_WORDS}
        unknown = {i for i in idents if i not in owner}
        if unknown:
            raise ValueError(f"formula {alias!r} uses unknown metrics {sorted(unknown)}")
        used |= idents
        fs.append((alias, expr))
    if not used:
        raise ValueError("no requested metric exists in the catalog")
    shown = sorted(n for n in wanted if n in owner)
    return Resolved(sorted((n, owner[n]) for n in used), shown, fs)


def _time_range(df: DataFrame, start, end) -> DataFrame:
    """Inclusive bounds, each optional; absent bound = open end."""
    ts = F.col("metric_timestamp")
    if start is not None:
        df = df.filter(ts >= ntz_literal(start))
    if end is not None:
        df = df.filter(ts <= ntz_literal(end))
    return df


def _joined_panels(store: MetricStore, r: Resolved, start, end, customer_id=None) -> DataFrame:
    """Inner join (USING the key pair) of the panels that own a requested metric.

    Each panel is filtered by the time range (and the person) before the join, so
    the filters reach every Parquet scan; unused metric columns are pruned by
    Catalyst from the final projection or aggregation (no per-column select is
    built here, which keeps thousand-column requests cheap to assemble).
    """
    frames = []
    for table in r.tables:
        p = store.panels[table]
        if customer_id is not None:
            p = p.filter(F.col("customer_id") == F.lit(customer_id))
        frames.append(_time_range(p, start, end))
    return panel_join(frames, KEYS)


def _doc(r: Resolved, summed: bool) -> Column:
    """The result document as one expression: named metrics (``<m>`` or ``<m>_sum``),
    then formulas; inside ``agg`` when ``summed``."""
    if summed:
        fields = [(f"{n}_sum", f"sum({ident(n)})") for n in r.shown]
        fields += [(f"{a}_sum", f"sum({e})") for a, e in r.formulas]
    else:
        fields = [(n, ident(n)) for n in r.shown]
        fields += [(a, f"({e})") for a, e in r.formulas]
    return json_doc_expr(fields)


def _bucket(code: str | None, allowed: tuple[str, ...]) -> Column | None:
    if code is None:
        return None
    if code not in allowed:
        raise ValueError(f"unknown aggregation code {code!r}; expected one of {allowed} or None")
    if code == "ALL":
        return ntz_literal(ALL_BUCKET_TIME)
    return trunc_ntz(BUCKET_UNITS[code], "metric_timestamp")


def find_customer(store: MetricStore, last_name: str, first_name: str | None = None,
                  first_panel: str | None = None) -> DataFrame:
    """``city, last_name, first_name, first_seen, last_seen`` of matching people.

    Only people with rows in the first panel appear (inner join), one row per
    ``(city, last_name, first_name)``.
    """
    cond = F.col("last_name") == F.lit(last_name)
    if first_name is not None:
        cond = cond & (F.col("first_name") == F.lit(first_name))
    people = store.people.filter(cond).select("customer_id", "city_id", "last_name", "first_name")
    people = join_dimension(people, store.cities.select("city_id", F.col("name").alias("city")), "city_id", "inner")
    panel = store.panels[first_panel or sorted(store.panels)[0]].select(*KEYS)
    # How few people a name leaves is seen at run time only: AQE then broadcasts them.
    seen = panel.join(people, "customer_id", "inner")
    return first_last_seen(seen, ["city", "last_name", "first_name"], "metric_timestamp")


def customer_metrics(store: MetricStore, customer_id: int, metric_names: str,
                     start: dt.datetime | None = None, end: dt.datetime | None = None,
                     agg: str | None = None, formulas: dict[str, str] | None = None) -> DataFrame:
    """``result_time, result`` for one person: raw rows or DY/WK/MO sums, ordered by time."""
    r = resolve(store, metric_names, formulas)
    bucket = _bucket(agg, PERSON_CODES)
    rows = _joined_panels(store, r, start, end, customer_id)
    if bucket is None:
        out = rows.select(F.col("metric_timestamp").alias("result_time"), _doc(r, False).alias("result"))
    else:
        out = rows.groupBy(bucket.alias("result_time")).agg(_doc(r, True).alias("result"))
    return out.orderBy("result_time")


def city_metrics(store: MetricStore, metric_names: str,
                 start: dt.datetime | None = None, end: dt.datetime | None = None,
                 agg: str | None = None, formulas: dict[str, str] | None = None,
                 people_broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """``city, result_time, result``: raw person rows labelled by city, or sums per city
    and DY/WK/MO bucket, or whole-period sums (``ALL``, time = sentinel).

    People are a dimension: when their checked size allows, they are broadcast and
    the only shuffle is the partial aggregation's. Otherwise the joined panel rows
    are first summed per (person, bucket) — sums compose, NULLs included — so the
    shuffle join with people moves one row per person and bucket, not per hour.
    """
    r = resolve(store, metric_names, formulas)
    bucket = _bucket(agg, CITY_CODES)
    rows = _joined_panels(store, r, start, end)
    base_people = store.people.select("customer_id", "city_id")
    base_cities = store.cities.select("city_id", F.col("name").alias("city"))
    people = join_dimension(base_people, base_cities, "city_id", "inner").select("customer_id", "city")
    small_people = maybe_broadcast(people, people_broadcast_limit, bounded_by=[base_people, base_cities])
    if bucket is None:
        out = rows.join(small_people, "customer_id", "inner").select(
            "city", F.col("metric_timestamp").alias("result_time"), _doc(r, False).alias("result"))
        return out.orderBy("result_time", "city")
    if small_people is not people:  # broadcast: aggregate once, map-side join
        out = (rows.join(small_people, "customer_id", "inner").groupBy("city", bucket.alias("result_time"))
               .agg(_doc(r, True).alias("result")))
    else:
        # per (person, bucket) partial sums, then the shuffle join with people and the
        # city sums over them (sums compose, NULLs included)
        parts = [(f"{n}_sum", f"sum({ident(n)})") for n in r.shown]
        parts += [(f"{a}_sum", f"sum({e})") for a, e in r.formulas]
        partial = ", ".join(f"'p{i}', {e}" for i, (_, e) in enumerate(parts))
        per_person = rows.groupBy("customer_id", bucket.alias("result_time")).agg(
            F.expr(f"named_struct({partial})").alias("__p"))
        out = (per_person.join(people, "customer_id", "inner").groupBy("city", "result_time")
               .agg(json_doc_expr([(k, f"sum(__p.p{i})") for i, (k, _) in enumerate(parts)]).alias("result")))
    return out.orderBy("result_time", "city")


def metric_rows(store: MetricStore, metric_names: str, start=None, end=None) -> DataFrame:
    """The joined panel rows with the requested metric columns (the panel join itself)."""
    r = resolve(store, metric_names)
    return _joined_panels(store, r, start, end).selectExpr(*KEYS, *[ident(n) for n, _ in r.metrics])
