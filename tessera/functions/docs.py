"""Per-row JSON documents (the result column of the metric functions)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _quote_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def json_doc_expr(fields: Iterable[tuple[str, str]]) -> Column:
    """``{"k1": v1, ...}`` in the given key order, NULLs kept, from ``(key, SQL expression)`` pairs, as ONE
    expression: for thousands of metrics this avoids one driver round trip per column.
    The expressions may be aggregates (``sum(`m`)``) when used inside ``agg``."""
    body = ", ".join(f"{_quote_text(k)}, {e}" for k, e in fields)
    return F.expr(f"to_json(named_struct({body}), map('ignoreNullFields', 'false'))")


def ident(name: str) -> str:
    """A column name quoted for use inside an SQL expression."""
    return _quote_ident(name)
