"""Per-key enrichment from an external lookup (the flow's REST lookup), batched on executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetch_lookup(
    keys: DataFrame,
    key: str,
    fetch: Callable[[list[str]], dict[str, str | None]],
    out: str = "house",
) -> DataFrame:
    """``key, out`` for the distinct keys, with values from ``fetch`` (e.g. an HTTP client).

    Keys are de-duplicated by Spark first; each executor then calls ``fetch`` once
    per Arrow batch of keys (``mapInPandas``), never once per row and never on the
    driver. Unknown keys get NULL. ``fetch`` must be picklable and idempotent:
    a retried task calls it again.
    """
    distinct = keys.select(F.col(key).cast("string").alias(key)).distinct()

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ks = pdf[key].tolist()
            found = fetch(ks) if ks else {}
            yield pd.DataFrame({key: ks, out: [found.get(k) for k in ks]})

    return distinct.mapInPandas(per_batch, schema=f"{key} string, {out} string")
