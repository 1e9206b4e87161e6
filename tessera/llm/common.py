"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage ends there, and a
    lost executor loses nothing of it."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def digest64(text: str | bytes) -> int:
    """Stable unsigned 64-bit digest of a short string (seeds, feature names)."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")


def fold_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


class Interned(dict):
    """A bounded cache of ``make(key)``: emptied when it holds ``limit`` entries."""

    def __init__(self, make, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def ascii_lower(text: str) -> str:
    """Lower-case A-Z only."""
    return text.translate(_ASCII_LOWER)


_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def ascii_words(text: str) -> list[str]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased.

    Works on UTF-8 bytes: ``bytes.lower`` and ``bytes.split`` know exactly A-Z and
    exactly these six white-space bytes.
    """
    return text.encode("utf-8", "surrogatepass").lower().split()


def batches(frames: Iterator, size: int) -> Iterator:
    """Cut incoming pandas frames into pieces of at most ``size`` rows."""
    for pdf in frames:
        for i in range(0, len(pdf), size):
            yield pdf.iloc[i:i + size]
