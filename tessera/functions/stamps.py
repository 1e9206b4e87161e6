"""Version stamps: fixed-width hex text, so text order equals numeric order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed format of the stamp text: "0x" + lower-case hex, zero padded to 8 digits.
STAMP_PREFIX = "0x"
STAMP_WIDTH = 8
ZERO_STAMP = "0x00000000"


def hex_stamp(n: Column | str) -> Column:
    """``'0x%08x' % n`` as a column; wider numbers keep all their digits."""
    h = F.lower(F.hex(F.col(n) if isinstance(n, str) else n))
    padded = F.when(F.length(h) >= STAMP_WIDTH, h).otherwise(F.lpad(h, STAMP_WIDTH, "0"))
    return F.concat(F.lit(STAMP_PREFIX), padded)


def stamp_value(s: Column | str) -> Column:
    """Numeric value of a stamp text (``int(s, 0)``)."""
    c = F.col(s) if isinstance(s, str) else s
    return F.conv(F.substring(c, 3, 64), 16, 10).cast("bigint")
