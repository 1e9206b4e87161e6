"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from tessera.functions.stamps import hex_stamp, stamp_value
from tessera.functions.timeparts import (
    ALL_BUCKET_TIME,
    BUCKET_UNITS,
    date_literal,
    ntz_literal,
    parse_dmy_date,
    parse_dmy_timestamp,
    trunc_ntz,
    year_month,
)
from tessera.functions.text import (
    UUID_PATTERN,
    common_prefix,
    extract_uuid,
    is_balanced,
    uuid_text,
)

__all__ = [
    "hex_stamp", "stamp_value", "ALL_BUCKET_TIME", "BUCKET_UNITS", "date_literal", "ntz_literal", "parse_dmy_date",
    "parse_dmy_timestamp", "trunc_ntz", "year_month", "UUID_PATTERN",
    "common_prefix", "extract_uuid", "is_balanced", "uuid_text",
]
