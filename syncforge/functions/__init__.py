from syncforge.functions.casts import (
    MONEY,
    empty_to_null,
    money_text,
    try_bool,
    try_date,
    try_decimal,
    try_double,
    try_int,
    try_long,
    try_timestamp,
)
from syncforge.functions.columns import as_col, has_path
from syncforge.functions.jsonpaths import parse_json, row_json
from syncforge.functions.keys import bucket_of, idempotency_key, row_fingerprint

__all__ = [
    "MONEY",
    "as_col",
    "bucket_of",
    "empty_to_null",
    "has_path",
    "idempotency_key",
    "money_text",
    "parse_json",
    "row_fingerprint",
    "row_json",
    "try_bool",
    "try_date",
    "try_decimal",
    "try_double",
    "try_int",
    "try_long",
    "try_timestamp",
]
