"""Row checksums: MD5 of canonical JSON, equal to Python's ``json.dumps`` with sorted keys and no ASCII escapes."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Short escapes of control characters in JSON: fixed values.
_SHORT = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}


def json_string(c: Column) -> Column:
    """A JSON string literal of ``c``. Escapes are replaced only in values that hold a character to be escaped."""
    escapes = [("\\", "\\\\"), ('"', '\\"')] + [(chr(i), _SHORT.get(i, f"\\u{i:04x}")) for i in range(32)]
    escaped = reduce(lambda e, pair: F.replace(e, F.lit(pair[0]), F.lit(pair[1])), escapes, c)
    return F.concat(F.lit('"'), F.when(c.rlike(r'["\\\x00-\x1f]'), escaped).otherwise(c), F.lit('"'))


def canonical_json(fields: dict[str, Column]) -> Column:
    """JSON object of string fields in sorted key order with ``", "`` and ``": "``; a NULL or missing field is ``""``."""
    parts: list[Column] = []
    for i, name in enumerate(sorted(fields)):
        head = ("{" if i == 0 else ", ") + json.dumps(name, ensure_ascii=False) + ": "
        parts += [F.lit(head), json_string(F.coalesce(fields[name].cast("string"), F.lit("")))]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


def row_checksum(df: DataFrame, fields: list[str]) -> Column:
    """MD5 of the canonical JSON of ``fields``; those the table lacks count as ``""``."""
    have = set(df.columns)
    return F.md5(canonical_json({f: F.col(f"`{f}`") if f in have else F.lit("") for f in fields}))


def with_checksum(df: DataFrame, fields: list[str], key: str = "checksum") -> DataFrame:
    """``df`` with a checksum column; unchanged where no fields are configured."""
    return df.withColumn(key, row_checksum(df, fields)) if fields else df


def checksum_or_computed(df: DataFrame, fields: list[str], key: str) -> Column:
    """The delivered checksum, computed where it is missing or empty."""
    computed = row_checksum(df, fields)
    return F.coalesce(F.nullif(F.col(key), F.lit("")), computed) if key in df.columns else computed
