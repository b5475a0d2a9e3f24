"""Cleaning of records and their conformance to a stored schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import strip


def with_key(df: DataFrame, key: str) -> DataFrame:
    """Records with a non-blank key, the key stripped."""
    return df.withColumn(key, strip(key)).where(F.col(key) != "")


#: Name of the key in tables that were laid out before keys had names of their own: a fixed value.
LEGACY_KEY = "no_camara"


def rename_legacy_key(df: DataFrame, key: str, legacy: str = LEGACY_KEY) -> DataFrame:
    """``legacy`` renamed to ``key`` where a table has only the former."""
    return df.withColumnRenamed(legacy, key) if key not in df.columns and legacy in df.columns else df


def date_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """New columns from others, the empty string as NULL; a missing source gives NULL."""
    return df.withColumns({new: F.nullif(F.col(old).cast("string"), F.lit("")) if old in df.columns else F.lit(None).cast("string") for new, old in aliases.items()})


def clean(df: DataFrame, key: str, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Key filter and trim, then date aliases."""
    return date_aliases(with_key(df, key), aliases or {})


def conformed_column(df: DataFrame, name: str, kind: str, formats: Mapping[str, str] | None = None) -> Column:
    """A column as the stored type ``kind`` (``TEXT``, ``DATE``, ``TIMESTAMP``, ``JSONB``) wants it.

    Blank strings are NULL and others stay as they are, untrimmed; dates that do not fit their format are NULL; JSON is the
    canonical text of a list, ``[]`` for NULL, empty and missing values; a missing column is NULL.
    """
    word = kind.split()[0].upper()
    if word == "JSONB":
        if name not in df.columns:
            return F.lit("[]").alias(name)
        c = F.col(name)
        if df.schema[name].dataType.simpleString() == "string":
            return F.when(strip(c) != "", c).otherwise("[]").alias(name)
        return F.coalesce(F.to_json(c), F.lit("[]")).alias(name)
    target = {"TEXT": "string", "DATE": "date", "TIMESTAMP": "timestamp"}.get(word)
    if target is None:
        raise ValueError(f"type not supported: {kind}")
    if name not in df.columns:
        return F.lit(None).cast(target).alias(name)
    c = F.col(name)
    if df.schema[name].dataType.simpleString() != "string":
        return c.cast(target).alias(name)
    c = F.when(strip(c) != "", c)
    if target == "date":
        return F.try_to_date(strip(c), (formats or {}).get(name, "yyyy-MM-dd")).alias(name)
    if target == "timestamp":
        return F.try_to_timestamp(strip(c)).alias(name)
    return c.alias(name)


def conform(df: DataFrame, columns: Mapping[str, str], formats: Mapping[str, str] | None = None) -> DataFrame:
    """Exactly the declared columns in their order and types; other columns are dropped."""
    return df.select(*[conformed_column(df, n, k, formats) for n, k in columns.items()])
