"""Which records are new or changed against what is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_hash(raw: DataFrame, key: str, value: str, seen: str | None = None) -> DataFrame:
    """One ``key, value`` per key: that seen last, of equal times the greatest (so row order never matters)."""
    rank = F.struct(seen, value) if seen else F.struct(value)
    return raw.groupBy(key).agg(F.max(rank).alias("__top")).select(key, F.col(f"__top.`{value}`").alias(value))


def route(incoming: DataFrame, known: DataFrame, key: str, value: str) -> DataFrame:
    """``incoming`` with ``route``: ``to_detail`` for new keys and other hashes, else ``bypass``.

    ``known`` has one ``key, value`` per key. A NULL hash differs from any other value but NULL.
    """
    have = known.select(F.col(key).alias("__k"), F.col(value).alias("__v"), F.lit(True).alias("__known"))
    joined = incoming.join(have, F.col(key) == F.col("__k"), "left")
    same = F.col("__known").isNotNull() & F.col(value).eqNullSafe(F.col("__v"))
    return joined.withColumn("route", F.when(same, "bypass").otherwise("to_detail")).drop("__k", "__v", "__known")


def new_or_changed(incoming: DataFrame, known: DataFrame, key: str, value: str) -> DataFrame:
    """Incoming records that are not stored with the same hash."""
    have = known.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    return incoming.join(have, (F.col(key) == F.col("__k")) & F.col(value).eqNullSafe(F.col("__v")), "left_anti")


def unchanged(incoming: DataFrame, known: DataFrame, key: str, value: str) -> DataFrame:
    """Incoming records that are stored with the same hash."""
    have = known.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    return incoming.join(have, (F.col(key) == F.col("__k")) & F.col(value).eqNullSafe(F.col("__v")), "left_semi")


def first_n(rows: DataFrame, order: list[Column | str], n: int = 50) -> DataFrame:
    """The first ``n`` records in arrival order (a feature of the pipeline; the order must be total)."""
    return rows.orderBy(*order).limit(n)


def lookup_by_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Records whose key is among ``ids`` (a column of that name)."""
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def merge_routes(detailed: DataFrame, bypassed: DataFrame) -> DataFrame:
    """All records of both routes; columns of one of them are NULL in the other."""
    return detailed.unionByName(bypassed, allowMissingColumns=True)
