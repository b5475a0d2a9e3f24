"""History of changing attributes: versions of an entity with the period in which each was valid.

Gaps and islands over all observations. Per entity the observations are put in order of time; where the hash of the
attributes differs from the one before, a version begins; a running sum over those marks numbers the islands; an
island's least time opens its period and the next island's least time closes it.

One entity may hold a large share of all rows, so nothing is windowed over a whole entity's rows: observations are first
aggregated to one per (entity, time), then windowed per (entity, day). Only a summary with one row per entity and day
carries the last hash and the count of changes across days; its groups are bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names this operator adds, kept apart from the input's columns.
_K, _T, _H, _DAY = "__key", "__at", "__hash", "__day"


def state_hash(*attributes: Column) -> Column:
    """128-bit digest of attribute values in which NULL is a value of its own."""
    return F.md5(F.to_json(F.struct(*[a.alias(f"a{i}") for i, a in enumerate(attributes)]), {"ignoreNullFields": "false"}))


def attribute_history(
    rows: DataFrame,
    key: Column,
    at: Column,
    attributes: dict[str, Column],
    precedence: Sequence[Column] = (),
) -> DataFrame:
    """Versions of each entity.

    ``key``: the entity; rows where it is NULL are left out. ``at``: when the state was observed; rows where it is NULL are
    left out. ``attributes``: the state, by output name (atomic values or arrays of strings; NULL is a value).
    ``precedence``: of rows with equal ``key`` and ``at``, the one with the greatest precedence counts (a tie on all of it
    falls to the greatest state hash, so the result never depends on row order).

    Gives ``entity_key, version, valid_from, valid_to, is_current, observations, last_seen`` and the attributes: periods
    are half-open, without gaps or overlaps; ``valid_to`` of the current version is NULL. An empty table gives an empty
    result; repeated rows and other columns of the input, whatever their names, make no difference.
    """
    names = list(attributes)
    points = rows.select(
        key.alias(_K), at.alias(_T), F.struct(*[p.alias(f"p{i}") for i, p in enumerate(precedence)], state_hash(*attributes.values()).alias("h")).alias("__rank"),
        F.struct(*[c.alias(n) for n, c in attributes.items()]).alias("__state"),
    ).where(F.col(_K).isNotNull() & F.col(_T).isNotNull())
    points = (
        points.groupBy(_K, _T)
        .agg(F.max(F.struct("__rank", "__state")).alias("__top"))
        .select(_K, _T, F.to_date(_T).alias(_DAY), F.col("__top.__rank.h").alias(_H), F.col("__top.__state").alias("__state"))
        .where(F.col(_DAY).isNotNull())  # always true; both sides of the join below then read one and the same exchange
    )
    in_day = Window.partitionBy(_K, _DAY).orderBy(_T)
    marked = points.withColumn("__prev", F.lag(_H).over(in_day)).withColumn("__mark", F.when(F.col("__prev") != F.col(_H), 1).otherwise(0))
    # Only rows that may open a version take their state further.
    marked = marked.withColumn("__state", F.when(F.col("__prev").isNull() | (F.col("__mark") == 1), F.col("__state")))
    days = marked.groupBy(_K, _DAY).agg(
        F.min_by(_H, _T).alias("__first"), F.max_by(_H, _T).alias("__last"), F.sum("__mark").alias("__inner")
    )
    over_days = Window.partitionBy(_K).orderBy(_DAY)
    opened = F.when(F.coalesce(F.lag("__last").over(over_days) == F.col("__first"), F.lit(False)), 0).otherwise(1)
    days = (
        days.withColumn("__opened", opened)
        .withColumn("__before", F.coalesce(F.sum(F.col("__opened") + F.col("__inner")).over(over_days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(F.col(_K).alias("__k2"), F.col(_DAY).alias("__d2"), "__opened", "__before")
    )
    numbered = marked.join(days, (F.col(_K) == F.col("__k2")) & (F.col(_DAY) == F.col("__d2"))).select(
        _K, _T, "__state",
        (F.col("__before") + F.col("__opened") + F.sum("__mark").over(in_day.rowsBetween(Window.unboundedPreceding, 0))).alias("version"),
    )
    islands = numbered.groupBy(_K, "version").agg(
        F.min(_T).alias("valid_from"), F.max(_T).alias("last_seen"), F.count(F.lit(1)).alias("observations"), F.min_by("__state", _T).alias("__state")
    )
    # The next version's start reaches this version by key (entity, version - 1), not by a window over the entity.
    ends = islands.select(F.col(_K).alias("__k2"), (F.col("version") - 1).alias("__v2"), F.col("valid_from").alias("valid_to"))
    closed = islands.join(ends, (F.col(_K) == F.col("__k2")) & (F.col("version") == F.col("__v2")), "left")
    return closed.select(
        F.col(_K).alias("entity_key"), "version", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), "observations", "last_seen",
        *[F.col(f"__state.`{n}`").alias(n) for n in names],
    )
