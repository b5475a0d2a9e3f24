"""What changed between consecutive full snapshots of a table.

Content-defined chunks: the rows of every snapshot are sorted by key within hash buckets of the key, and cut wherever the
hash of a key says so, so that equal stretches of two snapshots fall into equal chunks even after insertions. A chunk
whose digest equals that of the chunk with the same start in the next snapshot holds no change and is dropped. Only rows
of unmatched chunks are joined by key and classified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most loads whose numbers are broadcast.
BROADCAST_LOADS = 10_000


def latest_per_snapshot(rows: DataFrame, snapshot: Column, key: Column, value: Column, precedence: list[Column]) -> DataFrame:
    """One row ``load, key, value`` per snapshot and key: that with the greatest precedence (then the greatest value).

    Rows without snapshot or key are left out.
    """
    return (
        rows.select(
            snapshot.alias("load"), key.alias("key"),
            F.struct(*[p.alias(f"p{i}") for i, p in enumerate(precedence)], value.alias("v")).alias("top"),
        )
        .where(F.col("load").isNotNull() & F.col("key").isNotNull())
        .groupBy("load", "key")
        .agg(F.max("top").alias("top"))
        .select("load", "key", F.col("top.v").alias("value"))
    )


def content_chunks(snapshots: DataFrame, mean_rows: int = 64, buckets: int | None = None) -> DataFrame:
    """Adds ``bucket`` and ``chunk`` (the key that opens the chunk; ``''`` for a bucket's head) to rows of ``load, key``.

    ``mean_rows``: mean rows of a chunk. ``buckets``: hash ranges of keys that are sorted apart; default sixteen for each
    shuffle partition, so that a sort never holds more than a small share of one snapshot. Neither changes the result of
    a diff.
    """
    if buckets is None:
        buckets = 16 * int(snapshots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = F.pmod(F.xxhash64(F.lit("cut"), F.col("key")), F.lit(mean_rows)) == 0
    in_order = Window.partitionBy("bucket", "load").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    return snapshots.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")).withColumn(
        "chunk", F.coalesce(F.last(F.when(cut, F.col("key")), ignorenulls=True).over(in_order), F.lit(""))
    )


def _neighbours(snapshots: DataFrame) -> DataFrame:
    """``l, earlier, later`` of each load. Broadcast up to ``BROADCAST_LOADS`` rows of three numbers, else left to the planner."""
    spark = snapshots.sparkSession
    order = Window.orderBy("load")
    loads = snapshots.select("load").distinct()
    linked = loads.select(F.col("load").alias("l"), F.lag("load").over(order).alias("earlier"), F.lead("load").over(order).alias("later"))
    few = linked.limit(BROADCAST_LOADS + 1).collect()
    if len(few) > BROADCAST_LOADS:
        return linked
    return F.broadcast(spark.createDataFrame(few, linked.schema))


def snapshot_changes(snapshots: DataFrame, mean_rows: int = 64, buckets: int | None = None) -> DataFrame:
    """Changes between each snapshot and the one delivered before it in number.

    Takes ``load, key, value`` with one row per load and key (see :func:`latest_per_snapshot`); a NULL value is a value.
    Gives ``load`` (the later of the two), ``key``, ``change`` (``added``, ``removed``, ``changed``), ``before``, ``after``.
    The first snapshot gives no rows, nor does an empty table or a table of one snapshot.
    """
    loads = _neighbours(snapshots)
    chunked = content_chunks(snapshots, mean_rows, buckets)
    # Each row is the newer side of its own comparison and the older side of the next one.
    sides = (
        chunked.join(loads, F.col("load") == F.col("l"))
        .select(
            "key", "value", "bucket", "chunk",
            F.explode(
                F.filter(
                    F.array(
                        F.struct(F.when(F.col("earlier").isNotNull(), F.col("load")).alias("pair"), F.lit(True).alias("new")),
                        F.struct(F.col("later").alias("pair"), F.lit(False).alias("new")),
                    ),
                    lambda s: s["pair"].isNotNull(),
                )
            ).alias("side"),
        )
        .select("key", "value", "bucket", "chunk", "side.pair", "side.new")
    )
    one, two = (F.bit_xor(F.xxhash64(F.lit(seed), F.col("key"), F.coalesce(F.concat(F.lit("v"), F.col("value").cast("string")), F.lit("n")))) for seed in ("one", "two"))
    digests = sides.groupBy("pair", "bucket", "chunk", "new").agg(F.struct(F.count(F.lit(1)).alias("n"), one.alias("a"), two.alias("b")).alias("d"))
    unmatched = (
        digests.groupBy("pair", "bucket", "chunk")
        .agg(F.max(F.when(F.col("new"), F.col("d"))).alias("dn"), F.max(F.when(~F.col("new"), F.col("d"))).alias("do"))
        .where(~F.col("dn").eqNullSafe(F.col("do")))
        .select("pair", "bucket", "chunk")
    )
    left = sides.join(unmatched, ["pair", "bucket", "chunk"], "left_semi")
    new = left.where("new").select(F.col("pair").alias("np"), F.col("key").alias("nk"), F.col("value").alias("after"), F.lit(True).alias("is_new"))
    old = left.where("not new").select(F.col("pair").alias("op"), F.col("key").alias("ok"), F.col("value").alias("before"), F.lit(True).alias("is_old"))
    change = F.when(F.col("is_old").isNull(), "added").when(F.col("is_new").isNull(), "removed").when(~F.col("before").eqNullSafe(F.col("after")), "changed")
    return (
        new.join(old, (F.col("np") == F.col("op")) & (F.col("nk") == F.col("ok")), "full")
        .select(F.coalesce("np", "op").alias("load"), F.coalesce("nk", "ok").alias("key"), change.alias("change"), "before", "after")
        .where(F.col("change").isNotNull())
    )
