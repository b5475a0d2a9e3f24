"""The same upserts on a stream: each micro-batch goes through the batch operators.

An extension: what a stream of files leaves in the table equals what one batch of all of them would.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tamiz.operators.store import SnapshotTable


def upsert_stream(
    stream: DataFrame, table: SnapshotTable, checkpoint: str, order: Sequence[str], keep: Sequence[str] = (), defaults: dict[str, Column] | None = None,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Upserts every available file, then stops. A micro-batch that is delivered again changes nothing."""

    def one(batch: DataFrame, _: int) -> None:
        table.upsert(transform(batch), keep=keep, defaults=defaults, order=order)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
