"""Counts of a run, taken while its data passes by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its rows and of the rows that meet each condition; read it after an action."""
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count(F.when(c, True)).alias(n) for n, c in conditions.items()]]
    return df.observe(seen, *counts), seen


def failure_ratio(pages: DataFrame) -> DataFrame:
    """``pages, failed, ratio`` of fetched pages (see ``fetch_pages``); an empty table has the ratio 0."""
    failed = F.count(F.when(F.col("html").isNull(), 1))
    return pages.agg(F.count(F.lit(1)).alias("pages"), failed.alias("failed"), F.coalesce(failed / F.nullif(F.count(F.lit(1)), F.lit(0)), F.lit(0.0)).alias("ratio"))


def short_answers(batched: DataFrame, labels: DataFrame) -> DataFrame:
    """``batch, asked, answered`` of batches whose answer does not hold as many labels as there were records."""
    asked = batched.groupBy("batch").agg(F.count(F.lit(1)).alias("asked"))
    answered = labels.groupBy("batch").agg(F.count(F.lit(1)).alias("answered"))
    both = asked.join(answered, "batch", "left").withColumn("answered", F.coalesce("answered", F.lit(0)))
    return both.where("asked <> answered")
