"""Answers of a model: JSON lists of ``{id, label}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RECORDS = "array<struct<id:string,label:string>>"


def label_records(response: Column) -> Column:
    """The records of an answer with a non-empty id and label, in order.

    Anything but a JSON list (broken text, a lone object, text around the list) gives the empty array. Numeric ids come out
    as text. A list with an element that is no object gives the records of its objects.
    """
    listed = F.when(response.rlike(r"^\s*\["), F.from_json(response, "array<string>"))
    records = F.transform(listed, lambda e: F.struct(F.get_json_object(e, "$.id").alias("id"), F.get_json_object(e, "$.label").alias("label")))
    good = F.filter(records, lambda r: (F.coalesce(r["id"], F.lit("")) != "") & (F.coalesce(r["label"], F.lit("")) != ""))
    return F.coalesce(good, F.array().cast(_RECORDS))


def labels_of(responses: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys, id, label`` of all answers, one row for each id of an answer; of repeated ids the last one counts."""
    placed = responses.select(*keys, F.posexplode(label_records(F.col(text))).alias("place", "record"))
    return placed.groupBy(*keys, F.col("record.id").alias("id")).agg(F.max_by(F.col("record.label"), "place").alias("label"))
