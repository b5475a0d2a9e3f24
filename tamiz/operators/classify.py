"""Classification of records: ordered rules, then a pluggable model for what they leave open, then a closed list of labels."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.model_json import labels_of
from tamiz.functions.text import jvm_pattern
from tamiz.operators.metrics import short_answers
from tamiz.session import staged

log = logging.getLogger(__name__)

#: A model: takes the prompt of a batch, gives its answer as text; an error counts as an empty answer.
Model = Callable[[str], str]


def classifier_text(*fields: Column) -> Column:
    """The text that is classified: the fields with a space between them, NULL as the empty string."""
    return F.concat_ws(" ", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])


def valid_rules(rules: Iterable[dict]) -> list[tuple[str, str]]:
    """``(pattern, category)`` of the usable rules in order; rules without either, or with a broken pattern, are left out."""
    out = []
    for rule in rules:
        pattern, category = rule.get("pattern"), rule.get("category")
        if not pattern or not category:
            log.warning("rule without pattern or category: %r", rule)
            continue
        try:
            re.compile(pattern)
        except re.error as e:
            log.warning("broken pattern %r: %s", pattern, e)
            continue
        out.append((pattern, category))
    return out


def rule_label(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Category of the first rule whose pattern is found anywhere in ``text``, letter case aside; ``''`` if none is."""
    chain = None
    for pattern, category in rules:
        hit = text.rlike(jvm_pattern(pattern))
        chain = F.when(hit, category) if chain is None else chain.when(hit, category)
    return F.lit("") if chain is None else chain.otherwise("")


def in_domain(label: Column, categories: Sequence[str], other: str = "otros") -> Column:
    """``label`` if it is in the closed list, else ``other``."""
    return F.when(label.isin(*categories), label).otherwise(other)


def numbered_batches(rows: DataFrame, order: Sequence[Column | str], size: int = 20) -> DataFrame:
    """``rows`` with ``place`` (from 0, in the given order) and ``batch`` of ``size`` consecutive records.

    The places are counted without moving all rows into one task: rows are range-partitioned by the order, and a count for
    each range gives its first place.
    """
    spread = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__id", 33)
    sizes = spread.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__first"))  # a row for each range
    place = F.col("__first") + F.col("__id").bitwiseAND((1 << 33) - 1)
    placed = spread.withColumn("__p", part).join(F.broadcast(first) if sizes.count() <= 100_000 else first, "__p").withColumn("place", place)
    return placed.withColumn("batch", F.floor(F.col("place") / size).cast("bigint")).drop("__id", "__p", "__first")


def prompt_lines(key: Column, title: Column, detail: Column) -> Column:
    """The line of a record in a prompt: ``key: title -- detail``."""
    empty = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat(empty(key), F.lit(": "), empty(title), F.lit(" -- "), empty(detail))


def batch_prompts(batched: DataFrame, line: Column, head: str = "") -> DataFrame:
    """``batch, prompt``: the lines of each batch in order of ``place``, under a common head."""
    lines = batched.select("batch", "place", line.alias("line")).groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("l"))
    return lines.select("batch", F.concat(F.lit(head), F.array_join(F.transform("l", lambda x: x["line"]), "\n")).alias("prompt"))


def ask(prompts: DataFrame, model: Model) -> DataFrame:
    """``batch, response``: the model's answer to each prompt, ``''`` where it fails."""

    def call(frames: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        def one(prompt: str) -> str:
            try:
                return model(prompt) or ""
            except Exception as e:
                log.warning("the model failed: %r", e)
                return ""

        for f in frames:
            yield pd.DataFrame({"batch": f["batch"], "response": f["prompt"].map(one)})

    return prompts.mapInPandas(call, "batch bigint, response string")


def with_model_labels(unresolved: DataFrame, labels: DataFrame, key: str, other: str = "otros") -> DataFrame:
    """``sector`` of records from the labels of their own batch (``batch, id, label``); ``other`` where there is none."""
    have = labels.select(F.col("batch").alias("__b"), F.col("id").alias("__id"), "label")
    joined = unresolved.join(have, (F.col("batch") == F.col("__b")) & (F.col(key) == F.col("__id")), "left")
    return joined.withColumn("sector", F.coalesce("label", F.lit(other))).drop("__b", "__id", "label")


def classify(
    rows: DataFrame, key: str, title: str, detail: str, rules: Sequence[tuple[str, str]], categories: Sequence[str], model: Model | None = None,
    size: int = 20, order: Sequence[str] | None = None, head: str = "", other: str = "otros", short: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """``rows`` with ``sector``: by rules, else by the model in batches of ``size``, else ``other``; always of the closed list.

    The model is asked once for each batch: its answers are written before they are used. ``short`` is given the batches
    whose answers do not fit in number (see ``short_answers``).
    """
    ruled = rows.withColumn("sector", rule_label(classifier_text(F.col(title), F.col(detail)), rules))
    done = ruled.where(F.col("sector") != "")
    pending = ruled.where(F.col("sector") == "").drop("sector")
    if model is None:
        pending = pending.withColumn("sector", F.lit(other))
    else:
        batched = staged(numbered_batches(pending, order or [key], size), "batched")
        answers = staged(ask(batch_prompts(batched, prompt_lines(F.col(key), F.col(title), F.col(detail)), head), model), "answers")
        labels = labels_of(answers, "response", ["batch"])
        if short:
            short(short_answers(batched, labels))
        pending = with_model_labels(batched, labels, key, other).drop("batch", "place")
    return done.unionByName(pending).withColumn("sector", in_domain(F.col("sector"), categories, other))
