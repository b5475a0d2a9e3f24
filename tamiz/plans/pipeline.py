"""One incremental run: list pages, delta, detail pages, cleaning, classification, storage.

The final table is committed before the raw one. A run that fails in between leaves its records unknown to the raw table, so
that the next run takes them up again, and repeating them changes nothing. List pages that could not be fetched are stored
beside the tables, and each run leaves its counts in a log. What a run stages it removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.checksum import checksum_or_computed, with_checksum
from tamiz.functions.text import strip
from tamiz.functions.url import page_urls
from tamiz.operators.classify import Model, classify
from tamiz.operators.clean import LEGACY_KEY, clean, conform, rename_legacy_key, with_key
from tamiz.operators.delta import first_n, latest_hash, route
from tamiz.operators.detail_extract import attach_detail, extract_detail, second_hop
from tamiz.operators.list_extract import extract_list
from tamiz.operators.metrics import counted
from tamiz.operators.store import SnapshotTable, first_per_key
from tamiz.plans.spec import PipelineSpec
from tamiz.session import scratch
from tamiz.sources.pages import Get, dead_letters, fetch_in_rounds, fetch_pages, good_pages, http_get, refreshed


@dataclass(frozen=True)
class RunResult:
    """Counts of a run."""

    listed: int
    to_detail: int
    bypass: int
    stored: int
    failed_pages: int = 0
    short_batches: int = 0


def listed_records(spec: PipelineSpec, pages: DataFrame) -> DataFrame:
    """Records of list pages (``page_no, url, html``) in order, with their checksum, the first ``first_n`` if that is set."""
    records = with_checksum(extract_list(pages, spec.list_spec, carry=["page_no"]), list(spec.list_spec.hash_fields), spec.list_spec.hash_key)
    return first_n(records, ["page_no", "row_no"], spec.first_n) if spec.first_n else records


def detailed_records(spec: PipelineSpec, listed: DataFrame, pages: DataFrame, hop: DataFrame | None = None) -> DataFrame:
    """Listed records with the fields of their detail page, where one was fetched; ``pages`` and ``hop``: ``url, html``."""
    one_page = pages.groupBy("url").agg(F.min("html").alias("html"))
    wanted = listed.select("__row", F.col(spec.input_key).alias("__u")).where("__u <> ''")
    fetched = wanted.join(one_page, F.col("__u") == F.col("url")).select("__row", "html")
    merged = attach_detail(listed, extract_detail(fetched, spec.detail_fields, spec.domain, carry=["__row"]), "__row")
    if hop is not None and "expediente_url" in merged.columns:
        merged = second_hop(merged, hop, spec.domain)
    return merged


def raw_table(spark: SparkSession, spec: PipelineSpec, root: str) -> SnapshotTable:
    return SnapshotTable(spark, f"{root}/{spec.raw.name}", spec.raw.columns, spec.raw.primary_key)


def final_table(spark: SparkSession, spec: PipelineSpec, root: str) -> SnapshotTable:
    return SnapshotTable(spark, f"{root}/{spec.final.name}", spec.final.columns, spec.final.primary_key)


def failed_table(spark: SparkSession, root: str) -> SnapshotTable:
    """List pages that could not be fetched, by address."""
    return SnapshotTable(spark, f"{root}/failed_pages", {"url": "TEXT NOT NULL", "attempts": "TEXT", "error": "TEXT", "failed_at": "TIMESTAMP"}, "url")


def log_table(spark: SparkSession, root: str) -> SnapshotTable:
    """Counts of each run, as JSON."""
    return SnapshotTable(spark, f"{root}/runs", {"run_id": "TEXT NOT NULL", "ended_at": "TIMESTAMP", "counts": "TEXT"}, "run_id")


def run(
    spark: SparkSession, spec: PipelineSpec, root: str, list_pages: DataFrame | None = None, detail_pages: DataFrame | None = None,
    hop_pages: DataFrame | None = None, model: Model | None = None, live: bool = False, get: Get = http_get,
) -> RunResult:
    """One run on offline pages, or with ``live`` on pages that it fetches itself (by ``get``)."""
    if list_pages is None and not live:
        raise ValueError("no pages, and fetching is not allowed")
    with scratch(spark) as stage:
        result = _run(spark, spec, root, list_pages, detail_pages, hop_pages, model, live, get, stage)
    entry = spark.createDataFrame([(uuid.uuid4().hex, json.dumps(asdict(result)))], "run_id string, counts string")
    log_table(spark, root).upsert(entry.withColumn("ended_at", F.current_timestamp()))
    return result


def _run(
    spark: SparkSession, spec: PipelineSpec, root: str, list_pages: DataFrame | None, detail_pages: DataFrame | None, hop_pages: DataFrame | None,
    model: Model | None, live: bool, get: Get, stage: Callable[[DataFrame, str], DataFrame],
) -> RunResult:
    failed = 0
    policy = refreshed(spec.fetch, get) if live else spec.fetch
    if list_pages is None:
        urls = page_urls(spark, spec.base_url, spec.max_pages)
        fetched = fetch_in_rounds(urls, policy, spec.list_concurrency, spec.list_rounds, stage, get)
        lost = dead_letters(fetched)
        failed = lost.count()
        if failed:
            failed_table(spark, root).upsert(lost.withColumn("attempts", F.col("attempts").cast("string")).withColumn("failed_at", F.current_timestamp()))
        list_pages = good_pages(fetched).join(urls, "url").select("page_no", "url", "html")
    key, value = spec.raw.lookup_key, spec.raw.primary_key
    listed = listed_records(spec, list_pages)
    hashed = listed.withColumn(value, checksum_or_computed(listed, list(spec.list_spec.hash_fields), value)).withColumn(key, strip(key))
    listed = stage(hashed.withColumn("__row", F.concat_ws("-", "page_no", "row_no")), "listed")

    raw, final = raw_table(spark, spec, root), final_table(spark, spec, root)
    raw.create()
    final.create()
    known = latest_hash(rename_legacy_key(raw.read(), key), key, value, "last_seen" if "last_seen" in spec.raw.columns else None)
    watched, counts = counted(route(listed, known, key, value), "routed", to_detail=F.col("route") == "to_detail", bypass=F.col("route") == "bypass")
    routed = stage(watched, "routed")
    seen = counts.get
    todo = routed.where("route = 'to_detail'").drop("route")
    if not seen["to_detail"]:
        return RunResult(seen["rows"], 0, seen["bypass"], 0, failed)

    if detail_pages is None and live:
        urls = todo.select(F.col(spec.input_key).alias("url"))
        detail_pages = good_pages(stage(fetch_pages(urls, policy, spec.detail_concurrency, get), "detail-pages"), "failfast")
    merged = todo if detail_pages is None else detailed_records(spec, todo, detail_pages, hop_pages)
    ordered = clean(merged, spec.final.lookup_key, spec.aliases)
    for missing in {spec.title_field, spec.detail_field} - set(ordered.columns):
        ordered = ordered.withColumn(missing, F.lit("").cast("string"))
    ordered = first_per_key(ordered, spec.final.primary_key, ["page_no", "row_no"])
    short: list[int] = []
    labelled = classify(
        stage(ordered, "clean"), spec.final.lookup_key, spec.title_field, spec.detail_field, spec.rules, spec.categories, model, spec.batch_size,
        ["page_no", "row_no"], short=lambda batches: short.append(batches.count()),
    )
    rows = stage(conform(labelled, spec.final.columns, spec.date_formats), "conformed")
    final.upsert(rows)
    times = {"last_seen": F.current_timestamp()} if "last_seen" in spec.raw.columns else {}
    stored_key = key if key in spec.raw.columns else LEGACY_KEY
    raw.upsert(with_key(routed, key).select(F.col(key).alias(stored_key), value, "page_no", "row_no"), keep=list(times), defaults=times, order=["page_no", "row_no"])
    return RunResult(seen["rows"], seen["to_detail"], seen["bypass"], rows.count(), failed, sum(short))
