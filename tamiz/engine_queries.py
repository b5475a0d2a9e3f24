"""Queries of the pipeline's own operators over the test tables, with SQL for an independent engine.

List and detail pages are not among the tables; the queries on HTML build pages from whole tables, extract from them again,
and their SQL says what must come out.
"""

from __future__ import annotations

import hashlib
import json
import re
import urllib.error
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.checksum import row_checksum
from tamiz.functions.model_json import labels_of
from tamiz.functions.retry import wait_seconds
from tamiz.functions.text import after_marker, entity_key, find_all_at, search_group, strip
from tamiz.functions.url import page_urls
from tamiz.operators.classify import batch_prompts, classifier_text, classify, in_domain, numbered_batches, prompt_lines, rule_label, valid_rules, with_model_labels
from tamiz.operators.clean import clean, conform, rename_legacy_key
from tamiz.operators.delta import first_n, latest_hash, lookup_by_ids, merge_routes, new_or_changed, route, unchanged
from tamiz.operators.detail_extract import extract_detail, second_hop
from tamiz.operators.list_extract import ListSpec, extract_list, table_rows
from tamiz.operators.metrics import failure_ratio, short_answers
from tamiz.operators.store import SnapshotTable, first_per_key
from tamiz.plans.labels import CATEGORIES, RULES
from tamiz.plans.pipeline import final_table, log_table, run
from tamiz.plans.spec import PipelineSpec, load_spec
from tamiz.queries import _WS, query, sql_key, table
from tamiz.session import staged, work_path
from tamiz.sources.pages import FetchPolicy, dead_letters, fetch_in_rounds, fetch_pages, good_pages, proxies_of, usable_proxies
from tamiz.streaming.incremental import upsert_stream

_HASHED = ["no_camara", "no_senado", "proyecto", "detail_url"]


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def sql_json(fields: list[str]) -> str:
    parts = [f"""'{"{" if i == 0 else ", "}"{f}": ', to_json(coalesce({f}, ''))""" for i, f in enumerate(sorted(fields))]
    return f"concat({', '.join(parts)}, '}}')"


# --- checksums and delta -------------------------------------------------------------------------------------------------


@query("row_checksum", f"SELECT raw_id, md5({sql_json(_HASHED)}) AS checksum FROM raw_projects")
def q_row_checksum(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "raw_projects")
    return raw.select("raw_id", row_checksum(raw, _HASHED).alias("checksum"))


@query("row_checksum_customer", f"SELECT c_custkey, md5({sql_json(['c_name', 'c_mktsegment'])}) AS checksum FROM customer")
def q_row_checksum_customer(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select("c_custkey", row_checksum(c, ["c_name", "c_mktsegment"]).alias("checksum"))


def _delta_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Incoming: all snapshot rows. Known: the hash seen last of each bill in the batches."""
    raw = table(spark, sf, "raw_projects").select("raw_id", "load_kind", entity_key("no_camara").alias("k"), F.lower("row_hash").alias("h"), "last_seen").where("k IS NOT NULL")
    known = latest_hash(raw.where("load_kind = 'batch' AND h IS NOT NULL"), "k", "h", "last_seen")
    return raw.where("load_kind = 'snapshot'").select("raw_id", "k", "h"), known


_DELTA = f"""
WITH raw AS (SELECT raw_id, load_kind, {sql_key("no_camara")} AS k, lower(row_hash) AS h, last_seen FROM raw_projects WHERE {sql_key("no_camara")} IS NOT NULL),
known AS (SELECT k, h FROM raw WHERE load_kind = 'batch' AND h IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY last_seen DESC, h DESC) = 1),
inc AS (SELECT raw_id, k, h FROM raw WHERE load_kind = 'snapshot'),
routed AS (SELECT inc.*, CASE WHEN known.k IS NOT NULL AND known.h IS NOT DISTINCT FROM inc.h THEN 'bypass' ELSE 'to_detail' END AS route FROM inc LEFT JOIN known ON inc.k = known.k)
"""


@query("delta_route", _DELTA + "SELECT raw_id, k AS no_camara, route FROM routed")
def q_delta_route(spark: SparkSession, sf: str) -> DataFrame:
    inc, known = _delta_sides(spark, sf)
    return route(inc, known, "k", "h").select("raw_id", F.col("k").alias("no_camara"), "route")


@query("delta_new_or_changed", _DELTA + "SELECT raw_id FROM routed WHERE route = 'to_detail'")
def q_delta_new(spark: SparkSession, sf: str) -> DataFrame:
    inc, known = _delta_sides(spark, sf)
    return new_or_changed(inc, known, "k", "h").select("raw_id")


@query("delta_unchanged", _DELTA + "SELECT raw_id FROM routed WHERE route = 'bypass'")
def q_delta_unchanged(spark: SparkSession, sf: str) -> DataFrame:
    inc, known = _delta_sides(spark, sf)
    return unchanged(inc, known, "k", "h").select("raw_id")


@query("delta_counts", _DELTA + "SELECT route, count(*) AS n FROM routed GROUP BY 1")
def q_delta_counts(spark: SparkSession, sf: str) -> DataFrame:
    inc, known = _delta_sides(spark, sf)
    return route(inc, known, "k", "h").groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query(
    "latest_hash_per_key",
    f"""SELECT k AS no_camara, row_hash FROM (SELECT {sql_key("no_camara")} AS k, row_hash, last_seen FROM raw_projects WHERE row_hash IS NOT NULL)
    WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY last_seen DESC, row_hash DESC) = 1""",
)
def q_latest_hash(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "raw_projects").withColumn("no_camara", entity_key("no_camara")).where("no_camara IS NOT NULL AND row_hash IS NOT NULL")
    return latest_hash(raw, "no_camara", "row_hash", "last_seen")


@query("first_n_cap", "SELECT raw_id, proyecto FROM raw_projects ORDER BY last_seen, raw_id LIMIT 50")
def q_first_n(spark: SparkSession, sf: str) -> DataFrame:
    return first_n(table(spark, sf, "raw_projects"), ["last_seen", "raw_id"], 50).select("raw_id", "proyecto")


# --- fetching, with a site that exists nowhere ---------------------------------------------------------------------------

_ASKED = "asked AS (SELECT DISTINCT detail_url AS url, md5(detail_url) AS m FROM raw_projects WHERE coalesce(detail_url, '') <> '')"
_PROXIES = tuple(f"http://proxy{k}.invalid:80" for k in range(5))


def site(url: str, headers: dict[str, str], proxy: str | None, timeout: float) -> tuple[int, str]:
    """A stand-in for a site: by the address's hash a page is there, is there for some proxies only, or is gone."""
    if url == "https://check.invalid":
        return (500 if proxy == _PROXIES[0] else 200), ""
    kind = hashlib.md5(url.encode()).hexdigest()[0]
    if kind in "012" or kind in "345" and proxy is None:
        raise OSError("no answer")
    if proxy == _PROXIES[1]:
        raise urllib.error.HTTPError(url, 403, "blocked", None, None)
    return 200, f"{proxy or 'direct'} {headers['User-Agent']}"


def _fetched(spark: SparkSession, sf: str, **policy) -> DataFrame:
    urls = table(spark, sf, "raw_projects").select(F.col("detail_url").alias("url"))
    return fetch_pages(urls, FetchPolicy(attempts=1, **policy), spark.sparkContext.defaultParallelism, site)


@query("failure_ratio", f"WITH {_ASKED} SELECT count(*) AS pages, count(*) FILTER (m[1] <= '5') AS failed, coalesce(avg(CASE WHEN m[1] <= '5' THEN 1.0 ELSE 0.0 END), 0.0) AS ratio FROM asked")
def q_failure_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return failure_ratio(_fetched(spark, sf))


@query("dead_letter_pages", f"WITH {_ASKED} SELECT url, 1 AS attempts FROM asked WHERE m[1] <= '5'")
def q_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    return dead_letters(_fetched(spark, sf)).select("url", "attempts")


@query("fetched_pages", f"WITH {_ASKED} SELECT url, 'direct a' || (('0x' || substr(md5(url || '|1'), 1, 8))::BIGINT % 3) AS html FROM asked WHERE m[1] > '5'")
def q_fetched(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that are there, asked for under one of three names."""
    return good_pages(_fetched(spark, sf, agents=("a0", "a1", "a2"))).select("url", "html")


@query(
    "proxied_pages",
    f"""WITH {_ASKED}, p AS (SELECT unnest(['{"', '".join(_PROXIES[2:])}']) AS proxy),
    first AS (SELECT url, proxy FROM asked, p WHERE m[1] BETWEEN '3' AND '5' QUALIFY row_number() OVER (PARTITION BY url ORDER BY md5(url || '|' || proxy)) = 1)
    SELECT url, split_part(proxy, '//', 2) AS proxy FROM first""",
)
def q_proxied(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that only a proxy gets: proxies in an order of their own for each page, without those that fail their check or are blocked."""
    pages = good_pages(_fetched(spark, sf, proxies=_PROXIES, check_url="https://check.invalid"))
    return pages.where("html NOT LIKE 'direct%'").select("url", F.regexp_extract("html", "//(\\S+)", 1).alias("proxy"))


@query(
    "requeued_pages",
    f"WITH {_ASKED} SELECT url, m[1] > '2' AS fetched FROM asked",
)
def q_requeued(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that fail are asked for again behind the others, now by proxy."""
    urls = table(spark, sf, "raw_projects").select(F.col("detail_url").alias("url"))
    policy = FetchPolicy(attempts=1, proxies=_PROXIES[2:])
    return fetch_in_rounds(urls, policy, spark.sparkContext.defaultParallelism, 2, staged, site).select("url", F.col("html").isNotNull().alias("fetched"))


@query(
    "proxy_table_scan",
    """SELECT s_suppkey, 'http://' || s_nationkey || '.0.0.1:' || s_suppkey AS proxy FROM supplier WHERE s_acctbal > 0""",
)
def q_proxy_table(spark: SparkSession, sf: str) -> DataFrame:
    """The proxies for https of a page's table; here a page for each supplier, with a row of too few cells."""
    html = F.concat(
        F.lit("<table id=other><tr><td>x</table><table id=proxylisttable><tr><th>IP<tr><td>short<tr><td>"), F.col("s_nationkey").cast("string"), F.lit(".0.0.1<td>"),
        F.col("s_suppkey").cast("string"), F.lit("<td>a<td>b<td>c<td>d<td>"), F.when(F.col("s_acctbal") > 0, " Yes ").otherwise("no"), F.lit("</table>"),
    )
    return table(spark, sf, "supplier").select("s_suppkey", F.explode(proxies_of(html)).alias("proxy"))


@query("page_list_urls", "SELECT i AS page_no, CASE WHEN i = 0 THEN 'https://portal.invalid/list' ELSE 'https://portal.invalid/list?page=' || i END AS url FROM range(100) t(i)")
def q_page_urls(spark: SparkSession, sf: str) -> DataFrame:
    return page_urls(spark, "https://portal.invalid/list", 100)


@query("retry_schedule", "SELECT i AS attempt, least(1.0 * pow(2, i - 1), 30.0) AS wait FROM range(1, 11) t(i)")
def q_retry(spark: SparkSession, sf: str) -> DataFrame:
    return spark.range(1, 11).select(F.col("id").alias("attempt"), wait_seconds(F.col("id")).alias("wait"))


# --- classification ------------------------------------------------------------------------------------------------------

_CASE = "CASE " + " ".join(f"WHEN regexp_matches(t, '{p.removeprefix('(?i)')}', 'i') THEN '{c}'" for p, c in RULES) + " ELSE '' END"
_TEXT = "concat(coalesce(titulo, ''), ' ', coalesce(objeto, ''))"
_DOMAIN = ", ".join(f"'{c}'" for c in CATEGORIES)


def _ruled(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "final_projects")
    return rows.withColumn("label", rule_label(classifier_text(F.col("titulo"), F.col("objeto")), RULES))


@query("rule_sector", f"SELECT rec_id, CASE WHEN l IN ({_DOMAIN}) THEN l ELSE 'otros' END AS sector FROM (SELECT rec_id, {_CASE} AS l FROM (SELECT rec_id, {_TEXT} AS t FROM final_projects))")
def q_rule_sector(spark: SparkSession, sf: str) -> DataFrame:
    return _ruled(spark, sf).select("rec_id", in_domain(F.col("label"), CATEGORIES).alias("sector"))


@query("rule_sector_peru", f"SELECT pe_id, {_CASE} AS label FROM (SELECT pe_id, concat(coalesce(titulo, ''), ' ', coalesce(sumilla, '')) AS t FROM peru_projects)")
def q_rule_sector_peru(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "peru_projects")
    return rows.select("pe_id", rule_label(classifier_text(F.col("titulo"), F.col("sumilla")), RULES).alias("label"))


_PENDING = f"""
WITH pending AS (SELECT rec_id, no_camara, titulo, objeto, row_number() OVER (ORDER BY rec_id) - 1 AS place
  FROM (SELECT *, {_TEXT} AS t FROM final_projects) WHERE {_CASE} = '')
"""


@query("rule_unresolved_batches", _PENDING + "SELECT rec_id, place, place // 20 AS batch FROM pending")
def q_batches(spark: SparkSession, sf: str) -> DataFrame:
    pending = _ruled(spark, sf).where("label = ''").select("rec_id", "no_camara", "titulo", "objeto")
    return numbered_batches(pending, ["rec_id"], 20).select("rec_id", "place", "batch")


_LINE = "concat(coalesce(no_camara, ''), ': ', coalesce(titulo, ''), ' -- ', coalesce(objeto, ''))"


@query("prompt_lines", _PENDING + f"SELECT place // 20 AS batch, string_agg({_LINE}, chr(10) ORDER BY place) AS prompt FROM pending GROUP BY 1")
def q_prompts(spark: SparkSession, sf: str) -> DataFrame:
    pending = _ruled(spark, sf).where("label = ''").select("rec_id", "no_camara", "titulo", "objeto")
    return batch_prompts(numbered_batches(pending, ["rec_id"], 20), prompt_lines(F.col("no_camara"), F.col("titulo"), F.col("objeto")))


_LABELS = r"""
WITH listed AS (SELECT response_id, received_at, CASE WHEN regexp_matches(response_text, '^\s*\[') AND json_valid(response_text) THEN json_extract(response_text, '$[*]') END AS l FROM model_responses),
items AS (SELECT response_id, received_at, unnest(l) AS e, generate_subscripts(l, 1) AS place FROM listed WHERE l IS NOT NULL),
pairs AS (SELECT response_id, received_at, place, json_extract_string(e, '$.id') AS id, json_extract_string(e, '$.label') AS label FROM items),
good AS (SELECT * FROM pairs WHERE coalesce(id, '') <> '' AND coalesce(label, '') <> ''
  QUALIFY row_number() OVER (PARTITION BY response_id, id ORDER BY place DESC) = 1)
"""


@query("parse_model_json", _LABELS + "SELECT response_id, id, label FROM good")
def q_parse_json(spark: SparkSession, sf: str) -> DataFrame:
    return labels_of(table(spark, sf, "model_responses"), "response_text", ["response_id"])


@query(
    "model_label_fallback",
    _LABELS
    + f"""SELECT f.rec_id, coalesce(g.label, 'otros') AS sector FROM final_projects f LEFT JOIN good g ON {sql_key("f.no_camara")} = g.id AND g.response_id = f.rec_id % 50""",
)
def q_label_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of the answer to a record's own batch, here the answers taken in turn."""
    labels = labels_of(table(spark, sf, "model_responses").select(F.col("response_id").alias("batch"), "response_text"), "response_text", ["batch"])
    rows = table(spark, sf, "final_projects").select("rec_id", entity_key("no_camara").alias("k"), (F.col("rec_id") % 50).alias("batch"))
    return with_model_labels(rows, labels, "k").select("rec_id", "sector")


@query(
    "response_cardinality",
    _PENDING + ", " + _LABELS.strip().removeprefix("WITH ")
    + """, asked AS (SELECT place // 20 AS batch, count(*) AS asked FROM pending GROUP BY 1), answered AS (SELECT response_id AS batch, count(*) AS answered FROM good GROUP BY 1)
    SELECT batch, asked, coalesce(answered, 0) AS answered FROM asked LEFT JOIN answered USING (batch) WHERE asked <> coalesce(answered, 0)""",
)
def q_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    """Batches whose answer does not hold as many labels as records were asked for."""
    pending = _ruled(spark, sf).where("label = ''").select("rec_id")
    labels = labels_of(table(spark, sf, "model_responses").select(F.col("response_id").alias("batch"), "response_text"), "response_text", ["batch"])
    return short_answers(numbered_batches(pending, ["rec_id"], 20), labels)


def answer(prompt: str) -> str:
    """A stand-in for a model: labels by the last figure of the record's number, some strange or missing; some batches fail."""
    ids = re.findall(r"(?m)^#(\d+): ", prompt)
    if int(ids[0]) % 5 == 0:
        raise OSError("no answer")
    return json.dumps([{"id": f"#{i}", "label": CATEGORIES[int(i[-1])] if i[-1] < "5" else "strange"} for i in ids if i[-1] != "9"])


@query(
    "model_classifier",
    _PENDING + f"""SELECT f.rec_id, CASE WHEN p.rec_id IS NULL THEN CASE WHEN {_CASE} IN ({_DOMAIN}) THEN {_CASE} ELSE 'otros' END
      WHEN p.lead % 5 <> 0 AND f.rec_id % 10 < 5 THEN (['{"', '".join(CATEGORIES[:5])}'])[f.rec_id % 10 + 1] ELSE 'otros' END AS sector
    FROM (SELECT *, {_TEXT} AS t FROM final_projects) f LEFT JOIN (SELECT rec_id, min(rec_id) OVER (PARTITION BY place // 20) AS lead FROM pending) p ON f.rec_id = p.rec_id""",
)
def q_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Rules first, then a model in batches of twenty, then the closed list."""
    rows = table(spark, sf, "final_projects").select(F.concat(F.lit("#"), F.col("rec_id").cast("string")).alias("id"), "rec_id", "titulo", "objeto")
    labelled = classify(rows, "id", "titulo", "objeto", RULES, CATEGORIES, answer, 20, ["rec_id"])
    return labelled.select("rec_id", "sector")


_BROKEN = [{"pattern": "(", "category": "roto"}, {"pattern": "ley"}, {"category": "salud"}, {}, *[{"pattern": p, "category": c} for p, c in RULES]]


@query("malformed_rules", f"SELECT pe_id, {_CASE} AS label FROM (SELECT pe_id, coalesce(titulo_detalle, '') AS t FROM peru_projects)")
def q_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Rules without a pattern or a category, or with a broken pattern, are left out."""
    return table(spark, sf, "peru_projects").select("pe_id", rule_label(classifier_text(F.col("titulo_detalle")), valid_rules(_BROKEN)).alias("label"))


# --- cleaning, conformance, storage --------------------------------------------------------------------------------------


@query("clean_key_filter", f"SELECT rec_id, {sql_strip('no_camara')} AS no_camara, strftime(fecha_camara, '%Y-%m-%d') AS fecha_cam, nullif(observaciones, '') AS fecha_sen FROM final_projects WHERE {sql_strip('no_camara')} <> ''")
def q_clean(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = clean(table(spark, sf, "final_projects"), "no_camara", {"fecha_cam": "fecha_camara", "fecha_sen": "observaciones"})
    return cleaned.select("rec_id", "no_camara", "fecha_cam", "fecha_sen")


_FINAL = {"no_camara": "TEXT", "titulo": "TEXT", "fecha_cam": "DATE", "objeto": "TEXT", "observaciones": "TEXT", "documentos": "JSONB", "sector": "TEXT", "row_hash": "TEXT"}


def _null_blank(c: str) -> str:
    return f"CASE WHEN {sql_strip(c)} <> '' THEN {c} END AS {c}"


@query(
    "conform_nulls_json",
    f"SELECT rec_id, {', '.join(_null_blank(c) for c in ('no_camara', 'titulo', 'objeto', 'observaciones', 'sector', 'row_hash'))}, CAST(NULL AS DATE) AS fecha_cam, "
    f"CASE WHEN {sql_strip('documentos')} <> '' THEN documentos ELSE '[]' END AS documentos FROM final_projects",
)
def q_conform(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "final_projects").withColumn("id", F.col("rec_id").cast("string"))
    return conform(rows, {"id": "TEXT"} | _FINAL).withColumn("rec_id", F.col("id").cast("bigint")).drop("id")


_RAW_COLUMNS = {"no_camara": "TEXT", "row_hash": "TEXT NOT NULL", "last_seen": "TIMESTAMP NOT NULL DEFAULT NOW()"}


@query(
    "raw_upsert",
    """WITH r AS (SELECT raw_id, load_kind, no_camara, row_hash, last_seen FROM raw_projects WHERE coalesce(row_hash, '') <> ''),
    t AS (SELECT * FROM r WHERE load_kind = 'snapshot' QUALIFY row_number() OVER (PARTITION BY row_hash ORDER BY raw_id) = 1),
    b AS (SELECT * FROM r WHERE load_kind = 'batch' QUALIFY row_number() OVER (PARTITION BY row_hash ORDER BY raw_id) = 1)
    SELECT coalesce(b.row_hash, t.row_hash) AS row_hash, CASE WHEN b.row_hash IS NOT NULL THEN b.no_camara ELSE t.no_camara END AS no_camara,
    CASE WHEN t.row_hash IS NOT NULL THEN t.last_seen ELSE TIMESTAMP '2025-01-01' END AS last_seen FROM t FULL JOIN b ON t.row_hash = b.row_hash""",
)
def q_raw_upsert(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "raw_projects")
    first = lambda kind: first_per_key(raw.where(F.col("load_kind") == kind), "row_hash", ["raw_id"])
    stored = SnapshotTable(spark, work_path(spark, "raw-table"), _RAW_COLUMNS, "row_hash")
    stored.upsert(first("snapshot").select("no_camara", "row_hash", F.col("last_seen").cast("timestamp").alias("last_seen")))
    stored.upsert(first("batch").select("no_camara", "row_hash"), keep=["last_seen"], defaults={"last_seen": F.lit("2025-01-01 00:00:00").cast("timestamp")})
    return stored.read().withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))


@query(
    "final_upsert",
    """WITH t AS (SELECT * FROM final_projects WHERE loaded_at < TIMESTAMP '2021-01-01' AND row_hash IS NOT NULL QUALIFY row_number() OVER (PARTITION BY row_hash ORDER BY rec_id) = 1),
    b AS (SELECT * FROM final_projects WHERE loaded_at >= TIMESTAMP '2021-01-01' AND row_hash IS NOT NULL QUALIFY row_number() OVER (PARTITION BY row_hash ORDER BY rec_id) = 1)
    SELECT coalesce(b.row_hash, t.row_hash) AS row_hash, CASE WHEN b.row_hash IS NOT NULL THEN b.rec_id ELSE t.rec_id END AS rec_id,
    CASE WHEN b.row_hash IS NOT NULL THEN b.titulo ELSE t.titulo END AS titulo, CASE WHEN b.row_hash IS NOT NULL THEN b.objeto ELSE t.objeto END AS objeto
    FROM t FULL JOIN b ON t.row_hash = b.row_hash""",
)
def q_final_upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "final_projects").where("row_hash IS NOT NULL")
    cut = F.lit("2021-01-01 00:00:00").cast("timestamp_ntz")
    stored = SnapshotTable(spark, work_path(spark, "final-table"), {"row_hash": "TEXT NOT NULL", "rec_id": "TEXT", "titulo": "TEXT", "objeto": "TEXT"}, "row_hash")
    for when in (F.col("loaded_at") < cut, F.col("loaded_at") >= cut):
        stored.upsert(first_per_key(rows.where(when), "row_hash", ["rec_id"]).withColumn("rec_id", F.col("rec_id").cast("string")))
    return stored.read().withColumn("rec_id", F.col("rec_id").cast("bigint"))


@query("lookup_by_ids", "SELECT rec_id, no_camara, sector FROM final_projects WHERE rec_id IN (SELECT rec_id FROM subject_labels)")
def q_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return lookup_by_ids(table(spark, sf, "final_projects"), table(spark, sf, "subject_labels"), "rec_id").select("rec_id", "no_camara", "sector")


@query("merge_detail_bypass", _DELTA + "SELECT raw_id, CASE WHEN route = 'to_detail' THEN k END AS detail FROM routed")
def q_merge(spark: SparkSession, sf: str) -> DataFrame:
    inc, known = _delta_sides(spark, sf)
    return merge_routes(new_or_changed(inc, known, "k", "h").select("raw_id", F.col("k").alias("detail")), unchanged(inc, known, "k", "h").select("raw_id"))


@query("incremental_stream", "SELECT no_camara, row_hash FROM raw_projects WHERE coalesce(row_hash, '') <> '' QUALIFY row_number() OVER (PARTITION BY row_hash ORDER BY raw_id) = 1")
def q_stream(spark: SparkSession, sf: str) -> DataFrame:
    source = table(spark, sf, "raw_projects")
    stored = SnapshotTable(spark, work_path(spark, "stream-table"), {"no_camara": "TEXT", "row_hash": "TEXT"}, "row_hash")
    stored.create()
    stream = spark.readStream.schema(source.schema).parquet(f"{sf}/raw_projects.parq*")
    run = upsert_stream(stream, stored, work_path(spark, "stream-state"), order=["raw_id"])
    run.awaitTermination()
    return stored.read()


@query("legacy_key_table", "SELECT raw_id, no_camara AS numero FROM raw_projects")
def q_legacy(spark: SparkSession, sf: str) -> DataFrame:
    """A table that was laid out when its key was still named as in other tables."""
    return rename_legacy_key(table(spark, sf, "raw_projects"), "numero").select("raw_id", "numero")


@query("proxy_pool", """SELECT s_name AS proxy FROM supplier WHERE s_acctbal > 0 AND s_name NOT IN (SELECT s_name FROM supplier WHERE s_nationkey % 5 = 0) ORDER BY s_suppkey LIMIT 50""")
def q_proxies(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    pool = s.select("s_suppkey", F.col("s_name").alias("proxy"), F.when(F.col("s_acctbal") > 0, " Yes ").otherwise("no").alias("https"))
    return usable_proxies(pool, s.where("s_nationkey % 5 = 0").select(F.col("s_name").alias("proxy")), "s_suppkey", 50).select("proxy")


# --- list pages built from raw_projects -----------------------------------------------------------------------------------


def escaped(c: Column) -> Column:
    """A value as HTML text; characters that XHTML cannot hold are left out."""
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f\r]", "")
    return F.replace(F.replace(F.replace(plain, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))


def list_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One small listing for each row: a header row, a short row, and the row itself with unclosed cells and three links."""
    raw = table(spark, sf, "raw_projects")
    html = F.concat(
        F.lit("<html><body><table><tr><th>x</th></tr><tr><td>No_Camara<td>s<td>p<td>t</tr><tr><td>short</td></tr><tr><td>&nbsp;"), escaped(F.col("no_camara")),
        F.lit("&nbsp;<td>"), escaped(F.col("no_senado")), F.lit('<td><a href="/f.PDF">PDF</a><a href="/v">Ver Documento</a><a href="/p/'), F.col("raw_id").cast("string"),
        F.lit('">'), escaped(F.col("proyecto")), F.lit("</a><br>Título: “"), escaped(F.col("proyecto")), F.lit("”<td>Ley</table></body></html>"),
    )
    return raw.select("raw_id", html.alias("html"))


LIST = ListSpec("tr", "td", {"no_camara": 0, "no_senado": 1, "proyecto": 2, "tipo": 3}, link_column=2, href_suffix=".pdf", link_text="ver documento", title_regex="Título:\\s*“(.+?)”", domain="https://portal.invalid")
_CLEAN = lambda c: f"regexp_replace(coalesce({c}, ''), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\r]', '', 'g')"

#: The title is looked for in the cell's mark-up, where signs stay escaped.
_MARKED = f"replace(replace(replace({_CLEAN('proyecto')}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(
    "list_first_link",
    f"""SELECT raw_id, {sql_strip(_CLEAN("no_camara"))} AS no_camara, {sql_strip(_CLEAN("no_senado"))} AS no_senado, 'https://portal.invalid/p/' || raw_id AS detail_url, 'Ley' AS tipo
    FROM raw_projects WHERE {sql_strip(_CLEAN("no_camara"))} <> ''""",
)
def q_list_link(spark: SparkSession, sf: str) -> DataFrame:
    return extract_list(list_pages(spark, sf), LIST, carry=["raw_id"]).select("raw_id", "no_camara", "no_senado", "detail_url", "tipo")


@query(
    "title_or_fallback",
    f"""SELECT raw_id, CASE WHEN {_CLEAN("proyecto")} = '' THEN {sql_strip(_CLEAN("no_camara"))} ELSE {sql_strip("regexp_extract(" + _MARKED + " || '”', '(?s)^(.+?)”', 1)")} END AS titulo
    FROM raw_projects WHERE {sql_strip(_CLEAN("no_camara"))} <> ''""",
)
def q_title(spark: SparkSession, sf: str) -> DataFrame:
    return extract_list(list_pages(spark, sf), LIST, carry=["raw_id"]).select("raw_id", "titulo")


@query("list_header_short_rows", f"SELECT raw_id, 3 AS rows_on_page, CASE WHEN {sql_strip(_CLEAN('no_camara'))} <> '' THEN 1 ELSE 0 END AS records FROM raw_projects")
def q_header_rows(spark: SparkSession, sf: str) -> DataFrame:
    pages = list_pages(spark, sf)
    found = extract_list(pages, LIST, carry=["raw_id"]).groupBy("raw_id").agg(F.count(F.lit(1)).alias("n"))
    rows = pages.select("raw_id", F.size(table_rows(F.col("html"), "tr", "td")).alias("rows_on_page"))
    return rows.join(found, "raw_id", "left").select("raw_id", "rows_on_page", F.coalesce("n", F.lit(0)).alias("records"))


@query("list_anchors", "SELECT raw_id, unnest(['/f.PDF', '/v', '/p/' || raw_id]) AS href FROM raw_projects")
def q_anchors(spark: SparkSession, sf: str) -> DataFrame:
    rows = list_pages(spark, sf).select("raw_id", F.explode(table_rows(F.col("html"), "tr", "td")).alias("row"))
    return rows.select("raw_id", F.explode(F.flatten(F.col("row.cells.anchors"))).alias("a")).select("raw_id", F.col("a.href").alias("href"))


# --- detail pages built from final_projects --------------------------------------------------------------------------------

#: Fields of the pages below; their paths and patterns are fixed values of what such pages declare.
DETAIL = {
    "titulo_detalle": {"xpath": "//h1/text()"},
    "sumilla": {"xpath": "//input[@name='SumIni']/@value"},
    "presentado": {"xpath": "//input[@name='FecPres']/@value", "regex": "([0-9]{2}/[0-9]{2}/[0-9]{4})"},
    "documentos": {"xpath": "//a[contains(translate(text(),'VER DOCUMENTO','ver documento'),'ver documento') or contains(@href,'.pdf')]", "attr": "href", "label_attr": "text", "multiple": True},
    "archivos": {"xpath": "//a[contains(@href,'.pdf')]/@href", "multiple": True},
    "textos": {"xpath": "//ul/li/a[contains(@href,'.pdf')]", "multiple": True},
    "enlaces": {"xpath": "//li[not(a='Ver  Expediente Digital')]/a[@href]", "attr": "href", "label_attr": "title", "multiple": True},
    "fecha_camara": {"find_all": True, "regex": "([0-9]{4}-[0-9]{2}-[0-9]{2})", "index": 0},
    "fecha_senado": {"find_all": True, "regex": "([0-9]{4}-[0-9]{2}-[0-9]{2})", "index": 1},
    "objeto": {"regex": r"Objeto de proyecto:\s*(.*?)Observaciones:"},
    "observaciones": {"block_after": "Observaciones:", "regex": r"\s*(.*?)(?:\n\n|$)"},
    "nada": {"unknown": True},
    "expediente_url": {"xpath": "//a[contains(normalize-space(.),'Ver Expediente Digital')]/@href"},
}


def detail_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page of mark-up with unclosed elements for each row of final_projects."""
    rows = table(spark, sf, "final_projects")
    iso = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    html = F.concat(
        F.lit("<html><body><h1>"), escaped(F.col("no_camara")), F.lit('</h1><p>Radicado <b>'), iso("fecha_camara"), F.lit("<br>"), iso("fecha_senado"),
        F.lit('</b><form><input name="SumIni" value="'), escaped(F.col("titulo")), F.lit('"><input name="FecPres" value="el 05/06/2024 a las 3"></form>'),
        F.lit("<div>Objeto de proyecto: "), escaped(F.col("objeto")), F.lit("\nObservaciones: "), escaped(F.when(F.coalesce(strip(F.col("observaciones")), F.lit("")) == "", "ninguna").otherwise(F.col("observaciones"))), F.lit("\n\nfin</div>"),
        F.lit('<ul><li><a href="/d/'), F.col("rec_id").cast("string"), F.lit('.pdf">Texto</a><li><a href="/v/1">VER DOCUMENTO</a><li><a href="/d/'), F.col("rec_id").cast("string"),
        F.lit('.pdf">Otra vez</a><li><a href="x/'), (F.col("rec_id") % 7).cast("string"), F.lit('">Ver  Expediente Digital</a></ul></body></html>'),
    )
    return rows.select("rec_id", html.alias("html"))


def _detail(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    return extract_detail(detail_pages(spark, sf), {n: DETAIL[n] for n in names}, "https://portal.invalid", carry=["rec_id"])


@query("detail_xpath_scalar", f"SELECT rec_id, {sql_strip(_CLEAN('no_camara'))} AS titulo_detalle, {sql_strip(_CLEAN('titulo'))} AS sumilla, '05/06/2024' AS presentado, CAST(NULL AS VARCHAR) AS nada FROM final_projects")
def q_xpath_scalar(spark: SparkSession, sf: str) -> DataFrame:
    return _detail(spark, sf, "titulo_detalle", "sumilla", "presentado", "nada")


@query(
    "detail_xpath_multi",
    """SELECT rec_id, '[{"label":"Texto","url":"https://portal.invalid/d/' || rec_id || '.pdf"},{"label":"VER DOCUMENTO","url":"https://portal.invalid/v/1"}]' AS documentos,
    '/d/' || rec_id || '.pdf /d/' || rec_id || '.pdf' AS archivos FROM final_projects""",
)
def q_xpath_multi(spark: SparkSession, sf: str) -> DataFrame:
    return _detail(spark, sf, "documentos", "archivos").select("rec_id", F.to_json("documentos").alias("documentos"), F.array_join("archivos", " ").alias("archivos"))


@query("detail_element_texts", "SELECT rec_id, 'Texto|Otra vez' AS textos, '/d/' || rec_id || '.pdf|/v/1' AS enlaces FROM final_projects")
def q_element_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of elements, and links labelled by an attribute they lack; the first of a list with a second after it."""
    rows = _detail(spark, sf, "textos", "enlaces")
    return rows.select("rec_id", F.array_join("textos", "|").alias("textos"), F.array_join(F.transform("enlaces", lambda e: e["label"]), "|").alias("enlaces"))


@query(
    "detail_find_all_index",
    """SELECT rec_id, coalesce(strftime(fecha_camara, '%Y-%m-%d'), strftime(fecha_senado, '%Y-%m-%d'), '') AS fecha_camara,
    CASE WHEN fecha_camara IS NOT NULL THEN coalesce(strftime(fecha_senado, '%Y-%m-%d'), '') ELSE '' END AS fecha_senado FROM final_projects""",
)
def q_find_all(spark: SparkSession, sf: str) -> DataFrame:
    return _detail(spark, sf, "fecha_camara", "fecha_senado")


@query("detail_regex", f"SELECT rec_id, {sql_strip(_CLEAN('objeto'))} AS objeto, CASE WHEN {sql_strip(_CLEAN('observaciones'))} = '' THEN 'ninguna' ELSE {sql_strip(_CLEAN('observaciones'))} END AS observaciones FROM final_projects")
def q_detail_regex(spark: SparkSession, sf: str) -> DataFrame:
    return _detail(spark, sf, "objeto", "observaciones")


@query(
    "detail_block_after",
    f"""SELECT doc_id, {sql_strip("CASE WHEN strpos(text, 'Ley ') > 0 THEN substr(text, strpos(text, 'Ley ') + 4) ELSE text END")} AS after,
    {sql_strip("regexp_extract(CASE WHEN strpos(text, 'Ley ') > 0 THEN substr(text, strpos(text, 'Ley ') + 4) ELSE text END, '([0-9]+) de ([0-9]{4})', 1)")} AS number FROM documents WHERE text IS NOT NULL""",
)
def q_block_after(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where("text IS NOT NULL")
    block = after_marker(F.col("text"), "Ley ")
    return docs.select("doc_id", strip(block).alias("after"), search_group(block, "([0-9]+) de (?:[0-9]{4})").alias("number"))


@query("find_all_years", "SELECT doc_id, coalesce(regexp_extract_all(text, '[0-9]{4}')[3], '') AS third FROM documents")
def q_years(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", find_all_at(F.col("text"), "[0-9]{4}", 2).alias("third"))


@query(
    "second_hop_docs",
    """SELECT rec_id, CASE WHEN rec_id % 7 IN (1, 2, 3) THEN 'https://portal.invalid/x/a' || rec_id % 7 || '.PDF https://portal.invalid/x/b.pdf' ELSE '' END AS archivos FROM final_projects""",
)
def q_second_hop(spark: SparkSession, sf: str) -> DataFrame:
    records = _detail(spark, sf, "expediente_url").withColumn("documentos", F.array().cast("array<string>"))
    n = F.col("id").cast("string")
    html = F.concat(F.lit('<a href="a'), n, F.lit('.PDF">1</a><a href="">2</a><a href="b.pdf">3</a><a href="c.doc">4</a>'))
    pages = spark.range(1, 4).select(F.concat(F.lit("https://portal.invalid/x/"), n).alias("url"), html.alias("html"))
    return second_hop(records, pages, "http://portal.invalid").select("rec_id", F.array_join("documentos", " ").alias("archivos"))


# --- a whole run ----------------------------------------------------------------------------------------------------------

_EXAMPLE = Path(__file__).parent / "plans" / "example.yml"
_P, _TITLE = _CLEAN("proyecto"), sql_strip("regexp_extract(" + _MARKED + " || '”', '(?s)^(.+?)”', 1)")


_LISTED = f"""WITH r AS (SELECT raw_id, {sql_strip(_CLEAN("no_camara"))} AS no_camara, {sql_strip(_CLEAN("no_senado"))} AS no_senado, {_P} AS p,
      {sql_strip(f"concat('PDFVer Documento', {_P}, 'Título: “', {_P}, '”')")} AS proyecto, 'https://portal.invalid/p/' || raw_id AS detail_url,
      CASE WHEN {_P} = '' THEN {sql_strip(_CLEAN("no_camara"))} ELSE {_TITLE} END AS titulo, {sql_strip(_P)} AS objeto FROM raw_projects),
    h AS (SELECT *, md5({sql_json(["no_camara", "no_senado", "proyecto", "detail_url"])}) AS row_hash, concat(titulo, ' ', objeto) AS t FROM r WHERE no_camara <> '')
"""


@query(
    "pipeline_run",
    _LISTED + f"""SELECT no_camara, CASE WHEN {sql_strip("no_senado")} <> '' THEN no_senado END AS no_senado, CASE WHEN {sql_strip("titulo")} <> '' THEN titulo END AS titulo,
      CASE WHEN {sql_strip("objeto")} <> '' THEN objeto END AS objeto, '[{{"label":"Texto","url":"https://portal.invalid/d/' || raw_id || '.pdf"}}]' AS documentos,
      CASE WHEN {_CASE} = '' THEN 'otros' ELSE {_CASE} END AS sector, row_hash FROM h""",
)
def q_run(spark: SparkSession, sf: str) -> DataFrame:
    """List pages, delta against an empty store, detail pages, rules, conformance and upsert of all raw_projects rows."""
    spec, root, pages = _run_inputs(spark, sf)
    run(spark, spec, root, *pages)
    return final_table(spark, spec, root).read()


def _run_inputs(spark: SparkSession, sf: str) -> tuple[PipelineSpec, str, tuple[DataFrame, DataFrame]]:
    spec = load_spec(str(_EXAMPLE), first_n=None, rules=tuple(RULES), categories=tuple(CATEGORIES))
    listing = list_pages(spark, sf).withColumnRenamed("raw_id", "page_no")
    n = F.col("raw_id").cast("string")
    html = F.concat(F.lit("<p>Objeto de proyecto: "), escaped(F.col("proyecto")), F.lit('<p>Observaciones: ninguna<a href="/d/'), n, F.lit('.pdf">Texto</a>'))
    detail = table(spark, sf, "raw_projects").select(F.concat(F.lit("https://portal.invalid/p/"), n).alias("url"), html.alias("html"))
    return spec, work_path(spark, "pipeline"), (listing, detail)


@query("second_run_counts", _LISTED + "SELECT count(*) AS listed, count(*) FILTER (row_hash <> k) AS to_detail, count(*) FILTER (row_hash = k) AS bypass FROM (SELECT row_hash, max(row_hash) OVER (PARTITION BY no_camara) AS k FROM h)")
def q_second_run(spark: SparkSession, sf: str) -> DataFrame:
    """A run over the pages of the run before: what is stored as it is goes by; of several readings of a bill one is stored last."""
    spec, root, pages = _run_inputs(spark, sf)
    run(spark, spec, root, *pages)
    again = run(spark, spec, root, *pages)
    return spark.createDataFrame([(again.listed, again.to_detail, again.bypass)], "listed bigint, to_detail bigint, bypass bigint")


@query("run_log_counts", _LISTED + "SELECT count(*) AS listed, count(*) AS to_detail, 0 AS bypass, count(DISTINCT row_hash) AS stored, 0 AS failed_pages FROM h")
def q_run_log(spark: SparkSession, sf: str) -> DataFrame:
    """The counts that a run leaves in its log."""
    spec, root, pages = _run_inputs(spark, sf)
    run(spark, spec, root, *pages)
    kept = ["listed", "to_detail", "bypass", "stored", "failed_pages"]
    return log_table(spark, root).read().select(*[F.get_json_object("counts", f"$.{k}").cast("bigint").alias(k) for k in kept])
