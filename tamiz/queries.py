"""Queries of the core (all but the language-model data operators) and their SQL for an independent engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.links import link_set
from tamiz.functions.text import entity_key
from tamiz.operators.history import attribute_history
from tamiz.operators.snapshot_diff import latest_per_snapshot, snapshot_changes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Python's white space as a class of the SQL engine's regular expressions.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_key(column: str) -> str:
    """SQL of :func:`tamiz.functions.text.entity_key`."""
    return f"nullif(upper(regexp_replace({column}, '^{_WS}+|{_WS}+$', '', 'g')), '')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with its SQL where it can be expressed."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def bill_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of ``fecha_senado`` and the links of ``documentos`` of every bill in final_projects."""
    rows = table(spark, sf_dir, "final_projects")
    return attribute_history(
        rows,
        key=entity_key("no_camara"),
        at=F.col("scraped_at"),
        attributes={"fecha_senado": F.col("fecha_senado"), "links": link_set(F.col("documentos"))},
        precedence=[F.col("loaded_at"), F.col("rec_id")],
    )


_P2_SQL = f"""
WITH points AS (
  SELECT {sql_key("no_camara")} AS k, scraped_at,
         arg_max(struct_pack(f := fecha_senado, l := list_sort(list_distinct(regexp_extract_all(coalesce(documentos, ''), 'https?://[^"\\s]+')))),
                 struct_pack(a := loaded_at, b := rec_id)) AS state
  FROM final_projects WHERE {sql_key("no_camara")} IS NOT NULL AND scraped_at IS NOT NULL GROUP BY 1, 2),
marked AS (
  SELECT *, row_number() OVER w = 1 OR state IS DISTINCT FROM lag(state) OVER w AS starts FROM points
  WINDOW w AS (PARTITION BY k ORDER BY scraped_at)),
versions AS (SELECT k, scraped_at, state, row_number() OVER v AS version, lead(scraped_at) OVER v AS until FROM marked WHERE starts
  WINDOW v AS (PARTITION BY k ORDER BY scraped_at))
"""  # fmt: skip


@query("p2_found", _P2_SQL + "SELECT k AS no_camara, strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS valid_from FROM versions")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bill_history(spark, sf_dir).select(
        F.col("entity_key").alias("no_camara"), F.substring(F.col("valid_from").cast("timestamp_ntz").cast("string"), 1, 19).alias("valid_from")
    )


@query(
    "p2_history",
    _P2_SQL
    + """SELECT k AS no_camara, version, strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS valid_from,
    strftime(until, '%Y-%m-%d %H:%M:%S') AS valid_to, strftime(state.f, '%Y-%m-%d') AS fecha_senado,
    array_to_string(state.l, ' ') AS links FROM versions""",
)
def p2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = lambda c: F.substring(F.col(c).cast("timestamp_ntz").cast("string"), 1, 19).alias(c)
    return bill_history(spark, sf_dir).select(
        F.col("entity_key").alias("no_camara"), F.col("version").cast("bigint").alias("version"), second("valid_from"), second("valid_to"),
        F.col("fecha_senado").cast("string").alias("fecha_senado"), F.array_join("links", " ").alias("links"),
    )


def bill_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes between consecutive full listings of raw_projects."""
    rows = table(spark, sf_dir, "raw_projects").where(F.col("load_kind") == "snapshot")
    current = latest_per_snapshot(
        rows, F.col("load_no"), entity_key("no_camara"), F.lower("row_hash"), [F.col("last_seen"), F.col("raw_id")]
    )
    return snapshot_changes(current)


_P5_SQL = f"""
WITH latest AS (
  SELECT load_no, {sql_key("no_camara")} AS k, lower(row_hash) AS h FROM raw_projects
  WHERE load_kind = 'snapshot' AND {sql_key("no_camara")} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY load_no, {sql_key("no_camara")} ORDER BY last_seen DESC NULLS LAST, raw_id DESC) = 1),
pairs AS (SELECT load_no AS later, lag(load_no) OVER (ORDER BY load_no) AS earlier FROM (SELECT DISTINCT load_no FROM latest)),
o AS (SELECT p.later, l.k, l.h FROM latest l JOIN pairs p ON l.load_no = p.earlier),
n AS (SELECT p.later, l.k, l.h FROM latest l JOIN pairs p ON l.load_no = p.later WHERE p.earlier IS NOT NULL)
SELECT coalesce(n.later, o.later) AS load_no, coalesce(n.k, o.k) AS no_camara,
       CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM n FULL JOIN o ON n.later = o.later AND n.k = o.k
WHERE o.k IS NULL OR n.k IS NULL OR o.h IS DISTINCT FROM n.h
"""


@query("p5_found", _P5_SQL)
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bill_changes(spark, sf_dir).select(F.col("load").alias("load_no"), F.col("key").alias("no_camara"), "change")


@query("p5_counts", f"SELECT load_no, change, count(*) AS n FROM ({_P5_SQL}) GROUP BY 1, 2")
def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bill_changes(spark, sf_dir).groupBy(F.col("load").alias("load_no"), "change").agg(F.count(F.lit(1)).alias("n"))
