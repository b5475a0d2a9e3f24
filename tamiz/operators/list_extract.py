"""List pages: one page to many records.

One Arrow-batched function turns a page into its rows of cells, each with text, mark-up and links; everything after that
(columns, short and header rows, choice of link, title) is built from JVM expressions on the exploded rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import jvm_pattern, strip
from tamiz.functions.url import url_join
from tamiz.session import spread
from tamiz.sources.html import parse, select

_ROWS = "array<struct<cells:array<struct<text:string,html:string,anchors:array<struct<href:string,text:string>>>>>>"
_CELL_OF = re.compile(r"td:nth-child\((\d+)\)")


@dataclass(frozen=True)
class ListSpec:
    """How a list page expands. ``fields``: output name to cell number (from 0), in order; the first is the key."""

    row_selector: str
    cell_selector: str
    fields: dict[str, int]
    link_column: int | None = None
    href_suffix: str = ""
    link_text: str = ""
    title_regex: str = ".*"
    domain: str = ""
    hash_fields: tuple[str, ...] = field(default=())
    hash_key: str = "checksum"


def cell_number(selector: str) -> int | None:
    """The cell that ``td:nth-child(N)`` names, from 0; None for any other selector."""
    m = _CELL_OF.match(selector)
    return int(m[1]) - 1 if m else None


def table_rows(html: Column, row_selector: str, cell_selector: str) -> Column:
    """Rows of a page that match ``row_selector`` and hold at least one ``cell_selector``, with their cells."""

    @F.pandas_udf(_ROWS)
    def rows(pages: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[dict]:
            out = []
            for row in select(parse(text), row_selector):
                cells = [
                    {"text": c.text(), "html": c.html(), "anchors": [{"href": a.attrs.get("href", ""), "text": a.text()} for a in select(c, "a")]}
                    for c in select(row, cell_selector)
                ]
                if cells:
                    out.append({"cells": cells})
            return out

        return pages.map(one)

    return rows(html)


def first_link(anchors: Column, href_suffix: str = "", link_text: str = "") -> Column:
    """The first anchor that is not excluded by the end of its address or a part of its text; NULL if there is none.

    Addresses and texts are compared in small letters, the exclusions as they are given.
    """

    def allowed(a: Column) -> Column:
        keep = F.lit(True)
        if href_suffix:
            keep = keep & ~F.lower(F.coalesce(a["href"], F.lit(""))).endswith(href_suffix)
        if link_text:
            keep = keep & ~F.lower(strip(F.coalesce(a["text"], F.lit("")))).contains(link_text)
        return keep

    return F.get(F.filter(anchors, allowed), F.lit(0))


def resolved_link(anchor: Column, domain: str) -> Column:
    """Full address of a chosen anchor; ``''`` without one. An empty address gives the domain itself."""
    return F.when(anchor.isNull(), F.lit("")).otherwise(F.coalesce(url_join(F.lit(domain), F.coalesce(anchor["href"], F.lit(""))), F.lit("")))


def title_or_fallback(source: Column, pattern: str, title: Column, key: Column) -> Column:
    """Group 1 of ``pattern`` in ``source``, stripped; where it is not found, or has no group, the title if any, else the key."""
    fallback = F.coalesce(F.nullif(title, F.lit("")), key)
    if not pattern or re.compile(pattern).groups == 0:
        return fallback
    java = jvm_pattern(pattern, ignore_case=False, dot_all=True)
    return F.when(source.rlike(java), strip(F.regexp_extract(source, java, 1))).otherwise(fallback)


def bind_cells(rows: DataFrame, cells: str, fields: dict[str, int]) -> DataFrame:
    """Rows with enough cells, each field a stripped cell text. Header rows and rows with a blank key are left out."""
    most = max(fields.values(), default=-1)
    wide = rows.where((F.size(cells) > most) & (F.size(cells) > 0))
    bound = wide.select("*", *[strip(F.get(F.col(cells), F.lit(i))["text"]).alias(name) for name, i in fields.items()])
    if not fields:
        return bound
    key = next(iter(fields))
    return bound.where((F.col(key) != "") & (F.lower(key) != key.lower()))


def extract_list(pages: DataFrame, spec: ListSpec, html: str = "html", carry: Sequence[str] = ()) -> DataFrame:
    """Records of list pages: ``carry`` columns, ``row_no`` (place on the page), the fields, ``detail_url`` and ``titulo``.

    NULL, empty and malformed pages give what rows they have, possibly none.
    """
    exploded = spread(pages.select(*carry, html)).select(*carry, F.posexplode(table_rows(F.col(html), spec.row_selector, spec.cell_selector)).alias("row_no", "row"))
    rows = bind_cells(exploded.select(*carry, "row_no", F.col("row.cells").alias("__cells")), "__cells", spec.fields)
    if spec.link_column is not None:
        cell = F.get(F.col("__cells"), F.lit(spec.link_column))
        rows = rows.withColumn("__link", first_link(cell["anchors"], spec.href_suffix, spec.link_text)).withColumn("__html", F.coalesce(cell["html"], F.lit("")))
        rows = rows.withColumn("detail_url", resolved_link(F.col("__link"), spec.domain))
        title = F.col("titulo") if "titulo" in spec.fields else F.lit("")
        key = F.col(next(iter(spec.fields))) if spec.fields else F.lit("")
        rows = rows.withColumn("titulo", title_or_fallback(F.col("__html"), spec.title_regex, title, key)).drop("__link", "__html")
    return rows.drop("__cells")
