"""Detail pages: one page to one record, by a declared extraction for each field.

A page is parsed once, which gives its XHTML, its text and its declared lists of elements; scalar fields are then native
``xpath*`` and regular expressions. Only lists of elements need a function of their own, since native XPath gives no
attributes and texts of the same element together.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from typing import Any
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.text import after_marker, find_all_at, search_group, strip
from tamiz.functions.url import force_https, url_join
from tamiz.session import spread
from tamiz.sources.html import Node, parse
from tamiz.sources.paths import compiled, elements

_LINKS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("url", T.StringType())]))


def page_forms(fields: Mapping[str, Mapping[str, Any]], domain: str) -> Callable[[Column], Column]:
    """Of each page, parsed once: well-formed XHTML, all text, and the declared lists of elements. NULL and empty pages give
    an empty root."""
    lists = {n: how for n, how in fields.items() if _lists_elements(how)}
    for how in lists.values():
        compiled(how["xpath"])
    schema = [T.StructField("xhtml", T.StringType()), T.StructField("text", T.StringType())]
    schema += [T.StructField(f"f{i}", _LINKS if how.get("attr") else T.ArrayType(T.StringType())) for i, how in enumerate(lists.values())]

    @F.pandas_udf(T.StructType(schema))
    def forms(pages: pd.Series) -> pd.DataFrame:
        roots = [parse(t) for t in pages]
        out: dict[str, list] = {"xhtml": [r.html() for r in roots], "text": [r.text() for r in roots]}
        for i, how in enumerate(lists.values()):
            if how.get("attr"):
                out[f"f{i}"] = [links_of(r, how["xpath"], how["attr"], domain, how.get("label_attr"), how.get("regex")) for r in roots]
            else:
                out[f"f{i}"] = [[n.text().strip() for n in elements(r, how["xpath"])] for r in roots]
        return pd.DataFrame(out, dtype=object)

    return forms


def _lists_elements(how: Mapping[str, Any]) -> bool:
    return bool(how.get("xpath") and how.get("multiple") and _node_path(how["xpath"]))


def _node_path(path: str) -> bool:
    """True for paths that end in an element, not in text or an attribute."""
    return not re.search(r"(?:text\(\)|@[\w:\-]+)\s*\Z", path)


def xpath_scalar(xhtml: Column, path: str, attr: str | None = None, pattern: str | None = None) -> Column:
    """Text or attribute of the first node, stripped; ``''`` where there is none. ``pattern`` then takes its group 1."""
    if attr and _node_path(path):
        value = F.coalesce(F.get(F.xpath(xhtml, F.lit(f"({path})[1]/@{attr}")), F.lit(0)), F.lit(""))
    elif _node_path(path):
        value = F.xpath_string(xhtml, F.lit(f"({path})[1]"))
    else:
        value = F.coalesce(F.get(F.xpath(xhtml, F.lit(path)), F.lit(0)), F.lit(""))
    value = strip(F.coalesce(value, F.lit("")))
    return search_group(value, pattern) if pattern else value


def xpath_strings(xhtml: Column, path: str) -> Column:
    """All texts or attributes a path gives, stripped, without empty ones; repeats are kept."""
    return F.filter(F.transform(F.xpath(xhtml, F.lit(path)), lambda x: strip(x)), lambda x: x != "")


def links_of(root: Node, path: str, attr: str, domain: str, label_attr: str | None = None, pattern: str | None = None) -> list[dict[str, str]]:
    """``{label, url}`` of the elements of a path: address from ``attr`` resolved against ``domain``, the first of equal ones.

    ``label_attr``: ``text`` for the element's text, else an attribute, where it is empty the value of ``attr`` (cut down to
    group 1 of ``pattern`` if one is given; elements for which nothing is left are dropped).
    """
    search = re.compile(pattern, re.I | re.S) if pattern else None
    seen: dict[str, str] = {}
    for node in elements(root, path):
        href = node.attrs.get(attr, "")
        raw = href.strip()
        if search:
            m = search.search(raw)
            raw = (m.group(1) if search.groups else m.group()).strip() if m else ""
        if not raw:
            continue
        try:
            url = urljoin(domain, href)
        except ValueError:
            url = href
        label = node.text().strip() if label_attr == "text" else (node.attrs.get(label_attr, "") if label_attr else "") or raw
        seen.setdefault(url, label)
    return [{"label": v, "url": k} for k, v in seen.items()]


def pdf_links(html: Column, base: Column) -> Column:
    """Addresses of all links to PDF files, resolved; empty ones dropped, repeats kept."""

    @F.pandas_udf("array<string>")
    def links(pages: pd.Series, bases: pd.Series) -> pd.Series:
        def one(text: str | None, b: str | None) -> list[str]:
            hrefs = [n.attrs["href"] for n in parse(text).walk() if n.tag == "a" and ".pdf" in n.attrs.get("href", "").translate(str.maketrans("PDF", "pdf"))]
            return [urljoin(b or "", h.strip()) for h in hrefs if h.strip()]

        return pd.Series([one(t, b) for t, b in zip(pages, bases, strict=True)], dtype=object)

    return links(html, base)


def field_column(name: str, how: Mapping[str, Any], xhtml: Column, text: Column) -> Column:
    """The column of one declared field that is no list of elements.

    Precedence: ``xpath``, ``find_all`` with ``regex``, ``block_after`` with ``regex``, ``regex``; anything else is NULL.
    """
    path, pattern = how.get("xpath"), how.get("regex")
    if path:
        return (xpath_strings(xhtml, path) if how.get("multiple") else xpath_scalar(xhtml, path, how.get("attr"), pattern)).alias(name)
    if how.get("find_all") and pattern:
        return find_all_at(text, pattern, int(how.get("index", 0))).alias(name)
    if how.get("block_after") and pattern:
        return search_group(after_marker(text, how["block_after"]), pattern).alias(name)
    if pattern:
        return search_group(text, pattern).alias(name)
    return F.lit(None).cast("string").alias(name)


def extract_detail(pages: DataFrame, fields: Mapping[str, Mapping[str, Any]], domain: str = "", html: str = "html", carry: Sequence[str] = ()) -> DataFrame:
    """``carry`` columns and the declared fields of each page."""
    base = spread(pages.select(*carry, html)).select(*carry, page_forms(fields, domain)(F.coalesce(F.col(html), F.lit(""))).alias("__page"))
    number = {n: i for i, n in enumerate(n for n, how in fields.items() if _lists_elements(how))}
    columns = [F.col(f"__page.f{number[n]}").alias(n) if n in number else field_column(n, how, F.col("__page.xhtml"), F.col("__page.text")) for n, how in fields.items()]
    return base.select(*carry, *columns)


def second_hop(records: DataFrame, pages: DataFrame, domain: str, documents: str = "documentos", address: str = "expediente_url") -> DataFrame:
    """Records whose document list is empty get the PDF links of a second page, where they name one that was fetched.

    ``pages``: ``url, html``. Addresses are resolved against ``domain`` and forced to https. A page that is missing or failed
    leaves the record unchanged.
    """
    wanted = force_https(url_join(F.lit(domain), F.col(address)))
    empty = F.coalesce(F.size(documents) == 0, F.lit(True)) & (F.coalesce(F.col(address), F.lit("")) != "")
    hop = pages.where(F.col("html").isNotNull()).groupBy(F.col("url").alias("__url")).agg(F.min("html").alias("__html"))
    keyed = records.withColumn("__want", F.when(empty, wanted))
    joined = keyed.join(hop, F.col("__want") == F.col("__url"), "left")
    found = F.when(F.col("__html").isNotNull(), pdf_links(F.col("__html"), F.col("__want")))
    kept = F.col(documents)
    own = records.schema[documents].dataType.simpleString()
    if "struct" in own:
        found = F.transform(found, lambda u: F.struct(F.lit("").alias("label"), u.alias("url")))
    return joined.withColumn(documents, F.when(F.size(F.coalesce(found, F.array().cast(own))) > 0, found).otherwise(kept)).drop("__want", "__url", "__html")


def attach_detail(listed: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Listed records with the fields of their detail page; where both have a field the detail's counts, even if empty.

    ``key`` identifies a listed record; records without a detail row come through unchanged.
    """
    extra = [c for c in detail.columns if c != key]
    tagged = detail.select(F.col(key).alias("__key"), F.struct(*extra).alias("__detail"))
    joined = listed.join(tagged, F.col(key) == F.col("__key"), "left")
    out = []
    for c in listed.columns:
        out.append(F.when(F.col("__detail").isNotNull(), F.col(f"__detail.`{c}`")).otherwise(F.col(c)).alias(c) if c in extra else F.col(c))
    out += [F.col(f"__detail.`{c}`").alias(c) for c in extra if c not in listed.columns]
    return joined.select(*out)
