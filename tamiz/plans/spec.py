"""A pipeline's declaration: YAML to frozen values, checked once on the driver."""

from __future__ import annotations

import logging
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from tamiz.functions.text import jvm_pattern
from tamiz.operators.classify import valid_rules
from tamiz.operators.list_extract import ListSpec, cell_number
from tamiz.operators.store import table_schema
from tamiz.sources.pages import FetchPolicy

log = logging.getLogger(__name__)


class SpecError(ValueError):
    """A declaration that cannot be used."""


@dataclass(frozen=True)
class TableSpec:
    name: str
    primary_key: str
    lookup_key: str
    columns: dict[str, str]


@dataclass(frozen=True)
class PipelineSpec:
    """Everything a run needs to know of one country or site."""

    domain: str
    base_url: str
    max_pages: int
    list_spec: ListSpec
    input_key: str
    detail_fields: dict[str, dict[str, Any]]
    raw: TableSpec
    final: TableSpec
    title_field: str
    detail_field: str
    fetch: FetchPolicy
    list_concurrency: int
    detail_concurrency: int
    first_n: int | None = 50
    aliases: dict[str, str] = field(default_factory=lambda: {"fecha_cam": "fecha_camara", "fecha_sen": "fecha_senado"})
    date_formats: dict[str, str] = field(default_factory=dict)
    rules: tuple[tuple[str, str], ...] = ()
    categories: tuple[str, ...] = ()
    batch_size: int = 20
    list_rounds: int = 2


def read_yaml(path: str, root: str | None = None) -> dict[str, Any]:
    """A YAML file: the path as given, else below ``root``; FileNotFoundError if neither is there."""
    import yaml

    at = path if os.path.exists(path) else os.path.join(root or os.getcwd(), path)
    if not os.path.exists(at):
        raise FileNotFoundError(path)
    with open(at, encoding="utf-8") as f:
        return yaml.safe_load(f)


def _need(cfg: Mapping[str, Any], *path: str) -> Any:
    at: Any = cfg
    for p in path:
        if not isinstance(at, Mapping) or p not in at:
            raise SpecError(f"missing: {'.'.join(path)}")
        at = at[p]
    return at


def _table(cfg: Mapping[str, Any], which: str) -> TableSpec:
    t = _need(cfg, "storage", which)
    columns = dict(_need(cfg, "storage", which, "columns"))
    table_schema(columns)
    return TableSpec(_need(t, "table"), _need(t, "primary_key"), _need(t, "lookup_key"), columns)


def list_spec(cfg: Mapping[str, Any]) -> ListSpec:
    """The list page's part of a declaration. Fields whose selector names no cell are left out."""
    selectors = _need(cfg, "selectors", "list")
    fields = {}
    for name, selector in _need(selectors, "fields").items():
        at = cell_number(selector)
        if at is None:
            log.warning("the selector of %s names no cell: %s", name, selector)
        else:
            fields[name] = at
    exclude = selectors.get("detail_link_exclude") or {}
    title = selectors.get("title_regex", ".*") or ""
    re.compile(title)
    hashed = selectors.get("hash") or {}
    return ListSpec(
        row_selector=_need(selectors, "row_selector"), cell_selector=_need(selectors, "cell_selector"), fields=fields,
        link_column=cell_number(selectors.get("detail_link_selector", "")), href_suffix=exclude.get("href_suffix", ""), link_text=exclude.get("text", ""),
        title_regex=title, domain=_need(cfg, "portal", "domain"), hash_fields=tuple(hashed.get("fields", ())), hash_key=hashed.get("key", "checksum"),
    )


def pipeline_spec(cfg: Mapping[str, Any], classifier: Mapping[str, Any] | None = None, **changes: Any) -> PipelineSpec:
    """A declaration (and that of the classifier, if it is a file of its own) as a checked spec; ``changes`` override fields."""
    stages = {s["type"]: s for s in _need(cfg, "pipeline")}
    if "list" not in stages:
        raise SpecError("no list stage")
    detail = stages.get("detail", {})
    fields = dict(cfg.get("selectors", {}).get("detail", {}).get("fields", {}))
    for how in fields.values():
        if how.get("regex"):
            jvm_pattern(how["regex"])
    concurrency, retry = cfg.get("concurrency", {}), cfg.get("retry", {})
    backoff = retry.get("backoff", {})
    c = classifier or {}
    values: dict[str, Any] = {
        "domain": _need(cfg, "portal", "domain"), "base_url": _need(cfg, "portal", "base_url"), "max_pages": int(stages["list"].get("max_pages", 1)),
        "list_spec": list_spec(cfg), "input_key": detail.get("input_key", "detail_url"), "detail_fields": fields,
        "raw": _table(cfg, "raw"), "final": _table(cfg, "final"),
        "title_field": _need(cfg, "classifier", "titulo"), "detail_field": _need(cfg, "classifier", "detalle"),
        "fetch": FetchPolicy(
            attempts=int(retry.get("attempts", 3)), kind=backoff.get("type", "exponential"), multiplier=float(backoff.get("multiplier", 1)),
            most=float(backoff.get("max_delay", 30)), jitter=bool(backoff.get("jitter", True)), timeout=float(cfg.get("request", {}).get("timeout", 15)),
            proxy_page=cfg.get("request", {}).get("proxy_page"), agents=tuple(cfg.get("request", {}).get("agents", FetchPolicy.agents)),
        ),
        "list_concurrency": int(concurrency.get(stages["list"].get("concurrency"), 1)), "detail_concurrency": int(concurrency.get(detail.get("concurrency"), 1)),
        "rules": tuple(valid_rules(c.get("rules", ()))), "categories": tuple(c.get("categories", ())), "batch_size": int((c.get("gemini") or {}).get("batch_size", 20)),
    }
    return PipelineSpec(**(values | changes))


def load_spec(path: str, classifier_path: str | None = None, root: str | None = None, **changes: Any) -> PipelineSpec:
    """A spec from YAML files."""
    return pipeline_spec(read_yaml(path, root), read_yaml(classifier_path, root) if classifier_path else None, **changes)
