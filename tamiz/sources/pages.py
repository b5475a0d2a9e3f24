"""Pages as rows: offline tables, and live fetching as a Spark data source with retries, rotation of headers and proxies.

A page that cannot be fetched is a row with an error, never an endless retry. Live fetching is off unless it is asked for.
"""

from __future__ import annotations

import hashlib
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.retry import wait_of
from tamiz.sources.html import parse, select

#: Headers a browser sends: fixed values.
HEADERS = {
    "Accept": "text/html,application/xhtml+xml,application/xml;q=0.9,image/webp,*/*;q=0.8",
    "Accept-Language": "en-US,en;q=0.5",
    "Connection": "keep-alive",
}
PAGE_SCHEMA = "url string, html string, status int, attempts int, error string"

#: One request: address, headers, proxy or None, seconds; gives status and text, raises on failure.
Get = Callable[[str, dict[str, str], str | None, float], tuple[int, str]]


@lru_cache(maxsize=64)
def _session(proxy: str | None) -> urllib.request.OpenerDirector:
    """What a worker keeps between its requests: an opener with cookies, one for each proxy."""
    handlers: list[urllib.request.BaseHandler] = [urllib.request.HTTPCookieProcessor()]
    if proxy:
        handlers.append(urllib.request.ProxyHandler({"http": proxy, "https": proxy}))
    return urllib.request.build_opener(*handlers)


def http_get(url: str, headers: dict[str, str], proxy: str | None, timeout: float) -> tuple[int, str]:
    with _session(proxy).open(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
        return r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", errors="replace")


@dataclass(frozen=True)
class FetchPolicy:
    """How a page is fetched: ``attempts`` direct tries with waits between them, each followed by up to ``proxy_tries`` proxies."""

    attempts: int = 3
    kind: str = "exponential"
    multiplier: float = 1.0
    most: float = 30.0
    jitter: bool = True
    timeout: float = 15.0
    proxies: tuple[str, ...] = ()
    proxy_tries: int = 20
    check_url: str | None = None
    proxy_page: str | None = None
    agents: tuple[str, ...] = ("tamiz/1",)


def headers_for(url: str, attempt: int, agents: Sequence[str]) -> dict[str, str]:
    """Headers of an attempt; which of the ``agents`` asks depends on address and attempt only, so a repeated task asks alike."""
    pick = int(hashlib.md5(f"{url}|{attempt}".encode()).hexdigest()[:8], 16) % len(agents)
    return HEADERS | {"User-Agent": agents[pick]}


def proxy_order(proxies: Sequence[str], seed: str) -> list[str]:
    """All proxies in an order that depends on ``seed`` only."""
    return sorted(proxies, key=lambda p: hashlib.md5(f"{seed}|{p}".encode()).digest())


def fetch_once(url: str, policy: FetchPolicy, attempt: int, get: Get, failed: set[str]) -> tuple[int, str]:
    """A direct request, then proxies: those that fail their check, are blocked (403, 429) or break are not used again."""
    try:
        return get(url, headers_for(url, attempt, policy.agents), None, policy.timeout)
    except Exception as direct:
        error: Exception = direct
    for proxy in [p for p in proxy_order(policy.proxies, url) if p not in failed][: policy.proxy_tries]:
        if policy.check_url:
            try:
                if get(policy.check_url, {}, proxy, policy.timeout)[0] != 200:
                    raise OSError("the proxy's check failed")
            except Exception as e:
                failed.add(proxy)
                error = e
                continue
        try:
            return get(url, headers_for(url, attempt, policy.agents), proxy, policy.timeout)
        except urllib.error.HTTPError as e:
            if e.code not in (403, 429):
                raise
            error = e
        except Exception as e:
            error = e
        failed.add(proxy)
    raise error


def fetch(url: str, policy: FetchPolicy, get: Get = http_get, sleep: Callable[[float], None] = time.sleep) -> dict:
    """A row of ``PAGE_SCHEMA``: the page, or the error after the last attempt."""
    failed: set[str] = set()
    error = ""
    for attempt in range(1, max(1, policy.attempts) + 1):
        try:
            status, text = fetch_once(url, policy, attempt, get, failed)
            return {"url": url, "html": text, "status": status, "attempts": attempt, "error": None}
        except Exception as e:
            error = repr(e)
            if attempt < policy.attempts:
                wait = wait_of(attempt, policy.kind, policy.multiplier, policy.most)
                sleep(wait + (int(hashlib.md5(f"{url}{attempt}".encode()).hexdigest(), 16) % 1000 / 1000 if policy.jitter else 0))
    return {"url": url, "html": None, "status": None, "attempts": policy.attempts, "error": error}


def fetch_pages(urls: DataFrame, policy: FetchPolicy, concurrency: int = 5, get: Get = http_get) -> DataFrame:
    """Pages of ``urls`` (column ``url``), each distinct address once, by at most ``concurrency`` tasks at a time.

    Fetching has effects, so the caller writes the result before using it twice.
    """

    def run(frames: Iterator) -> Iterator:
        for f in frames:
            rows = [fetch(u, policy, get) for u in f["url"]]
            yield pd.DataFrame(rows, columns=["url", "html", "status", "attempts", "error"]).astype({"status": "Int32", "attempts": "Int32"})

    return urls.select("url").where("url IS NOT NULL AND url <> ''").distinct().repartition(concurrency, "url").mapInPandas(run, PAGE_SCHEMA)


def fetch_in_rounds(urls: DataFrame, policy: FetchPolicy, concurrency: int, rounds: int, stage: Callable[[DataFrame, str], DataFrame], get: Get = http_get) -> DataFrame:
    """Pages of ``urls``; those that failed are asked for again behind all others, ``rounds`` times in all.

    ``stage`` writes each round, see :func:`tamiz.session.scratch`. A page that fails in the last round stays a row with its error.
    """
    last = stage(fetch_pages(urls, policy, concurrency, get), "pages")
    good = last.where("html IS NOT NULL")
    for _ in range(rounds - 1):
        failed = last.where("html IS NULL")
        if failed.isEmpty():
            break
        last = stage(fetch_pages(failed, policy, concurrency, get), "pages")
        good = good.unionByName(last.where("html IS NOT NULL"))
    return good.unionByName(last.where("html IS NULL"))


class FailedPages(RuntimeError):
    """Pages could not be fetched and the policy is to stop."""


def good_pages(pages: DataFrame, mode: str = "permissive") -> DataFrame:
    """Fetched pages. ``failfast``: an error if any failed; ``permissive``: those that failed are left to :func:`dead_letters`."""
    if mode == "failfast":
        bad = pages.where("html IS NULL").select("url", "error").limit(5).collect()
        if bad:
            raise FailedPages("; ".join(f"{r['url']}: {r['error']}" for r in bad))
    return pages.where("html IS NOT NULL")


def dead_letters(pages: DataFrame) -> DataFrame:
    """Pages that could not be fetched, with attempts and error."""
    return pages.where("html IS NULL").select("url", "attempts", "error")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Offline pages: Parquet with ``url`` and ``html``."""
    return spark.read.parquet(path).select("url", "html")


def register_http_source(spark: SparkSession) -> None:
    """Registers the data source ``tamiz_http``: options ``urls`` (separated by line breaks), ``attempts``, ``timeout``."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Reader(DataSourceReader):
        def __init__(self, options: dict) -> None:
            self.urls = [u for u in options.get("urls", "").split("\n") if u]
            self.policy = FetchPolicy(attempts=int(options.get("attempts", 3)), timeout=float(options.get("timeout", 15)))

        def partitions(self):
            return [InputPartition(u) for u in self.urls]

        def read(self, partition):
            r = fetch(partition.value, self.policy)
            yield r["url"], r["html"], r["status"], r["attempts"], r["error"]

    class HttpPages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tamiz_http"

        def schema(self) -> str:
            return PAGE_SCHEMA

        def reader(self, schema):
            return Reader(self.options)

    spark.dataSource.register(HttpPages)


def proxy_table(html: str, most: int = 50) -> list[str]:
    """Proxies of a page's proxy table (``#proxylisttable``, else the first table): those for https, the first ``most``."""
    root = parse(html)
    tables = select(root, "table#proxylisttable") or select(root, "table")
    found = []
    for row in select(tables[0], "tr")[1:] if tables else []:
        cells = [c.text().strip() for c in select(row, "td")]
        if len(cells) >= 7 and cells[6].lower() == "yes":
            found.append(f"http://{cells[0]}:{cells[1]}")
    return found[:most]


def refreshed(policy: FetchPolicy, get: Get = http_get) -> FetchPolicy:
    """``policy`` with the proxies that its ``proxy_page`` lists now; as it was where the page fails or lists none."""
    if not policy.proxy_page:
        return policy
    try:
        found = proxy_table(get(policy.proxy_page, headers_for(policy.proxy_page, 1, policy.agents), None, policy.timeout)[1])
    except Exception:
        return policy
    return replace(policy, proxies=tuple(found)) if found else policy


def proxies_of(html: Column) -> Column:
    """:func:`proxy_table` of each page."""

    @F.pandas_udf("array<string>")
    def found(pages: pd.Series) -> pd.Series:
        return pages.map(lambda t: proxy_table(t or ""))

    return found(html)


def usable_proxies(pool: DataFrame, failed: DataFrame, order: str, most: int = 50) -> DataFrame:
    """Proxies ``proxy, https`` for https that have not failed, the first ``most`` in order (a feature of the pool)."""
    fit = pool.where(F.lower(F.trim("https")) == "yes")
    return fit.join(failed.select("proxy").distinct(), "proxy", "left_anti").orderBy(order).limit(most)
