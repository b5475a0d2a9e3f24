"""Addresses: joining, scheme, and lists of page addresses."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def url_join(base: pd.Series, href: pd.Series) -> pd.Series:
    """``urllib.parse.urljoin`` by Arrow batch; NULL where either is NULL, the address itself where it cannot be joined."""

    def one(b: str | None, h: str | None) -> str | None:
        if b is None or h is None:
            return None
        try:
            return urljoin(b, h)
        except ValueError:
            return h

    return pd.Series([one(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


def force_https(c: Column) -> Column:
    """Any other scheme replaced by https; addresses without one unchanged."""
    return F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "https:")


def page_urls(spark: SparkSession, base: str, pages: int = 1) -> DataFrame:
    """``page_no, url`` of a paged listing: the base itself, then ``?page=1`` and on; ``pages`` in all."""
    n = F.col("id")
    url = F.when(n == 0, F.lit(base)).otherwise(F.concat(F.lit(base + "?page="), n.cast("string")))
    return spark.range(max(1, pages)).select(n.alias("page_no"), url.alias("url"))
