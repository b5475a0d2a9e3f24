"""``python -m tamiz SPEC --classifier FILE --root FOLDER [--pages PARQUET --detail PARQUET | --live]``: one incremental run."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tamiz.plans.pipeline import run
from tamiz.plans.spec import load_spec
from tamiz.sources.pages import read_pages


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tamiz", description=__doc__)
    p.add_argument("spec")
    p.add_argument("--classifier")
    p.add_argument("--root", required=True, help="folder of the stored tables")
    p.add_argument("--pages", help="Parquet of list pages: page_no, url, html")
    p.add_argument("--detail", help="Parquet of detail pages: url, html")
    p.add_argument("--hop", help="Parquet of second pages: url, html")
    p.add_argument("--live", action="store_true", help="fetch the pages")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("tamiz").getOrCreate()
    listing = spark.read.parquet(a.pages).select(F.col("page_no").cast("long").alias("page_no"), "url", "html") if a.pages else None
    other = lambda path: read_pages(spark, path) if path else None
    print(run(spark, load_spec(a.spec, a.classifier), a.root, listing, other(a.detail), other(a.hop), live=a.live))


if __name__ == "__main__":
    main()
