"""Links of a document list that sources write as JSON in many ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.text import strip


def link_set(c: Column) -> Column:
    """The set of links in a JSON document list, as a sorted array without repeats.

    Takes lists of bare links and lists of ``{label, url}`` objects, mixed too, and a lone object. Text that is no JSON
    gives the ``http(s)`` addresses found in it. NULL, blank text and ``[]`` give the empty array. Labels, order,
    repetition, white space and JSON escapes make no difference.
    """
    parsed = F.from_json(c, "array<string>")
    bare = F.transform(
        parsed,
        lambda e: F.when(F.ltrim(e).startswith("{"), F.coalesce(F.get_json_object(e, "$.url"), F.get_json_object(e, "$.href"))).otherwise(e),
    )
    loose = F.regexp_extract_all(F.replace(c, F.lit("\\/"), F.lit("/")), F.lit(r"""(https?://[^\s"'<>,\]\}\\]+)"""), F.lit(1))
    links = F.transform(F.coalesce(bare, loose, F.array().cast("array<string>")), lambda e: strip(e))
    return F.array_sort(F.array_distinct(F.filter(links, lambda e: F.coalesce(e != "", F.lit(False)))))
