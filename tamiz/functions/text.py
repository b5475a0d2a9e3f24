"""Text expressions whose results equal Python's, built from JVM functions only.

``strip`` follows ``str.strip`` (all of Python's white space, NBSP included); regular expressions are compiled with the
flags under which the JVM's engine agrees with Python's ``re`` for case folding, dot and white space.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as in ``str.isspace``: the Unicode class plus the four separators the JVM leaves out.
SPACE = r"[\s\x1c-\x1f]"
_STRIP = rf"(?U)^{SPACE}+|{SPACE}+\z"


def strip(c: Column | str) -> Column:
    """``str.strip``. NULL stays NULL."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, _STRIP, "")


def is_blank(c: Column) -> Column:
    """True for NULL, the empty string and strings of white space only."""
    return F.coalesce(strip(c) == "", F.lit(True))


def entity_key(c: Column | str) -> Column:
    """Key of an entity: stripped of all outer white space, in capitals; NULL where nothing is left."""
    s = F.upper(strip(c))
    return F.when(s != "", s)


def jvm_pattern(pattern: str, ignore_case: bool = True, dot_all: bool = False) -> str:
    """A Python ``re`` pattern as a JVM pattern with the same meaning.

    Raises ``re.error`` for patterns Python rejects. ``\\s`` and ``\\S`` are widened to Python's white space.
    """
    re.compile(pattern)
    out, i, depth = [], 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt == "s":
                out.append(r"\s\x1c-\x1f" if depth else SPACE)
            elif nxt == "S" and not depth:
                out.append(r"[^\s\x1c-\x1f]")
            elif nxt == "Z":
                out.append(r"\z")
            else:
                out.append(ch + nxt)
            i += 2
            continue
        if ch == "[" and not depth:
            depth = True
        elif ch == "[" and depth:
            out.append("\\")
        elif ch == "]" and depth and pattern[i - 1] not in "[^":
            depth = False
        out.append(ch)
        i += 1
    return "(?" + ("i" if ignore_case else "") + "ud" + ("s" if dot_all else "") + "U)" + "".join(out)


def search_group(c: Column, pattern: str, ignore_case: bool = True, dot_all: bool = True) -> Column:
    """Group 1 (or the whole match, where there is none) of the first match, stripped; ``''`` without a match or on NULL."""
    group = 1 if re.compile(pattern).groups else 0
    return F.coalesce(strip(F.regexp_extract(c, jvm_pattern(pattern, ignore_case, dot_all), group)), F.lit(""))


def find_all_at(c: Column, pattern: str, index: int = 0) -> Column:
    """Element ``index`` of all matches, stripped; ``''`` where there are fewer. At most one group is allowed."""
    groups = re.compile(pattern).groups
    if groups > 1:
        raise ValueError(f"more than one group: {pattern}")
    hits = F.regexp_extract_all(c, F.lit(jvm_pattern(pattern, ignore_case=False)), F.lit(groups))
    return F.coalesce(strip(F.get(hits, F.lit(index))), F.lit(""))


def after_marker(c: Column, marker: str) -> Column:
    """Text after the first ``marker``; the whole text where the marker is missing."""
    if not marker:
        return c
    at = F.locate(marker, c)
    return F.when(at > 0, c.substr(at + F.lit(len(marker)), F.length(c))).otherwise(c)
