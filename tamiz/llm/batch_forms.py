"""Canonical forms of listing records: what a record says, however its fields are written, abbreviated or damaged."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from urllib.parse import urlsplit

import regex

_LOOKS = str.maketrans("oOlI|", "00111")
_NUMBER = re.compile(r"(?<![^\W_])([\dol]{1,6})\s*(?:[/\-_\s]|\bde\b)+\s*([\dol]{2,4})(?![\d])")
_NOISE = re.compile(r"^(?:\W|_|proyecto|de|ley|pl|p\.\s?l|no|nro|num|numero)+(?=[\dol])")
_TOKEN = re.compile(r"(?:[^\W_]|[?\ufffd](?=[^\W_])|(?<=[^\W_])[?\ufffd])+\.?")
_TAIL = re.compile(r"[^\W\d_]")
_LIKE = re.compile(r"[\dol|]+")
_HEADING = re.compile(r"^\W*proyecto de ley\s*:")
_PLURAL = re.compile(r"\b([^\W\d_]{2,5})\.(e?s)\b")
_SIGN = re.compile("[ºª\u00ad]")
_MARK = regex.compile(r"\p{M}")


def fold(text: str) -> str:
    """Compatibility form without accents and case; fraction slashes become slashes."""
    if text.isascii():
        return text.casefold()
    return _MARK.sub("", unicodedata.normalize("NFKD", _SIGN.sub("", text).replace("⁄", "/").replace("∕", "/"))).casefold()


@lru_cache(1 << 16)
def numbered(text: str | None, digits: int = 4) -> str:
    """``number/year`` and the letter of the chamber of a file number; the folded text where it is none; ``''`` for blank.

    Zeros before the number, two-figure years, separators, words around it and letters that look like figures make no
    difference.
    """
    if text is None or not text.strip():
        return ""
    t = fold(text).strip()
    t = _NOISE.sub("", t)
    m = _NUMBER.search(t)
    if not m:
        return re.sub(r"\W", "", t)
    number, year = (int(g.translate(_LOOKS)) for g in m.groups())
    if year < 100:
        year += 2000 if year < 70 else 1900
    letter = _TAIL.search(t[m.end() :])
    return f"{number}/{year}{letter.group() if letter else ''}"


@lru_cache(1 << 16)
def address(text: str | None) -> str:
    """Host and path of an address; scheme, ``www``, letter case, doubled and closing slashes, query and fragment go."""
    if text is None or not text.strip():
        return ""
    t = unicodedata.normalize("NFKC", text).strip().casefold()
    parts = urlsplit(t if "//" in t else "//" + t)
    path = re.sub(r"/+", "/", parts.path).rstrip("/")
    return parts.netloc.removeprefix("www.") + path


def title_tokens(text: str | None) -> list[str]:
    """Words of a title, folded; an abbreviation keeps its point, a lost letter its mark; a heading before it goes."""
    if text is None:
        return []
    t = _PLURAL.sub(r"\1\2.", _HEADING.sub("", fold(text)))  # the plural of an abbreviation
    out = []
    for m in _TOKEN.finditer(t):
        w = m.group()
        if w.endswith(".") and (len(w) > 7 or w[:-1].isdigit()):
            w = w[:-1]
        if _LIKE.fullmatch(w) and any(c.isdigit() for c in w):
            w = w.translate(_LOOKS)
        out.append(w)
    return out


def figures(tokens: list[str]) -> str:
    """The figures of a title in order."""
    return " ".join(t for t in tokens if t[0].isdigit())
