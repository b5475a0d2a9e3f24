"""Words of a text as they are compared: no case, accents, punctuation, mark-up, line breaks or odd spacing.

:func:`word_arrays` does the same as :func:`cased_words` and :func:`words` for a whole Arrow batch at once.
"""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

_TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>")
_HYPHEN = re.compile(r"([^\W_])[-­‐‑][ \t\r\n]*\n[ \t\r\n]*(?=[^\W_])")
_INVISIBLE = re.compile(r"[­​-‏⁠﻿]")
_MARK = regex.compile(r"\p{M}")
_WORD = re.compile(r"[^\W_]+")
_ASCII = re.compile(r"[\x00-\x7f]*\Z")
_FOLD = str.maketrans("áéíóúüñàèìòùâêîôûãõçäëïöÁÉÍÓÚÜÑÀÈÌÒÙÂÊÎÔÛÃÕÇÄËÏÖ", "aeiouunaeiouaeiouaocaeioAEIOUUNAEIOUAEIOUAOCAEIO")


def plain(text: str) -> str:
    """``text`` without mark-up, entities, invisible characters, hyphens at line ends and accents; case is kept."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if "\n" in text:
        text = _HYPHEN.sub(r"\1", text)
    text = text.translate(_FOLD)
    if not _ASCII.match(text):
        text = _INVISIBLE.sub("", text)
        text = _MARK.sub("", unicodedata.normalize("NFKD", text))
    return text


def cased_words(text: str | None) -> list[str]:
    """Words of ``text`` with their case. NULL, empty and blank texts have none."""
    return _WORD.findall(plain(text)) if text else []


def words(text: str | None) -> list[str]:
    """Words of ``text`` without case. NULL, empty and blank texts have none."""
    return _WORD.findall(plain(text).casefold()) if text else []


def faces(word: str) -> bool:
    """True if a cased word looks like a name or a figure."""
    return word[0].isupper() or any(c.isdigit() for c in word)


def word_arrays(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Words of a batch of texts: distinct words without case, and of each word in order its number among them, the number
    of its text, and whether it :func:`faces`."""
    t = pc.fill_null(texts.cast(pa.string()), "")
    t = pc.replace_substring_regex(t, r"</?[A-Za-z][^<>]{0,200}>", " ")
    entities = pc.match_substring(t, "&")
    if pc.any(entities).as_py():
        t = pc.replace_with_mask(t, entities, pa.array([html.unescape(x) for x in t.filter(entities).to_pylist()], pa.string()))
    t = pc.replace_substring_regex(t, "([\\pL\\pN])[-­‐‑][ \\t\\r\\n]*\\n[ \\t\\r\\n]*([\\pL\\pN])", r"\1\2")
    t = pc.replace_substring_regex(t, "[­​-‏⁠﻿]", "")
    t = pc.replace_substring_regex(pc.utf8_normalize(t, form="NFKD"), r"\pM", "")
    split = pc.split_pattern_regex(t, r"[^\pL\pN]+")
    parent, flat = pc.list_parent_indices(split), pc.list_flatten(split)
    filled = pc.not_equal(flat, "")
    encoded = pc.dictionary_encode(flat.filter(filled))
    cased = encoded.dictionary.to_pylist()
    numbers: dict[str, int] = {}
    lower = np.array([numbers.setdefault(w.casefold(), len(numbers)) for w in cased], dtype=np.int32)
    facing = np.array([faces(w) for w in cased], dtype=bool)
    at = encoded.indices.to_numpy(zero_copy_only=False)
    return list(numbers), lower[at] if len(at) else at.astype(np.int32), parent.filter(filled).to_numpy(zero_copy_only=False).astype(np.int64), facing[at] if len(at) else at.astype(bool)


def told_words(text: str | None) -> list[tuple[str, bool]]:
    """Words with their case, each with whether it is telling: a figure, or capitalised though no sentence begins there."""
    if not text:
        return []
    base = plain(text)
    out, end = [], 0
    for m in _WORD.finditer(base):
        word, between = m.group(), base[end : m.start()]
        opens = end == 0 or any(c in ".!?:\n…" for c in between)
        out.append((word, any(c.isdigit() for c in word) or (word[0].isupper() and not opens)))
        end = m.end()
    return out
