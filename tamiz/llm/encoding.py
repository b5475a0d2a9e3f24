"""Text garbled by a wrong character encoding: where it is, and what it was.

Adjacent character pairs are counted over the whole corpus. Each pair of a text is scored by its mutual information weighted
with its own probability; maximum-scoring segments of the negated scores isolate the improbable runs. Only inside those runs
inverse mappings are tested: reading the characters back in the encoding they were wrongly shown in and then in the right
one (once or repeatedly, also after letter case was changed or a byte was lost), and putting letters in the place of
characters that were replaced by a mark. A mapping holds if what it gives is far more probable next to its neighbours.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.session import spread, staged

#: Characters that are counted as themselves, the most frequent ones; all others count as their Unicode category. With at
#: most 30 categories the pair table has no more than (ALPHABET + 30) ** 2 rows; it is what the driver and the tasks hold.
ALPHABET = 500
#: Share of all pair occurrences that count as improbable.
IMPROBABLE = 0.12
#: Bits by which a mapping must raise the probability: of bytes that are valid UTF-8, of a single character, of a lost one.
GAIN_UTF8, GAIN_SINGLE, GAIN_LOST = -8.0, 5.0, 5.0

#: Encodings in which UTF-8 is wrongly shown, and pairs (wrong, right) for single-byte text: fixed values.
SHOWN_AS = ["cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "iso8859-15", "cp1254"]
SINGLE = [
    ("latin-1", "cp850"), ("cp1252", "cp850"), ("latin-1", "cp437"), ("latin-1", "mac_roman"), ("cp1252", "mac_roman"),
    ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("cp1250", "cp1252"), ("cp1251", "cp1252"),
]
#: Letters and signs of Spanish text that a mapping may restore: fixed values.
LETTERS = "áéíóúñüÁÉÍÓÚÑÜ"
SIGNS = "¿¡“”«»‘’–—ºª°\xa0"
LOST = "�"
#: Lead bytes whose continuation left no visible character (a soft hyphen or a control), and the letters they stand for.
HALF = {"ÃƒÂ": "íÍÁ", "ãƒâ": "íá", "Ã": "íÍÁ", "ã": "íá", "Ă": "íÍÁ", "Г": "í", "Â": "\xa0"}
#: Most accented words that may be held for the choice of lost letters (some 100 MB); more are an error, none is left out.
MOST_WORDS = 500_000
#: Score of a pair that no correct text holds (a replacement mark), and least score of a no-break space beside a letter.
MARKED, BESIDE = 12.0, 1.0
#: Words of plain and Spanish letters; those with an accented one make the table above.
_WORD = re.compile(f"[A-Za-z{LETTERS}]+")
_BLANKED = re.compile(f"[{LETTERS}?{LOST}]")
_SPACED = re.compile(f"[A-Za-z{LETTERS}]+\xa0[A-Za-z{LETTERS}]+")
_HOLED = re.compile(f"[A-Za-z{LETTERS}?{LOST}]+")
#: What any mapping can act on: a character other than plain and Spanish letters and signs of ASCII, a question mark, or two
#: characters beyond ASCII in a row. A text without is as it was, whatever its runs.
SUSPECT = f"[^\\x00-\\x7f{LETTERS}]|\\?|[^\\x00-\\x7f]{{2}}"
_SUSPECT = re.compile(SUSPECT)


@dataclass
class PairModel:
    """Counts of characters and adjacent pairs of a corpus, and the score below which a pair is improbable."""

    alphabet: frozenset[str]
    pairs: dict[tuple[str, str], int]
    total: int
    words: dict[str, list[tuple[int, str]]] = field(default_factory=dict)
    floor: float = 0.0
    left: dict[str, int] = field(default_factory=dict)
    right: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for (a, b), n in self.pairs.items():
            self.left[a] = self.left.get(a, 0) + n
            self.right[b] = self.right.get(b, 0) + n
        ranked = sorted((self.information(a, b), n) for (a, b), n in self.pairs.items())
        seen = 0
        for score, n in ranked:
            seen += n
            if seen > IMPROBABLE * self.total:
                self.floor = score
                break

    def symbol(self, ch: str) -> str:
        return ch if ch in self.alphabet else unicodedata.category(ch)

    def bits(self, a: str, b: str) -> float:
        """Logarithm of the probability of the pair."""
        return math.log2((self.pairs.get((self.symbol(a), self.symbol(b)), 0) + 0.5) / (self.total + 1))

    def information(self, a: str, b: str) -> float:
        """Mutual information of two adjacent symbols plus twice the logarithm of the pair's own probability.

        Unweighted, it is greatest for rare characters that only occur together, which is just what garbled letters do.
        """
        n = self.pairs.get((a, b), 0) + 0.5
        return 3 * math.log2(n / (self.total + 1)) - math.log2((self.left.get(a, 0) + 1) / (self.total + 1)) - math.log2((self.right.get(b, 0) + 1) / (self.total + 1))


def padded(text: str) -> str:
    return f"\n{text}\n"


def pairs_of(text: str) -> list[tuple[str, str, int]]:
    """Adjacent characters of ``text`` with their number."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    seen = np.flatnonzero(np.bincount(points))
    number = np.zeros(int(seen[-1]) + 1, dtype=np.int64)
    number[seen] = np.arange(len(seen))
    both = number[points[:-1]] * len(seen) + number[points[1:]]
    found, n = np.unique(both, return_counts=True) if len(seen) > 2_000 else ((c := np.bincount(both)).nonzero()[0], c[c > 0])
    chars = [chr(p) for p in seen.tolist()]
    return [(chars[k // len(seen)], chars[k % len(seen)], int(m)) for k, m in zip(found.tolist(), n.tolist(), strict=True)]


def pair_counts(docs: DataFrame, columns: list[str]) -> PairModel:
    """Pairs of adjacent characters in all values of ``columns``, and accented words; ends of values count as line breaks.

    Equal values count once, so that a text delivered over and over does not look probable, garbled as it may be. Of the
    accented words all those are kept that a word with a lost letter somewhere in the corpus may be. What is counted (a row
    for each pair and word) is kept in a small table.
    """
    values = docs.select(F.explode(F.array(*columns)).alias("v")).where("v <> ''").distinct()

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        pairs: Counter[str] = Counter()
        words: Counter[str] = Counter()
        holed: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            kinds = ["p"] * len(pairs) + ["w"] * len(words) + ["h"] * len(holed)
            counts = [*pairs.values(), *words.values(), *holed.values()]
            out = pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array([*pairs, *words, *holed], pa.string()), pa.array(counts, pa.int64())], names=["kind", "item", "n"])
            for c in (pairs, words, holed):
                c.clear()
            return out

        for b in batches:
            text = padded("\n".join(b.column(0).to_pylist()))
            for a, c, n in pairs_of(text):
                pairs[a + c] += n
            words.update(w.lower() for w in _WORD.findall(text) if not w.isascii())
            holed.update(_needed(text))
            if len(pairs) + len(words) + len(holed) > 200_000:
                yield flush()
        yield flush()

    counted = staged(values.mapInArrow(tally, "kind string, item string, n bigint").groupBy("kind", "item").agg(F.sum("n").alias("n")), "pair-counts")
    by_pair = counted.where("kind = 'p'").select(F.col("item").alias("pair"), "n")
    first = by_pair.groupBy(F.substring("pair", 1, 1).alias("ch")).agg(F.sum("n").alias("n"))
    alphabet = frozenset(r["ch"] for r in first.orderBy(F.desc("n"), "ch").limit(ALPHABET).collect())

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol = lambda c: c if c in alphabet else unicodedata.category(c)
        for b in batches:
            p = b.column("pair").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([symbol(x[0]) for x in p], pa.string()), pa.array([symbol(x[1]) for x in p], pa.string()), b.column("n")], names=["a", "b", "n"])

    folded = by_pair.mapInArrow(fold, "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    pairs = {(r["a"], r["b"]): r["n"] for r in folded.collect()}
    words: dict[str, list[tuple[int, str]]] = {}
    blank = F.translate("item", LETTERS + "?" + LOST, "_" * (len(LETTERS) + 2))
    needed = counted.where("kind = 'h'").select(F.col("item").alias("form"))
    held = counted.where("kind = 'w'").select("item", "n", blank.alias("form")).join(needed, "form", "left_semi").limit(MOST_WORDS + 1).collect()
    if len(held) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} accented words for words with lost letters")
    for r in held:
        words.setdefault(r["form"], []).append((r["n"], r["item"]))
    return PairModel(alphabet, pairs, sum(pairs.values()), words)


def _needed(text: str) -> set[str]:
    """Forms, without accents and lost letters, of the words of ``text`` that may have lost a letter."""
    found: set[str] = set()
    if LOST in text or "?" in text:
        found.update(_BLANKED.sub("_", w.lower()) for w in _HOLED.findall(text) if "?" in w or LOST in w)
    if "\xa0" in text:
        found.update(_BLANKED.sub("_", w.replace("\xa0", "á").lower()) for w in _SPACED.findall(text))
    return found


def improbable_runs(text: str, model: PairModel, cost: dict[tuple[str, str], float]) -> list[tuple[int, int]]:
    """All maximal scoring segments of improbable pairs, as half-open ranges of character positions in ``text``.

    Linear time: open segments are kept with the running sum before and after them; a new positive pair joins those to its
    left that it can raise above their own end.
    """
    p = padded(text)
    total = 0.0
    open_: list[tuple[int, int, float, float]] = []
    for i, pair in enumerate(zip(p, p[1:], strict=False)):
        w = cost.get(pair)
        if w is None:
            a, b = pair
            w = max(-6.0, min(12.0, model.floor - model.information(model.symbol(a), model.symbol(b))))
            if LOST in pair:
                w = MARKED
            elif a == "\xa0" and b.isalpha() or b == "\xa0" and a.isalpha():
                w = max(w, BESIDE)
            cost[pair] = w
        before, total = total, total + w
        if w <= 0:
            continue
        start, end, low, high = i, i + 2, before, total
        while True:
            j = len(open_) - 1
            while j >= 0 and open_[j][2] >= low:
                j -= 1
            if j < 0 or open_[j][3] >= high:
                break
            start, low = open_[j][0], open_[j][2]
            del open_[j:]
        open_.append((start, end, low, high))
    return [(max(0, a - 1), min(len(text), b - 1)) for a, b, _, _ in open_]


@lru_cache(maxsize=1 << 16)
def _decoded(chunk: str) -> tuple[str, ...]:
    """What ``chunk`` is if it is UTF-8 shown in another encoding."""
    found = []
    forms = {chunk, chunk[0].upper() + chunk[1:], chunk.upper(), chunk.lower(), chunk[0].upper() + chunk[1:].lower()}
    for form in sorted(forms, key=lambda f: f != chunk):
        for enc in SHOWN_AS:
            raw = _bytes(form, enc)
            if raw is None or max(raw) < 0x80:
                continue
            try:
                text = raw.decode("utf-8")
            except UnicodeDecodeError:
                continue
            if text != chunk and all(unicodedata.category(c)[0] in "LPSN" or c == "\xad" or "\x80" <= c <= "\xa0" for c in text):
                found.append(text)
    # Letters and signs of the language first: short stretches are valid in more than one way.
    return tuple(sorted(dict.fromkeys(found), key=lambda t: not all(c in LETTERS or c in SIGNS for c in t)))


def _bytes(text: str, enc: str) -> bytes | None:
    """Bytes of ``text`` in ``enc``; control characters that a table leaves open stand for themselves."""
    out = bytearray()
    for c in text:
        try:
            out += c.encode(enc)
        except UnicodeEncodeError:
            if "\x80" <= c <= "\x9f":
                out.append(ord(c))
            else:
                return None
    return bytes(out)


@lru_cache(maxsize=1 << 12)
def _singles(ch: str) -> tuple[str, ...]:
    """Spanish letters and signs that ``ch`` may be if one single-byte encoding was taken for another."""
    found: list[str] = []
    if ch in LETTERS or ch == "\xa0":
        return ()
    for wrong, right in SINGLE:
        for form in dict.fromkeys((ch, ch.upper(), ch.lower())):
            raw = _bytes(form, wrong) if len(form) == 1 else None
            if raw and len(raw) == 1 and raw[0] >= 0x80:
                got = raw.decode(right, errors="ignore")
                if got != ch and got and got in LETTERS + SIGNS:
                    found.append(got)
    return tuple(dict.fromkeys(found))


def _gain(model: PairModel, before: str, old: str, new: str, after: str) -> float:
    """Bits gained at the two seams by putting ``new`` for ``old``."""
    return model.bits(before, new[0]) + model.bits(new[-1], after) - model.bits(before, old[0]) - model.bits(old[-1], after)


def _fits_case(ch: str, before: str, after: str) -> bool:
    """A capital letter has no small letter before it, a small one no capital on both sides."""
    if ch.isupper():
        return not before.islower()
    return not (before.isupper() and after.isupper())


def _spelt(word: str, model: PairModel) -> str | None:
    """The most frequent known word that ``word`` with its lost letters may be, in its letter case."""
    low = word.lower()
    for _, known in sorted(model.words.get(_BLANKED.sub("_", low), ()), reverse=True):
        if all(a == b or a in "?" + LOST for a, b in zip(low, known, strict=True)):
            upper = sum(c.isupper() for c in word) > sum(c.islower() for c in word)
            return "".join(a if a not in "?" + LOST else b.upper() if upper else b for a, b in zip(word, known, strict=True))
    return None


def repair(text: str, model: PairModel, cost: dict[tuple[str, str], float]) -> tuple[str, bool]:
    """``text`` with its garbled parts restored where they can be told, and whether any part is garbled."""
    if not _SUSPECT.search(text):
        return text, False
    odd: set[int] = set()
    for a, b in improbable_runs(text, model, cost):
        odd.update(range(a, b))
    if not odd:
        return text, False
    garbled = any(text[i] == LOST for i in odd)
    lost: dict[int, str] = {}
    if LOST in text or "?" in text:
        for m in _HOLED.finditer(text):
            w = m.group()
            holes = [k for k, c in enumerate(w) if c in "?" + LOST and m.start() + k in odd]
            if holes and len(w) > len(holes) and (known := _spelt(w, model)):
                lost.update((m.start() + k, known[k]) for k in holes)
    if "\xa0" in text:
        # A no-break space is what one table shows for á: only inside what is then a known word.
        for m in _SPACED.finditer(text):
            w = m.group().replace("\xa0", "á")
            if m.start() + m.group().index("\xa0") in odd and any(known == w.lower() and k >= 3 for k, known in model.words.get(_BLANKED.sub("_", w.lower()), ())):
                lost[m.start() + m.group().index("\xa0")] = "á"
    floor = math.log2((2.5 + 2e-7 * model.total) / (model.total + 1))
    out: list[str] = []
    i, n = 0, len(text)
    while i < n:
        ch = text[i]
        if i not in odd or ch.isascii() and ch != "?":
            out.append(ch)
            i += 1
            continue
        before = out[-1][-1] if out else "\n"
        if ch.isascii() or ch == LOST:
            made, used = None, 1
        else:
            made, used = _several(text, i, before, model)
            used = max(1, used)
        if made is None:
            after = text[i + 1] if i + 1 < n else "\n"
            if i in lost:
                made = lost[i]
            else:
                made = _one(ch, before, after, model, floor)
            if made is None and ch == "?" and before.isalpha() and after.isalpha():
                garbled = True  # a mark inside a word: the letter is lost
        if made is None:
            out.append(ch)
            i += 1
        else:
            out.append(made)
            garbled = True
            i += used
    return "".join(out), garbled


def restored(texts: pa.Array, model: PairModel | None, cost: dict[tuple[str, str], float], known: dict[str, str]) -> pa.Array:
    """A batch of texts with their garbled parts restored; those on which no mapping can act are passed over at once.
    ``known`` remembers texts of ordinary length."""
    if model is None:
        return texts
    suspect = pc.fill_null(pc.match_substring_regex(texts, SUSPECT), False)
    changed = []
    for t in texts.filter(suspect).to_pylist():
        if (got := known.get(t)) is None:
            if len(known) > 20_000:
                known.clear()
            got = repair(t, model, cost)[0]
            if len(t) <= 2_000:
                known[t] = got
        changed.append(got)
    return pc.replace_with_mask(texts, suspect, pa.array(changed, texts.type)) if changed else texts


def _several(text: str, i: int, before: str, model: PairModel) -> tuple[str | None, int]:
    """What a stretch from ``i`` on is as UTF-8 that was wrongly shown, the longest stretch first, and its length."""
    for size in range(min(14, len(text) - i), 1, -1):
        chunk = text[i : i + size]
        if chunk[1].isascii():
            continue
        one = _unwrap(chunk)
        if one is not None:
            after = text[i + size] if i + size < len(text) else "\n"
            if _gain(model, before, chunk, one, after) >= GAIN_UTF8:
                return one, size
    for half, options in HALF.items():
        if text.startswith(half, i):
            after = text[i + len(half)] if i + len(half) < len(text) else "\n"
            choice = _best(half, options, GAIN_LOST, before, after, model, math.log2((2.5 + 2e-7 * model.total) / (model.total + 1)))
            if choice is not None:
                return choice, len(half)
    return None, 0


def _one(ch: str, before: str, after: str, model: PairModel, floor: float) -> str | None:
    """What a single character is, if another encoding was taken for its own or it stands for a lost one."""
    if ch == LOST:
        return _best(ch, LETTERS + SIGNS, -math.inf, before, after, model, floor)
    if ch == "?":
        return _best(ch, LETTERS + "¿“”\xa0", GAIN_LOST, before, after, model, floor)
    return _best(ch, _singles(ch), GAIN_SINGLE, before, after, model, floor)


def _best(old: str, options: str | tuple[str, ...], need: float, before: str, after: str, model: PairModel, floor: float) -> str | None:
    best, choice = -math.inf, None
    for new in options:
        if new in LETTERS and not (before.isalpha() or after.isalpha() or after in LOST + "?"):
            continue
        if new in LETTERS and not _fits_case(new, before, after):
            continue
        one, two = model.bits(before, new), model.bits(new, after)
        if min(one, two) < floor and after != LOST and before != LOST:
            continue
        likely = one + two - math.log2((model.left.get(model.symbol(new), 0) + 1) / (model.total + 1))
        if _gain(model, before, old, new, after) >= need and likely > best:
            best, choice = likely, new
    return choice


@lru_cache(maxsize=1 << 16)
def _unwrap(chunk: str) -> str | None:
    """The text that ``chunk`` is after all layers of wrong reading; None if it is none."""
    for one in _decoded(chunk):
        if len(one) == 1 or all(unicodedata.category(c)[0] == "L" or c in SIGNS for c in one):
            again = _unwrap(one) if len(one) > 1 else None
            if again is not None:
                return again
            if len(one) == 1 and (one < "\u0180" or "\u2000" <= one < "\u2300"):
                return one
        else:
            again = _unwrap(one)
            if again is not None:
                return again
    return None


def find_garbled(docs: DataFrame, key: str, columns: list[str], model: PairModel | None = None) -> DataFrame:
    """``key, field, garbled, restored`` of every garbled value of ``columns``, ``restored`` as far as it can be told.

    NULL, empty and blank values are never garbled. Repeated rows give repeated results. Very long values are scanned whole
    in linear time. Other columns are ignored.
    """
    model = model or pair_counts(docs, columns)
    key_type = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost: dict[tuple[str, str], float] = {}
        known: dict[str, tuple[str, bool]] = {}
        for b in batches:
            rows, fields, old, new = [], [], [], []
            for name, column in zip(columns, b.columns[1:], strict=True):
                # Values on which no mapping can act are passed over, a batch at a time.
                at = pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(column, SUSPECT), False))
                for i, t in zip(at.to_pylist(), column.take(at).to_pylist(), strict=True):
                    if (got := known.get(t)) is None:
                        if len(known) > 20_000 or len(t) > 2_000:
                            known.clear()
                        got = known[t] = repair(t, model, cost)
                    if got[1]:
                        rows.append(i)
                        fields.append(name)
                        old.append(t)
                        new.append(got[0])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(fields, pa.string()), pa.array(old, pa.string()), pa.array(new, pa.string())],
                names=["k", "field", "garbled", "restored"],
            )

    found = spread(docs.select(F.col(key).alias("k"), *[F.col(c) for c in columns])).mapInArrow(scan, f"k {key_type}, field string, garbled string, restored string")
    return found.select(F.col("k").alias(key), "field", "garbled", "restored")
