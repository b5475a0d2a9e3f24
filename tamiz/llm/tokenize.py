"""Encoding of a corpus with a public byte-level BPE.

Texts of ordinary length are encoded whole, in Arrow batches. A long text is cut where the tokenizer's own splitting
pattern must cut it, and the parts travel to different tasks; a part that the pattern cannot split (a run of letters, of
digits, of spaces, ...) is halved again and again, its halves are encoded in parallel as rows of their own, and the
encodings are joined pairwise as a tree: around each join a growing window is encoded anew until its outermost tokens
equal those that both sides already have. A byte-pair encoding is fixed by its neighbouring pairs, so the joined
sequence then equals the encoding of the whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.session import spread

DEFAULT_FOLDER = "/opt/tokenizers"
#: Longest text, in characters, that one row encodes at once.
WHOLE = 1 << 16
#: Longest unsplit part, in characters, that is encoded without halving.
HALF = 1 << 13
#: Splitting pattern of the vocabulary, a fixed value published with it.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_loaded: dict[tuple[str, str], object] = {}


def encoding(name: str = "byte_bpe_50k", folder: str = DEFAULT_FOLDER):
    """The encoder of a ``.tiktoken`` vocabulary file, loaded once per Python worker."""
    key = (name, folder)
    if key not in _loaded:
        import tiktoken

        with open(f"{folder}/{name}.tiktoken", "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _loaded[key] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[key]


def _kind(ch: str) -> str:
    if ch.isspace() or ch in "\x1c\x1d\x1e\x1f":
        return "s"
    import unicodedata

    c = unicodedata.category(ch)[0]
    return "l" if c == "L" else "n" if c == "N" else "o"


def sure_cut(text: str, at: int) -> bool:
    """True where the pattern splits between ``text[at - 1]`` and ``text[at]`` whatever stands around them."""
    left, right = text[at - 1], text[at]
    a, b = _kind(left), _kind(right)
    if b == "s":
        return a != "s"
    if a == "s":
        return False
    return a != b and left != "'"


def cut_text(text: str, size: int) -> list[str]:
    """``text`` in parts of about ``size`` characters, cut at sure cuts only; a part without any stays whole."""
    parts, start = [], 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) and not sure_cut(text, at):
            at += 1
        if at >= len(text):
            break
        parts.append(text[start:at])
        start = at
    parts.append(text[start:])
    return parts


def halves(text: str, size: int) -> list[str]:
    """``text`` halved until no part is longer than ``size`` characters."""
    if len(text) <= size:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], size) + halves(text[middle:], size)


def join_encodings(left: list[int], right: list[int], encode_piece, token_bytes, window: int = 8) -> list[int]:
    """Encoding of the concatenation of two neighbouring stretches of one unsplit part.

    The last ``n`` tokens of ``left`` and the first ``n`` of ``right`` are encoded together anew, ``n`` growing, until the
    first token of the window is still the one ``left`` has there and the last the one ``right`` has. Each seam is then a
    pair that an encoding already holds.
    """
    if not left or not right:
        return left + right
    n = window
    while True:
        a, b = max(0, len(left) - n), min(len(right), n)
        fresh = encode_piece(b"".join(map(token_bytes, left[a:])) + b"".join(map(token_bytes, right[:b])))
        if (a == 0 or fresh[0] == left[a]) and (b == len(right) or fresh[-1] == right[b - 1]):
            return left[:a] + fresh + right[b:]
        n *= 2


def join_tree(parts: list[list[int]], encode_piece, token_bytes) -> list[int]:
    """Pairwise joins of neighbouring encodings, level by level."""
    while len(parts) > 1:
        parts = [join_encodings(parts[i], parts[i + 1], encode_piece, token_bytes) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else []


def _plan(text: str, whole: int, half: int) -> Iterator[tuple[int, int, bool, str]]:
    """``(unit, part, raw, text)`` of a long text: units are joined by concatenation, the parts of a raw unit as a tree."""
    import regex

    pattern = regex.compile(PATTERN)
    unit = 0
    for piece in cut_text(text, whole):
        if len(piece) <= 2 * whole:
            yield unit, 0, False, piece
            unit += 1
            continue
        for m in pattern.finditer(piece):
            parts = halves(m.group(), half)
            for k, part in enumerate(parts):
                yield unit, k, True, part
            unit += 1


_IDS = T.ArrayType(T.IntegerType(), True)


def encode_whole(rows: DataFrame, key: str, text: str, name: str = "byte_bpe_50k", folder: str = DEFAULT_FOLDER) -> DataFrame:
    """``key`` and ``ids`` of every row, each text encoded at once. NULL and empty texts get the empty array."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(name, folder)
        for b in batches:
            ids = [enc.encode_ordinary(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(ids, pa.list_(pa.int32()))], names=["key", "ids"])

    pair = rows.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    out = T.StructType([T.StructField("key", pair.schema["key"].dataType), T.StructField("ids", _IDS)])
    return spread(pair).mapInArrow(encode, out).select(F.col("key").alias(key), "ids")


def encode_corpus(
    rows: DataFrame, key: str, text: str, name: str = "byte_bpe_50k", folder: str = DEFAULT_FOLDER, whole: int = WHOLE, half: int = HALF
) -> DataFrame:
    """``key`` and ``ids`` (array of int) of every row: the ids of its text, without special tokens.

    NULL and empty texts get the empty array; strings that look like special tokens are ordinary text. ``key`` must be
    unique where texts are longer than ``whole``. Other columns are ignored, an empty table gives an empty result.
    """
    pair = rows.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key_type = pair.schema["key"].dataType
    out = T.StructType([T.StructField("key", key_type), T.StructField("ids", _IDS)])
    ids_arrow = pa.list_(pa.int32())

    short = encode_whole(pair.where(F.length("text") <= whole), "key", "text", name, folder)

    part_type = T.StructType(
        [T.StructField("key", key_type), T.StructField("unit", T.LongType()), T.StructField("part", T.LongType()), T.StructField("raw", T.BooleanType()), T.StructField("text", T.StringType())]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("key")
            for i, t in enumerate(b.column("text").to_pylist()):
                found = list(_plan(t, whole, half))
                if found:
                    unit, part, raw, texts = (list(x) for x in zip(*found, strict=True))
                    own = keys.take(pa.array([i] * len(found)))
                    yield pa.RecordBatch.from_arrays([own, pa.array(unit, pa.int64()), pa.array(part, pa.int64()), pa.array(raw), pa.array(texts, pa.string())], names=part_type.names)

    encoded_type = T.StructType(part_type.fields[:4] + [T.StructField("ids", _IDS)])

    def encode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(name, folder)
        for b in batches:
            texts, raws = b.column("text").to_pylist(), b.column("raw").to_pylist()
            ids = [enc._encode_single_piece(t) if r else enc.encode_ordinary(t) for t, r in zip(texts, raws, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(ids, ids_arrow)], names=encoded_type.names)

    def join(group: pa.Table) -> pa.Table:
        # All parts of one text: its size is that of one row of the result.
        enc = encoding(name, folder)
        group = group.sort_by([("unit", "ascending"), ("part", "ascending")])
        units: dict[int, list[list[int]]] = {}
        for u, ids in zip(group.column("unit").to_pylist(), group.column("ids").to_pylist(), strict=True):
            units.setdefault(u, []).append(ids)
        joined = [i for parts in units.values() for i in join_tree(parts, enc._encode_single_piece, enc.decode_single_token_bytes)]
        return pa.table({"key": group.column("key").slice(0, 1), "ids": pa.array([joined], ids_arrow)})

    parts = pair.where(F.length("text") > whole).mapInArrow(split, part_type).repartition(F.col("key"), F.col("unit"), F.col("part"))
    long = parts.mapInArrow(encode_parts, encoded_type).groupBy("key").applyInArrow(join, out)
    return short.unionByName(long).select(F.col("key").alias(key), "ids")


def token_count(ids: Column) -> Column:
    """Number of tokens of an encoded text."""
    return F.size(ids)
