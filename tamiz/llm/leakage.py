"""Evaluation passages inside a training corpus.

A positional inverted index of the corpus is stored once: in segments of neighbouring documents, each with its tokens, their
document frequencies and, token by token, the documents and places where they stand. Building it is one pass without a
shuffle; a frequent token is spread over the segments. A segment is searched on its own. The rarest tokens of every window of
a test passage, by document frequency in the whole corpus and only such as the corpus has, are looked up; their lists are
shifted by the token's place in the passage and intersected, and where they meet the stretch of the document is told from
the positions of all tokens of the passage: as an exact phrase, or as a near one in which an occasional word was changed,
left out or added. Short quotes and passages of like wording about other names and figures are told apart by the same
positions. The corpus is tokenised once however many passages there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.words import cased_words, faces, told_words, word_arrays
from tamiz.session import spread, staged

#: Consecutive words that make a leak, and equal words that must stand against each edit.
RUN, EQUAL = 12, 4
#: Most bytes of text and most documents of a segment; a single longer text is a segment of its own.
SEGMENT_BYTES, SEGMENT_DOCS = 1 << 22, 1 << 16
#: Most words of test passages that a search holds at once; larger sets take another pass over the index.
BLOCK_WORDS = 200_000
#: Words of a passage that are compared at once; a longer one is compared in stretches of so many that overlap by half.
STRETCH = 96
#: Hits and cells that a search holds at once within a segment.
MOST_HITS, MOST_CELLS = 1 << 22, 1 << 20


def most_edits(words: int) -> int:
    """Edits that a chain over ``words`` words of a passage may hold."""
    return words // (EQUAL + 1)


def seeds_per_window(run: int) -> int:
    """Seeds of each window of ``run`` words that leave at least two of them in some window of every allowed chain.

    A chain of fewer than twice ``run`` words loses at most ``most_edits(2 * run - 1)`` of them, all of which may be seeds of
    all its windows; a longer one has windows apart from each other, of which the best loses fewer.
    """
    return min(run, 2 + most_edits(2 * run - 1))


def index_schema(key_type: T.DataType) -> T.StructType:
    """A row is a segment: ``keys`` of its documents and their ``lengths`` in words; ``tokens`` with ``frequencies``
    (documents); per token from ``starts`` the packed ``docs``, ``places`` and ``facing`` (names and figures) of its occurrences."""
    packed = [T.StructField(c, T.BinaryType()) for c in ("lengths", "starts", "docs", "places", "facing")]
    return T.StructType([
        T.StructField("segment", T.LongType()), T.StructField("keys", T.ArrayType(key_type)), T.StructField("tokens", T.ArrayType(T.StringType())),
        T.StructField("frequencies", T.ArrayType(T.IntegerType())), *packed,
    ])


def _stretches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``SEGMENT_BYTES`` and ``SEGMENT_DOCS``."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, before = 0, 0
    while start < len(size):
        end = int(np.searchsorted(size, before + SEGMENT_BYTES, side="right"))
        end = min(max(end, start + 1), start + SEGMENT_DOCS, len(size))
        yield start, end
        start, before = end, int(size[end - 1])


def positional_index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The index of a corpus (see :func:`index_schema`), all of its tokens. NULL texts are left out."""
    schema = index_schema(docs.schema[key].dataType)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for start, end in _stretches(b.column(1)):
                part = b.slice(start, end - start)
                tokens, code, doc, facing = word_arrays(part.column(1))
                n = part.num_rows
                lengths = np.bincount(doc, minlength=n).astype(np.int32)
                place = (np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
                order = np.argsort(code, kind="stable")
                code, doc, place, facing = code[order], doc[order].astype(np.uint16), place[order], facing[order]
                starts = np.searchsorted(code, np.arange(len(tokens) + 1)).astype(np.int64)
                first = np.ones(len(code), dtype=np.int32)
                first[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
                held = np.add.reduceat(first, starts[:-1]) if len(tokens) else first
                packed = [x.tobytes() for x in (lengths, starts, doc, place, np.packbits(facing))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(0)), pa.array([tokens], pa.list_(pa.string())),
                        pa.array([held.tolist()], pa.list_(pa.int32())), *[pa.array([x], pa.binary()) for x in packed],
                    ],
                    names=schema.names,
                )
                number += 1

    return spread(docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t IS NOT NULL")).mapInArrow(build, schema)


class Segment:
    """A segment of the index, unpacked."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        def of(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(batch.column(name)[row].as_py(), dtype=kind)

        self.keys, self.tokens = batch.column("keys")[row].values, batch.column("tokens")[row].values
        self.lengths, self.starts, self.docs, self.places = of("lengths", np.int32), of("starts", np.int64), of("docs", np.uint16), of("places", np.int32)
        self.facing = np.unpackbits(of("facing", np.uint8), count=len(self.docs)).astype(bool)
        #: Where each document's first word stands in :meth:`in_order`.
        self.offsets = (np.cumsum(self.lengths, dtype=np.int64) - self.lengths + np.arange(1, len(self.lengths) + 1)).astype(np.int32 if len(self.docs) < 1 << 30 else np.int64)

    def in_order(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens by document and place, and whether they look like names or figures: the postings turned around. A place
        without a token stands before and after each document."""
        at = self.offsets[self.docs] + self.places
        size = len(at) + len(self.lengths) + 1
        code, facing = np.full(size, -2, dtype=np.int32), np.zeros(size, dtype=bool)
        code[at] = np.repeat(np.arange(len(self.tokens), dtype=np.int32), np.diff(self.starts))
        facing[at] = self.facing
        return code, facing


def postings(index: DataFrame) -> DataFrame:
    """The index as rows ``token, doc, at``."""
    key_type = index.schema["keys"].dataType.elementType

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                s = Segment(b, i)
                codes = np.repeat(np.arange(len(s.tokens)), np.diff(s.starts))
                yield pa.RecordBatch.from_arrays([s.tokens.take(pa.array(codes)), s.keys.take(pa.array(s.docs.astype(np.int64))), pa.array(s.places)], names=["token", "doc", "at"])

    return index.mapInArrow(unpack, T.StructType([T.StructField("token", T.StringType()), T.StructField("doc", key_type), T.StructField("at", T.IntegerType())]))


def document_frequencies(index: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Number of documents that hold each token of ``vocabulary``, from the whole index."""
    wanted = index.sparkSession.createDataFrame([(v,) for v in vocabulary], "token string")
    held = index.select(F.explode(F.arrays_zip("tokens", "frequencies")).alias("t")).select(F.col("t.tokens").alias("token"), F.col("t.frequencies").alias("n"))
    return {r["token"]: r["n"] for r in held.join(F.broadcast(wanted), "token", "left_semi").groupBy("token").agg(F.sum("n").alias("n")).collect()}


def seed_positions(passage: list[str], frequency: dict[str, int], run: int = RUN) -> set[int]:
    """Positions of the rarest tokens of every window of ``run`` words, of those that the corpus has at all."""
    found: set[int] = set()
    held = [(frequency[w], i) for i, w in enumerate(passage) if frequency.get(w)]
    for start in range(max(1, len(passage) - run + 1)):
        found.update(i for _, i in sorted(x for x in held if start <= x[1] < start + run)[: seeds_per_window(run)])
    return found


def aligned(doc: list, facing: list[bool], item: list, telling: list[bool], run: int = RUN) -> bool:
    """True if ``doc`` holds ``run`` consecutive words of ``item``, allowing for an occasional edit.

    ``facing``: which words of the document look like names or figures; ``telling``: which words of the item are such.
    Stretches of equal words are chained over gaps of at most two words on either side; a gap where a telling word of the
    item faces a name or figure ends the chain. A chain counts if it covers ``run`` words of the item, begins and ends with at
    least two equal words, holds at most one edit for every four equal words, and at least two telling words kept for each lost.
    """
    blocks = [b for b in SequenceMatcher(None, item, doc, autojunk=False).get_matching_blocks() if b.size]
    kept = [sum(telling[b.a : b.a + b.size]) for b in blocks]
    linked, edits, lost = [], [], []
    for one, two in zip(blocks, blocks[1:], strict=False):
        a, b = range(one.a + one.size, two.a), range(one.b + one.size, two.b)
        gone = sum(telling[i] for i in a)
        linked.append(len(a) <= 2 and len(b) <= 2 and not (gone and any(facing[i] for i in b)))
        edits.append(max(len(a), len(b)))
        lost.append(gone)
    for i, first in enumerate(blocks):
        if first.size < 2:
            continue
        equal, edited, held, gone = 0, 0, 0, 0
        for j in range(i, len(blocks)):
            if j > i:
                if not linked[j - 1]:
                    break
                edited += edits[j - 1]
                gone += lost[j - 1]
            last = blocks[j]
            equal += last.size
            held += kept[j]
            if last.size >= 2 and last.a + last.size - first.a >= run and EQUAL * edited <= equal and held >= 2 * gone:
                return True
    return False


def holds_passage(doc: list[str], item: list[tuple[str, bool]], run: int = RUN) -> bool:
    """:func:`aligned` for a document's cased words and an item's words, each with whether it is telling."""
    return aligned([w.casefold() for w in doc], [faces(w) for w in doc], [w.casefold() for w, _ in item], [t for _, t in item], run)


class Passages:
    """A block of test passages, ready to be looked up in segments."""

    def __init__(self, block: list[tuple[list[str], list[bool]]], run: int):
        self.run, self.telling = run, [t for _, t in block]
        numbers: dict[str, int] = {}
        self.codes = [np.array([numbers.setdefault(w, len(numbers)) for w in ws], dtype=np.int32) for ws, _ in block]
        self.vocabulary = list(numbers)
        self.folded = [ws for ws, _ in block]

    def seed(self, frequency: dict[str, int]) -> None:
        """Chooses what is looked up of each passage, by document frequency."""
        found = [(self.codes[i][p], i, p) for i, ws in enumerate(self.folded) for p in sorted(seed_positions(ws, frequency, self.run))]
        self.seeds = np.array(found, dtype=np.int64).reshape(-1, 3)
        width = max((len(c) for c in self.codes), default=0)
        self.padded = np.full((len(self.codes), width), -1, dtype=np.int32)
        self.told = np.zeros((len(self.codes), width), dtype=bool)
        for i, (c, t) in enumerate(zip(self.codes, self.telling, strict=True)):
            self.padded[i, : len(c)], self.told[i, : len(c)] = c, t

    def search(self, s: Segment) -> Iterator[tuple[int, int]]:
        """``(document, item)`` numbers of the leaks of a segment."""
        local = pc.fill_null(pc.index_in(pa.array(self.vocabulary, pa.string()), value_set=s.tokens), -1).to_numpy(zero_copy_only=False)
        token, item, place = self.seeds.T
        code = local[token] if len(token) else token
        have = code >= 0
        code, item, place = code[have], item[have], place[have]
        if not len(code):
            return
        sizes = s.starts[code + 1] - s.starts[code]
        # Passages are taken together as long as their hits fit; the seeds are in order of passage.
        total = np.cumsum(sizes)
        group = np.maximum.accumulate((total - 1) // MOST_HITS)
        group = group[np.searchsorted(item, item, side="left")] if len(item) else group
        order: tuple[np.ndarray, np.ndarray] | None = None
        for g in np.unique(group):
            m = group == g
            candidates = self._intersected(s, code[m], item[m], place[m], sizes[m])
            if len(candidates[0]):
                order = order or s.in_order()
                yield from self._told_apart(s, local, order, *candidates)

    def _intersected(self, s: Segment, code: np.ndarray, item: np.ndarray, place: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """``item, doc, low, high``: where at least two seeds of a passage stand as far apart as in it, but for edits."""
        start = np.repeat(s.starts[code] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        at = np.repeat(place, sizes)
        offset = s.places[start] - at
        item, doc = np.repeat(item, sizes), s.docs[start].astype(np.int64)
        order = np.lexsort((offset, doc, item))
        item, doc, offset, at = item[order], doc[order], offset[order], at[order]
        fresh = np.ones(len(item), dtype=bool)
        fresh[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (offset[1:] - offset[:-1] > most_edits(2 * self.run - 1))
        first = np.flatnonzero(fresh)
        several = np.minimum.reduceat(at, first) != np.maximum.reduceat(at, first)
        last = np.append(first[1:], len(item)) - 1
        return item[first][several], doc[first][several], offset[first][several], offset[last][several]

    def _told_apart(self, s: Segment, local: np.ndarray, order: tuple[np.ndarray, np.ndarray], item: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, int]]:
        tokens, facing = order
        length = np.array([len(c) for c in self.codes])
        # A band of offsets around each meeting place, as wide as the edits of a whole passage; wider ranges take several.
        band = most_edits(length[item]) + 1
        steps = (high - low) // band + 1
        base = np.repeat(low, steps) + (np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)) * np.repeat(band, steps)
        item, doc, band = np.repeat(item, steps), np.repeat(doc, steps), np.repeat(band, steps)
        done: set[tuple[int, int]] = set()
        # Passages of like length share an array.
        for size in np.unique(np.ceil(length[item] / 16).astype(int)) * 16:
            own = np.flatnonzero(np.ceil(length[item] / 16).astype(int) * 16 == size)
            wide, width = int(band[own].max()), min(size, self.padded.shape[1])
            step = max(1, MOST_CELLS // ((2 * wide + 1) * width))
            for k in range(0, len(own), step):
                i = own[k : k + step]
                if done:
                    i = i[~np.isin(doc[i] << 32 | item[i], np.array([d << 32 | q for d, q in done]))]
                codes = np.where(self.padded[item[i], :width] >= 0, local[self.padded[item[i], :width]], -1).astype(np.int32)
                first = s.offsets[doc[i]]
                at = (first + base[i].astype(first.dtype))[:, None, None] + np.add.outer(np.arange(-wide, wide + 1, dtype=first.dtype), np.arange(width, dtype=first.dtype))
                np.maximum(at, (first - 1)[:, None, None], out=at)
                np.minimum(at, (first + s.lengths[doc[i]])[:, None, None], out=at)
                equal = tokens[at] == codes[:, None, :]
                exact = _longest(equal) >= self.run
                possible = exact | self._possible(equal.any(axis=1), self.told[item[i], :width], self.padded[item[i], :width] >= 0)
                for j in np.flatnonzero(possible):
                    one = (int(doc[i[j]]), int(item[i[j]]))
                    if one in done:
                        continue
                    if exact[j] or self._near(s, local, tokens, facing, one, int(base[i[j]]), int(band[i[j]])):
                        done.add(one)
                        yield one

    def _possible(self, equal: np.ndarray, telling: np.ndarray, filled: np.ndarray) -> np.ndarray:
        """Whether ``run`` words or more can hold few enough words, and telling ones, that are nowhere near their place."""
        words = np.where(equal, 1, np.where(filled, -EQUAL, -1_000_000))
        told = np.where(telling, np.where(equal, 1, -2), 0)
        out = np.ones(len(equal), dtype=bool)
        for score in (words, told):
            sums = np.concatenate([np.zeros((len(score), 1), dtype=np.int64), np.cumsum(score, axis=1)], axis=1)
            least = np.minimum.accumulate(sums[:, : -self.run], axis=1)
            out &= (sums[:, self.run :] >= least).any(axis=1)
        return out

    def _near(self, s: Segment, local: np.ndarray, tokens: np.ndarray, facing: np.ndarray, one: tuple[int, int], base: int, band: int) -> bool:
        doc, item = one
        start = int(s.offsets[doc])
        a, b = start + max(0, base - band), start + min(int(s.lengths[doc]), base + len(self.codes[item]) + band)
        own = local[self.codes[item]]
        return aligned(tokens[a:b].tolist(), facing[a:b].tolist(), np.where(own >= 0, own, -1).tolist(), self.telling[item], self.run)


def _longest(equal: np.ndarray) -> np.ndarray:
    """Longest run of equal words on one offset, for each candidate of ``(candidates, offsets, places)``."""
    run = np.zeros(equal.shape[:2], dtype=np.int16 if equal.shape[2] < 30_000 else np.int32)
    best = np.zeros(len(equal), dtype=run.dtype)
    for p in range(equal.shape[2]):
        run = (run + 1) * equal[:, :, p]
        np.maximum(best, run.max(axis=1), out=best)
    return best


def find_leaks(docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str, item_text: str, run: int = RUN, index: DataFrame | None = None) -> DataFrame:
    """``key, item_key`` of every document that holds ``run`` words of a passage of ``items`` (see :func:`aligned`, for a
    passage of more than ``STRETCH`` words in one of its stretches).

    NULL, empty and blank texts and passages shorter than ``run`` words match nothing; repeated rows give repeated
    results only where ``key`` repeats. ``index``: a stored :func:`positional_index` of ``docs``, else one is made. The
    passages are read to the driver block by block (``BLOCK_WORDS``); the corpus is not.
    """
    if run < 6:
        raise ValueError("a leak is at least six words")
    out: DataFrame | None = None
    block: list[tuple[object, list[list[tuple[str, bool]]]]] = []
    size = 0
    if index is None:
        index = staged(positional_index(docs, key, text), "positional-index")
    for one in ((r[0], told_words(r[1])) for r in items.select(item_key, item_text).toLocalIterator()):
        if len(one[1]) >= run:
            block.append((one[0], stretches(one[1])))
            size += len(one[1])
        if size >= BLOCK_WORDS:
            found = _find_block(index, block, items, key, item_key, run)
            out = found if out is None else out.unionByName(found)
            block, size = [], 0
    if block or out is None:
        found = _find_block(index, block, items, key, item_key, run)
        out = found if out is None else out.unionByName(found)
    return out


def stretches(words: list) -> list[list]:
    """``words`` in overlapping stretches of at most ``STRETCH``."""
    return [words[a : a + STRETCH] for a in range(0, max(1, len(words) - STRETCH // 2), STRETCH // 2)]


def _find_block(index: DataFrame, block: list[tuple[object, list[list[tuple[str, bool]]]]], items: DataFrame, key: str, item_key: str, run: int) -> DataFrame:
    passages = Passages([([w.casefold() for w, _ in ws], [t for _, t in ws]) for _, parts in block for ws in parts], run)
    owner = [k for k, (_, parts) in enumerate(block) for _ in parts]
    passages.seed(document_frequencies(index, passages.vocabulary) if passages.vocabulary else {})
    names = pa.array([i for i, _ in block])
    key_type, item_type = index.schema["keys"].dataType.elementType, items.schema[item_key].dataType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                s = Segment(b, row)
                found = {(d, owner[i]) for d, i in passages.search(s)}
                if found:
                    doc, item = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([s.keys.take(doc), names.take(item)], names=["doc", "item"])

    found = spread(index).mapInArrow(search, T.StructType([T.StructField("doc", key_type), T.StructField("item", item_type)]))
    return found.select(F.col("doc").alias(key), F.col("item").alias(item_key))
