"""Texts cut off by field limits or lost in transfer.

No labels are needed: intact texts of a bounded sample are cut artificially, at their source's length limit or at random
places inside a word or sentence, with and without the marks that viewers leave. A logistic regression on hashed features
of the closing characters, words and last line, of punctuation and of the length against the source's limits is trained on
both; intact examples that models trained on other folds take for cut are then left out and it is trained again. It scores
every record. Limits are lengths, in characters or bytes, at which a source has far more texts than around them.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.session import spread

#: Dimensions of the hashed features.
WIDTH = 1 << 16
#: Most texts of the training sample.
SAMPLE = 20_000
#: Folds and rounds in which intact examples are doubted.
FOLDS, ROUNDS = 3, 3
#: Closing characters that are looked at.
TAIL = 240
#: Most length limits kept (a row each); more would mean that lengths are no limits at all.
MOST_LIMITS = 10_000
#: Marks and residue left where a text was cut: fixed values.
MARKS = ["...", "…", " [...]", "[…]", " …", "… (ver más)", "…leer más", " (continúa)", "�", "  ", "\n", "<", "<p", "</", "</div>", "&", "&nb"]

_WORDS = re.compile(r"\S+")
_NINE = re.compile(r"\d")
_NAME = re.compile(r"[^\W\d_]+")
_END = re.compile(r"""(?<![.…])[.!?][)\]»”"'’]*(?:\s*</?\w+[^<>]*>)*\s*\Z""")


def length_limits(docs: DataFrame, source: str, text: str) -> dict[str, list[tuple[str, int]]]:
    """Length limits of each source, as ``{source: [(unit, length), ...]}``, unit ``c`` (characters) or ``b`` (UTF-8 bytes).

    A limit is a length that at least eight texts have and that is twelve times as frequent as the lengths within 25 of it
    are on the mean. Counted over all texts, copies of a text in a source once; the source NULL is ``''``.
    """
    once = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.length(text).alias("c"), F.octet_length(text).alias("b"), F.xxhash64(text).alias("h")
    ).distinct()
    lengths = once.select("source", F.explode(F.array(F.struct(F.lit("c").alias("unit"), F.col("c").alias("n")), F.struct(F.lit("b").alias("unit"), F.col("b").alias("n")))).alias("u"))
    counts = lengths.groupBy("source", F.col("u.unit").alias("unit"), F.col("u.n").alias("n")).agg(F.count(F.lit(1)).alias("k"))
    near = Window.partitionBy("source", "unit").orderBy("n").rangeBetween(-25, 25)
    spikes = counts.where("n >= 32").withColumn("around", F.sum("k").over(near) - F.col("k")).where("k >= 8 AND k > 12 * around / 50")
    found = spikes.select("source", "unit", "n").limit(MOST_LIMITS + 1).collect()
    if len(found) > MOST_LIMITS:
        raise ValueError("more length limits than lengths can be; is the source column a key?")
    out: dict[str, list[tuple[str, int]]] = {}
    for r in found:
        out.setdefault(r["source"], []).append((r["unit"], r["n"]))
    return {s: sorted(v) for s, v in out.items()}


def at_limit(chars: int, size: int, limits: list[tuple[str, int]]) -> bool:
    """True if a text of this length stops at a limit; one in bytes may fall up to three bytes short of it (a split character)."""
    return any(chars == n if unit == "c" else n - 3 <= size <= n for unit, n in limits)


def features(tail: str, limited: bool, has_limit: bool) -> np.ndarray:
    """Hashed features of a text's closing characters."""
    body = tail.rstrip()
    line = _NINE.sub("9", body[body.rfind("\n") + 1 :])
    words = [w.casefold() for w in _WORDS.findall(line)]
    before = [w.casefold() for w in _WORDS.findall(_NINE.sub("9", body))][-3:]
    last = before[-1] if before else ""
    shape = "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in body[-4:])
    ended = bool(_END.search(tail))
    first = words[0] if words else ""
    alone = "\n" in body and len(words) <= 12
    opener = f"{first}|{min(len(words), 13)}|{alone}"
    kind = "d" if shape[-1:] == "9" else "l" if shape[-1:] in ("a", "A") else shape[-1:]
    pad = "s" if tail != body and not tail.endswith("\n\n") else ""
    facts = [
        "bias", f"end={ended}", f"lim={limited}", f"end,lim={ended},{limited}", f"end,has={ended},{has_limit}", f"c1={shape[-1:]}", f"c2={shape[-2:]}",
        f"c4={shape}", f"x1={body[-1:]}", f"x3={body[-3:].casefold()}", f"w1={last}", f"w2={' '.join(before[-2:])}",
        f"kind={kind}", f"kind,alone={kind},{alone}", f"open={opener}", f"open,kind={opener},{kind}", f"open,w1={first},{last},{alone}", f"pad={pad},{ended}",
        f"line={line.casefold() if len(line) <= 60 else ''},{alone}", f"lim,kind={limited},{kind}", f"shape={_NAME.sub('a', line[-14:])}",
        f"dots={'…' in body[-16:] or '...' in body[-16:]},{shape[-1:] in '.…])'}",
    ]
    return np.array([zlib.crc32(f.encode()) % WIDTH for f in facts], dtype=np.int32)


def cut_artificially(text: str, limits: list[tuple[str, int]], rng: random.Random) -> tuple[str, bool] | None:
    """A cut version of ``text`` and whether it stops at a limit; None where no cut inside a word or sentence was found."""
    for _ in range(8):
        fitting = [(u, n) for u, n in limits if (len(text) if u == "c" else len(text.encode())) > n]
        limited = bool(fitting) and rng.random() < 0.5
        if limited:
            unit, n = rng.choice(fitting)
            cut = text[:n] if unit == "c" else text.encode()[:n].decode(errors="ignore")
        elif len(text) < 12:
            return None
        else:
            cut = text[: rng.randint(max(8, len(text) // 10), len(text) - 1)]
        rest = text[len(cut) :]
        if _END.search(cut) or not rest.strip() or rest.startswith("\n") or not cut.strip():
            continue
        if not limited and rng.random() < 0.5:
            if rng.random() < 0.6 and " " in cut[8:]:
                cut = cut[: cut.rindex(" ", 8)]
                if _END.search(cut):
                    continue
            if rng.random() < 0.75:
                cut += rng.choice(MARKS)
        return cut, limited
    return None


def fit(examples: np.ndarray, labels: np.ndarray, rounds: int = 120, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression on rows of hashed feature indices, by full-batch Adam."""
    weights, m, v = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH)
    share = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    flat = examples.ravel()
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(weights[examples].sum(1), -30, 30)))
        g = np.bincount(flat, weights=np.repeat((p - labels) * share, examples.shape[1]), minlength=WIDTH) + ridge * weights
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        weights -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return weights


def _least_hashes(rows: DataFrame, sample: int) -> int:
    """The hash up to which ``h`` of ``rows`` has at most ``sample`` distinct values, nearly as many if there are more.

    A first pass estimates how many there are; a second collects a share of the hashes, little more than ``sample``.
    """
    top = (1 << 63) - 1
    seen = rows.agg(F.approx_count_distinct("h", 0.02).alias("n")).first()["n"]
    share = 1.2 * sample / max(1, seen)
    below = rows if share >= 1 else rows.where(F.col("h") < int(-top + 2 * top * share))
    found = sorted(r["h"] for r in below.select("h").distinct().limit(2 * sample).collect())
    return found[sample - 1] if len(found) >= sample else found[-1] if found else top


def train(docs: DataFrame, key: str, text: str, source: str, limits: dict[str, list[tuple[str, int]]], sample: int = SAMPLE) -> np.ndarray:
    """Weights trained on at most ``sample`` texts, those with the least hash, each as it is and cut artificially twice.

    Texts are cut where they are; only features leave their task. The models of a round are fitted by tasks of their own.
    """
    spark = docs.sparkSession
    rows = docs.where(F.length(F.trim(F.col(text))) >= 12).select(
        F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("h"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("s"), F.col(text).alias("t")
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            hashes, examples, labels, folds = [], [], [], []
            for h, s, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if h in seen:
                    continue
                seen.add(h)
                own, rng = limits.get(s, []), random.Random(h)
                fold = zlib.crc32(t[-120:].encode()) % FOLDS
                limited = at_limit(len(t), len(t.encode()), own)
                made = [(t, limited, 0)] if not limited or _END.search(t) else []  # what stops at a limit inside a sentence is no intact example
                made += [(*cut, 1) for cut in (cut_artificially(t, own, rng) for _ in range(2)) if cut]
                for tail, at, label in made:
                    hashes.append(h)
                    examples.append(features(tail[-TAIL:], at, bool(own)).tolist())
                    labels.append(label)
                    folds.append(fold)
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(examples, pa.list_(pa.int32())), pa.array(labels, pa.int32()), pa.array(folds, pa.int32())], names=["h", "x", "y", "fold"])

    chosen = rows.where(F.col("h") <= _least_hashes(rows, sample))
    # Copies of a row give the same examples; those of one task stand in a group.
    made = spread(chosen).mapInArrow(make, "h bigint, x array<int>, y int, fold int").distinct().toPandas().sort_values(["h", "y", "fold"], kind="stable")
    if made.empty:
        return np.zeros(WIDTH)
    fold, y = made["fold"].to_numpy(), made["y"].to_numpy().astype(float)
    shared = spark.sparkContext.broadcast((np.array(made["x"].tolist(), dtype=np.int32), y, fold))
    # An intact example is doubted by models that have not seen its closing characters, else a cut text hides by being known.
    keep = np.ones(len(y), dtype=bool)
    for _ in range(ROUNDS):
        doubted = np.zeros(len(y), dtype=bool)
        for k, said in _fitted(spark, shared, keep, range(FOLDS)).items():
            doubted[fold == k] = np.frombuffer(said, dtype=bool)
        keep = (y == 1) | ~doubted
    weights = np.frombuffer(_fitted(spark, shared, keep, range(FOLDS, FOLDS + 1))[FOLDS])
    shared.unpersist()
    return weights


def _fitted(spark: SparkSession, shared: Broadcast, keep: np.ndarray, folds: range) -> dict[int, bytes]:
    """A model for each of ``folds``, fitted without it by a task of its own: what it takes for cut in it, or for a fold that
    no example has, its weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, fold = shared.value
        for b in batches:
            for k in b.column(0).to_pylist():
                out = fold == k
                weights = fit(x[keep & ~out], y[keep & ~out]) if (keep & ~out).any() else np.zeros(WIDTH)
                said = (weights[x[out]].sum(1) > 0).tobytes() if k < FOLDS else weights.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([said], pa.binary())], names=["k", "said"])

    rows = spark.range(folds.start, folds.stop, 1, len(folds)).mapInArrow(run, "k bigint, said binary").collect()
    return {r["k"]: bytes(r["said"]) for r in rows}


def score_truncation(docs: DataFrame, key: str, text: str, source: str, sample: int = SAMPLE) -> DataFrame:
    """``key, source, p_cut, is_cut`` of every row: the probability that its text was cut off.

    NULL, empty and blank texts get 0. Repeated rows get equal scores. A table without a text long enough to be cut
    artificially gives 0 everywhere. Other columns are ignored.
    """
    limits = length_limits(docs, source, text)
    weights = train(docs, key, text, source, limits, sample)
    trained = bool(weights.any())
    rows = docs.select(
        F.col(key).alias("k"), F.col(source).alias("s"), F.substring(F.col(text), -TAIL, TAIL).alias("tail"), F.length(text).alias("c"), F.octet_length(text).alias("b")
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = []
            for s, tail, c, size in zip(*(b.column(i).to_pylist() for i in range(1, 5)), strict=True):
                if not trained or tail is None or not tail.strip():
                    p.append(0.0)
                    continue
                own = limits.get("" if s is None else str(s), [])
                z = float(weights[features(tail, at_limit(c, size, own), bool(own))].sum())
                p.append(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p, pa.float64())], names=["k", "s", "p"])

    schema = f"k {docs.schema[key].dataType.simpleString()}, s {docs.schema[source].dataType.simpleString()}, p double"
    scored = spread(rows).mapInArrow(score, schema)
    return scored.select(F.col("k").alias(key), F.col("s").alias(source), F.col("p").alias("p_cut"), (F.col("p") > 0.5).alias("is_cut"))


def truncation_rates(scored: DataFrame, source: str) -> DataFrame:
    """``source, documents, cut, share`` of each source."""
    return scored.groupBy(source).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.col("is_cut").cast("bigint")).alias("cut"), F.avg(F.col("is_cut").cast("double")).alias("share")
    )
