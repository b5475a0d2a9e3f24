"""Subjects of documents by class-association rules.

Words and pairs of neighbouring words of labelled records are items, their subjects class items. Items that always occur
together are merged; frequent itemsets are mined by parallel frequent-pattern growth: each frequent pattern is grown by one
item at a time in the records projected on it, all patterns together and up to three items, and only towards subjects of
which it is not sure yet, since no longer pattern can be surer. Itemsets that lead to a subject are
rules, and a rule is dropped where a more general one is as sure. A record's evidence for a subject is the noisy-or of its
matching rules, those of another subject that are more specific overriding the more general; it is turned into a probability by an isotonic calibration on
records whose bills took no part in mining. Rows without a probable subject have the subject of none.
"""

from __future__ import annotations

import bisect
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.llm.encoding import PairModel, repair, restored
from tamiz.llm.words import word_arrays, words
from tamiz.session import spread, staged

#: Words that make no item: fixed values.
STOP = frozenset("de la el los las del por que con para en al y o su sus un una sobre contra entre se lo a e medio cual".split())
#: Bills that must hold an item; least confidence of a rule.
MIN_BILLS, MIN_CONFIDENCE = 2, 0.5
#: Least support of an item or itemset, as a share of the labelled records, and as a number of them.
MIN_SHARE, MIN_COUNT = 1e-4, 2
#: Least certainty of a rule: by how much of the way from the subject's share to one the items raise its confidence.
MIN_CERTAINTY = 0.4
#: Most rules, and most items that they stand for, that are held and broadcast (some 100 MB); more are an error, none is left out.
MOST_RULES, MOST_ITEMS = 200_000, 1_000_000
#: Weight, in records, of a subject's share in the estimate of a rule's confidence.
PRIOR = 2.0
#: What is mined at once: the records without each half of the bills, and all records.
VIEWS = range(3)


def text_items(texts: list[str | None]) -> list[str]:
    """Items of a record: its words, and pairs of words that follow each other when stop words are left out."""
    found: set[str] = set()
    for t in texts:
        content = [w for w in words(t) if w not in STOP and len(w) > 2 and not w[0].isdigit()]
        found.update(content)
        found.update(f"{a} {b}" for a, b in zip(content, content[1:], strict=False))
    return sorted(found)


@dataclass
class SubjectRules:
    """Rules ``(items, subject, certainty)``, what items stand for, and the calibration ``(evidence, probability)``."""

    rules: list[tuple[frozenset[str], str, float]]
    stands_for: dict[str, str]
    calibration: list[tuple[float, float]]

    def __post_init__(self) -> None:
        self.by_item: dict[str, list[int]] = defaultdict(list)
        spoken: dict[str, set[str]] = defaultdict(set)
        for item, stands in self.stands_for.items():
            spoken[stands].update(item.split())
        #: Words that each rule's items hold: a pair of words is more specific than either of them.
        self.words = [frozenset(w for i in items for w in spoken.get(i, {i})) for items, _, _ in self.rules]
        for k, (items, _, _) in enumerate(self.rules):
            self.by_item[min(items)].append(k)

    def evidence(self, items: list[str]) -> dict[str, float]:
        """Evidence for each subject that any rule points to."""
        return self.evidence_of({self.stands_for[i] for i in items if i in self.stands_for})

    def evidence_of(self, held: set[str]) -> dict[str, float]:
        """Evidence for each subject, from the items that a record's items stand for."""
        matched = [k for i in held for k in self.by_item.get(i, ()) if self.rules[k][0] <= held]
        said = {(self.words[k], self.rules[k][1]) for k in matched}
        doubt: dict[str, float] = defaultdict(lambda: 1.0)
        for k in matched:
            _, subject, sure = self.rules[k]
            if not any(self.words[k] < other for other, its in said if its != subject):
                doubt[subject] *= 1 - sure
        return {s: 1 - d for s, d in doubt.items()}

    def probability(self, evidence: float) -> float:
        if not self.calibration:
            return evidence
        k = bisect.bisect_right([e for e, _ in self.calibration], evidence) - 1
        return self.calibration[max(0, k)][1]


class ItemReader:
    """Finds, for a batch of records at once, what the items of :func:`text_items` stand for in rules."""

    def __init__(self, rules: SubjectRules):
        self.names = sorted(set(rules.stands_for.values()))
        number = {n: k for k, n in enumerate(self.names)}
        self.items = {i: number[s] for i, s in rules.stands_for.items()}
        self.paired = {w for i in self.items if " " in i for w in i.split()}

    def held(self, columns: list[pa.Array], n: int) -> list[tuple[int, ...]]:
        """Numbers into ``names`` for each of ``n`` records, whose texts are ``columns``."""
        found = [np.empty(0, dtype=np.int64)]
        width = max(1, len(self.names))
        for c in columns:
            tokens, code, doc, _ = word_arrays(c)
            content = np.array([w not in STOP and len(w) > 2 and not w[0].isdigit() for w in tokens], dtype=bool)
            kept = content[code] if len(code) else np.empty(0, dtype=bool)
            code, doc = code[kept].astype(np.int64), doc[kept]
            alone = np.array([self.items.get(w, -1) for w in tokens], dtype=np.int64)
            paired = np.array([w in self.paired for w in tokens], dtype=bool)
            if not len(code):
                continue
            one = alone[code]
            found.append(doc[one >= 0] * width + one[one >= 0])
            near = (doc[1:] == doc[:-1]) & paired[code[1:]] & paired[code[:-1]]
            pairs, back = np.unique(code[:-1][near] * len(tokens) + code[1:][near], return_inverse=True)
            two = np.array([self.items.get(f"{tokens[p // len(tokens)]} {tokens[p % len(tokens)]}", -1) for p in pairs.tolist()], dtype=np.int64)[back] if len(pairs) else np.empty(0, dtype=np.int64)
            found.append((doc[:-1][near] * width)[two >= 0] + two[two >= 0])
        both = np.unique(np.concatenate(found))
        ends = np.searchsorted(both, np.arange(1, n + 1) * width).tolist()
        own = (both % width).tolist()
        return [tuple(own[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def record_items(rows: DataFrame, keys: list[str], texts: list[str], model: PairModel | None) -> DataFrame:
    """``keys`` and ``items`` of each record; garbled texts are restored by ``model`` first."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost: dict[tuple[str, str], float] = {}
        for b in batches:
            columns = [b.column(len(keys) + i).to_pylist() for i in range(len(texts))]
            items = [text_items([repair(t, model, cost)[0] if t and model else t for t in ts]) for ts in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], pa.array(items, pa.list_(pa.string()))], names=[*keys, "items"])

    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys) + ", items array<string>"
    return rows.select(*keys, *texts).mapInArrow(make, schema)


Rules = tuple[list[tuple[frozenset[str], str, float]], dict[str, str]]


def _any_view(condition) -> Column:
    """True where ``condition`` holds in any view."""
    out = condition(0)
    for v in VIEWS[1:]:
        out = out | condition(v)
    return out


def _counted(rows: DataFrame, pattern: list[str], *more: Column) -> DataFrame:
    """``pattern, subject, n0..n2, k0..k2``: for each pattern and subject the records of each view that hold the pattern, and
    those of them that have the subject. ``rows`` has a row for each record and pattern of it."""
    laid = rows.withColumn("subject", F.explode(F.concat(F.array(F.lit("")), "subjects")))
    counts = laid.groupBy(*pattern, "subject").agg(*[F.count(F.when(F.col(f"v{v}"), 1)).alias(f"k{v}") for v in VIEWS], *more)
    extra = [c for c in counts.columns if c not in (*pattern, "subject", *[f"k{v}" for v in VIEWS])]
    whole = counts.where("subject = ''").select(*pattern, *[F.col(f"k{v}").alias(f"n{v}") for v in VIEWS], *extra)
    return counts.where("subject <> ''").select(*pattern, "subject", *[f"k{v}" for v in VIEWS]).join(whole, pattern)


def mine_views(labelled: DataFrame) -> list[Rules]:
    """Rules and merged items of ``bill, items, subjects, half`` (a row for each labelled record): of the records without
    half 0, of those without half 1, and of all, mined in one pass. Records with equal items and subjects count once."""
    once = labelled.groupBy(F.xxhash64("items", F.array_sort("subjects")).alias("tid")).agg(
        F.first("items").alias("items"), F.first(F.array_distinct("subjects")).alias("subjects"), F.lit(True).alias("v2"), F.min("bill").alias("b2"),
        *[F.bool_or(F.col("half") != v).alias(f"v{v}") for v in (0, 1)], *[F.min(F.when(F.col("half") != v, F.col("bill"))).alias(f"b{v}") for v in (0, 1)],
    )
    once = staged(spread(once), "subject-records")
    shares = once.select(F.explode(F.concat(F.array(F.lit("")), "subjects")).alias("s"), "v0", "v1", "v2").groupBy("s").agg(*[F.count(F.when(F.col(f"v{v}"), 1)).alias(f"n{v}") for v in VIEWS])
    share = {r["s"]: [r[f"n{v}"] for v in VIEWS] for r in shares.collect()}
    total = share.pop("", [0, 0, 0])
    least = [max(MIN_COUNT, math.ceil(MIN_SHARE * n)) for n in total]

    def likely(v: int) -> Column:
        return (F.col(f"k{v}") >= least[v]) & (F.col(f"k{v}") >= MIN_CONFIDENCE * F.col(f"n{v}"))

    def unsure(v: int) -> Column:
        return (F.col(f"k{v}") >= least[v]) & (F.col(f"k{v}") < F.col(f"n{v}"))

    # Patterns of one item.
    single = once.select("tid", "subjects", *[f"{c}{v}" for v in VIEWS for c in "vb"], F.explode("items").alias("item"))
    seen = [x for v in VIEWS for x in (F.min(f"b{v}").alias(f"lo{v}"), F.max(f"b{v}").alias(f"hi{v}"), F.bit_xor(F.when(F.col(f"v{v}"), F.col("tid"))).alias(f"x{v}"))]
    ones = staged(_counted(single, ["item"], *seen), "subject-items")
    telling = [F.bool_or(likely(v) & (F.col(f"lo{v}") != F.col(f"hi{v}"))).alias(f"told{v}") for v in VIEWS]
    stats = ones.groupBy("item").agg(*telling, *[F.first(f"{c}{v}").alias(f"{c}{v}") for v in VIEWS for c in "nx"]).where(_any_view(lambda v: F.col(f"told{v}")))
    # Items that always occur together are one; in a view, more may be.
    same = stats.groupBy("n2", "x2").agg(F.min(F.struct(F.length("item"), "item")).getField("item").alias("item"), F.collect_list("item").alias("members"))
    same = staged(same.drop("n2", "x2").join(stats, "item"), "subject-merged")
    held = ones.drop(*[f"{c}{v}" for v in VIEWS for c in ("n", "x", "lo", "hi")]).join(same.drop("members"), "item")
    rules = [held.where(_any_view(lambda v: likely(v) & F.col(f"told{v}"))).select(F.array("item").alias("left"), "subject", *[f"{c}{v}" for v in VIEWS for c in "nk"], *[f"told{v}" for v in VIEWS])]
    alone = held.select("item", "subject", *[F.when(likely(v), F.col(f"k{v}") / (F.col(f"n{v}") + PRIOR)).alias(f"alone{v}") for v in VIEWS], *[f"told{v}" for v in VIEWS])
    open_ = staged(held.where(_any_view(unsure)).select("item", "subject", "n2"), "subject-open")

    # Patterns of two: each record is projected on each of its open items, those after it in order of frequency remain.
    ordered = F.transform(F.array_sort(F.collect_set(F.struct("n2", "item"))), lambda x: x["item"])
    base = single.select("tid", "item").join(open_.select("item", "n2").distinct(), "item").groupBy("tid").agg(ordered.alias("items"))
    base = staged(base.where(F.size("items") > 1).join(once.select("tid", "subjects", "v0", "v1", "v2"), "tid"), "subject-open-records")
    heads = spread(base).select("tid", "subjects", "v0", "v1", "v2", "items", F.posexplode("items").alias("p", "a"))
    two = heads.select("tid", "subjects", "v0", "v1", "v2", "a", F.explode(F.slice("items", F.col("p") + 2, F.size("items"))).alias("b"))
    pairs = staged(_counted(two, ["a", "b"]).where(_any_view(lambda v: F.col(f"k{v}") >= least[v])), "subject-pairs")
    rules.append(_surer(pairs, ["a", "b"], alone, likely))

    # Patterns of three: pairs that are not sure of a subject yet, grown towards it where all their pairs are such.
    grown = staged(pairs.where(_any_view(unsure)).select("a", "b", "subject"), "subject-grown")
    towards = two.select("tid", "a", "b", F.explode("subjects").alias("subject")).join(grown, ["a", "b", "subject"]).join(base.select("tid", "items"), "tid")
    after = F.slice("items", F.array_position("items", F.col("b")).cast("int") + 1, F.size("items"))
    three = towards.select("a", "b", "subject", F.explode(after).alias("c")).groupBy("a", "b", "c", "subject").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= min(least))
    for x in "ab":
        three = three.join(grown.select(F.col("a").alias(x), F.col("b").alias("c"), "subject"), [x, "c", "subject"], "left_semi")
    three = staged(three.select("a", "b", "c").distinct(), "subject-triples")
    held3 = two.join(three, ["a", "b"]).join(base.select("tid", "items"), "tid").where(F.array_contains("items", F.col("c"))).select("a", "b", "c", "subjects", "v0", "v1", "v2")
    rules.append(_surer(_counted(held3, ["a", "b", "c"]), ["a", "b", "c"], alone, likely))

    found = rules[0].unionByName(rules[1]).unionByName(rules[2]).limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules; ask for more support or confidence")
    used = labelled.sparkSession.createDataFrame([(i,) for i in sorted({i for r in found for i in r["left"]})], "item string")
    merged = same.join(used, "item", "left_semi").select("item", F.explode("members").alias("member"), *[f"{c}{v}" for v in VIEWS for c in "nx"]).limit(MOST_ITEMS + 1).collect()
    if len(merged) > MOST_ITEMS:
        raise ValueError(f"more than {MOST_ITEMS} items in rules; ask for more support or confidence")
    return [_rules_of(v, found, merged, total[v], {s: n[v] for s, n in share.items()}, least[v]) for v in VIEWS]


def _surer(grown: DataFrame, pattern: list[str], alone: DataFrame, likely) -> DataFrame:
    """Likely rules of several items, all telling, without those that one of the items alone is as sure of, in any view."""
    rows = grown.where(_any_view(likely))
    for k, x in enumerate(pattern):
        names = [F.col(f"alone{v}").alias(f"alone{v}_{k}") for v in VIEWS] + [F.col(f"told{v}").alias(f"told{v}_{k}") for v in VIEWS]
        rows = rows.join(alone.select(F.col("item").alias(x), "subject", *names), [x, "subject"])

    def told(v: int) -> Column:
        out = F.col(f"told{v}_0")
        for k in range(1, len(pattern)):
            out = out & F.col(f"told{v}_{k}")
        return out

    def better(v: int) -> Column:
        best = F.greatest(*[F.coalesce(F.col(f"alone{v}_{k}"), F.lit(-1.0)) for k in range(len(pattern))])
        return likely(v) & told(v) & (F.col(f"k{v}") / (F.col(f"n{v}") + PRIOR) > best)

    return rows.where(_any_view(better)).select(F.array(*pattern).alias("left"), "subject", *[f"{c}{v}" for v in VIEWS for c in "nk"], *[better(v).alias(f"told{v}") for v in VIEWS])


def _rules_of(v: int, found: list, merged: list, total: int, share: dict[str, int], least: int) -> Rules:
    """Rules of a view, and what each item stands for in it."""
    stands: dict[tuple[int, int], str] = {}
    for r in merged:
        group = (r[f"n{v}"], r[f"x{v}"])
        if group not in stands or (len(r["item"]), r["item"]) < (len(stands[group]), stands[group]):
            stands[group] = r["item"]
    one = {r["item"]: stands[(r[f"n{v}"], r[f"x{v}"])] for r in merged}
    rules: dict[tuple[frozenset[str], str], float] = {}
    for r in found:
        n, k = r[f"n{v}"], r[f"k{v}"]
        if not r[f"told{v}"] or k < least or k < MIN_CONFIDENCE * n:
            continue
        base = share.get(r["subject"], 0) / total
        sure = (k + PRIOR * base) / (n + PRIOR)
        certainty = (sure - base) / (1 - base) if base < 1 else 0.0
        if certainty >= MIN_CERTAINTY:
            rules[(frozenset(one[i] for i in r["left"]), r["subject"])] = certainty
    kept = prune([(i, s, c) for (i, s), c in rules.items()])
    needed = {i for items, _, _ in kept for i in items}
    return kept, {r["member"]: one[r["item"]] for r in merged if one[r["item"]] in needed}


def prune(rules: list[tuple[frozenset[str], str, float]]) -> list[tuple[frozenset[str], str, float]]:
    """``rules`` without those to which a rule with fewer of their items and the same subject is at least as sure."""
    kept: dict[tuple[frozenset[str], str], float] = {}
    for items, subject, sure in sorted(rules, key=lambda r: (len(r[0]), -r[2], sorted(r[0]), r[1])):
        general = [items - {i} for i in items] + [frozenset({i}) for i in items] if len(items) > 1 else []
        if not any(kept.get((g, subject), -1.0) >= sure for g in general):
            kept[(items, subject)] = sure
    return [(i, s, c) for (i, s), c in kept.items()]


def isotonic(points: list[tuple[float, bool]]) -> list[tuple[float, float]]:
    """Steps ``(evidence, probability)`` that rise, by pooling adjacent violators."""
    pools: list[list[float]] = []
    for e, hit in sorted(points):
        if pools and pools[-1][3] == e:
            pools[-1][1] += hit
            pools[-1][2] += 1
        else:
            pools.append([e, float(hit), 1.0, e])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            start, hits, n, end = pools.pop()
            pools[-1] = [pools[-1][0], pools[-1][1] + hits, pools[-1][2] + n, end]
    return [(p[0], p[1] / p[2]) for p in pools]


def train_subjects(rows: DataFrame, labels: DataFrame, key: str, bill: str, texts: list[str], subject: str, none: str, model: PairModel | None, held: int = 20_000) -> SubjectRules:
    """Rules mined from all labelled records, calibrated on at most ``held`` records by rules of the other half of the bills."""
    known = labels.where(F.col(subject).isNotNull()).groupBy(key).agg(F.collect_set(subject).alias("subjects"))
    chosen = rows.select(key, bill, *texts).join(known, key)
    half = F.pmod(F.xxhash64(F.coalesce(F.upper(F.trim(F.col(bill))), F.col(key).cast("string"))), F.lit(2))
    prepared = record_items(chosen.withColumn("half", half).withColumnRenamed(bill, "bill"), [key, "bill", "subjects", "half"], texts, model)
    prepared = prepared.withColumn("subjects", F.filter("subjects", lambda s: s != none)).withColumn("bill", F.coalesce(F.upper(F.trim("bill")), F.lit("")))
    prepared = staged(prepared, "subject-labelled")
    points: list[tuple[float, bool]] = []
    *parts, whole = mine_views(prepared)
    for side, (rules, stands_for) in enumerate(parts):
        judge = SubjectRules(rules, stands_for, [])
        test = prepared.where(F.col("half") == side).dropDuplicates(["items"]).orderBy(F.xxhash64("items")).limit(held // 2)
        for r in test.select("items", "subjects").toLocalIterator():
            points += [(round(e, 3), s in r["subjects"]) for s, e in judge.evidence(r["items"]).items()]
    return SubjectRules(*whole, isotonic(points))


def score_subjects(rows: DataFrame, key: str, texts: list[str], rules: SubjectRules, none: str, model: PairModel | None, least: float = 0.5) -> DataFrame:
    """``key, subject, probability``: the subjects of each record whose probability is ``least`` or more, else ``none``.

    NULL, empty and blank texts have the subject ``none``; repeated rows give repeated results; other columns are ignored.
    """
    key_type = rows.schema[key].dataType.simpleString()
    reader = ItemReader(rules)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost: dict[tuple[str, str], float] = {}
        known: dict[tuple[int, ...], list[tuple[str, float]]] = {}
        texts_known: dict[str, str] = {}
        for b in batches:
            at, subjects, probabilities = [], [], []
            for i, held in enumerate(reader.held([restored(c, model, cost, texts_known) for c in b.columns[1:]], b.num_rows)):
                if (got := known.get(held)) is None:
                    if len(known) > 100_000:
                        known.clear()
                    sure = [(s, rules.probability(round(e, 3))) for s, e in rules.evidence_of({reader.names[k] for k in held}).items()]
                    got = known[held] = sorted((s, p) for s, p in sure if p >= least) or [(none, 1 - max((p for _, p in sure), default=0.0))]
                for s, p in got:
                    at.append(i)
                    subjects.append(s)
                    probabilities.append(p)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(subjects, pa.string()), pa.array(probabilities, pa.float64())], names=["k", "subject", "probability"])

    scored = spread(rows.select(F.col(key).alias("k"), *texts)).mapInArrow(score, f"k {key_type}, subject string, probability double")
    return scored.select(F.col("k").alias(key), "subject", "probability")
