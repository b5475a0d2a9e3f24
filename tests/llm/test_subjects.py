"""Subject rules: accuracy on records held out by the test, pruning, and calibration."""

from __future__ import annotations

import itertools
import random
import time

import pytest

from tamiz.llm import subjects
from tamiz.llm.subjects import MIN_BILLS, MIN_CERTAINTY, MIN_CONFIDENCE, MIN_COUNT, PRIOR, ItemReader, SubjectRules, isotonic, mine_views, prune, score_subjects, text_items, train_subjects

MATTERS = {
    "salud": ["la atención de pacientes con dengue", "el registro clínico de tuberculosis", "la vacunación contra el asma"],
    "agro": ["el crédito a productores de cacao", "el seguro de cosecha de arroz", "el control de plagas en papa nativa"],
    "deporte": ["el calendario de ligas de atletismo", "la dotación de torneos de ajedrez", "el retiro digno de boxeadores"],
}
NOISE = ["", " (remitido por la comisión que conoce de salud y trabajo)", ". Incluye nota del diario El Deporte", ", presentado en la plaza Carbón y Cacao"]


def records(n=700, seed=1):
    rng = random.Random(seed)
    rows, labels, truth = [], [], {}
    for i in range(n):
        picked = [(s, rng.choice(MATTERS[s])) for s in rng.sample(sorted(MATTERS), rng.choice([0, 1, 1, 2]))]
        fields = ["Por la cual se dictan normas", "Ver texto adjunto."]
        for k, (_, matter) in enumerate(picked):
            fields[k] = f"Por la cual se dictan normas sobre {matter}"
        fields[0] += rng.choice(NOISE)
        rows.append((i, f"{i:04d}/2020C", fields[0].upper() if rng.random() < 0.2 else fields[0], fields[1]))
        truth[i] = {s for s, _ in picked} or {"otros"}
        if i % 2:
            labels += [(i, s) for s in truth[i]]
    return rows, labels, truth


def test_held_out_accuracy(spark):
    rows, labels, truth = records()
    extra = [(9000, None, None, None), (9001, "x", "", " "), (9002, "y", "salud " * 5000, None)]
    df = spark.createDataFrame(rows + extra, "rec_id bigint, no_camara string, titulo string, objeto string").selectExpr("*", "'clash' AS items", "'clash' AS half")
    lab = spark.createDataFrame(labels, "rec_id bigint, subject string")
    rules = train_subjects(df, lab, "rec_id", "no_camara", ["titulo", "objeto"], "subject", "otros", None)
    got: dict[int, set[str]] = {}
    for r in score_subjects(df, "rec_id", ["titulo", "objeto"], rules, "otros", None).collect():
        got.setdefault(r.rec_id, set()).add(r.subject)
    held = [i for i in truth if i % 2 == 0]
    assert sum(got[i] == truth[i] for i in held) >= 0.97 * len(held)
    assert got[9000] == got[9001] == {"otros"} and len(got) == len(rows) + len(extra)


def test_without_labels_everything_is_of_no_subject(spark):
    df = spark.createDataFrame([(1, "a", "dengue", None)], "rec_id bigint, no_camara string, titulo string, objeto string")
    none = spark.createDataFrame([], "rec_id bigint, subject string")
    rules = train_subjects(df, none, "rec_id", "no_camara", ["titulo", "objeto"], "subject", "otros", None)
    assert [r.subject for r in score_subjects(df, "rec_id", ["titulo", "objeto"], rules, "otros", None).collect()] == ["otros"]
    assert score_subjects(df.where("false"), "rec_id", ["titulo", "objeto"], rules, "otros", None).collect() == []


def test_pruning_and_override():
    a, b, ab = frozenset({"a"}), frozenset({"b"}), frozenset({"a", "b"})
    assert sorted(prune([(a, "s", 0.9), (ab, "s", 0.8), (ab, "t", 0.7), (b, "t", 0.4)]), key=str) == sorted([(a, "s", 0.9), (ab, "t", 0.7), (b, "t", 0.4)], key=str)
    rules = SubjectRules([(frozenset({"registro"}), "salud", 0.6), (frozenset({"registro nacional"}), "turismo", 0.9)], {w: w for w in ("registro", "registro nacional")}, [])
    assert set(rules.evidence(["registro"])) == {"salud"} and set(rules.evidence(["registro", "registro nacional"])) == {"turismo"}


def test_calibration_rises():
    steps = isotonic([(0.1, False), (0.2, True), (0.3, False), (0.9, True), (0.9, True)])
    assert [p for _, p in steps] == sorted(p for _, p in steps) and steps[-1] == (0.9, 1.0)
    assert isotonic([]) == [] and SubjectRules([], {}, []).probability(0.7) == 0.7


def test_items():
    assert text_items([None, "", "La atención de los pacientes, 2020"]) == ["atencion", "atencion pacientes", "pacientes"]


LABELLED = "bill string, items array<string>, subjects array<string>, half int"


def brute_force(rows):
    """Rules over all itemsets of up to three items, by definition."""
    seen, once = set(), []
    for bill, items, subs, _ in rows:
        if (key := (tuple(items), tuple(sorted(subs)))) not in seen:
            seen.add(key)
            once.append((bill, frozenset(items), frozenset(subs)))
    total = len(once)
    share = {c: sum(c in s for _, _, s in once) / total for c in {c for _, _, s in once for c in s}}

    def count(x):
        held = [(b, s) for b, i, s in once if x <= i]
        return len(held), {c: sum(c in s for _, s in held) for c in share}, {b for b, _ in held}

    items = sorted({i for _, held, _ in once for i in held})
    groups = {}
    for i in items:
        n, k, bills = count(frozenset({i}))
        if len(bills) >= MIN_BILLS and any(x >= max(MIN_COUNT, MIN_CONFIDENCE * n) for x in k.values()):
            groups.setdefault(tuple(i in h for _, h, _ in once), []).append(i)
    reps = [min(g, key=lambda i: (len(i), i)) for g in groups.values()]
    rules, alone = [], {}
    for size in (1, 2, 3):
        for x in map(frozenset, itertools.combinations(reps, size)):
            n, k, _ = count(x)
            for c, hits in k.items():
                if hits < MIN_COUNT or hits < MIN_CONFIDENCE * n:
                    continue
                if size == 1:
                    alone[(x, c)] = hits / (n + PRIOR)
                elif any(alone.get((frozenset({i}), c), -1) >= hits / (n + PRIOR) for i in x):
                    continue
                sure = (hits + PRIOR * share[c]) / (n + PRIOR)
                certainty = (sure - share[c]) / (1 - share[c]) if share[c] < 1 else 0
                if certainty >= MIN_CERTAINTY:
                    rules.append((x, c, certainty))
    return {(x, c): round(s, 9) for x, c, s in prune(rules)}


def test_rules_equal_brute_force_in_every_view(spark):
    rng = random.Random(7)
    words_ = [f"w{i}" for i in range(12)]
    rows = []
    for _ in range(400):
        items = {w for w in words_ if rng.random() < 0.4}
        subs = set()
        for c, of in (("a", {"w0", "w1"}), ("b", {"w2", "w3", "w4"}), ("c", {"w5"})):
            if rng.random() < (0.97 if of <= items else 0.72 if len(of & items) == len(of) - 1 else 0.3 if of & items else 0.02):
                subs.add(c)
        if rng.random() < 0.1:
            subs.add(rng.choice("abcd"))
        items |= {f"{w} x" for w in items if w in ("w6", "w7")}
        rows.append((f"bill{rng.randint(0, 40)}", sorted(items), sorted(subs), rng.randint(0, 1)))
    rows += rows[:20]
    views = mine_views(spark.createDataFrame(rows, LABELLED))
    for v, (rules, stands) in enumerate(views):
        want = brute_force([r for r in rows if r[3] != v])
        assert {(x, c): round(s, 9) for x, c, s in rules} == want
        assert all(i in stands for x, _, _ in rules for i in x)
    assert any(len(x) == 3 for x, _, _ in views[2][0]) and any(len(x) == 2 for x, _, _ in views[2][0])


def test_many_shared_words_end_soon(spark):
    """Records that share sixty telling words, each of which also stands alone somewhere, with subjects that differ."""
    shared = [f"w{i:02}" for i in range(60)]
    rows = [(f"b{k}", [*shared, f"own{k}"], [["a"], ["a"], ["a", "b"], ["b"]][k % 4], k % 2) for k in range(8)]
    rows += [(f"c{i}", [w], ["a"], i % 2) for i, w in enumerate(shared)]
    began = time.monotonic()
    mine_views(spark.createDataFrame(rows, LABELLED))
    assert time.monotonic() - began < 60


def test_more_rules_than_can_be_held_are_an_error(spark, monkeypatch):
    rows = [(f"b{k}", [f"w{k // 3}", f"own{k}"], ["a"], k % 2) for k in range(30)] + [("z", ["x"], ["b"], 0)]
    monkeypatch.setattr(subjects, "MOST_RULES", 5)
    with pytest.raises(ValueError, match="rules"):
        mine_views(spark.createDataFrame(rows, LABELLED))


def test_items_of_batches_are_those_of_records():
    import pyarrow as pa

    texts = [["La atención de los pacientes, 2020", None, "", "atención pacientes", "pacientes atención"], ["x", "Los pacientes", None, " ", "la"]]
    rules = SubjectRules([], {"atencion": "atencion", "atencion pacientes": "ap", "pacientes": "atencion", "pacientes atencion": "pa"}, [])
    reader = ItemReader(rules)
    got = reader.held([pa.array(t, pa.string()) for t in texts], 5)
    want = [{rules.stands_for[i] for i in text_items(list(ts)) if i in rules.stands_for} for ts in zip(*texts, strict=True)]
    assert [{reader.names[k] for k in g} for g in got] == want
