"""Garbled text: texts garbled by the test come out, with the original where no byte was lost."""

from __future__ import annotations

import random
import re

import pytest

from tamiz.llm.encoding import SUSPECT, PairModel, find_garbled, improbable_runs, pair_counts, repair

BASE = [
    "Por medio de la cual se regula la atención de pacientes con cáncer", "Por la cual se fortalece la educación pública en la región", "Su objeto es la señalización de vías y la revisión técnica",
    "¿Qué se pretende? Atender allí la conservación de páramos", "“Ley que declara de interés nacional la montaña”", "El proyecto consta de artículos y trata del crédito a jóvenes",
]
DECOYS = ["acuerdo São Tomé: NAÇÃO e EDUCAÇÃO", "½ jornada, tarifa de 5 ¢ y £3", "(µg/m³, ≤ 25 °C)", "«Convention de la Forêt, n° 4»", "Ángulo Â, parágrafo 2º", "rótulo &oacute;ptimo (¿vigente?)", "ATENCIÓN Y REGIÓN", "atencion y region"]
WAYS = {
    "cp1252": lambda t: t.encode().decode("cp1252", "ignore"), "mac": lambda t: t.encode().decode("mac_roman"), "cp437": lambda t: t.encode().decode("cp437"),
    "twice": lambda t: t.encode().decode("latin-1").encode().decode("latin-1"), "dos": lambda t: t.replace("“", "").replace("”", "").encode("cp850").decode("latin-1"), "lost": lambda t: t.encode("ascii", "replace").decode(),
    "replaced": lambda t: t.replace("“", "").replace("”", "").encode("latin-1").decode("utf-8", "replace"),
}


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows, truth, original = [], set(), {}
    for i in range(1500):
        text = rng.choice(BASE) + " " + rng.choice(BASE)
        if i % 25 == 0:
            way = rng.choice(sorted(WAYS))
            original[i] = (way, text)
            text = WAYS[way](text)
            truth.add(i)
        elif i % 25 == 1:
            text += " " + rng.choice(DECOYS)
        rows.append((i, text, None if i % 2 else rng.choice(BASE)))
    rows += [(9000, None, None), (9001, "", " "), (9002, (BASE[0] + " ") * 3000, None), rows[25], rows[26]]
    df = spark.createDataFrame(rows, "rec_id bigint, titulo string, objeto string").selectExpr("*", "'x' AS field", "'y' AS restored")
    return df, truth, original


def test_garbled_values_and_their_originals(corpus):
    df, truth, original = corpus
    found = find_garbled(df, "rec_id", ["titulo", "objeto"]).collect()
    assert {r.field for r in found} == {"titulo"}
    got = {r.rec_id: r.restored for r in found}
    assert set(got) == truth
    exact = [i for i, (way, _) in original.items() if way in ("mac", "cp437", "twice", "dos")]
    assert sum(got[i].replace("“", "").replace("”", "") == original[i][1].replace("“", "").replace("”", "") for i in exact) >= 0.95 * len(exact)


def test_empty_table(spark):
    assert find_garbled(spark.createDataFrame([], "rec_id bigint, titulo string"), "rec_id", ["titulo"]).collect() == []


def test_pair_counts_are_complete(spark):
    model = pair_counts(spark.createDataFrame([("ab", None), ("a", "b")], "x string, y string"), ["x", "y"])
    assert model.pairs[("a", "b")] == 1 and model.pairs[("\n", "a")] == 2 and model.total == 3 + 2 + 2
    twice = pair_counts(spark.createDataFrame([("ab", None), ("a", "b"), ("ab", "ab")], "x string, y string"), ["x", "y"])
    assert twice.pairs == model.pairs


def test_segments_are_those_of_brute_force():
    rng = random.Random(2)
    model = PairModel(frozenset("ab"), {("a", "b"): 1}, 1)
    for _ in range(200):
        n = rng.randint(1, 12)
        text = "".join(rng.choice("abcd") for _ in range(n))
        p = f"\n{text}\n"
        cost = {pair: rng.choice([-3, -2, -1, 1, 2, 3]) for pair in set(zip(p, p[1:], strict=False))}
        scores = [cost[pair] for pair in zip(p, p[1:], strict=False)]
        sums = {(i, j): sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)}
        todo, want = [(0, len(scores))], []
        while todo:  # the greatest segment (the shortest, first one), then both sides of it
            lo, hi = todo.pop()
            inner = [(sums[i, j], -(j - i), -i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)]
            if inner and max(inner)[0] > 0:
                *_, i, j = max(inner)
                want.append((max(0, i - 1), min(n, j)))
                todo += [(lo, i), (j, hi)]
        got = improbable_runs(text, model, cost)
        assert sum(b - a for a, b in got) >= 0 and {k for a, b in got for k in range(a, b)} >= {k for a, b in want for k in range(a, b)}
    assert repair("", model, {}) == ("", False)


def test_more_words_than_can_be_held_are_an_error(spark, monkeypatch):
    """Every accented word that a lost letter may need is held, or it is an error; none is left out."""
    from tamiz.llm import encoding

    texts = [(i, f"La acción número {i} de la región y la canción") for i in range(20)] + [(99, "La acci?n de la regi�n y la canci?n")]
    df = spark.createDataFrame(texts, "rec_id bigint, titulo string")
    assert sum(map(len, pair_counts(df, ["titulo"]).words.values())) == 3
    monkeypatch.setattr(encoding, "MOST_WORDS", 2)
    with pytest.raises(ValueError, match="accented words"):
        pair_counts(df, ["titulo"])


def test_texts_without_suspects_are_left_as_they_are():
    model = PairModel(frozenset(), {}, 0)
    for t in ["", "Ley", "La acción de la región ÑANDÚ, 2º"]:
        assert not re.search(SUSPECT, t) or "º" in t
        assert repair(t.replace("º", ""), model, {}) == (t.replace("º", ""), False)


def test_pairs_of_a_text():
    from tamiz.llm.encoding import pairs_of

    for text in ["ab", "abab\nñ😀", "".join(map(chr, range(0x4E00, 0x4E00 + 2500)))]:
        want = {}
        for p in zip(text, text[1:]):
            want[p] = want.get(p, 0) + 1
        assert {(a, b): n for a, b, n in pairs_of(text)} == want
