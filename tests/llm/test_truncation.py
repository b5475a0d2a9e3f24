"""Truncation: held-out accuracy on texts cut by the test itself."""

from __future__ import annotations

import random

from tamiz.llm.truncation import _least_hashes, at_limit, cut_artificially, length_limits, score_truncation, truncation_rates

CLOSINGS = ["", "\n\nAnexos: 12 folios", "\n\nAtentamente,\n\nPonente coordinador", "\n\nVotos a favor | 3\nVotos en contra | 9"]
NOUNS = "comisión ponencia proyecto informe artículo secretaría medida audiencia votación provincia gobierno reglamento plazo".split()


def sentence(rng):
    return "La " + " ".join(rng.choice(NOUNS) for _ in range(rng.randint(5, 14))) + f" rige desde {rng.randint(1990, 2026)}."


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    rows, truth = [], set()
    for i in range(n):
        text = " ".join(sentence(rng) for _ in range(rng.randint(2, 14)))
        source = rng.choice(["uno", "dos", None])
        if source == "uno" and len(text) > 400:
            text = text[:400]
        elif rng.random() < 0.08:
            text = text[: rng.randint(60, len(text) - 8)]
        else:
            text += rng.choice(CLOSINGS)
            rows.append((i, text, source))
            continue
        rows.append((i, text, source))
        if not text.rstrip().endswith("."):
            truth.add(i)
    return rows, truth


def test_held_out_accuracy(spark):
    rows, truth = corpus()
    extra = [(10_000, None, "uno"), (10_001, "", "uno"), (10_002, " \n ", None), (10_003, sentence(random.Random(9)) * 4000, "dos"), *rows[:3]]
    df = spark.createDataFrame(rows + extra, "doc_id bigint, text string, source string").selectExpr("*", "1 AS tail", "2 AS p_cut")
    assert ("c", 400) in length_limits(df, "source", "text")["uno"]
    scored = score_truncation(df, "doc_id", "text", "source")
    found = [r.doc_id for r in scored.where("is_cut").collect()]
    hit = len(truth & set(found))
    assert hit >= 0.97 * len(truth) and hit >= 0.97 * len(set(found))
    assert not {10_000, 10_001, 10_002, 10_003} & set(found)
    rates = {r.source: r for r in truncation_rates(scored, "source").collect()}
    assert rates["uno"].share > rates["dos"].share and sum(r.documents for r in rates.values()) == len(rows) + len(extra)


def test_small_and_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert score_truncation(empty, "doc_id", "text", "source").collect() == []
    tiny = spark.createDataFrame([(1, "corto", "a"), (2, None, None)], "doc_id bigint, text string, source string")
    assert [r.p_cut for r in score_truncation(tiny, "doc_id", "text", "source").collect()] == [0.0, 0.0]


def test_limits_in_bytes_and_cuts():
    assert at_limit(100, 100, [("c", 100)]) and at_limit(90, 98, [("b", 100)]) and not at_limit(90, 96, [("b", 100)])
    rng = random.Random(2)
    for _ in range(200):
        made = cut_artificially("Una frase entera. Otra frase algo más larga que sigue", [("c", 20)], rng)
        assert made is None or made[0]
    assert cut_artificially("x", [], rng) is None


def test_sample_is_the_least_hashes(spark):
    rows = spark.range(5000).selectExpr("xxhash64(id % 4000) AS h")
    want = sorted(r.h for r in rows.distinct().collect())
    assert want[290] <= _least_hashes(rows, 300) <= want[299]
    assert _least_hashes(rows, 10_000) == want[-1] and _least_hashes(rows.where("false"), 5) == (1 << 63) - 1
