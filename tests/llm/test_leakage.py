"""Leak finder on planted passages."""

from __future__ import annotations

import random

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st

from tamiz.llm import leakage
from tamiz.llm.leakage import find_leaks, holds_passage, positional_index, postings, seed_positions
from tamiz.llm.words import cased_words, faces, told_words, word_arrays, words

ITEM = (
    "Quien herede un predio de 3113 metros en Lleñeyota debe notificar a Yopayolu dentro de 68 días, adjuntando el croquis sellado "
    "por Sofabumé. De los 1450 testigos citados en Lupaméñe comparecieron 29, y ninguno supo explicar la ausencia del archivo de Bullehuimé."
)
OTHER = ITEM.replace("3113", "5257").replace("Lleñeyota", "Chiquiriso").replace("Yopayolu", "Faguabune").replace("68", "91").replace("Sofabumé", "Parisochi")
OTHER = OTHER.replace("1450", "8164").replace("Lupaméñe", "Nehui").replace("29", "71").replace("Bullehuimé", "Tapa")
W = ITEM.split()

HOLD = {
    "whole": ITEM,
    "case": ITEM.upper(),
    "accents": "Antes. " + ITEM.replace("ñ", "n").replace("é", "e").lower(),
    "tags": "<p>" + " ".join(W[:8]) + " <b>" + " ".join(W[8:30]) + "</b></p>",
    "breaks": ITEM.replace("notificar", "notifi-\ncar").replace(" ", "\n "),
    "spaces": ITEM.replace(" ", "\xa0 "),
    "part": "Consta en actas que " + " ".join(W[6:21]) + ", como se dijo.",
    "edited": ITEM.replace("metros", "quizá").replace("el croquis", "croquis").replace("testigos", "entonces testigos"),
    "entities": ITEM.replace("ñ", "&ntilde;"),
}
LACK = {
    "other": OTHER, "short": "Alguien dijo «" + " ".join(W[6:14]) + "» y nada más.", "lower other": OTHER.lower(), "empty": "", "null": None, "blank": " \n",
    "one figure": OTHER.replace("71", "29"),
}


@pytest.mark.parametrize("case", HOLD)
def test_passage_is_found(case):
    assert holds_passage(cased_words(HOLD[case]), told_words(ITEM))


@pytest.mark.parametrize("case", LACK)
def test_passage_is_not_found(case):
    assert not holds_passage(cased_words(LACK[case]), told_words(ITEM))


def test_operator_equals_brute_force(spark):
    rng = random.Random(1)
    names = ["".join(rng.choice(["lu", "ña", "ro", "mé", "ti", "po"]) for _ in range(4)).capitalize() for _ in range(60)]
    make = lambda: f"La comisaria de {rng.choice(names)} recibió {rng.randint(100, 9999)} quejas contra el proveedor de {rng.choice(names)}, y aplicó una multa equivalente a {rng.randint(10, 99)} jornales depositados en {rng.choice(names)}."  # noqa: E731,E501
    items = [(i, make()) for i in range(12)] + [(98, "muy corto"), (99, None)]
    docs = [(i, f"Texto previo. {rng.choice(items[:12])[1]} Texto final." if i % 3 else make()) for i in range(60)]
    docs += [(100 + i, t) for i, t in enumerate([*HOLD.values(), *LACK.values()])] + [(200, items[0][1] * 400)]
    items.append((50, ITEM))
    want = {(d, i) for d, t in docs for i, p in items if p and len(words(p)) >= 12 and t and holds_passage(cased_words(t), told_words(p))}
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "'clash' AS item_id", "1 AS token")
    got = find_leaks(df, spark.createDataFrame(items, "item_id bigint, text string"), "doc_id", "text", "item_id", "text").collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert {(100 + i, 50) for i in range(len(HOLD))} <= want


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert find_leaks(docs, one, "doc_id", "text", "item_id", "text").collect() == []
    assert find_leaks(one.selectExpr("item_id AS doc_id", "text"), items, "doc_id", "text", "item_id", "text").collect() == []


def test_index_holds_every_token(spark):
    docs = spark.createDataFrame([(1, "uno dos uno"), (2, None), (3, "")], "doc_id bigint, text string")
    rows = postings(positional_index(docs, "doc_id", "text")).collect()
    assert sorted((r.token, r.doc, r["at"]) for r in rows) == [("dos", 1, 1), ("uno", 1, 0), ("uno", 1, 2)]


def test_seeds_are_words_of_the_corpus():
    assert seed_positions(["a", "b", "c"], {"a": 5, "b": 1}) == {0, 1}
    passage = [f"w{i}" for i in range(12)]
    assert seed_positions(passage, {w: i + 1 for i, w in enumerate(passage) if i > 1}) == set(range(2, 8))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), st.text(alphabet="aÁñß1½ <b>&amp;-\n\u0301\u00ad_'İΣ漢"))))
def test_words_of_batches_are_those_of_texts(texts):
    import pyarrow as pa

    tokens, code, doc, facing = word_arrays(pa.array(texts, pa.string()))
    want = [(i, w.casefold(), faces(w)) for i, t in enumerate(texts) for w in cased_words(t)]
    assert [(int(d), tokens[c], bool(f)) for d, c, f in zip(doc, code, facing, strict=True)] == want


def test_rarest_words_of_a_passage_may_be_the_changed_ones(spark):
    """Two of the rarest words of a quote of seventeen were replaced by common ones; the corpus has neither."""
    passage = "Quien herede un predio de tres cuartas en el valle debe notificar al comisario ambulante dentro de quince días hábiles, adjuntando croquis"
    quote = " ".join(passage.split()[:17]).replace("cuartas", "partes").replace("ambulante", "siguiente")
    docs = [(1, "Consta que " + quote + " y nada más."), *[(i, f"En el valle se debe notificar al comisario dentro de {i} días un predio de tres partes siguiente") for i in range(2, 60)]]
    assert holds_passage(cased_words(quote), told_words(passage))
    got = find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(7, passage)], "item_id bigint, text string"), "doc_id", "text", "item_id", "text").collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 7)]


def test_long_passages_are_compared_in_stretches(spark):
    from tamiz.llm.leakage import STRETCH, stretches

    for n in (12, 95, 96, 97, 144, 145, 400):
        parts = stretches(list(range(n)))
        assert sorted({x for p in parts for x in p}) == list(range(n)) and max(map(len, parts)) <= STRETCH
        assert all(any(set(range(a, min(n, a + 48))) <= set(p) for p in parts) for a in range(n))
    rng = random.Random(2)
    words_ = [f"w{rng.randint(0, 3000)}" for _ in range(1200)]
    docs = [(1, " ".join(words_ * 20)), (2, " ".join(words_[k] for k in range(300, 312))), (3, " ".join(words_[700:711])), (4, " ".join(words_[1180:]))]
    got = find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(5, " ".join(words_))], "item_id bigint, text string"), "doc_id", "text", "item_id", "text").collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 5), (2, 5), (4, 5)]


def test_blocks_within_a_segment_make_no_difference(spark, monkeypatch):
    import pyarrow as pa

    from tamiz.llm.leakage import Passages, Segment, index_schema

    rng = random.Random(11)
    items = [[f"w{rng.randint(0, 80)}" for _ in range(rng.randint(12, 50))] for _ in range(15)]
    docs = [(i, " ".join([*rng.choice(items)[:20], "y", *rng.choice(items), *rng.choice(items)])) for i in range(60)]
    index = positional_index(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1), "doc_id", "text")
    passages = Passages([(w, [False] * len(w)) for w in items], 12)
    passages.seed(leakage.document_frequencies(index, passages.vocabulary))
    batch = pa.RecordBatch.from_pylist([r.asDict(recursive=True) | {c: bytes(r[c]) for c in ("lengths", "starts", "docs", "places", "facing")} for r in index.collect()])
    assert [f.name for f in batch.schema] == index_schema(index.schema["keys"].dataType.elementType).names
    want = [sorted(passages.search(Segment(batch, i))) for i in range(batch.num_rows)]
    assert sum(map(len, want)) > 60
    monkeypatch.setattr(leakage, "MOST_HITS", 50)
    monkeypatch.setattr(leakage, "MOST_CELLS", 3000)
    assert [sorted(passages.search(Segment(batch, i))) for i in range(batch.num_rows)] == want


def test_every_allowed_edit_is_found(spark, monkeypatch):
    """Random quotes with random edits against brute force over all pairs, in blocks of passages."""
    rng = random.Random(3)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(300)]
    word = lambda: rng.choice(common) if rng.random() < 0.5 else rng.choice(rare)
    items = [(i, " ".join(word() for _ in range(rng.randint(12, 60)))) for i in range(20)]
    docs = []
    for i in range(300):
        w = rng.choice(items)[1].split()
        size = rng.randint(10, len(w)) if len(w) > 12 else len(w)
        a = rng.randint(0, len(w) - size)
        w = w[a : a + size]
        for _ in range(rng.randint(0, len(w) // 4)):
            at = rng.randrange(len(w))
            kind = rng.random()
            w[at : at + 1] = [word()] if kind < 0.5 else [] if kind < 0.75 else [w[at], "nuevo"]
            if not w:
                break
        docs.append((i, " ".join([word() for _ in range(rng.randint(0, 40))] + w + [word() for _ in range(rng.randint(0, 40))])))
    want = {(d, i) for d, t in docs for i, p in items if holds_passage(cased_words(t), told_words(p))}
    assert len(want) > 100
    monkeypatch.setattr(leakage, "BLOCK_WORDS", 300)
    got = find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), "doc_id", "text", "item_id", "text").collect()
    assert want <= {(r.doc_id, r.item_id) for r in got} and len(got) == len({(r.doc_id, r.item_id) for r in got})
    extra = {(r.doc_id, r.item_id) for r in got} - want
    assert len(extra) <= 0.02 * len(want), extra
