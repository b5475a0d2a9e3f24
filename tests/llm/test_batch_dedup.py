"""Batches against everything before: planted copies, versions, and a brute-force replay."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tamiz.llm import batch_dedup
from tamiz.llm.batch_dedup import BatchIndex, arrival_steps, band_keys, canonical_rows, deduplicate_batches, edits, same_title, signed_forms
from tamiz.llm.batch_forms import address, figures, numbered, title_tokens

SCHEMA = "raw_id bigint, load_no int, no_camara string, no_senado string, proyecto string, detail_url string"
URL = "https://portal.invalid/proyectos/2012/17-a2cfa2"
TITLE = "Por medio de la cual se regula la atención de pacientes y se dictan otras disposiciones"


def test_numbers():
    same = ["017/2012C", "17/12c", "00017/2012C", " 017 / 2012 C ", "No. 17 de 2012 C", "PL 017/2012C", "017-2012C", "017_2012_C", "017⁄2012C", "O17/2O12C", "0l7/２0l2C", "017/2012 Cámara", "017/2012C."]
    assert {numbered(x) for x in same} == {"17/2012c"}
    assert numbered("018/2012C") != numbered("017/2012C") != numbered("017/2013C") and numbered(None) == numbered(" \xa0") == ""
    assert numbered("sin número") == "sinnumero"


def test_addresses():
    same = [URL, "http://WWW.portal.invalid//proyectos/2012/17-a2cfa2/", URL + "?ref=x", URL + "#texto", URL.upper()]
    assert {address(x) for x in same} == {"portal.invalid/proyectos/2012/17-a2cfa2"} and address(None) == ""


def test_titles():
    t = title_tokens(TITLE)
    for other in ["POR MED. DE LA CUAL SE REGULA LA ATENCION DE PACIENTES Y SE DICTAN OTRAS DISP.", "“Por mdeio de la cual se regula la atenció de pacientes y se dictan otras disposiciones.”", "Proyecto de ley: " + TITLE, TITLE.replace("ó", "?")]:
        assert same_title(t, title_tokens(other)), other
    assert same_title(title_tokens("La auditoría de programas de código"), title_tokens("La auditoría de prog.s de código"))
    for other in [TITLE + ", excepto en el municipio de Tapa", "Por medio de la cual se corrige un yerro", ""]:
        assert not same_title(t, title_tokens(other)), other
    assert figures(title_tokens("Ley l2 de 2O15")) == "12 2015"
    assert edits("abc", "acb", 2) == 1 and edits("a?c", "abc", 2) == 0 and edits("abcdef", "a", 2) == 3


def rows():
    return [
        (1, 1, "017/2012C", None, TITLE, URL), (2, 1, "17/2012C", None, TITLE.upper(), URL + "#t"), (3, 1, "017/2012C", "304/12S", TITLE, URL),
        (4, 1, "017/2012C", None, TITLE + ", con prórroga de 2 meses", URL), (5, 1, "017/2012C", None, TITLE + ", con prórroga de 3 meses", URL),
        (6, 1, " ", None, TITLE, URL), (7, 1, None, None, None, None), (8, 2, "017/2012C.", " 304/12s ", TITLE.replace("regula", "reguula"), URL),
        (9, 2, "018/2012C", None, None, None), (10, 2, "018/2012C", None, "", None), (11, 3, "017/2012C", None, TITLE + ", con prorroga de 3 meses", URL), (12, 3, "017/2012C", None, TITLE, URL + "/x"),
    ]


def test_planted_cases(spark):
    df = spark.createDataFrame(rows(), SCHEMA).selectExpr("*", "'clash' AS identity", "'clash' AS title", "1 AS leader")
    got = {r.raw_id: r.leader for r in deduplicate_batches(df, "load_no").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 8: 3, 9: 9, 10: 9, 11: 5, 12: 12}


def replay(spark, made):
    """Leaders by comparing every row with all accepted ones of its identity."""
    accepted, want = [], {}
    canonical = {r.raw_id: r for r in canonical_rows(spark.createDataFrame(made, SCHEMA)).collect()}
    for i in sorted(canonical):
        c = canonical[i]
        leader = next((a for a in accepted if canonical[a].identity == c.identity and same_title(canonical[a].title.split(), c.title.split())), i)
        want[i] = leader
        if leader == i:
            accepted.append(i)
    return want


def writings(n=300, seed=4):
    rng = random.Random(seed)
    topics = ["la atención de pacientes con dengue", "el crédito a productores de cacao", "la señalización de vías rurales", "el fomento de bandas de viento"]
    made = []
    for i in range(1, n + 1):
        title = f"Por medio de la cual se regula {rng.choice(topics)} y se fija un plazo de {rng.randint(1, 4)} meses"
        written = title
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randint(25, 50)
            written = written[:at] + rng.choice(["", "x", written[at] * 2]) + written[at + 1 :] if not written[at].isdigit() else written
        bill = rng.choice(["001/2020C"] * 3 + ["002/2020C", "003/2020C"])
        made.append((i, 1 + i // (n // 6), bill, rng.choice([None, "5/20S"]), written, URL))
    return made


@pytest.mark.parametrize("hot", [10_000, 5])
def test_replay_equals_brute_force(spark, monkeypatch, hot):
    """With ``hot`` forms of one identity at most in a task: beyond, the rounds must give the same."""
    monkeypatch.setattr(batch_dedup, "HOT_FORMS", hot)
    made = writings(300 if hot > 5 else 60)
    got = {r.raw_id: r.leader for r in deduplicate_batches(spark.createDataFrame(made, SCHEMA), "load_no").collect()}
    assert got == replay(spark, made)


def test_short_titles_miss_nothing(spark):
    rng = random.Random(8)
    made = []
    for i in range(1, 241):
        w = list(rng.choice(["paramo", "cafe organico", "ley seca", "reforestacion", "x"]))
        for _ in range(rng.choice([0, 1, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice("aeiourst")
        made.append((i, 1 + i // 60, rng.choice(["001/2020C", "002/2020C"]), None, "".join(w), URL))
    got = {r.raw_id: r.leader for r in deduplicate_batches(spark.createDataFrame(made, SCHEMA), "load_no").collect()}
    assert got == replay(spark, made)


def test_late_rows_belong_to_the_step_in_which_they_arrive(spark):
    made = [(i, 1 if i % 50 == 0 else load, *rest) for i, load, *rest in writings(200)]
    got = {r.raw_id: r.leader for r in deduplicate_batches(spark.createDataFrame(made, SCHEMA), "load_no").collect()}
    assert got == replay(spark, made)


def test_what_a_batch_reads_grows_with_the_batch(spark, tmp_path, monkeypatch):
    """Batches of twenty records, one at a time: records read of the index after 3 and after 11 batches."""
    monkeypatch.setattr(batch_dedup, "BUCKET_RECORDS", 2)
    monkeypatch.setattr(batch_dedup, "LEAST_BUCKETS", 4)
    index = BatchIndex(spark, str(tmp_path / "index"))
    read = {}
    for k in range(12):
        rows = [(k * 20 + i, k, f"{k * 20 + i}/2020C", None, TITLE, URL) for i in range(20)]
        if k in (3, 11):
            forms = signed_forms(canonical_rows(spark.createDataFrame(rows, SCHEMA)))
            touched = [r.b for r in forms.select(F.pmod("place", F.lit(index.state["buckets"])).alias("b")).distinct().collect()]
            read[k] = index.read(touched).count()
        if k < 11:
            index.accept(canonical_rows(spark.createDataFrame(rows, SCHEMA))).count()
    assert index.state["records"] == 11 * 20 == index.read().count() and index.state["buckets"] >= 16
    assert read[11] < 2 * max(read[3], 60) and read[11] < 0.7 * index.state["records"]


def test_two_writers_cannot_both_commit(spark, tmp_path):
    forms = signed_forms(canonical_rows(spark.createDataFrame(rows(), SCHEMA)))
    one, two = (BatchIndex(spark, str(tmp_path / "index")) for _ in range(2))
    one.check(forms)
    with pytest.raises(Exception, match="already exists"):
        two.check(forms)


def test_index_persists_and_takes_empty_batches(spark, tmp_path):
    df = canonical_rows(spark.createDataFrame(rows(), SCHEMA))
    index = BatchIndex(spark, str(tmp_path / "index"))
    assert index.accept(df.where("false")).collect() == []
    index.accept(df.where("raw_id < 8")).collect()
    again = {r.raw_id: r.leader for r in index.accept(df.where("raw_id < 8")).collect()}
    assert again == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    later = [(20, 4, "017/2012C", None, TITLE.lower(), URL), (21, 4, "099/2012C", None, TITLE, URL)]
    got = deduplicate_batches(spark.createDataFrame(later, SCHEMA), "load_no", path=str(tmp_path / "index")).collect()
    assert {r.raw_id: r.leader for r in got} == {20: 1, 21: 21}
    empty = spark.createDataFrame([], SCHEMA)
    assert deduplicate_batches(empty, "load_no").collect() == []


def test_steps_begin_where_a_load_first_appears(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (5, 1), (3, 2), (9, 3), (10, 4), (11, 4), (12, 4), (13, 4)], "raw_id bigint, load_no int")
    last = (1 << 63) - 1
    assert arrival_steps(df, "load_no", "raw_id") == [(1, 2), (3, 9), (10, last)]
    assert arrival_steps(df, "load_no", "raw_id", 100) == [(1, last)] and arrival_steps(df.where("false"), "load_no", "raw_id") == []


def test_similar_titles_share_a_band():
    a, b = band_keys("i", TITLE), band_keys("i", TITLE.replace("regula", "regla"))
    assert set(a) & set(b) and not set(a) & set(band_keys("j", TITLE))
