"""Extraction, delta, cleaning, storage, classification, pages, pipeline and stream on authored fixtures."""

from __future__ import annotations

import urllib.error

import pytest
from pyspark.sql import functions as F

from tamiz.functions.model_json import label_records, labels_of
from tamiz.functions.retry import wait_of, wait_seconds
from tamiz.functions.url import force_https, page_urls, url_join
from tamiz.operators.classify import batch_prompts, classify, numbered_batches, prompt_lines, rule_label, valid_rules
from tamiz.operators.clean import clean, conform, rename_legacy_key
from tamiz.operators.delta import latest_hash, new_or_changed, route, unchanged
from tamiz.operators.detail_extract import extract_detail, pdf_links, second_hop, xpath_scalar
from tamiz.operators.list_extract import ListSpec, extract_list
from tamiz.operators.store import DuplicateKey, SnapshotTable, first_per_key, upserted
from tamiz.plans.pipeline import RunResult, final_table, raw_table, run
from tamiz.plans.spec import SpecError, pipeline_spec, read_yaml
from tamiz.sources.html import parse, select
from tamiz.sources.pages import FetchPolicy, dead_letters, fetch, fetch_pages, good_pages, proxy_table
from tamiz.streaming.incremental import upsert_stream

LIST_PAGE = """<html><body><table cellspacing="1"><tr><td>decoy<td>x</table>
<table cellspacing='0'><tr><td>numero<td>h</tr>
<tr><td>&nbsp;001/2020C&nbsp;<td>one <a href="/a.PDF">pdf</a><a href="/v">  Ver Documento </a><a href="/p/1">real</a> Título: “Uno &amp; dos”</tr>
<tr><td>002/2020C<td>two <a href="">empty</a></tr>
<tr><td>003/2020C<td>three</tr>
<tr><td>only one cell</tr>
<tr><td> <td>blank key</tr>
</table>"""

CFG = {
    "portal": {"domain": "https://portal.invalid", "base_url": "https://portal.invalid/list"},
    "concurrency": {"start_page": 2, "detail": 3},
    "retry": {"attempts": 2, "backoff": {"type": "fixed", "multiplier": 0, "jitter": False}},
    "pipeline": [{"name": "list", "type": "list", "max_pages": 2, "concurrency": "start_page"}, {"name": "detail", "type": "detail", "input_key": "detail_url", "concurrency": "detail"}],
    "selectors": {
        "list": {
            "row_selector": "table[cellspacing='0'] tr", "cell_selector": "td", "detail_link_selector": "td:nth-child(2) a", "detail_link_exclude": {"href_suffix": ".pdf", "text": "ver documento"},
            "title_regex": "Título:\\s*“(.+?)”", "fields": {"numero": "td:nth-child(1)", "texto": "td:nth-child(2)", "ignored": "span"}, "hash": {"key": "row_hash", "fields": ["numero", "texto", "detail_url"]},
        },
        "detail": {"fields": {"objeto": {"regex": r"Objeto:\s*(.*?)Fin"}, "documentos": {"xpath": "//a[contains(@href,'.pdf')]", "attr": "href", "label_attr": "text", "multiple": True}}},
    },
    "storage": {
        "raw": {"table": "raw", "primary_key": "row_hash", "lookup_key": "numero", "columns": {"numero": "TEXT", "row_hash": "TEXT NOT NULL", "last_seen": "TIMESTAMP NOT NULL DEFAULT NOW()"}},
        "final": {"table": "final", "primary_key": "row_hash", "lookup_key": "numero", "columns": {"numero": "TEXT", "titulo": "TEXT", "objeto": "TEXT", "documentos": "JSONB", "sector": "TEXT", "row_hash": "TEXT", "absent": "DATE"}},
    },
    "classifier": {"titulo": "titulo", "detalle": "objeto"},
}
RULES = {"rules": [{"pattern": "salud", "category": "salud"}, {"pattern": "(", "category": "x"}, {"pattern": "only"}], "categories": ["salud", "otros"], "gemini": {"batch_size": 2}}


def test_tree_repairs_and_selects():
    root = parse("<p>a<p>b<ul><li>1<li>2</ul><table><tr><td>x<td>y<tr><td>z</table><br><img src=q>")
    assert [n.text() for n in select(root, "li")] == ["1", "2"] and [len(select(r, "td")) for r in select(root, "tr")] == [2, 1]
    assert [n.text() for n in select(root, "p")] == ["a", "b"] and select(root, "td:nth-child(2)")[0].text() == "y"
    assert select(root, "img[src='q']") and not select(root, "img[src='r']") and len(select(root, "tr > td, li")) == 5
    assert parse(None).text() == parse("").text() == "" and parse("a<b").text().startswith("a")
    with pytest.raises(ValueError):
        select(root, "td::before")
    deep = parse("<div>" * 3000 + "x")
    assert deep.text() == "x" and deep.html().count("<div>") == 3000


def test_paths_of_elements():
    from tamiz.sources.paths import elements

    root = parse("<div id=a><p class=x>one <b>B</b><p>two</div><div><p class=y>three<p class='x z'>four</div><a href='/f.pdf'>PDF</a><a name=n>Ver  Ficha</a>")
    found = lambda path: [" ".join(n.text().split()) for n in elements(root, path)]
    assert found("//p") == ["one B", "two", "three", "four"] and found("//div/p[1]") == ["one B", "three"] and found("//div[2]/p[last()]") == ["four"]
    assert found("//div[@id='a']//b") == ["B"] and found("//p[@class='x' or contains(@class,'z')]") == ["one B", "four"]
    assert found("//p[@class and not(@class='y') and contains(.,'o')]") == ["one B", "four"] and found("//p[b='B']") == ["one B"] and found("//p[b]") == ["one B"]
    assert found("/html/div/p[starts-with(text(),'t')]") == ["two", "three"] and found("//a[(contains(translate(text(),'PDF','pdf'),'pdf')) or @name!='m']") == ["PDF", "Ver Ficha"]
    assert found('//a[normalize-space(.)="Ver Ficha"]') == ["Ver Ficha"] and found("//*[@href]") == ["PDF"] and found("//p[2][@class]") == ["four"]
    for bad in ("", "a[", "//a[foo(.)]", "//a[1", "//a/@href/..", "//a[@x='1"):
        with pytest.raises(ValueError):
            elements(root, bad)


def list_spec():
    return pipeline_spec(CFG, RULES).list_spec


def test_list_page(spark):
    pages = spark.createDataFrame([(0, LIST_PAGE), (1, None), (2, "")], "page_no int, html string")
    rows = extract_list(pages, list_spec(), carry=["page_no"]).orderBy("row_no").collect()
    assert [r.numero for r in rows] == ["001/2020C", "002/2020C", "003/2020C"]
    assert [r.detail_url for r in rows] == ["https://portal.invalid/p/1", "https://portal.invalid", ""]
    assert [r.titulo for r in rows] == ["Uno &amp; dos", "002/2020C", "003/2020C"]


def test_title_without_group_and_no_link_column(spark):
    pages = spark.createDataFrame([(LIST_PAGE,)], "html string")
    spec = ListSpec("table[cellspacing='0'] tr", "td", {"numero": 0, "titulo": 1}, link_column=1, title_regex="", domain="https://d")
    assert {r.titulo for r in extract_list(pages, spec).collect() if r.numero == "003/2020C"} == {"three"}
    assert "detail_url" not in extract_list(pages, ListSpec("tr", "td", {"numero": 0})).columns


def test_detail_page(spark):
    html = """<h1> T <br></h1><input name="N" value=" v "><p>2020-01-02 2021-03-04<p>Objeto: uno\ndos Observaciones: tres\n\nfin<a href="/a.pdf">A</a><a href="/a.pdf">B</a><a href="/b.PDF"></a><a href="">c</a>"""
    fields = {
        "h": {"xpath": "//h1/text()"}, "el": {"xpath": "//h1"}, "v": {"xpath": "//input[@name='N']/@value"}, "attr": {"xpath": "//input", "attr": "name"}, "none": {"xpath": "//h9/text()"},
        "d1": {"find_all": True, "regex": "([0-9]{4}-[0-9]{2}-[0-9]{2})", "index": 1}, "d9": {"find_all": True, "regex": "([0-9]{4}-[0-9]{2}-[0-9]{2})", "index": 9},
        "o": {"regex": r"objeto:\s*(.*?)Observaciones:"}, "b": {"block_after": "Observaciones:", "regex": r"\s*(.*?)(?:\n\n|$)"}, "x": {"other": 1},
        "docs": {"xpath": "//a[contains(@href,'.pdf')]", "attr": "href", "label_attr": "text", "multiple": True}, "texts": {"xpath": "//a[contains(@href,'.pdf')]", "multiple": True},
        "hrefs": {"xpath": "//a[contains(@href,'.pdf')]/@href", "multiple": True},
    }
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, html string")
    one, two, three = extract_detail(pages, fields, "https://d", carry=["id"]).orderBy("id").collect()
    assert (one.h, one.el, one.v, one.attr, one.none) == ("T", "T", "v", "N", "") and (one.d1, one.d9, one.o, one.b, one.x) == ("2021-03-04", "", "uno\ndos", "tres", None)
    assert [(d.label, d.url) for d in one.docs] == [("A", "https://d/a.pdf")] and one.texts == ["A", "B"] and one.hrefs == ["/a.pdf", "/a.pdf"]
    assert two.h == three.h == "" and two.docs == three.docs == []
    pdfs = pages.select(pdf_links(F.col("html"), F.lit("https://d/x/"))).collect()
    assert pdfs[0][0] == ["https://d/a.pdf", "https://d/a.pdf", "https://d/b.PDF"] and pdfs[1][0] == []
    assert spark.range(1).select(xpath_scalar(F.lit("<a>12/03/2020 x</a>"), "//a/text()", pattern="([0-9/]{10})")).first()[0] == "12/03/2020"


def test_second_hop(spark):
    records = spark.createDataFrame([(1, [], "e/1"), (2, ["k"], "e/1"), (3, [], ""), (4, None, "e/9"), (5, [], None)], "id int, documentos array<string>, expediente_url string")
    pages = spark.createDataFrame([("https://d/e/1", "<a href='x.pdf'>"), ("https://d/e/1", "<a href='x.pdf'>"), ("https://d/e/2", None)], "url string, html string")
    got = {r.id: r.documentos for r in second_hop(records, pages, "http://d").collect()}
    assert got == {1: ["https://d/e/x.pdf"], 2: ["k"], 3: [], 4: None, 5: []}


def test_urls(spark):
    df = spark.createDataFrame([("https://d/a/", h) for h in ["", "?q", "#f", "//h/x", "../u", "javascript:x", None]], "b string, h string")
    assert [r[0] for r in df.select(url_join("b", "h")).collect()] == ["https://d/a/", "https://d/a/?q", "https://d/a/#f", "https://h/x", "https://d/u", "javascript:x", None]
    assert spark.range(1).select(force_https(F.lit("http://x")), force_https(F.lit("/x"))).first()[:] == ("https://x", "/x")
    assert [r.url for r in page_urls(spark, "u", 3).orderBy("page_no").collect()] == ["u", "u?page=1", "u?page=2"]
    assert [r[0] for r in spark.range(1, 8).select(wait_seconds(F.col("id"))).collect()] == [1, 2, 4, 8, 16, 30, 30] == [wait_of(i, "exponential", 1, 30) for i in range(1, 8)]


def test_delta(spark):
    raw = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "1", 1), ("b", "0", 1)], "k string, h string, t int")
    known = latest_hash(raw, "k", "h", "t")
    assert {(r.k, r.h) for r in known.collect()} == {("a", "2"), ("b", "1")}
    inc = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", None), ("c", "1"), (None, "1")], "k string, h string")
    routes = {(r.k, r.h): r.route for r in route(inc, known, "k", "h").collect()}
    assert routes == {("a", "2"): "bypass", ("a", "1"): "to_detail", ("b", None): "to_detail", ("c", "1"): "to_detail", (None, "1"): "to_detail"}
    assert new_or_changed(inc, known, "k", "h").count() == 4 and unchanged(inc, known, "k", "h").count() == 1


def test_clean_and_conform(spark):
    df = spark.createDataFrame([(" a\xa0", "", "[1]"), ("", "2020-01-02", ""), (None, "x", None), ("b", " 2020-13-40", " ")], "no_camara string, d string, j string")
    assert [(r.no_camara, r.x, r.y) for r in clean(df, "no_camara", {"x": "d", "y": "gone"}).collect()] == [("a", None, None), ("b", " 2020-13-40", None)]
    rows = conform(df, {"no_camara": "TEXT", "d": "DATE", "j": "JSONB", "new": "TEXT", "t": "TIMESTAMP", "k": "JSONB"}).collect()
    assert [r.no_camara for r in rows] == [" a\xa0", None, None, "b"] and [str(r.d) for r in rows] == ["None", "2020-01-02", "None", "None"]
    assert [r.j for r in rows] == ["[1]", "[]", "[]", "[]"] and {(r.new, r.t, r.k) for r in rows} == {(None, None, "[]")}
    peru = conform(spark.createDataFrame([("31/12/2024",)], "d string"), {"d": "DATE"}, {"d": "dd/MM/yyyy"})
    assert str(peru.first().d) == "2024-12-31" and rename_legacy_key(df, "numero").columns[0] == "numero"
    with pytest.raises(ValueError):
        conform(df, {"d": "POINT"})


def test_upsert(spark):
    target = spark.createDataFrame([("1", "old", "t1"), ("2", "keep", "t1")], "h string, v string, seen string")
    batch = spark.createDataFrame([("1", None), ("3", "new")], "h string, v string")
    got = {r.h: (r.v, r.seen) for r in upserted(target, batch, "h", keep=["seen"], defaults={"seen": F.lit("now")}).collect()}
    assert got == {"1": (None, "t1"), "2": ("keep", "t1"), "3": ("new", "now")}
    twice = spark.createDataFrame([("1", "b", 2), ("1", "a", 1), ("", "x", 0), (None, "x", 0)], "h string, v string, n int")
    assert [(r.h, r.v) for r in first_per_key(twice, "h", ["n"]).collect()] == [("1", "a")]


def test_snapshot_table(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), {"h": "TEXT NOT NULL", "v": "TEXT"}, "h")
    assert t.read().count() == 0
    t.create()
    batch = spark.createDataFrame([("1", "a"), ("2", "b")], "h string, v string")
    reader = t.read()
    assert t.upsert(batch) and t.upsert(batch) and t.read().count() == 2 and reader.count() == 0
    assert not t.upsert(batch.where("false"))
    with pytest.raises(DuplicateKey):
        t.upsert(batch.unionByName(batch))
    assert t.read().count() == 2


def test_an_upsert_rewrites_the_parts_of_its_keys_only(spark, tmp_path, monkeypatch):
    from tamiz.operators import store

    t = SnapshotTable(spark, str(tmp_path / "t"), {"h": "TEXT NOT NULL", "v": "TEXT"}, "h")
    t.upsert(spark.createDataFrame([(str(i), "a") for i in range(200)], "h string, v string"))
    before = t.state()
    assert t.upsert(spark.createDataFrame([("7", "b")], "h string, v string"))
    after = t.state()
    assert len(before["folders"]) == 8 and [p for p in before["folders"] if before["folders"][p] != after["folders"][p]].__len__() == 1
    assert t.read().count() == 200 == sum(after["records"].values()) and t.read().where("v = 'b'").collect()[0].h == "7"
    monkeypatch.setattr(store, "PART_RECORDS", 10)
    t.upsert(spark.createDataFrame([("8", "c"), ("new", "c")], "h string, v string"))
    assert t.state()["parts"] == 32 and t.read().count() == 201 and t.read().where("v <> 'a'").count() == 3
    for k in range(4):
        t.upsert(spark.createDataFrame([("8", str(k))], "h string, v string"))
    assert len(t._versions()) == 3 and t.read().count() == 201
    assert len([f for f in (tmp_path / "t").iterdir() if f.name.startswith("data-")]) <= 4


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    from tamiz.operators.store import ConcurrentCommit

    t = SnapshotTable(spark, str(tmp_path / "t"), {"h": "TEXT NOT NULL", "v": "TEXT"}, "h")
    t.create()
    began = t.state()
    t.upsert(spark.createDataFrame([("1", "a")], "h string, v string"))
    monkeypatch.setattr(t, "state", lambda: began)
    with pytest.raises(ConcurrentCommit):
        t.upsert(spark.createDataFrame([("2", "b")], "h string, v string"))
    monkeypatch.undo()
    assert [r.h for r in t.read().collect()] == ["1"]


def test_rules_and_batches(spark):
    assert valid_rules([{"pattern": "Foo", "category": "x"}, {"pattern": "("}, {"pattern": "(", "category": "y"}, {}]) == [("Foo", "x")]
    df = spark.createDataFrame([("This foo test",), ("nothing here",), (None,)], "t string")
    assert [r[0] for r in df.select(rule_label(F.col("t"), [("Foo", "sector_foo")])).collect()] == ["sector_foo", "", ""]
    numbers = spark.range(0, 1000, 1, 7).select(F.col("id"), (999 - F.col("id")).alias("o"))
    rows = numbered_batches(numbers, ["o"], 20).collect()
    assert all(r.place == r.o and r.batch == r.o // 20 for r in rows) and len(rows) == 1000
    prompts = batch_prompts(numbered_batches(numbers, ["o"], 300), prompt_lines(F.col("o"), F.lit(None), F.lit("d")), "H\n").orderBy("batch").collect()
    assert len(prompts) == 4 and prompts[0].prompt.startswith("H\n0:  -- d\n1:  -- d")


def test_model_labels(spark):
    answers = {
        '[{"id": "1", "label": "a"}, {"id": "1", "label": "b"}, {"id": 2, "label": "c"}, {"id": "", "label": "d"}, {"id": "3", "label": null}]': {"1": "b", "2": "c"},
        '{"id": "1", "label": "a"}': {}, "broken [": {}, "": {}, None: {}, '```json\n[{"id": "1", "label": "a"}]\n```': {}, '[1, "x", {"id": "9", "label": "z"}]': {"9": "z"}, "[]": {},
    }
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "n int, r string")
    assert {(r.n, r.id, r.label) for r in labels_of(df, "r", ["n"]).collect()} == {(n, k, v) for n, m in enumerate(answers.values()) for k, v in m.items()}
    assert df.select(F.max(F.size(label_records(F.col("r"))))).first()[0] == 3


def test_classifier_with_a_model(spark):
    rows = spark.createDataFrame([("1", "Proj1", "Detail1"), ("2", "Proj2", None), ("3", "plan de SALUD", ""), ("4", None, None)], "id string, title string, detail string")
    model = lambda prompt: '[{"id": "1", "label": "sector_valid"}, {"id": "2", "label": "strange"}]' if "1: " in prompt else 1 / 0
    got = {r.id: r.sector for r in classify(rows, "id", "title", "detail", [("salud", "salud")], ["sector_valid", "salud"], model, 2).collect()}
    assert got == {"1": "sector_valid", "2": "otros", "3": "salud", "4": "otros"}
    assert {r.sector for r in classify(rows, "id", "title", "detail", [], ["x"]).collect()} == {"otros"}


def test_fetching(spark):
    calls = []

    def get(url, headers, proxy, timeout):
        calls.append((url, proxy))
        if url == "check":
            return (200, "") if proxy != "p1" else (500, "")
        if proxy == "p2":
            raise urllib.error.HTTPError(url, 403, "no", None, None)
        if proxy == "p3" or url == "good":
            return 200, "page"
        raise OSError("down")

    assert fetch("good", FetchPolicy(), get)["html"] == "page"
    policy = FetchPolicy(attempts=2, kind="fixed", multiplier=0, jitter=False, proxies=("p1", "p2", "p3"), check_url="check")
    assert fetch("bad", policy, get, lambda s: None)["attempts"] == 1
    lost = fetch("bad", FetchPolicy(attempts=2, jitter=False), get, calls.append)
    assert lost["html"] is None and "down" in lost["error"] and calls.count(1.0) == 1
    answer = lambda url, headers, proxy, timeout: (200, url * 2) if url != "x" else 1 / 0
    pages = fetch_pages(spark.createDataFrame([("a",), ("a",), ("x",), ("",), (None,)], "url string"), FetchPolicy(attempts=1), 2, answer)
    assert {(r.url, r.html) for r in good_pages(pages).collect()} == {("a", "aa")} and [r.url for r in dead_letters(pages).collect()] == ["x"]
    with pytest.raises(RuntimeError):
        good_pages(pages, "failfast")
    row = "<tr>" + "".join(f"<td>{c}" for c in ("1.2.3.4", "80", "", "", "", "", "{}"))
    html = f"<table id=other></table><table id=proxylisttable><tr><th>h{row.format(' Yes ')}{row.format('no')}<tr><td>short</table>"
    assert proxy_table(html) == ["http://1.2.3.4:80"] and proxy_table("no table") == []


def test_spec():
    spec = pipeline_spec(CFG, RULES)
    assert spec.list_spec.fields == {"numero": 0, "texto": 1} and spec.rules == (("salud", "salud"),) and spec.fetch.kind == "fixed" and spec.batch_size == 2
    with pytest.raises(SpecError):
        pipeline_spec({k: v for k, v in CFG.items() if k != "storage"})
    with pytest.raises(FileNotFoundError):
        read_yaml("no/such/file.yml")


def pages(spark, day):
    html = LIST_PAGE.replace("one ", f"one {day} ")
    return spark.createDataFrame([(0, "u", html)], "page_no int, url string, html string")


def detail(spark):
    return spark.createDataFrame([("https://portal.invalid/p/1", "Objeto: la salud Fin <a href='/d.pdf'>D</a>"), ("https://portal.invalid/p/1", "Objeto: la salud Fin <a href='/d.pdf'>D</a>")], "url string, html string")


def test_runs(spark, tmp_path):
    spec, root = pipeline_spec(CFG, RULES), str(tmp_path)
    assert run(spark, spec, root, pages(spark, "a"), detail(spark)) == RunResult(3, 3, 0, 3)
    stored = {r.numero: r for r in final_table(spark, spec, root).read().collect()}
    assert stored["001/2020C"].sector == "salud" and stored["001/2020C"].objeto == "la salud" and stored["001/2020C"].documentos == '[{"label":"D","url":"https://portal.invalid/d.pdf"}]'
    assert stored["003/2020C"].sector == "otros" and stored["003/2020C"].documentos == "[]" and stored["003/2020C"].absent is None
    assert run(spark, spec, root, pages(spark, "a"), detail(spark)) == RunResult(3, 0, 3, 0)
    assert run(spark, spec, root, pages(spark, "b"), detail(spark)) == RunResult(3, 1, 2, 1)
    assert final_table(spark, spec, root).read().count() == 4
    seen = {r.row_hash: r.last_seen for r in raw_table(spark, spec, root).read().collect()}
    run(spark, spec, root, pages(spark, "a"), detail(spark))  # back to the first state: nothing new, times kept
    assert {r.row_hash: r.last_seen for r in raw_table(spark, spec, root).read().collect()} == seen and final_table(spark, spec, root).read().count() == 4
    with pytest.raises(ValueError):
        run(spark, spec, root)


def test_live_run_keeps_what_failed_and_logs_its_counts(spark, tmp_path):
    import json

    from tamiz.plans.pipeline import failed_table, log_table

    site = {"https://portal.invalid/list": LIST_PAGE, "https://portal.invalid/p/1": "Objeto: la salud Fin", "https://portal.invalid": "<p>"}
    get = lambda url, headers, proxy, timeout: (200, site[url])
    model = lambda prompt: '[{"id": "002/2020C", "label": "otros"}]'
    spec, root = pipeline_spec(CFG, RULES), str(tmp_path)
    result = run(spark, spec, root, live=True, model=model, get=get)
    assert result == RunResult(3, 3, 0, 3, 1, 1)
    lost = failed_table(spark, root).read().collect()
    assert [r.url for r in lost] == ["https://portal.invalid/list?page=1"] and "KeyError" in lost[0].error
    assert [json.loads(r.counts)["failed_pages"] for r in log_table(spark, root).read().collect()] == [1]
    del site["https://portal.invalid/p/1"]
    with pytest.raises(RuntimeError):
        run(spark, spec, str(tmp_path / "other"), live=True, get=get)


def test_failed_pages_are_asked_for_again_behind_the_others(spark, tmp_path):
    from tamiz.session import scratch
    from tamiz.sources.pages import fetch_in_rounds

    tried = tmp_path / "tried"

    def get(url, headers, proxy, timeout):
        with tried.open("a") as f:
            f.write(url + "\n")
        if url == "never" or url == "late" and tried.read_text().count("late") == 1:
            raise OSError("down")
        return 200, url

    urls = spark.createDataFrame([("late",), ("never",), ("good",)], "url string")
    with scratch(spark) as stage:
        rows = fetch_in_rounds(urls, FetchPolicy(attempts=1), 1, 3, stage, get).collect()
    assert sorted((r.url, r.html) for r in rows if r.html) == [("good", "good"), ("late", "late")] and [r.url for r in rows if not r.html] == ["never"]
    order = tried.read_text().split()
    assert len(order) == 6 and order[3:].count("never") == 2 and "good" in order[:3]


def test_tables_with_the_key_of_old(spark, tmp_path):
    cfg = {**CFG, "storage": {**CFG["storage"], "raw": {**CFG["storage"]["raw"], "columns": {"no_camara": "TEXT", "row_hash": "TEXT NOT NULL"}}}}
    spec, root = pipeline_spec(cfg, RULES), str(tmp_path)
    assert run(spark, spec, root, pages(spark, "a"), detail(spark)).to_detail == 3
    assert sorted(r.no_camara for r in raw_table(spark, spec, root).read().collect()) == ["001/2020C", "002/2020C", "003/2020C"]
    assert run(spark, spec, root, pages(spark, "a"), detail(spark)).bypass == 3


def test_no_update_is_lost_when_a_run_fails_before_the_raw_commit(spark, tmp_path, monkeypatch):
    spec, root = pipeline_spec(CFG, RULES), str(tmp_path)
    monkeypatch.setattr("tamiz.plans.pipeline.with_key", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, spec, root, pages(spark, "a"), detail(spark))
    monkeypatch.undo()
    assert raw_table(spark, spec, root).read().count() == 0
    assert run(spark, spec, root, pages(spark, "a"), detail(spark)).to_detail == 3 and final_table(spark, spec, root).read().count() == 3


def test_stream_equals_batch(spark, tmp_path):
    rows = [(str(i % 40), f"v{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "h string, v string, n int")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    columns = {"h": "TEXT", "v": "TEXT"}
    one, two = SnapshotTable(spark, str(tmp_path / "a"), columns, "h"), SnapshotTable(spark, str(tmp_path / "b"), columns, "h")
    one.upsert(df, order=["n"])
    two.create()
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    for _ in range(2):
        upsert_stream(stream, two, str(tmp_path / "state"), ["n"]).awaitTermination()
    assert sorted(one.read().collect()) == sorted(two.read().collect())


def test_counts_and_short_answers(spark):
    from tamiz.operators.metrics import counted, short_answers

    df, seen = counted(spark.range(10), "seen", even=F.col("id") % 2 == 0)
    df.collect()
    assert seen.get == {"rows": 10, "even": 5}
    batched = spark.createDataFrame([(0, 1), (0, 2), (1, 3)], "batch bigint, place bigint")
    labels = spark.createDataFrame([(1, "3", "x")], "batch bigint, id string, label string")
    assert [tuple(r) for r in short_answers(batched, labels).collect()] == [(0, 2, 0)]


def test_statements():
    from tamiz.sources.postgres import create_statement, upsert_statement

    assert create_statement("t", {"k": "TEXT", "v": "DATE"}, "k") == "CREATE TABLE IF NOT EXISTS t (k TEXT, v DATE, PRIMARY KEY (k))"
    assert upsert_statement("t", ["k", "v"], "k") == "INSERT INTO t (k, v) VALUES %s ON CONFLICT (k) DO UPDATE SET v = EXCLUDED.v"
    assert upsert_statement("t", ["k"], "k").endswith("DO NOTHING")


def test_command_line(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    from tamiz.__main__ import main

    for name, value in (("spec.yml", CFG), ("rules.yml", RULES)):
        (tmp_path / name).write_text(yaml.safe_dump(value, allow_unicode=True))
    pages(spark, "a").write.parquet(str(tmp_path / "pages"))
    detail(spark).write.parquet(str(tmp_path / "detail"))
    args = [str(tmp_path / "spec.yml"), "--classifier", str(tmp_path / "rules.yml"), "--root", str(tmp_path / "store"), "--pages", str(tmp_path / "pages"), "--detail", str(tmp_path / "detail")]
    main(args)
    spec = pipeline_spec(CFG, RULES)
    assert final_table(spark, spec, str(tmp_path / "store")).read().count() == 3


def test_http_source(spark, tmp_path):
    import http.server
    import threading

    from tamiz.sources.pages import register_http_source

    (tmp_path / "a.html").write_text("<p>hola</p>")
    handler = lambda *a: http.server.SimpleHTTPRequestHandler(*a, directory=str(tmp_path))
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    try:
        register_http_source(spark)
        rows = spark.read.format("tamiz_http").option("urls", f"{base}/a.html\n{base}/b.html").option("attempts", "1").load().collect()
    finally:
        server.shutdown()
    assert sorted((r.html or "", r.status or 0) for r in rows) == [("", 0), ("<p>hola</p>", 200)]


def test_model_behind_http(spark):
    import http.server
    import json
    import threading

    from tamiz.sources.models import HttpModel

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["parts"][0]["text"]
            ids = [line.split(":")[0] for line in asked.splitlines()]
            said = json.dumps({"out": [{"text": json.dumps([{"id": i, "label": "salud"} for i in ids])}]}).encode()
            self.send_response(200 if "2" not in ids else 500)
            self.end_headers()
            self.wfile.write(said)

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        model = HttpModel(f"http://127.0.0.1:{server.server_port}/", {"parts": [{"text": "{prompt}"}]}, ("out", 0, "text"), policy=FetchPolicy(attempts=2, kind="fixed", multiplier=0, jitter=False))
        rows = spark.createDataFrame([("1", "a", None), ("2", "b", None)], "id string, title string, detail string")
        got = {r.id: r.sector for r in classify(rows, "id", "title", "detail", [], ["salud"], model, 1).collect()}
    finally:
        server.shutdown()
    assert got == {"1": "salud", "2": "otros"}


def test_proxies_are_refreshed_or_kept():
    from tamiz.sources.pages import refreshed

    html = "<table id=proxylisttable><tr><th>h<tr>" + "".join(f"<td>{c}" for c in ("1.2.3.4", "80", "", "", "", "", "yes")) + "</table>"
    policy = FetchPolicy(proxies=("old",), proxy_page="list")
    assert refreshed(policy, lambda *a: (200, html)).proxies == ("http://1.2.3.4:80",)
    assert refreshed(policy, lambda *a: (200, "")) is policy and refreshed(policy, lambda *a: 1 / 0) is policy and refreshed(FetchPolicy(), None).proxies == ()


def test_only_small_scans_are_spread(spark, tmp_path):
    from tamiz.session import spread

    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    scan = spark.read.parquet(str(tmp_path / "one"))
    moved = spread(scan.where("id >= 0"))
    assert moved.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and moved.count() == 100
    grouped = scan.groupBy("id").count()
    assert spread(grouped) is grouped
    wide = spark.range(0, 100, 1, 64)
    assert spread(wide) is wide
