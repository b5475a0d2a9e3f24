"""Text expressions against the standard library."""

from __future__ import annotations

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tamiz.functions.checksum import canonical_json, checksum_or_computed, row_checksum, with_checksum
from tamiz.functions.links import link_set
from tamiz.functions.text import after_marker, entity_key, find_all_at, is_blank, jvm_pattern, search_group, strip
from tamiz.plans.labels import RULES

SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def column(spark, values, name="s"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def run(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def test_strip_equals_python_for_every_space(spark):
    values = [f"{s}a{s}b{s}" for s in SPACES] + ["​x​", "﻿x", "", " ", None]
    assert run(column(spark, values), strip("s")) == [v.strip() if v is not None else None for v in values]


def test_entity_key_and_blank(spark):
    values = ["\xa0 017/2007c\t", "", "  ", None]
    assert run(column(spark, values), entity_key("s")) == ["017/2007C", None, None, None]
    assert run(column(spark, values), is_blank(F.col("s"))) == [False, True, True, True]


@pytest.mark.parametrize("pattern", [p for p, _ in RULES] + [r"a\sb", r"[\s,]+x", r"^a.c$", r"caf[eé]", r"\S+"])
def test_patterns_agree_with_re(spark, pattern):
    values = ["MINERÍA de Oro", "tesoro", "CAFÉ\nagricultura", "CREACIÓN de un\nDISTRITO", "creación x distrito", "a\xa0b", "a b", "A\rC", "abc\n", "x", " ,x", "Tratado", "", "Ó ó Í í"]
    got = run(column(spark, values), F.col("s").rlike(jvm_pattern(pattern)))
    assert got == [re.search(pattern, v, re.I) is not None for v in values]


def test_group_find_all_and_marker(spark):
    df = column(spark, ["x 2024-01-02 y 2025-03-04", "none", None, ""])
    pattern = "([0-9]{4}-[0-9]{2}-[0-9]{2})"
    assert run(df, search_group(F.col("s"), pattern)) == ["2024-01-02", "", "", ""]
    assert run(df, find_all_at(F.col("s"), pattern, 1)) == ["2025-03-04", "", "", ""]
    with pytest.raises(ValueError):
        find_all_at(F.col("s"), "(a)(b)")
    df = column(spark, ["a:b:c", "abc", None])
    assert run(df, after_marker(F.col("s"), ":")) == ["b:c", "abc", None]


def test_checksum_equals_json_dumps(spark):
    rng = random.Random(7)
    alphabet = [chr(i) for i in range(32)] + list('"\\/ áÑ€😀\x7f abc')
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(400)] + [None]
    df = column(spark, values, "name").withColumn("id", F.lit("1"))
    want = [json.dumps({"id": "1", "name": v or ""}, sort_keys=True, ensure_ascii=False) for v in values]
    assert run(df, canonical_json({"name": F.col("name"), "id": F.col("id")})) == want
    assert run(df, row_checksum(df, ["name", "id"])) == [hashlib.md5(w.encode()).hexdigest() for w in want]


def test_checksum_of_configured_fields_only(spark):
    df = spark.createDataFrame([("123", "Test Name", "ignored", "")], "id string, name string, extra string, row_hash string")
    want = hashlib.md5(b'{"id": "123", "name": "Test Name"}').hexdigest()
    assert with_checksum(df, ["name", "id"], "h").first()["h"] == want
    assert df.select(checksum_or_computed(df, ["id", "name"], "row_hash")).first()[0] == want
    assert with_checksum(df, []).columns == df.columns
    missing = hashlib.md5(b'{"gone": "", "id": "123"}').hexdigest()
    assert df.select(row_checksum(df, ["id", "gone"])).first()[0] == missing


def test_link_set(spark):
    values = [
        '["https://x/b", "https://x/a", "https://x/a"]', '[{"label": "t", "url": "https://x/a"}, "https://x/b"]', '{"url": "https:\\/\\/x\\/a"}',
        "see https://x/a, https://x/b", "[]", "[ ]", "", " ", None, '[\n {\n "url": "https://x/a",\n "label": ""}]',
    ]
    ab = ["https://x/a", "https://x/b"]
    assert run(column(spark, values), link_set(F.col("s"))) == [ab, ab, ab[:1], ab, [], [], [], [], [], ab[:1]]
