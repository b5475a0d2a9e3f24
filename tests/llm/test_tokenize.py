"""Corpus encoding against direct encoding, and an exact round trip."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tamiz.llm.tokenize import DEFAULT_FOLDER, cut_text, encode_corpus, encoding, halves, join_encodings, join_tree

pytestmark = pytest.mark.skipif(not os.path.exists(f"{DEFAULT_FOLDER}/byte_bpe_50k.tiktoken"), reason="no vocabulary files")

PARTS = ["a", "b", "é", "Ñ", " ", "\n", "\t", "1", "'s", "'ll", "!", "…", "漢", "😀", "-", "<|endoftext|>", "\x1c", "\x85", "²", "́"]


def texts(n=150, seed=1):
    rng = random.Random(seed)
    made = ["".join(rng.choice(PARTS) * rng.choice([1, 1, 2, 5, 30]) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return made + ["", None, " ", "a" * 3000, " " * 500 + "x", "the cat sat on the mat " * 60, "<|endoftext|>"]


def test_encoding_equals_direct_encoding_at_any_part_size(spark):
    values = texts()
    df = spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string").withColumn("ids", F.lit("clash")).withColumn("key", F.lit(1))
    enc = encoding()
    want = {i: enc.encode_ordinary(t or "") for i, t in enumerate(values)}
    for whole, half in ((1 << 16, 1 << 13), (16, 5), (3, 2)):
        got = encode_corpus(df, "doc_id", "text", whole=whole, half=half).collect()
        assert {r.doc_id: r.ids for r in got} == want and len(got) == len(values)
    assert all(enc.decode(want[i]) == (t or "") for i, t in enumerate(values))


def test_same_ids_as_the_other_library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{DEFAULT_FOLDER}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    for text in texts(60, 2):
        assert t.encode(text or "", add_special_tokens=False).ids == encoding().encode_ordinary(text or "")


def test_tree_of_halves_equals_the_whole():
    enc = encoding()
    rng = random.Random(3)
    for size in (1, 2, 50, 4000):
        text = "".join(rng.choice("abcdeñ") for _ in range(size))
        parts = [enc._encode_single_piece(h) for h in halves(text, 7)]
        assert join_tree(parts, enc._encode_single_piece, enc.decode_single_token_bytes) == enc._encode_single_piece(text)
    assert join_encodings([], [1], None, None) == [1]


def test_cuts_lose_nothing():
    for text in texts(50, 4):
        for size in (1, 5, 100):
            assert "".join(cut_text(text or "", size)) == (text or "")


def test_empty_table(spark):
    assert encode_corpus(spark.createDataFrame([], "doc_id bigint, text string"), "doc_id", "text").collect() == []


def test_long_runs_of_real_letters_go_through_the_tree(spark):
    from tamiz.llm.queries import p6_runs

    rows = p6_runs(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 16 and all(r.same for r in rows) and min(r.letters for r in rows) > 10_000


def test_megabytes_without_a_split(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefñoaei") for _ in range(3_000_000))
    got = encode_corpus(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), "doc_id", "text").collect()
    assert got[0].ids == encoding()._encode_single_piece(text)
