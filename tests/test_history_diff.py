"""History and snapshot diff against brute force."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tamiz.operators.history import attribute_history
from tamiz.operators.snapshot_diff import content_chunks, latest_per_snapshot, snapshot_changes

SCHEMA = "k string, at timestamp_ntz, loaded timestamp_ntz, id bigint, v string, w date, __key string, version string"


def observations(n=400, seed=1):
    rng = random.Random(seed)
    start = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(n):
        key = rng.choice(["hot"] * 4 + ["a", "b", None])
        at = start + dt.timedelta(hours=rng.randint(0, 200)) if rng.random() > 0.02 else None
        loaded = start + dt.timedelta(hours=rng.randint(0, 400))
        w = rng.choice([None, dt.date(2020, 1, 1)])
        rows.append((key, at, loaded, i, rng.choice(["x", "y", None]), w, "clash", "clash"))
    return rows + rows[:30]


def brute(rows):
    best = {}
    for k, at, loaded, i, v, w, *_ in rows:
        if k is not None and at is not None and (loaded, i) >= best.get((k, at), ((dt.datetime.min, -1), None))[0]:
            best[(k, at)] = ((loaded, i), (v, w))
    out, last = [], {}
    for k, at in sorted(best):
        state = best[(k, at)][1]
        if k not in last or last[k][0] != state:
            if k in last:
                last[k][1][4] = at
            row = [k, at, *state, None]
            out.append(row)
            last[k] = (state, row)
    return sorted(map(tuple, out), key=str)


def history(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return attribute_history(df, F.col("k"), F.col("at"), {"v": F.col("v"), "w": F.col("w")}, [F.col("loaded"), F.col("id")])


def test_history_equals_brute_force(spark):
    rows = observations()
    got = history(spark, rows).collect()
    assert sorted(((r.entity_key, r.valid_from, r.v, r.w, r.valid_to) for r in got), key=str) == brute(rows)
    assert sorted(r.version for r in got if r.entity_key == "hot") == list(range(1, 1 + sum(r.entity_key == "hot" for r in got)))
    assert all(r.is_current == (r.valid_to is None) for r in got)


def test_history_does_not_depend_on_row_order(spark):
    rows = observations(seed=2)
    again = rows[:]
    random.Random(3).shuffle(again)
    assert sorted(map(str, history(spark, rows).collect())) == sorted(map(str, history(spark, again).collect()))


def test_history_of_nothing(spark):
    assert history(spark, []).collect() == []


def test_returning_state_is_a_new_version(spark):
    t = [dt.datetime(2020, 1, d) for d in (1, 2, 3, 4)]
    rows = [("a", t[i], t[i], i, v, None, "", "") for i, v in enumerate(["x", "y", "y", "x"])]
    assert [(r.valid_from, r.v) for r in history(spark, rows).orderBy("valid_from").collect()] == [(t[0], "x"), (t[1], "y"), (t[3], "x")]


def loads(seed=5):
    rng = random.Random(seed)
    state = {f"k{i:03d}": rng.choice("abc") for i in range(300)}
    rows, i = [], 0
    for load in (1, 2, 5, 6):
        for k in rng.sample(sorted(state), 12):
            state[k] = rng.choice(["a", "b", "c", None])
        for k in rng.sample(sorted(state), 5):
            del state[k]
        for _ in range(5):
            state[f"n{load}{rng.randint(0, 99):02d}"] = "a"
        for k, v in state.items():
            for _ in range(1 + (rng.random() < 0.1)):
                i += 1
                rows.append((load, k, v, i))
    return rows + [(None, "k000", "a", 0), (1, None, "a", 0)]


def test_diff_equals_brute_force(spark):
    rows = loads()
    df = spark.createDataFrame(rows, "load_no int, k string, h string, id bigint").withColumn("load", F.lit("clash"))
    current = latest_per_snapshot(df, F.col("load_no"), F.col("k"), F.col("h"), [F.col("id")])
    state = {}
    for load, k, v, _ in rows:
        if load is not None and k is not None:
            state.setdefault(load, {})[k] = v
    want = []
    numbers = sorted(state)
    for one, two in zip(numbers, numbers[1:], strict=False):
        for k in state[one].keys() | state[two].keys():
            if k not in state[one]:
                want.append((two, k, "added"))
            elif k not in state[two]:
                want.append((two, k, "removed"))
            elif state[one][k] != state[two][k]:
                want.append((two, k, "changed"))
    for mean, buckets in ((64, None), (2, 3), (1000, 1)):
        got = snapshot_changes(current, mean, buckets).collect()
        assert sorted((r.load, r.key, r.change) for r in got) == sorted(want)


def test_diff_of_nothing_and_of_one_load(spark):
    df = spark.createDataFrame([], "load int, key string, value string")
    assert snapshot_changes(df).collect() == []
    one = spark.createDataFrame([(1, "a", "x"), (1, "b", None)], "load int, key string, value string")
    assert snapshot_changes(one).collect() == []


def test_chunks_survive_insertions(spark):
    keys = [f"k{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(1, k, "v") for k in keys] + [(2, k, "v") for k in [*keys, "k0100x"]], "load int, key string, value string")
    rows = content_chunks(df, 16, 2).collect()
    chunks = [{(r.bucket, r.chunk, r.key) for r in rows if r.load == n} for n in (1, 2)]
    assert len(chunks[1] - chunks[0]) < 100 and len({(b, c) for b, c, _ in chunks[0]}) > 10
