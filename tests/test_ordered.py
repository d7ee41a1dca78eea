import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rivulet.functions import times
from rivulet.operators import ordered
from tests.conftest import as_set


@pytest.mark.parametrize("chunk", [1, 3, 7, 1000])
def test_lags_do_not_depend_on_chunks(spark, chunk):
    rng = random.Random(chunk)
    rows, want = [], {}
    for key, size in (("a", 40), ("b", 3), ("c", 1)):
        at = sorted(rng.sample(range(100), size))
        values = [rng.random() for _ in at]
        rows += [(key, t, v) for t, v in zip(at, values)]
        for i, t in enumerate(at):
            want[key, t] = [values[i - k] if i >= k else None for k in range(1, 6)]
    d = spark.createDataFrame(rows, "k string, t long, v double").repartition(3)
    lagged = ordered.lag_columns(
        ordered.with_lags(d, ["k"], "t", ["v"], 5, F.floor(F.col("t") / chunk)), ["v"], 5
    )
    got = {(r.k, r.t): [r[f"v_lag{i}"] for i in range(1, 6)] for r in lagged.collect()}
    assert got == want


def test_lags_keep_null_values_in_their_place(spark):
    d = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0)], "k string, t long, v double")
    lagged = ordered.lag_columns(ordered.with_lags(d, ["k"], "t", ["v"], 2, F.col("t")), ["v"], 2)
    assert as_set(lagged, "t", "v_lag1", "v_lag2") == {(1, None, None), (2, 1.0, None), (3, None, 1.0)}


def test_positions_are_global_with_a_hot_first_key(spark):
    rows = [(0, i) for i in range(300)] + [(k, i) for k in range(1, 20) for i in range(15)]
    random.Random(1).shuffle(rows)
    d = spark.createDataFrame(rows, "a long, b long").repartition(7)
    got = {r.position: (r.a, r.b) for r in ordered.with_position(d, ["a", "b"]).collect()}
    assert [got[i] for i in range(len(rows))] == sorted(rows)


@pytest.mark.parametrize("posts, size", [(12, 3), (11, 3), (2, 3), (79, 1), (119, 2), (1030, 25), (1, 1)])
def test_batches_keep_every_post(spark, posts, size):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=i // 2), i) for i in range(posts)]
    random.Random(2).shuffle(rows)
    d = spark.createDataFrame(rows, "ts timestamp_ntz, id long").repartition(5)
    got = {r.id: r.slot for r in ordered.batch_by_count(d, ["ts", "id"], size).collect()}
    assert got == {i: i // size for i in range(posts)}


def test_more_batches_than_slots_are_an_error(spark):
    d = spark.range(13).toDF("id")
    assert {r.slot for r in ordered.batch_by_count(d, ["id"], 3, 5).collect()} == set(range(5))
    with pytest.raises(ValueError):
        ordered.batch_by_count(d, ["id"], 3, 4)
    assert ordered.batch_by_count(d.limit(0), ["id"], 3, 4).count() == 0


def test_lists_are_contiguous_parts(spark):
    rows = [("hot", 7)] * 50_000 + [("long", i) for i in range(2500)] + [(None, 1), (None, 2), ("one", 5)]
    d = spark.createDataFrame(rows, "k string, v long").repartition(6)
    lists = {(r.k, r.part): [i.v for i in r["items"]] for r in ordered.collect_lists(d, "k", ["v"]).collect()}
    assert {p: len(v) for (k, p), v in lists.items() if k == "hot"} == {p: 1000 for p in range(50)}
    assert [lists["long", p] for p in range(3)] == [list(range(1000)), list(range(1000, 2000)), list(range(2000, 2500))]
    assert lists[None, 0] == [1, 2] and lists["one", 0] == [5] and len(lists) == 55


def test_null_keys_stay(spark):
    d = spark.createDataFrame([(None, 1, 1.0), (None, 2, 3.0), ("a", 1, 5.0), ("a", None, 4.0)], "k string, t long, v double")
    lagged = ordered.lag_columns(ordered.with_lags(d, ["k"], "t", ["v"], 1), ["v"], 1)
    assert as_set(lagged, "k", "t", "v_lag1") == {(None, 1, None), (None, 2, 1.0), ("a", None, None), ("a", 1, 4.0)}
    assert as_set(ordered.min_max_scaled(d, ["v"], ["k"]), "k", "v") == {(None, 0.0), (None, 1.0), ("a", 1.0), ("a", 0.0)}


@pytest.mark.parametrize("kind", ["sparse", "text", "struct", "time"])
def test_chunks_are_even_for_any_order(spark, kind):
    order = {
        "sparse": F.col("id") * 60_000_000 - (1 << 50),
        "text": F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 9, "0")),
        "struct": F.struct(F.floor(F.col("id") / 700).alias("day"), F.timestamp_seconds(F.col("id") % 700).alias("at")),
        "time": F.timestamp_seconds(F.col("id") * F.col("id")),
    }[kind]
    d = spark.range(20_000).withColumn("t", order)
    cut = ordered.evenly_cut(d, ["t"], rows=1000)
    sizes = {r["chunk"]: (r["n"], r["low"], r["high"]) for r in cut.groupBy("chunk").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).collect()}
    assert sizes == {k: (1000, 1000 * k, 1000 * k + 999) for k in range(20)}
    assert ordered.evenly_cut(d, ["t"]).agg(F.max("chunk")).first()[0] == 0


def test_lags_of_a_sparse_sequence_cross_even_chunks(spark, monkeypatch):
    whole = ordered.evenly_cut
    monkeypatch.setattr(ordered, "evenly_cut", lambda df, order, name: whole(df, order, name, 50))
    rows = [(k, i * 60_000_000, float(i)) for k in ("a", None) for i in range(230)]
    d = spark.createDataFrame(rows, "k string, t long, v double").repartition(3)
    lagged = ordered.lag_columns(ordered.with_lags(d, ["k"], "t", ["v"], 3), ["v"], 3)
    assert "cut_" not in lagged.columns
    got = {(r.k, r.t // 60_000_000): (r.v_lag1, r.v_lag2, r.v_lag3) for r in lagged.collect()}
    assert got == {(k, i): tuple(float(i - n) if i >= n else None for n in (1, 2, 3)) for k in ("a", None) for i in range(230)}


@pytest.mark.parametrize("size", [1, 3])
def test_very_many_batches_are_joined(spark, size):
    rows = [(None, 0), *[(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i // 2), i) for i in range(1, 500)]]
    random.Random(3).shuffle(rows)
    d = spark.createDataFrame(rows, "ts timestamp_ntz, id long").repartition(5)
    few, many = (ordered.batch_by_count(d, ["ts", "id"], size, most_starts=n) for n in (4096, 10))
    assert {r.id: r.slot for r in many.collect()} == {r.id: r.slot for r in few.collect()} == {i: i // size for i in range(500)}
    assert "Join" in plan_of(many) and "Join" not in plan_of(few).split("Subquery")[0]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_million_batches(spark):
    d = spark.range(1_000_000).select(F.col("id"), F.lit("text").alias("text"))
    found = ordered.batch_by_count(d, ["id"], 1)
    assert tuple(found.agg(F.count("*"), F.count_if(F.col("slot") == F.col("id"))).first()) == (1_000_000, 1_000_000)


def test_slots_are_closed_on_the_right(spark):
    clock = {
        "09:15:00": 1, "09:30:59": 1, "09:40:59": 1, "09:41:00": 2, "09:50:00": 2, "15:50:01": 38, "16:00:59": 39,
        "16:01:00": None, "16:10:00": None, "00:00:00": 1,
    }
    d = spark.createDataFrame([(c,) for c in clock], "c string")
    got = d.select("c", times.slot_index(F.to_timestamp(F.concat(F.lit("2024-01-02 "), "c"))).alias("s"))
    assert {r.c: r.s for r in got.collect()} == clock


def test_last_quote_leaves_empty_slots_out(spark):
    rows = [("2024-01-02 09:31:00", 1.0), ("2024-01-02 09:40:59", 2.0), ("2024-01-02 10:05:00", 3.0), ("2024-01-02 16:30:00", 9.0)]
    d = spark.createDataFrame(rows, "t string, v double").select(F.to_timestamp("t").alias("ts"), "v")
    assert as_set(ordered.slot_last_quote(d, "ts", ["v"]), "slot", "v") == {(1, 2.0), (4, 3.0)}


def test_times(spark):
    d = spark.createDataFrame(
        [("Wed Aug  7 13:08:45 2008",), ("Wed Aug  7 13:08:45 +0000 2008",), ("Wed Aug 17 03:08:45 2008",), ("nonsense",)],
        "t string",
    )
    parsed = d.select(times.parse_ctime(F.col("t")).alias("ts")).select(times.hhmm(F.col("ts")).alias("h"), "ts").collect()
    assert [r.h for r in parsed] == ["13:08", "13:08", "03:08", None]
    assert parsed[0].ts == parsed[1].ts
    grid = [r.label for r in times.time_grid(spark).orderBy("slot").collect()]
    assert len(grid) == 40 and grid[0] == "09:30" and grid[1] == "09:40" and grid[39] == "16:00"


def test_min_max(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, v double")
    assert as_set(ordered.min_max_scaled(d, ["v"]), "k", "v") == {("a", 0.0), ("a", 0.5), ("b", 1.0)}
    assert as_set(ordered.min_max_scaled(d, ["v"], ["k"]), "k", "v") == {("a", 0.0), ("a", 1.0), ("b", None)}
