import datetime
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.operators import matrix
from rivulet.operators.matrix import PLACE_SUMS, blocked_matrix, place_sums
from tests.conftest import as_set
from workload.recommender import wide_matrix_filled

CELL = "u string, b long, v double"


def some_cells():
    rng = random.Random(4)
    cells = {(rng.choice([None, "a", "b", "c", "d", "ee"]), rng.choice([None, *range(-3, 9)])): float(rng.randrange(1, 6)) for _ in range(50)}
    return [(u, b, v) for (u, b), v in cells.items()]


@pytest.mark.parametrize("size", [1, 3, 1024])
def test_cells_and_transposed_cells_come_back(spark, size):
    rows = some_cells()
    m = blocked_matrix(spark.createDataFrame(rows, CELL).repartition(3), "u", "b", "v", size)
    assert (m.height, m.width) == (len({r[0] for r in rows}), len({r[1] for r in rows}))
    assert as_set(m.cells(), "row", "column", "value") == set(rows)
    turned = m.transposed()
    assert (turned.height, turned.width) == (m.width, m.height)
    assert as_set(turned.cells(), "column", "row", "value") == set(rows)
    assert as_set(turned.transposed().cells(), "row", "column", "value") == set(rows)
    for block in m.blocks.collect():
        assert len(block["cells"]) <= size * size
        assert all((c["row"] // size, c["column"] // size) == (block["row_block"], block["column_block"]) for c in block["cells"])


def test_vectors_are_filled_and_in_order(spark):
    rows = some_cells()
    m = blocked_matrix(spark.createDataFrame(rows, CELL), "u", "b", "v", 4)
    for matrix, (i, j) in ((m, (0, 1)), (m.transposed(), (1, 0))):
        order = sorted({r[j] for r in rows}, key=lambda k: (k is not None, k or 0 if not isinstance(k, str) else k))
        of = {(r[i], r[j]): r[2] for r in rows}
        got = {r["row"]: r["vector"] for r in matrix.vectors(0.1).collect()}
        assert got == {k: [of.get((k, c), 0.1) for c in order] for k in {r[i] for r in rows}}


def test_repeated_cells_and_no_cells(spark):
    d = spark.createDataFrame([("a", 1, 3.0), ("a", 1, 2.0), ("b", 1, 4.0)], CELL)
    assert as_set(blocked_matrix(d, "u", "b", "v").cells(), "row", "column", "value") == {("a", 1, 2.0), ("b", 1, 4.0)}
    none = blocked_matrix(d.limit(0), "u", "b", "v")
    assert (none.height, none.width, none.cells().count(), none.transposed().vectors(0.0).count()) == (0, 0, 0, 0)


def test_a_hundred_thousand_columns(spark):
    cells = spark.range(100_000).select((F.col("id") % 7).alias("u"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("b"), F.lit(2.0).alias("v"))
    m = blocked_matrix(cells, "u", "b", "v")
    assert (m.height, m.width) == (7, 100_000)
    rows = m.vectors(0.5).select(F.size("vector").alias("n"), F.aggregate("vector", F.lit(0.0), lambda s, v: s + v).alias("total"))
    assert {r["n"] for r in rows.collect()} == {100_000}
    assert rows.agg(F.sum("total")).first()[0] == 100_000 * 2.0 + 600_000 * 0.5
    assert m.transposed().blocks.agg(F.max("row_block"), F.max("column_block")).first()[:] == (97, 0)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def sums(row):
    """Width, sum and sum weighted by the place from 1, without rounding on the way."""
    exact = [Fraction(v) for v in row]
    return len(row), float(sum(exact)), float(sum(v * i for i, v in enumerate(exact, 1)))


@pytest.mark.parametrize("filled, task_values, batch", [(1 << 21, 1 << 30, 10_000), (1000, 300, 7), (1, 900, 1)])
def test_rows_are_measured_where_they_are_filled(spark, monkeypatch, filled, task_values, batch):
    monkeypatch.setattr(matrix, "FILLED", filled)
    monkeypatch.setattr(matrix, "TASK_VALUES", task_values)
    rng = random.Random(5)
    cells = {(rng.choice([None, *"abcdefghijklmnopqrstuvwxyz"]), b): float(rng.randrange(-5, 6)) for b in [None, *range(299)] for _ in range(3)}
    m = blocked_matrix(spark.createDataFrame([(u, b, v) for (u, b), v in cells.items()], CELL).repartition(5), "u", "b", "v", 16)
    want = {u: [cells.get((u, b), 0.1) for b in [None, *range(299)]] for u, _ in cells}
    assert (m.height, m.width) == (27, 300)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert {r["row"]: r["vector"] for r in m.vectors(0.1).collect()} == want
        found = m.vectors(0.1, place_sums, PLACE_SUMS)
        got = {r["row"]: (r["width"], r["total"], r["weighted"]) for r in found.collect()}
        assert found.columns == ["row", "width", "total", "weighted"] and found.count() == 27
        assert {u: pytest.approx(sums(row), abs=1e-9) for u, row in want.items()} == got
        if task_values < 1 << 30:
            assert found.rdd.getNumPartitions() == max(27 * 300 // task_values, spark.sparkContext.defaultParallelism)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rows_of_full_width_are_not_joined(spark):
    m = blocked_matrix(spark.createDataFrame(some_cells(), CELL), "u", "b", "v", 4)
    done = plan(m.vectors(0.1))
    assert done.index("MapInArrow") < done.index("Join")


SETTINGS = {
    "merged": {},
    "broadcast late": {"spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB"},
    "skewed": {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    },
}


@pytest.mark.parametrize("task_values", [1 << 30, 1000])
@pytest.mark.parametrize("settings", SETTINGS.values(), ids=SETTINGS)
def test_a_row_stays_whole_however_the_join_is_run(spark, monkeypatch, settings, task_values):
    monkeypatch.setattr(matrix, "TASK_VALUES", task_values)
    u = F.when(F.col("id") % 10 < 7, F.lit(3)).otherwise(F.col("id") % 20)
    cells = spark.range(40_000).select(u.cast("string").alias("u"), F.floor(F.col("id") / 20).alias("b"), F.lit(2.0).alias("v")).repartition(8)
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} | settings
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        m = blocked_matrix(cells, "u", "b", "v", 64)
        got = m.vectors(0.1).collect()
    finally:
        for key in changed:
            spark.conf.unset(key)
    assert len(got) == m.height and {r["row"]: r["vector"] for r in got} == {str(u): [2.0] * 2000 for u in (3, 7, 8, 9, 17, 18, 19)}


@pytest.mark.parametrize("width", [0, 1, 127, 128, 129, 1000, 360_000])
def test_long_rows_round_little(width):
    values = np.full((2, width), 0.1)
    values[1, ::97] = 4.0
    values[1, -1:] = 5.0
    for row, *got in zip(values.tolist(), *(c.to_pylist() for c in place_sums(values))):
        assert got[0] == width
        assert got[1:] == pytest.approx(sums(row)[1:], rel=4e-15, abs=0)


def test_infinite_values_are_summed():
    width, total, weighted = place_sums(np.array([[float("inf")] + [0.1] * 299, [0.1] * 299 + [float("inf")], [0.1] * 300]))
    assert total.to_pylist()[:2] == weighted.to_pylist()[:2] == [float("inf")] * 2
    assert total.to_pylist()[2] == pytest.approx(30.0)


def test_filled_rows_of_users_are_whole(spark, tmp_path):
    """The query over orders and line items of its own: users with more than 60 reviews, 300 businesses."""
    rng, day = random.Random(6), datetime.datetime(2024, 1, 1)
    users = {1: 61, 2: 300, 3: 60, 4: 90, 5: 1, 6: 2, 7: 3}
    orders = [(10 * u + k, u) for u in users for k in range(3)]
    lines = [(10 * u + rng.randrange(3), i, s, float(rng.randrange(50)), day + datetime.timedelta(days=i)) for u, n in users.items() for i, s in enumerate(rng.sample(range(300), n))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    stars = {(key // 10, s): 1.0 + int(q) % 5 for key, _, s, q, _ in lines}
    got = wide_matrix_filled(spark, str(tmp_path))
    want = {(u, *(round(x, d) for x, d in zip(sums([stars.get((u, s), 0.1) for s in range(300)]), (0, 6, 4)))) for u in (1, 2, 4)}
    assert as_set(got, "user_id", "width", "total", "weighted") == want
    assert "vector" not in plan(got)
