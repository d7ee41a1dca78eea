"""Wide matrices without a list of their columns: numbered rows and columns, cells in square blocks.

A matrix is three tables: the row keys and the column keys with their places, and the cells that exist, by block of ``size`` rows and
columns. A block is bounded by its extent, whatever the numbers of rows and columns; transposing swaps block numbers and places and
moves no row of the table to another task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from rivulet.operators.ordered import with_position
from rivulet.operators.relational import join_on_same
from rivulet.session import materialize

#: Values that a task has filled at a time, if that is a row at least.
FILLED = 1 << 21
#: Values to fill that are worth a task of their own.
TASK_VALUES = 1 << 30
#: Values that are summed one after the other.
STRETCH = 128

#: Columns of some rows of full width.
Measure = Callable[[np.ndarray], list[pa.Array]]


@dataclass(frozen=True)
class BlockedMatrix:
    """``rows`` and ``columns`` (key, place), places from 0 in order of the key, null first; ``blocks`` (row_block, column_block,
    cells: array of (row, column, value) by place); ``height`` and ``width``."""

    rows: DataFrame
    columns: DataFrame
    blocks: DataFrame
    height: int
    width: int
    size: int

    def transposed(self) -> BlockedMatrix:
        """The matrix with rows and columns swapped."""
        swapped = F.transform("cells", lambda c: F.struct(c["column"].alias("row"), c["row"].alias("column"), c["value"].alias("value")))
        blocks = self.blocks.select(F.col("column_block").alias("row_block"), F.col("row_block").alias("column_block"), swapped.alias("cells"))
        return replace(self, rows=self.columns, columns=self.rows, blocks=blocks, height=self.width, width=self.height)

    def cells(self) -> DataFrame:
        """(row, column, value): the cells that exist, by key."""
        flat = self.blocks.select(F.explode("cells").alias("c")).select("c.*")
        named = flat.join(self.rows.select(F.col("key").alias("row_key"), F.col("place").alias("row")), "row").join(
            self.columns.select(F.col("key").alias("column_key"), F.col("place").alias("column")), "column"
        )
        return named.select(F.col("row_key").alias("row"), F.col("column_key").alias("column"), "value")

    def vectors(self, fill: float, measure: Measure | None = None, measured: str = "vector array<double>") -> DataFrame:
        """(row, vector): every row with all ``width`` values in order of the columns, ``fill`` where no cell is.

        With ``measure`` what it finds in the rows, the columns ``measured``, takes the place of ``vector``: it gets a few whole rows at
        a time in the task that fills them (rows by ``width``; the array is used again), so rows of full width go nowhere.
        """
        width, measure = self.width, measure or _lists
        schema = StructType([StructField("row", self.rows.schema["key"].dataType), *StructType.fromDDL(measured)])
        names = schema.names
        # a few rows at a time, as each has the full width
        step = max(1, FILLED // max(width, 1))

        def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            values = np.full((step, width), fill)
            for cells in _whole_rows(batches, step):
                row, column, value = (cells[c].to_numpy() for c in ("row", "column", "value"))
                first = np.flatnonzero(np.diff(row, prepend=-1))
                places = np.repeat(np.arange(len(first)), np.diff(first, append=len(row))), column
                values[places] = value
                yield pa.RecordBatch.from_arrays([cells["key"].take(pa.array(first)), *measure(values[: len(first)])], names)
                values[places] = fill

        flat = self.blocks.select(F.explode("cells").alias("c")).select("c.*")
        named = flat.join(self.rows.select(F.col("place").alias("row"), "key"), "row")
        # the work is in the values to fill, of which the size of the cells says nothing
        tasks = self.height * width // TASK_VALUES
        count = [max(tasks, named.sparkSession.sparkContext.defaultParallelism)] if tasks else []
        # not by the join's own key: then the join's parts would do, and adaptive execution may cut those inside a row
        dealt = named.repartition(*count, F.xxhash64("row"))
        return dealt.sortWithinPartitions("row").mapInArrow(dense, schema)


def _whole_rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Cells in order of their row as batches of ``n`` whole rows, the last one of what is left."""
    held, seen, last = [], 0, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        row = batch["row"].to_numpy()
        first = np.flatnonzero(np.diff(row, prepend=last))
        at = 0
        for cut in first[-seen % n :: n].tolist():
            held.append(batch.slice(at, cut - at))
            if sum(h.num_rows for h in held):
                yield pa.concat_batches(held)
            held, at = [], cut
        held.append(batch.slice(at))
        seen, last = seen + len(first), row[-1]
    if held:
        yield pa.concat_batches(held)


def _lists(values: np.ndarray) -> list[pa.Array]:
    n, width = values.shape
    return [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.flatten()))]


#: What ``place_sums`` finds.
PLACE_SUMS = "width long, total double, weighted double"


def place_sums(values: np.ndarray) -> list[pa.Array]:
    """The width of every row, its sum, and its sum weighted by the place from 1, of all its values.

    Stretches are summed first and then their sums, by halves, so that long rows round little.
    """
    n, width = values.shape
    whole = width // STRETCH * STRETCH
    weights = np.stack([np.ones(STRETCH), np.arange(1.0, STRETCH + 1)], axis=1)
    sums = values[:, :whole].reshape(n, whole // STRETCH, STRETCH) @ weights
    rest = values[:, whole:]
    total = sums[:, :, 0].sum(axis=1) + rest.sum(axis=1)
    # a value in a later stretch has its place in that stretch and the places before it
    before = sums[:, 1:, 0] * np.arange(STRETCH, whole, STRETCH, dtype=float)
    weighted = sums[:, :, 1].sum(axis=1) + before.sum(axis=1) + (rest * np.arange(whole + 1.0, width + 1)).sum(axis=1)
    return [pa.array(np.full(n, width)), pa.array(total), pa.array(weighted)]


def blocked_matrix(cells: DataFrame, row: str, column: str, value: str, size: int = 1024) -> BlockedMatrix:
    """The matrix of ``cells``, whose rows and columns are all keys that occur, null included. Of a cell that occurs more than
    once the smallest value counts. Runs jobs: keys are numbered and the blocks written."""
    written = materialize(cells.select(F.col(row).alias("row_key"), F.col(column).alias("column_key"), F.col(value).cast("double").alias("value")))
    rows, columns = (with_position(written.select(F.col(f"{side}_key").alias("key")).distinct(), ["key"], "place") for side in ("row", "column"))
    placed = written
    for side, keys in (("row", rows), ("column", columns)):
        placed = join_on_same(placed, keys.select(F.col("key").alias(f"{side}_key"), F.col("place").alias(side)), [f"{side}_key"])
    one = placed.groupBy("row", "column").agg(F.min("value").alias("value"))
    blocks = one.groupBy(F.floor(F.col("row") / size).alias("row_block"), F.floor(F.col("column") / size).alias("column_block")).agg(
        F.collect_list(F.struct("row", "column", "value")).alias("cells")
    )
    return BlockedMatrix(rows, columns, materialize(blocks), rows.count(), columns.count(), size)
