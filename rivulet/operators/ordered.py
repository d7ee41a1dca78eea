"""Ordered operators that do not put a whole sequence into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.functions.numbers import scaled
from rivulet.functions.times import slot_index
from rivulet.operators.relational import join_on_same, last_per_key
from rivulet.session import materialize


#: Rows of a chunk of a long sequence.
CHUNK_ROWS = 65_536


def with_lags(
    df: DataFrame, by: Sequence[str], order: str, values: Sequence[str], depth: int, chunk: Column | None = None, name: str = "lags"
) -> DataFrame:
    """Add ``name``: an array of the last ``depth`` rows before this one in its sequence, nearest
    first, each a struct of ``values``; fewer near the start.

    A sequence is one value of ``by``, null included, in the order of ``order`` (no ties; nulls first). Windows run inside
    one chunk of one sequence; what reaches back over a chunk's
    start comes from the last ``depth`` rows of the chunks before, a table that is smaller by
    the chunk length. One very long sequence is thereby spread over many tasks.

    ``chunk`` must never decrease along a sequence; without it the rows are cut evenly (see ``evenly_cut``, which runs jobs).
    """
    if chunk is None:
        df = evenly_cut(df, [*by, order], "cut_")
        chunk = F.col("cut_")
    row = F.struct(*values)
    chunked = df.withColumn("chunk_", chunk)
    inner = Window.partitionBy(*by, "chunk_").orderBy(order)
    inside = chunked.withColumn(
        "inside_", F.array_compact(F.array(*[F.lag(row, i).over(inner) for i in range(1, depth + 1)]))
    )

    backward = Window.partitionBy(*by, "chunk_").orderBy(F.desc(order))
    ends = (
        chunked.select(*by, "chunk_", order, row.alias("row_"))
        .withColumn("from_end_", F.row_number().over(backward))
        .where(F.col("from_end_") <= depth)
    )
    across = Window.partitionBy(*by).orderBy(order)
    before = (
        ends.withColumn(
            "before_", F.array_compact(F.array(*[F.lag("row_", i).over(across) for i in range(1, depth + 1)]))
        )
        .groupBy(*by, "chunk_")
        .agg(F.min_by("before_", order).alias("before_"))
    )
    joined = join_on_same(inside, before, [*by, "chunk_"])
    lags = F.slice(F.concat("inside_", "before_"), 1, depth)
    return joined.withColumn(name, lags).drop("inside_", "before_", "chunk_", "cut_")


def evenly_cut(df: DataFrame, order: Sequence[str], name: str = "chunk", rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with ``name``: the number of its chunk of ``rows`` rows in the order of ``order``, whatever that holds and
    however it is spread; as many chunks as it takes.

    The rows are written to the shared folder (this runs jobs), so what follows does not compute them again. Pass narrow rows.
    """
    written = materialize(df)
    if written.count() <= rows:
        return written.withColumn(name, F.lit(0).cast("long"))
    return with_position(written, order, name).withColumn(name, F.floor(F.col(name) / rows))


def lag_columns(df: DataFrame, values: Sequence[str], depth: int, lags: str = "lags") -> DataFrame:
    """One column ``<value>_lag<i>`` per value and distance, null before the sequence starts."""
    picked = [
        F.get(lags, F.lit(i - 1))[v].alias(f"{v}_lag{i}") for v in values for i in range(1, depth + 1)
    ]
    return df.select(*[c for c in df.columns if c != lags], *picked)


def with_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Add the 0-based place of every row in the total order of ``order`` (no ties).

    Rows are range-partitioned and numbered inside their partition; the partition sizes give each
    partition's offset. The numbered rows are written to the shared folder first (this runs a
    job), because two evaluations might cut the ranges differently. Pass narrow rows.
    """
    numbered = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("id_", F.monotonically_increasing_id())
    )
    # The id holds the partition number above its low 33 bits and the row number in them.
    split = numbered.withColumn("part_", F.shiftright("id_", 33)).withColumn(
        "row_", F.col("id_").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = split.groupBy("part_").agg(F.count(F.lit(1)).alias("size_"))
    # One row per partition, so this window is small whatever the data.
    offsets = sizes.select(
        "part_", (F.sum("size_").over(Window.orderBy("part_")) - F.col("size_")).alias("offset_")
    )
    placed = split.join(offsets, "part_")
    return placed.withColumn(name, F.col("offset_") + F.col("row_")).drop("id_", "part_", "row_", "offset_", "size_")


#: Batches whose first keys travel with every post; more are joined.
MOST_STARTS = 4096


def batch_by_count(
    posts: DataFrame, order: Sequence[str], size: int, slots: int | None = None, name: str = "slot", most_starts: int = MOST_STARTS
) -> DataFrame:
    """Number posts in arrival order into batches of ``size``; batch i takes slot i. The last batch may be partial.

    With ``slots`` more posts than that many batches hold are an error; without it slots go on. Only the order keys
    (no ties) are sorted and numbered. Of up to ``most_starts`` batches the first keys form one array, in which each post finds its
    batch by halving, so the posts are never shuffled. Of more, each post meets its own numbered key in a join: the keys are
    different, so no task gets more than its share however many batches there are.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    here = F.struct(*order)
    keys = with_position(posts.select(*order), order, "position_")
    batches = -(-keys.count() // size)
    if slots is not None and batches > slots:
        raise ValueError(f"{batches} batches of {size} do not fit {slots} slots")
    if batches > most_starts:
        numbered = keys.select(*order, F.floor(F.col("position_") / size).cast("int").alias(name))
        return join_on_same(posts, numbered, order)
    starts = keys.where(F.col("position_") % size == 0).agg(F.sort_array(F.collect_list(here))).scalar()

    def halve(span: Column, step: Column) -> Column:
        """The last start that is not after this post lies in low..high."""
        middle = F.floor((span["low"] + span["high"] + 1) / 2).cast("int")
        reached = here >= F.get("starts_", middle)
        return F.struct(
            F.when(reached, middle).otherwise(span["low"]).alias("low"),
            F.when(reached, span["high"]).otherwise(F.greatest(middle - 1, F.lit(0))).alias("high"),
        )

    whole = F.struct(F.lit(0).alias("low"), F.lit(max(0, batches - 1)).alias("high"))
    found = F.aggregate(F.sequence(F.lit(0), F.lit(batches.bit_length())), whole, halve)
    return posts.withColumn("starts_", starts).withColumn(name, found["low"]).drop("starts_")


def collect_lists(df: DataFrame, key: str, items: Sequence[str], most: int = 1000) -> DataFrame:
    """Items per key in order, as lists of ``most`` entries: (key, part, items), parts numbered from 0.

    List number ``part`` holds the places ``part * most`` and following of the key's sorted items; the last may
    be shorter. Places come from one global numbering (this runs a job), so a hot key, even one of equal
    items, is never in one task or one list.
    """
    placed = with_position(df.select(key, *items), [key, *items], "at_")
    first = placed.groupBy(key).agg(F.min("at_").alias("first_"))
    parts = join_on_same(placed, first, [key]).withColumn("part", F.floor((F.col("at_") - F.col("first_")) / most).cast("int"))
    return parts.groupBy(key, "part").agg(F.sort_array(F.collect_list(F.struct(*items))).alias("items"))


def slot_last_quote(quotes: DataFrame, ts: str, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The last quote in each right-closed ten-minute slot; empty slots are absent, and so are quotes after
    the grid's end, which have no slot (see ``slot_index``)."""
    slotted = quotes.withColumn("slot", slot_index(F.col(ts))).where(F.col("slot").isNotNull())
    return last_per_key(slotted, [*by, "slot"], ts, values)


def min_max_scaled(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Columns mapped to 0..1 between their minimum and maximum, per group of ``by``."""
    ends = F.struct(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns])
    if by:
        spans = join_on_same(df, df.groupBy(*by).agg(ends.alias("span_")), by)
    else:
        spans = df.withColumn("span_", df.agg(ends).scalar())

    def scaled_column(c: str) -> Column:
        return scaled(F.col(c), F.col(f"span_.{c}.low"), F.col(f"span_.{c}.high"))

    return spans.select(*[scaled_column(c).alias(c) if c in columns else c for c in df.columns])
