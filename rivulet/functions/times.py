"""Column functions over clock times and the trading-day slot grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The grid has 40 labels, ten minutes apart, the first at 09:30.
GRID_START_MINUTE = 570
GRID_STEP_MINUTES = 10
GRID_SLOTS = 40


def parse_ctime(text: Column) -> Column:
    """``Wed Aug  7 13:08:45 2008`` (or with ``+0000`` before the year) as a timestamp.

    The weekday is not part of a Spark pattern, so it is cut off; padding blanks are collapsed.
    """
    bare = F.regexp_replace(F.replace(text, F.lit("+0000 "), F.lit("")), " +", " ")
    return F.try_to_timestamp(F.substring(bare, 5, 40), F.lit("MMM d HH:mm:ss yyyy"))


def hhmm(ts: Column) -> Column:
    """``HH:MM`` with the seconds cut off."""
    return F.date_format(ts, "HH:mm")


def slot_label(index: Column) -> Column:
    """Label of a grid position, ``09:30`` for 0."""
    minute = index * GRID_STEP_MINUTES + GRID_START_MINUTE
    return F.format_string("%02d:%02d", F.floor(minute / 60).cast("int"), (minute % 60).cast("int"))


def slot_index(ts: Column) -> Column:
    """Grid position of a quote time: slots are closed on the right, minutes are truncated.

    Everything up to the first step falls in slot 1; times after the last label get null.
    """
    minute = F.hour(ts) * 60 + F.minute(ts)
    index = F.greatest(F.lit(1), F.ceil((minute - GRID_START_MINUTE) / GRID_STEP_MINUTES)).cast("int")
    return F.when(index < GRID_SLOTS, index)


def time_grid(spark: SparkSession) -> DataFrame:
    """The grid as (slot, label): 40 rows by definition."""
    return spark.range(GRID_SLOTS).select(
        F.col("id").cast("int").alias("slot"), slot_label(F.col("id")).alias("label")
    )
