"""Streaming forms of the post and quote jobs. Inputs and results are streaming DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from rivulet.functions.times import slot_index
from rivulet.functions.text import stop_test, tokens
from rivulet.session import fresh_path
from rivulet.streaming.results import KeyedResults


def track_filter(posts: DataFrame, track: Iterable[str], text: str = "text") -> DataFrame:
    """Texts of posts that contain any tracked keyword, whatever its case."""
    hit = F.lit(False)
    for word in track:
        hit = hit | F.contains(F.lower(F.col(text)), F.lit(word.lower()))
    return posts.where(hit).select(text)


def _timed(stream: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return stream if delay is None else stream.withWatermark(ts, delay)


def time_buckets(posts: DataFrame, ts: str, delay: str | None = None, width: str = "10 minutes") -> DataFrame:
    """Posts per event-time bucket: (bucket, n).

    Here and below ``delay`` bounds the state of an endless stream: rows later than it are not counted any
    more. Without it every row counts, however late, and the state has one entry per group.
    """
    buckets = _timed(posts, ts, delay).groupBy(F.window(ts, width)).agg(F.count(F.lit(1)).alias("n"))
    return buckets.select(F.col("window.start").alias("bucket"), "n")


def last_quotes(quotes: DataFrame, ts: str, values: Sequence[str], delay: str | None = None) -> DataFrame:
    """Last quote per day and ten-minute slot: (day, slot, *values)."""
    slotted = _timed(quotes, ts, delay).withColumn("slot", slot_index(F.col(ts)))
    picked = (
        slotted.where(F.col("slot").isNotNull())
        .groupBy(F.window(ts, "1 day"), "slot")
        .agg(*[F.max_by(v, ts).alias(v) for v in values])
    )
    return picked.select(F.to_date("window.start").alias("day"), "slot", *values)


def bucket_sentiment(
    posts: DataFrame,
    ts: str,
    positives: DataFrame,
    negatives: DataFrame,
    stopwords: Iterable[str] = (),
    text: str = "text",
    delay: str | None = None,
    width: str = "10 minutes",
) -> DataFrame:
    """Positive and negative sums, ratio and difference per event-time bucket.

    The static lexicons are reduced to one value per word, so each word meets one row.
    """
    values = (
        positives.select("word", F.col("value").cast("double").alias("p"), F.lit(0.0).alias("q"))
        .unionByName(negatives.select("word", F.lit(0.0).alias("p"), F.col("value").cast("double").alias("q")))
        .groupBy("word")
        .agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    )
    words = (
        _timed(posts, ts, delay)
        .select(ts, F.explode(tokens(F.col(text))).alias("word"))
        .where(~stop_test(F.col("word"), stopwords))
        .withColumn("word", F.lower("word"))
    )

    def total(c: str):
        return F.sum(F.coalesce(F.col(c), F.lit(0.0)))

    sums = (
        words.join(values, "word", "left")
        .groupBy(F.window(ts, width))
        .agg(total("p").alias("positive"), total("q").alias("negative"))
    )
    size = F.abs("negative")
    return sums.select(
        F.col("window.start").alias("bucket"),
        "positive",
        "negative",
        F.try_divide(F.col("positive"), size).alias("ratio"),
        (F.col("positive") - size).alias("diff"),
    )


def run_available(
    stream: DataFrame, label: str = "stream", keys: Sequence[str] | None = None, folder: str | None = None
) -> DataFrame:
    """Run a stream over all input that is there and read the result from Parquet.

    Rows and progress stay in ``folder`` (a fresh one below the shared folder if absent): a later call with the same folder
    goes on where this one ended. Without ``keys`` rows are appended as they come. With ``keys``, those of the groups,
    each run writes the groups that changed, and the result holds the newest row of every group, those
    that may still change included; what newer rows replace is cleared away from time to time (see ``results``), so the folder
    stays in proportion to the groups. A result can be read until the second clearing after it.
    """
    folder = folder or fresh_path(stream.sparkSession, label)
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True)
    if keys is None:
        rows = f"{folder}/rows"
        writer.format("parquet").outputMode("append").start(rows).awaitTermination()
        return stream.sparkSession.read.schema(stream.schema).parquet(rows)
    versions = KeyedResults(stream.sparkSession, folder, stream.schema, keys)
    writer.outputMode("update").foreachBatch(versions.store).start().awaitTermination()
    versions.clear()
    return versions.newest()
