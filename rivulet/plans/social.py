"""Popular posts and entities, and mutual connections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from rivulet.operators.relational import count_per_key, mutual, top_counts


def reposts(posts: DataFrame) -> DataFrame:
    """Posts that repeat another post: (retweet_count, screen_name, text, id)."""
    return posts.where(F.col("retweeted_status").isNotNull()).select(
        "retweet_count", F.col("retweeted_status.user.screen_name").alias("screen_name"), "text", "id"
    )


def popular_posts(posts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest distinct retweet counts with one post each: of equal counts the last by
    (screen_name, text, id)."""
    row = F.struct("screen_name", "text", "id")
    best = reposts(posts).groupBy("retweet_count").agg(F.max(row).alias("row"))
    return best.select("retweet_count", "row.*").orderBy(F.desc("retweet_count")).limit(k)


def popular_entities(posts: DataFrame, array_col: str, field: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of ``field`` in an array of structs: (entity, n)."""
    named = posts.select(F.explode(array_col).alias("e")).select(F.col(f"e.{field}").alias("entity"))
    return top_counts(named, "entity", k)


def popular_by_kind(posts: DataFrame, array_col: str, fields: Sequence[str], k: int = 10) -> DataFrame:
    """``popular_entities`` of several fields in one pass: (kind, entity, n), kind being the field's name.

    The lists are opened once and counted once; the best of a kind are cut in each task before they meet.
    """
    named = F.array(*[F.struct(F.lit(f).alias("kind"), F.col(f"e.{f}").alias("entity")) for f in fields])
    counted = count_per_key(posts.select(F.explode(array_col).alias("e")).select(F.explode(named).alias("v")).select("v.*"), "kind", "entity")
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "entity"))
    return counted.withColumn("place", place).where(F.col("place") <= k).drop("place")


def mutual_connections(friends: DataFrame, followers: DataFrame, k: int = 10, multiset: bool = True) -> DataFrame:
    """Friends that also follow: (id, screen_name), the first ``k`` in descending order."""
    both = mutual(friends.select("id", "screen_name"), followers, "id", multiset)
    return both.orderBy(F.desc("id"), F.desc("screen_name")).limit(k)
