"""Grouping, joining and ranking building blocks shared by the jobs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.text import polarity_value, stop_test


def join_on_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null, keeping one set of key columns."""
    named = right.withColumnsRenamed({k: f"{k}_right_" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_right_"))
    return left.join(named, same, how).drop(*[f"{k}_right_" for k in keys])


def count_per_key(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key; partial counts are formed before the shuffle, so a hot key moves little."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_counts(df: DataFrame, key: str, k: int, name: str = "n") -> DataFrame:
    """The ``k`` most frequent keys; equal counts are ordered by key."""
    return count_per_key(df, key, name=name).orderBy(F.desc(name), F.asc(key)).limit(k)


def groups_above(df: DataFrame, key: str, minimum: int, name: str = "n") -> DataFrame:
    """Keys with more than ``minimum`` rows."""
    return count_per_key(df, key, name=name).where(F.col(name) > minimum)


def nth_by_count(df: DataFrame, key: str, n: int, name: str = "n") -> DataFrame:
    """The key in place ``n`` (from 1) by descending count, equal counts ordered by key."""
    return count_per_key(df, key, name=name).orderBy(F.desc(name), F.asc(key)).offset(n - 1).limit(1)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key: the first under ``order``, which must leave no ties.

    An aggregate instead of a window, so partial minima are formed before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    picked = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("row"))
    return picked.select(*[c if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns])


def last_per_key(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Values of the row that is last under ``order``, which must leave no ties, within each key.

    One aggregate per column: values of fixed width then aggregate by hash, without sorting the input.
    """
    return df.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])


def drop_stopwords(words: DataFrame, stopwords: Iterable[str] | DataFrame, word: str = "word") -> DataFrame:
    """Words that are not on the stop list (exact match).

    A list is compared in place; a table is anti-joined, and Spark chooses by its size how.
    """
    if isinstance(stopwords, DataFrame):
        return words.join(stopwords.select(word), word, "left_anti")
    return words.where(~stop_test(F.col(word), stopwords))


def label_words(words: DataFrame, lexicon: DataFrame, word: str = "word") -> DataFrame:
    """Every word with its lexicon columns: unmatched words keep nulls, and a word listed twice in
    the lexicon comes out twice."""
    return words.join(lexicon, word, "left")


def polarity_counts(weighted: DataFrame, polarity: str = "polarity", weight: str = "n") -> DataFrame:
    """One row with the numbers of positive, negative and neutral words, their total and sum."""
    value = polarity_value(F.col(polarity))

    def number(sign: int) -> Column:
        return F.coalesce(F.sum(F.when(value == sign, F.col(weight))), F.lit(0))

    return weighted.agg(
        number(1).alias("positive"),
        number(-1).alias("negative"),
        number(0).alias("neutral"),
        F.coalesce(F.sum(weight), F.lit(0)).alias("total"),
        F.coalesce(F.sum(value * F.col(weight)), F.lit(0)).alias("sum_value"),
    )


def semi_by_key(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(on), on, "left_semi")


def mutual(left: DataFrame, right: DataFrame, on: str, multiset: bool = True) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``.

    With ``multiset`` a left row comes out once per match, as two nested loops would give it.
    """
    if not multiset:
        return left.join(right.select(on), on, "left_semi").distinct()
    matches = count_per_key(right, on, name="matches")
    repeated = left.join(matches, on).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("matches"))))
    return repeated.drop("matches", "copy")


def lookup_or_default(requests: DataFrame, table: DataFrame, on: Sequence[str], value: str, default: float) -> DataFrame:
    """``value`` for every request, ``default`` where the table has no such key."""
    found = requests.join(table.select(*on, value), list(on), "left")
    return found.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def profile_lookup(
    profiles: DataFrame,
    screen_names: DataFrame | None = None,
    ids: DataFrame | None = None,
    items_only: bool = False,
) -> DataFrame:
    """Profiles for a table of screen names or a table of ids, exactly one of the two."""
    if (screen_names is None) == (ids is None):
        raise ValueError("give either screen_names or ids")
    keys, on = (screen_names, "screen_name") if ids is None else (ids, "id")
    found = profiles.join(keys.select(on).distinct(), on, "left_semi")
    return found.select("id", "screen_name") if items_only else found


def error_metrics(df: DataFrame, by: Sequence[str], predicted: str = "predicted", truth: str = "stars") -> DataFrame:
    """RMSE, accuracy (1 minus the mean relative error) and MAE."""
    gap = F.col(predicted) - F.col(truth)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        (1 - F.avg(F.try_divide(F.abs(gap), F.col(truth)))).alias("accuracy"),
        F.avg(F.abs(gap)).alias("mae"),
    )


def _listed(df: DataFrame, column: str, listed: Sequence) -> DataFrame:
    """``df`` with a check of ``column`` in every row, made where the column is read."""
    unlisted = F.raise_error(F.concat(F.lit(f"{column} holds a value that is not listed: "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(F.col(column).isin(list(listed)), F.col(column)).otherwise(unlisted.cast(kind)))


def rating_matrix(ratings: DataFrame, row: str, column: str, value: str, columns: Sequence, fill: float | None) -> DataFrame:
    """Ratings as a wide table with the given ``columns``; absent cells get ``fill``.

    For presentation with a known, short list of columns: the jobs themselves keep the long form.
    A value of ``column`` that is not listed, or null, stops the job with an error.
    """
    wide = _listed(ratings, column, columns).groupBy(row).pivot(column, list(columns)).agg(F.first(value))
    return wide if fill is None else wide.na.fill(fill, subset=[str(c) for c in columns])


def transpose(wide: DataFrame, row: str, rows: Sequence, column: str = "column") -> DataFrame:
    """Swap rows and columns of a wide table whose row keys are the short list ``rows``; another key is an error."""
    cells = [c for c in wide.columns if c != row]
    long = _listed(wide, row, rows).unpivot([row], cells, column, "value")
    return long.groupBy(column).pivot(row, list(rows)).agg(F.first("value"))
