"""Word frequency, lexical diversity and lexicon sentiment over texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from rivulet.functions.text import BLANKS, sign_label, stop_test
from rivulet.operators.relational import count_per_key, label_words, polarity_counts


def words(docs: DataFrame, text: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """One row per token of ``text``, with the columns of ``keep``."""
    cut = docs.select(*keep, F.explode(F.split(text, BLANKS)).alias("word"))
    return cut.where(F.col("word") != "")


def word_frequency(docs: DataFrame, text: str = "text", stopwords: Iterable[str] = (), k: int = 30) -> DataFrame:
    """The ``k`` most frequent words that are not stop words: (word, n). Case is kept, and equal
    counts are ordered by word."""
    kept = words(docs, text).where(~stop_test(F.col("word"), stopwords))
    return count_per_key(kept, "word").orderBy(F.desc("n"), F.asc("word")).limit(k)


def lexical_diversity(docs: DataFrame, text: str = "text", stopwords: Iterable[str] = ()) -> DataFrame:
    """Total words, distinct words and their ratio, before and after stop words are removed.

    One row; ratios over no words are null. Words are counted first, so one pass serves both.
    """
    counts = count_per_key(words(docs, text), "word")
    clean = ~stop_test(F.col("word"), stopwords)
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("distinct"),
        F.coalesce(F.sum(F.when(clean, F.col("n"))), F.lit(0)).alias("clean_total"),
        F.count_if(clean).alias("clean_distinct"),
    )
    return sums.withColumns(
        {
            "diversity": F.try_divide(F.col("distinct"), F.col("total")),
            "clean_diversity": F.try_divide(F.col("clean_distinct"), F.col("clean_total")),
        }
    )


def clean_words(docs: DataFrame, stopwords: Iterable[str], text: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """Lower-cased words that are not stop words. Stop words go first and case counts there, so
    ``The`` stays (as ``the``) while ``the`` goes."""
    kept = words(docs, text, keep).where(~stop_test(F.col("word"), stopwords))
    return kept.withColumn("word", F.lower("word"))


def sentiment_verdict(docs: DataFrame, lexicon: DataFrame, stopwords: Iterable[str] = (), text: str = "text") -> DataFrame:
    """Numbers of positive, negative and neutral words, their total and sum, and the verdict.

    ``lexicon`` has (word, polarity). A word listed twice counts twice. Words are counted before
    they meet the lexicon, so a frequent word crosses the join once.
    """
    counted = count_per_key(clean_words(docs, stopwords, text), "word")
    sums = polarity_counts(label_words(counted, lexicon))
    return sums.withColumn("verdict", sign_label(F.col("sum_value")))
