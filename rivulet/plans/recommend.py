"""Neighbourhood recommender: similarity, neighbours, predictions and their evaluation.

``reviews`` tables have (user_id, business_id, stars); ``ratings`` are reviews with one row per user
and business (see ``one_rating_each``). Means and deviations of users are taken over all their
reviews, the matrix and predictions over ratings.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.operators.correlation import best_of_each, correlation_matrix, correlation_with, RANK_DIGITS, rank_order
from rivulet.operators.relational import count_per_key, error_metrics, groups_above
from rivulet.operators.similarity_join import top_correlations
from rivulet.plans.text import words
from rivulet.session import materialize

# Fixed value: what an unrated business counts as in a user's profile.
UNRATED = 0.1


def active_users(reviews: DataFrame, users: DataFrame, min_reviews: int = 80) -> DataFrame:
    """Users with more than ``min_reviews`` reviews, with their number and profile."""
    return groups_above(reviews, "user_id", min_reviews, "reviews").join(users, "user_id")


def reviews_of_active(reviews: DataFrame, min_reviews: int = 80) -> DataFrame:
    """All reviews by users with more than ``min_reviews`` of them."""
    return reviews.join(groups_above(reviews, "user_id", min_reviews).select("user_id"), "user_id", "left_semi")


def one_rating_each(reviews: DataFrame, order: Sequence[str]) -> DataFrame:
    """(user_id, business_id, stars): the first review of each user and business under ``order``,
    which must leave no ties between different stars."""
    first = F.min_by("stars", F.struct(*order))
    return reviews.groupBy("user_id", "business_id").agg(first.alias("stars"))


def _star_stats(reviews: DataFrame, key: str) -> DataFrame:
    return reviews.groupBy(key).agg(
        F.avg("stars").alias("mean"), F.stddev_pop("stars").alias("std"), F.count(F.lit(1)).alias("reviews")
    )


def user_stats(reviews: DataFrame) -> DataFrame:
    """Mean and population deviation of each user's stars, and their number."""
    return _star_stats(reviews, "user_id")


def business_stats(reviews: DataFrame) -> DataFrame:
    """Mean and population deviation of each business's stars, and their number."""
    return _star_stats(reviews, "business_id")


def prepare(reviews: DataFrame, min_reviews: int, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(stats, ratings): star statistics of all users, and the ratings of those with more than
    ``min_reviews`` reviews.

    Everything downstream reads these two tables several times, so both are written to the shared
    folder once (this runs jobs), and the reviews are not scanned again.
    """
    stats = materialize(user_stats(reviews))
    active = stats.where(F.col("reviews") > min_reviews).select("user_id")
    ratings = materialize(one_rating_each(reviews.join(active, "user_id", "left_semi"), order))
    return stats, ratings


def most_active(stats: DataFrame, n: int):
    """Id of the user in place ``n`` (from 1) by number of reviews, equal numbers ordered by id."""
    found = stats.orderBy(F.desc("reviews"), F.asc("user_id")).offset(n - 1).limit(1).first()
    return found["user_id"]


def _profiles(ratings: DataFrame, fill: float) -> DataFrame:
    return ratings.select(
        F.col("user_id").alias("id"), F.col("business_id").alias("key"), (F.col("stars") - F.lit(fill)).alias("value")
    )


def user_similarity(ratings: DataFrame, fill: float = UNRATED, best: int | None = None) -> DataFrame:
    """Pearson correlation of user pairs, unrated businesses counting as ``fill``:
    (user_id, neighbor_id, corr), null for a constant profile.

    With ``best`` each user's highest other users only. Without it the result has users squared rows, which
    only a small table should ask for; for one user take ``similarity_to_user``.
    """
    return _correlations(_profiles(ratings, fill), best)


def _correlations(profiles: DataFrame, best: int | None) -> DataFrame:
    found = correlation_matrix(profiles) if best is None else top_correlations(profiles, best)
    return found.withColumnRenamed("id", "user_id")


def similarity_to_user(ratings: DataFrame, user, fill: float = UNRATED) -> DataFrame:
    """The rows of ``user_similarity`` for one user, in time linear in the ratings."""
    return correlation_with(_profiles(ratings, fill), user).withColumnRenamed("id", "user_id")


def nearest_neighbors(sim: DataFrame, user=None, k: int = 30) -> DataFrame:
    """The ``k`` best correlated other users of one user or of every user, with their rank.

    (user_id, neighbor_id, corr, rank); correlations that are equal in ``RANK_DIGITS`` digits are ordered by id, unknown ones
    left out.
    """
    others = sim.where(~F.col("neighbor_id").eqNullSafe(F.col("user_id")) & F.col("corr").isNotNull())
    if user is not None:
        # k rows are left when the rank is taken, so it needs no partitioning.
        return _ranked(others.where(F.col("user_id") == F.lit(user)).orderBy(*rank_order()).limit(k))
    return _ranked(best_of_each(others.withColumnRenamed("user_id", "id"), k).withColumnRenamed("id", "user_id"))


def neighbors_of_all(ratings: DataFrame, k: int = 30, fill: float = UNRATED) -> DataFrame:
    """``nearest_neighbors`` of every user."""
    return _ranked(user_similarity(ratings, fill, best=k))


def _ranked(best: DataFrame) -> DataFrame:
    """``best``, a few rows per user, with their rank."""
    row = F.struct((-F.round("corr", RANK_DIGITS)).alias("down"), "neighbor_id", "corr")
    return best.groupBy("user_id").agg(F.sort_array(F.collect_list(row)).alias("best")).select("user_id", F.posexplode("best").alias("at", "b")).select(
        "user_id", "b.neighbor_id", "b.corr", (F.col("at") + 1).alias("rank")
    )


def threshold_neighbors(sim: DataFrame, user=None, min_corr: float = 0.0) -> DataFrame:
    """All other users correlated above ``min_corr``."""
    kept = sim.where(~F.col("neighbor_id").eqNullSafe(F.col("user_id")) & (F.col("corr") > min_corr))
    return kept if user is None else kept.where(F.col("user_id") == F.lit(user))


def neighbor_ratings(neighbors: DataFrame, ratings: DataFrame, stats: DataFrame) -> DataFrame:
    """What each neighbour's rating adds to a prediction: (user_id, neighbor_id, rank,
    business_id, delta, weight), delta being the weighted deviation in the neighbour's own scale.

    Neighbours whose stars never vary say nothing about a deviation and are left out.
    """
    theirs = neighbors.join(
        stats.select(F.col("user_id").alias("neighbor_id"), F.col("mean").alias("n_mean"), F.col("std").alias("n_std")),
        "neighbor_id",
    ).where(F.col("n_std") > 0)
    rated = theirs.join(
        ratings.select(F.col("user_id").alias("neighbor_id"), "business_id", F.col("stars").alias("n_stars")), "neighbor_id"
    )
    delta = (F.col("n_stars") - F.col("n_mean")) * F.col("corr") / F.col("n_std")
    return rated.select(
        "user_id", "neighbor_id", "rank", "business_id", delta.alias("delta"), F.col("corr").alias("weight")
    )


def _prediction(delta: Column, weight: Column) -> Column:
    no_evidence = delta.isNull() | (delta == 0) | (weight == 0)
    return F.when(no_evidence, F.col("mean")).otherwise(
        F.col("mean") + F.col("std") * F.try_divide(delta, weight)
    )


def predict_rating(requests: DataFrame, neighbors: DataFrame, ratings: DataFrame, stats: DataFrame) -> DataFrame:
    """Predicted stars for every (user_id, business_id) of ``requests``.

    The user's mean plus deviation times the weighted mean deviation of the neighbours that rated
    the business, with signed weights and no clipping; the plain mean where none did.
    """
    sums = (
        neighbor_ratings(neighbors, ratings, stats)
        .groupBy("user_id", "business_id")
        .agg(F.sum("delta").alias("delta"), F.sum("weight").alias("weight"))
    )
    known = requests.join(stats.select("user_id", "mean", "std"), "user_id").join(sums, ["user_id", "business_id"], "left")
    return known.withColumn("predicted", _prediction(F.col("delta"), F.col("weight"))).drop(
        "mean", "std", "delta", "weight"
    )


def sweep_predictions(
    ratings: DataFrame, stats: DataFrame, sim: DataFrame, user, ks: Iterable[int] = range(5, 50, 5)
) -> DataFrame:
    """Predictions of one user's own rated businesses for several neighbour counts: (k,
    business_id, stars, predicted).

    The largest neighbour set is joined once; the sums for each k are conditional on the rank.
    """
    ks = list(ks)
    nearest = nearest_neighbors(sim, user, max(ks))
    sums = [
        F.struct(
            F.lit(k).alias("k"),
            F.sum(F.when(F.col("rank") <= k, F.col("delta"))).alias("delta"),
            F.sum(F.when(F.col("rank") <= k, F.col("weight"))).alias("weight"),
        )
        for k in ks
    ]
    own = ratings.where(F.col("user_id") == F.lit(user)).select("user_id", "business_id", "stars")
    evidence = own.select("business_id", "stars").join(
        neighbor_ratings(nearest, ratings, stats).drop("user_id"), "business_id", "left"
    )
    by_k = evidence.groupBy("business_id").agg(F.first("stars").alias("stars"), F.array(*sums).alias("sums"))
    mine = stats.where(F.col("user_id") == F.lit(user)).select(F.struct("mean", "std")).scalar()
    flat = by_k.select("business_id", "stars", F.explode("sums").alias("s"), mine.alias("mine")).select(
        "s.k", "business_id", "stars", "s.delta", "s.weight", "mine.mean", "mine.std"
    )
    return flat.select("k", "business_id", "stars", _prediction(F.col("delta"), F.col("weight")).alias("predicted"))


def evaluate_k_sweep(
    ratings: DataFrame, stats: DataFrame, sim: DataFrame, user, ks: Iterable[int] = range(5, 50, 5)
) -> DataFrame:
    """RMSE, accuracy and MAE per neighbour count, on the ratings the similarity was fitted to."""
    return error_metrics(sweep_predictions(ratings, stats, sim, user, ks), ["k"])


def recommend_businesses(
    ratings: DataFrame, stats: DataFrame, sim: DataFrame, business: DataFrame, user, k: int = 45
) -> DataFrame:
    """Predicted stars of one user for every business, with its attributes."""
    sums = (
        neighbor_ratings(nearest_neighbors(sim, user, k), ratings, stats)
        .groupBy("business_id")
        .agg(F.sum("delta").alias("delta"), F.sum("weight").alias("weight"))
    )
    mine = stats.where(F.col("user_id") == F.lit(user)).select(F.struct("mean", "std")).scalar()
    known = business.join(sums, "business_id", "left").withColumn("mine", mine)
    flat = known.select(F.lit(user).alias("user_id"), *business.columns, "delta", "weight", "mine.mean", "mine.std")
    predicted = _prediction(F.col("delta"), F.col("weight")).alias("predicted")
    return flat.select("user_id", *business.columns, predicted)


def ranked_predictions(predictions: DataFrame, k: int | None = None) -> DataFrame:
    """Predictions in ascending order, or the ``k`` best in descending order."""
    if k is None:
        return predictions.orderBy(F.asc("predicted"), F.asc("business_id"))
    return predictions.orderBy(F.desc("predicted"), F.asc("business_id")).limit(k)


def _word_profiles(texts: DataFrame) -> DataFrame:
    """Word counts per user, written once because a correlation reads its profiles several times."""
    counted = count_per_key(words(texts, "text", ["user_id"]), "user_id", "word")
    return materialize(
        counted.select(F.col("user_id").alias("id"), F.col("word").alias("key"), F.col("n").cast("double").alias("value"))
    )


def lexical_user_similarity(texts: DataFrame, best: int | None = None) -> DataFrame:
    """Pearson correlation of users' word counts, over all words anyone used:
    (user_id, neighbor_id, corr). ``texts`` has (user_id, text); ``best`` as in ``user_similarity``."""
    return _correlations(_word_profiles(texts), best)


def lexical_similarity_to_user(texts: DataFrame, user) -> DataFrame:
    """The rows of ``lexical_user_similarity`` for one user."""
    return correlation_with(_word_profiles(texts), user).withColumnRenamed("id", "user_id")


def compare_recommenders(**sweeps: DataFrame) -> DataFrame:
    """The error measures of several sweeps under each other: (recommender, k, rmse, accuracy, mae)."""
    named = [s.withColumn("recommender", F.lit(name)) for name, s in sweeps.items()]
    whole = named[0]
    for sweep in named[1:]:
        whole = whole.unionByName(sweep)
    return whole.select("recommender", "k", "rmse", "accuracy", "mae")
