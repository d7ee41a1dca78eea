"""Review, relational and recommender queries."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from rivulet.functions import text as ft
from rivulet.operators import relational as rel
from rivulet.operators.correlation import correlation_matrix
from rivulet.operators.matrix import PLACE_SUMS, blocked_matrix, place_sums
from rivulet.plans import recommend as rec
from rivulet.session import materialize
from workload import adapters as a
from workload.courts import rounded
from workload.registry import query

KS = list(range(5, 50, 5))
ONE = "(SELECT user_id FROM target)"


def prepared(spark, sf):
    """The 7th most active user, star statistics and ratings of the active users."""
    stats, ratings = rec.prepare(a.reviews(spark, sf), a.SIMILAR_MIN, a.REVIEW_ORDER)
    return rec.most_active(stats, 7), stats, ratings


def similar(spark, sf):
    """``prepared`` and the user's similarities."""
    user, stats, ratings = prepared(spark, sf)
    return user, stats, ratings, rec.similarity_to_user(ratings, user)


@query(
    "agg_having",
    f"WITH {a.REVIEWS} SELECT user_id, count(*) AS reviews FROM reviews GROUP BY user_id HAVING count(*) > 80",
)
def agg_having(spark, sf):
    return rel.groups_above(a.reviews(spark, sf), "user_id", 80, "reviews")


@query(
    "agg_count_ordered",
    f"WITH {a.REVIEWS} SELECT business_id, count(*) AS n FROM reviews GROUP BY business_id ORDER BY n DESC, business_id",
)
def agg_count_ordered(spark, sf):
    return rel.count_per_key(a.reviews(spark, sf), "business_id").orderBy(F.desc("n"), "business_id")


@query(
    "active_users",
    f"""WITH {a.REVIEWS} SELECT user_id, reviews, {a.USER_SQL} FROM (SELECT user_id, count(*) AS reviews FROM reviews
    GROUP BY user_id HAVING count(*) > 80) JOIN customer ON c_custkey = user_id""",
)
def active_users(spark, sf):
    return rec.active_users(a.reviews(spark, sf), a.users(spark, sf), 80)


@query(
    "active_user_businesses",
    f"""WITH {a.REVIEWS} SELECT DISTINCT business_id FROM reviews WHERE user_id IN
    (SELECT user_id FROM reviews GROUP BY user_id HAVING count(*) > 80)""",
)
def active_user_businesses(spark, sf):
    return rec.reviews_of_active(a.reviews(spark, sf), 80).select("business_id").distinct()


@query(
    "join_inner_equi",
    f"WITH {a.REVIEWS} SELECT user_id, c_name AS name, business_id, stars FROM reviews JOIN customer ON c_custkey = user_id",
)
def join_inner_equi(spark, sf):
    return a.reviews(spark, sf).join(a.users(spark, sf), "user_id").select("user_id", "name", "business_id", "stars")


@query(
    "agg_mean",
    f"""WITH {a.REVIEWS} SELECT 'business' AS kind, business_id AS id, round(avg(stars), 6) AS mean FROM reviews GROUP BY 1, 2
    UNION ALL SELECT 'user', user_id, round(avg(stars), 6) FROM reviews GROUP BY 1, 2""",
)
def agg_mean(spark, sf):
    reviews = a.reviews(spark, sf)
    b = rec.business_stats(reviews).select(F.lit("business").alias("kind"), F.col("business_id").alias("id"), "mean")
    u = rec.user_stats(reviews).select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "mean")
    return rounded(b.unionByName(u), "mean")


@query(
    "agg_std_population",
    f"""WITH {a.REVIEWS} SELECT 'business' AS kind, business_id AS id, round(stddev_pop(stars), 6) AS std FROM reviews GROUP BY 1, 2
    UNION ALL SELECT 'user', user_id, round(stddev_pop(stars), 6) FROM reviews GROUP BY 1, 2""",
)
def agg_std_population(spark, sf):
    reviews = a.reviews(spark, sf)
    b = rec.business_stats(reviews).select(F.lit("business").alias("kind"), F.col("business_id").alias("id"), "std")
    u = rec.user_stats(reviews).select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "std")
    return rounded(b.unionByName(u), "std")


@query(
    "join_entity_stats",
    f"""WITH {a.REVIEWS}, {a.STATS} SELECT user_id, business_id, stars, l_orderkey, round(mean, 6) AS mean, round(std, 6) AS std
    FROM reviews JOIN stats USING (user_id)""",
)
def join_entity_stats(spark, sf):
    reviews = a.reviews(spark, sf)
    joined = reviews.join(rec.user_stats(reviews).drop("reviews"), "user_id")
    return rounded(joined, "mean", "std").select("user_id", "business_id", "stars", "l_orderkey", "mean", "std")


@query("agg_drop_duplicates", f"WITH {a.RATINGS} SELECT user_id, business_id, stars FROM ratings")
def agg_drop_duplicates(spark, sf):
    return a.ratings(spark, sf)


@query(
    "nth_by_count",
    f"WITH {a.REVIEWS} SELECT user_id, count(*) AS n FROM reviews GROUP BY user_id ORDER BY n DESC, user_id LIMIT 1 OFFSET 6",
)
def nth_by_count(spark, sf):
    return rel.nth_by_count(a.reviews(spark, sf), "user_id", 7)


@query(
    "point_lookup_default",
    f"""WITH {a.RATINGS}, {a.TARGET}, own AS (SELECT business_id, stars FROM ratings WHERE user_id = {ONE})
    SELECT s_suppkey AS business_id, coalesce(stars, 0) AS stars FROM supplier LEFT JOIN own ON business_id = s_suppkey""",
)
def point_lookup_default(spark, sf):
    user, _, ratings = prepared(spark, sf)
    asked = a.business(spark, sf).select("business_id", F.lit(user).alias("user_id"))
    own = ratings.where(F.col("user_id") == user)
    return rel.lookup_or_default(asked, own, ["user_id", "business_id"], "stars", 0.0).select("business_id", "stars")


@query(
    "record_lookup",
    f"""WITH {a.RATINGS}, {a.TARGET} SELECT {a.BUSINESS_SQL}
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE s_suppkey IN (SELECT business_id FROM ratings WHERE user_id = {ONE})""",
)
def record_lookup(spark, sf):
    user, _, ratings = prepared(spark, sf)
    own = ratings.where(F.col("user_id") == user)
    return rel.semi_by_key(a.business(spark, sf), own, "business_id")


@query("head_n", f"SELECT c_custkey AS user_id, {a.USER_SQL} FROM customer ORDER BY c_custkey LIMIT 5")
def head_n(spark, sf):
    return a.users(spark, sf).orderBy("user_id").limit(5)


@query("fn_concat", "SELECT o_orderkey, o_orderstatus || ' ' || o_orderpriority AS label FROM orders")
def fn_concat(spark, sf):
    label = ft.full_name(F.col("o_orderstatus"), F.col("o_orderpriority"))
    return a.table(spark, sf, "orders").select("o_orderkey", label.alias("label"))


@query(
    "union_all",
    """SELECT 'from' AS side, o_custkey AS id FROM orders UNION ALL SELECT 'to', l_suppkey FROM lineitem""",
)
def union_all(spark, sf):
    left = a.table(spark, sf, "orders").select(F.lit("from").alias("side"), F.col("o_custkey").alias("id"))
    right = a.table(spark, sf, "lineitem").select(F.lit("to").alias("side"), F.col("l_suppkey").alias("id"))
    return left.unionByName(right)


# Ratings of nations instead of single suppliers: 25 known columns at every scale.
NATIONS = list(range(25))
NATION_FIRST = f"""{a.REVIEWS}, nr AS (SELECT user_id, s_nationkey AS nation, stars, row_number() OVER (PARTITION BY user_id,
  s_nationkey ORDER BY {', '.join(a.REVIEW_ORDER)}) AS rn FROM reviews JOIN supplier ON s_suppkey = business_id)"""


def nation_ratings(spark, sf):
    places = a.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("business_id"), "s_nationkey")
    placed = a.reviews(spark, sf).join(places, "business_id")
    first = F.min_by("stars", F.struct(*a.REVIEW_ORDER)).alias("stars")
    return placed.groupBy("user_id", F.col("s_nationkey").alias("nation")).agg(first)


def cells_sql(fill: str) -> str:
    return ", ".join(f"coalesce(max(CASE WHEN nation = {n} THEN stars END), {fill}) AS \"{n}\"" for n in NATIONS)


@query("agg_pivot", f"WITH {NATION_FIRST} SELECT user_id, {cells_sql('NULL')} FROM nr WHERE rn = 1 GROUP BY user_id")
def agg_pivot(spark, sf):
    return rel.rating_matrix(nation_ratings(spark, sf), "user_id", "nation", "stars", NATIONS, None)


@query(
    "agg_fill_missing",
    f"WITH {NATION_FIRST} SELECT user_id, {cells_sql('0.1::DOUBLE')} FROM nr WHERE rn = 1 GROUP BY user_id",
)
def agg_fill_missing(spark, sf):
    return rel.rating_matrix(nation_ratings(spark, sf), "user_id", "nation", "stars", NATIONS, rec.UNRATED)


DAYS = list(range(1, 32))
DAY_COLUMNS = ", ".join(f"max(CASE WHEN day = {d} THEN v END) AS \"{d}\"" for d in DAYS)


@query(
    "agg_transpose",
    f"""WITH d AS (SELECT event_type, day(ts) AS day, round(avg(value), 6) AS v FROM events GROUP BY 1, 2)
    SELECT event_type AS "column", {DAY_COLUMNS} FROM d GROUP BY event_type""",
)
def agg_transpose(spark, sf):
    """Days by event types turned into event types by days: both sides have a fixed extent."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    daily = (
        a.table(spark, sf, "events")
        .groupBy(F.dayofmonth("ts").alias("day"), "event_type")
        .agg(F.round(F.avg("value"), 6).alias("stars"))
    )
    wide = rel.rating_matrix(daily, "day", "event_type", "stars", kinds, None)
    return rel.transpose(wide, "day", DAYS)


# ---- wide matrices: all columns that occur, none of them listed


def rating_blocks(spark, sf):
    _, _, ratings = prepared(spark, sf)
    return blocked_matrix(ratings, "user_id", "business_id", "stars", 64)


PLACED = f"""{a.RATINGS}, us AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS u FROM (SELECT DISTINCT user_id FROM ratings)),
    bs AS (SELECT business_id, row_number() OVER (ORDER BY business_id) - 1 AS b FROM (SELECT DISTINCT business_id FROM ratings))"""


@query("wide_matrix", f"WITH {PLACED} SELECT u // 64 AS row_block, b // 64 AS column_block, u AS row_place, b AS column_place, stars FROM ratings JOIN us USING (user_id) JOIN bs USING (business_id)")
def wide_matrix(spark, sf):
    """Ratings as a matrix of blocks."""
    blocks = rating_blocks(spark, sf).blocks
    return blocks.select("row_block", "column_block", F.explode("cells").alias("c")).select(
        "row_block", "column_block", F.col("c.row").alias("row_place"), F.col("c.column").alias("column_place"), F.col("c.value").alias("stars")
    )


@query("wide_matrix_transposed", f"WITH {a.RATINGS} SELECT business_id AS business, user_id AS user, stars FROM ratings")
def wide_matrix_transposed(spark, sf):
    return rating_blocks(spark, sf).transposed().cells().toDF("business", "user", "stars")


@query(
    "wide_matrix_filled",
    f"""WITH {PLACED}, w AS (SELECT count(*) AS width FROM bs) SELECT user_id, any_value(width) AS width, round(sum(stars) + 0.1::DOUBLE * (any_value(width) - count(*)), 6) AS total,
    round(sum(stars * (b + 1)) + 0.1::DOUBLE * (any_value(width) * (any_value(width) + 1) / 2 - sum(b + 1)), 4) AS weighted FROM ratings JOIN bs USING (business_id) CROSS JOIN w GROUP BY user_id""",
)
def wide_matrix_filled(spark, sf):
    """Every user's whole row with absent cells filled: its width, sum, and sum weighted by the place."""
    rows = rating_blocks(spark, sf).vectors(rec.UNRATED, place_sums, PLACE_SUMS)
    return rows.select(F.col("row").alias("user_id"), "width", F.round("total", 6).alias("total"), F.round("weighted", 4).alias("weighted"))


# ---- similarity -----------------------------------------------------------------------------------

PAIR_SIM = "SELECT user_id, neighbor_id, round(corr, 9) + 0 AS corr FROM sim"




def best_sql(k: int) -> str:
    """Each user's best others, equal rounded correlations in order of the id."""
    return f"""SELECT user_id, neighbor_id, corr, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY corr DESC, neighbor_id) AS rank FROM (SELECT user_id, neighbor_id, round(corr, 9) + 0 AS corr FROM sim
      WHERE neighbor_id <> user_id AND corr IS NOT NULL)) WHERE rank <= {k}"""


def best(sim):
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("corr"), "neighbor_id"))
    return rounded(sim, "corr", digits=9).withColumn("rank", place).select("user_id", "neighbor_id", "corr", "rank")


@query("user_similarity", f"WITH {a.RATINGS}, {a.PROFILES}, {a.corr_sql('profiles')} {best_sql(30)}")
def user_similarity(spark, sf):
    _, _, ratings = prepared(spark, sf)
    return best(rec.user_similarity(ratings, best=30))


@query(
    "agg_corr_matrix",
    f"""WITH {a.REVIEWS}, m AS (SELECT l_suppkey AS b, o_orderpriority AS u, count(*) AS c FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2), profiles AS (SELECT u AS id, b AS k, CAST(c AS DOUBLE) AS v FROM m),
    {a.corr_sql('profiles')} {PAIR_SIM}""",
)
def agg_corr_matrix(spark, sf):
    """Correlation of order priorities over how often each supplier serves them."""
    orders = a.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    lines = a.table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    counts = rel.count_per_key(lines.join(orders, lines.l_orderkey == orders.o_orderkey), "o_orderpriority", "l_suppkey")
    profiles = counts.select(
        F.col("o_orderpriority").alias("id"), F.col("l_suppkey").alias("key"), F.col("n").cast("double").alias("value")
    )
    return rounded(correlation_matrix(materialize(profiles)).withColumnRenamed("id", "user_id"), "corr", digits=9)


@query("user_similarity_one", f"WITH {a.SIM_ONE} {PAIR_SIM}")
def user_similarity_one(spark, sf):
    *_, sim = similar(spark, sf)
    return rounded(sim, "corr", digits=9)


NEAREST = "SELECT user_id, neighbor_id, round(corr, 9) AS corr, rank FROM nearest"


@query("nearest_neighbors", f"WITH {a.SIM_ONE}, {a.nearest_sql(30)} {NEAREST}")
def nearest_neighbors(spark, sf):
    user, _, _, sim = similar(spark, sf)
    return rounded(rec.nearest_neighbors(sim, user, 30), "corr", digits=9)


@query(
    "nearest_neighbors_all", f"WITH {a.RATINGS}, {a.PROFILES}, {a.corr_sql('profiles')} {best_sql(5)}"
)
def nearest_neighbors_all(spark, sf):
    _, _, ratings = prepared(spark, sf)
    return rounded(rec.neighbors_of_all(ratings, 5), "corr", digits=9)


@query(
    "topk_neighbors_skip_self",
    f"WITH {a.SIM_ONE}, {a.nearest_sql(10)} SELECT neighbor_id, rank FROM nearest",
)
def topk_neighbors_skip_self(spark, sf):
    user, _, _, sim = similar(spark, sf)
    return rec.nearest_neighbors(sim, user, 10).select("neighbor_id", "rank")


@query(
    "threshold_neighbors",
    f"WITH {a.SIM_ONE} SELECT user_id, neighbor_id, round(corr, 9) AS corr FROM sim WHERE neighbor_id <> user_id AND corr > 0.05",
)
def threshold_neighbors(spark, sf):
    user, _, _, sim = similar(spark, sf)
    return rounded(rec.threshold_neighbors(sim, user, 0.05), "corr", digits=9)


JOINED = f"""{a.SIM_ONE}, {a.nearest_sql(45)}, nr AS (SELECT rank, neighbor_id, business_id,
  (r.stars - s.mean) * corr / s.std AS delta, corr AS weight FROM nearest JOIN stats s ON s.user_id = neighbor_id
  JOIN ratings r ON r.user_id = neighbor_id WHERE s.std > 0)"""
PRED = """CASE WHEN delta IS NULL OR delta = 0 OR weight = 0 THEN mean ELSE mean + std * delta / weight END"""
MINE = f"me AS (SELECT mean, std FROM stats WHERE user_id = {ONE})"


def predicted_sql(k: int) -> str:
    return f"""{JOINED}, {MINE}, sums AS (SELECT business_id, sum(delta) AS delta, sum(weight) AS weight FROM nr WHERE rank <= {k}
      GROUP BY 1), own AS (SELECT business_id, stars FROM ratings WHERE user_id = {ONE})"""


@query(
    "join_neighbor_ratings",
    f"""WITH {JOINED} SELECT neighbor_id, rank, business_id, round(delta, 7) + 0 AS delta, round(weight, 7) AS weight FROM nr""",
)
def join_neighbor_ratings(spark, sf):
    user, stats, ratings, sim = similar(spark, sf)
    joined = rec.neighbor_ratings(rec.nearest_neighbors(sim, user, 45), ratings, stats)
    return rounded(joined, "delta", "weight", digits=7).drop("user_id")


@query(
    "predict_rating",
    f"""WITH {predicted_sql(30)} SELECT business_id, stars, round({PRED}, 6) AS predicted FROM own CROSS JOIN me
    LEFT JOIN sums USING (business_id)""",
)
def predict_rating(spark, sf):
    user, stats, ratings, sim = similar(spark, sf)
    own = ratings.where(F.col("user_id") == user)
    done = rec.predict_rating(own, rec.nearest_neighbors(sim, user, 30), ratings, stats)
    return rounded(done, "predicted").select("business_id", "stars", "predicted")


def sweep_sql(joined: str = JOINED) -> str:
    """SQL of a sweep over ``nr`` (rank, business_id, delta, weight): the CTE ``sweep``."""
    return f"""{joined}, {MINE}, own AS (SELECT business_id, stars FROM ratings WHERE user_id = {ONE}),
      ks AS (SELECT unnest(generate_series(5, 45, 5)) AS k),
      sums AS (SELECT k, business_id, sum(delta) AS delta, sum(weight) AS weight FROM ks JOIN nr ON rank <= k GROUP BY 1, 2),
      pred AS (SELECT k, business_id, stars, {PRED} AS predicted FROM own CROSS JOIN ks CROSS JOIN me
        LEFT JOIN sums USING (k, business_id)),
      sweep AS (SELECT CAST(k AS INTEGER) AS k, round(sqrt(avg((predicted - stars) * (predicted - stars))), 6) AS rmse,
        round(1 - avg(abs(predicted - stars) / stars), 6) AS accuracy, round(avg(abs(predicted - stars)), 6) AS mae
        FROM pred GROUP BY k)"""


@query("evaluate_k_sweep", f"WITH {sweep_sql()} SELECT * FROM sweep")
def evaluate_k_sweep(spark, sf):
    user, stats, ratings, sim = similar(spark, sf)
    return rounded(rec.evaluate_k_sweep(ratings, stats, sim, user, KS), "rmse", "accuracy", "mae")


@query("k_sweep_predictions", f"WITH {sweep_sql()} SELECT CAST(k AS INTEGER) AS k, business_id, stars, round(predicted, 6) AS predicted FROM pred")
def k_sweep_predictions(spark, sf):
    user, stats, ratings, sim = similar(spark, sf)
    return rounded(rec.sweep_predictions(ratings, stats, sim, user, KS), "predicted")


@query(
    "agg_error_metrics",
    f"""WITH {a.REVIEWS}, {a.STATS}, g AS (SELECT business_id, stars, mean FROM reviews JOIN stats USING (user_id))
    SELECT business_id, round(sqrt(avg((mean - stars) * (mean - stars))), 6) AS rmse,
    round(1 - avg(abs(mean - stars) / stars), 6) AS accuracy, round(avg(abs(mean - stars)), 6) AS mae FROM g GROUP BY 1""",
)
def agg_error_metrics(spark, sf):
    reviews = a.reviews(spark, sf)
    guessed = reviews.join(rec.user_stats(reviews), "user_id")
    return rounded(rel.error_metrics(guessed, ["business_id"], "mean", "stars"), "rmse", "accuracy", "mae")


RECOMMENDED = f"""{predicted_sql(45)}, done AS (SELECT {a.BUSINESS_SQL},
  round({PRED}, 6) AS predicted FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  CROSS JOIN me LEFT JOIN sums ON business_id = s_suppkey)"""


@query("recommend_businesses", f"WITH {RECOMMENDED} SELECT * FROM done")
def recommend_businesses(spark, sf):
    user, stats, ratings, sim = similar(spark, sf)
    done = rec.recommend_businesses(ratings, stats, sim, a.business(spark, sf), user, 45)
    return rounded(done, "predicted").drop("user_id")


@query("sort_predictions", f"WITH {RECOMMENDED} SELECT business_id, predicted FROM done ORDER BY predicted, business_id")
def sort_predictions(spark, sf):
    return rec.ranked_predictions(recommend_businesses(spark, sf)).select("business_id", "predicted")


# ---- by the words users write -----------------------------------------------------------------------

TEXT_PROFILES = r"""tp AS (SELECT doc_id % 50 AS id, word AS k, CAST(count(*) AS DOUBLE) AS v FROM (
  SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS word FROM documents) WHERE word <> '' GROUP BY 1, 2)"""
WRITER = 7


@query("lexical_user_similarity", f"WITH {TEXT_PROFILES}, {a.corr_sql('tp')} {best_sql(20)}")
def lexical_user_similarity(spark, sf):
    return best(rec.lexical_user_similarity(a.review_texts(spark, sf), best=20))


# Both recommenders rate the same writer, over the 50 users that have texts, each with one rating per business.
WRITERS = f"""{a.REVIEWS}, target AS (SELECT {WRITER} AS user_id), {a.STATS}, ratings AS (
  SELECT user_id, business_id, stars FROM (SELECT *, row_number() OVER (PARTITION BY user_id, business_id
    ORDER BY {', '.join(a.REVIEW_ORDER)}) AS rn FROM reviews WHERE user_id IN (SELECT doc_id % 50 FROM documents)) WHERE rn = 1)"""


def writer_joined(name: str, profiles: str) -> str:
    return f"""{profiles}, {a.corr_sql(name, left=f'= {WRITER}')}, {a.nearest_sql(45)},
      nr AS (SELECT rank, business_id, (r.stars - s.mean) * corr / s.std AS delta, corr AS weight FROM nearest
      JOIN stats s ON s.user_id = neighbor_id JOIN ratings r ON r.user_id = neighbor_id WHERE s.std > 0)"""


BY_STARS = sweep_sql(f"{WRITERS}, {writer_joined('profiles', a.PROFILES)}")
BY_WORDS = sweep_sql(f"{WRITERS}, {writer_joined('tp', TEXT_PROFILES)}")


@query(
    "compare_recommenders",
    f"""SELECT 'ratings' AS recommender, * FROM (WITH {BY_STARS} SELECT * FROM sweep)
    UNION ALL SELECT 'words', * FROM (WITH {BY_WORDS} SELECT * FROM sweep)""",
)
def compare_recommenders(spark, sf):
    texts, reviews = a.review_texts(spark, sf), a.reviews(spark, sf)
    writers = texts.select("user_id").distinct()
    ratings = materialize(rec.one_rating_each(rel.semi_by_key(reviews, writers, "user_id"), a.REVIEW_ORDER))
    stats = materialize(rec.user_stats(reviews))
    sims = {
        "ratings": rec.similarity_to_user(ratings, WRITER),
        "words": rec.lexical_similarity_to_user(texts, WRITER),
    }
    sweeps = {n: rec.evaluate_k_sweep(ratings, stats, s, WRITER, KS) for n, s in sims.items()}
    return rounded(rec.compare_recommenders(**sweeps), "rmse", "accuracy", "mae")
