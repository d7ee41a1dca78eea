"""The test tables in the shapes the jobs read: once as DataFrames, once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.plans.movement import event_moments, flatten_movement, moment_positions, players_with_ball
from rivulet.plans.recommend import one_rating_each, reviews_of_active
from rivulet.sources.readers import spread

# One list each, shared by the Spark queries and their SQL.
STOPWORDS = ["and", "by", "de", "des", "el", "for", "in", "is", "la", "le", "of", "that", "the", "to", "un", "with"]
# ``orre`` is listed twice on purpose: it counts twice.
POLARITIES = [
    ("rewh", "positive"), ("er", "positive"), ("orre", "positive"), ("orre", "positive"),
    ("thatin", "negative"), ("inoran", "negative"), ("ononst", "negative"), ("ha", "both"),
]
POSITIVES = [("rewh", 1.0), ("er", 0.5), ("orre", 1.5), ("orre", 1.0)]
NEGATIVES = [("thatin", -1.0), ("inoran", -0.5), ("ononst", -2.0)]
GOOD_EVENTS = [("view", 1.0), ("purchase", 2.0)]
BAD_EVENTS = [("error", -1.0)]
TRACKED = ["VIEW", "err"]

REVIEW_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "stars"]
SIMILAR_MIN = 60  # reviews a user needs to take part in the similarity
GAME_RANGE = (700.5, 718.0)
SHOT_RANGE = (7.7, 20.4)
FOCUS = 3
PAIRS = [(3, -1), (3, 5), (3, 9), (7, 9)]
SPLIT_DAY = "2024-01-16"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rows(spark: SparkSession, pairs: list[tuple], columns: str) -> DataFrame:
    """A few literal rows as a table whose size Spark knows."""
    values = ", ".join(str(p) for p in pairs)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").alias("business_id"),
        (1 + F.col("l_quantity").cast("long") % 5).cast("double").alias("stars"),
        "l_shipdate",
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("o_orderkey")


def active_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return reviews_of_active(reviews(spark, sf), SIMILAR_MIN)


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """One rating per active user and business."""
    return one_rating_each(active_reviews(spark, sf), REVIEW_ORDER)


def users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("average_stars"),
        F.col("c_nationkey").cast("long").alias("review_count"),
    )


def business(spark: SparkSession, sf: str) -> DataFrame:
    supplier, nation, region = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    placed = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return placed.select(
        F.col("s_suppkey").alias("business_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("city"),
        F.col("s_acctbal").alias("stars"),
        F.col("s_nationkey").cast("long").alias("review_count"),
    )


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"))


def review_texts(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select((F.col("doc_id") % 50).alias("user_id"), "text")


def posts(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(F.col("doc_id").alias("id"), "text")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the number k read from their JSON properties."""
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", F.from_json("props", "k long")["k"].alias("k")
    )


def retweets(spark: SparkSession, sf: str) -> DataFrame:
    user = F.struct(F.struct(F.col("user_id").cast("string").alias("screen_name")).alias("user"))
    return events(spark, sf).select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("text"),
        F.col("k").alias("retweet_count"),
        F.when(F.col("event_type") == "view", user).alias("retweeted_status"),
    )


ENTITY = ["screen_name", "text", "l_linenumber"]


def entity_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as entities of orders, one row each."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_suppkey").cast("string").alias("screen_name"),
        F.col("l_returnflag").alias("text"),
        "l_linenumber",
    )


def entity_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as posts, each with the list of its few line items."""
    return entity_lines(spark, sf).groupBy("id").agg(F.sort_array(F.collect_list(F.struct(*ENTITY))).alias("entities"))


def contacts(spark: SparkSession, sf: str, priority: str) -> DataFrame:
    """(id, screen_name) of customers with an order of one priority."""
    ids = table(spark, sf, "orders").where(F.col("o_orderpriority") == priority).select(F.col("o_custkey").alias("id")).distinct()
    named = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("screen_name"))
    return ids.join(named, "id")


def friends(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf, "1-URGENT")


def followers(spark: SparkSession, sf: str) -> DataFrame:
    return contacts(spark, sf, "5-LOW")


EVENT_MOMENTS, GAME_EVENTS = 100, 2


def tracked_events(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as tracking moments with 32 entities, the last being the ball: one row per event,
    its moments in an array."""
    e = F.col("embedding")

    def entity(p):
        player = F.when(p == 31, F.lit(-1)).otherwise(p)
        numbers = [p % 2, player, F.get(e, p * 2), F.get(e, p * 2 + 1), F.lit(0.0)]
        return F.array(*[n.cast("double") for n in numbers])

    moments = table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / (EVENT_MOMENTS * GAME_EVENTS)).alias("game_id"),
        (F.floor(F.col("vec_id") / EVENT_MOMENTS) % GAME_EVENTS).alias("event_id"),
        F.struct(
            "vec_id",
            (F.lit(720.0) - F.lit(0.04) * F.col("vec_id")).alias("game_clock"),
            (F.lit(24.0) - F.lit(0.04) * (F.col("vec_id") % 600)).alias("shot_clock"),
            F.transform(F.sequence(F.lit(0), F.lit(31)), entity).alias("positions"),
        ).alias("m"),
    )
    return moments.groupBy("game_id", "event_id").agg(F.sort_array(F.collect_list("m")).alias("moments"))


def payload(spark: SparkSession, sf: str) -> DataFrame:
    return event_moments(tracked_events(spark, sf))


def players(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("player_id"),
        F.col("n_name").alias("first_name"),
        F.col("r_name").alias("last_name"),
        F.col("n_regionkey").cast("string").alias("jersey"),
    )
    return players_with_ball(named)


def positions(spark: SparkSession, sf: str) -> DataFrame:
    """Tracked positions without names, which most questions do not need."""
    return moment_positions(payload(spark, sf))


def movement(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_movement(payload(spark, sf), players(spark, sf))


def shots(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("player_id"),
        F.col("l_discount").alias("close_def_dist"),
        F.col("l_quantity").alias("dribbles"),
        F.col("l_extendedprice").alias("shot_dist"),
        F.col("l_tax").alias("touch_time"),
    )


def shot_points(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(F.col("value").alias("x"), F.col("k").cast("double").alias("y"))


BOX_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
BOX_SQL = {
    "pts": "l_quantity", "reb": "l_linenumber", "ast": "l_discount * 100", "stl": "l_tax * 100",
    "blk": "l_orderkey % 7", "pfd": "l_partkey % 5", "fta": "l_linenumber + 4", "ftm": "l_linenumber",
    "fga": "l_quantity + l_linenumber", "fgm": "l_partkey % 11", "tov": "l_partkey % 9",
}


def box_results(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as game results of suppliers, several rows per player."""
    stats = [F.expr(sql).cast("double").alias(name) for name, sql in BOX_SQL.items()]
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("player_id"), *BOX_ORDER, *stats)


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        F.to_date("ts").alias("day"), "ts", F.col("value").alias("sp500"), F.col("k").cast("double").alias("nasdaq")
    )


def time_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Event times in the form ``Tue Jan  2 09:30:00 +0000 2024``."""
    day = F.lpad(F.dayofmonth("ts").cast("string"), 2, " ")
    clock = F.concat(F.date_format("ts", "HH:mm:ss"), F.lit(" +0000 "), F.date_format("ts", "yyyy"))
    text = F.concat_ws(" ", F.date_format("ts", "E"), F.date_format("ts", "MMM"), day, clock)
    return table(spark, sf, "events").select("event_id", text.alias("created_at"))


def batch_size(spark: SparkSession, sf: str) -> int:
    """A size with which all posts fit the 40 slots."""
    return max(1, -(-table(spark, sf, "documents").count() // 40))


def hourly_series(spark: SparkSession, sf: str) -> DataFrame:
    return (
        events(spark, sf)
        .groupBy("event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("time"))
        .agg(F.avg("value").alias("value"), F.avg("k").alias("index"))
    )


# ---- the same shapes in SQL -------------------------------------------------------------------

USER_SQL = "c_name AS name, c_acctbal AS average_stars, CAST(c_nationkey AS BIGINT) AS review_count"
BUSINESS_SQL = """s_suppkey AS business_id, s_name AS name, n_name AS state, r_name AS city, s_acctbal AS stars,
  CAST(s_nationkey AS BIGINT) AS review_count"""
STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"


def values_sql(pairs: list[tuple], columns: str) -> str:
    cells = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE" for v in p) + ")" for p in pairs)
    return f"(SELECT * FROM (VALUES {cells}) AS v({columns}))"


REVIEWS = """reviews AS (
  SELECT o_custkey AS user_id, l_suppkey AS business_id, CAST(1 + CAST(l_quantity AS BIGINT) % 5 AS DOUBLE) AS stars,
         l_shipdate, l_orderkey, l_linenumber
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""
ACTIVE = f"""{REVIEWS}, active AS (
  SELECT * FROM reviews WHERE user_id IN (SELECT user_id FROM reviews GROUP BY user_id HAVING count(*) > {SIMILAR_MIN}))"""
RATINGS = f"""{ACTIVE}, ratings AS (
  SELECT user_id, business_id, stars FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, business_id ORDER BY {', '.join(REVIEW_ORDER)}) AS rn FROM active)
  WHERE rn = 1)"""
TARGET = """target AS (
  SELECT user_id FROM reviews GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1 OFFSET 6)"""
STATS = """stats AS (SELECT user_id, avg(stars) AS mean, stddev_pop(stars) AS std FROM reviews GROUP BY user_id)"""


def corr_sql(profiles: str, name: str = "sim", left: str = "") -> str:
    """Correlations of (id, k, v) profiles; ``left`` restricts the first user of each pair."""
    return f"""{name}_s AS (SELECT id, sum(v) AS s, sum(v * v) AS q FROM {profiles} GROUP BY id),
    {name}_n AS (SELECT CAST(count(DISTINCT k) AS DOUBLE) AS n FROM {profiles}),
    {name}_p AS (SELECT a.id AS u, b.id AS w, sum(a.v * b.v) AS p FROM {profiles} a JOIN {profiles} b ON a.k = b.k
      {('WHERE a.id ' + left) if left else ''} GROUP BY 1, 2),
    {name} AS (SELECT a.id AS user_id, b.id AS neighbor_id,
      (n * coalesce(p, 0) - a.s * b.s) / nullif(sqrt((n * a.q - a.s * a.s) * (n * b.q - b.s * b.s)), 0) AS corr
      FROM {name}_s a CROSS JOIN {name}_s b CROSS JOIN {name}_n LEFT JOIN {name}_p ON u = a.id AND w = b.id
      {('WHERE a.id ' + left) if left else ''})"""


PROFILES = "profiles AS (SELECT user_id AS id, business_id AS k, stars - CAST(0.1 AS DOUBLE) AS v FROM ratings)"
SIM_ONE = f"{RATINGS}, {TARGET}, {STATS}, {PROFILES}, {corr_sql('profiles', left='= (SELECT user_id FROM target)')}"


def nearest_sql(k: int, sim: str = "sim", name: str = "nearest") -> str:
    return f"""{name} AS (SELECT * FROM (SELECT user_id, neighbor_id, corr,
      row_number() OVER (PARTITION BY user_id ORDER BY corr DESC, neighbor_id) AS rank
      FROM {sim} WHERE neighbor_id <> user_id AND corr IS NOT NULL) WHERE rank <= {k})"""


EVENTS = """ev AS (SELECT event_id, ts, user_id, event_type, value,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)"""
RETWEETS = f"""{EVENTS}, rt AS (SELECT event_id AS id, event_type AS text, k AS retweet_count,
  CAST(user_id AS VARCHAR) AS screen_name FROM ev WHERE event_type = 'view')"""
EVENT_SQL = f"vec_id // {EVENT_MOMENTS}"
MOVES = f"""mv AS (SELECT vec_id // {EVENT_MOMENTS * GAME_EVENTS} AS game_id, {EVENT_SQL} % {GAME_EVENTS} AS event_id,
  p % 2 AS team_id, CASE WHEN p = 31 THEN -1 ELSE p END AS player_id,
  CAST(embedding[2 * p + 1] AS DOUBLE) AS x_loc, CAST(embedding[2 * p + 2] AS DOUBLE) AS y_loc, place AS moment,
  CAST(720 AS DOUBLE) - CAST(0.04 AS DOUBLE) * vec_id AS game_clock,
  CAST(24 AS DOUBLE) - CAST(0.04 AS DOUBLE) * (vec_id % 600) AS shot_clock
  FROM (SELECT *, row_number() OVER (PARTITION BY {EVENT_SQL} ORDER BY vec_id) - 1 AS place FROM embeddings)
  CROSS JOIN (SELECT unnest(generate_series(0, 31)) AS p))"""
PLAYERS = """players AS (SELECT n_nationkey AS player_id, n_name || ' ' || r_name AS player_name,
  CAST(n_regionkey AS VARCHAR) AS jersey FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT -1, 'ball', NULL)"""
SLOTS = """slots AS (SELECT *, CAST(greatest(1, ceil((hour(ts) * 60 + minute(ts) - 570) / 10.0)) AS INTEGER) AS slot FROM ev)"""
QUOTES = f"""{EVENTS}, {SLOTS}, quotes AS (SELECT CAST(ts AS DATE) AS day, slot, arg_max(value, ts) AS sp500,
  CAST(arg_max(k, ts) AS DOUBLE) AS nasdaq FROM slots WHERE slot < 40 GROUP BY 1, 2)"""
WORDS = r"""words AS (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS word FROM documents)"""
CLEAN = rf"""{WORDS}, clean AS (SELECT doc_id, lower(word) AS word FROM words WHERE word <> '' AND word NOT IN {STOP_SQL})"""
BATCHES = """batches AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos,
  (SELECT greatest(1, (count(*) + 39) // 40) FROM documents) AS size FROM documents),
  batched AS (SELECT doc_id, CAST(pos // size AS INTEGER) AS slot FROM batches)"""
SENTIMENT = f"""{CLEAN}, {BATCHES},
  pos AS (SELECT word, sum(value) AS p FROM {values_sql(POSITIVES, 'word, value')} GROUP BY word),
  neg AS (SELECT word, sum(value) AS q FROM {values_sql(NEGATIVES, 'word, value')} GROUP BY word),
  sums AS (SELECT slot, sum(coalesce(p, 0)) AS positive, sum(coalesce(q, 0)) AS negative
    FROM clean JOIN batched USING (doc_id) LEFT JOIN pos USING (word) LEFT JOIN neg USING (word) GROUP BY slot),
  sentiment AS (SELECT *, positive / nullif(abs(negative), 0) AS ratio, positive - abs(negative) AS diff FROM sums)"""
HOURLY = f"""{EVENTS}, hourly AS (SELECT event_type, date_trunc('hour', ts) AS time, avg(value) AS value, avg(k) AS "index"
  FROM ev GROUP BY 1, 2)"""
SHOTS = """shots AS (SELECT l_suppkey AS player_id, l_discount AS close_def_dist, l_quantity AS dribbles,
  l_extendedprice AS shot_dist, l_tax AS touch_time FROM lineitem)"""
BOX = f"""box AS (SELECT player_id, {', '.join(f'round({s}, 2) AS {s}' for s in BOX_SQL)} FROM (
  SELECT l_suppkey AS player_id, {', '.join(f'CAST({sql} AS DOUBLE) AS {s}' for s, sql in BOX_SQL.items())},
  row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(BOX_ORDER)}) AS rn FROM lineitem) WHERE rn = 1)"""
CONTACTS = """fr AS (SELECT DISTINCT o_custkey AS id, c_name AS screen_name FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderpriority = '1-URGENT'),
  fo AS (SELECT DISTINCT o_custkey AS id, c_name AS screen_name FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderpriority = '5-LOW')"""
