"""Time slot, sentiment series, Granger and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions import text as ft, times
from rivulet.operators import ordered, relational as rel
from rivulet.plans import text, timeseries as ts
from rivulet.streaming import posts as stream
from workload import adapters as a
from workload.courts import rounded
from workload.registry import query

MAXLAG = 5


def positives(spark):
    return a.rows(spark, a.POSITIVES, "word, value")


def negatives(spark):
    return a.rows(spark, a.NEGATIVES, "word, value")


# ---- times ----------------------------------------------------------------------------------------

STAMP = "strftime(ts, '%a %b ') || lpad(CAST(day(ts) AS VARCHAR), 2, ' ') || strftime(ts, ' %H:%M:%S +0000 %Y')"


@query(
    "fn_find",
    f"SELECT event_id, strpos({STAMP}, '+0000') AS at FROM events",
)
def fn_find(spark, sf):
    return a.time_strings(spark, sf).select("event_id", ft.find(F.col("created_at"), "+0000").alias("at"))


@query("fn_remove_text", f"SELECT event_id, replace({STAMP}, '+0000', '') AS cut FROM events")
def fn_remove_text(spark, sf):
    return a.time_strings(spark, sf).select("event_id", ft.remove_text(F.col("created_at"), "+0000").alias("cut"))


@query("fn_parse_time", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events")
def fn_parse_time(spark, sf):
    parsed = times.parse_ctime(F.col("created_at"))
    return a.time_strings(spark, sf).select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("time"))


@query("fn_format_hhmm", "SELECT event_id, strftime(ts, '%H:%M') AS hhmm FROM events")
def fn_format_hhmm(spark, sf):
    return a.time_strings(spark, sf).select("event_id", times.hhmm(times.parse_ctime(F.col("created_at"))).alias("hhmm"))


@query("fn_trim_cast", f"SELECT event_id, year(ts)::DOUBLE AS year, CAST(day(ts) AS VARCHAR) AS day FROM events")
def fn_trim_cast(spark, sf):
    stamp = F.col("created_at")
    return a.time_strings(spark, sf).select(
        "event_id",
        ft.trim_number(F.substring(stamp, -5, 5)).alias("year"),
        ft.trim_string(F.substring(stamp, 8, 3)).alias("day"),
    )


@query(
    "fn_time_grid",
    f"""WITH {a.EVENTS}, {a.SLOTS}, g AS (SELECT CAST(unnest(generate_series(0, 39)) AS INTEGER) AS slot),
    n AS (SELECT slot, count(*) AS n FROM slots WHERE slot < 40 GROUP BY slot)
    SELECT slot, printf('%02d:%02d', (570 + slot * 10) // 60, (570 + slot * 10) % 60) AS label, coalesce(n, 0) AS n
    FROM g LEFT JOIN n USING (slot)""",
)
def fn_time_grid(spark, sf):
    """The grid with the number of events in each slot, empty ones included."""
    slotted = a.events(spark, sf).select(times.slot_index(F.col("ts")).alias("slot"))
    filled = times.time_grid(spark).join(rel.count_per_key(slotted, "slot"), "slot", "left")
    return filled.select("slot", "label", F.coalesce("n", F.lit(0)).alias("n"))


# ---- slots and batches ----------------------------------------------------------------------------

DAY = "CAST(day AS VARCHAR) AS day"


@query("slot_last_quote", f"WITH {a.QUOTES} SELECT {DAY}, slot, sp500, nasdaq FROM quotes")
def slot_last_quote(spark, sf):
    last = ordered.slot_last_quote(a.quotes(spark, sf), "ts", ["sp500", "nasdaq"], ["day"])
    return last.withColumn("day", F.col("day").cast("string"))


@query("batch_by_count", f"WITH {a.BATCHES} SELECT doc_id AS id, slot FROM batched")
def batch_by_count(spark, sf):
    batched = ordered.batch_by_count(a.posts(spark, sf), ["id"], a.batch_size(spark, sf))
    return batched.select("id", "slot")


MEASURES = "round(ratio, 6) AS ratio, round(diff, 6) + 0 AS diff"


@query("batch_sentiment", f"WITH {a.SENTIMENT} SELECT slot, positive, negative, {MEASURES} FROM sentiment")
def batch_sentiment(spark, sf):
    size = a.batch_size(spark, sf)
    found = ts.batch_sentiment(a.posts(spark, sf), positives(spark), negatives(spark), size, a.STOPWORDS)
    return rounded(found, "ratio", "diff")


@query(
    "agg_ratio_and_diff",
    f"""WITH {a.CLEAN}, pos AS (SELECT word, sum(value) AS p FROM {a.values_sql(a.POSITIVES, 'word, value')} GROUP BY word),
    neg AS (SELECT word, sum(value) AS q FROM {a.values_sql(a.NEGATIVES, 'word, value')} GROUP BY word),
    s AS (SELECT doc_id AS id, sum(coalesce(p, 0)) AS positive, sum(coalesce(q, 0)) AS negative FROM clean
      LEFT JOIN pos USING (word) LEFT JOIN neg USING (word) GROUP BY 1)
    SELECT id, positive, negative, round(positive / nullif(abs(negative), 0), 6) AS ratio, positive - abs(negative) AS diff FROM s""",
)
def agg_ratio_and_diff(spark, sf):
    words = text.clean_words(a.posts(spark, sf), a.STOPWORDS, keep=["id"])
    return rounded(ts.ratio_and_diff(words, positives(spark), negatives(spark), ["id"]), "ratio")


ALIGNED = f"""{a.SENTIMENT}, {a.QUOTES}, al AS (SELECT m.name || '_' || i.name AS series, day, slot,
    CASE m.name WHEN 'ratio' THEN ratio ELSE diff END AS value, CASE i.name WHEN 'sp500' THEN sp500 ELSE nasdaq END AS "index"
    FROM sentiment JOIN quotes USING (slot) CROSS JOIN (VALUES ('ratio'), ('diff')) m(name)
    CROSS JOIN (VALUES ('sp500'), ('nasdaq')) i(name))"""


def aligned(spark, sf):
    size = a.batch_size(spark, sf)
    sentiment = ts.batch_sentiment(a.posts(spark, sf), positives(spark), negatives(spark), size, a.STOPWORDS)
    quotes = ordered.slot_last_quote(a.quotes(spark, sf), "ts", ["sp500", "nasdaq"], ["day"])
    return ts.aligned_series(sentiment, quotes, ["sp500", "nasdaq"])


@query("aligned_series", f'WITH {ALIGNED} SELECT series, {DAY}, slot, round(value, 6) + 0 AS value, "index" FROM al')
def aligned_series(spark, sf):
    return rounded(aligned(spark, sf), "value").withColumn("day", F.col("day").cast("string"))


@query(
    "sort_by_slot",
    f"""WITH {ALIGNED} SELECT {DAY}, slot, round(value, 6) + 0 AS value, "index" FROM al WHERE series = 'diff_nasdaq'
    ORDER BY al.day, slot""",
)
def sort_by_slot(spark, sf):
    series = aligned_series(spark, sf).where(F.col("series") == "diff_nasdaq").drop("series")
    return series.orderBy("day", "slot")


EVENT_SENTIMENT = """es AS (SELECT CAST(ts AS DATE) AS day, slot, sum(CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN 2
    ELSE 0 END)::DOUBLE AS positive, sum(CASE event_type WHEN 'error' THEN -1 ELSE 0 END)::DOUBLE AS negative FROM slots
    WHERE slot < 40 GROUP BY 1, 2)"""


@query(
    "join_on_time_slot",
    f"""WITH {a.QUOTES}, {EVENT_SENTIMENT} SELECT {DAY}, slot, positive, negative, sp500, nasdaq FROM es
    JOIN quotes USING (day, slot)""",
)
def join_on_time_slot(spark, sf):
    words = a.events(spark, sf).select(
        F.to_date("ts").alias("day"), times.slot_index(F.col("ts")).alias("slot"), F.col("event_type").alias("word")
    )
    good, bad = a.rows(spark, a.GOOD_EVENTS, "word, value"), a.rows(spark, a.BAD_EVENTS, "word, value")
    sentiment = ts.ratio_and_diff(words.where(F.col("slot").isNotNull()), good, bad, ["day", "slot"])
    quotes = ordered.slot_last_quote(a.quotes(spark, sf), "ts", ["sp500", "nasdaq"], ["day"])
    joined = sentiment.join(quotes, ["day", "slot"]).withColumn("day", F.col("day").cast("string"))
    return joined.select("day", "slot", "positive", "negative", "sp500", "nasdaq")


# ---- series ---------------------------------------------------------------------------------------

TIME = "strftime(time, '%Y-%m-%d %H') AS time"


def with_text_time(df):
    return df.withColumn("time", F.date_format("time", "yyyy-MM-dd HH"))


@query(
    "lag_matrix",
    f"""WITH {a.HOURLY} SELECT event_type, {TIME}, round(value, 6) AS value, round("index", 6) AS "index",
    {', '.join(f'round(lag({c}, {i}) OVER w, 6) AS "{n}_lag{i}"' for c, n in (('value', 'value'), ('"index"', 'index'))
               for i in range(1, MAXLAG + 1))}
    FROM hourly WINDOW w AS (PARTITION BY event_type ORDER BY hourly.time)""",
)
def lag_matrix(spark, sf):
    series = rounded(a.hourly_series(spark, sf), "value", "index")
    lags = ordered.with_lags(series, ["event_type"], "time", ["value", "index"], MAXLAG)
    return with_text_time(ordered.lag_columns(lags, ["value", "index"], MAXLAG))


@query(
    "min_max_normalize",
    f"""WITH {a.HOURLY} SELECT event_type, {TIME}, round((value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w), 6) AS value,
    round(("index" - min("index") OVER w) / (max("index") OVER w - min("index") OVER w), 6) AS "index"
    FROM hourly WINDOW w AS (PARTITION BY event_type)""",
)
def min_max_normalize(spark, sf):
    scaled = ordered.min_max_scaled(a.hourly_series(spark, sf), ["value", "index"], ["event_type"])
    return with_text_time(rounded(scaled, "value", "index"))


def granger_sql(series: str, by: str, order: str, runs: str = "", digits: int = 6) -> str:
    """Residual sums by eliminating one regressor after the other from the product sums."""
    parts = []
    for lag in range(1, MAXLAG + 1):
        names = ["c"] + [f"y{i}" for i in range(1, lag + 1)] + [f"x{i}" for i in range(1, lag + 1)] + ["y"]
        last = len(names) - 1
        lags = ", ".join(f"lag({c}, {i}) OVER w AS {c}{i}" for c in "yx" for i in range(1, lag + 1))
        ctes = [
            f"l AS (SELECT {by}, 1::DOUBLE AS c, y, {lags} FROM ce WINDOW w AS (PARTITION BY {by}{runs} ORDER BY {order}))",
            "g0 AS (SELECT {}, count(*) AS t, {} FROM l WHERE x{} IS NOT NULL GROUP BY {})".format(
                by,
                ", ".join(
                    f"sum({names[i]} * {names[j]}) AS g_{i}_{j}" for i in range(last + 1) for j in range(i, last + 1)
                ),
                lag,
                by,
            ),
        ]
        for s in range(last):
            rest = ", ".join(
                f"g_{i}_{j} - g_{s}_{i} * g_{s}_{j} / g_{s}_{s} AS g_{i}_{j}"
                for i in range(s + 1, last + 1)
                for j in range(i, last + 1)
            )
            small = f", g_{last}_{last} - g_{s}_{last} * g_{s}_{last} / g_{s}_{s} AS ssr_small" if s == lag else ""
            keep = ", ssr_small" if s > lag else ""
            ctes.append(f"g{s + 1} AS (SELECT {by}, t{keep}{small}, {rest} FROM g{s})")
        parts.append(
            f"""SELECT {by}, {lag} AS lag, t AS observations,
            round((ssr_small - g_{last}_{last}) / {lag} / (g_{last}_{last} / (t - {2 * lag + 1})), {digits}) AS f_stat,
            {lag} AS f_df1, t - {2 * lag + 1} AS f_df2, round(t * (ssr_small - g_{last}_{last}) / g_{last}_{last}, {digits}) AS chi2_stat,
            round(t * ln(ssr_small / g_{last}_{last}), {digits}) AS lr_stat, {lag} AS chi2_df FROM (
              WITH {', '.join(ctes)} SELECT * FROM g{last})"""
        )
    return f"""WITH {series}, ce AS (SELECT *, value - avg(value) OVER (PARTITION BY {by}) AS y,
      "index" - avg("index") OVER (PARTITION BY {by}) AS x FROM se) """ + " UNION ALL ".join(parts)


STATS = ["f_stat", "chi2_stat", "lr_stat"]
SHOWN = ["event_type", "lag", "observations", "f_stat", "f_df1", "f_df2", "chi2_stat", "lr_stat", "chi2_df"]


def hourly_granger(spark, sf):
    return ts.granger_causality(a.hourly_series(spark, sf), MAXLAG, ["event_type"], "time")


@query("granger_causality", granger_sql(f"{a.HOURLY}, se AS (SELECT * FROM hourly)", "event_type", "time"))
def granger_causality(spark, sf):
    return rounded(hourly_granger(spark, sf), *STATS).select(SHOWN)


# Tails by Simpson's rule. With u = 1 - s^2 in the beta integral and t = s^2 in the gamma integral both integrands are smooth.
STEPS = 4000
F_TERM = "2 * pow(s, lag - 1) * exp((f_df2 / 2.0 - 1) * ln(greatest(1 - s * s, 1e-300)) + lgamma((f_df2 + lag) / 2.0) - lgamma(f_df2 / 2.0) - lgamma(lag / 2.0))"
CHI_TERM = "2 * pow(s, lag - 1) * exp(-s * s / 2 - lag / 2.0 * ln(2) - lgamma(lag / 2.0))"
P_VALUES = f"""WITH g AS ({granger_sql(f"{a.HOURLY}, se AS (SELECT * FROM hourly)", "event_type", "time", digits=15)}),
    spans AS (SELECT event_type, lag, f_df2, 'f' AS kind, sqrt(lag * f_stat / (f_df2 + lag * f_stat)) AS low,
        least(1, sqrt(lag * f_stat / (f_df2 + lag * f_stat)) + 24 / sqrt(f_df2)) AS high FROM g
      UNION ALL SELECT event_type, lag, f_df2, 'chi2', sqrt(chi2_stat), sqrt(chi2_stat) + 14 FROM g
      UNION ALL SELECT event_type, lag, f_df2, 'lr', sqrt(lr_stat), sqrt(lr_stat) + 14 FROM g),
    points AS (SELECT *, low + (high - low) * i / {STEPS} AS s, CASE WHEN i IN (0, {STEPS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
      FROM spans CROSS JOIN (SELECT unnest(generate_series(0, {STEPS})) AS i)),
    tails AS (SELECT event_type, lag, kind, any_value(high - low) / {3 * STEPS}.0
      * sum(w * CASE kind WHEN 'f' THEN {F_TERM} ELSE {CHI_TERM} END) AS p FROM points GROUP BY ALL)
    SELECT event_type, lag, {', '.join(f"round(max(p) FILTER (kind = '{k}'), 6) + 0 AS {n}" for k, n in
      (('f', 'f_p'), ('chi2', 'chi2_p'), ('lr', 'lr_p'), ('f', 'params_f_p')))} FROM tails GROUP BY ALL"""


@query("granger_p_values", P_VALUES)
def granger_p_values(spark, sf):
    """The p-values that go with ``granger_causality``."""
    columns = ["f_p", "chi2_p", "lr_p", "params_f_p"]
    return rounded(hourly_granger(spark, sf), *columns).select("event_type", "lag", *columns)


def halves(spark, sf):
    series = a.hourly_series(spark, sf)
    early = F.col("time") < F.lit(a.SPLIT_DAY).cast("timestamp")
    return [series.where(early), series.where(~early)]


POOLED = f"{a.HOURLY}, se AS (SELECT *, time >= DATE '{a.SPLIT_DAY}' AS half FROM hourly)"


@query("granger_pooled", granger_sql(POOLED, "event_type", "half, time"))
def granger_pooled(spark, sf):
    found = ts.granger_pooled(halves(spark, sf), MAXLAG, ["event_type"], "time")
    return rounded(found, *STATS).select(SHOWN)


@query("granger_pooled_by_part", granger_sql(POOLED, "event_type", "time", ", half"))
def granger_pooled_by_part(spark, sf):
    found = ts.granger_pooled(halves(spark, sf), MAXLAG, ["event_type"], "time", partition_by_day=True)
    return rounded(found, *STATS).select(SHOWN)


# ---- streaming ------------------------------------------------------------------------------------


def event_stream(spark, sf):
    """The events table as a file stream with an event time that watermarks accept.

    The path is a pattern because a stream's plain path must be a folder, and a table may be one file.
    """
    schema = a.table(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


BUCKET = "time_bucket(INTERVAL 10 MINUTE, ts)"


@query(
    "stream_track_filter",
    "SELECT event_type AS text FROM events WHERE lower(event_type) LIKE '%view%' OR lower(event_type) LIKE '%err%'",
)
def stream_track_filter(spark, sf):
    found = stream.track_filter(event_stream(spark, sf).withColumnRenamed("event_type", "text"), a.TRACKED)
    return stream.run_available(found, "tracked")


@query(
    "stream_time_buckets",
    f"""SELECT strftime({BUCKET}, '%Y-%m-%d %H:%M') AS bucket, count(*) AS n FROM events GROUP BY {BUCKET}""",
)
def stream_time_buckets(spark, sf):
    done = stream.run_available(stream.time_buckets(event_stream(spark, sf), "ts"), "buckets", ["bucket"])
    return done.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))


@query(
    "stream_last_quote",
    f"WITH {a.QUOTES} SELECT {DAY}, slot, sp500, nasdaq FROM quotes",
)
def stream_last_quote(spark, sf):
    quotes = event_stream(spark, sf).select(
        "ts", F.col("value").alias("sp500"), F.from_json("props", "k long")["k"].cast("double").alias("nasdaq")
    )
    done = stream.run_available(stream.last_quotes(quotes, "ts", ["sp500", "nasdaq"]), "quotes", ["day", "slot"])
    return done.withColumn("day", F.col("day").cast("string"))


@query(
    "stream_sentiment",
    f"""WITH s AS (SELECT {BUCKET} AS b, sum(CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 ELSE 0 END)::DOUBLE AS positive,
    sum(CASE event_type WHEN 'error' THEN -1 ELSE 0 END)::DOUBLE AS negative FROM events GROUP BY 1)
    SELECT strftime(b, '%Y-%m-%d %H:%M') AS bucket, positive, negative, round(positive / nullif(abs(negative), 0), 6) AS ratio,
    positive - abs(negative) AS diff FROM s""",
)
def stream_sentiment(spark, sf):
    posts = event_stream(spark, sf).select("ts", F.col("event_type").alias("text"))
    good, bad = a.rows(spark, a.GOOD_EVENTS, "word, value"), a.rows(spark, a.BAD_EVENTS, "word, value")
    done = stream.run_available(stream.bucket_sentiment(posts, "ts", good, bad), "sentiment", ["bucket"])
    return rounded(done, "ratio").withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))
