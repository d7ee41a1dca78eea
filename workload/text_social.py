"""Text and social queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from rivulet.functions import text as ft
from rivulet.operators import ordered, relational as rel
from rivulet.plans import social, text
from workload import adapters as a
from workload.registry import query

TOKENS = a.WORDS + ", tok AS (SELECT * FROM words WHERE word <> '')"
KEPT = f"{TOKENS}, kept AS (SELECT * FROM tok WHERE word NOT IN {a.STOP_SQL})"
LEXICON = f"lex AS (SELECT * FROM {a.values_sql(a.POLARITIES, 'word, polarity')})"


def lexicon(spark):
    return a.rows(spark, a.POLARITIES, "word, polarity")


@query(
    "word_frequency",
    f"WITH {KEPT} SELECT word, count(*) AS n FROM kept GROUP BY word ORDER BY n DESC, word LIMIT 30",
)
def word_frequency(spark, sf):
    return text.word_frequency(a.posts(spark, sf), stopwords=a.STOPWORDS, k=30)


@query(
    "lexical_diversity",
    f"""WITH {KEPT}, r AS (SELECT count(*) AS total, count(DISTINCT word) AS "distinct" FROM tok),
    c AS (SELECT count(*) AS clean_total, count(DISTINCT word) AS clean_distinct FROM kept)
    SELECT *, round("distinct" / total, 9) AS diversity, round(clean_distinct / clean_total, 9) AS clean_diversity
    FROM r CROSS JOIN c""",
)
def lexical_diversity(spark, sf):
    d = text.lexical_diversity(a.posts(spark, sf), stopwords=a.STOPWORDS)
    return d.withColumns({c: F.round(c, 9) for c in ("diversity", "clean_diversity")})


@query(
    "agg_lexical_diversity",
    f"""WITH {TOKENS}, d AS (SELECT source, tok.* FROM tok JOIN documents USING (doc_id))
    SELECT source, round(count(DISTINCT word) / count(*), 9) AS diversity FROM d GROUP BY source""",
)
def agg_lexical_diversity(spark, sf):
    docs = a.documents(spark, sf)
    # Counted per word first: a source's distinct words are then plain rows of an even shuffle.
    counts = rel.count_per_key(text.words(docs, keep=["source"]), "source", "word")
    return counts.groupBy("source").agg(F.round(F.count(F.lit(1)) / F.sum("n"), 9).alias("diversity"))


SUMMARY = """sum(CASE WHEN value = 1 THEN n ELSE 0 END)::BIGINT AS positive,
    sum(CASE WHEN value = -1 THEN n ELSE 0 END)::BIGINT AS negative,
    sum(CASE WHEN value = 0 THEN n ELSE 0 END)::BIGINT AS neutral, sum(n)::BIGINT AS total, sum(value * n)::BIGINT AS sum_value"""
LABELLED = f"""{a.CLEAN}, {LEXICON}, labelled AS (SELECT 1 AS n,
    CASE polarity WHEN 'negative' THEN -1 WHEN 'positive' THEN 1 ELSE 0 END AS value FROM clean LEFT JOIN lex USING (word))"""


@query(
    "sentiment_verdict",
    f"""WITH {LABELLED}, s AS (SELECT {SUMMARY} FROM labelled) SELECT *, CASE WHEN sum_value > 0 THEN 'Positive'
    WHEN sum_value < 0 THEN 'Negative' ELSE 'Neutral' END AS verdict FROM s""",
)
def sentiment_verdict(spark, sf):
    return text.sentiment_verdict(a.posts(spark, sf), lexicon(spark), a.STOPWORDS)


@query("agg_conditional_counts", f"WITH {LABELLED} SELECT {SUMMARY} FROM labelled")
def agg_conditional_counts(spark, sf):
    counted = rel.count_per_key(text.clean_words(a.posts(spark, sf), a.STOPWORDS), "word")
    return rel.polarity_counts(rel.label_words(counted, lexicon(spark)))


@query(
    "join_lexicon_right",
    f"""WITH {a.CLEAN}, {LEXICON} SELECT doc_id AS id, word, polarity, count(*) AS n
    FROM clean LEFT JOIN lex USING (word) GROUP BY ALL""",
)
def join_lexicon_right(spark, sf):
    words = text.clean_words(a.posts(spark, sf), a.STOPWORDS, keep=["id"])
    return rel.count_per_key(rel.label_words(words, lexicon(spark)), "id", "word", "polarity")


@query("fn_tokenize", f"WITH {TOKENS} SELECT doc_id AS id, word, count(*) AS n FROM tok GROUP BY ALL")
def fn_tokenize(spark, sf):
    return rel.count_per_key(text.words(a.posts(spark, sf), keep=["id"]), "id", "word")


@query("fn_lower", f"WITH {TOKENS} SELECT lower(word) AS word, count(*) AS n FROM tok GROUP BY ALL")
def fn_lower(spark, sf):
    return rel.count_per_key(text.words(a.posts(spark, sf)).select(F.lower("word").alias("word")), "word")


@query(
    "filter_stopwords",
    f"WITH {KEPT} SELECT doc_id AS id, count(*) AS n FROM kept GROUP BY ALL",
)
def filter_stopwords(spark, sf):
    listed = a.rows(spark, [(w, 1) for w in a.STOPWORDS], "word, listed")
    return rel.count_per_key(rel.drop_stopwords(text.words(a.posts(spark, sf), keep=["id"]), listed), "id")


@query("agg_count", f"WITH {TOKENS} SELECT count(*) AS n FROM tok")
def agg_count(spark, sf):
    return text.words(a.posts(spark, sf)).agg(F.count(F.lit(1)).alias("n"))


@query("agg_count_distinct", f"WITH {TOKENS} SELECT count(DISTINCT word) AS n FROM tok")
def agg_count_distinct(spark, sf):
    return text.words(a.posts(spark, sf)).agg(F.countDistinct("word").alias("n"))


@query("agg_frequency", f"WITH {TOKENS} SELECT word, count(*) AS n FROM tok GROUP BY word")
def agg_frequency(spark, sf):
    return rel.count_per_key(text.words(a.posts(spark, sf)), "word")


@query("distinct_set", f"WITH {TOKENS} SELECT DISTINCT word FROM tok")
def distinct_set(spark, sf):
    return text.words(a.posts(spark, sf)).distinct()


@query("topk_words", f"WITH {TOKENS} SELECT word, count(*) AS n FROM tok GROUP BY word ORDER BY n DESC, word LIMIT 30")
def topk_words(spark, sf):
    return rel.top_counts(text.words(a.posts(spark, sf)), "word", 30)


@query(
    "fn_polarity_case",
    f"""WITH {a.CLEAN}, {LEXICON} SELECT word, CASE polarity WHEN 'negative' THEN -1 WHEN 'positive' THEN 1 ELSE 0 END AS value,
    count(*) AS n FROM clean LEFT JOIN lex USING (word) GROUP BY ALL""",
)
def fn_polarity_case(spark, sf):
    labelled = rel.label_words(text.clean_words(a.posts(spark, sf), a.STOPWORDS), lexicon(spark))
    return rel.count_per_key(labelled.select("word", ft.polarity_value(F.col("polarity")).alias("value")), "word", "value")


@query(
    "udf_row_value",
    f"""WITH {a.CLEAN}, {LEXICON} SELECT doc_id AS id,
    sum(CASE polarity WHEN 'negative' THEN -1 WHEN 'positive' THEN 1 ELSE 0 END)::BIGINT AS sum_value
    FROM clean LEFT JOIN lex USING (word) GROUP BY doc_id""",
)
def udf_row_value(spark, sf):
    """A Python function of the caller's on each distinct word's polarity, over whole Arrow batches."""

    @F.pandas_udf("long")
    def value(polarity: pd.Series) -> pd.Series:
        return polarity.map({"positive": 1, "negative": -1}).fillna(0).astype("int64")

    words = rel.count_per_key(text.clean_words(a.posts(spark, sf), a.STOPWORDS, keep=["id"]), "id", "word")
    labelled = rel.label_words(words, lexicon(spark)).withColumn("value", value("polarity"))
    return labelled.groupBy("id").agg(F.sum(F.col("value") * F.col("n")).alias("sum_value"))


@query(
    "fn_sign_label",
    f"""WITH {a.CLEAN}, {LEXICON}, s AS (SELECT doc_id AS id,
    sum(CASE polarity WHEN 'negative' THEN -1 WHEN 'positive' THEN 1 ELSE 0 END) AS v FROM clean LEFT JOIN lex USING (word)
    GROUP BY doc_id) SELECT id, CASE WHEN v > 0 THEN 'Positive' WHEN v < 0 THEN 'Negative' ELSE 'Neutral' END AS verdict FROM s""",
)
def fn_sign_label(spark, sf):
    return udf_row_value(spark, sf).select("id", ft.sign_label(F.col("sum_value")).alias("verdict"))


# ---- social -------------------------------------------------------------------------------------


@query(
    "popular_posts",
    f"""WITH {a.RETWEETS} SELECT retweet_count, screen_name, text, id FROM (SELECT *, row_number() OVER (PARTITION BY retweet_count
    ORDER BY screen_name DESC, text DESC, id DESC) AS rn FROM rt) WHERE rn = 1 ORDER BY retweet_count DESC LIMIT 10""",
)
def popular_posts(spark, sf):
    return social.popular_posts(a.retweets(spark, sf))


@query(
    "top_distinct_counts",
    f"""WITH {a.RETWEETS} SELECT retweet_count, max(screen_name) AS screen_name, count(*) AS n FROM rt GROUP BY retweet_count
    ORDER BY retweet_count DESC LIMIT 10""",
)
def top_distinct_counts(spark, sf):
    found = social.reposts(a.retweets(spark, sf)).groupBy("retweet_count")
    rows = found.agg(F.max("screen_name").alias("screen_name"), F.count(F.lit(1)).alias("n"))
    return rows.orderBy(F.desc("retweet_count")).limit(10)


@query("project_nested", f"WITH {a.RETWEETS} SELECT retweet_count, screen_name, text, id FROM rt")
def project_nested(spark, sf):
    return social.reposts(a.retweets(spark, sf))


@query("filter_exists", f"WITH {a.RETWEETS} SELECT id, retweet_count FROM rt")
def filter_exists(spark, sf):
    return a.retweets(spark, sf).where(F.col("retweeted_status").isNotNull()).select("id", "retweet_count")


@query(
    "popular_entities",
    """(SELECT 'screen_name' AS kind, CAST(l_suppkey AS VARCHAR) AS entity, count(*) AS n FROM lineitem GROUP BY 1, 2
    ORDER BY n DESC, entity LIMIT 10) UNION ALL
    (SELECT 'text', l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2 ORDER BY n DESC, 2 LIMIT 10)""",
)
def popular_entities(spark, sf):
    return social.popular_by_kind(a.entity_posts(spark, sf), "entities", ["screen_name", "text"])


@query(
    "topk_entities",
    "SELECT CAST(l_suppkey AS VARCHAR) AS entity, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, entity LIMIT 10",
)
def topk_entities(spark, sf):
    return social.popular_entities(a.entity_posts(spark, sf), "entities", "screen_name", 10)


@query(
    "agg_collect_by_key",
    """SELECT id, CAST((rn - 1) // 3 AS INTEGER) AS part, count(*) AS n, string_agg(name, ',' ORDER BY rn) AS items FROM (
      SELECT l_orderkey AS id, CAST(l_suppkey AS VARCHAR) AS name, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY CAST(l_suppkey AS VARCHAR), l_returnflag, l_linenumber) AS rn FROM lineitem) GROUP BY 1, 2""",
)
def agg_collect_by_key(spark, sf):
    """Lists of at most three items, numbered by place."""
    lists = ordered.collect_lists(a.entity_lines(spark, sf), "id", a.ENTITY, most=3)
    names = F.transform("items", lambda e: e["screen_name"])
    return lists.select("id", "part", F.size("items").cast("long").alias("n"), F.concat_ws(",", names).alias("items"))


@query(
    "fn_array_access",
    """SELECT l_orderkey AS id, min(CAST(l_suppkey AS VARCHAR)) AS first_name, count(*) AS n FROM lineitem GROUP BY 1""",
)
def fn_array_access(spark, sf):
    return a.entity_posts(spark, sf).select(
        "id", F.get("entities", F.lit(0))["screen_name"].alias("first_name"), F.size("entities").cast("long").alias("n")
    )


@query(
    "mutual_connections",
    f"""WITH {a.CONTACTS} SELECT fr.id, fr.screen_name FROM fr JOIN fo ON fr.id = fo.id
    ORDER BY fr.id DESC, fr.screen_name DESC LIMIT 10""",
)
def mutual_connections(spark, sf):
    return social.mutual_connections(a.friends(spark, sf), a.followers(spark, sf))


@query("join_mutual", f"WITH {a.CONTACTS} SELECT fr.id, fr.screen_name FROM fr JOIN fo ON fr.id = fo.id")
def join_mutual(spark, sf):
    return rel.mutual(a.friends(spark, sf), a.followers(spark, sf), "id")


@query("intersect_by_key", f"WITH {a.CONTACTS} SELECT id FROM fr INTERSECT SELECT id FROM fo")
def intersect_by_key(spark, sf):
    return a.friends(spark, sf).select("id").intersect(a.followers(spark, sf).select("id"))


@query(
    "sort_tuple_desc_limit",
    f"WITH {a.CONTACTS} SELECT id, screen_name FROM fr ORDER BY id DESC, screen_name DESC LIMIT 20",
)
def sort_tuple_desc_limit(spark, sf):
    return a.friends(spark, sf).orderBy(F.desc("id"), F.desc("screen_name")).limit(20)


@query(
    "join_profile_lookup",
    f"""WITH {a.CONTACTS} SELECT c_custkey AS id, c_name AS screen_name FROM customer WHERE c_custkey IN (SELECT id FROM fo)""",
)
def join_profile_lookup(spark, sf):
    profiles = a.table(spark, sf, "customer").withColumnsRenamed({"c_custkey": "id", "c_name": "screen_name"})
    return rel.profile_lookup(profiles, ids=a.followers(spark, sf), items_only=True)


@query(
    "fn_query_string_map",
    """WITH q AS (SELECT page_id, unnest(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&')) AS p FROM pages
    WHERE url LIKE '%?%') SELECT page_id, split_part(p, '=', 1) AS name, split_part(p, '=', 2) AS value FROM q WHERE p <> ''""",
)
def fn_query_string_map(spark, sf):
    pages = a.table(spark, sf, "pages")
    return pages.select("page_id", F.explode(ft.query_map(F.col("url"))).alias("name", "value"))


@query(
    "fn_json_fields",
    "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events",
)
def fn_json_fields(spark, sf):
    return a.table(spark, sf, "events").select("event_id", ft.json_value(F.col("props"), "k long")["k"].alias("k"))
