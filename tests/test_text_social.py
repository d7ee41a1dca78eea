import pytest
from pyspark.sql import functions as F

from rivulet.functions import text as ft
from rivulet.operators import ordered, relational as rel
from rivulet.plans import social, text
from tests.conftest import as_set


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")


def test_tokens_follow_unicode_whitespace(spark):
    sample = "  a b c\x1cd 　 e\nfé  "
    row = docs(spark, sample, " ", "").select(ft.tokens(F.col("text")).alias("t")).collect()
    assert row[0].t == sample.split()
    assert row[1].t == [] and row[2].t == []


def test_stop_words_are_removed_before_lower_casing(spark):
    d = docs(spark, "The cat and the dog", "THE the")
    kept = text.clean_words(d, ["the", "and"])
    assert sorted(r.word for r in kept.collect()) == ["cat", "dog", "the", "the"]


def test_word_frequency_orders_ties_by_word(spark):
    rows = text.word_frequency(docs(spark, "b a c b a A the"), stopwords=["the"], k=3).collect()
    assert [(r.word, r.n) for r in rows] == [("a", 2), ("b", 2), ("A", 1)]


def test_lexical_diversity_and_no_words(spark):
    row = text.lexical_diversity(docs(spark, "a a b the the"), stopwords=["the"]).first()
    assert (row.total, row.distinct, row.clean_total, row.clean_distinct) == (5, 3, 3, 2)
    assert row.diversity == pytest.approx(0.6) and row.clean_diversity == pytest.approx(2 / 3)
    empty = text.lexical_diversity(docs(spark, " ")).first()
    assert (empty.total, empty.distinct, empty.diversity) == (0, 0, None)


def test_duplicate_lexicon_words_multiply(spark):
    lexicon = spark.createDataFrame(
        [("good", "positive"), ("good", "positive"), ("bad", "negative"), ("so", "both")], "word string, polarity string"
    )
    row = text.sentiment_verdict(docs(spark, "good bad so other"), lexicon).first()
    assert (row.positive, row.negative, row.neutral, row.total, row.sum_value) == (2, 1, 2, 5, 1)
    assert row.verdict == "Positive"
    joined = rel.label_words(text.words(docs(spark, "good other")), lexicon)
    assert sorted((r.word, r.polarity) for r in joined.collect() if r.polarity) == [("good", "positive")] * 2
    assert joined.count() == 3


def test_sentiment_of_no_words_is_neutral(spark):
    lexicon = spark.createDataFrame([("good", "positive")], "word string, polarity string")
    row = text.sentiment_verdict(docs(spark, ""), lexicon).first()
    assert (row.total, row.sum_value, row.verdict) == (0, 0, "Neutral")


def test_stop_table_and_stop_list_agree(spark):
    words = text.words(docs(spark, "a b c a"))
    table = spark.createDataFrame([("a",)], "word string")
    assert as_set(rel.drop_stopwords(words, table), "word") == as_set(rel.drop_stopwords(words, ["a"]), "word") == {
        ("b",), ("c",)
    }


def test_query_map(spark):
    urls = ["http://h/p?a=1&b=x%20y#frag", "http://h/p", "http://h/?a=1&a=2&c", "http://h/?q=a+b%3D", "http://h/?z=%zz"]
    d = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r.m for r in d.select(ft.query_map(F.col("url")).alias("m")).collect()]
    assert got == [{"a": "1", "b": "x y"}, {}, {"a": "2", "c": ""}, {"q": "a+b="}, {"z": "%zz"}]


def posts(spark):
    schema = "id long, text string, retweet_count long, retweeted_status struct<user: struct<screen_name: string>>"
    rows = [
        (1, "a", 9, (("u1",),)), (2, "b", 9, (("u2",),)), (3, "c", 9, (("u2",),)), (4, "z", 50, None),
        (5, "d", 7, (("u1",),)), (6, "e", 7, (("u1",),)), (7, "f", 3, (("u9",),)), (8, "g", 3, (("u8",),)),
        (9, "h", 1, (("u1",),)), (10, "h", 1, (("u1",),)), (11, "h", 1, (("u0",),)), (12, "i", 9, (("u1",),)),
    ]
    return spark.createDataFrame(rows, schema)


def test_popular_posts_keep_one_per_count(spark):
    rows = social.popular_posts(posts(spark), 3).collect()
    assert [(r.retweet_count, r.screen_name, r.text, r.id) for r in rows] == [
        (9, "u2", "c", 3), (7, "u1", "e", 6), (3, "u9", "f", 7)
    ]


def test_mutual_connections_repeat_per_match(spark):
    friends = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, screen_name string")
    followers = spark.createDataFrame([(2, "b"), (2, "b"), (3, "c"), (9, "z")], "id long, screen_name string")
    twice = social.mutual_connections(friends, followers).collect()
    assert [(r.id, r.screen_name) for r in twice] == [(3, "c"), (2, "b"), (2, "b")]
    assert social.mutual_connections(friends, followers, multiset=False).count() == 2


def test_profile_lookup_wants_one_kind_of_key(spark):
    profiles = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, screen_name string, bio string")
    names = spark.createDataFrame([("b",), ("b",)], "screen_name string")
    assert [tuple(r) for r in rel.profile_lookup(profiles, screen_names=names, items_only=True).collect()] == [(2, "b")]
    for wrong in ({}, {"screen_names": names, "ids": profiles}):
        with pytest.raises(ValueError):
            rel.profile_lookup(profiles, **wrong)


def test_entities_and_collected_lists(spark):
    rows = [("hot", str(i), i) for i in range(250)] + [("cold", "x", 1), ("cold", "x", 2)]
    d = spark.createDataFrame(rows, "id string, name string, n long")
    lists = ordered.collect_lists(d, "id", ["name", "n"], most=40)
    by_key = {}
    for r in lists.collect():
        by_key.setdefault(r.id, []).append(r["items"])
    assert len(by_key["cold"]) == 1 and len(by_key["hot"]) == 7
    assert max(len(items) for items in by_key["hot"]) == 40
    assert sorted(i.n for items in by_key["hot"] for i in items) == list(range(250))
    top = social.popular_entities(lists, "items", "name", 1).first()
    assert (top.entity, top.n) == ("x", 2)


def test_lookup_default_and_nth(spark):
    table = spark.createDataFrame([(1, 10, 4.0)], "user_id long, business_id long, stars double")
    asked = spark.createDataFrame([(1, 10), (1, 11)], "user_id long, business_id long")
    got = rel.lookup_or_default(asked, table, ["user_id", "business_id"], "stars", 0.0)
    assert as_set(got, "business_id", "stars") == {(10, 4.0), (11, 0.0)}
    d = spark.createDataFrame([(c,) for c in "aaabbccd"], "k string")
    assert [rel.nth_by_count(d, "k", n).first().k for n in (1, 2, 3, 4)] == ["a", "b", "c", "d"]
    assert rel.nth_by_count(d, "k", 5).count() == 0
