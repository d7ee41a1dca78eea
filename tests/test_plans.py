"""What the physical plans must and must not contain."""

import pytest

from tests.test_oracle import SF

QUIET = """word_frequency lexical_diversity sentiment_verdict popular_posts popular_entities mutual_connections flatten_movement
distance_and_speed distance_to_focus distance_in_play density_kde similarity_to_user nearest_neighbors evaluate_k_sweep
recommend_businesses user_similarity batch_sentiment aligned_series granger_causality""".split()


def plan(spark, name):
    from __spark_entry__ import queries

    df = queries()["user_similarity_one" if name == "similarity_to_user" else name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUIET)
def test_no_join_pairs_everything(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["word_frequency", "topk_words", "topk_entities", "popular_posts", "efficiency_leaderboard"])
def test_top_k_needs_no_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


@pytest.mark.parametrize("name", ["join_lexicon_right", "join_dimension_map", "flatten_movement"])
def test_small_sides_are_broadcast_by_their_size(spark, name):
    text = plan(spark, name)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_scans_read_only_what_is_used(spark):
    text = plan(spark, "agg_multi_mean")
    assert "l_shipdate" not in text and "l_orderkey" not in text
    assert "c_mktsegment" not in plan(spark, "active_users")
    assert "PushedFilters: [IsNotNull(o_orderpriority)" in plan(spark, "join_mutual")


def test_counts_are_formed_before_the_shuffle(spark):
    text = plan(spark, "agg_frequency")
    assert text.count("HashAggregate") == 2 and text.count("Exchange hashpartitioning") == 1


def test_fixed_width_firsts_aggregate_by_hash(spark):
    assert "SortAggregate" not in plan(spark, "slot_last_quote")


def test_pairs_of_a_play_come_from_one_pass(spark):
    text = plan(spark, "distance_in_play")
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
