import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.operators.correlation import correlation_matrix, correlation_with
from rivulet.operators.similarity_join import top_correlations
from rivulet.plans import recommend as rec
from tests.conftest import as_set

RATING = "user_id long, business_id long, stars double"


def random_ratings(users=23, businesses=40, seed=3, hot=0):
    rng = np.random.default_rng(seed)
    rated = rng.random((users, businesses)) < 0.2
    rated[:, hot] = True  # one business everybody rated
    rated[5] = False
    rated[5, 7] = True
    stars = rng.integers(1, 6, (users, businesses)).astype(float)
    return [(u, b, float(stars[u, b])) for u in range(users) for b in range(businesses) if rated[u, b]]


def filled(rows, fill=0.1):
    users, businesses = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    m = np.full((len(users), len(businesses)), fill)
    for u, b, s in rows:
        m[users.index(u), businesses.index(b)] = s
    return users, m


@pytest.mark.parametrize("block, cells", [(1024, 500_000), (5, 500_000), (5, 40), (100, 30)])
def test_matrix_equals_numpy_for_any_blocks(spark, block, cells):
    rows = random_ratings()
    users, m = filled(rows)
    want = np.corrcoef(m)
    profiles = spark.createDataFrame(rows, RATING).selectExpr("user_id id", "business_id key", "stars - 0.1D value")
    got = correlation_matrix(profiles, block, cells).collect()
    assert len(got) == len(users) ** 2
    for r in got:
        assert r["corr"] == pytest.approx(want[users.index(r.id), users.index(r.neighbor_id)], abs=1e-12)
    one = correlation_with(profiles, 4).collect()
    assert len(one) == len(users)
    for r in one:
        assert r["corr"] == pytest.approx(want[4, users.index(r.neighbor_id)], abs=1e-12)


def test_light_and_heavy_keys_with_text_ids(spark):
    rng = np.random.default_rng(5)
    rows = [(f"u{u:02d}", f"w{k}", float(rng.integers(1, 9))) for u in range(60) for k in range(900) if k % 60 == u or k < 3]
    users, m = filled(rows, 0.0)
    profiles = spark.createDataFrame(rows, "id string, key string, value double")
    got = {(r.id, r.neighbor_id): r["corr"] for r in correlation_matrix(profiles, 16, 400).collect()}
    want = np.corrcoef(m)
    assert len(got) == 3600
    assert max(abs(got[a, b] - want[i, j]) for i, a in enumerate(users) for j, b in enumerate(users)) < 1e-12


@pytest.mark.parametrize("stars", [(1e8, 1e8 + 1, 1e8), (3.9, 3.9000000000000004, 3.9), (float("nan"), 1.0, 2.0)])
def test_nearly_constant_profiles_stop_nothing(spark, stars):
    rows = [(1, b, s) for b, s in enumerate(stars)] + [(2, 0, 1.0), (2, 1, 5.0), (3, 0, 2.0), (3, 1, 4.0), (3, 2, 1.0)]
    d = spark.createDataFrame(rows, "user_id long, business_id long, stars double")
    for sim in (rec.similarity_to_user(d, 2), rec.user_similarity(d), rec.similarity_to_user(d, 1)):
        found = {(r.user_id, r.neighbor_id): r["corr"] for r in sim.collect()}
        assert all(c is None or -1.0001 < c < 1.0001 for c in found.values())
        assert all(c is None for pair, c in found.items() if 1 in pair)
    near = rec.nearest_neighbors(rec.similarity_to_user(d, 2), 2, 5).collect()
    assert [r.neighbor_id for r in near] == [3]



@pytest.mark.parametrize("cells", [500_000, 3])
def test_constant_profiles_have_no_correlation(spark, cells):
    rows = [(1, 1, 3.0), (1, 2, 3.0), (2, 1, 4.0), (2, 2, 1.0), (3, 2, 5.0)]  # user 1 gave 3 everywhere
    d = spark.createDataFrame(rows, RATING)
    got = {(r.user_id, r.neighbor_id): r["corr"] for r in rec.user_similarity(d).collect()}
    assert len(got) == 9
    assert all((v is None) == (1 in k) for k, v in got.items())
    assert got[2, 3] == pytest.approx(-1.0) and got[2, 2] == pytest.approx(1.0)
    assert {r["corr"] for r in rec.similarity_to_user(d, 1).collect()} == {None}
    near = rec.nearest_neighbors(rec.similarity_to_user(d, 2), 2, 5).collect()
    assert [r.neighbor_id for r in near] == [3]


def test_users_without_shared_business_still_correlate(spark):
    rows = [(1, 1, 5.0), (2, 2, 5.0), (3, 3, 1.0), (3, 1, 2.0)]
    users, m = filled(rows)
    got = {r.neighbor_id: r["corr"] for r in rec.similarity_to_user(spark.createDataFrame(rows, RATING), 1).collect()}
    assert got[2] == pytest.approx(np.corrcoef(m)[0, 1])


def test_neighbours_break_ties_by_id_and_skip_self(spark):
    rows = [(1, n, c) for n, c in ((1, 1.0), (2, 0.5), (3, 1.0), (4, None), (5, 0.5), (6, -0.2))]
    rows += [(2, n, c) for n, c in ((1, 0.5), (2, 1.0))]
    sim = spark.createDataFrame(rows, "user_id long, neighbor_id long, corr double")
    one = [(r.neighbor_id, r["rank"]) for r in rec.nearest_neighbors(sim, 1, 3).orderBy("rank").collect()]
    assert one == [(3, 1), (2, 2), (5, 3)]
    every = as_set(rec.nearest_neighbors(sim, None, 3), "user_id", "neighbor_id", "rank")
    assert every == {(1, 3, 1), (1, 2, 2), (1, 5, 3), (2, 1, 1)}
    assert as_set(rec.threshold_neighbors(sim, 1, 0.4), "neighbor_id") == {(2,), (3,), (5,)}


def test_best_of_all_equal_the_best_of_the_matrix(spark):
    rows = random_ratings(seed=6)
    rows += [(u + 100, b, s) for u, b, s in rows if u in (2, 9)]  # twins, so that correlations tie
    ratings = spark.createDataFrame(rows, RATING)
    columns = ("user_id", "neighbor_id", "rank")
    for k in (3, 40):
        got = rec.neighbors_of_all(ratings, k)
        assert as_set(got, *columns) == as_set(rec.nearest_neighbors(rec.user_similarity(ratings), None, k), *columns)
        assert got.count() == min(k, 24) * 25


def best_by_numpy(rows, k):
    """(id, neighbor_id, corr in 9 digits) of the k best others, ties by id; null ids first."""
    ids, keys = ([*{r[i]: None for r in rows}] for i in (0, 1))
    m = np.zeros((len(ids), len(keys)))
    for i, key, v in rows:
        m[ids.index(i), keys.index(key)] = v
    constant = (m == m[:, :1]).all(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = np.round(np.corrcoef(m), 9) + 0.0
    out = set()
    for u, i in enumerate(ids):
        others = [v for v in range(len(ids)) if v != u and not constant[v] and not constant[u]]
        others.sort(key=lambda v: (-corr[u, v], ids[v] is not None, ids[v] if ids[v] is not None else 0))
        out |= {(i, ids[v], corr[u, v]) for v in others[:k]}
    return out


def zipf_profiles(ids=90, seed=4):
    """Words by rank: a few that nearly all use, many that few use; some profiles share nothing, some are equal, some have equal offsets."""
    rng = np.random.default_rng(seed)
    rows = {}
    for i in range(ids):
        for w in set(np.minimum(rng.zipf(1.4, 40), 400)):
            rows[i, f"w{w}"] = float(rng.integers(1, 9))
    rows |= {(i, f"own{i}"): 1.0 for i in range(ids, ids + 12)}
    rows |= {(ids + 20, w): v for (i, w), v in rows.items() if i == 3} | {(ids + 21, w): v for (i, w), v in rows.items() if i == 3}
    return [(i, w, v) for (i, w), v in rows.items()]


@pytest.mark.parametrize(
    "k, prune, cells", [(1, True, 300), (10, True, 300), (200, True, 300), (10, True, 10**6), (10, False, 300), (3, None, 60), (3, None, 5)]
)
def test_top_correlations_equal_numpy(spark, k, prune, cells):
    rows = zipf_profiles()
    # many partitions, so that key numbers are far apart
    got = top_correlations(spark.createDataFrame(rows, "id long, key string, value double").repartition(7), k, cells, prune, 0).selectExpr("id", "neighbor_id", "round(corr, 9) + 0 corr")
    assert as_set(got, "id", "neighbor_id", "corr") == best_by_numpy(rows, k)


def test_top_correlations_of_signed_values_and_of_nothing(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(b), float(rng.normal())) for i in range(40) for b in rng.choice(60, 8, replace=False)]
    kind = "id long, key long, value double"
    got = top_correlations(spark.createDataFrame(rows, kind), 4, 50, True, 0).selectExpr("id", "neighbor_id", "round(corr, 9) + 0 corr")
    assert as_set(got, "id", "neighbor_id", "corr") == best_by_numpy(rows, 4)
    assert top_correlations(spark.createDataFrame([], kind), 4).count() == top_correlations(spark.createDataFrame([], kind), 4, few=-1).count() == 0
    few = top_correlations(spark.createDataFrame(rows, kind), 4).selectExpr("id", "neighbor_id", "round(corr, 9) + 0 corr")
    assert as_set(few, "id", "neighbor_id", "corr") == as_set(got, "id", "neighbor_id", "corr")
    assert top_correlations(spark.createDataFrame(rows[:8], kind), 4).count() == 0


def test_search_keeps_profiles_apart(spark):
    from rivulet.operators import similarity_join as sj

    # many small groups with their own keys and two keys that everybody has
    rng = np.random.default_rng(2)
    rows = [(i, f"g{i // 6}-{k}", float(rng.integers(3, 9))) for i in range(240) for k in range(5)]
    rows += [(i, f"all{k}", float(rng.integers(1, 3))) for i in range(240) for k in range(2)]
    sent = []
    plain = sj._candidates

    def counted(whole, k, *rest):
        found = plain(whole, k, *rest)
        sent.append(found.count() / (whole.count() * found.select("block").distinct().count()))
        return found

    sj._candidates, profiles = counted, spark.createDataFrame(rows, "id long, key string, value double")
    try:
        got = top_correlations(profiles, 3, 60, True, 0).selectExpr("id", "neighbor_id", "round(corr, 9) + 0 corr")
        assert as_set(got, "id", "neighbor_id", "corr") == best_by_numpy(rows, 3)
    finally:
        sj._candidates = plain
    assert sent[0] < 0.3


def null_profiles():
    rng = np.random.default_rng(9)
    rows = [(u, b, float(rng.integers(1, 6)) - 0.1) for u in [None, *range(1, 9)] for b in [None, *range(1, 13)] if rng.random() < 0.5]
    return rows + [(20, None, 4.9)]


def test_null_ids_and_keys_are_like_any_other(spark):
    rows = null_profiles()
    profiles = spark.createDataFrame(rows, "id long, key long, value double")
    want = best_by_numpy(rows, 100)
    for block, cells in ((1024, 10**6), (3, 10**6), (3, 8)):
        whole = correlation_matrix(profiles, block, cells).selectExpr("id", "neighbor_id", "round(corr, 9) + 0 corr").collect()
        assert len(whole) == 100
        assert {tuple(r) for r in whole if r["id"] != r["neighbor_id"]} == want
        assert all(r["corr"] == 1.0 for r in whole if r["id"] == r["neighbor_id"])
    for prune in (True, False):
        got = top_correlations(profiles, 4, 20, prune, 0).selectExpr("id", "neighbor_id", "round(corr, 9) + 0 corr")
        assert as_set(got, "id", "neighbor_id", "corr") == best_by_numpy(rows, 4)
    for target in (None, 3):
        one = correlation_with(profiles, target).selectExpr("id", "neighbor_id", "round(corr, 9) + 0 corr").collect()
        assert {tuple(r) for r in one if r["neighbor_id"] != target} == {p for p in want if p[0] == target}


def test_reviews_without_user_or_business(spark):
    rows = [(u, b, v + 0.1) for u, b, v in null_profiles()]
    ratings = spark.createDataFrame(rows, RATING)
    near = rec.neighbors_of_all(ratings, 3).collect()
    assert {r.user_id for r in near} == {r[0] for r in rows}
    assert all(abs(r["corr"]) <= 1 + 1e-9 for r in near)
    texts = spark.createDataFrame([(None, "a a b"), (2, "a b b c"), (3, "c d"), (1, None)], "user_id long, text string")
    assert {r.user_id for r in rec.lexical_user_similarity(texts, best=2).collect()} == {None, 2, 3}


def brute_force(rows, user, business, near, mean, std):
    by = {(u, b): s for u, b, s in rows}
    delta = weight = 0.0
    for n, c in near:
        if (n, business) in by and std[n] > 0:
            delta += (by[n, business] - mean[n]) * c / std[n]
            weight += c
    if delta == 0 or weight == 0:
        return mean[user]
    return mean[user] + std[user] * delta / weight


def test_predictions_sweep_and_recommendations(spark):
    rows = random_ratings(seed=11)
    rows += [(90, b, 2.0) for b in range(12)]  # stars that never vary
    d = spark.createDataFrame(rows, RATING)
    stats = rec.user_stats(d)
    mean = {r.user_id: r["mean"] for r in stats.collect()}
    std = {u: float(np.std([s for v, _, s in rows if v == u])) for u in mean}
    assert std[90] == 0.0
    sim = rec.similarity_to_user(d, 3)
    ranked = sorted(((-r["corr"], r.neighbor_id) for r in sim.collect() if r.neighbor_id != 3))
    near = [(n, -c) for c, n in ranked]

    own = [r for r in rows if r[0] == 3]
    for k in (2, 6, 20):
        want = {b: brute_force(rows, 3, b, near[:k], mean, std) for _, b, _ in own}
        requests = spark.createDataFrame(own, RATING)
        got = rec.predict_rating(requests, rec.nearest_neighbors(sim, 3, k), d, stats)
        assert {r.business_id: r.predicted for r in got.collect()} == pytest.approx(want)
    sweep = rec.sweep_predictions(d, stats, sim, 3, [2, 6, 20]).collect()
    assert len(sweep) == 3 * len(own)
    for r in sweep:
        assert r.predicted == pytest.approx(brute_force(rows, 3, r.business_id, near[: r.k], mean, std))
    gaps = [r.predicted - r.stars for r in sweep if r.k == 6]
    truth = [r.stars for r in sweep if r.k == 6]
    row = rec.evaluate_k_sweep(d, stats, sim, 3, [2, 6]).where("k = 6").first()
    assert row.rmse == pytest.approx(np.sqrt(np.mean(np.square(gaps))))
    assert row.mae == pytest.approx(np.mean(np.abs(gaps)))
    assert row.accuracy == pytest.approx(1 - np.mean(np.abs(gaps) / np.array(truth)))

    business = spark.range(45).select(F.col("id").alias("business_id"), F.lit("n").alias("name"))
    done = rec.recommend_businesses(d, stats, sim, business, 3, 6).collect()
    assert len(done) == 45
    for r in done:
        assert r.predicted == pytest.approx(brute_force(rows, 3, r.business_id, near[:6], mean, std))
    best = rec.ranked_predictions(spark.createDataFrame(done), 5).collect()
    assert [r.predicted for r in best] == sorted((r.predicted for r in done), reverse=True)[:5]


def test_equal_neighbours_give_their_common_deviation(spark):
    rows = [(1, 1, 2.0), (1, 2, 4.0)] + [r for n in (2, 3) for r in ((n, 1, 1.0), (n, 2, 5.0), (n, 3, 5.0))]
    d = spark.createDataFrame(rows, RATING)
    near = spark.createDataFrame([(1, 2, 0.3, 1), (1, 3, 0.9, 2)], "user_id long, neighbor_id long, corr double, rank long")
    ask = spark.createDataFrame([(1, 3)], "user_id long, business_id long")
    got = rec.predict_rating(ask, near, d, rec.user_stats(d)).first().predicted
    z = (5.0 - 11 / 3) / np.std([1.0, 5.0, 5.0])
    assert got == pytest.approx(3.0 + 1.0 * z)


def test_first_rating_counts_and_activity_threshold(spark):
    rows = [(1, 1, 5.0, 2), (1, 1, 3.0, 1), (1, 2, 4.0, 3), (2, 1, 1.0, 4)]
    d = spark.createDataFrame(rows, RATING + ", at long")
    stats, ratings = rec.prepare(d, 2, ["at"])
    assert as_set(ratings, "user_id", "business_id", "stars") == {(1, 1, 3.0), (1, 2, 4.0)}
    assert rec.most_active(stats, 1) == 1 and rec.most_active(stats, 2) == 2
    users = spark.createDataFrame([(1, "a"), (2, "b")], "user_id long, name string")
    assert as_set(rec.active_users(d, users, 2), "user_id", "reviews", "name") == {(1, 3, "a")}


def test_lexical_similarity(spark):
    texts = spark.createDataFrame([(1, "a a b"), (2, "a b b c"), (3, "c d"), (1, "b")], "user_id long, text string")
    m = np.array([[2, 2, 0, 0], [1, 2, 1, 0], [0, 0, 1, 1]], float)
    want = np.corrcoef(m)
    got = {(r.user_id, r.neighbor_id): r["corr"] for r in rec.lexical_user_similarity(texts).collect()}
    assert got == pytest.approx({(i + 1, j + 1): want[i, j] for i in range(3) for j in range(3)})
    one = {r.neighbor_id: r["corr"] for r in rec.lexical_similarity_to_user(texts, 2).collect()}
    assert one == pytest.approx({j + 1: want[1, j] for j in range(3)})


def test_unlisted_matrix_columns_are_an_error(spark):
    from rivulet.operators import relational as rel

    d = spark.createDataFrame([(1, 1, 4.0), (2, 3, 5.0)], RATING)
    assert rel.rating_matrix(d, "user_id", "business_id", "stars", [1, 3], 0.1).count() == 2
    for listed in ([1], []):
        with pytest.raises(Exception, match="not listed"):
            rel.rating_matrix(d, "user_id", "business_id", "stars", listed or [2], None).collect()
    wide = rel.rating_matrix(d, "user_id", "business_id", "stars", [1, 3], None)
    with pytest.raises(Exception, match="not listed"):
        rel.transpose(wide, "user_id", [1]).collect()
