import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.plans import timeseries as ts
from tests.conftest import as_set


def least_squares(y, x, lag, cut=()):
    """Residual sums with and without the lags of x; rows whose lags cross a cut are left out."""
    use = [t for t in range(lag, len(y)) if not any(t - lag < c <= t for c in cut)]
    own = np.array([[1.0] + [y[t - i] for i in range(1, lag + 1)] for t in use])
    other = np.array([[x[t - i] for i in range(1, lag + 1)] for t in use])
    target = np.array([y[t] for t in use])

    def rest(a):
        return float(((target - a @ np.linalg.lstsq(a, target, rcond=None)[0]) ** 2).sum())

    return len(use), rest(own), rest(np.hstack([own, other]))


def example(n=80, seed=1, shift=1e4):
    rng = np.random.default_rng(seed)
    x = shift + rng.normal(size=n).cumsum()
    y = np.r_[0.0, 0.4 * x[:-1]] + rng.normal(size=n)
    return y, x


def frame(spark, y, x, key="a"):
    rows = [(key, t, float(v), float(w)) for t, (v, w) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "k string, time long, value double, index double").repartition(3)


@pytest.mark.parametrize("direction", ["index->value", "value->index"])
def test_granger_equals_least_squares(spark, direction):
    y, x = example()
    noise = np.random.default_rng(9).normal(size=(2, 60))
    series = frame(spark, y, x).unionByName(frame(spark, *noise, "b"))
    got = ts.granger_causality(series, 5, ["k"], "time", F.floor(F.col("time") / 11), direction).collect()
    assert len(got) == 10
    jvm = spark._jvm.org.apache.commons.math3.distribution
    for r in got:
        pair = (y, x) if r.k == "a" else tuple(noise)
        t, small, full = least_squares(*(pair if direction == "index->value" else pair[::-1]), r.lag)
        df2 = t - 2 * r.lag - 1
        f = (small - full) / r.lag / (full / df2)
        assert (r.observations, r.f_df1, r.f_df2, r.chi2_df) == (t, r.lag, df2, r.lag)
        assert r.f_stat == pytest.approx(f, rel=1e-6) and r.params_f_stat == r.f_stat
        assert r.chi2_stat == pytest.approx(t * (small - full) / full, rel=1e-6)
        assert r.lr_stat == pytest.approx(t * np.log(small / full), rel=1e-6)
        assert r.f_p == pytest.approx(1 - jvm.FDistribution(float(r.lag), float(df2)).cumulativeProbability(r.f_stat), abs=1e-9)
        chi2 = jvm.ChiSquaredDistribution(float(r.lag))
        assert r.chi2_p == pytest.approx(1 - chi2.cumulativeProbability(r.chi2_stat), abs=1e-9)
        assert r.lr_p == pytest.approx(1 - chi2.cumulativeProbability(r.lr_stat), abs=1e-9)


@pytest.mark.parametrize("kind", ["trend", "collinear", "scales"])
def test_badly_conditioned_series_equal_least_squares(spark, kind):
    rng = np.random.default_rng(5)
    y, x = example(400, 3, 0.0)
    if kind == "trend":
        y, x = y + 50.0 * np.arange(400), x + 1e3 * np.arange(400)
    elif kind == "collinear":
        x = y + 1e-5 * rng.normal(size=400)
    else:
        y, x = y * 1e-9, x * 1e9
    # least squares by Householder in extended precision, so that the comparison itself is exact enough
    got = {r.lag: r for r in ts.granger_causality(frame(spark, y, x), 5, ["k"], "time", F.floor(F.col("time") / 37)).collect()}
    for lag in range(1, 6):
        small, full = (exact_rest(y, x, lag, own) for own in (True, False))
        f = (small - full) / lag / (full / (400 - lag - 2 * lag - 1))
        assert got[lag].f_stat == pytest.approx(float(f), rel=1e-8)


def exact_rest(y, x, lag, own):
    """Residual sum of squares in 80-bit arithmetic, by orthogonalising twice."""
    y, x = (np.asarray(v - np.mean(v), np.longdouble) for v in (y, x))
    use = range(lag, len(y))
    columns = [np.ones(len(use), np.longdouble)] + [y[lag - i : len(y) - i] for i in range(1, lag + 1)]
    columns += [] if own else [x[lag - i : len(x) - i] for i in range(1, lag + 1)]
    basis, rest = [], y[lag:]
    for c in [*columns, rest]:
        for _ in range(3):
            for b in basis:
                c = c - b * (b @ c)
        basis.append(c / np.sqrt(c @ c))
    return c @ c


def test_exactly_collinear_series_have_no_answer(spark):
    y, _ = example(100)
    assert all(r.f_stat is None for r in ts.granger_causality(frame(spark, y, 2 * y), 3, ["k"]).collect())


def test_many_series_and_null_keys(spark):
    rng = np.random.default_rng(7)
    rows = [(k, t, float(v), float(w)) for k in [None, *range(40)] for t, (v, w) in enumerate(rng.normal(size=(30, 2)))]
    got = ts.granger_causality(spark.createDataFrame(rows, "k long, time long, value double, index double"), 2, ["k"]).collect()
    assert len(got) == 82
    for r in got:
        mine = [(v, w) for k, _, v, w in rows if k == r.k]
        t, small, full = least_squares(*map(np.array, zip(*mine)), r.lag)
        assert r.f_stat == pytest.approx((small - full) / r.lag / (full / (t - 2 * r.lag - 1)), rel=1e-9)


def test_granger_without_enough_rows_or_variation(spark):
    short = ts.granger_causality(frame(spark, *example(6)), 5).collect()
    assert [(r.lag, r.f_stat is None) for r in sorted(short)] == [(1, False), (2, True), (3, True), (4, True), (5, True)]
    flat = ts.granger_causality(frame(spark, np.ones(40), np.arange(40.0)), 2).collect()
    assert all(r.f_stat is None and r.f_p is None for r in flat)


def test_pooled_days(spark):
    y, x = example(50)
    days = [frame(spark, y[:30], x[:30]), frame(spark, y[30:], x[30:])]
    over = {r.lag: r for r in ts.granger_pooled(days, 3, ["k"]).collect()}
    apart = {r.lag: r for r in ts.granger_pooled(days, 3, ["k"], partition_by_day=True).collect()}
    for lag in (1, 2, 3):
        for got, cut in ((over[lag], ()), (apart[lag], (30,))):
            t, small, full = least_squares(y, x, lag, cut)
            assert got.observations == t
            assert got.f_stat == pytest.approx((small - full) / lag / (full / (t - 2 * lag - 1)), rel=1e-6)


def lexicons(spark):
    good = spark.createDataFrame([("good", 2.0), ("fine", 1.0), ("fine", 0.5)], "word string, value double")
    bad = spark.createDataFrame([("bad", -1.0)], "word string, value double")
    return good, bad


def test_batch_sentiment(spark):
    texts = ["good bad", "Bad the", "fine good", "x", "good bad bad", "nothing", "late"]
    posts = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = ts.batch_sentiment(posts, *lexicons(spark), 2, ["the"])
    assert as_set(got, "slot", "positive", "negative", "ratio", "diff") == {
        (0, 2.0, -2.0, 1.0, 0.0), (1, 3.5, 0.0, None, 3.5), (2, 2.0, -2.0, 1.0, 0.0), (3, 0.0, 0.0, None, 0.0)
    }
    with pytest.raises(ValueError):
        ts.batch_sentiment(posts, *lexicons(spark), 2, ["the"], slots=3)


def test_aligned_series(spark):
    sentiment = spark.createDataFrame([(1, 2.0, 1.0), (2, None, 3.0), (9, 1.0, 1.0)], "slot int, ratio double, diff double")
    quotes = spark.createDataFrame([(1, 10.0, 100.0), (2, 11.0, 101.0)], "slot int, sp double, nq double")
    got = as_set(ts.aligned_series(sentiment, quotes, ["sp", "nq"]), "series", "slot", "value", "index")
    assert got == {
        ("ratio_sp", 1, 2.0, 10.0), ("ratio_sp", 2, None, 11.0), ("ratio_nq", 1, 2.0, 100.0), ("ratio_nq", 2, None, 101.0),
        ("diff_sp", 1, 1.0, 10.0), ("diff_sp", 2, 3.0, 11.0), ("diff_nq", 1, 1.0, 100.0), ("diff_nq", 2, 3.0, 101.0),
    }
