"""Sentiment per time slot, its alignment with index quotes, and Granger causality."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.tails import chi2_tail, f_tail
from rivulet.functions.times import GRID_SLOTS
from rivulet.operators.ordered import batch_by_count, evenly_cut, with_lags
from rivulet.operators.relational import count_per_key, join_on_same
from rivulet.plans.text import clean_words
from rivulet.session import materialize


def ratio_and_diff(words: DataFrame, positives: DataFrame, negatives: DataFrame, by: Sequence[str]) -> DataFrame:
    """Summed positive and negative lexicon values per group, their ratio and difference.

    ``positives`` and ``negatives`` have (word, value). The ratio is null where no negative word
    occurs. Words are counted per group before they meet the lexicons.
    """
    counted = count_per_key(words, *by, "word")
    marked = (
        counted.join(_one_value(positives, "p"), "word", "left")
        .join(_one_value(negatives, "q"), "word", "left")
    )

    def total(c: str) -> Column:
        return F.sum(F.coalesce(F.col(c), F.lit(0.0)) * F.col("n"))

    sums = marked.groupBy(*by).agg(total("p").alias("positive"), total("q").alias("negative"))
    size = F.abs("negative")
    return sums.withColumns(
        {"ratio": F.try_divide(F.col("positive"), size), "diff": F.col("positive") - size}
    )


def _one_value(lexicon: DataFrame, name: str) -> DataFrame:
    """A word listed twice counts twice, which for a sum is one row with the added values."""
    return lexicon.groupBy("word").agg(F.sum(F.col("value").cast("double")).alias(name))


def batch_sentiment(
    posts: DataFrame,
    positives: DataFrame,
    negatives: DataFrame,
    size: int,
    stopwords: Iterable[str] = (),
    order: Sequence[str] = ("id",),
    slots: int | None = GRID_SLOTS,
) -> DataFrame:
    """Sentiment ratio and difference per slot, slots being filled with ``size`` posts each; more posts
    than ``slots`` such batches hold are an error."""
    batched = batch_by_count(posts, order, size, slots)
    words = clean_words(batched, stopwords, keep=["slot"])
    return ratio_and_diff(words, positives, negatives, ["slot"])


def aligned_series(
    sentiment: DataFrame, quotes: DataFrame, indices: Sequence[str], on: Sequence[str] = ("slot",)
) -> DataFrame:
    """Sentiment and index side by side for each measure and index: (series, *keys, value, index).

    One series per combination of ``ratio`` / ``diff`` and index, present where both are.
    """
    joined = sentiment.join(quotes, list(on))
    keys = [c for c in quotes.columns if c not in indices]
    pairs = [
        F.struct(F.lit(f"{m}_{i}").alias("series"), F.col(m).alias("value"), F.col(i).cast("double").alias("index"))
        for m in ("ratio", "diff")
        for i in indices
    ]
    return joined.select(*keys, F.explode(F.array(*pairs)).alias("s")).select("s.series", *keys, "s.value", "s.index")


GRANGER_SCHEMA = (
    "lag int, observations long, f_stat double, f_p double, f_df1 long, f_df2 long, chi2_stat double, chi2_p double, "
    "lr_stat double, lr_p double, chi2_df long, params_f_stat double, params_f_p double"
)


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of ``rows``, square: it has the same product with itself, and stacked factors stand for stacked rows."""
    width = rows.shape[1]
    if len(rows) < width:
        rows = np.vstack([rows, np.zeros((width - len(rows), width))])
    return np.linalg.qr(rows, mode="r")


def _factors(group: Sequence[str], width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's rows (*group, depth, terms) as one triangular factor and row count per series and depth.

    Factors that a task holds are bounded: with very many series it hands some out and starts new ones.
    """
    keys = [*group, "depth"]

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[int, np.ndarray]] = {}
        kinds: list[pa.DataType] = []

        def handed_out() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in held], kind) for i, kind in enumerate(kinds)]
            counts = pa.array([n for n, _ in held.values()], pa.int64())
            factors = pa.array([r.ravel() for _, r in held.values()], pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([*columns, counts, factors], [*keys, "n", "factor"])

        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys]
            terms = batch["terms"].flatten().to_numpy().reshape(-1, width)
            codes = np.stack([batch[k].dictionary_encode(null_encoding="encode").indices.to_numpy() for k in keys])
            _, first, member = np.unique(codes, axis=1, return_index=True, return_inverse=True)
            order = np.argsort(member.ravel(), kind="stable")
            parts = np.split(order, np.cumsum(np.bincount(member.ravel()))[:-1])
            for at, mine in zip(first, parts):
                key = tuple(batch[k][int(at)].as_py() for k in keys)
                n, known = held.get(key, (0, np.empty((0, width))))
                held[key] = n + len(mine), _triangle(np.vstack([known, terms[mine]]))
            if len(held) > 4096:
                yield handed_out()
                held.clear()
        if held:
            yield handed_out()

    return factor


def _solve(strata: pd.DataFrame, maxlag: int) -> list[tuple]:
    """Test statistics for every lag from the triangular factors of one series.

    ``strata`` has rows per number of available lags; lag L uses those with at
    least L of them.
    """
    width = 2 * maxlag + 2
    depth = strata["depth"].to_numpy()
    factors = [np.asarray(f, float).reshape(width, width) for f in strata["factor"]]
    counts = strata["n"].to_numpy()
    out = []
    for lag in range(1, maxlag + 1):
        use = depth >= lag
        whole = np.vstack([f for f, u in zip(factors, use) if u] or [np.zeros((width, width))])
        t = int(counts[use].sum())
        y_lags = list(range(2, 2 + lag))
        x_lags = list(range(2 + maxlag, 2 + maxlag + lag))
        df2 = t - 2 * lag - 1
        small = _residual(whole, [0] + y_lags)
        full = _residual(whole, [0] + y_lags + x_lags)
        if df2 <= 0 or small is None or full is None:
            out.append((lag, t) + (None,) * 11)
            continue
        f = (small - full) / lag / (full / df2)
        chi2 = t * (small - full) / full
        lr = t * float(np.log(small / full))
        f_p = f_tail(f, lag, df2)
        out.append((lag, t, f, f_p, lag, df2, chi2, chi2_tail(chi2, lag), lr, chi2_tail(lr, lag), lag, f, f_p))
    return out


#: Below this share of its column's length a regressor is one that the others give, and a residual is none.
UNDETERMINED = 1e-12


def _residual(rows: np.ndarray, regressors: list[int]) -> float | None:
    """Residual sum of squares of column 1 on ``regressors``; None when it is not determined."""
    picked = rows[:, [*regressors, 1]]
    size = np.sqrt(np.square(picked).sum(axis=0))
    if not (np.all(size > 0) and np.all(np.isfinite(size))):
        return None
    corner = np.abs(np.diag(_triangle(picked / size)))
    if np.any(corner <= UNDETERMINED):
        return None
    return float((corner[-1] * size[-1]) ** 2)


def granger_causality(
    series: DataFrame,
    maxlag: int = 5,
    by: Sequence[str] = (),
    order: str = "time",
    chunk: Column | None = None,
    direction: str = "index->value",
    runs: Sequence[str] = (),
) -> DataFrame:
    """Does the past of one column help to predict the other? One row per series and lag 1..maxlag.

    ``series`` has (*by, order, value, index). Four tests per lag: SSR F, SSR chi-square, likelihood
    ratio and parameter F (equal to the first), with p-values and degrees of freedom; null where
    the rows do not determine them. ``direction`` may be turned to ``value->index``.
    ``chunk`` is a non-decreasing function of the order that cuts long series for the lags; without it they are cut
    evenly (see ``with_lags``). ``runs`` are further columns that lags do not cross. Runs jobs: the known rows are written once.

    Each task turns its rows into one triangular factor per series, whatever rows it has, and the factors of a series are
    stacked and factored again. No products are formed, so regressors that nearly agree lose no more digits than they must.
    """
    effect, cause = ("value", "index") if direction == "index->value" else ("index", "value")
    known = series.where(F.col("value").isNotNull() & F.col("index").isNotNull()).select(
        *by, *runs, order, *([] if chunk is None else [chunk.alias("chunk")]), F.col(effect).cast("double").alias("y"), F.col(cause).cast("double").alias("x")
    )
    known = evenly_cut(known, [*by, *runs, order]) if chunk is None else materialize(known)
    group = list(by) or ["series_"]
    # Regression with a constant does not change when a column is shifted; centring keeps precision.
    averages = F.struct(F.avg("y").alias("y"), F.avg("x").alias("x"))
    if by:
        centred = join_on_same(known, known.groupBy(*by).agg(averages.alias("means")), by)
    else:
        centred = known.withColumn("means", known.agg(averages).scalar()).withColumn("series_", F.lit(0))
    centred = centred.withColumns({"y": F.col("y") - F.col("means.y"), "x": F.col("x") - F.col("means.x")})
    lagged = with_lags(
        centred.drop("means"), [*group, *runs], order, ["y", "x"], maxlag, F.col("chunk")
    )

    def past(i: int, c: str) -> Column:
        return F.coalesce(F.get("lags", F.lit(i))[c], F.lit(0.0))

    terms = F.array(F.lit(1.0), F.col("y"), *[past(i, "y") for i in range(maxlag)], *[past(i, "x") for i in range(maxlag)])
    rows = lagged.where(F.size("lags") > 0).select(*group, F.size("lags").alias("depth"), terms.alias("terms"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in group)
    factors = rows.mapInArrow(_factors(group, 2 * maxlag + 2), f"{kinds}, depth int, n long, factor array<double>")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        answers = pd.DataFrame(_solve(pdf, maxlag), columns=[c.split()[0] for c in GRANGER_SCHEMA.split(", ")])
        for at, c in enumerate(group):
            answers.insert(at, c, pdf[c].iloc[0])
        return answers

    return factors.groupBy(*group).applyInPandas(solve, f"{kinds}, {GRANGER_SCHEMA}").drop("series_")


def granger_pooled(
    parts: Sequence[DataFrame], maxlag: int = 5, by: Sequence[str] = (), order: str = "time",
    partition_by_day: bool = False, **options,
) -> DataFrame:
    """``granger_causality`` of several days appended in the given order.

    Lags run over from one day into the next unless ``partition_by_day``.
    """
    pooled = None
    for at, part in enumerate(parts):
        numbered = part.withColumn("day_", F.lit(at))
        pooled = numbered if pooled is None else pooled.unionByName(numbered)
    pooled = pooled.withColumn("order_", F.struct("day_", order))
    runs = ["day_"] if partition_by_day else []
    return granger_causality(pooled, maxlag, by, "order_", runs=runs, **options)
