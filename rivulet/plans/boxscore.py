"""Player shot profiles and the efficiency leaderboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rivulet.operators.relational import first_per_key

# The shot metrics that are averaged and the box score statistics that are read.
SHOT_METRICS = ["close_def_dist", "dribbles", "shot_dist", "touch_time"]
BOX_STATS = ["pts", "reb", "ast", "stl", "blk", "pfd", "fta", "ftm", "fga", "fgm", "tov"]


def player_shot_profile(shots: DataFrame, player: str = "player_id") -> DataFrame:
    """Mean of the four shot metrics per player; missing values do not count."""
    return shots.groupBy(player).agg(*[F.avg(m).alias(f"avg_{m}") for m in SHOT_METRICS])


def ranked_by(profile: DataFrame, metric: str, player: str = "player_id") -> DataFrame:
    """Players from the highest value of one metric down, unknown ones last, with the metric."""
    return profile.select(player, metric).orderBy(F.col(metric).desc_nulls_last(), F.asc(player))


def box_scores(results: DataFrame, order: Sequence[str], player: str = "player_id") -> DataFrame:
    """The first row of every player's results with its statistics rounded to two places."""
    first = first_per_key(results.select(player, *order, *[s for s in BOX_STATS if s not in order]), [player], order)
    return first.select(player, *[F.round(s, 2).alias(s) for s in BOX_STATS])


def efficiency(box: DataFrame, player: str = "player_id") -> DataFrame:
    """(player, eff): what a player adds minus missed shots, missed free throws and turnovers, to six places,
    so that equal scores are equal whatever the order of the sum."""
    gains = sum((F.col(s) for s in ["reb", "ast", "stl", "blk", "pfd"]), F.col("pts"))
    losses = (F.col("fga") - F.col("fgm")) + (F.col("fta") - F.col("ftm")) + F.col("tov")
    return box.select(player, (F.round(gains - losses, 6) + 0.0).alias("eff"))


def efficiency_leaderboard(box: DataFrame, k: int = 10, player: str = "player_id") -> DataFrame:
    """The ``k`` most efficient players; equal scores are ordered by player."""
    return efficiency(box, player).orderBy(F.col("eff").desc_nulls_last(), F.asc(player)).limit(k)
