"""Movement, density and box score queries."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F

from rivulet.functions import numbers as fn
from rivulet.operators import relational as rel
from rivulet.plans import boxscore, density, movement
from workload import adapters as a
from workload.registry import query

LAST = "OVER (PARTITION BY game_id, event_id, player_id ORDER BY moment)"
STEPS = f"""{a.MOVES}, st AS (SELECT game_id, event_id, player_id, moment, x_loc - lag(x_loc) {LAST} AS dx, y_loc - lag(y_loc) {LAST} AS dy FROM mv)"""
TRAVEL = f"{STEPS}, tr AS (SELECT game_id, event_id, player_id, coalesce(sum(sqrt(dx * dx + dy * dy)), 0) AS distance FROM st GROUP BY ALL)"
FOCUS = f"""{a.MOVES}, fd AS (SELECT o.game_id, o.event_id, o.player_id, o.moment, o.shot_clock, sqrt((o.x_loc - f.x_loc) * (o.x_loc - f.x_loc)
  + (o.y_loc - f.y_loc) * (o.y_loc - f.y_loc)) AS dist FROM mv o JOIN mv f ON o.game_id = f.game_id AND o.event_id = f.event_id AND o.moment = f.moment
  WHERE f.player_id = {a.FOCUS} AND o.player_id <> {a.FOCUS})"""
MASK = f"""game_clock BETWEEN {a.GAME_RANGE[0]}::DOUBLE AND {a.GAME_RANGE[1]}::DOUBLE
  AND shot_clock BETWEEN {a.SHOT_RANGE[0]}::DOUBLE AND {a.SHOT_RANGE[1]}::DOUBLE"""
PAIRS = ", ".join(f"('{x}:{y}', {x}, {y})" for x, y in a.PAIRS)
PLAY = f"""{a.MOVES}, play AS (SELECT l.game_id, l.event_id, p.pair, l.moment, l.shot_clock, sqrt((l.x_loc - r.x_loc) * (l.x_loc - r.x_loc)
  + (l.y_loc - r.y_loc) * (l.y_loc - r.y_loc)) AS dist FROM (VALUES {PAIRS}) p(pair, a, b)
  JOIN (SELECT * FROM mv WHERE {MASK}) l ON l.player_id = p.a JOIN mv r ON r.player_id = p.b AND r.game_id = l.game_id AND r.event_id = l.event_id AND r.moment = l.moment)"""


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) + 0.0 for c in columns})


@query(
    "flatten_movement",
    f"""WITH {a.MOVES}, {a.PLAYERS} SELECT game_id, event_id, mv.player_id, team_id, x_loc, y_loc, 0::DOUBLE AS radius, moment, game_clock,
    shot_clock, player_name, jersey FROM mv LEFT JOIN players USING (player_id)""",
)
def flatten_movement(spark, sf):
    return a.movement(spark, sf)


@query(
    "moment_positions",
    f"WITH {a.MOVES} SELECT game_id, event_id, moment, player_id, game_clock, shot_clock, x_loc, y_loc FROM mv",
)
def moment_positions(spark, sf):
    return movement.moment_positions(a.payload(spark, sf)).select(
        *movement.EVENT, "moment", "player_id", "game_clock", "shot_clock", "x_loc", "y_loc"
    )


@query(
    "join_dimension_map",
    f"""WITH {a.MOVES}, {a.PLAYERS} SELECT player_name, jersey, count(*) AS n FROM mv LEFT JOIN players USING (player_id)
    GROUP BY ALL""",
)
def join_dimension_map(spark, sf):
    return rel.count_per_key(a.movement(spark, sf), "player_name", "jersey")


@query("filter_equals", f"WITH {a.MOVES} SELECT game_id, event_id, moment, x_loc, y_loc FROM mv WHERE player_id = -1 AND team_id = 1")
def filter_equals(spark, sf):
    mv = a.positions(spark, sf)
    return mv.where((F.col("player_id") == movement.BALL) & (F.col("team_id") == 1)).select(*movement.EVENT, "moment", "x_loc", "y_loc")


@query("filter_not_equal", f"WITH {a.MOVES} SELECT game_id, event_id, player_id, moment, x_loc FROM mv WHERE player_id <> {a.FOCUS}")
def filter_not_equal(spark, sf):
    return a.positions(spark, sf).where(F.col("player_id") != a.FOCUS).select(*movement.EVENT, "player_id", "moment", "x_loc")


@query("filter_range_mask", f"WITH {a.MOVES} SELECT game_id, event_id, player_id, moment, game_clock, shot_clock FROM mv WHERE {MASK}")
def filter_range_mask(spark, sf):
    return a.positions(spark, sf).where(movement.in_play(a.GAME_RANGE, a.SHOT_RANGE)).select(
        *movement.EVENT, "player_id", "moment", "game_clock", "shot_clock"
    )


@query("filter_in_set", f"WITH {a.MOVES} SELECT game_id, event_id, player_id, moment, x_loc FROM mv WHERE player_id IN (3, 5, 7, 9, -1)")
def filter_in_set(spark, sf):
    return a.positions(spark, sf).where(F.col("player_id").isin(3, 5, 7, 9, -1)).select(*movement.EVENT, "player_id", "moment", "x_loc")


@query("agg_min_max_range", f"WITH {a.MOVES} SELECT round(max(game_clock) - min(game_clock), 6) AS seconds FROM mv")
def agg_min_max_range(spark, sf):
    span = F.max("game_clock") - F.min("game_clock")
    return a.positions(spark, sf).agg(F.round(span, 6).alias("seconds"))


@query("agg_distinct", f"WITH {a.MOVES} SELECT DISTINCT shot_clock FROM mv")
def agg_distinct(spark, sf):
    return a.positions(spark, sf).select("shot_clock").distinct()


@query(
    "window_lag_diff",
    f"WITH {STEPS} SELECT game_id, event_id, player_id, moment, round(dx, 6) + 0 AS dx, round(dy, 6) + 0 AS dy FROM st",
)
def window_lag_diff(spark, sf):
    return rounded(movement.steps(a.positions(spark, sf)), "dx", "dy").drop("step")


@query("travel_distance", f"WITH {TRAVEL} SELECT game_id, event_id, player_id, round(distance, 6) AS distance FROM tr")
def travel_distance(spark, sf):
    return rounded(movement.travel_distance(a.positions(spark, sf)), "distance")


SPEED = f"""WITH {TRAVEL}, s AS (SELECT game_id, event_id, max(game_clock) - min(game_clock) AS seconds FROM mv GROUP BY ALL)
    SELECT game_id, event_id, player_id, round(distance, 6) AS distance,
    round(distance / seconds * CAST(0.681818 AS DOUBLE), 6) AS mph FROM tr JOIN s USING (game_id, event_id)"""


@query("distance_and_speed", SPEED)
def distance_and_speed(spark, sf):
    return rounded(movement.distance_and_speed(a.positions(spark, sf)), "distance", "mph")


@query("average_speed", f"SELECT player_id, round(avg(mph), 6) AS mph FROM ({SPEED}) GROUP BY player_id")
def average_speed(spark, sf):
    """Each player's mean over the events."""
    speeds = rounded(movement.distance_and_speed(a.positions(spark, sf)), "mph")
    return rounded(speeds.groupBy("player_id").agg(F.avg("mph").alias("mph")), "mph")


@query(
    "fn_unit_convert",
    f"WITH {STEPS} SELECT game_id, event_id, player_id, moment, round(sqrt(dx * dx + dy * dy) * CAST(0.681818 AS DOUBLE), 6) AS mph FROM st",
)
def fn_unit_convert(spark, sf):
    steps = movement.steps(a.positions(spark, sf))
    return steps.select(*movement.EVENT, "player_id", "moment", F.round(fn.to_mph(F.col("step")), 6).alias("mph"))


@query("fn_euclidean", f"WITH {a.MOVES} SELECT game_id, event_id, player_id, moment, round(sqrt(x_loc * x_loc + y_loc * y_loc), 6) AS r FROM mv")
def fn_euclidean(spark, sf):
    r = fn.distance(F.col("x_loc"), F.col("y_loc"), F.lit(0.0), F.lit(0.0))
    return a.positions(spark, sf).select(*movement.EVENT, "player_id", "moment", F.round(r, 6).alias("r"))


@query("join_self_positional", f"WITH {FOCUS} SELECT game_id, event_id, player_id, moment, shot_clock, round(dist, 6) AS dist FROM fd")
def join_self_positional(spark, sf):
    return rounded(movement.focus_distances(a.positions(spark, sf), a.FOCUS), "dist")


@query(
    "distance_to_focus",
    f"WITH {FOCUS} SELECT game_id, event_id, player_id, count(*) AS moments, round(avg(dist), 6) AS avg_dist FROM fd GROUP BY ALL",
)
def distance_to_focus(spark, sf):
    return rounded(movement.distance_to_focus(a.positions(spark, sf), a.FOCUS), "avg_dist")


@query("distance_in_play", f"WITH {PLAY} SELECT game_id, event_id, pair, moment, shot_clock, round(dist, 6) AS dist FROM play")
def distance_in_play(spark, sf):
    play = movement.distance_in_play(a.positions(spark, sf), a.PAIRS, a.GAME_RANGE, a.SHOT_RANGE)
    return rounded(play, "dist")


@query(
    "series_last_value",
    f"WITH {PLAY} SELECT game_id, event_id, pair, max(moment) AS moment, round(arg_max(dist, moment), 6) AS dist FROM play GROUP BY game_id, event_id, pair",
)
def series_last_value(spark, sf):
    play = movement.distance_in_play(a.positions(spark, sf), a.PAIRS, a.GAME_RANGE, a.SHOT_RANGE)
    return rounded(movement.last_distances(play), "dist")


@query(
    "udf_group_scalar",
    f"""WITH {STEPS} SELECT game_id, event_id, player_id, round(quantile_disc(sqrt(dx * dx + dy * dy), 0.5), 6) AS middle_step
    FROM st WHERE dx IS NOT NULL GROUP BY ALL""",
)
def udf_group_scalar(spark, sf):
    """A Python function per group that has no partial form: each player's middle step of an event."""

    @F.pandas_udf("double")
    def middle(step: pd.Series) -> float:
        return float(step.sort_values(ignore_index=True)[max(0, -(-len(step) // 2) - 1)])

    steps = movement.steps(a.positions(spark, sf)).where(F.col("step").isNotNull())
    return steps.groupBy(*movement.EVENT, "player_id").agg(F.round(middle("step"), 6).alias("middle_step"))


@query(
    "udf_group_list",
    f"""WITH {FOCUS} SELECT game_id, event_id, player_id, moment // 1000 AS chunk, count(*) AS n, string_agg(CAST(moment AS VARCHAR), ','
    ORDER BY moment) AS moments, round(sum(dist), 6) AS total FROM fd GROUP BY 1, 2, 3, 4""",
)
def udf_group_list(spark, sf):
    lists = movement.distance_lists(a.positions(spark, sf), a.FOCUS)
    total = F.aggregate("series", F.lit(0.0), lambda acc, s: acc + s["dist"])
    names = F.concat_ws(",", F.transform("series", lambda s: s["moment"].cast("string")))
    return lists.select(
        *movement.EVENT, "player_id", "chunk", F.size("series").cast("long").alias("n"), names.alias("moments"), F.round(total, 6).alias("total")
    )


# ---- densities ------------------------------------------------------------------------------------

POINTS = f"{a.EVENTS}, pts AS (SELECT value AS x, CAST(k AS DOUBLE) AS y FROM ev)"
SX, SY = 8.0, 8.0 * math.sqrt(3.0)


@query(
    "shot_density_grid",
    f"""WITH {POINTS} SELECT CAST(floor(x / 5) AS BIGINT) AS cell_x, CAST(floor(y / 10) AS BIGINT) AS cell_y, count(*) AS n
    FROM pts GROUP BY 1, 2""",
)
def shot_density_grid(spark, sf):
    return density.density_grid(a.shot_points(spark, sf), 5.0, 10.0)


@query(
    "shot_density_marginals",
    f"""WITH {POINTS} SELECT 'x' AS axis, CAST(floor(x / 5) AS BIGINT) AS bin, count(*) AS n FROM pts GROUP BY 1, 2
    UNION ALL SELECT 'y', CAST(floor(y / 10) AS BIGINT), count(*) FROM pts GROUP BY 1, 2""",
)
def shot_density_marginals(spark, sf):
    pts = a.shot_points(spark, sf)
    across, along = density.marginal(pts, 5.0, "x"), density.marginal(pts, 10.0, "y")
    both = across.withColumn("axis", F.lit("x")).unionByName(along.withColumn("axis", F.lit("y")))
    return both.select("axis", "bin", "n")


@query(
    "shot_density_hex",
    f"""WITH {POINTS}, s AS (SELECT x / {SX!r}::DOUBLE AS u, y / {SY!r}::DOUBLE AS v FROM pts),
    c AS (SELECT *, floor(u + 0.5) AS i1, floor(v + 0.5) AS j1, floor(u) AS i2, floor(v) AS j2 FROM s),
    d AS (SELECT *, (u - i1) * (u - i1) + 3 * (v - j1) * (v - j1) AS d1,
      (u - i2 - 0.5) * (u - i2 - 0.5) + 3 * (v - j2 - 0.5) * (v - j2 - 0.5) AS d2 FROM c)
    SELECT CASE WHEN d1 <= d2 THEN 1 ELSE 2 END AS lattice, CAST(CASE WHEN d1 <= d2 THEN i1 ELSE i2 END AS BIGINT) AS cell_x,
    CAST(CASE WHEN d1 <= d2 THEN j1 ELSE j2 END AS BIGINT) AS cell_y, count(*) AS n FROM d GROUP BY 1, 2, 3""",
)
def shot_density_hex(spark, sf):
    return density.density_hex(a.shot_points(spark, sf), SX).select("lattice", "cell_x", "cell_y", "n")


def kde_sql(points: str, digits: int = 10) -> str:
    return f"""WITH {points}, f AS (SELECT count(*) AS n, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1,
      stddev_samp(x) * pow(count(*), -1.0::DOUBLE / 6) AS hx, stddev_samp(y) * pow(count(*), -1.0::DOUBLE / 6) AS hy FROM pts),
    g AS (SELECT gx, gy, x0 + gx * (x1 - x0) / 49 AS x, y0 + gy * (y1 - y0) / 49 AS y, hx, hy, n FROM f,
      (SELECT unnest(generate_series(0, 49)) AS gx), (SELECT unnest(generate_series(0, 49)) AS gy))
    SELECT gx, gy, round(g.x, 6) AS x, round(g.y, 6) AS y, round(sum(exp(-0.5::DOUBLE * (pow((g.x - p.x) / hx, 2)
      + pow((g.y - p.y) / hy, 2)))) / any_value(n * 2 * pi() * hx * hy), {digits}) AS density
    FROM g CROSS JOIN pts p GROUP BY gx, gy, g.x, g.y"""


@query("density_kde", kde_sql(POINTS))
def density_kde(spark, sf):
    return rounded(rounded(density.density_kde(a.shot_points(spark, sf)), "x", "y"), "density", digits=10)


@query("density_kde_binned", kde_sql(POINTS, 8))
def density_kde_binned(spark, sf):
    """The density by binning, with an error far below the digits that are shown."""
    found = density.density_kde(a.shot_points(spark, sf), tolerance=1e-9)
    return rounded(rounded(found, "x", "y"), "density", digits=8)


@query(
    "density_kde_scaled",
    kde_sql(
        f"""{a.HOURLY}, pts AS (SELECT (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) AS x,
        ("index" - min("index") OVER ()) / (max("index") OVER () - min("index") OVER ()) AS y FROM hourly)"""
    ),
)
def density_kde_scaled(spark, sf):
    return rounded(rounded(density.density_kde_scaled(a.hourly_series(spark, sf)), "x", "y"), "density", digits=10)


# ---- box scores -----------------------------------------------------------------------------------

MEANS = ", ".join(f"round(avg({m}), 6) AS avg_{m}" for m in boxscore.SHOT_METRICS)


@query("player_shot_profile", f"WITH {a.SHOTS} SELECT player_id, {MEANS} FROM shots GROUP BY player_id")
def player_shot_profile(spark, sf):
    profile = boxscore.player_shot_profile(a.shots(spark, sf))
    return rounded(profile, *[f"avg_{m}" for m in boxscore.SHOT_METRICS])


@query(
    "agg_multi_mean",
    f"WITH {a.SHOTS} SELECT player_id, {MEANS}, count(*) AS shots FROM shots GROUP BY player_id",
)
def agg_multi_mean(spark, sf):
    means = [F.round(F.avg(m), 6).alias(f"avg_{m}") for m in boxscore.SHOT_METRICS]
    return a.shots(spark, sf).groupBy("player_id").agg(*means, F.count(F.lit(1)).alias("shots"))


@query(
    "sort_metric_desc",
    f"""WITH {a.SHOTS}, p AS (SELECT player_id, round(avg(dribbles), 6) AS avg_dribbles FROM shots GROUP BY player_id)
    SELECT * FROM p ORDER BY avg_dribbles DESC NULLS LAST, player_id""",
)
def sort_metric_desc(spark, sf):
    return boxscore.ranked_by(player_shot_profile(spark, sf), "avg_dribbles")


@query(
    "select_rename",
    "SELECT l_suppkey AS person_id, l_extendedprice AS shot_distance, l_quantity AS dribble_count FROM lineitem",
)
def select_rename(spark, sf):
    return a.shots(spark, sf).select(
        F.col("player_id").alias("person_id"),
        F.col("shot_dist").alias("shot_distance"),
        F.col("dribbles").alias("dribble_count"),
    )


@query("agg_first_per_group", f"WITH {a.BOX} SELECT * FROM box")
def agg_first_per_group(spark, sf):
    return boxscore.box_scores(a.box_results(spark, sf), a.BOX_ORDER)


EFF = f"""{a.BOX}, e AS (SELECT player_id, round(pts + reb + ast + stl + blk + pfd - ((fga - fgm) + (fta - ftm) + tov), 6) AS eff
    FROM box)"""


@query("efficiency_leaderboard", f"WITH {EFF} SELECT * FROM e ORDER BY eff DESC, player_id LIMIT 10")
def efficiency_leaderboard(spark, sf):
    return boxscore.efficiency_leaderboard(agg_first_per_group(spark, sf))


@query(
    "topk_score",
    f"WITH {a.SHOTS} SELECT player_id, max(shot_dist) AS best FROM shots GROUP BY 1 ORDER BY best DESC, player_id LIMIT 10",
)
def topk_score(spark, sf):
    best = a.shots(spark, sf).groupBy("player_id").agg(F.max("shot_dist").alias("best"))
    return best.orderBy(F.desc("best"), "player_id").limit(10)


@query("computed_columns", f"WITH {EFF} SELECT e.player_id, eff, -pts AS mirrored FROM e JOIN box USING (player_id)")
def computed_columns(spark, sf):
    box = agg_first_per_group(spark, sf)
    mirrored = box.select("player_id", (-F.col("pts")).alias("mirrored"))
    return boxscore.efficiency(box).join(mirrored, "player_id")


@query(
    "fn_abs_round_pow",
    """SELECT event_id, round(abs(value - 10), 2) AS gap, round((value - 10) * (value - 10), 6) AS squared FROM events""",
)
def fn_abs_round_pow(spark, sf):
    off = F.col("value") - 10
    return a.table(spark, sf, "events").select(
        "event_id", F.round(F.abs(off), 2).alias("gap"), F.round(fn.square(off), 6).alias("squared")
    )
