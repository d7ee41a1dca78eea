"""Player tracking: flattening, distances, speed and distances within a play.

Positions belong to an event of a game: every table has the columns of ``EVENT``, moments are numbered per
event, and nothing is compared or added up across events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.numbers import distance, to_mph
from rivulet.functions.text import full_name
from rivulet.operators.ordered import lag_columns, with_lags
from rivulet.operators.relational import join_on_same

# Fixed value: the id under which the ball is tracked.
BALL = -1
EVENT = ["game_id", "event_id"]


def players_with_ball(players: DataFrame) -> DataFrame:
    """(player_id, player_name, jersey) from a roster with first and last names, plus the ball."""
    named = players.select(
        "player_id", full_name(F.col("first_name"), F.col("last_name")).alias("player_name"), "jersey"
    )
    kind = {f.name: f.dataType for f in named.schema}
    ball = players.sparkSession.range(1).select(
        F.lit(BALL).cast(kind["player_id"]).alias("player_id"),
        F.lit("ball").alias("player_name"),
        F.lit(None).cast(kind["jersey"]).alias("jersey"),
    )
    return named.unionByName(ball)


# Fixed form of a tracking payload: clocks and entities stand at these places of a moment.
GAME_CLOCK_AT, SHOT_CLOCK_AT, ENTITIES_AT = 2, 3, 5
_TEAM = "struct<players: array<struct<playerid: bigint, firstname: string, lastname: string, jersey: string>>>"
_PAYLOAD = f"home {_TEAM}, visitor {_TEAM}, moments array<array<string>>"


def read_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """(*EVENT, home, visitor, moments) from one JSON text per event; moments are arrays of
    struct(game_clock, shot_clock, positions)."""
    parsed = payloads.select(*EVENT, F.from_json(payload, _PAYLOAD).alias("p")).select(*EVENT, "p.*")

    def moment(m: Column) -> Column:
        return F.struct(
            F.get(m, F.lit(GAME_CLOCK_AT)).try_cast("double").alias("game_clock"),
            F.get(m, F.lit(SHOT_CLOCK_AT)).try_cast("double").alias("shot_clock"),
            F.from_json(F.get(m, F.lit(ENTITIES_AT)), "array<array<double>>").alias("positions"),
        )

    return parsed.withColumn("moments", F.transform("moments", moment))


def payload_roster(events: DataFrame) -> DataFrame:
    """(player_id, first_name, last_name, jersey) of both teams of all events, each player once."""
    both = events.select(F.explode(F.concat(*[F.coalesce(f"{t}.players", F.array()) for t in ("home", "visitor")])).alias("p"))
    first = [F.min(f"p.{c}").alias(name) for c, name in (("firstname", "first_name"), ("lastname", "last_name"), ("jersey", "jersey"))]
    return both.groupBy(F.col("p.playerid").alias("player_id")).agg(*first)


def moment_positions(payload: DataFrame) -> DataFrame:
    """One row per tracked entity and moment, from one row per moment.

    ``payload`` has (*EVENT, moment, game_clock, shot_clock, positions), positions being arrays of
    [team_id, player_id, x, y, radius].
    """
    entity = F.explode("positions").alias("p")
    flat = payload.select(*EVENT, "moment", "game_clock", "shot_clock", entity)
    return flat.select(
        *EVENT,
        F.get("p", F.lit(0)).cast("long").alias("team_id"),
        F.get("p", F.lit(1)).cast("long").alias("player_id"),
        F.get("p", F.lit(2)).alias("x_loc"),
        F.get("p", F.lit(3)).alias("y_loc"),
        F.get("p", F.lit(4)).alias("radius"),
        "moment",
        "game_clock",
        "shot_clock",
    )


def event_moments(events: DataFrame, moments: str = "moments") -> DataFrame:
    """One row per moment of events held as an array of moments, each a
    struct with game_clock, shot_clock and positions; moments are numbered from 0 in each event."""
    numbered = events.select(*EVENT, F.posexplode(moments).alias("moment", "m"))
    return numbered.select(
        *EVENT, F.col("moment").cast("long").alias("moment"), "m.game_clock", "m.shot_clock", "m.positions"
    )


def flatten_movement(payload: DataFrame, players: DataFrame) -> DataFrame:
    """``moment_positions`` with player name and jersey; unknown players keep nulls."""
    return moment_positions(payload).join(players, "player_id", "left")


def steps(mv: DataFrame, chunk_moments: int = 10_000) -> DataFrame:
    """Every position with the distance from the entity's previous one in the event, null for its first."""
    chunk = F.floor(F.col("moment") / chunk_moments)
    rows = mv.select(*EVENT, "player_id", "moment", "x_loc", "y_loc")
    lags = with_lags(rows, [*EVENT, "player_id"], "moment", ["x_loc", "y_loc"], 1, chunk)
    return lag_columns(lags, ["x_loc", "y_loc"], 1).select(
        *EVENT,
        "player_id",
        "moment",
        (F.col("x_loc") - F.col("x_loc_lag1")).alias("dx"),
        (F.col("y_loc") - F.col("y_loc_lag1")).alias("dy"),
        distance(F.col("x_loc"), F.col("y_loc"), F.col("x_loc_lag1"), F.col("y_loc_lag1")).alias("step"),
    )


def travel_distance(mv: DataFrame, chunk_moments: int = 10_000) -> DataFrame:
    """Length of each entity's path in feet: (*EVENT, player_id, distance)."""
    total = F.coalesce(F.sum("step"), F.lit(0.0))
    return steps(mv, chunk_moments).groupBy(*EVENT, "player_id").agg(total.alias("distance"))


def distance_and_speed(mv: DataFrame, chunk_moments: int = 10_000) -> DataFrame:
    """(*EVENT, player_id, distance, mph): path length and average speed over the whole event."""
    seconds = mv.groupBy(*EVENT).agg((F.max("game_clock") - F.min("game_clock")).alias("seconds"))
    speed = to_mph(F.try_divide(F.col("distance"), F.col("seconds")))
    return join_on_same(travel_distance(mv, chunk_moments), seconds, EVENT).withColumn("mph", speed).drop("seconds")


def focus_distances(mv: DataFrame, focus: int) -> DataFrame:
    """Distance of every other entity to the focus player at each moment both are tracked."""
    near = mv.where(F.col("player_id") == focus).select(*EVENT, "moment", F.col("x_loc").alias("bx"), F.col("y_loc").alias("by"))
    both = join_on_same(mv.where(F.col("player_id") != focus), near, [*EVENT, "moment"])
    gap = distance(F.col("x_loc"), F.col("y_loc"), F.col("bx"), F.col("by"))
    return both.select(*EVENT, "player_id", "moment", "shot_clock", gap.alias("dist"))


def distance_to_focus(mv: DataFrame, focus: int) -> DataFrame:
    """Average distance to the focus player: (*EVENT, player_id, moments, avg_dist)."""
    return focus_distances(mv, focus).groupBy(*EVENT, "player_id").agg(
        F.count(F.lit(1)).alias("moments"), F.avg("dist").alias("avg_dist")
    )


def distance_lists(mv: DataFrame, focus: int, chunk_moments: int = 1000) -> DataFrame:
    """The distances to the focus player as lists in moment order: (*EVENT, player_id, chunk, series).

    A list covers at most ``chunk_moments`` moments of one event, so long recordings give several.
    """
    rows = focus_distances(mv, focus).withColumn("chunk", F.floor(F.col("moment") / chunk_moments))
    return rows.groupBy(*EVENT, "player_id", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("moment", "dist"))).alias("series")
    )


def in_play(game_range: tuple[float, float], shot_range: tuple[float, float]) -> Column:
    """Both clocks within closed ranges; a missing clock is outside."""
    return F.col("game_clock").between(*game_range) & F.col("shot_clock").between(*shot_range)


def distance_in_play(
    mv: DataFrame,
    pairs: Sequence[tuple[int, int]],
    game_range: tuple[float, float] = (196.0, 209.0),
    shot_range: tuple[float, float] = (7.7, 20.4),
) -> DataFrame:
    """Distance of chosen pairs at each moment of a play: (*EVENT, pair, moment, shot_clock, dist).

    The wanted positions of a moment are brought together once, and all pairs are taken from that row.
    """
    wanted = sorted({p for pair in pairs for p in pair})
    play = mv.where(in_play(game_range, shot_range) & F.col("player_id").isin(wanted))
    seen = play.groupBy(*EVENT, "moment").agg(F.collect_list(F.struct("player_id", "shot_clock", "x_loc", "y_loc")).alias("seen"))

    def of(player: int) -> Column:
        return F.filter("seen", lambda row: row["player_id"] == player)

    meeting = [
        F.transform(
            F.flatten(F.transform(of(a), lambda left: F.transform(of(b), lambda right: F.struct(left.alias("left"), right.alias("right"))))),
            lambda both: F.struct(F.lit(f"{a}:{b}").alias("pair"), both["left"].alias("left"), both["right"].alias("right")),
        )
        for a, b in pairs
    ]
    met = seen.select(*EVENT, "moment", F.explode(F.concat(*meeting)).alias("met")).select(*EVENT, "moment", "met.*")
    gap = distance(F.col("left.x_loc"), F.col("left.y_loc"), F.col("right.x_loc"), F.col("right.y_loc"))
    return met.select(*EVENT, "pair", "moment", F.col("left.shot_clock").alias("shot_clock"), gap.alias("dist"))


def last_distances(play: DataFrame) -> DataFrame:
    """The last distance of each pair, where its label goes: (*EVENT, pair, moment, dist)."""
    return play.groupBy(*EVENT, "pair").agg(F.max("moment").alias("moment"), F.max_by("dist", "moment").alias("dist"))
