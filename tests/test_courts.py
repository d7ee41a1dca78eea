import json
import math
import random

import numpy as np
import pytest

from rivulet.plans import boxscore, density, movement
from tests.conftest import as_set

TRACK = "game_id long, event_id long, player_id long, moment long, x_loc double, y_loc double, game_clock double, shot_clock double"


def track(spark):
    rng = random.Random(4)
    rows = []
    for p in (-1, 1, 2):
        for m in range(50):
            if p == 2 and m in (10, 11, 30):
                continue  # not tracked then
            clock = None if m == 20 else 24.0 - 0.04 * m
            rows.append((p, m, rng.uniform(0, 90), rng.uniform(0, 50), 720.0 - 0.04 * m, clock))
    return rows, spark.createDataFrame([(1, 2, *r) for r in rows], TRACK).repartition(3)


@pytest.mark.parametrize("chunk", [4, 10_000])
def test_distance_and_speed(spark, chunk):
    rows, mv = track(spark)
    got = {r.player_id: (r.distance, r.mph) for r in movement.distance_and_speed(mv, chunk).collect()}
    for p in (-1, 1, 2):
        at = [(r[2], r[3]) for r in rows if r[0] == p]
        length = sum(math.dist(a, b) for a, b in zip(at, at[1:]))
        assert got[p] == pytest.approx((length, length / (49 * 0.04) * 0.681818))


def test_distances_to_the_focus_player(spark):
    rows, mv = track(spark)
    at = {(r[0], r[1]): (r[2], r[3]) for r in rows}
    near = {(p, m): math.dist(at[p, m], at[2, m]) for p, m in at if p != 2 and (2, m) in at}
    got = {(r.player_id, r.moment): r.dist for r in movement.focus_distances(mv, 2).collect()}
    assert got == pytest.approx(near)
    mean = {r.player_id: (r.moments, r.avg_dist) for r in movement.distance_to_focus(mv, 2).collect()}
    assert mean[1] == pytest.approx((47, np.mean([d for (p, _), d in near.items() if p == 1])))
    lists = movement.distance_lists(mv, 2, 20).where("player_id = 1").orderBy("chunk").collect()
    assert [s.moment for r in lists for s in r.series] == sorted(m for p, m in near if p == 1)


def test_play_mask_drops_missing_clocks_and_ends_are_inside(spark):
    rows, mv = track(spark)
    play = movement.distance_in_play(mv, [(1, -1), (-1, 2)], (718.4, 719.6), (20.0, 24.0))
    moments = {m for m in range(10, 41) if m != 20}
    got = play.collect()
    assert {r.moment for r in got if r.pair == "1:-1"} == moments
    assert {r.moment for r in got if r.pair == "-1:2"} == moments - {10, 11, 30}
    assert as_set(movement.last_distances(play), "pair", "moment") == {("1:-1", 40), ("-1:2", 40)}


def test_events_do_not_run_into_each_other(spark):
    rows = []
    for event, shift in ((1, 0.0), (2, 30.0)):
        for m in (0, 1):
            rows += [(7, event, 1, m, shift, 0.0, 10.0 - m, 5.0), (7, event, 2, m, shift, 1.0, 10.0 - m, 5.0)]
    rows.append((None, None, 1, 0, 5.0, 5.0, 1.0, 1.0))
    mv = spark.createDataFrame(rows, TRACK)
    assert {r.distance for r in movement.travel_distance(mv).collect()} == {0.0}
    near = {(r.game_id, r.event_id, r.player_id): (r.moments, r.avg_dist) for r in movement.distance_to_focus(mv, 2).collect()}
    assert near == {(7, 1, 1): (2, 1.0), (7, 2, 1): (2, 1.0)}
    play = movement.distance_in_play(mv, [(1, 2)], (0, 20), (0, 20))
    assert play.count() == 4 and movement.last_distances(play).count() == 2
    assert movement.distance_lists(mv, 2).count() == 2


def test_payload_with_both_rosters(spark):
    def team(*players):
        return {"players": [{"playerid": i, "firstname": f, "lastname": n, "jersey": j} for i, f, n, j in players]}

    def moment(clock, shot, *entities):
        return [1, 1451606400000, clock, shot, None, [list(e) for e in entities]]

    text = json.dumps(
        {
            "gameid": "x", "home": team((1, "Ann", "A", "7")), "visitor": team((2, "Bo", "B", "00"), (3, "Cy", "C", "5")),
            "moments": [moment(720.0, 24.0, (-1, -1, 1, 2, 3), (10, 1, 4, 5, 0)), moment(719.96, None, (20, 2, 6.5, 7, 0)), [1, 2]],
        }
    )
    raw = spark.createDataFrame([(1, 1, text), (1, 2, text), (2, 1, "{}"), (3, 1, None)], "game_id long, event_id long, payload string")
    events = movement.read_payloads(raw)
    roster = movement.players_with_ball(movement.payload_roster(events))
    assert as_set(roster, "player_id", "player_name", "jersey") == {(1, "Ann A", "7"), (2, "Bo B", "00"), (3, "Cy C", "5"), (-1, "ball", None)}
    flat = movement.flatten_movement(movement.event_moments(events), roster)
    one = {(-1, 0, 720.0, 24.0, 1.0, "ball"), (1, 0, 720.0, 24.0, 4.0, "Ann A"), (2, 1, 719.96, None, 6.5, "Bo B")}
    for event in (1, 2):
        assert as_set(flat.where(f"event_id = {event}"), "player_id", "moment", "game_clock", "shot_clock", "x_loc", "player_name") == one
    assert flat.count() == 6


def test_flattening_names_the_ball(spark):
    moment = "struct<game_clock: double, shot_clock: double, positions: array<array<double>>>"
    ball, man, guest = [-1.0, -1.0, 1.0, 2.0, 3.0], [5.0, 7.0, 4.0, 5.0, 0.0], [5.0, 99.0, 0.0, 0.0, 0.0]
    events = spark.createDataFrame(
        [(1, 1, [(720.0, 24.0, [ball, man]), (719.96, None, [ball, guest])])], f"game_id long, event_id long, moments array<{moment}>"
    )
    roster = spark.createDataFrame([(7, "Ann", "Lee", "12")], "player_id long, first_name string, last_name string, jersey string")
    flat = movement.flatten_movement(movement.event_moments(events), movement.players_with_ball(roster))
    assert as_set(flat, "moment", "player_id", "player_name", "jersey", "x_loc", "shot_clock") == {
        (0, -1, "ball", None, 1.0, 24.0), (0, 7, "Ann Lee", "12", 4.0, 24.0),
        (1, -1, "ball", None, 1.0, None), (1, 99, None, None, 0.0, None),
    }


def points(spark, n=400):
    rng = np.random.default_rng(8)
    xy = np.column_stack([rng.normal(0, 10, n), rng.uniform(-5, 40, n)])
    return xy, spark.createDataFrame([(float(x), float(y)) for x, y in xy], "x double, y double").repartition(5)


def test_kde(spark):
    xy, pts = points(spark)
    x, y = xy.T
    hx, hy = x.std(ddof=1) * len(x) ** (-1 / 6), y.std(ddof=1) * len(y) ** (-1 / 6)
    got = density.density_kde(pts, 7, 5).collect()
    assert len(got) == 35
    for r in got:
        gx, gy = np.linspace(x.min(), x.max(), 7)[r.gx], np.linspace(y.min(), y.max(), 5)[r.gy]
        want = np.exp(-0.5 * (((gx - x) / hx) ** 2 + ((gy - y) / hy) ** 2)).sum() / (len(x) * 2 * np.pi * hx * hy)
        assert (r.x, r.y, r.density) == pytest.approx((gx, gy, want))


@pytest.mark.parametrize("kind", ["spread", "clusters", "line", "far"])
def test_binned_kde_is_within_its_tolerance(spark, kind):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(2, 3000))
    if kind == "clusters":
        x, y = np.r_[x * 0.01, 5.0, x[:50] * 0.01 + 9], np.r_[y * 0.01, -3.0, y[:50] * 0.01]
    elif kind == "line":
        y = x + 1e-3 * y
    elif kind == "far":
        x, y = x + 1e6, y * 1e-5 - 1e3
    pts = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double").repartition(3)
    exact = {(r.gx, r.gy): r.density for r in density.density_kde(pts, 31, 17).collect()}
    for tolerance in (1e-3, 1e-6, 1e-9):
        got = density.density_kde(pts, 31, 17, tolerance=tolerance).collect()
        assert len(got) == 31 * 17
        assert max(abs(r.density - exact[r.gx, r.gy]) for r in got) <= tolerance * max(exact.values())


def test_binning_weights_reproduce_polynomials():
    at = np.random.default_rng(1).random(200) * 9
    node, weights = density._shares(at, 0.25)
    assert np.allclose(weights.sum(axis=0), 1)
    places = (node + density.NODES[:, None]) * 0.25
    for power in range(6):
        assert np.allclose((weights * places**power).sum(axis=0), at**power)
    assert np.abs(weights).sum(axis=0).max() < 1.5


def test_kde_of_a_line_and_of_nothing(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "x double, y double")
    assert density.density_kde(flat, 3, 3).count() == 0
    assert density.density_kde(flat.where("x > 9"), 3, 3).count() == 0
    assert density.density_kde(flat, 3, 3, tolerance=1e-6).count() == 0


def test_hexagons_hold_their_nearest_points(spark):
    xy, pts = points(spark)
    sx = 6.0
    sy = sx * math.sqrt(3)
    centers = [(i * sx, j * sy) for i in range(-9, 9) for j in range(-9, 9)]
    centers += [((i + 0.5) * sx, (j + 0.5) * sy) for i in range(-9, 9) for j in range(-9, 9)]
    want = {}
    for p in xy:
        c = min(centers, key=lambda c: math.dist(c, p))
        key = (round(c[0], 6), round(c[1], 6))
        want[key] = want.get(key, 0) + 1
    got = {(round(r.center_x, 6), round(r.center_y, 6)): r.n for r in density.density_hex(pts, sx).collect()}
    assert got == want


def test_grid_and_marginals(spark):
    pts = spark.createDataFrame([(-0.5, 0.0), (0.0, 0.0), (4.9, 9.9), (5.0, 10.0)], "x double, y double")
    assert as_set(density.density_grid(pts, 5, 10), "cell_x", "cell_y", "n") == {(-1, 0, 1), (0, 0, 2), (1, 1, 1)}
    assert as_set(density.marginal(pts, 5, "x"), "bin", "n") == {(-1, 1), (0, 2), (1, 1)}


def test_shot_profile_skips_missing_values(spark):
    shots = spark.createDataFrame(
        [(1, 2.0, 1.0, 10.0, None), (1, None, 3.0, 20.0, None), (2, 4.0, 0.0, 5.0, 1.0)],
        "player_id long, close_def_dist double, dribbles double, shot_dist double, touch_time double",
    )
    profile = boxscore.player_shot_profile(shots)
    assert as_set(profile, "player_id", "avg_close_def_dist", "avg_dribbles", "avg_touch_time") == {
        (1, 2.0, 2.0, None), (2, 4.0, 0.0, 1.0)
    }
    assert [r.player_id for r in boxscore.ranked_by(profile, "avg_touch_time").collect()] == [2, 1]


def test_efficiency(spark):
    stats = boxscore.BOX_STATS
    first = dict(pts=20.126, reb=5, ast=4, stl=1, blk=1, pfd=3, fta=4, ftm=3, fga=15, fgm=8, tov=2)
    rows = [(1, 1, *[float(first[s]) for s in stats]), (1, 2, *[99.0] * 11), (2, 1, *[0.0] * 11)]
    results = spark.createDataFrame(rows, "player_id long, game long, " + ", ".join(f"{s} double" for s in stats))
    box = boxscore.box_scores(results, ["game"])
    assert as_set(box, "player_id", "pts") == {(1, 20.13), (2, 0.0)}
    board = boxscore.efficiency_leaderboard(box, 10).collect()
    assert board[0].eff == pytest.approx(20.13 + 5 + 4 + 1 + 1 + 3 - 7 - 1 - 2) and board[1].eff == 0.0
