"""The best correlated others of every profile, exactly, without meeting every profile with every other.

Correlations are those of ``correlation``: with z the scaled values and a the offset of a profile, corr(u, v) is the
product of z_u and z_v less a_u * a_v, and the length of z_v is sqrt(1 + a_v * a_v). Where no value is negative, profiles are kept apart by bounds:

* Some pairs that meet under a profile's rarest keys give its threshold: their sums over those keys, less
  the offsets' product, are already lower bounds, and the k-th highest of them is below the k-th best correlation.
* The most frequent keys of a profile are left out of its search as long as nobody could reach the
  threshold by them alone: by Cauchy-Schwarz they add at most the length of what is left out times sqrt(1 + a_v * a_v).
* A profile that shares none of the remaining keys is therefore no candidate, unless it shares nothing at all: of those the best have the smallest
  offsets, and the k + 1 smallest of all profiles, sorted once, suffice for everybody.

Profiles are dealt into blocks, and a profile goes whole to the blocks where a search key of a member occurs in it, not to
every block. A task multiplies one block with a slice of its candidates tile by tile and keeps the k best of each row, ties cut by
id, so what is shuffled is k rows per profile and slice. Where keys are so common that the bounds keep nothing apart, or values
are negative, every block gets every profile; blocks are of a size by cells, so the copies are the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.operators.correlation import RANK_DIGITS, best_of_each, correlation_matrix, key_count, multiply_sparse, profile_stats
from rivulet.operators.ordered import with_position
from rivulet.operators.relational import join_on_same
from rivulet.session import materialize

#: Profiles of a tile of the product.
TILE = 1024
#: Pairs per profile, times k, that a threshold is taken from.
SEEDS = 4
#: More than the rounding of a rank and of the sums behind a bound.
SLACK = 2 * 10.0**-RANK_DIGITS


def top_correlations(profiles: DataFrame, k: int, block_cells: int = 2_000_000, prune: bool | None = None, few: int = TILE) -> DataFrame:
    """The ``k`` highest correlations of every profile with others: (id, neighbor_id, corr), unknown ones left out, ties by id.

    ``profiles`` is (id, key, value). ``prune`` says whether candidates are searched; by default where there are more than
    8 blocks, since below that copies cost less than the search. The result is the same. Up to ``few`` profiles, and all where one has more
    than ``block_cells`` cells, go through ``correlation_matrix``, which cuts profiles by key. Runs jobs.
    """
    known = profile_stats(profiles, key_count(profiles)).where(F.col("scale").isNotNull()).select("id", "scale", "offset", "cells")
    facts = known.agg(
        F.count(F.lit(1)).alias("n"), F.sum("cells").alias("cells"), F.max("cells").alias("most"), F.min("offset").alias("low"), F.max("offset").alias("high")
    ).first()
    if facts["n"] <= few or (facts["most"] or 0) > block_cells:
        return best_of_each(correlation_matrix(profiles), k)
    ids = with_position(known, ["id"], "code")
    slices = max(1, -(-(facts["cells"] or 0) // block_cells))
    # more blocks than slices where that keeps the machine busy; a block is never smaller than some tiles' width
    blocks = max(slices, min(profiles.sparkSession.sparkContext.defaultParallelism, -(-facts["n"] // 128)))
    if prune is None:
        prune = slices > 8
    keys = materialize(profiles.groupBy("key").agg(F.count(F.lit(1)).alias("among")).withColumn("at", F.monotonically_increasing_id()), "similarity-keys")
    cells = join_on_same(join_on_same(profiles, ids, ["id"]), keys, ["key"]).select("code", "offset", "at", "among", "value", (F.col("value") * F.col("scale")).alias("z"))
    whole = materialize(
        cells.groupBy("code", "offset").agg(F.min("value").alias("least"), F.collect_list(F.struct("at", "z", "among")).alias("cells")), "similarity-profiles"
    )
    block = F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    if prune and whole.agg(F.min("least")).first()[0] >= 0:
        meeting = _candidates(whole, k, block, everywhere, facts["low"], facts["high"])
        right = whole.join(meeting, "code")
    else:
        right = whole.withColumn("block", everywhere)
    right = right.withColumn("slice", F.pmod(F.xxhash64("code", F.lit("slice")), F.lit(slices)).cast("int"))
    left = whole.withColumn("block", block).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    columns = ["block", "slice", "code", "offset", F.col("cells.at").alias("keys"), F.col("cells.z").alias("z")]
    sides = left.select(F.lit(True).alias("member"), *columns).unionByName(right.select(F.lit(False).alias("member"), *columns))

    def multiply(table: pa.Table) -> pa.Table:
        return best_of_block(table, k)

    found = sides.groupBy("block", "slice").applyInArrow(multiply, "id long, neighbor_id long, corr double")
    best = found if slices == 1 else best_of_each(found, k)
    return _named(best, ids)


def _named(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """``pairs`` of codes with the ids that they stand for."""
    mine = ids.select(F.col("code").alias("id"), F.col("id").alias("mine"))
    theirs = ids.select(F.col("code").alias("neighbor_id"), F.col("id").alias("theirs"))
    return pairs.join(mine, "id").join(theirs, "neighbor_id").select(F.col("mine").alias("id"), F.col("theirs").alias("neighbor_id"), "corr")


def _candidates(whole: DataFrame, k: int, block: Column, everywhere: Column, low: float, high: float) -> DataFrame:
    """(code, block): the blocks to which each profile must go."""
    flat = whole.select("code", "offset", F.explode("cells").alias("cell")).select("code", "offset", "cell.*")
    searched = whole.join(_thresholds(whole, flat, k), "code", "left")
    kinds = "block int, at long"

    def needed(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tables:
            parts = [
                np.stack((np.full(len(at), home), at))
                for home, offset, threshold, at, z, among in _unpacked(rows)
                for at in (search_keys(at, z, among, offset, threshold, low, high),)
            ]
            pairs = np.unique(np.concatenate([*parts, np.empty((2, 0), np.int64)], axis=1).astype(np.int64), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int32()), pa.array(pairs[1])], ["block", "at"])

    needs = searched.select(block.alias("block"), "offset", "threshold", "cells").mapInArrow(needed, kinds).distinct()
    by_key = needs.join(flat.select("code", "at"), "at").select("code", "block").distinct()
    least = whole.orderBy("offset", "code").limit(k + 1).select("code", everywhere.alias("block"))
    return by_key.union(least).distinct()


def _unpacked(rows: pa.RecordBatch) -> Iterator[tuple]:
    """block, offset, threshold, keys, z and frequencies of each profile of a batch."""
    cells = rows["cells"]
    flat, borders = cells.flatten(), np.concatenate(([0], np.cumsum(cells.value_lengths().to_numpy())))
    at, z, among = (flat.field(c).to_numpy() for c in ("at", "z", "among"))
    for i, (home, offset, threshold) in enumerate(zip(rows["block"].to_pylist(), rows["offset"].to_pylist(), rows["threshold"].to_pylist())):
        mine = slice(borders[i], borders[i + 1])
        yield home, offset, threshold, at[mine], z[mine], among[mine]


def search_keys(at: np.ndarray, z: np.ndarray, among: np.ndarray, offset: float, threshold: float | None, low: float, high: float) -> np.ndarray:
    """The keys by which a profile must look for others: all but the most frequent ones that cannot reach its threshold.

    ``low`` and ``high`` are the least and largest offsets. The bound is convex in the other's offset, so one of these is the worst case.
    """
    if threshold is None:
        return at
    order = np.lexsort((at, -among))
    left_out = np.sqrt(np.cumsum(np.square(z[order])))
    most = np.maximum(left_out * np.hypot(1, low) - offset * low, left_out * np.hypot(1, high) - offset * high)
    return at[order[np.searchsorted(most, threshold - SLACK) :]]


def _thresholds(whole: DataFrame, flat: DataFrame, k: int) -> DataFrame:
    """(code, threshold): a value that the k-th best correlation of a profile reaches; profiles with fewer pairs are absent.

    A profile takes its rarest keys until the others that have them are ``SEEDS * k``, so there are no more pairs than that per profile.
    """

    def rarest(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tables:
            cells = rows["cells"]
            flat, lengths = cells.flatten(), cells.value_lengths().to_numpy()
            at, z, among = (flat.field(c).to_numpy() for c in ("at", "z", "among"))
            row = np.repeat(np.arange(len(lengths)), lengths)
            order = np.lexsort((at, among, row))
            others = np.cumsum(among[order] - 1)
            before = np.concatenate(([0], others))[np.cumsum(lengths) - lengths]
            taken = order[(others - before[row] <= SEEDS * k) & (among[order] > 1)]
            mine = [rows[c].to_numpy()[row[taken]] for c in ("code", "offset")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*mine, at[taken], z[taken])], ["code", "offset", "at", "z"])

    seeds = whole.select("code", "offset", "cells").mapInArrow(rarest, "code long, offset double, at long, z double")
    theirs = flat.select("at", F.col("code").alias("other"), F.col("offset").alias("their_offset"), F.col("z").alias("their_z"))
    pairs = seeds.join(theirs, "at").where("code <> other").groupBy("code", "other", "offset", "their_offset").agg(F.sum(F.col("z") * F.col("their_z")).alias("product"))
    bounds = pairs.groupBy("code").agg(F.sort_array(F.collect_list(F.col("product") - F.col("offset") * F.col("their_offset")), asc=False).alias("bounds"))
    return bounds.select("code", F.get("bounds", F.lit(k - 1)).alias("threshold")).where("threshold IS NOT NULL")


# ---- one task


def best_of_block(table: pa.Table, k: int) -> pa.Table:
    """The ``k`` best among the others of a block's candidates for every member, tile by tile."""
    member = table["member"].to_numpy()
    left, right = (_profiles(table.filter(pa.array(side))) for side in (member, ~member))
    # the product wants small key numbers
    codes = np.unique(np.concatenate((left[4], right[4])), return_inverse=True)[1]
    left, right = ((*side[:4], keys, side[5]) for side, keys in ((left, codes[: len(left[4])]), (right, codes[len(left[4]) :])))
    ids, others, scores = [], [], []
    for rows, row_ids, row_offsets in _tiles(left):
        best_id, best_corr = np.empty((len(row_ids), 0), np.int64), np.empty((len(row_ids), 0))
        for cells, col_ids, col_offsets in _tiles(right):
            corr = multiply_sparse(rows, cells, (len(row_ids), len(col_ids))) - np.outer(row_offsets, col_offsets)
            corr[row_ids[:, None] == col_ids[None, :]] = -np.inf
            best_id, best_corr = _merged(best_id, best_corr, np.broadcast_to(col_ids, corr.shape), corr, k)
        kept = best_corr > -np.inf
        ids.append(np.broadcast_to(row_ids[:, None], kept.shape)[kept])
        others.append(best_id[kept])
        scores.append(best_corr[kept])
    empty = [np.empty(0, np.int64)]
    return pa.table(
        {"id": np.concatenate(ids + empty), "neighbor_id": np.concatenate(others + empty), "corr": np.concatenate([*scores, np.empty(0)])}
    )


def _profiles(table: pa.Table) -> tuple[np.ndarray, ...]:
    """code, offset, first cell and end cell of each profile in order of code, keys and values of all cells."""
    table = table.sort_by("code").combine_chunks()
    lengths = np.concatenate([c.value_lengths().to_numpy() for c in table["keys"].chunks] or [np.empty(0, np.int64)]).astype(np.int64)
    ends = np.cumsum(lengths)
    keys, z = (np.concatenate([c.flatten().to_numpy() for c in table[name].chunks] or [np.empty(0)]) for name in ("keys", "z"))
    return table["code"].to_numpy(), table["offset"].to_numpy(), ends - lengths, ends, keys, z


def _tiles(side: tuple[np.ndarray, ...]) -> Iterator[tuple]:
    code, offset, first, end, keys, z = side
    for at in range(0, len(code), TILE):
        to = min(at + TILE, len(code))
        cells = slice(first[at], end[to - 1])
        row = np.repeat(np.arange(to - at), end[at:to] - first[at:to])
        yield (row, keys[cells], z[cells]), code[at:to], offset[at:to]


def _merged(ids: np.ndarray, corr: np.ndarray, more_ids: np.ndarray, more: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of each row of two tables, equal ones (rounded) by id; the ids of the second are ascending and larger."""
    ranked = np.round(more, RANK_DIGITS)
    if more.shape[1] > k:
        least = -np.partition(-ranked, k - 1, axis=1)[:, k - 1 : k]
        # of those that tie with the k-th only the first ids are taken
        above, equal = ranked > least, ranked == least
        keep = above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        row, col = np.nonzero(keep)
        col = col.reshape(len(more), k)
        more_ids, more = np.take_along_axis(more_ids, col, 1), np.take_along_axis(more, col, 1)
    ids, corr = np.concatenate((ids, more_ids), axis=1), np.concatenate((corr, more), axis=1)
    order = np.lexsort((ids, -np.round(corr, RANK_DIGITS)), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(corr, order, 1)
