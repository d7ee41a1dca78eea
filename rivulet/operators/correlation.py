"""Pearson correlation of sparse profiles whose absent cells share one fill value.

A profile is a set of (id, key, value) rows with value = observed - fill, so an absent cell counts
as 0; subtracting a constant changes no correlation. With n keys, s = sum and q = sum of squares
of one profile's values and d = sqrt(n*q - s*s), the correlation of u and v is

    sum over shared keys of z_u * z_v  -  a_u * a_v,   z = value * sqrt(n) / d,   a = s / d

so only shared keys need to meet, and pairs without one still get their exact value.

All forms read the profiles several times: pass a table that is written, not a long lineage. A null id is
a profile and a null key is a key like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.operators.relational import join_on_same
from rivulet.session import materialize


def _constant(sums: Column, size: Column) -> Column:
    """Whether a profile is the same everywhere: all cells 0, or every key present with one value."""
    return (sums["q"] == 0) | ((sums["cells"] == size) & (sums["low"] == sums["high"]))


#: Below this share of n*q, n*q - s*s is rounding error: the profile counts as constant.
ROUNDING = 1e-12


def _spread(sums: Column, size: Column) -> Column:
    """d in the formula above; null for a constant profile, one that is nearly so, and one with NaN."""
    n, s, q = size, sums["s"], sums["q"]
    square = n * q - s * s
    known = ~_constant(sums, n) & ~F.isnan(square) & (square > n * q * ROUNDING)
    return F.when(known, F.sqrt(square))


def key_count(profiles: DataFrame) -> Column:
    """The number of different keys, null being one, as a scalar."""
    return profiles.agg(F.countDistinct(F.struct("key")).cast("double")).scalar()


def profile_stats(profiles: DataFrame, size: Column, id_col: str = "id") -> DataFrame:
    """(id, cells, scale, offset) per profile: z = value * scale and a = offset in the formula above,
    both null for a constant profile."""
    sums = profiles.groupBy(id_col).agg(
        F.struct(
            F.sum("value").alias("s"),
            F.sum(F.col("value") * F.col("value")).alias("q"),
            F.count(F.lit(1)).alias("cells"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        ).alias("sums")
    )
    sized = sums.select(id_col, "sums", size.alias("size"))
    spreads = sized.withColumn("d", _spread(F.col("sums"), F.col("size")))
    scale, offset = F.try_divide(F.sqrt("size"), F.col("d")), F.try_divide(F.col("sums.s"), F.col("d"))
    return spreads.select(id_col, "sums.cells", scale.alias("scale"), offset.alias("offset"))


def correlation_with(profiles: DataFrame, target) -> DataFrame:
    """Correlation of every profile with the one profile ``target``: (id, neighbor_id, corr).

    Linear in the number of cells: the target's cells meet the others on the key, and one
    aggregation per profile collects the sums.
    """
    size = key_count(profiles)
    own = profiles.where(F.col("id").eqNullSafe(F.lit(target)))
    facts = [
        F.sum("value").alias("s"),
        F.sum(F.col("value") * F.col("value")).alias("q"),
        F.count(F.lit(1)).alias("cells"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    ]
    shared = F.sum(F.coalesce(F.col("value") * F.col("own_value"), F.lit(0.0))).alias("p")
    meeting = join_on_same(profiles, own.select("key", F.col("value").alias("own_value")), ["key"], "left")
    sums = meeting.groupBy("id").agg(F.struct(*facts).alias("their"), shared)
    mine = own.agg(F.struct(*facts)).scalar()
    both = sums.select("id", "their", "p", mine.alias("mine"), size.alias("size"))

    above = F.col("size") * F.col("p") - F.col("their.s") * F.col("mine.s")
    below = _spread(F.col("their"), F.col("size")) * _spread(F.col("mine"), F.col("size"))
    corr = F.try_divide(above, below)
    return both.select(F.lit(target).alias("id"), F.col("id").alias("neighbor_id"), corr.alias("corr"))


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, start = np.unique(sorted_keys, return_index=True)
    return keys, start, np.diff(np.append(start, len(sorted_keys)))


def multiply_sparse(left, right, shape, chunk: int = 2_000_000) -> np.ndarray:
    """Dense product of two sparse blocks given as (row, key, value) arrays.

    Keys present in much of both blocks go through a matrix product, the others through
    their few matching cells, a bounded number at a time.
    """
    out = np.zeros(shape)
    sides = []
    for row, key, value in (left, right):
        order = np.argsort(key, kind="stable")
        sides.append((row[order], key[order], value[order]))
    (lr, lk, lv), (rr, rk, rv) = sides
    lkeys, lstart, lcount = _runs(lk)
    rkeys, rstart, rcount = _runs(rk)
    shared, li, ri = np.intersect1d(lkeys, rkeys, assume_unique=True, return_indices=True)
    if not len(shared):
        return out
    cost = lcount[li] * rcount[ri]
    heavy = cost * 16 >= shape[0] * shape[1]

    slots = np.full(int(max(lkeys[-1], rkeys[-1])) + 1, -1)
    width = 512
    dense = shared[heavy]
    for at in range(0, len(dense), width):
        part = dense[at : at + width]
        slots[part] = np.arange(len(part))
        a = np.zeros((shape[0], len(part)))
        b = np.zeros((shape[1], len(part)))
        for block, row, key, value in ((a, lr, lk, lv), (b, rr, rk, rv)):
            mine = slots[key] >= 0
            block[row[mine], slots[key[mine]]] = value[mine]
        out += a @ b.T
        slots[part] = -1

    li, ri, cost = li[~heavy], ri[~heavy], cost[~heavy]
    ends = np.cumsum(cost)
    flat = out.reshape(-1)
    at = 0
    while at < len(cost):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + chunk, side="right")))
        pair_key = np.repeat(np.arange(at, stop), cost[at:stop])
        inner = np.arange(len(pair_key)) - np.repeat(ends[at:stop] - cost[at:stop] - base, cost[at:stop])
        n_right = rcount[ri][pair_key]
        l_at = lstart[li][pair_key] + inner // n_right
        r_at = rstart[ri][pair_key] + inner % n_right
        cells = lr[l_at] * shape[1] + rr[r_at]
        flat += np.bincount(cells, weights=lv[l_at] * rv[r_at], minlength=len(flat))
        at = stop
    return out


def _block_products(table: pa.Table) -> pa.Table:
    """Partial correlations of the profiles on the two sides of one block pair and key slice."""
    side = table["side"].to_numpy()
    ids, keys = (table[c].combine_chunks().dictionary_encode(null_encoding="encode") for c in ("id", "key"))
    id_code, key_code = ids.indices.to_numpy(), keys.indices.to_numpy()
    z = table["z"].to_numpy()
    marker = table["marker"].to_numpy()

    views = []
    for other in (1, 0):  # rows of the left side are those not marked right, and the reverse
        mine = side != other
        present, row = np.unique(id_code[mine], return_inverse=True)
        flag = marker[mine]
        cells = (row[~flag], key_code[mine][~flag], z[mine][~flag])
        offset = np.full(len(present), np.nan)
        offset[row[flag]] = z[mine][flag]
        views.append((present, cells, offset))
    (lid, lcells, loff), (rid, rcells, roff) = views
    product = multiply_sparse(lcells, rcells, (len(lid), len(rid)))

    first = bool(marker.any())
    keep = np.ones(product.shape, bool) if first else product != 0
    names = ids.dictionary
    if (side == 2).all():
        # One block with itself: each pair once, in id order so that all slices agree.
        rank = np.empty(len(names), int)
        rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        keep &= rank[lid][:, None] <= rank[rid][None, :]
    if first:
        product = product - np.outer(loff, roff)
    i, j = np.nonzero(keep)
    part = product[i, j]
    return pa.table(
        {
            "id": names.take(pa.array(lid[i])),
            "neighbor_id": names.take(pa.array(rid[j])),
            "part": pa.array(part, mask=np.isnan(part)),
        }
    )


def correlation_matrix(profiles: DataFrame, block: int = 1024, slice_cells: int = 4_000_000) -> DataFrame:
    """Correlation of every profile with every profile, itself included: (id, neighbor_id, corr).

    The result has profiles squared rows; for the best of each profile take ``top_correlations``. Profiles are cut into
    blocks of about ``block`` ids. A task holds two blocks and one slice of the keys and returns summed products, never the
    pairs that meet under a key, so a key shared by everybody costs a matrix product rather than a flood of rows. Slices bound what a task
    reads when a profile or a block is large; they are added up at the end, and a single slice
    needs no addition. Block and slice numbers follow from the sizes of the profiles, whose statistics
    are written first (this runs jobs).
    """
    stats = materialize(profile_stats(profiles, key_count(profiles)), "profile-stats")
    ids = stats.count()
    blocks = max(1, -(-ids // block))
    home = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    largest = stats.groupBy(home.alias("block")).agg(F.sum("cells").alias("cells")).agg(F.max("cells")).first()[0]
    heaviest = 2 * (largest or 0)
    slices = max(1, -(-heaviest // slice_cells))
    if heaviest > max(100_000, (ids / blocks) ** 2):  # few profiles with many cells: sums are few, so more slices cost little
        slices = max(slices, -(-heaviest // 250_000))

    scaled = join_on_same(profiles, stats.select("id", "scale"), ["id"]).select(
        "id", "key", (F.col("value") * F.col("scale")).alias("z"), F.lit(False).alias("marker")
    )
    offsets = stats.select("id", F.lit(None).cast(profiles.schema["key"].dataType).alias("key"), F.col("offset").alias("z"), F.lit(True).alias("marker"))
    rows = scaled.where(F.col("z").isNotNull()).unionByName(offsets)
    rows = rows.select(
        "id",
        "key",
        "z",
        "marker",
        home.alias("mine"),
        F.when(F.col("marker"), 0).otherwise(F.pmod(F.xxhash64("key"), F.lit(slices))).cast("int").alias("slice"),
    )
    paired = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        F.least("mine", "other").alias("low"),
        F.greatest("mine", "other").alias("high"),
        "slice",
        F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"),
        "id",
        "key",
        "z",
        "marker",
    )
    kind = profiles.schema["id"].dataType.simpleString()
    parts = paired.groupBy("low", "high", "slice").applyInArrow(
        _block_products, f"id {kind}, neighbor_id {kind}, part double"
    )
    if slices > 1:
        parts = parts.groupBy("id", "neighbor_id").agg(F.sum("part").alias("part"))
    both = F.when(
        F.col("id").eqNullSafe(F.col("neighbor_id")), F.array(F.struct("id", "neighbor_id"))
    ).otherwise(
        F.array(
            F.struct("id", "neighbor_id"),
            F.struct(F.col("neighbor_id").alias("id"), F.col("id").alias("neighbor_id")),
        )
    )
    return parts.select(F.explode(both).alias("pair"), F.col("part").alias("corr")).select("pair.*", "corr")


#: Correlations that agree in so many digits rank as equal, so that rounding errors of sums do not decide between twins.
RANK_DIGITS = 9


def rank_order(corr: str = "corr", neighbor: str = "neighbor_id") -> list[Column]:
    """Highest first, equal ones (in ``RANK_DIGITS`` digits) in order of the neighbour's id."""
    return [F.round(corr, RANK_DIGITS).desc(), F.asc(neighbor)]


def best_of_each(pairs: DataFrame, k: int, parts: int = 64) -> DataFrame:
    """The ``k`` highest pairs of every id with others in ``rank_order``, unknown ones left out.

    Two rounds, the first over parts of an id's candidates, so that no task sorts all candidates of one id.
    """
    known = pairs.where(~F.col("neighbor_id").eqNullSafe(F.col("id")) & F.col("corr").isNotNull())
    local = Window.partitionBy("id", F.pmod(F.xxhash64("neighbor_id"), F.lit(parts))).orderBy(*rank_order())
    few = known.withColumn("at_", F.row_number().over(local)).where(F.col("at_") <= k)
    return few.withColumn("at_", F.row_number().over(Window.partitionBy("id").orderBy(*rank_order()))).where(F.col("at_") <= k).drop("at_")
