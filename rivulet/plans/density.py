"""Two-dimensional densities of points: rectangular cells, hexagonal cells, Gaussian kernels."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.functions.numbers import nearest
from rivulet.operators.ordered import min_max_scaled
from rivulet.operators.relational import count_per_key


def density_grid(pts: DataFrame, dx: float, dy: float, x: str = "x", y: str = "y") -> DataFrame:
    """Points per cell of a dx by dy grid: (cell_x, cell_y, n)."""
    cells = pts.select(
        F.floor(F.col(x) / dx).alias("cell_x"), F.floor(F.col(y) / dy).alias("cell_y")
    )
    return count_per_key(cells, "cell_x", "cell_y")


def marginal(pts: DataFrame, width: float, column: str) -> DataFrame:
    """Histogram of one coordinate: (bin, n)."""
    return count_per_key(pts.select(F.floor(F.col(column) / width).alias("bin")), "bin")


def density_hex(pts: DataFrame, sx: float, x: str = "x", y: str = "y") -> DataFrame:
    """Points per hexagon of width ``sx``: (lattice, cell_x, cell_y, center_x, center_y, n).

    Hexagon centres form two rectangular lattices of sx by sx*sqrt(3), the second shifted by half
    a cell; a point belongs to the nearer of its two candidate centres.
    """
    sy = sx * math.sqrt(3.0)
    u, v = F.col(x) / sx, F.col(y) / sy
    i1, j1 = nearest(u), nearest(v)
    i2, j2 = F.floor(u), F.floor(v)
    d1 = (u - i1) * (u - i1) + 3 * (v - j1) * (v - j1)
    d2 = (u - i2 - 0.5) * (u - i2 - 0.5) + 3 * (v - j2 - 0.5) * (v - j2 - 0.5)
    cells = pts.select(
        F.when(d1 <= d2, 1).otherwise(2).alias("lattice"),
        F.when(d1 <= d2, i1).otherwise(i2).alias("cell_x"),
        F.when(d1 <= d2, j1).otherwise(j2).alias("cell_y"),
    )
    shift = F.when(F.col("lattice") == 1, 0.0).otherwise(0.5)
    return count_per_key(cells, "lattice", "cell_x", "cell_y").withColumns(
        {"center_x": (F.col("cell_x") + shift) * sx, "center_y": (F.col("cell_y") + shift) * sy}
    )


#: Fine nodes around a point that share its weight, and the bound of what that changes in a kernel of height 1 whose
#: nodes are r bandwidths apart: r**6 times the largest node product (2.5 * 1.5 * 0.5)**2 over 6!, times 15, the largest sixth derivative; for
#: the second axis once more, times the largest sum of absolute weights, below 1.5.
NODES = np.arange(-2, 4)
BINNING = (2.5 * 1.5 * 0.5) ** 2 / 720 * 15 * (1 + 1.5)
#: Fine cells that a task holds at most.
MOST_CELLS = 1 << 22


def fine_step(tolerance: float, u_span: float, v_span: float) -> float:
    """Distance of fine nodes, in bandwidths, that keeps every density within ``tolerance`` of the highest one.

    Of the whole mass at least 0.99 lies within 4 bandwidths of the data's range, so the highest density is at least
    that over the area, in units of a single point's peak 2 pi times as much.
    """
    highest = 0.99 * 2 * math.pi / ((u_span + 8) * (v_span + 8))
    return (tolerance * highest / BINNING) ** (1 / 6)


def _shares(at: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
    """First fine node left of each place, and the weights of the nodes around it, one row per node."""
    node = np.floor(at / step)
    t = at / step - node
    weights = [np.prod([(t - other) / (own - other) for other in NODES if other != own], axis=0) for own in NODES]
    return node.astype(np.int64), np.stack(weights)


def density_kde(pts: DataFrame, nx: int = 50, ny: int = 50, x: str = "x", y: str = "y", tolerance: float | None = None) -> DataFrame:
    """Gaussian kernel density on an nx by ny grid over the data's range: (gx, gy, x, y, density).

    Bandwidths follow Scott's rule per axis, sd * n**(-1/6). The kernel is a product of its two
    axes, so a batch of points adds one small matrix product to the grid; each task returns
    one partial grid, and only those are shuffled. Points are never paired with cells as rows.

    With ``tolerance`` a point is shared out to the 36 fine nodes around it, and each task multiplies its fine grid once by the two
    kernels, so the cost of a point does not depend on the grid. Densities are then within ``tolerance`` of the highest one (see
    ``fine_step``). Where that takes more than ``MOST_CELLS`` fine cells the product is exact.
    """
    known = pts.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    )
    facts = known.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.min("x").alias("x0"),
            F.max("x").alias("x1"),
            F.min("y").alias("y0"),
            F.max("y").alias("y1"),
            (F.stddev_samp("x") * F.pow(F.count(F.lit(1)), -1 / 6)).alias("hx"),
            (F.stddev_samp("y") * F.pow(F.count(F.lit(1)), -1 / 6)).alias("hy"),
        )
    ).scalar()

    # Everything in units of the bandwidth, counted from the lower corner of the grid.
    f = {name: F.col(f"facts.{name}") for name in ("n", "x0", "x1", "y0", "y1", "hx", "hy")}
    scaled = known.withColumn("facts", facts).select(
        F.try_divide(F.col("x") - f["x0"], f["hx"]).alias("u"),
        F.try_divide(F.col("y") - f["y0"], f["hy"]).alias("v"),
        F.try_divide(f["x1"] - f["x0"], f["hx"]).alias("u_span"),
        F.try_divide(f["y1"] - f["y0"], f["hy"]).alias("v_span"),
    ).where(F.col("u").isNotNull() & F.col("v").isNotNull())

    def kernel(steps: int, span: float, at: np.ndarray) -> np.ndarray:
        gap = np.linspace(0.0, span, steps)[:, None] - at[None, :]
        return np.exp(-0.5 * gap * gap)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = fine = None
        for batch in batches:
            if not batch.num_rows:
                continue
            u, v, u_span, v_span = (c.to_numpy() for c in batch.columns)
            spans = u_span[0], v_span[0]
            step = None if tolerance is None else fine_step(tolerance, *spans)
            shape = None if step is None else tuple(int(s / step) + len(NODES) + 1 for s in spans)
            if shape is None or shape[0] * shape[1] > MOST_CELLS:
                part = kernel(nx, spans[0], u) @ kernel(ny, spans[1], v).T
                grid = part if grid is None else grid + part
                continue
            (i, wu), (j, wv) = _shares(u, step), _shares(v, step)
            rows, columns = (at - NODES[0] + NODES[:, None] for at in (i, j))
            cells = rows[:, None, :] * shape[1] + columns[None, :, :]
            shares = np.bincount(cells.ravel(), (wu[:, None, :] * wv[None, :, :]).ravel(), shape[0] * shape[1])
            fine = shares if fine is None else fine + shares
        if fine is not None:
            nodes = [(np.arange(n) + NODES[0]) * step for n in shape]
            grid = kernel(nx, spans[0], nodes[0]) @ fine.reshape(shape) @ kernel(ny, spans[1], nodes[1]).T
        if grid is not None:
            gx, gy = np.meshgrid(np.arange(nx), np.arange(ny), indexing="ij")
            yield pa.RecordBatch.from_arrays(
                [pa.array(gx.ravel()), pa.array(gy.ravel()), pa.array(grid.ravel())], ["gx", "gy", "part"]
            )

    cells = scaled.mapInArrow(partial, "gx long, gy long, part double")
    sums = cells.groupBy("gx", "gy").agg(F.sum("part").alias("total"))
    return sums.withColumn("facts", facts).select(
        "gx",
        "gy",
        (f["x0"] + F.col("gx") * (f["x1"] - f["x0"]) / F.lit(max(nx - 1, 1))).alias("x"),
        (f["y0"] + F.col("gy") * (f["y1"] - f["y0"]) / F.lit(max(ny - 1, 1))).alias("y"),
        (F.col("total") / (f["n"] * F.lit(2 * math.pi) * f["hx"] * f["hy"])).alias("density"),
    )


def density_kde_scaled(series: DataFrame, nx: int = 50, ny: int = 50, x: str = "value", y: str = "index") -> DataFrame:
    """``density_kde`` of two columns that are first mapped to 0..1 each."""
    return density_kde(min_max_scaled(series, [x, y]), nx, ny, x, y)
