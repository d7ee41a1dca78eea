"""Upper tail probabilities of the F and chi-square distributions for a handful of values.

Used inside the per-series regression task, on a few numbers per series.
"""

from __future__ import annotations

import math

_TINY = 1e-300


def _lentz(term, first: float) -> float:
    """Value of first + a1/(b1 + a2/(b2 + ...)), with ``term(i)`` giving (a_i, b_i)."""
    value = first or _TINY
    c, d = value, 0.0
    for i in range(1, 2000):
        a, b = term(i)
        d = 1.0 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        step = c * d
        value *= step
        if abs(step - 1.0) < 1e-15:
            break
    return value


def chi2_tail(x: float, df: int) -> float:
    """P(X > x) for a chi-square variable with a whole number of degrees of freedom."""
    if not x > 0:
        return 1.0
    half = x / 2.0
    if df % 2 == 0:
        term = tail = math.exp(-half)
        start = 1.0
    else:
        tail = math.erfc(math.sqrt(half))
        term = math.exp(-half) / math.sqrt(math.pi * half)
        start = 0.5
    shape = start
    for _ in range(df // 2 - (1 if df % 2 == 0 else 0)):
        term *= half / shape
        tail += term
        shape += 1.0
    return min(1.0, tail)


def beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_share(1.0 - x, b, a)

    def term(i: int) -> tuple[float, float]:
        m = i // 2
        if i % 2:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(log_front) / (a * _lentz(term, 1.0))


def f_tail(x: float, df1: float, df2: float) -> float:
    """P(X > x) for an F variable."""
    if not x > 0:
        return 1.0
    return beta_share(df2 / (df2 + df1 * x), df2 / 2.0, df1 / 2.0)
