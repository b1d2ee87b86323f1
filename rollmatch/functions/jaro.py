"""Jaro similarity (1 - Jaro distance), the one text comparison Spark lacks.

Definition built here: match window ``max(floor(max(la, lb) / 2) - 1, 0)``; walk
the shorter text, matching each character to the first unused equal character
of the other text inside the window; ``m`` matches; ``k`` matched characters out
of order; ``t`` transpositions; similarity ``(m/la + m/lb + (m - t)/m) / 3`` and 0
when ``m = 0``.

``transpositions``:
  * ``"half"``  ``t = k / 2`` (the published definition; library default);
  * ``"floor"`` ``t = floor(k / 2)`` (what DuckDB's ``jaro_similarity`` computes).

Two empty texts score 1 under ``"half"`` and 0 under ``"floor"``.

Equal texts are decided in the JVM, and for the ``< threshold`` flag the length bound
``Jaro <= (2 + min/max) / 3`` decides every pair whose length ratio is too small. The
district measures send only distinct undecided pairs to Python (``operators.measures``);
the UDF scores a whole batch of pairs at once.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

VARIANTS = ("half", "floor")


def jaro(a: str, b: str, transpositions: str = "half", prefix_weight: float = 0.0) -> float:
    """Plain-Python Jaro similarity for one pair (the tests hold the vectorized one against it).

    ``prefix_weight`` > 0 gives the Winkler variant: ``sim + l * p * (1 - sim)`` with
    ``l`` the common prefix length, at most 4 (``p`` at most 0.25). Default 0: plain Jaro.
    """
    sim = _jaro(a, b, transpositions)
    if prefix_weight:
        n = 0
        for x, y in zip(a[:4], b[:4]):
            if x != y:
                break
            n += 1
        sim += n * prefix_weight * (1.0 - sim)
    return sim


def _jaro(a: str, b: str, transpositions: str) -> float:
    if a == b:
        if a:
            return 1.0
        return 1.0 if transpositions == "half" else 0.0
    la, lb = len(a), len(b)
    if la == 0 or lb == 0:
        return 0.0
    if la > lb:
        a, b, la, lb = b, a, lb, la
    window = max(lb // 2 - 1, 0)
    used = [False] * lb
    a_matched = []
    for i, ch in enumerate(a):
        lo = i - window if i > window else 0
        hi = min(lb, i + window + 1)
        for j in range(lo, hi):
            if not used[j] and b[j] == ch:
                used[j] = True
                a_matched.append(ch)
                break
    m = len(a_matched)
    if m == 0:
        return 0.0
    k = 0
    pos = 0
    for j in range(lb):
        if used[j]:
            if b[j] != a_matched[pos]:
                k += 1
            pos += 1
    t = k // 2 if transpositions == "floor" else k / 2
    return (m / la + m / lb + (m - t) / m) / 3.0


def _padded(texts: list[str], width: int, pad: int) -> np.ndarray:
    out = np.full((len(texts), width), pad, np.int32)
    for i, t in enumerate(texts):
        out[i, :len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def jaro_batch(a: list[str], b: list[str], transpositions: str = "half", prefix_weight: float = 0.0) -> np.ndarray:
    """Jaro similarity of many pairs at once: one step per character position, over all pairs."""
    swap = [len(x) > len(y) for x, y in zip(a, b)]
    a, b = [y if s else x for x, y, s in zip(a, b, swap)], [x if s else y for x, y, s in zip(a, b, swap)]
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    wide_a, wide_b = int(la.max(initial=0)), int(lb.max(initial=0))
    if not wide_a:
        same = (la == 0) & (lb == 0)
        return np.where(same & (transpositions == "half"), 1.0, 0.0)
    x, y = _padded(a, wide_a, -1), _padded(b, wide_b, -2)
    window = np.maximum(lb // 2 - 1, 0)[:, None]
    place, rows = np.arange(wide_b)[None, :], np.arange(len(a))
    free, hit = np.ones(y.shape, bool), np.zeros(x.shape, bool)
    for i in range(wide_a):
        fits = (y == x[:, i:i + 1]) & free & (np.abs(place - i) <= window)
        first = fits.argmax(axis=1)
        hit[:, i] = fits[rows, first]
        free[rows, first] &= ~hit[:, i]
    m = hit.sum(axis=1)
    # the k-th matched character of one text against the k-th of the other
    in_a, in_b = np.full(x.shape, -1, np.int32), np.full(x.shape, -1, np.int32)
    r, c = np.nonzero(hit)
    in_a[r, hit.cumsum(axis=1)[r, c] - 1] = x[r, c]
    used = ~free
    r, c = np.nonzero(used)
    in_b[r, used.cumsum(axis=1)[r, c] - 1] = y[r, c]
    k = (in_a != in_b).sum(axis=1)
    t = k // 2 if transpositions == "floor" else k / 2
    some = np.maximum(m, 1)
    sim = np.where(m > 0, (m / np.maximum(la, 1) + m / np.maximum(lb, 1) + (m - t) / some) / 3.0, 0.0)
    if transpositions == "half":
        sim = np.where((la == 0) & (lb == 0), 1.0, sim)
    if prefix_weight:
        n = min(4, wide_a)
        prefix = np.cumprod(x[:, :n] == y[:, :n], axis=1).sum(axis=1)
        sim = sim + prefix * prefix_weight * (1.0 - sim)
    return sim


def _series_jaro(transpositions: str, prefix_weight: float, cells: int = 2_000_000):
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.full(len(a), np.nan)
        known = np.flatnonzero((a.notna() & b.notna()).to_numpy())
        known = known[np.argsort([max(len(a.iloc[i]), len(b.iloc[i])) for i in known], kind="stable")] if len(known) else known
        at = len(known)
        while at:  # longest first, in parts of about ``cells`` characters
            width = max(1, len(a.iloc[known[at - 1]]), len(b.iloc[known[at - 1]]))
            part = known[max(0, at - max(1, cells // width)):at]
            out[part] = jaro_batch([a.iloc[i] for i in part], [b.iloc[i] for i in part], transpositions, prefix_weight)
            at -= len(part)
        return pd.Series(out).where(pd.Series(~np.isnan(out)), None).astype("float64")

    return score


_UDFS: dict = {}


def _udf(transpositions: str, prefix_weight: float):
    if transpositions not in VARIANTS:
        raise ValueError(f"transpositions must be one of {VARIANTS}")
    if not 0.0 <= prefix_weight <= 0.25:
        raise ValueError("prefix_weight must be in [0, 0.25]")
    key = (transpositions, float(prefix_weight))
    if key not in _UDFS:
        _UDFS[key] = F.pandas_udf(_series_jaro(transpositions, float(prefix_weight)), DoubleType())
    return _UDFS[key]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jaro_similarity(a, b, transpositions: str = "half", prefix_weight: float = 0.0) -> Column:
    """Jaro similarity of two text columns; NULL if either is NULL."""
    udf = _udf(transpositions, prefix_weight)
    a, b = _c(a), _c(b)
    same = (a == b) & (F.length(a) > 0)
    undecided = a.isNotNull() & b.isNotNull() & ~same
    scored = udf(F.when(undecided, a), F.when(undecided, b))
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(same, F.lit(1.0))
        .otherwise(scored)
    )


def _ratio_bound(threshold: float, prefix_weight: float = 0.0) -> tuple[int, int] | None:
    """Exact rational r0 with similarity < threshold whenever min/max length < r0.

    Jaro <= (2 + r) / 3; the Winkler boost is at most 4p(1 - sim) and increasing in sim,
    so the plain-Jaro threshold becomes (t - 4p) / (1 - 4p). None when no bound applies.
    """
    t, p4 = Fraction(str(threshold)), 4 * Fraction(str(prefix_weight))
    if p4 >= 1:
        return None
    r0 = 3 * (t - p4) / (1 - p4) - 2
    return r0.numerator, r0.denominator


def decided_below(a, b, threshold: float = 0.9, prefix_weight: float = 0.0) -> Column:
    """What the JVM alone can say about Jaro(a, b) < ``threshold``: FALSE for equal texts, TRUE where
    the length ratio proves it, NULL for pairs that must be scored (and where a side is NULL)."""
    a, b = _c(a), _c(b)
    la, lb = F.length(a), F.length(b)
    bound = _ratio_bound(threshold, prefix_weight)
    if bound is None:
        short = F.lit(False)
    else:
        num, den = bound
        # min/max < num/den  <=>  den*min < num*max, in exact integer arithmetic
        short = F.lit(den) * F.least(la, lb) < F.lit(num) * F.greatest(la, lb)
    return F.when((a == b) & (la > 0), F.lit(1.0) < F.lit(threshold)).when(short, F.lit(True))


def jaro_below(a, b, threshold: float = 0.9, transpositions: str = "half",
               prefix_weight: float = 0.0) -> Column:
    """TRUE when Jaro(a, b) < ``threshold``; NULL when either side is NULL.

    ``decided_below`` settles what it can in the JVM; the UDF scores the rest.
    """
    udf = _udf(transpositions, prefix_weight)
    a, b = _c(a), _c(b)
    decided = decided_below(a, b, threshold, prefix_weight)
    undecided = a.isNotNull() & b.isNotNull() & decided.isNull()
    scored = udf(F.when(undecided, a), F.when(undecided, b))
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("boolean"))
        .when(decided.isNotNull(), decided)
        .otherwise(scored < F.lit(threshold))
    )
