"""Width of the confidence interval of a Poisson mean, from chi-squared quantiles.

The quantile of degrees 2m is twice the root of P(m, y) = p, with P the regularised lower
incomplete gamma function. One method serves all counts: the density is integrated by a
Gauss rule over the cube root of y / m, in which it is close to a normal one whatever m is, and
Newton steps within a bracket find the root. All terms are differences from the mean, so
nothing cancels for large m. Steps end when they are below 1e-12 of the root's own spread;
values that do not get there are an error.
"""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# Workers get these helpers with the function, so nothing need be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(120)
_REACH = 14.0  # standard deviations beyond which nothing of the density is left


def _stirling_rest(m: np.ndarray) -> np.ndarray:
    """What Stirling's formula lacks of the logarithm of the gamma function."""
    inverse = 1.0 / m
    square = inverse * inverse
    rest = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
    for i in np.flatnonzero(m < 30.0):
        rest[i] = math.lgamma(m[i]) - (m[i] - 0.5) * math.log(m[i]) + m[i] - 0.5 * math.log(2 * math.pi)
    return rest


def _density(h: np.ndarray, m: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Density of h, where the gamma variable of shape m is m (1 + h)^3."""
    above = h * (3.0 + h * (3.0 + h))
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        exponent = -m * (above - np.log1p(above)) - rest - np.log1p(h)
        found = 3.0 * np.sqrt(m / (2.0 * math.pi)) * np.exp(exponent)
    return np.where(h > -1.0, np.nan_to_num(found, nan=0.0, posinf=0.0), 0.0)


def chi_squared_quantile(p: float, degrees: np.ndarray) -> np.ndarray:
    """The quantile for each number of degrees, 2 at least."""
    m = np.asarray(degrees, dtype=float) / 2.0
    rest = _stirling_rest(m)
    spread = 1.0 / (3.0 * np.sqrt(m))
    low = np.maximum(-spread * (_REACH + spread), -1.0)
    high = spread * (_REACH + _REACH * spread)
    left = p <= 0.5
    end, share = (low, p) if left else (high, 1.0 - p)

    def tail(h: np.ndarray) -> np.ndarray:
        half = (h - end)[:, None] / 2.0
        at = end[:, None] + half * (1.0 + _NODES)
        # Row by row, so a value does not depend on those beside it.
        return np.abs((_density(at, m[:, None], rest[:, None]) * half * _WEIGHTS).sum(axis=1))

    h = np.clip(NormalDist().inv_cdf(p) * spread - spread * spread, low + 1e-3 * spread, high)
    done = np.zeros(len(m), bool)
    for _ in range(200):
        excess = tail(h) - share
        over = excess > 0 if left else excess < 0
        high = np.where(over, h, high)
        low = np.where(over, low, h)
        with np.errstate(divide="ignore", invalid="ignore"):
            # On the logarithm of the tail, which is close to a straight line far out.
            step = np.log1p(excess / share) * (excess + share) / _density(h, m, rest)
        later = h - step if left else h + step
        later = np.where((later > low) & (later < high), later, (low + high) / 2.0)
        settled = np.abs(later - h) <= 1e-12 * spread + 4e-16
        h = np.where(done, h, later)
        done |= settled
        if done.all():
            return 2.0 * m * (1.0 + h) ** 3
    raise ArithmeticError(f"no quantile of {p} for degrees {np.asarray(degrees)[~done][:3]}")


def interval_width(
    total: np.ndarray, samples: int, alpha: float = 0.99, textbook: bool = False
) -> np.ndarray:
    """Width for `total` occurrences seen in `samples` samples; totals below 1 count as 1.

    The degrees are `2 * total * samples`, as in the method followed here; `textbook`
    drops the second factor.
    """
    tail = (1.0 - alpha) / 2.0
    k = np.maximum(np.asarray(total, dtype=float), 1.0)
    values, where = np.unique(k, return_inverse=True)
    degrees = 2.0 * values * (1 if textbook else samples)
    width = chi_squared_quantile(1.0 - tail, degrees + 2.0) - chi_squared_quantile(tail, degrees)
    return (width / (2.0 * samples))[where]


def poisson_ci(
    total: Column,
    samples: int,
    alpha: float = 0.99,
    textbook: bool = False,
    pinned: bool = False,
) -> Column:
    """`interval_width` of a column, one numpy call per Arrow batch.

    `pinned` declares the function non-deterministic, which it is not, so that Catalyst
    does not move a filter on the width below its projection and compute it twice.
    """

    @F.pandas_udf("double")
    def width(totals: pd.Series) -> pd.Series:
        return pd.Series(interval_width(totals.to_numpy(), samples, alpha, textbook))

    return (width.asNondeterministic() if pinned else width)(total.cast("double"))


def poisson_ci_floor(
    total: Column, samples: int, alpha: float = 0.99, textbook: bool = False
) -> Column:
    """A JVM-side lower bound of `poisson_ci`: `2 z sqrt(m) / samples` for degrees 2m.

    The width is `(1 + z (sqrt(m + 1) + sqrt(m)) + ...) / samples`; the bound drops the
    leading 1, which outweighs the omitted terms.
    """
    z = NormalDist().inv_cdf(1.0 - (1.0 - alpha) / 2.0)
    m = F.greatest(total.cast("double"), F.lit(1.0)) * (1 if textbook else samples)
    return F.sqrt(m) * (2.0 * z / samples)
