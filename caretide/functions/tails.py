"""Tail probabilities of single numbers, for test statistics computed in Spark."""

from __future__ import annotations

import math

_TINY = 1e-300
_EPS = 1e-15
_STEPS = 100_000


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _lentz(first: float, coefficients) -> float:
    """Value of a continued fraction from its (numerator, denominator) terms."""
    value = first if abs(first) > _TINY else _TINY
    c, d = value, 0.0
    for num, den in coefficients:
        d = den + num * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = den + num / c
        c = c if abs(c) > _TINY else _TINY
        step = c * d
        value *= step
        if abs(step - 1.0) < _EPS:
            break
    return value


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_inc(b, a, 1.0 - x)

    def terms():
        for m in range(1, _STEPS):
            k = (m - 1) // 2 if m % 2 else m // 2
            if m % 2:
                yield -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1)), 1.0
            else:
                yield k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k)), 1.0

    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    return math.exp(log_front) / (a * _lentz(1.0, terms()))


def gamma_sf(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    log_front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1.0:
        term = total = 1.0 / a
        for k in range(1, _STEPS):
            term *= x / (a + k)
            total += term
            if term < total * _EPS:
                break
        return 1.0 - total * math.exp(log_front)
    terms = ((k * (a - k), x + 2 * k + 1.0 - a) for k in range(1, _STEPS))
    return math.exp(log_front) / _lentz(x + 1.0 - a, terms)


#: Degrees of freedom from which asymptotic forms are closer than sums of large logarithms.
_LARGE = 1e6


def t_two_sided(t: float, df: float) -> float:
    if df > _LARGE:
        return 2.0 * normal_sf(abs(t) * (1.0 - 0.25 / df) / math.sqrt(1.0 + t * t / (2.0 * df)))
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    if f <= 0.0:
        return 1.0
    if d1 > _LARGE and d2 > _LARGE:
        return _cube_root_sf(f, d1, d2)
    if d2 > _LARGE:
        return chi2_sf(d1 * f, d1)
    if d1 > _LARGE:
        return 1.0 - chi2_sf(d2 / f, d2)
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def _cube_root_sf(f: float, d1: float, d2: float) -> float:
    """Wilson and Hilferty's normal form for a ratio of two mean squares."""
    a, b, r = 2.0 / (9.0 * d1), 2.0 / (9.0 * d2), f ** (1.0 / 3.0)
    return normal_sf(((1.0 - b) * r - (1.0 - a)) / math.sqrt(b * r * r + a))


def chi2_sf(x: float, df: float) -> float:
    if df > _LARGE:
        return _cube_root_sf(max(x, 0.0) / df, df, math.inf)
    return gamma_sf(df / 2.0, x / 2.0)


def normal_quantile(p: float) -> float:
    """Inverse of the standard normal distribution, by bisection."""
    lo, hi = -40.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if normal_sf(mid) > 1.0 - p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0
