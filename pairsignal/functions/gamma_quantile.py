"""Quantiles of a mixture of two gamma distributions, a whole Arrow batch at a time."""

from __future__ import annotations

import numpy as np

# From this shape on the series and the fraction need many terms, and the density is a narrow peak.
LARGE_SHAPE = 200.0
REACH = 12.0  # standard deviations beyond which a large shape has no mass in double precision
MOST_TERMS = 10_000
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(80)


def _series(a, x, front):
    """Lower incomplete gamma by its power series, for x below a + 1."""
    term = 1.0 / a
    total = term.copy()
    k = a.copy()
    for _ in range(MOST_TERMS):
        k += 1.0
        term = term * x / k
        total += term
        if np.all(term <= total * 1e-16):
            return total * front
    raise ArithmeticError("the series of the incomplete gamma function did not converge")


def _fraction(a, x, front):
    """Upper incomplete gamma by its continued fraction, for x above a + 1."""
    b = x + 1.0 - a
    c = np.full_like(x, 1e300)
    d = 1.0 / b
    h = d.copy()
    for i in range(1, MOST_TERMS):
        an = -i * (i - a)
        b = b + 2.0
        d = an * d + b
        d = 1.0 / np.where(np.abs(d) < 1e-300, 1e-300, d)
        c = b + an / c
        c = np.where(np.abs(c) < 1e-300, 1e-300, c)
        step = d * c
        h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            return h * front
    raise ArithmeticError("the fraction of the incomplete gamma function did not converge")


def _by_quadrature(a, x, ln_gamma_a):
    """Integral of the density up to x between the places where it is negligible, for a large shape.

    The nodes are spread over at most 2 * REACH standard deviations, however far x lies beyond."""
    low = np.maximum(0.0, a - REACH * np.sqrt(a))
    high = a + REACH * np.sqrt(a)
    half = 0.5 * np.maximum(np.minimum(x, high) - low, 0.0)
    t = np.maximum(low[:, None] + half[:, None] * (_NODES + 1.0), 1e-300)
    a_, lg = a[:, None], ln_gamma_a[:, None]
    density = np.exp((a_ - 1.0) * np.log(t) - t - lg)
    return np.where(x >= high, 1.0, np.minimum(half * (density @ _WEIGHTS), 1.0))


def gamma_cdf(a, x, ln_gamma_a):
    """Regularised lower incomplete gamma function P(a, x) of arrays."""
    out = np.zeros_like(x)
    large = (a >= LARGE_SHAPE) & (x > 0)
    if large.any():
        out[large] = _by_quadrature(a[large], x[large], ln_gamma_a[large])
    rest = (a < LARGE_SHAPE) & (x > 0)
    low, high = rest & (x < a + 1.0), rest & (x >= a + 1.0)
    with np.errstate(under="ignore", over="ignore"):
        front = np.exp(a * np.log(np.where(x > 0, x, 1.0)) - x - ln_gamma_a)
        if low.any():
            out[low] = _series(a[low], x[low], front[low])
        if high.any():
            out[high] = 1.0 - _fraction(a[high], x[high], front[high])
    return out


def mixture_quantile(prob, q, a1, s1, lg1, a2, s2, lg2, steps=200):
    """Smallest value with mixture probability ``prob``, by safeguarded Newton steps.

    ``q`` is the weight of the first gamma; ``a``, ``s`` and ``lg`` are shape, scale and
    ln gamma(shape).  By Markov's inequality the answer is at most the larger mean over
    (1 - prob), which gives the first bracket.  Rows with a number that is not finite give NaN.
    """

    def density(a, s, lg, v):
        with np.errstate(under="ignore", over="ignore", divide="ignore"):
            return np.exp((a - 1.0) * np.log(v / s) - v / s - lg) / s

    low = np.zeros_like(q)
    mean1, mean2 = np.where(q > 0, a1 * s1, 0.0), np.where(q < 1, a2 * s2, 0.0)
    high = np.maximum(mean1, mean2) / (1.0 - prob)
    value = 0.5 * high
    numbers = (q, a1, s1, lg1, a2, s2, lg2)
    open_ = np.flatnonzero(np.all([np.isfinite(c) for c in numbers], axis=0) & (high > 0))
    value[~np.isin(np.arange(len(q)), open_)] = np.nan
    for _ in range(steps):
        if not len(open_):
            break
        i = open_
        v = value[i]
        cdf, slope = np.zeros_like(v), np.zeros_like(v)
        for share, a, s, lg in ((q[i], a1[i], s1[i], lg1[i]), (1.0 - q[i], a2[i], s2[i], lg2[i])):
            on = share > 0
            cdf[on] += share[on] * gamma_cdf(a[on], v[on] / s[on], lg[on])
            slope[on] += share[on] * density(a[on], s[on], lg[on], v[on])
        off = cdf - prob
        high[i] = np.where(off >= 0, v, high[i])
        low[i] = np.where(off < 0, v, low[i])
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            newton = v - off / slope
        bad = ~np.isfinite(newton) | (newton <= low[i]) | (newton >= high[i])
        step = np.where(bad, 0.5 * (low[i] + high[i]), newton)
        value[i] = step
        done = (np.abs(step - v) <= 1e-13 * np.abs(step)) | (high[i] - low[i] <= 1e-14 * high[i])
        open_ = i[~done]
    if len(open_):
        raise ArithmeticError(f"{len(open_)} quantiles did not converge in {steps} steps")
    return value
