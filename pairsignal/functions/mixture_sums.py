"""Sums over (n, w, e) cells that one step of the mixture fit needs, for many thetas at once.

Plain numpy over one batch of cells; the terms are those of ``operators/fit.py``: truncated
log pmf, its derivatives by alpha and beta, posterior share, and the products of the scores.
The module travels with the task.
"""

from __future__ import annotations

import math

import numpy as np

from pairsignal.functions.special import DIGAMMA_SERIES, LN_GAMMA_SERIES, SHIFT

# Up to this smallest count the truncation is a sum over counts, else an integral of fixed size.
FEW = 32
# An integrand is followed down to e^-37 of its start, in panels that end at these logarithms.
LEVELS, NODES = (-37.0, -8.0, -1.0), 24
SUMS = ("loglik", "w", "wr") + tuple(f"{k}{i}" for i in (1, 2) for k in ("u", "v", "uu", "uv", "vv"))


def _series(coefficients: tuple, z: np.ndarray) -> np.ndarray:
    x, out = 1.0 / (z * z), 0.0
    for c in reversed(coefficients):
        out = c + x * out
    return out


def ln_gamma_rise(x, n: np.ndarray) -> np.ndarray:
    """ln gamma(x + n) - ln gamma(x), exact also where x is much larger than n."""
    z = x + SHIFT
    top = z + n
    ratio = np.ones(np.shape(n))
    for k in range(SHIFT):
        ratio = ratio * (1.0 + n / (x + k))
    series = _series(LN_GAMMA_SERIES, top) / top - _series(LN_GAMMA_SERIES, z) / z
    return (top - 0.5) * np.log1p(n / z) - n + n * np.log(z) + series - np.log(ratio)


def digamma_rise(x, n: np.ndarray) -> np.ndarray:
    """digamma(x + n) - digamma(x)."""
    z = x + SHIFT
    top = z + n
    series = _series(DIGAMMA_SERIES, top) / (top * top) - _series(DIGAMMA_SERIES, z) / (z * z)
    steps = sum(n / ((x + k) * (x + k + n)) for k in range(SHIFT))
    return np.log1p(n / z) + 0.5 * n / (z * top) + series + steps


def _folded(first: int, terms: int, a: float, q: np.ndarray) -> tuple:
    """Sums of f(k), f(k) (k - first) and f(k) times the rise of its slope, relative to f(first)."""
    beyond = steps = slopes = np.zeros(len(q))
    for k in range(first + terms - 1, first - 1, -1):
        ratio = (a + k) / (k + 1) * q
        beyond, steps, slopes = (
            ratio * (1.0 + beyond),
            ratio * (1.0 + beyond + steps),
            q / (k + 1) * (1.0 + beyond) + ratio * slopes,
        )
    return beyond, steps, slopes


def _summed(e: np.ndarray, a, b, nstar: int) -> tuple:
    """ln P(count >= nstar) and its derivatives by alpha and beta, as sums over nstar terms."""
    l, q = np.log1p(e / b), e / (b + e)  # noqa: E741
    f0 = np.exp(-a * l)
    by_b = a * e / (b * (b + e))
    beyond, steps, slopes = _folded(0, nstar - 1, a, q)
    g = -np.expm1(-a * l) - f0 * beyond
    ln_g = np.log(g)
    g_a = f0 * (l * (1.0 + beyond) - slopes) / g
    g_b = f0 * (steps / (b + e) - by_b * (1.0 + beyond)) / g
    # One minus the sum below nstar cancels for a small exposure; the sum from nstar on does not.
    tail = q * max(1.0, (a + nstar) / (nstar + 1)) < 10.0 ** (-7.0 / nstar)
    if tail.any():
        qt, lt, et = q[tail], l[tail], e[tail]
        beyond, steps, slopes = _folded(nstar, math.ceil(16 * nstar / 7), a, qt)
        k = np.full(len(qt), float(nstar))
        first = -k * np.log1p(b / et) - a * lt + ln_gamma_rise(a, k) - ln_gamma_rise(1.0, k)
        ln_g[tail] = first + np.log1p(beyond)
        g_a[tail] = digamma_rise(a, k) - lt + slopes / (1.0 + beyond)
        g_b[tail] = by_b[tail] - (nstar + steps / (1.0 + beyond)) / (b + et)
    return ln_g, g_a, g_b


def reached(e: np.ndarray, a, b, nstar: int) -> tuple:
    """ln P(count >= nstar) and its derivatives by alpha and beta; the cost does not grow with nstar.

    With l = ln(1 + e/b), P is the integral of (1 - exp(-y))^(nstar - 1) exp(-alpha y) over y from 0
    to l, over that from 0 on.  The integrand is log-concave, so it is followed from l away from its
    peak, as the probability or as what is missing to 1, in three panels of Gauss-Legendre nodes.
    """
    a, b = np.broadcast_to(np.float64(a), e.shape), np.broadcast_to(np.float64(b), e.shape)
    k, odds, l = np.full(e.shape, float(nstar)), b / e, np.log1p(e / b)  # noqa: E741
    rest = nstar - 1.0
    below = (rest * odds >= a) | (a * l < 1.0)
    side = np.where(below, 1.0, -1.0)

    def log_height(u, side, odds, a):
        return rest * np.log1p(-np.expm1(side * u) * odds) + side * a * u

    far = np.log1p(-np.expm1((LEVELS[0] - a * l) / rest) / odds)
    u = np.where(below, far, (rest * np.log1p(odds) - LEVELS[0]) / a)
    ends = []
    for level in LEVELS:  # Newton's method from beyond the place sought, where a concave line is safe
        for _ in range(60):
            grown = np.exp(side * u) * odds
            slope = side * (a - rest * grown / (1.0 - grown + odds))
            move = (log_height(u, side, odds, a) - level) / slope
            u = u - move
            if not (np.abs(move) > 1e-3 * u).any():
                break
        ends.append(u)
    x, weight = np.polynomial.legendre.leggauss(NODES)
    area = by_u = 0.0
    for left, right in zip((0.0, *ends[:0:-1]), ends[::-1]):
        half = (right - left) / 2.0
        at = left + half * (x[:, None] + 1.0)
        height = np.exp(log_height(at, side, odds, a)) * (half * weight[:, None])
        area, by_u = area + height.sum(axis=0), by_u + (height * at).sum(axis=0)
    edge = -rest * np.log1p(odds) - a * l + ln_gamma_rise(a, k) - ln_gamma_rise(1.0, k) + math.log(nstar)
    missing = np.where(below, 0.0, np.exp(edge) * area)
    by_a = digamma_rise(a, k) - l + side * by_u / area
    by_l = -e / (b * (b + e)) / area
    share = np.where(below, 1.0, -missing / (1.0 - missing))
    return (
        np.where(below, edge + np.log(area), np.log1p(-missing)),
        share * by_a,
        by_l * np.where(below, 1.0, -share),
    )


def _component(n, e, a: float, b: float, nstar: int, ln_factorial: np.ndarray) -> tuple:
    """ln of the truncated pmf and its derivatives by ln alpha and ln beta, for each cell."""
    l = np.log1p(e / b)  # noqa: E741
    ln_f = -n * np.log1p(b / e) - a * l + ln_gamma_rise(a, n) - ln_factorial
    by_b = a * e / (b * (b + e))
    ln_g, g_a, g_b = (_summed if nstar <= FEW else reached)(e, a, b, nstar)
    u = a * (digamma_rise(a, n) - l - g_a)
    v = b * (by_b - n / (b + e) - g_b)
    return ln_f - ln_g, u, v


def cell_sums(n: np.ndarray, w: np.ndarray, e: np.ndarray, thetas: list[tuple], nstar: int) -> np.ndarray:
    """One row of ``SUMS`` for each theta."""
    out = np.zeros((len(thetas), len(SUMS)))
    with np.errstate(all="ignore"):
        ln_factorial = ln_gamma_rise(1.0, n)
        for row, (a1, b1, a2, b2, p) in zip(out, thetas):
            ln1, *score1 = _component(n, e, a1, b1, nstar, ln_factorial)
            ln2, *score2 = _component(n, e, a2, b2, nstar, ln_factorial)
            x1 = (math.log(p) if p > 0 else -1e300) + ln1
            x2 = (math.log1p(-p) if p < 1 else -1e300) + ln2
            r = 1.0 / (1.0 + np.exp(x2 - x1))
            found = [w @ (np.maximum(x1, x2) + np.log1p(np.exp(-np.abs(x1 - x2)))), w.sum(), w @ r]
            for share, (u, v) in ((w * r, score1), (w * (1.0 - r), score2)):
                found += [share @ u, share @ v, share @ (u * u), share @ (u * v), share @ (v * v)]
            row[:] = found
    return out
