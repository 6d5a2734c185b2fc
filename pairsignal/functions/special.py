"""Logarithm of the gamma function, digamma and the gamma-Poisson pmf as SQL text.

All are closed forms of fixed size: a count in the millions costs what a count of three
does, and everything stays in generated code.  Arguments are SQL expressions for positive
doubles; results have about 13 good digits.
"""

from __future__ import annotations

SHIFT = 10

# Coefficients of the asymptotic series in 1/z.
LN_GAMMA_SERIES = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
DIGAMMA_SERIES = (-1 / 12, 1 / 120, -1 / 252, 1 / 240, -1 / 132, 691 / 32760)
HALF_LN_2PI = 0.9189385332046728


def _horner(coefficients: tuple[float, ...], x: str) -> str:
    sql = "0D"
    for c in reversed(coefficients):
        sql = f"({c!r}D + {x} * {sql})"
    return sql


def ln_gamma(x: str) -> str:
    """ln gamma(x): the series at x + 10, taken back by the product x(x+1)...(x+9)."""
    z = f"({x} + {SHIFT}D)"
    product = " * ".join(f"({x} + {k}D)" for k in range(SHIFT))
    series = f"{_horner(LN_GAMMA_SERIES, f'(1D / ({z} * {z}))')} / {z}"
    return f"(({z} - 0.5D) * ln({z}) - {z} + {HALF_LN_2PI!r}D + {series} - ln({product}))"


def ln_gamma_rise(x: str, n: str) -> str:
    """ln gamma(x + n) - ln gamma(x) without the loss of digits that a difference of two large
    logarithms has where x is much larger than n."""
    z = f"({x} + {SHIFT}D)"
    top = f"({z} + {n})"
    series = [f"{_horner(LN_GAMMA_SERIES, f'(1D / ({t} * {t}))')} / {t}" for t in (top, z)]
    ratio = " * ".join(f"(1D + {n} / ({x} + {k}D))" for k in range(SHIFT))
    return (
        f"(({top} - 0.5D) * log1p({n} / {z}) - {n} + {n} * ln({z})"
        f" + ({series[0]} - {series[1]}) - ln({ratio}))"
    )


def digamma(x: str) -> str:
    """Derivative of ln gamma, by the same shift."""
    z = f"({x} + {SHIFT}D)"
    steps = " + ".join(f"1D / ({x} + {k}D)" for k in range(SHIFT))
    series = f"{_horner(DIGAMMA_SERIES, f'(1D / ({z} * {z}))')} / ({z} * {z})"
    return f"(ln({z}) - 0.5D / {z} + {series} - ({steps}))"


def ln_nb_pmf(n: str, e: str, alpha: str, beta: str) -> str:
    """Log probability of count ``n`` at exposure ``e`` under one gamma component."""
    return (
        f"(-{n} * log1p({beta} / {e}) - {alpha} * log1p({e} / {beta})"
        f" + {ln_gamma_rise(alpha, n)} - {ln_gamma(f'({n} + 1D)')})"
    )


def literal(x: float) -> str:
    return f"{float(x)!r}D"
