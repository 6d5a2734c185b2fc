"""Scores of actual against expected counts under a two-gamma mixture.

Every step adds a column to a triples table.  All but the lower bound stay in generated
code; the bound needs a root per row and runs over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pairsignal.functions import gamma_quantile
from pairsignal.functions.gamma_quantile import mixture_quantile
from pairsignal.functions.special import digamma, literal, ln_gamma, ln_nb_pmf
from pairsignal.operators.expected import min_actual_filter
from pairsignal.schema import DEFAULT_PARAMS, MixtureParams
from pairsignal.sources.written import unwritten

# Tail probability, search limit and failure mark of the lower bound, and the
# limit of a strong signal.
TAIL = 0.05
CAP = 10.0
NO_ROOT = -1.0
STRONG = 2.0

# The batch function travels with the task, so executors need no copy of this package.
register_pickle_by_value(gamma_quantile)

N, E = "CAST(actual AS DOUBLE)", "expected"


def _component(params: MixtureParams, which: int) -> tuple[str, str]:
    alpha, beta = (params.alpha1, params.beta1) if which == 1 else (params.alpha2, params.beta2)
    return literal(alpha), literal(beta)


def rrr(triples: DataFrame) -> DataFrame:
    """Relative reporting ratio."""
    return triples.withColumn("rrr", F.expr(f"{N} / {E}"))


def nb_pmf(triples: DataFrame, params: MixtureParams = DEFAULT_PARAMS) -> DataFrame:
    """Log probability (``ln_pmf1``, ``ln_pmf2``) of the count under each component."""
    return triples.withColumns(
        {f"ln_pmf{i}": F.expr(ln_nb_pmf(N, E, *_component(params, i))) for i in (1, 2)}
    )


def posterior_weight(triples: DataFrame, params: MixtureParams = DEFAULT_PARAMS) -> DataFrame:
    """Posterior probability ``q`` of the first component, from log odds."""
    if params.p >= 1.0:
        return triples.withColumn("q", F.lit(1.0))
    if params.p <= 0.0:
        return triples.withColumn("q", F.lit(0.0))
    prior = literal((1.0 - params.p) / params.p)
    with_pmf = nb_pmf(triples, params)
    odds = F.expr(f"1D / (1D + exp(ln_pmf2 - ln_pmf1 + ln({prior})))")
    return with_pmf.withColumn("q", odds).drop("ln_pmf1", "ln_pmf2")


def posterior_log_mean(triples: DataFrame, params: MixtureParams = DEFAULT_PARAMS) -> DataFrame:
    """Posterior mean of ln(lambda) under each component, ``delta1`` and ``delta2``."""
    deltas = {}
    for i in (1, 2):
        alpha, beta = _component(params, i)
        deltas[f"delta{i}"] = F.expr(f"{digamma(f'({alpha} + {N})')} - ln({beta} + {E})")
    return triples.withColumns(deltas)


def _with_ebgm(weighted: DataFrame, params: MixtureParams) -> DataFrame:
    """Add ``ebgm`` to triples that have ``q``."""
    scored = posterior_log_mean(weighted, params)
    return scored.withColumn("ebgm", F.expr("exp(q * delta1 + (1D - q) * delta2)")).drop("delta1", "delta2")


def ebgm_scores(triples: DataFrame, params: MixtureParams = DEFAULT_PARAMS) -> DataFrame:
    """Empirical Bayes geometric mean."""
    return _with_ebgm(posterior_weight(triples, params), params).drop("q")


def _scale(beta: str, posterior: str) -> str:
    """Scale of the posterior gamma: beta + e read as its scale (parity) or its rate."""
    if posterior not in ("scale", "rate"):
        raise ValueError(f"unknown posterior {posterior!r}")
    return f"({beta} + {E})" if posterior == "scale" else f"(1D / ({beta} + {E}))"


def _lower_bound(
    prob: pd.Series, q: pd.Series, a1: pd.Series, s1: pd.Series, lg1: pd.Series,
    a2: pd.Series, s2: pd.Series, lg2: pd.Series,
) -> pd.Series:
    parts = [c.to_numpy(dtype="float64", copy=True) for c in (q, a1, s1, lg1, a2, s2, lg2)]
    return pd.Series(mixture_quantile(float(prob.iloc[0]) if len(prob) else TAIL, *parts))


# Called non-deterministic so that a later filter on the bound is not pushed below it, which would
# search each kept row's root twice.
_lower_bound = F.pandas_udf(_lower_bound, DoubleType()).asNondeterministic()


def _posterior(params: MixtureParams, posterior: str, which: int) -> list[Column]:
    alpha, beta = _component(params, which)
    shape = f"({alpha} + {N})"
    return [F.expr(shape), F.expr(_scale(beta, posterior)), F.expr(ln_gamma(shape))]


def _with_ebci(
    weighted: DataFrame, params: MixtureParams, posterior: str, cap: float | None, tail: float
) -> DataFrame:
    """Add ``ebci`` to triples that have ``q``."""
    gammas = [*_posterior(params, posterior, 1), *_posterior(params, posterior, 2)]
    scored = weighted.withColumn("ebci", _lower_bound(F.lit(tail), F.col("q"), *gammas))
    if cap is None:
        return scored
    return scored.withColumn(
        "ebci", F.when(F.col("ebci") > cap, NO_ROOT).otherwise(F.col("ebci"))
    )


def ebci_bounds(
    triples: DataFrame,
    params: MixtureParams = DEFAULT_PARAMS,
    posterior: str = "rate",
    cap: float | None = None,
    tail: float = TAIL,
) -> DataFrame:
    """Lower bound ``ebci``: the value with probability ``tail`` below it.

    ``"rate"`` without a cap is the gamma-Poisson posterior; ``posterior="scale"`` with
    ``cap=CAP`` gives the shipped behaviour (above the cap: -1).
    """
    return _with_ebci(posterior_weight(triples, params), params, posterior, cap, tail).drop("q")


def _may_reach(
    weighted: DataFrame, params: MixtureParams, posterior: str, limit: float, tail: float
) -> DataFrame:
    """Drop triples whose lower bound cannot reach ``limit``, before any root is searched.

    A value with 1 - tail of the mass above it is at most the mean over (1 - tail).
    """
    (a1, b1), (a2, b2) = _component(params, 1), _component(params, 2)
    mean1 = f"({a1} + {N}) * {_scale(b1, posterior)}"
    mean2 = f"({a2} + {N}) * {_scale(b2, posterior)}"
    mean = F.expr(f"q * {mean1} + (1D - q) * {mean2}")
    return weighted.where(mean >= limit * (1.0 - tail) * (1.0 - 1e-9))


def scored_signals(
    triples: DataFrame,
    params: MixtureParams = DEFAULT_PARAMS,
    min_actual: int = 3,
    posterior: str = "rate",
    cap: float | None = None,
    min_ebci: float = STRONG,
    order: bool = True,
    store: Callable[[DataFrame], DataFrame] = unwritten,
) -> DataFrame:
    """Strong signals with all scores, best ``ebgm`` first (ties by name).

    The order is global over a range shuffle; nothing is gathered into one partition.  The range
    sort reads its input twice, so with ``store=written`` the survivors are stored first.
    """
    weighted = posterior_weight(min_actual_filter(triples, min_actual), params)
    kept = _may_reach(weighted, params, posterior, min_ebci, TAIL)
    scored = _with_ebci(_with_ebgm(rrr(kept), params), params, posterior, cap, TAIL)
    scored = scored.where(F.col("ebci") >= min_ebci).select(*triples.columns, "rrr", "ebgm", "ebci")
    if order:
        ties = [c for c in triples.columns if c not in ("actual", "expected")]
        scored = store(scored).orderBy(F.desc("ebgm"), *ties)
    return scored
