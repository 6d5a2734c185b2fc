"""Fitting the two-gamma mixture to (n, w, e) cells: count, weight, mean exposure.

The counts are truncated at the smallest one present, so each component is divided by its
probability of reaching it.  A pass over the cells is one Spark job that sends a row of sums a
theta; the driver holds parameters and sums only.  Squashed cells and raw triples (w = 1) run the same code.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairsignal.functions import mixture_sums, special
from pairsignal.functions.special import digamma, ln_nb_pmf
from pairsignal.schema import MixtureParams
from pairsignal.sources.written import written

# Stopping rule and number of random starts.
TOLERANCE = 0.01
MAX_ITERATIONS = 100
STARTS = 20

# The sums travel with the task, so executors need no copy of this package.
register_pickle_by_value(mixture_sums)
register_pickle_by_value(special)

PLAIN_START = MixtureParams(0.2, 0.1, 2.0, 4.0, 1 / 3)
STEPS = (1.0, 0.3, 0.05, 0.0)
THETA = ("alpha1", "beta1", "alpha2", "beta2", "p")
FIT_SCHEMA = (
    "start INT, alpha1 DOUBLE, beta1 DOUBLE, alpha2 DOUBLE, beta2 DOUBLE, p DOUBLE, "
    "loglik DOUBLE, iterations INT, converged BOOLEAN, at_limit BOOLEAN"
)
# Limits of a step, of an extrapolation, of ln alpha and ln beta, and of the share; a fit that ends
# at one of the last two says so.
LONGEST_MOVE = 2.0
LONGEST_REACH = 16.0
LARGEST_LOG = 30.0
LEAST_SHARE = 1e-12


def fit_input(squashed: DataFrame) -> DataFrame:
    """Cells of the squashed table but for bin 0: count, weight and mean exposure."""
    return squashed.where("bin >= 1").selectExpr(
        "actual AS n", "weight AS w", "sum_expected / weight AS e"
    )


def smallest_count(cells: DataFrame) -> int | None:
    """The count at which the cells are truncated; None without cells."""
    found = cells.agg(F.min("n")).first()[0]
    return None if found is None else int(found)


def _truncation(cells: DataFrame, nstar: int | None) -> int:
    """``nstar`` as given, else the smallest count; any will do for no cells."""
    if nstar is not None and nstar < 1:
        raise ValueError(f"counts are truncated from 1 on, not from {nstar}")
    return nstar or smallest_count(cells) or 1


def _with_params(cells: DataFrame, params: MixtureParams) -> DataFrame:
    return cells.withColumns({k: F.lit(float(v)) for k, v in zip(THETA, astuple(params))})


def _terms(first: int, terms: int, alpha: str, q: str) -> str:
    """Sums over the counts first, first + 1, ..., first + terms, folded from the last.

    With f(k) the pmf relative to f(first), the struct holds the sums of f(k) ``beyond`` the
    first, of f(k) (k - first) as ``steps``, and of f(k) times the change of d ln f / d alpha
    since the first as ``slopes``.
    """
    zero = "struct(0D AS beyond, 0D AS steps, 0D AS slopes)"
    if terms == 0:
        return zero
    ratio = f"(({alpha} + k) / (k + 1) * {q})"
    fold = (
        f"struct({ratio} * (1D + s.beyond) AS beyond, "
        f"{ratio} * (1D + s.beyond + s.steps) AS steps, "
        f"{q} / (k + 1) * (1D + s.beyond) + {ratio} * s.slopes AS slopes)"
    )
    return f"aggregate(sequence({first + terms - 1}, {first}, -1), {zero}, (s, k) -> {fold})"


def _truncated(cells: DataFrame, i: int, nstar: int) -> DataFrame:
    """Add ``ln_g``, ``_ga`` and ``_gb`` of component ``i``: ln P(count >= nstar), its derivatives.

    P is one minus the sum below nstar, but where that cancels (a small exposure) it is the
    quickly falling sum from nstar on.  Both grow with nstar, and smallest counts grow with the
    data, so from ``mixture_sums.FEW`` on P is an integral of fixed size.
    """
    a, b, q, l = f"alpha{i}", f"beta{i}", f"_q{i}", f"_l{i}"
    names = (f"ln_g{i}", f"_ga{i}", f"_gb{i}")
    if nstar > mixture_sums.FEW:
        def reached(e: pd.Series, alpha: pd.Series, beta: pd.Series) -> pd.DataFrame:
            with np.errstate(all="ignore"):
                found = mixture_sums.reached(*(c.to_numpy("float64") for c in (e, alpha, beta)), nstar)
            return pd.DataFrame(dict(zip(("ln_g", "ga", "gb"), found)))

        integral = F.pandas_udf(reached, "ln_g double, ga double, gb double")
        found = cells.withColumn(f"_t{i}", integral("e", a, b))
        each = {name: F.col(f"_t{i}.{part}") for name, part in zip(names, ("ln_g", "ga", "gb"))}
        return found.withColumns(each).drop(f"_t{i}")
    small = 10.0 ** (-7.0 / nstar)
    below = _terms(0, nstar - 1, a, q)
    above = _terms(nstar, math.ceil(16 * nstar / 7), a, q)
    ln_first = ln_nb_pmf(f"{nstar}D", "e", a, b)
    slope_first = f"({digamma(f'({a} + {nstar}D)')} - {digamma(a)} - {l})"
    by_beta = f"{a} * e / ({b} * ({b} + e))"
    ln_g, g_a, g_b = names
    return (
        cells.withColumns(
            {
                f"_tail{i}": F.expr(f"{q} * greatest(1D, ({a} + {nstar}D) / {nstar + 1}D) < {small!r}D"),
                f"_f0{i}": F.expr(f"exp(-{a} * {l})"),
            }
        )
        .withColumn(f"_s{i}", F.expr(f"CASE WHEN _tail{i} THEN {above} ELSE {below} END"))
        .withColumn(f"_g{i}", F.expr(f"-expm1(-{a} * {l}) - _f0{i} * _s{i}.beyond"))
        .withColumns(
            {
                ln_g: F.expr(
                    f"CASE WHEN _tail{i} THEN {ln_first} + log1p(_s{i}.beyond) ELSE ln(_g{i}) END"
                ),
                g_a: F.expr(
                    f"CASE WHEN _tail{i} THEN {slope_first} + _s{i}.slopes / (1D + _s{i}.beyond) "
                    f"ELSE _f0{i} * ({l} * (1D + _s{i}.beyond) - _s{i}.slopes) / _g{i} END"
                ),
                g_b: F.expr(
                    f"CASE WHEN _tail{i} "
                    f"THEN {by_beta} - ({nstar}D + _s{i}.steps / (1D + _s{i}.beyond)) / ({b} + e) "
                    f"ELSE _f0{i} * (_s{i}.steps / ({b} + e) - {by_beta} * (1D + _s{i}.beyond)) / _g{i} END"
                ),
            }
        )
        .drop(*[f"_{c}{i}" for c in ("tail", "s", "f0", "g")])
    )


def _component(cells: DataFrame, i: int, nstar: int) -> DataFrame:
    """Columns of component ``i``: ln pmf, ln P(count >= nstar) and its two derivatives."""
    a, b = f"alpha{i}", f"beta{i}"
    shared = {
        f"_q{i}": F.expr(f"e / ({b} + e)"),
        f"_l{i}": F.expr(f"log1p(e / {b})"),
        f"ln_f{i}": F.expr(ln_nb_pmf("n", "e", a, b)),
    }
    return _truncated(cells.withColumns(shared), i, nstar).drop(f"_q{i}")


def _score(cells: DataFrame, i: int) -> DataFrame:
    """Derivatives of the log truncated pmf of component ``i`` by alpha and beta."""
    a, b = f"alpha{i}", f"beta{i}"
    by_alpha = f"{digamma(f'({a} + n)')} - {digamma(a)} - _l{i} - _ga{i}"
    by_beta = f"{a} * e / ({b} * ({b} + e)) - n / ({b} + e) - _gb{i}"
    return cells.withColumns({f"da{i}": F.expr(by_alpha), f"db{i}": F.expr(by_beta)})


def _mixed(cells: DataFrame, nstar: int) -> DataFrame:
    """Add ``r`` (posterior share of the first component) and ``ll`` to cells with a theta."""
    both = cells.selectExpr(
        *[f"CAST({c} AS DOUBLE) AS {c}" if c in ("n", "w", "e") else c for c in cells.columns]
    )
    both = _component(_component(both, 1, nstar), 2, nstar)
    log = lambda x: f"CASE WHEN {x} > 0 THEN ln({x}) ELSE -1e300D END"
    return (
        both.withColumns(
            {
                "_x1": F.expr(f"{log('p')} + ln_f1 - ln_g1"),
                "_x2": F.expr(f"{log('(1D - p)')} + ln_f2 - ln_g2"),
            }
        )
        .withColumns(
            {
                "r": F.expr("1D / (1D + exp(_x2 - _x1))"),
                "ll": F.expr("greatest(_x1, _x2) + log1p(exp(-abs(_x1 - _x2)))"),
            }
        )
        .drop("_x1", "_x2")
    )


def truncated_pmf(
    cells: DataFrame, params: MixtureParams, nstar: int | None = None
) -> DataFrame:
    """Log truncated probability of each cell's count under each component."""
    mixed = _mixed(_with_params(cells, params), _truncation(cells, nstar))
    return mixed.selectExpr(
        "n", "w", "e", "ln_f1 - ln_g1 AS ln_fstar1", "ln_f2 - ln_g2 AS ln_fstar2"
    )


def mixture_loglik(
    cells: DataFrame, params: MixtureParams, nstar: int | None = None
) -> DataFrame:
    """Weighted log likelihood of the truncated mixture, one row."""
    mixed = _mixed(_with_params(cells, params), _truncation(cells, nstar))
    return mixed.agg(F.sum(F.col("w") * F.col("ll")).alias("loglik"))


def mixture_responsibilities(
    cells: DataFrame, params: MixtureParams, nstar: int | None = None
) -> DataFrame:
    """Posterior share ``r`` of the first component in each cell."""
    mixed = _mixed(_with_params(cells, params), _truncation(cells, nstar))
    return mixed.select("n", "w", "e", "r")


def mixing_share(responsibilities: DataFrame) -> DataFrame:
    """Weighted mean share of the first component: the next ``p``."""
    return responsibilities.agg((F.sum(F.expr("w * r")) / F.sum("w")).alias("p"))


def mixture_gradient(
    cells: DataFrame, params: MixtureParams, nstar: int | None = None
) -> DataFrame:
    """Derivatives of the log likelihood by alpha and beta of each component, one row."""
    mixed = _mixed(_with_params(cells, params), _truncation(cells, nstar))
    scored = _score(_score(mixed, 1), 2)
    return scored.agg(
        F.sum(F.expr("w * r * da1")).alias("d_alpha1"),
        F.sum(F.expr("w * r * db1")).alias("d_beta1"),
        F.sum(F.expr("w * (1D - r) * da2")).alias("d_alpha2"),
        F.sum(F.expr("w * (1D - r) * db2")).alias("d_beta2"),
    )


def _sums(cells: DataFrame, thetas: dict[tuple[int, int], tuple], nstar: int) -> dict[tuple[int, int], dict]:
    """Sums of one pass for every theta, which has the key (start, candidate).

    A task adds up all thetas over its batches of cells and sends one row a theta, however many
    cells it reads.
    """
    keys, tried = list(thetas), list(thetas.values())
    names = mixture_sums.SUMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(tried), len(names)))
        for batch in batches:
            n, w, e = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "w", "e"))
            total += mixture_sums.cell_sums(n, w, e, tried, nstar)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(tried)), pa.int32()), *map(pa.array, total.T)], names=["theta", *names]
        )

    parts = cells.mapInArrow(run, "theta int, " + ", ".join(f"{k} double" for k in names))
    found = parts.groupBy("theta").agg(*[F.sum(k).alias(k) for k in names])
    return {keys[row["theta"]]: row.asDict() for row in found.collect()}  # a row for each theta


def _stepped(theta: tuple, s: dict, step: float, largest: float = LARGEST_LOG) -> tuple:
    """Theta after one EM step: the share in closed form, the gammas by a scoring step in
    ln alpha and ln beta, shortened to ``step``."""
    out = []
    for i in (1, 2):
        gradient = np.array([s[f"u{i}"], s[f"v{i}"]])
        spread = np.array([[s[f"uu{i}"], s[f"uv{i}"]], [s[f"uv{i}"], s[f"vv{i}"]]])
        spread += np.eye(2) * (1e-8 * np.trace(spread) + 1e-12)
        move = np.linalg.solve(spread, gradient)
        move *= min(1.0, LONGEST_MOVE / max(np.linalg.norm(move), 1e-300))
        old = np.log(np.array(theta[2 * i - 2 : 2 * i]))
        out += _bounded(old + step * move, largest)
    share = s["wr"] / s["w"]
    return (*out, float(min(max(share, LEAST_SHARE), 1.0 - LEAST_SHARE)))


def _bounded(logs: np.ndarray, largest: float) -> list[float]:
    """Alpha and beta of logs moved together into the limits, so that their ratio, the mean, stays."""
    logs = logs - max(0.0, float(logs.max()) - largest)
    logs = logs + max(0.0, -largest - float(logs.min()))
    return np.exp(np.minimum(logs, largest)).tolist()


def _free(theta: tuple) -> np.ndarray:
    """Theta in coordinates without bounds: logs, and the log odds of the share."""
    p = min(max(theta[4], LEAST_SHARE), 1.0 - LEAST_SHARE)
    return np.array([*np.log(theta[:4]), math.log(p / (1.0 - p))])


def _extrapolated(before: tuple, theta: tuple, after: tuple, largest: float) -> list[tuple]:
    """Thetas further along the way of two EM steps (squared extrapolation), the longer first.

    With r the first step and v the change of the step, the point is ``before + 2 c r + c^2 v``;
    c = 1 is ``after`` itself, and the step lengths' ratio says how much further to go.
    """
    x0, x1, x2 = map(_free, (before, theta, after))
    r, v = x1 - x0, x2 - 2.0 * x1 + x0
    c = float(np.linalg.norm(r) / max(np.linalg.norm(v), 1e-300))
    found = []
    for far in (min(c, LONGEST_REACH), (min(c, LONGEST_REACH) + 1.0) / 2.0) if c > 1.0 else ():
        x = x0 + 2.0 * far * r + far * far * v
        odds = math.exp(min(max(x[4], -700.0), 700.0))
        share = min(max(odds / (1.0 + odds), LEAST_SHARE), 1.0 - LEAST_SHARE)
        found.append((*_bounded(x[:2], largest), *_bounded(x[2:4], largest), share))
    return found


def _at_limit(theta: tuple, largest: float = LARGEST_LOG) -> bool:
    logs = np.abs(np.log(np.array(theta[:4])))
    return bool((logs >= largest - 1e-9).any() or not 1e-9 < theta[4] < 1 - 1e-9)


def fit_step(cells: DataFrame, params: MixtureParams = PLAIN_START, step: float = 1.0, nstar: int | None = None) -> DataFrame:
    """Theta after one EM step from ``params``, and the log likelihood before it; one row."""
    theta = astuple(params)
    sums = _sums(_doubles(cells), {(0, 0): theta}, _truncation(cells, nstar)).get((0, 0))
    rows = [(*map(float, _stepped(theta, sums, step)), float(sums["loglik"]))] if _usable(sums) else []
    return cells.sparkSession.createDataFrame(rows, ", ".join(f"{k} DOUBLE" for k in (*THETA, "loglik")))


def _doubles(cells: DataFrame) -> DataFrame:
    return cells.select(*[F.col(c).cast("double").alias(c) for c in ("n", "w", "e")])


def _usable(s: dict | None) -> bool:
    return s is not None and s["w"] != 0 and all(v is not None and math.isfinite(v) for v in s.values())


@dataclass
class _Run:
    theta: tuple
    sums: dict
    iterations: int = 0
    active: bool = True
    before: tuple | None = None  # the theta whose whole EM step this one is


def fit_starts(
    cells: DataFrame,
    starts: list[MixtureParams],
    tolerance: float = TOLERANCE,
    max_iterations: int = MAX_ITERATIONS,
    store: Callable[[DataFrame], DataFrame] = written,
    largest: float = LARGEST_LOG,
) -> DataFrame:
    """EM from several starts at once: one row per start that kept a finite likelihood.

    Each iteration is one pass that tries a few step lengths for every start and, after a whole
    step, two extrapolations of the last two; the likeliest is kept, so the likelihood of a start
    never falls.  A start stops when a step gains no more than ``tolerance``, and is then
    ``converged``; ``at_limit`` marks a fit whose ln alpha or ln beta ran to ``largest`` or its
    negative, or whose share lies at 0 or 1.  Without cells there is no row.
    """
    spark = cells.sparkSession
    # Read once for every pass: cells of a small squashed table would all lie in one task.
    cells = store(_doubles(cells).repartition(spark.sparkContext.defaultParallelism))
    nstar = smallest_count(cells)
    if nstar is None:
        return spark.createDataFrame([], FIT_SCHEMA)
    valid = {
        i: astuple(p) for i, p in enumerate(starts) if min(astuple(p)) > 0 and p.p <= 1
    }
    first = _sums(cells, {(i, 0): t for i, t in valid.items()}, nstar) if valid else {}
    runs = {i: _Run(t, first[i, 0]) for i, t in valid.items() if _usable(first.get((i, 0)))}
    for _ in range(max_iterations):
        moves = {}
        for i, run in runs.items():
            if run.active:
                steps = [_stepped(run.theta, run.sums, step, largest) for step in STEPS]
                if run.before is not None:
                    steps += _extrapolated(run.before, run.theta, steps[0], largest)
                moves |= {(i, j): theta for j, theta in enumerate(steps)}
        if not moves:
            break
        found = _sums(cells, moves, nstar)
        for i, run in runs.items():
            if not run.active:
                continue
            tried = [(s["loglik"], j) for (k, j), s in found.items() if k == i and _usable(s)]
            gain = max(tried)[0] - run.sums["loglik"] if tried else 0.0
            run.active = gain > tolerance
            if gain > 0:
                best = max(tried)[1]
                run.before = run.theta if best == 0 else None
                run.theta, run.sums = moves[i, best], found[i, best]
                run.iterations += 1
    rows = [
        (i, *map(float, run.theta), float(run.sums["loglik"]), run.iterations, not run.active,
         _at_limit(run.theta, largest))
        for i, run in runs.items()
    ]
    return spark.createDataFrame(rows, FIT_SCHEMA)


def fit_mixture(cells: DataFrame, start: MixtureParams = PLAIN_START, **options) -> DataFrame:
    """EM from one start; a start that is not a valid theta is an error.  No cells, no row."""
    if not (min(astuple(start)) > 0 and start.p <= 1):
        raise ValueError(f"invalid start {start}")
    return fit_starts(cells, [start], **options)


def random_starts(n: int = STARTS, seed: int = 0) -> list[MixtureParams]:
    """Starts with unit exponential alpha and beta and a uniform share."""
    draw = np.random.default_rng(seed)
    return [MixtureParams(*draw.exponential(size=4), draw.uniform()) for _ in range(n)]


def fit_mixture_multistart(
    cells: DataFrame, n_starts: int = STARTS, seed: int = 0, **options
) -> DataFrame:
    """The likeliest fit over random starts; starts that fail are left out."""
    fitted = fit_starts(cells, random_starts(n_starts, seed), **options)
    return fitted.orderBy(F.desc("loglik"), "start").limit(1)


def fitted_params(fitted: DataFrame) -> MixtureParams | None:
    """The likeliest fit; None where nothing could be fitted."""
    row = fitted.orderBy(F.desc("loglik"), "start").first()
    return None if row is None else MixtureParams(*(row[k] for k in THETA))
