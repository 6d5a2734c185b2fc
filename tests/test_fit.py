import dataclasses
import math

import numpy as np
import pytest

from pairsignal.functions import mixture_sums
from pairsignal.operators import fit
from pairsignal.schema import DEFAULT_PARAMS, MixtureParams
from pairsignal.sources.written import unwritten

PLAIN = fit.PLAIN_START


def ln_truncated(n, e, a, b, nstar, last=400):
    def f(k):
        return math.exp(math.lgamma(a + k) - math.lgamma(a) - math.lgamma(k + 1)
                        - k * math.log1p(b / e) - a * math.log1p(e / b))
    tail = math.fsum(f(k) for k in range(nstar, last))
    return math.log(f(n)) - math.log(tail)


@pytest.fixture(scope="module")
def cells(spark):
    data = [(3 + i % 9, 1 + i % 4, 0.002 * 1.6**i) for i in range(16)]
    return spark.createDataFrame(data, "n long, w long, e double").cache()


def test_input_leaves_out_the_lowest_bin(spark):
    df = spark.createDataFrame([(3, 0, 1.0, 2), (3, 5, 6.0, 3)], "actual long, bin int, sum_expected double, weight long")
    assert [tuple(r) for r in fit.fit_input(df).collect()] == [(3, 3, 2.0)]


@pytest.mark.parametrize("params", [PLAIN, MixtureParams(1e-4, 0.3, 30.0, 8.0, 0.5)])
def test_truncated_pmf(cells, params):
    for r in fit.truncated_pmf(cells, params).collect():
        for i, (a, b) in enumerate([(params.alpha1, params.beta1), (params.alpha2, params.beta2)], 1):
            assert r[f"ln_fstar{i}"] == pytest.approx(ln_truncated(r["n"], r["e"], a, b, 3), abs=1e-7)


@pytest.mark.parametrize("params", [PLAIN, MixtureParams(1e-3, 0.3, 30.0, 8.0, 0.5)])
def test_gradient_by_differences(cells, params):
    got = fit.mixture_gradient(cells, params).first().asDict()
    for k in ("alpha1", "beta1", "alpha2", "beta2"):
        h = 1e-4 * getattr(params, k)
        up, down = (
            fit.mixture_loglik(cells, dataclasses.replace(params, **{k: getattr(params, k) + s}), 3).first()[0]
            for s in (h, -h)
        )
        assert got[f"d_{k}"] == pytest.approx((up - down) / (2 * h), rel=1e-4, abs=1e-4)


def test_large_smallest_count(spark):
    data = [(60 + i % 9, 1, 2.0 * 1.5**i) for i in range(12)]
    df = spark.createDataFrame(data, "n long, w long, e double")
    for r in fit.truncated_pmf(df, PLAIN).collect():
        assert r["ln_fstar1"] == pytest.approx(ln_truncated(r["n"], r["e"], 0.2, 0.1, 60, 60_000), abs=1e-6)
    assert math.isfinite(fit.mixture_gradient(df, PLAIN).first()["d_beta2"])


def test_smallest_count_of_millions(spark):
    """Large tables have large smallest counts; with alpha 1 and 2 the tail is a closed form."""
    first, params = 3_000_000, MixtureParams(1.0, 0.5, 2.0, 4.0, 0.4)
    data = [(first + i * i, 1 + i % 2, 1e6 * 1.5**i) for i in range(12)]
    df = spark.createDataFrame(data, "n long, w long, e double")
    for r in fit.truncated_pmf(df, params).collect():
        more = r["n"] - first
        miss1, miss2 = 0.5 / (0.5 + r["e"]), 4.0 / (4.0 + r["e"])
        assert r["ln_fstar1"] == pytest.approx(math.log(miss1) + more * math.log1p(-miss1), abs=1e-6)
        tail = math.log1p(first * miss2)
        want = math.log(r["n"] + 1) + 2 * math.log(miss2) + more * math.log1p(-miss2) - tail
        assert r["ln_fstar2"] == pytest.approx(want, abs=1e-6)
    fitted = fit.fit_starts(df, fit.random_starts(3), max_iterations=3).collect()
    assert len(fitted) == 3 and all(r["loglik"] < 0 for r in fitted)
    step = fit.fit_step(df, params).first()
    assert step["loglik"] == pytest.approx(fit.mixture_loglik(df, params).first()[0], rel=1e-10)


@pytest.mark.parametrize("a, b", [(0.2, 0.1), (1e-4, 0.3), (30.0, 8.0), (300.0, 300.0)])
def test_integral_and_sum_agree(a, b):
    e = 40.0 * 1.1 ** np.arange(-20.0, 20.0)
    for got, want in zip(mixture_sums.reached(e, a, b, 32), mixture_sums._summed(e, a, b, 32)):
        assert got == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_loglik_with_one_component(cells):
    want = sum(r["w"] * ln_truncated(r["n"], r["e"], DEFAULT_PARAMS.alpha1, DEFAULT_PARAMS.beta1, 3) for r in cells.collect())
    assert fit.mixture_loglik(cells, DEFAULT_PARAMS).first()[0] == pytest.approx(want, rel=1e-6)


def test_share_is_the_weighted_mean(cells):
    resp = fit.mixture_responsibilities(cells, PLAIN).collect()
    want = sum(r["w"] * r["r"] for r in resp) / sum(r["w"] for r in resp)
    assert fit.mixing_share(fit.mixture_responsibilities(cells, PLAIN)).first()[0] == pytest.approx(want)


@pytest.fixture(scope="module")
def planted(spark):
    draw = np.random.default_rng(5)
    theta = MixtureParams(2.0, 4.0, 3.0, 0.8, 0.7)
    first = draw.uniform(size=4000) < theta.p
    rate = np.where(first, draw.gamma(theta.alpha1, 1 / theta.beta1, 4000), draw.gamma(theta.alpha2, 1 / theta.beta2, 4000))
    e = draw.uniform(0.5, 8, 4000)
    n = draw.poisson(rate * e)
    data = [(int(a), 1, float(b)) for a, b in zip(n, e) if a >= 1]
    return theta, spark.createDataFrame(data, "n long, w long, e double").repartition(4).cache()


def test_fit_reaches_the_planted_likelihood(planted):
    theta, cells = planted
    at_theta = fit.mixture_loglik(cells, theta).first()[0]
    row = fit.fit_mixture(cells, store=unwritten).first()
    assert row["loglik"] >= at_theta - 0.5
    assert fit.fitted_params(fit.fit_mixture(cells, max_iterations=0)).p == pytest.approx(PLAIN.p)


def test_likelihood_never_falls(planted):
    _, cells = planted
    found = [fit.fit_mixture(cells, max_iterations=k).first()["loglik"] for k in (0, 1, 2, 4)]
    assert found == sorted(found)


def test_best_of_many_starts(planted):
    _, cells = planted
    starts = [*fit.random_starts(3), MixtureParams(-1, 1, 1, 1, 0.5)]
    each = fit.fit_starts(cells, starts, max_iterations=6).collect()
    assert {r["start"] for r in each} <= {0, 1, 2}
    best = fit.fit_mixture_multistart(cells, n_starts=3, max_iterations=6).first()
    assert best["loglik"] == pytest.approx(max(r["loglik"] for r in each), abs=1e-6)
    with pytest.raises(ValueError):
        fit.fit_mixture(cells, MixtureParams(-1, 1, 1, 1, 0.5))


def test_pass_sums_are_those_of_the_expressions(cells):
    """The sums of a pass against likelihood and gradient in SQL, also far out and with a small tail."""
    for t in (PLAIN, MixtureParams(50.0, 30.0, 1e-3, 2.0, 0.9), MixtureParams(1e6, 6e5, 3.0, 2e4, 0.2)):
        found = fit._sums(fit._doubles(cells), {(0, 0): dataclasses.astuple(t)}, 3)[0, 0]
        assert found["loglik"] == pytest.approx(fit.mixture_loglik(cells, t).first()[0], rel=1e-9)
        slopes = fit.mixture_gradient(cells, t).first()
        for k, name in (("u1", "alpha1"), ("v1", "beta1"), ("u2", "alpha2"), ("v2", "beta2")):
            assert found[k] == pytest.approx(slopes[f"d_{name}"] * getattr(t, name), rel=1e-6, abs=1e-6)


def test_extrapolation_takes_fewer_passes_to_no_less_likelihood(planted, monkeypatch):
    _, cells = planted
    fast = fit.fit_mixture(cells).first()
    monkeypatch.setattr(fit, "_extrapolated", lambda *_: [])
    plain = fit.fit_mixture(cells).first()
    assert fast["loglik"] >= plain["loglik"] - 0.01
    assert fast["iterations"] <= plain["iterations"]


def test_limits_keep_the_mean():
    a, b = fit._bounded(np.array([12.0, 11.0]), 8.0)
    assert (a / b, a) == (pytest.approx(math.e), pytest.approx(math.exp(8.0)))
    a, b = fit._bounded(np.array([-12.0, -11.0]), 8.0)
    assert (a / b, a) == (pytest.approx(1 / math.e), pytest.approx(math.exp(-8.0)))


def test_nothing_to_fit(spark):
    assert fit.fit_mixture(spark.createDataFrame([], "n long, w long, e double")).count() == 0
