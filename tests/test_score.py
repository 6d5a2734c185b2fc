import math

import numpy as np
import pytest
from conftest import rows

from pyspark.sql import functions as F

from pairsignal.functions.gamma_quantile import gamma_cdf, mixture_quantile
from pairsignal.functions.special import digamma, ln_gamma
from pairsignal.operators import score
from pairsignal.schema import DEFAULT_PARAMS, MixtureParams

PLAIN = MixtureParams(0.2, 0.1, 2.0, 4.0, 1 / 3)


def triples(spark, pairs):
    data = [(f"a{i:03}", "b", "r", n, e) for i, (n, e) in enumerate(pairs)]
    return spark.createDataFrame(
        data, "drug1 string, drug2 string, react string, actual long, expected double"
    )


def test_special_functions(spark):
    xs = [1e-6, 6.8e-7, 0.1, 0.5, 1.0, 1.5, 3.0, 10.0, 100.0, 12345.6, 1e6, 1e9]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.selectExpr("x", f"{ln_gamma('x')} AS lg", f"{digamma('x')} AS psi", f"{digamma('(x + 1D)')} AS next").collect()
    for r in got:
        assert r["lg"] == pytest.approx(math.lgamma(r["x"]), rel=1e-12, abs=1e-12)
        assert r["next"] - r["psi"] == pytest.approx(1 / r["x"], rel=1e-9, abs=1e-12)
    assert got[4]["psi"] == pytest.approx(-0.5772156649015329, abs=1e-12)


def test_pmf_sums_to_one(spark):
    df = triples(spark, [(n, 2.5) for n in range(400)])
    total = score.nb_pmf(df, PLAIN).agg(F.sum(F.exp("ln_pmf1")), F.sum(F.exp("ln_pmf2"))).first()
    assert total[0] == pytest.approx(1, abs=1e-6) and total[1] == pytest.approx(1, abs=1e-12)


def test_shipped_ebgm_and_ratio(spark):
    r = score.rrr(score.ebgm_scores(triples(spark, [(3, 3.0)]))).first()
    assert r["rrr"] == 1.0
    assert r["ebgm"] == pytest.approx(0.7775, abs=5e-5)


def test_weight_at_the_ends(spark):
    df = triples(spark, [(3, 3.0), (500, 0.001), (5, 1e6)])
    ends = {p: [r["q"] for r in score.posterior_weight(df, MixtureParams(1, 1, 2, 2, p)).collect()] for p in (0.0, 1.0)}
    assert ends == {0.0: [0.0] * 3, 1.0: [1.0] * 3}


def test_gamma_cdf_at_integer_shape():
    for a in (1, 3, 40, 199, 200, 500):
        x = np.array([0.3, 0.7, 0.95, 1.0, 1.1, 1.6]) * a
        shape = np.full_like(x, float(a))
        lg = np.full_like(x, math.lgamma(a))
        ks = np.arange(a)
        lf = np.array([math.lgamma(k + 1) for k in ks])
        want = [1 - math.fsum(np.exp(ks * math.log(v) - v - lf)) for v in x]
        assert gamma_cdf(shape, x, lg) == pytest.approx(want, abs=1e-11)


def test_quantile_has_the_right_tail():
    draw = np.random.default_rng(1)
    n = 500
    a1, a2 = draw.integers(1, 400, n) + 0.2, draw.integers(1, 400, n) + 2.0
    s1, s2, q = draw.uniform(0.01, 5, n), draw.uniform(0.01, 5, n), draw.uniform(0, 1, n)
    q[:2] = 0, 1
    lg = np.vectorize(math.lgamma)
    v = mixture_quantile(0.05, q, a1, s1, lg(a1), a2, s2, lg(a2))
    back = q * gamma_cdf(a1, v / s1, lg(a1)) + (1 - q) * gamma_cdf(a2, v / s2, lg(a2))
    assert back == pytest.approx(np.full(n, 0.05), abs=1e-10)


def poisson_cdf(a, x):
    """P(a, x) for an integer shape, as one minus a Poisson sum over the terms that matter."""
    ks = np.arange(max(0, int(min(a, x) - 60 * math.sqrt(x) - 60)), a)
    logs = ks * math.log(x) - x - np.array([math.lgamma(k + 1) for k in ks])
    return 1 - math.fsum(np.exp(logs))


@pytest.mark.parametrize("a", [200, 500, 912, 5000, 40000])
def test_gamma_cdf_far_from_a_large_shape(a):
    ratio = [0.5, 0.9, 0.99, 1.0, 1.01, 1.1, 1.5, 2, 10, 50, 200, 1000]
    x = np.array([r * a for r in ratio] + [a + k * math.sqrt(a) for k in (-6, -3, -1, 1, 3, 6, 11.9, 12.1)])
    got = gamma_cdf(np.full_like(x, float(a)), x, np.full_like(x, math.lgamma(a)))
    assert got == pytest.approx([poisson_cdf(a, v) for v in x], abs=1e-9)


@pytest.mark.parametrize("a", [1e5, 1e6, 1e8])
def test_gamma_cdf_of_huge_shapes(a):
    """Against the first terms of the uniform expansion in the shape."""
    k = np.array([-8.0, -3, -1, -0.1, 0.1, 1, 3, 8, 1e3, 1e6])
    x = a + k * math.sqrt(a)
    x, k = x[x > 0], k[x > 0]
    got = gamma_cdf(np.full_like(x, a), x, np.full_like(x, math.lgamma(a)))
    for v, g in zip(x, got):
        t = v / a
        eta = math.copysign(math.sqrt(max(0.0, 2 * (t - 1 - math.log1p(t - 1)))), t - 1)
        rest = math.exp(-0.5 * a * eta * eta) / math.sqrt(2 * math.pi * a) * (1 / (t - 1) - 1 / eta)
        assert g == pytest.approx(0.5 * math.erfc(-eta * math.sqrt(a / 2)) - rest, abs=2e-5)


def test_quantile_of_far_apart_components():
    """Component means a hundred times apart, by bisection over Poisson sums."""
    for n1, n2, s1, s2, q in ((912, 914, 80.0, 0.14, 0.881), (250, 260, 1.0, 0.01, 0.03), (300, 210, 0.01, 1.0, 0.9)):
        low, high = 0.0, 1e6
        for _ in range(90):
            mid = (low + high) / 2
            below = q * poisson_cdf(n1, mid / s1) + (1 - q) * poisson_cdf(n2, mid / s2)
            low, high = (mid, high) if below < 0.05 else (low, mid)
        one = lambda v: np.array([float(v)])
        got = mixture_quantile(0.05, one(q), one(n1), one(s1), one(math.lgamma(n1)), one(n2), one(s2), one(math.lgamma(n2)))
        assert got[0] == pytest.approx(high, rel=1e-8)


def test_rise_of_ln_gamma_at_large_shapes(spark):
    """ln gamma(a + n) - ln gamma(a) is the sum of ln(a + k), which loses nothing."""
    from pairsignal.functions.special import ln_gamma_rise

    cases = [(a, n) for a in (6.8e-7, 0.2, 3.0, 1e3, 7e7, 1e11, 1e13) for n in (1, 5, 40, 3000)]
    df = spark.createDataFrame([(a, float(n)) for a, n in cases], "a double, n double")
    got = df.selectExpr("a", "n", f"{ln_gamma_rise('a', 'n')} AS rise").collect()
    for r in got:
        want = math.fsum(math.log(r["a"] + k) for k in range(int(r["n"])))
        assert r["rise"] == pytest.approx(want, rel=1e-13, abs=1e-11)


def test_the_bound_is_searched_once(spark):
    """The filter on the bound stays above the one node that runs Python."""
    df = triples(spark, [(3, 0.5), (20, 1.0)])
    plan = score.scored_signals(df, PLAIN, order=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_bounds_by_scale_and_rate(spark):
    df = triples(spark, [(5, 5.0), (3, 0.1), (50, 9.0)])
    rate = [r["ebci"] for r in score.ebci_bounds(df, posterior="rate", cap=None).collect()]
    scale = [r["ebci"] for r in score.ebci_bounds(df, posterior="scale", cap=score.CAP).collect()]
    assert rate[:2] == pytest.approx([0.38, 2.43], abs=0.005)
    assert scale == [-1.0, pytest.approx(0.28, abs=0.005), -1.0]
    with pytest.raises(ValueError):
        score.ebci_bounds(df, posterior="other")


@pytest.mark.parametrize("params", [DEFAULT_PARAMS, PLAIN])
@pytest.mark.parametrize("posterior,cap", [("scale", 10.0), ("rate", None)])
def test_signals_lose_nothing_to_the_early_filter(spark, params, posterior, cap):
    df = triples(spark, [(n, e / 7) for n in (1, 2, 3, 4, 8, 20, 60) for e in range(1, 90, 4)])
    bounds = score.ebci_bounds(df.where("actual >= 3"), params, posterior, cap).where("ebci >= 2")
    got = score.scored_signals(df, params, 3, posterior, cap)
    assert rows(got, "drug1") == rows(bounds, "drug1")
    ebgm = [r["ebgm"] for r in got.collect()]
    assert ebgm and ebgm == sorted(ebgm, reverse=True)
    assert got.columns == ["drug1", "drug2", "react", "actual", "expected", "rrr", "ebgm", "ebci"]
