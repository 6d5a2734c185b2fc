import random

import pytest
from conftest import rows

from pairsignal.operators.squash import (
    CUTS,
    SKETCH_ERROR,
    binned_expected,
    cut_sketches,
    cuts_of_sketches,
    merged_sketches,
    quantile_cuts,
    rank_errors,
    squashed_stats,
)
from pairsignal.sources.written import written


def triples(spark, groups):
    data = [(a, float(v), f"t{i}") for a, vs in groups.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(data, "actual long, expected double, name string").repartition(4)


def by_rank(values):
    v, n = sorted(values), len(values)
    return [v[0], *[v[-(-i * n // 10) - 1] for i in range(1, 10)], v[-1]]


@pytest.fixture(scope="module")
def groups():
    draw = random.Random(7)
    sized = {n: [draw.lognormvariate(0, 3) for _ in range(n)] for n in (1, 2, 3, 9, 10, 11, 37, 256, 300)}
    near = 1.0
    close = [near + i * 2.0**-52 for i in range(40)]
    return sized | {
        1000: [1.0] * 50, 1001: [1.0] * 20 + [2.0] * 5, 1002: close, 1003: [0.0, 1e-300, 5e-324, 1e300, 0.5, 2.0],
        1004: [2.0**k for k in range(-30, 30)], 1005: [-3.0, -1.5, 0.0, 2.5, -1e-9], 1006: [0.1 + 0.2, 0.3],
    }


def test_exact_cuts(spark, groups):
    got = {r["actual"]: [r[c] for c in CUTS] for r in quantile_cuts(triples(spark, groups)).collect()}
    assert got == {a: by_rank(v) for a, v in groups.items()}


def test_approximate_cuts_stay_near_in_rank(spark):
    values = [float(i) for i in range(5000)]
    row = quantile_cuts(triples(spark, {3: values}), mode="approx", accuracy=1000).first()
    for i, c in enumerate(CUTS):
        assert abs(row[c] - by_rank(values)[i]) <= 2 * len(values) / 1000
    assert row["n_group"] == 5000


def test_bins(spark, groups):
    df = triples(spark, groups)
    got = binned_expected(df, quantile_cuts(df)).collect()

    def search(cuts, v):
        low, high = 0, 10
        while low <= high:
            mid = (low + high) // 2
            if cuts[mid] == v:
                return mid
            low, high = (mid + 1, high) if cuts[mid] < v else (low, mid - 1)
        return low

    assert len(got) == sum(map(len, groups.values()))
    assert all(r["bin"] == search(by_rank(groups[r["actual"]]), r["expected"]) for r in got)


def test_single_row_group_is_in_the_middle(spark):
    df = triples(spark, {3: [3.0]})
    assert rows(squashed_stats(binned_expected(df, quantile_cuts(df)))) == [(3, 5, 3.0, 1)]


def test_sketches_of_two_extracts_merge(spark):
    """Cuts from merged sketches: exact ends and sizes, inner ranks within the bound, also when skewed."""
    draw = random.Random(11)
    groups = {3: [draw.lognormvariate(0, 3) for _ in range(20_000)], 4: [1.0] * 900 + [2.0] * 100, 5: [0.5]}
    every = triples(spark, groups)
    halves = [every.where(f"crc32(name) % 2 = {i}") for i in (0, 1)]
    merged = merged_sketches(*[cut_sketches(h) for h in halves])
    cuts = cuts_of_sketches(merged).cache()
    assert cuts.columns == quantile_cuts(every).columns
    for r in cuts.collect():
        values = groups[r["actual"]]
        assert (r["n_group"], r["q0"], r["q10"]) == (len(values), min(values), max(values))
    errors = rank_errors(every, cuts).collect()
    assert len(errors) == 27 and max(r["rank_error"] for r in errors) <= SKETCH_ERROR
    assert {r["rank_error"] for r in rank_errors(every, quantile_cuts(every)).collect()} == {0.0}


def test_stored_steps_change_no_cut(spark):
    draw = random.Random(12)
    every = triples(spark, {3: [draw.random() for _ in range(500)], 7: [draw.random() for _ in range(33)]})
    assert rows(quantile_cuts(every, store=written)) == rows(quantile_cuts(every))
