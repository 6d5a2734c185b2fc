import random

import pytest
from conftest import rows

from pairsignal.operators import expected, reports
from pairsignal.operators.counts import (
    drug_counts,
    drug_react_counts,
    pair_react_counts,
    react_counts,
    stratum_counts,
)
from pairsignal.operators.expected import (
    actual_expected,
    pair_marginals,
    pair_stratum_expected,
    report_actual_expected,
)
from pairsignal.operators.pairs import drug_pairs, item_pair_products, report_drug_react, report_pair_react
from pairsignal.operators.reports import multi_drug_reports, report_tables
from pairsignal.schema import Columns, DEFAULT_COLUMNS
from pairsignal.sources.written import unwritten, written

S1, S2 = ("F", 40, "20090101"), ("M", 50, "20090202")


@pytest.fixture(scope="module", params=[unwritten, written])
def tables(request, example):
    return report_tables(*example, store=request.param)


def test_bag_join(example):
    got = rows(report_drug_react(*example))
    assert len(got) == 11
    assert got.count(("A", "X", 2, *S1)) == 2
    assert sum(r[2] == 5 for r in got) == 0


def test_counts(tables):
    assert rows(stratum_counts(tables.reports)) == [(*S1, 3), (*S2, 1)]
    assert rows(drug_counts(tables.items)) == [(*S1, "A", 3), (*S1, "B", 2), (*S2, "A", 1), (*S2, "B", 1)]
    assert rows(react_counts(tables.outcomes)) == [(*S1, "X", 3), (*S1, "Y", 1), (*S2, "X", 1)]
    assert (*S1, "A", "Y", 1) in rows(drug_react_counts(tables.items, tables.outcomes))
    assert rows(pair_react_counts(tables.items, tables.outcomes)) == [
        (*S1, "A", "B", "X", 2), (*S1, "A", "B", "Y", 1), (*S2, "A", "B", "X", 1)
    ]


def test_pairs(example):
    _, drug, _ = example
    assert rows(drug_pairs(drug)) == [(1, "A", "B"), (2, "A", "B"), (4, "A", "B"), (5, "A", "C")]
    assert rows(multi_drug_reports(drug)) == [(1, 2), (2, 2), (4, 2), (5, 2)]


def test_pair_join(example):
    assert rows(report_pair_react(*example)) == [
        ("A", "B", "X", 1, *S1), ("A", "B", "X", 2, *S1), ("A", "B", "X", 4, *S2), ("A", "B", "Y", 2, *S1)
    ]


def test_actual_expected(tables):
    t = tables
    marginals = pair_marginals(
        pair_react_counts(t.items, t.outcomes), stratum_counts(t.reports),
        drug_counts(t.items), react_counts(t.outcomes),
    )
    per_stratum = pair_stratum_expected(marginals)
    assert [round(r[0], 6) for r in rows(per_stratum, "expected")] == [0.666667, 1.0, 2.0]
    composed = rows(actual_expected(per_stratum))
    assert [(*r[:4], round(r[4], 6)) for r in composed] == [("A", "B", "X", 3, 3.0), ("A", "B", "Y", 1, 0.666667)]
    assert rows(report_actual_expected(t)) == composed
    assert rows(report_actual_expected(t, min_actual=3)) == composed[:1]


def test_large_products_do_not_wrap(spark):
    n = 100_000
    df = spark.createDataFrame([(n, n, n, 1)], "n_drug1 long, n_drug2 long, n_react long, n_stratum long")
    assert pair_stratum_expected(df).first()["expected"] == 1e15


def test_other_column_names(spark):
    cols = Columns(report="basket", case="visit", item="sku", outcome="event", strata=("shop",))
    demo = spark.createDataFrame([(1, "s"), (2, "s")], "basket long, shop string")
    items = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "basket long, sku string")
    events = spark.createDataFrame([(1, "return"), (2, "return")], "basket long, event string")
    t = report_tables(demo, items, events, cols)
    assert rows(report_actual_expected(t, cols)) == [("a", "b", "return", 1, 1.0)]


def test_shared_report_id_counts_in_both_strata(spark):
    cols = DEFAULT_COLUMNS
    demo = spark.createDataFrame(
        [(1, "F", 40, "20090101"), (1, "M", 40, "20090101")], "isr long, gender string, age long, fda_dt string"
    )
    drug = spark.createDataFrame([(1, "A"), (1, "B")], "isr long, drug string")
    react = spark.createDataFrame([(1, "X")], "isr long, react string")
    t = report_tables(demo, drug, react, cols)
    assert [r[-1] for r in rows(pair_react_counts(t.items, t.outcomes))] == [1, 1]
    assert rows(report_actual_expected(t)) == [("A", "B", "X", 2, 2.0)]


def sparse_tables(spark, n=400):
    """Reports whose names are mostly shared by few: most pairs are rare, some names are in all."""
    draw = random.Random(8)
    items = {i: {f"d{int(draw.paretovariate(0.5)) % 90}" for _ in range(draw.choice([1, 3, 6]))} for i in range(n)}
    outcomes = {i: {f"r{int(draw.paretovariate(0.6)) % 60}" for _ in range(draw.choice([1, 2, 5]))} for i in range(n)}
    demo = spark.createDataFrame([(i, "FM"[i % 2], 40, "20090101") for i in range(n)], "isr long, gender string, age long, fda_dt string")
    drug = spark.createDataFrame([(i, d) for i, ds in items.items() for d in ds], "isr long, drug string")
    react = spark.createDataFrame([(i, r) for i, rs in outcomes.items() for r in rs], "isr long, react string")
    return report_tables(demo, drug, react, store=written)


@pytest.mark.parametrize("least,rows_per_salt", [(3, 1_000_000), (2, 5)])
def test_level_wise_pruning_changes_no_triple(spark, least, rows_per_salt):
    t = sparse_tables(spark)
    rounded = lambda df: sorted((*r[:4], round(r[4], 9)) for r in df.collect())
    plain = rounded(report_actual_expected(t, min_actual=least, worth_pruning=1.0))
    pruned = report_actual_expected(t, min_actual=least, worth_pruning=0.0, store=written, rows_per_salt=rows_per_salt)
    assert plain and rounded(pruned) == plain


def test_level_wise_pruning_leaves_few_rows(spark):
    t, cols = sparse_tables(spark), DEFAULT_COLUMNS
    shares = expected._most_pruned(t, drug_counts(t.items), react_counts(t.outcomes), cols, 3)
    assert min(shares) > expected.WORTH_PRUNING  # so the levels are counted here without being told
    items, outcomes = expected.frequent_rows(t.items, t.outcomes, cols, 3, store=written)
    assert items.count() < t.items.count() and outcomes.count() < t.outcomes.count()
    pairs = item_pair_products(items, cols)
    kept = expected.frequent_item_pairs(pairs, cols, 3, written)
    assert kept.count() < 0.7 * item_pair_products(t.items, cols).count()


def test_names_that_are_all_frequent_are_not_counted_again(spark):
    demo = spark.createDataFrame([(i, "F", 40, "20090101") for i in range(60)], "isr long, gender string, age long, fda_dt string")
    drug = spark.createDataFrame([(i, d) for i in range(60) for d in "AB"], "isr long, drug string")
    react = spark.createDataFrame([(i, "X") for i in range(60)], "isr long, react string")
    t = report_tables(demo, drug, react)
    shares = expected._most_pruned(t, drug_counts(t.items), react_counts(t.outcomes), DEFAULT_COLUMNS, 3)
    assert max(shares) <= expected.WORTH_PRUNING


def test_rows_of_other_reports_go_before_they_are_grouped(spark, example):
    """Stored tables hold the reports of the demographics only, and are those made without a filter."""
    demo, drug, react = example
    demo, kept, cols = demo.where("isr > 2"), [], Columns(strata=("gender",))

    def store(df):
        kept.append(written(df))
        return kept[-1]

    stored, plain = reports.report_tables(demo, drug, react, cols, store), reports.report_tables(demo, drug, react, cols)
    for name in ("reports", "items", "outcomes"):
        want = getattr(plain, name)
        assert rows(getattr(stored, name), *want.columns) == rows(want)
    assert all({r["isr"] for r in df.collect()} <= {3, 4} for df in kept)
