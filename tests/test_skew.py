"""One report, drug or copy group that holds much of the data gives the same results in parts."""

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F
from conftest import rows

from pairsignal.operators import counts, expected, pairs, reports, skew, squash
from pairsignal.operators.counts import drug_react_counts, pair_react_counts
from pairsignal.schema import Columns
from pairsignal.sources.written import written

COLS = Columns(strata=("gender",))


@pytest.fixture(scope="module")
def skewed(spark):
    demo = spark.createDataFrame([(i, "F" if i % 2 else "M") for i in range(20)], "isr long, gender string")
    items = {0: [f"d{i:02}" for i in range(40)], **{i: [f"d{i:02}", "d00", "d01"] for i in range(1, 20)}}
    terms = {0: [f"r{i}" for i in range(9)] + ["r0"] * 25, **{i: ["r0", f"r{i % 3}"] for i in range(1, 20)}}
    drug = spark.createDataFrame([(i, d) for i, ds in items.items() for d in ds], "isr long, drug string")
    react = spark.createDataFrame([(i, r) for i, rs in terms.items() for r in rs], "isr long, react string")
    return demo, drug, react, items, terms


def brute_pairs(items):
    return {i: list(itertools.combinations(sorted(set(ds)), 2)) for i, ds in items.items()}


@pytest.mark.parametrize("block", [2, 7, 512])
def test_pairs_meet_once(skewed, block):
    _, drug, _, items, _ = skewed
    want = sorted((i, *p) for i, ps in brute_pairs(items).items() for p in ps)
    assert rows(pairs.drug_pairs(drug, COLS, block)) == want


@pytest.mark.parametrize("block,per_chunk", [(3, 4), (512, 1024)])
def test_joins_keep_copies(skewed, block, per_chunk):
    demo, drug, react, items, terms = skewed
    sex = lambda i: "F" if i % 2 else "M"
    want = Counter((d, r, i, sex(i)) for i in items for d in items[i] for r in terms[i])
    assert Counter(rows(pairs.report_drug_react(demo, drug, react, COLS, block, per_chunk))) == want
    want = Counter((*p, r, i, sex(i)) for i, ps in brute_pairs(items).items() for p in ps for r in terms[i])
    assert Counter(rows(pairs.report_pair_react(demo, drug, react, COLS, block, per_chunk))) == want


@pytest.mark.parametrize("block", [3, 512])
def test_counts_in_blocks(skewed, block):
    demo, drug, react, items, terms = skewed
    t = reports.report_tables(demo, drug, react, COLS)
    sex = lambda i: "F" if i % 2 else "M"
    want = Counter((sex(i), d, r) for i in items for d in set(items[i]) for r in set(terms[i]))
    assert dict((r[:3], r[3]) for r in rows(drug_react_counts(t.items, t.outcomes, COLS, block))) == want
    want = Counter((sex(i), *p, r) for i, ps in brute_pairs(items).items() for p in ps for r in set(terms[i]))
    assert dict((r[:4], r[4]) for r in rows(pair_react_counts(t.items, t.outcomes, COLS, block))) == want


def test_hot_keys_in_parts(spark):
    big = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS v")
    table = big.groupBy("k").count().withColumnRenamed("count", "n")
    hot = skew.heaviest_keys(table, ["k"], "n", rows_per_salt=10)
    assert rows(hot) == [(0, 34)]
    got = skew.join_spread(big, table, ["k"], hot, ["v"])
    assert rows(got, "k", "v", "n") == rows(big.join(table, "k"), "k", "v", "n")


def test_every_heavy_key_is_split_and_they_are_few(spark):
    weights = spark.range(1000).selectExpr("id AS k", "1000 - id AS n")
    hot = {r["k"]: r["salts"] for r in skew.heaviest_keys(weights, ["k"], "n", rows_per_salt=400).collect()}
    assert hot == {k: -(-(1000 - k) // 400) for k in range(600)}
    # Parts grow with the whole, so that fewer than ``most`` keys are ever above them.
    total = 1000 * 1001 // 2
    for most in (3, 700):
        part = max(1, total / most)
        hot = skew.heaviest_keys(weights, ["k"], "n", rows_per_salt=1, most=most).collect()
        assert {r["k"] for r in hot} == {k for k in range(1000) if 1000 - k > part} and len(hot) < most


def test_joins_in_parts_equal_plain_joins(skewed):
    demo, drug, react, *_ = skewed
    t = reports.report_tables(demo, drug, react, COLS, written)
    pair_counts = written(pair_react_counts(t.items, t.outcomes, COLS))
    counted = [written(f) for f in (counts.stratum_counts(t.reports, COLS), counts.drug_counts(t.items, COLS), counts.react_counts(t.outcomes, COLS))]
    plain = pair_counts
    for item, out in (("drug1", "n_drug1"), ("drug2", "n_drug2")):
        plain = plain.join(counted[1].toDF("gender", item, out), ["gender", item])
    plain = plain.join(counted[2], ["gender", "react"]).join(counted[0], ["gender"])
    got = expected.pair_marginals(pair_counts, *counted, COLS, rows_per_salt=5)
    assert rows(got, *sorted(got.columns)) == rows(plain, *sorted(got.columns))

    got = expected.with_marginals(t.items, counted[1], "drug", "n_drug", COLS, 1, rows_per_salt=5)
    plain = t.items.join(counted[1], ["gender", "drug"])
    assert rows(got, *sorted(got.columns)) == rows(plain, *sorted(got.columns))
    triples = written(expected.report_actual_expected(t, COLS, store=written))
    assert rows(expected.report_actual_expected(t, COLS, store=written, rows_per_salt=5)) == rows(triples)

    sizes = drug.groupBy("isr").count().withColumnRenamed("count", "n_items")
    got = reports.join_names(drug, sizes, "n_items", ["drug"], COLS, rows_per_salt=5)
    assert rows(got, *sorted(got.columns)) == rows(drug.join(sizes, "isr"), *sorted(got.columns))

    cuts = written(squash.quantile_cuts(triples))
    got = squash.binned_expected(triples, cuts, rows_per_salt=5)
    assert rows(got) == rows(squash.binned_expected(triples, cuts))


def test_pruning_rare_names_is_exact(skewed):
    demo, drug, react, *_ = skewed
    t = reports.report_tables(demo, drug, react, COLS)
    every = rows(expected.report_actual_expected(t, COLS))
    assert rows(expected.report_actual_expected(t, COLS, min_actual=3)) == [r for r in every if r[3] >= 3]


def test_counts_of_many_rows_are_not_sent_whole(spark, monkeypatch):
    """Their file would be small enough for a broadcast; their rows in the driver would not."""
    rows_of = spark.range(400).selectExpr("id AS isr", "CAST(id AS STRING) AS gender", "'a' AS drug")
    counted = written(rows_of.groupBy("gender", "drug").agg(F.count("*").alias("n_drug")))
    for most, sent in ((400, True), (399, False)):
        monkeypatch.setattr(skew.grows, "__defaults__", (most,))
        got = expected.with_marginals(rows_of, counted, "drug", "n_drug", COLS, 1)
        assert len(got.collect()) == 400
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert ("SortMergeJoin" not in plan) == sent
