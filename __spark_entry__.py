"""

Reports are the orders of the driver tables (FIXTURES.md).  Doubles are rounded so that the
order of summation in either engine does not show.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce
from operator import add

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Observation, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from pairsignal import fixtures  # noqa: E402
from pairsignal.operators import counts, expected, fit, network, pairs, reports, score, squash  # noqa: E402
from pairsignal.plans import stages  # noqa: E402
from pairsignal.plans.signals import (  # noqa: E402
    SignalConfig,
    find_signals,
    find_triples,
    signal_network,
    signals_of,
    squashed,
    triples_of,
)
from pairsignal.schema import DEFAULT_COLUMNS, MixtureParams, YEAR_COLUMNS  # noqa: E402
from pairsignal.sources import lines  # noqa: E402
from pairsignal.sources.stage_tables import read_stage_table, write_bucketed, write_stage_table  # noqa: E402
from pairsignal.sources.written import shared_folder, store_all, written  # noqa: E402

try:  # the folder of these operators may be absent; nothing else that is missing is passed over
    import corpus_pipeline
    from pairsignal.llm import registry as llm
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "pairsignal.llm"):
        raise
    llm = corpus_pipeline = None

ENTRY_DIR = "/root/testdata/sf0.001"
PLAIN = fit.PLAIN_START
RATE = SignalConfig(cols=YEAR_COLUMNS, posterior="rate", cap=None)
SCALE = SignalConfig(cols=YEAR_COLUMNS, posterior="scale", cap=score.CAP)
# The network of the fixture needs weaker signals to have more than a few edges.
NETWORK = SignalConfig(cols=YEAR_COLUMNS, posterior="rate", cap=None, min_ebci=1.0)


def entry(spark: SparkSession) -> DataFrame:
    """Ranked signals: item pairs reported with an outcome more often than expected."""
    return find_signals(*fixtures.report_inputs(spark, ENTRY_DIR), RATE)


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _inputs(spark, sf):
    return fixtures.report_inputs(spark, sf)


def _tables(spark, sf, cols):
    return reports.report_tables(*_inputs(spark, sf), cols)


def _pair_counts(spark, sf, cols):
    t = reports.report_tables(*_inputs(spark, sf), cols, written)
    return t, counts.pair_react_counts(t.items, t.outcomes, cols)


def _marginals(spark, sf, cols):
    t, pair_counts = _pair_counts(spark, sf, cols)
    return expected.pair_marginals(
        written(pair_counts),
        written(counts.stratum_counts(t.reports, cols)),
        written(counts.drug_counts(t.items, cols)),
        written(counts.react_counts(t.outcomes, cols)),
        cols,
    )


def _all_triples(spark, sf, cols):
    config = SignalConfig(cols=cols, min_actual=1)
    return _rounded(find_triples(*_inputs(spark, sf), config), 6, "expected")


def _triples(spark, sf):
    """Triples with at least three reports, exposures rounded against ulps in ties."""
    return written(_rounded(find_triples(*_inputs(spark, sf), SCALE), 9, "expected"))


def _cells(spark, sf):
    return written(fit.fit_input(squashed(_triples(spark, sf))))


def _fitted(run):
    """A fit with its flags.  The fixture's counts are as good as Poisson, so alpha runs to any limit
    and the parameters themselves say little; both engines get a limit that they reach."""

    def fitted(spark, sf):
        found = run(_cells(spark, sf), largest=oracle.FIT_LIMIT)
        return _rounded(found.select("start", "loglik", "iterations", "converged", "at_limit"), 1, "loglik")

    return fitted


def _scores(step, *names):
    def run(spark, sf):
        return _rounded(step(_triples(spark, sf)), 6, "expected", *names)

    return run


def _signals(config):
    def run(spark, sf):
        return _rounded(find_signals(*_inputs(spark, sf), config), 6, "expected", "rrr", "ebgm", "ebci")

    return run


def _network(spark, sf):
    signals = find_signals(*_inputs(spark, sf), NETWORK, order=False)
    # Exact-match rename to have combination products in the data.
    for item in ("drug1", "drug2"):
        combined = F.when(F.col(item) == "Brand#1", "Brand#1/Brand#2").otherwise(F.col(item))
        signals = signals.withColumn(item, combined)
    return _rounded(signals, 6, "expected", "rrr", "ebgm", "ebci")


def _edges(spark, sf):
    _, edges = signal_network(_network(spark, sf))
    return edges.withColumn("reactions", F.concat_ws("$", "reactions"))


def _scratch(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _read_lines(spark, sf):
    """The three sources written as text files and read as report lines."""
    counted = []
    for name, make in (("demos", fixtures.demo_lines), ("drugs", fixtures.drug_lines), ("reactions", fixtures.react_lines)):
        path = _scratch(spark, name)
        make(spark, sf).write.text(path)
        lines_ = lines.read_report_lines(spark, path)
        text = F.col(lines_.columns[0])
        counted.append(lines_.agg(
            F.lit(name).alias("source"), F.count("*").alias("n"), F.sum(F.length(text)).alias("chars"),
            F.min(text).alias("first"), F.max(text).alias("last"),
        ))
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def _stage_round_trip(spark, sf, fmt):
    """Triples written as a stage table and read again."""
    root, name = _scratch(spark, "stages"), "drugs2_reacs_actual_expected"
    triples = find_triples(*_inputs(spark, sf), SCALE)
    write_stage_table(triples, root, name, YEAR_COLUMNS, fmt)
    return _rounded(read_stage_table(spark, root, name, YEAR_COLUMNS, fmt), 6, "expected")


def _observed_counts(spark, sf):
    """Line counts of the jobs that parse the sources and keep the parsed rows."""
    seen = {name: Observation() for name in lines.SOURCES}
    written(lines.parse_demo(fixtures.demo_lines(spark, sf), seen=seen["demos"]))
    written(lines.parse_drug(fixtures.drug_lines(spark, sf), seen["drugs"]))
    written(lines.parse_react(fixtures.react_lines(spark, sf), seen["reactions"]))
    return lines.line_counts(spark, seen)


def _bucketed_expected(spark, sf):
    """Triples summed in place from the bucketed table of pair counts and marginals."""
    root, buckets, cols = _scratch(spark, "buckets"), 16, YEAR_COLUMNS
    tables = reports.report_tables(*_inputs(spark, sf), cols, written)
    marginals = expected.report_marginals(tables, cols, store=written)
    write_bucketed(marginals, root, stages.MARGINALS, cols.triple, buckets, cols)
    return _rounded(stages.bucketed_expected(spark, root, SCALE, buckets), 6, "expected")


def _sketched_cuts(spark, sf):
    """Cuts of two extracts whose sketches are kept as stage tables and merged: is each cut's rank
    within the bound?"""
    triples, name = _triples(spark, sf), "drugs2_reacs_sketches"
    kept = []
    for part in (0, 1):
        root = _scratch(spark, "sketches")
        extract = triples.where(F.crc32(F.concat_ws("/", "drug1", "drug2", "react")) % 2 == part)
        write_stage_table(squash.cut_sketches(extract), root, name, YEAR_COLUMNS, "parquet" if part else "text")
        kept.append(read_stage_table(spark, root, name, YEAR_COLUMNS, "parquet" if part else "text"))
    cuts = written(squash.cuts_of_sketches(squash.merged_sketches(*kept)))
    errors = squash.rank_errors(triples, cuts)
    return errors.select("actual", "n_group", "i", (F.col("rank_error") <= squash.SKETCH_ERROR).alias("within"))


def _stage_digests(spark, sf, fmt):
    """Every stage table written and read again: rows, sum of all numbers, letters in all texts."""
    cols = YEAR_COLUMNS
    demo, drug, react = _inputs(spark, sf)
    demo = written(demo)
    drug, react = store_all(
        written,
        reports.of_reports(drug.select(cols.report, cols.item), demo, cols),
        reports.of_reports(react.select(cols.report, cols.outcome), demo, cols),
    )
    t = reports.report_tables(demo, drug, react, cols, written)
    found = written(triples_of(t, SCALE))
    triples = written(_rounded(found, 9, "expected"))
    signals = written(_rounded(signals_of(found, NETWORK), 6, "expected", "rrr", "ebgm", "ebci"))
    nodes, edges = signal_network(signals)
    tables = {
        "strat_drugs1_reacs": pairs.report_drug_react(demo, drug, react, cols, store=written),
        "strat_demo_counts": counts.stratum_counts(t.reports, cols),
        "strat_drugs_counts": counts.drug_counts(t.items, cols),
        "strat_reacs_counts": counts.react_counts(t.outcomes, cols),
        "strat_drugs_reacs_counts": counts.drug_react_counts(t.items, t.outcomes, cols),
        "strat_drugs2_reacs": pairs.report_pair_react(demo, drug, react, cols, store=written),
        "strat_drugs2_reacs_counts": counts.pair_react_counts(t.items, t.outcomes, cols),
        "drugs2_reacs_actual_expected": _rounded(triples, 6, "expected"),
        "drugs2_reacs_stats": _rounded(squashed(triples), 5, "sum_expected"),
        "scored_drugs2_reacs": signals, "network_nodes": nodes, "network_edges": edges,
    }
    root, digests = _scratch(spark, "stages"), []
    for name, df in tables.items():
        write_stage_table(df, root, name, cols, fmt)
        read = read_stage_table(spark, root, name, cols, fmt)
        numbers = [F.col(c).cast("double") for c, kind in read.dtypes if kind in ("bigint", "int", "double")]
        letters = [F.length(F.concat_ws("", c)) for c, kind in read.dtypes if kind in ("string", "array<string>")]
        digests.append(read.agg(
            F.lit(name).alias("stage_table"), F.count("*").alias("n"), F.round(F.sum(reduce(add, numbers)), 2).alias("numbers"),
            F.coalesce(F.sum(reduce(add, letters, F.lit(0))), F.lit(0)).cast("long").alias("letters"),
        ))
    return reduce(DataFrame.unionByName, digests)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    full, year = DEFAULT_COLUMNS, YEAR_COLUMNS
    drug = lambda spark, sf: lines.parse_drug(fixtures.drug_lines(spark, sf))
    demo = lambda spark, sf: lines.parse_demo(fixtures.demo_lines(spark, sf))
    return {
        "ingest_line_counts": lambda s, d: lines.ingest_line_counts(
            fixtures.demo_lines(s, d), fixtures.drug_lines(s, d), fixtures.react_lines(s, d)
        ),
        "parse_demo": demo,
        "valid_demo_filter": lambda s, d: lines.demo_fields(fixtures.demo_lines(s, d))
        .groupBy("valid").agg(F.count("*").alias("n"), F.sum("age").alias("sum_age")),
        "parse_drug": drug,
        "parse_react": lambda s, d: lines.parse_react(fixtures.react_lines(s, d)),
        "dedupe_cases": lambda s, d: lines.dedupe_cases(demo(s, d)),
        "report_drug_react": lambda s, d: pairs.report_drug_react(*_inputs(s, d), store=written),
        "distinct_report_drugs": lambda s, d: reports.distinct_report_drugs(drug(s, d)),
        "multi_drug_reports": lambda s, d: reports.multi_drug_reports(drug(s, d)),
        "drug_pairs": lambda s, d: pairs.drug_pairs(drug(s, d)),
        "report_pair_react": lambda s, d: pairs.report_pair_react(*_inputs(s, d), store=written),
        "stratum_counts": lambda s, d: counts.stratum_counts(_tables(s, d, full).reports),
        "drug_counts": lambda s, d: counts.drug_counts(_tables(s, d, full).items),
        "react_counts": lambda s, d: counts.react_counts(_tables(s, d, full).outcomes),
        "drug_react_counts": lambda s, d: (
            lambda t: counts.drug_react_counts(t.items, t.outcomes)
        )(reports.report_tables(*_inputs(s, d), full, written)),
        "pair_react_counts": lambda s, d: _pair_counts(s, d, full)[1],
        "pair_react_counts_by_year": lambda s, d: _pair_counts(s, d, year)[1],
        "pair_marginals": lambda s, d: _marginals(s, d, year),
        "pair_stratum_expected": lambda s, d: _rounded(
            expected.pair_stratum_expected(_marginals(s, d, year)), 6, "expected"
        ),
        "actual_expected": lambda s, d: _all_triples(s, d, full),
        "actual_expected_by_year": lambda s, d: _all_triples(s, d, year),
        "min_actual_filter": lambda s, d: _rounded(
            find_triples(*_inputs(s, d), SCALE), 6, "expected"
        ),
        "quantile_cuts": lambda s, d: _rounded(
            squash.quantile_cuts(_triples(s, d), store=written), 6, *squash.CUTS
        ),
        "quantile_cuts_approx": lambda s, d: _rounded(
            squash.quantile_cuts(_triples(s, d), mode="approx"), 6, *squash.CUTS
        ),
        "quantile_cuts_sketched": _sketched_cuts,
        "ingest_line_counts_observed": _observed_counts,
        "parse_demo_normalized": lambda s, d: lines.parse_demo(fixtures.demo_lines(s, d), normalize_strata=True),
        "actual_expected_bucketed": _bucketed_expected,
        "every_stage_table_parquet": lambda s, d: _stage_digests(s, d, "parquet"),
        "every_stage_table_text": lambda s, d: _stage_digests(s, d, "text"),
        "binned_expected": lambda s, d: (
            lambda t: _rounded(
                squash.binned_expected(t, written(squash.quantile_cuts(t))), 6, "expected"
            )
        )(_triples(s, d)),
        "squashed_stats": lambda s, d: _rounded(squashed(_triples(s, d)), 5, "sum_expected"),
        "nb_pmf": _scores(lambda t: score.nb_pmf(t, PLAIN), "ln_pmf1", "ln_pmf2"),
        "posterior_weight": _scores(lambda t: score.posterior_weight(t, PLAIN), "q"),
        "posterior_log_mean": _scores(score.posterior_log_mean, "delta1", "delta2"),
        "ebgm_scores": _scores(score.ebgm_scores, "ebgm"),
        "ebgm_scores_mixed": _scores(lambda t: score.ebgm_scores(t, PLAIN), "ebgm"),
        "ebci_bounds": _scores(
            lambda t: score.ebci_bounds(t, posterior="scale", cap=score.CAP), "ebci"
        ),
        "ebci_bounds_mixed": _scores(
            lambda t: score.ebci_bounds(
                score.ebci_bounds(t, PLAIN, "scale").withColumnRenamed("ebci", "ebci_scale"), PLAIN
            ), "ebci_scale", "ebci",
        ),
        "ebci_bounds_rate": _scores(
            lambda t: score.ebci_bounds(t, posterior="rate", cap=None), "ebci"
        ),
        "rrr": _scores(score.rrr, "rrr"),
        "scored_signals": _signals(SCALE),
        "scored_signals_rate": _signals(RATE),
        "fit_input": lambda s, d: _rounded(_cells(s, d), 6, "e"),
        "truncated_pmf": lambda s, d: _rounded(
            fit.truncated_pmf(_cells(s, d), PLAIN), 6, "e", "ln_fstar1", "ln_fstar2"
        ),
        "mixture_loglik": lambda s, d: _rounded(
            fit.mixture_loglik(_cells(s, d), PLAIN), 3, "loglik"
        ),
        "mixture_responsibilities": lambda s, d: _rounded(
            fit.mixture_responsibilities(_cells(s, d), PLAIN), 6, "e", "r"
        ),
        "mixture_gradient": lambda s, d: _rounded(
            fit.mixture_gradient(_cells(s, d), PLAIN), 3,
            "d_alpha1", "d_beta1", "d_alpha2", "d_beta2",
        ),
        "fit_step": lambda s, d: _rounded(
            fit.fit_step(_cells(s, d), PLAIN), 4, *fit.THETA, "loglik"
        ),
        "read_report_lines": _read_lines,
        "stage_table_parquet": lambda s, d: _stage_round_trip(s, d, "parquet"),
        "stage_table_text": lambda s, d: _stage_round_trip(s, d, "text"),
        "scored_signals_mixed": _signals(
            SignalConfig(cols=YEAR_COLUMNS, params=PLAIN, min_ebci=1.0)
        ),
        "fit_mixture": _fitted(fit.fit_mixture),
        "fit_starts": _fitted(lambda cells, **o: fit.fit_starts(cells, fit.random_starts(), **o)),
        "fit_mixture_multistart": _fitted(fit.fit_mixture_multistart),
        "combination_filter": lambda s, d: network.combination_filter(_network(s, d)),
        "signal_nodes": lambda s, d: signal_network(_network(s, d))[0],
        "signal_edges": _edges,
        **(llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    said = llm.oracle_sql() | {"pipeline": corpus_pipeline.ORACLE_SQL} if llm else {}
    return oracle.statements() | {name: sql for name, sql in said.items() if sql}
