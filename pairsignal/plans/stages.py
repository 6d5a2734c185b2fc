"""The same work as separate jobs that hand over stage tables under one root folder.

Each function reads the tables of the job before and writes its own, so any of them can be
run again alone.  ``fmt`` is ``parquet`` or ``text``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from pairsignal.operators.counts import (
    drug_counts,
    drug_react_counts,
    pair_react_counts,
    react_counts,
    stratum_counts,
)
from pairsignal.operators.expected import (
    actual_expected,
    min_actual_filter,
    pair_marginals,
    pair_stratum_expected,
    report_marginals,
)
from pairsignal.operators.pairs import report_drug_react, report_pair_react
from pairsignal.operators.reports import report_tables
from pairsignal.operators.score import scored_signals
from pairsignal.operators.squash import (
    binned_expected,
    cut_sketches,
    cuts_of_sketches,
    merged_sketches,
    squashed_stats,
)
from pairsignal.plans.signals import SignalConfig, mixture_for, signal_network, squashed
from pairsignal.sources.lines import (
    SOURCES,
    dedupe_cases,
    line_counts,
    parse_demo,
    parse_drug,
    parse_react,
    read_report_lines,
    with_year,
)
from pairsignal.sources.stage_tables import read_bucketed, read_stage_table, write_bucketed, write_stage_table
from pairsignal.sources.written import written


MARGINALS = "strat_drugs2_reacs_marginals"


def read_sources(
    spark: SparkSession, demos: str, drugs: str, reactions: str, normalize_strata: bool = False,
    observed: dict[str, Observation] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Deduplicated demographics, drugs and reactions from three folders of report lines.

    ``observed`` (one observation for each of ``lines.SOURCES``) counts lines as they are parsed.
    """
    seen = observed or {}
    demo = parse_demo(read_report_lines(spark, demos), normalize_strata, seen.get("demos"))
    return (
        with_year(dedupe_cases(demo)),
        parse_drug(read_report_lines(spark, drugs), seen.get("drugs")),
        parse_react(read_report_lines(spark, reactions), seen.get("reactions")),
    )


def run_counts(
    demo: DataFrame,
    drug: DataFrame,
    react: DataFrame,
    root: str,
    config: SignalConfig = SignalConfig(),
    fmt: str = "parquet",
    buckets: int | None = None,
    observed: dict[str, Observation] | None = None,
) -> DataFrame | None:
    """The joined reports, the joined pairs and the five stratified counts.

    With ``buckets``, the pair counts are also kept with their marginals, bucketed by triple.  With
    the observations of ``read_sources``, returns the raw, valid and rejected lines of each source,
    counted by the jobs that parse them: the sources are not read again.
    """
    cols = config.cols
    demo, drug, react = written(demo), written(drug), written(react)
    counted = line_counts(demo.sparkSession, observed) if observed else None
    t = report_tables(demo, drug, react, cols, written)
    outputs = {
        "strat_drugs1_reacs": report_drug_react(demo, drug, react, cols, store=written),
        "strat_demo_counts": stratum_counts(t.reports, cols),
        "strat_drugs_counts": drug_counts(t.items, cols),
        "strat_reacs_counts": react_counts(t.outcomes, cols),
        "strat_drugs_reacs_counts": drug_react_counts(t.items, t.outcomes, cols),
        "strat_drugs2_reacs": report_pair_react(demo, drug, react, cols, store=written),
        "strat_drugs2_reacs_counts": pair_react_counts(t.items, t.outcomes, cols),
    }
    for name, df in outputs.items():
        write_stage_table(df, root, name, cols, fmt)
    if buckets:
        write_bucketed(report_marginals(t, cols, store=written), root, MARGINALS, cols.triple, buckets, cols)
    return counted


def bucketed_expected(spark: SparkSession, root: str, config: SignalConfig, buckets: int) -> DataFrame:
    """Actual and expected counts from the bucketed pair table, which is read in place."""
    cols = config.cols
    rows = read_bucketed(spark, root, MARGINALS, cols.triple, buckets, cols)
    return actual_expected(pair_stratum_expected(rows), cols)


def run_expected(
    spark: SparkSession, root: str, config: SignalConfig = SignalConfig(), fmt: str = "parquet",
    buckets: int | None = None,
) -> None:
    """Actual and expected counts; with ``buckets`` from the bucketed table of ``run_counts``."""
    cols = config.cols
    if buckets:
        triples = bucketed_expected(spark, root, config, buckets)
        write_stage_table(triples, root, "drugs2_reacs_actual_expected", cols, fmt)
        return
    pairs, strata, drugs, reacts = (
        read_stage_table(spark, root, name, cols, fmt)
        for name in (
            "strat_drugs2_reacs_counts", "strat_demo_counts",
            "strat_drugs_counts", "strat_reacs_counts",
        )
    )
    marginals = pair_marginals(pairs, strata, drugs, reacts, cols)
    triples = actual_expected(pair_stratum_expected(marginals), cols)
    write_stage_table(triples, root, "drugs2_reacs_actual_expected", cols, fmt)


def _triples(spark: SparkSession, root: str, config: SignalConfig, fmt: str) -> DataFrame:
    name = "drugs2_reacs_actual_expected"
    return min_actual_filter(read_stage_table(spark, root, name, config.cols, fmt), config.min_actual)


def run_squash(
    spark: SparkSession, root: str, config: SignalConfig = SignalConfig(), fmt: str = "parquet"
) -> None:
    triples = _triples(spark, root, config, fmt).select("actual", "expected")
    write_stage_table(squashed(triples), root, "drugs2_reacs_stats", config.cols, fmt)


def run_sketches(
    spark: SparkSession, root: str, config: SignalConfig = SignalConfig(), fmt: str = "parquet",
    earlier: Sequence[str] = (),
) -> None:
    """Cuts from quantile sketches: those of this root's triples are kept as a stage table, merged with
    the kept ones of ``earlier`` roots, whose triples are not read again, and the triples are squashed
    by the cuts of all."""
    name, cols = "drugs2_reacs_sketches", config.cols
    triples = _triples(spark, root, config, fmt).select("actual", "expected")
    write_stage_table(cut_sketches(triples), root, name, cols, fmt)
    every = merged_sketches(*[read_stage_table(spark, r, name, cols, fmt) for r in (root, *earlier)])
    cuts = written(cuts_of_sketches(every))
    write_stage_table(squashed_stats(binned_expected(triples, cuts)), root, "drugs2_reacs_stats", cols, fmt)


def run_score(
    spark: SparkSession, root: str, config: SignalConfig = SignalConfig(), fmt: str = "parquet"
) -> None:
    triples = _triples(spark, root, config, fmt)
    params = mixture_for(triples, config)
    signals = scored_signals(
        triples, params, config.min_actual, config.posterior, config.cap, config.min_ebci, store=written
    )
    write_stage_table(signals, root, "scored_drugs2_reacs", config.cols, fmt)


def run_network(
    spark: SparkSession, root: str, config: SignalConfig = SignalConfig(), fmt: str = "parquet"
) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the scored stage table, as stage tables."""
    signals = read_stage_table(spark, root, "scored_drugs2_reacs", config.cols, fmt)
    for name, df in zip(("network_nodes", "network_edges"), signal_network(signals, config.cols)):
        write_stage_table(df, root, name, config.cols, fmt)
    nodes, edges = (
        read_stage_table(spark, root, name, config.cols, fmt) for name in ("network_nodes", "network_edges")
    )
    return nodes, edges


def run_all(
    spark: SparkSession,
    demos: str,
    drugs: str,
    reactions: str,
    root: str,
    config: SignalConfig = SignalConfig(),
    fmt: str = "parquet",
    normalize_strata: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """All jobs in order, from report lines to the network; returns the line counts of the sources."""
    observed = {name: Observation() for name in SOURCES}
    sources = read_sources(spark, demos, drugs, reactions, normalize_strata, observed)
    counted = run_counts(*sources, root, config, fmt, buckets, observed)
    run_expected(spark, root, config, fmt, buckets)
    run_squash(spark, root, config, fmt)
    run_score(spark, root, config, fmt)
    run_network(spark, root, config, fmt)
    return counted
