"""The whole chain from report tables to ranked signals and their network."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from pairsignal.operators.expected import report_actual_expected
from pairsignal.operators.fit import PLAIN_START, fit_input, fit_mixture_multistart, fitted_params
from pairsignal.operators.network import combination_filter, signal_edges, signal_nodes
from pairsignal.operators.reports import ReportTables, report_tables
from pairsignal.operators.score import STRONG, scored_signals
from pairsignal.operators.squash import binned_expected, quantile_cuts, squashed_stats
from pairsignal.schema import Columns, DEFAULT_COLUMNS, DEFAULT_PARAMS, MixtureParams
from pairsignal.sources.written import written


@dataclass(frozen=True)
class SignalConfig:
    """What to look for.  ``params="fit"`` fits the mixture to the data first.

    ``posterior="scale"`` with ``cap=CAP`` is the shipped behaviour, which marks the strongest
    signals -1 and so loses them; the default keeps them.
    """

    cols: Columns = DEFAULT_COLUMNS
    min_actual: int = 3
    params: MixtureParams | str = DEFAULT_PARAMS
    posterior: str = "rate"
    cap: float | None = None
    min_ebci: float = STRONG


def squashed(triples: DataFrame, store: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """Cuts, bins and the squashed table of triples; the cuts table is stored."""
    return squashed_stats(binned_expected(triples, store(quantile_cuts(triples, store=store))))


def mixture_for(
    triples: DataFrame, config: SignalConfig, store: Callable[[DataFrame], DataFrame] = written
) -> MixtureParams:
    if isinstance(config.params, MixtureParams):
        return config.params
    cells = fit_input(squashed(triples, store))
    # Without a cell there is nothing to score but triples that no bin holds; the plain start serves.
    return fitted_params(fit_mixture_multistart(cells, store=store)) or PLAIN_START


def find_triples(
    demo: DataFrame,
    drug: DataFrame,
    react: DataFrame,
    config: SignalConfig,
    store: Callable[[DataFrame], DataFrame] = written,
) -> DataFrame:
    """Actual and expected counts of the triples reported often enough to be scored."""
    return triples_of(report_tables(demo, drug, react, config.cols, store), config, store)


def triples_of(
    tables: ReportTables, config: SignalConfig, store: Callable[[DataFrame], DataFrame] = written
) -> DataFrame:
    """``find_triples`` of report tables that are there already."""
    return report_actual_expected(tables, config.cols, config.min_actual, store=store)


def find_signals(
    demo: DataFrame,
    drug: DataFrame,
    react: DataFrame,
    config: SignalConfig = SignalConfig(),
    store: Callable[[DataFrame], DataFrame] = written,
    order: bool = True,
) -> DataFrame:
    """Strong signals, ranked with ``order``.  ``demo`` has one row per case."""
    triples = find_triples(demo, drug, react, config, store)
    if not isinstance(config.params, MixtureParams):
        triples = store(triples)
    return signals_of(triples, config, store, order)


def signals_of(
    triples: DataFrame,
    config: SignalConfig = SignalConfig(),
    store: Callable[[DataFrame], DataFrame] = written,
    order: bool = True,
) -> DataFrame:
    """``find_signals`` of triples that are there already, stored ones where the mixture is fitted."""
    params = mixture_for(triples, config, store)
    return scored_signals(
        triples, params, config.min_actual, config.posterior, config.cap, config.min_ebci, order, store
    )


def signal_network(
    signals: DataFrame,
    cols: Columns = DEFAULT_COLUMNS,
    store: Callable[[DataFrame], DataFrame] = written,
) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the signals without combination products."""
    kept = store(combination_filter(signals, cols))
    nodes = store(signal_nodes(kept, cols))
    return nodes, signal_edges(kept, nodes, cols)
