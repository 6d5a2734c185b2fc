"""Reports with their distinct items and outcomes: the inputs of every count.

``items`` and ``outcomes`` hold one row per report (and stratum) and name, with the sizes
of the report.  Each distinct and count is combined before its shuffle, and the names of a
report that holds much of the data are joined to it in parts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairsignal.operators.skew import ROWS_PER_SALT, heaviest_keys, join_spread
from pairsignal.schema import Columns, DEFAULT_COLUMNS
from pairsignal.sources.written import store_all, unwritten


@dataclass(frozen=True)
class ReportTables:
    reports: DataFrame  # report, strata, n_items, n_outcomes
    items: DataFrame  # report, strata, n_items, n_outcomes, item
    outcomes: DataFrame  # report, strata, n_items, n_outcomes, outcome


def complete(df: DataFrame, *names: str) -> DataFrame:
    """Rows with all of ``names`` present.

    Joins ask for this anyway, each for its own keys only.  Asked for once and at the
    start, every use of a table has the same plan below its shuffle, which then runs once.
    """
    for name in names:
        df = df.where(F.col(name).isNotNull())
    return df


def join_reports(left: DataFrame, right: DataFrame, cols: Columns) -> DataFrame:
    """Join two tables of few rows per report by sort-merge: both grow with the number of
    reports, so neither is ever a side to broadcast."""
    return left.hint("merge").join(right, cols.report)


def join_names(
    names: DataFrame, reports: DataFrame, size: str, name: list[str], cols: Columns,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Join the names of each report to its row, large reports in parts by name."""
    hot = heaviest_keys(reports, [cols.report], size, rows_per_salt)
    return join_spread(names, reports, [cols.report], hot, name, merge=True)


def of_reports(rows: DataFrame, reports: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """The rows whose report is among ``reports``, as they are.

    Every count and product is about those; where several start from the same rows, the others
    need not go through the shuffles of each.
    """
    return rows.hint("merge").join(reports.select(cols.report), cols.report, "left_semi")


def distinct_report_drugs(drug: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Distinct item names of each report."""
    return complete(drug, cols.report, cols.item).select(cols.report, cols.item).distinct()


def distinct_report_reacts(react: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    return complete(react, cols.report, cols.outcome).select(cols.report, cols.outcome).distinct()


def multi_drug_reports(drug: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Reports with more than one distinct item, and how many."""
    return (
        distinct_report_drugs(drug, cols)
        .groupBy(cols.report)
        .agg(F.count("*").alias("n_items"))
        .where("n_items > 1")
    )


def report_tables(
    demo: DataFrame,
    drug: DataFrame,
    react: DataFrame,
    cols: Columns = DEFAULT_COLUMNS,
    store: Callable[[DataFrame], DataFrame] = unwritten,
) -> ReportTables:
    """Reports with at least one item and one outcome, and their distinct names.

    A count of reports per (stratum, item) needs to know that a report has some outcome,
    not which, so the item x outcome product of a report is never formed for it.

    ``store`` is applied to each table that is read more than once; with ``written`` each
    source is parsed once and no join is repeated.
    """
    reports = store(
        complete(demo, cols.report, *cols.strata).select(cols.report, *cols.strata).distinct()
    )
    if store is not unwritten:  # stored before they are grouped, a large report's rows are filtered in parts
        drug, react = store_all(
            store,
            of_reports(complete(drug, cols.report, cols.item).select(cols.report, cols.item), reports, cols),
            of_reports(complete(react, cols.report, cols.outcome).select(cols.report, cols.outcome), reports, cols),
        )
    items, outcomes = store_all(
        store, distinct_report_drugs(drug, cols), distinct_report_reacts(react, cols)
    )
    n_items = items.groupBy(cols.report).agg(F.count("*").alias("n_items"))
    n_outcomes = outcomes.groupBy(cols.report).agg(F.count("*").alias("n_outcomes"))
    reports = store(join_reports(join_reports(reports, n_items, cols), n_outcomes, cols))
    items, outcomes = store_all(
        store,
        join_names(items, reports, "n_items", [cols.item], cols),
        join_names(outcomes, reports, "n_outcomes", [cols.outcome], cols),
    )
    return ReportTables(reports, items, outcomes)
