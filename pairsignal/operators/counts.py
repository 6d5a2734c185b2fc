"""Distinct reports per stratum and name.

The inputs (``ReportTables``) hold one row per report, stratum and name, so a distinct
count is a plain count: partial sums per task, one shuffle of group keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairsignal.operators.pairs import BLOCK, item_outcome_products, pair_outcome_products
from pairsignal.schema import Columns, DEFAULT_COLUMNS


def _counted(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias(out))


def stratum_counts(reports: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    return _counted(reports, [*cols.strata], "n_stratum")


def drug_counts(items: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    return _counted(items, [*cols.strata, cols.item], "n_drug")


def react_counts(outcomes: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    return _counted(outcomes, [*cols.strata, cols.outcome], "n_react")


def drug_react_counts(
    items: DataFrame, outcomes: DataFrame, cols: Columns = DEFAULT_COLUMNS, block: int = BLOCK
) -> DataFrame:
    rows = item_outcome_products(items, outcomes, cols, block)
    return _counted(rows, [*cols.strata, cols.item, cols.outcome], "n")


def pair_react_counts(
    items: DataFrame, outcomes: DataFrame, cols: Columns = DEFAULT_COLUMNS, block: int = BLOCK
) -> DataFrame:
    rows = pair_outcome_products(items, outcomes, cols, block)
    return _counted(rows, [*cols.strata, *cols.triple], "n")
