"""Actual and expected counts of (item1, item2, outcome)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairsignal.operators.counts import drug_counts, react_counts, stratum_counts
from pairsignal.operators.pairs import (
    BLOCK,
    item_outcome_products,
    item_pair_products,
    outcomes_of_pairs,
    pair_outcome_products,
)
from pairsignal.operators.reports import ReportTables
from pairsignal.operators.skew import ROWS_PER_SALT, grows, heaviest_keys, join_spread, rows_of_keys
from pairsignal.schema import Columns, DEFAULT_COLUMNS
from pairsignal.sources.written import store_all, unwritten


def pair_marginals(
    pair_counts: DataFrame,
    n_stratum: DataFrame,
    n_drug: DataFrame,
    n_react: DataFrame,
    cols: Columns = DEFAULT_COLUMNS,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Attach the stratum total and both item counts and the outcome count.

    The total rides on the (much smaller) outcome counts, so the pair table is joined three
    times, not four.  Names with many pair rows join in parts; the pair table is read once more
    for each key to weigh them, so it should be a stored one.  So should the counts, whose rows say
    whether they may be sent to every task.
    """
    strata = [*cols.strata]
    merge = grows(n_drug) or grows(n_react)
    rows = pair_counts
    for item, out in ((cols.item1, "n_drug1"), (cols.item2, "n_drug2")):
        counts = n_drug.select(*strata, F.col(cols.item).alias(item), F.col("n_drug").alias(out))
        others = [c for c in cols.triple if c != item]
        hot = heaviest_keys(rows_of_keys(pair_counts, [*strata, item]), [*strata, item], rows_per_salt=rows_per_salt)
        rows = join_spread(rows, counts, [*strata, item], hot, others, merge)
    keys = [*strata, cols.outcome]
    hot = heaviest_keys(rows_of_keys(pair_counts, keys), keys, rows_per_salt=rows_per_salt)
    rows = join_spread(rows, with_totals(n_react, n_stratum, cols), keys, hot, [cols.item1, cols.item2], merge)
    return rows.select(*strata, *cols.triple, "n", "n_stratum", "n_drug1", "n_drug2", "n_react")


def with_totals(n_react: DataFrame, n_stratum: DataFrame, cols: Columns) -> DataFrame:
    """Attach the stratum total (a stored table) to the outcome counts."""
    n_stratum = n_stratum.hint("merge") if grows(n_stratum) else F.broadcast(n_stratum)
    return n_react.join(n_stratum, [*cols.strata])


def expected_in_stratum() -> Column:
    """Reports expected under independence, in double throughout."""
    d = lambda c: F.col(c).cast("double")
    return d("n_drug1") * d("n_drug2") * d("n_react") / (d("n_stratum") * d("n_stratum"))


def pair_stratum_expected(marginals: DataFrame) -> DataFrame:
    return marginals.withColumn("expected", expected_in_stratum())


def actual_expected(stratified: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Sum the actual (``n``) and expected counts of each triple over the strata."""
    return stratified.groupBy(*cols.triple).agg(
        F.sum("n").alias("actual"), F.sum("expected").alias("expected")
    )


def with_marginals(
    rows: DataFrame, counts: DataFrame, name: str, n: str, cols: Columns, min_actual: int,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Attach each name's count in its stratum, before any pair is formed.

    ``counts`` should be a stored table.

    With ``min_actual``, names reported less often over all strata are left out: a triple
    cannot be reported more often than its rarest name, so none of the kept triples changes.
    """
    keys, merge = [*cols.strata, name], grows(counts)
    # A distinct report has one row of the name: the count is the number of rows to be joined.
    hot = heaviest_keys(counts, keys, n, rows_per_salt)
    if min_actual > 1:
        often = counts.groupBy(name).agg(F.sum(n).alias("total")).where(F.col("total") >= min_actual)
        often = often.select(name)
        counts = counts.join(often.hint("merge") if merge else often, name, "left_semi")
    return join_spread(rows, counts, keys, hot, [cols.report], merge)


def _counts(
    tables: ReportTables, cols: Columns, store: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Item counts, and outcome counts with the stratum total."""
    n_drug, n_react, n_stratum = store_all(
        store, drug_counts(tables.items, cols), react_counts(tables.outcomes, cols), stratum_counts(tables.reports, cols)
    )
    return n_drug, store(with_totals(n_react, n_stratum, cols))


def report_marginals(
    tables: ReportTables,
    cols: Columns = DEFAULT_COLUMNS,
    block: int = BLOCK,
    store: Callable[[DataFrame], DataFrame] = unwritten,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """The rows of ``pair_marginals`` straight from the report tables: the counts ride on a report's
    items and outcomes, so the pair table is summed once and joined to nothing."""
    strata, totals = [*cols.strata], ["n_stratum", "n_drug1", "n_drug2", "n_react"]
    n_drug, n_react = _counts(tables, cols, store)
    items = with_marginals(tables.items, n_drug, cols.item, "n_drug", cols, 1, rows_per_salt)
    outcomes = with_marginals(tables.outcomes, n_react, cols.outcome, "n_react", cols, 1, rows_per_salt)
    return pair_outcome_products(items, outcomes, cols, block).groupBy(*strata, *cols.triple).agg(
        F.count("*").alias("n"), *[F.max(c).alias(c) for c in totals]
    )


# A level is counted where it may take out this share of its rows; else its count costs more than it saves.
WORTH_PRUNING = 0.25


def _most_pruned(tables: ReportTables, n_drug: DataFrame, n_react: DataFrame, cols: Columns, min_actual: int) -> tuple[float, float]:
    """The largest share of (item, outcome) rows and of item pair rows that can be infrequent.

    Names that exist bound the pairs that exist, and an infrequent pair has fewer than ``min_actual``
    rows, so no count of pairs is needed.  One row from each small table.
    """
    def names(counts: DataFrame, name: str, n: str) -> Column:
        often = counts.groupBy(name).agg(F.sum(n).alias("total")).where(F.col("total") >= min_actual)
        return often.agg(F.count("*")).scalar()

    d = lambda c: F.col(c).cast("double")
    rows = tables.reports.agg(
        F.sum(d("n_items") * d("n_outcomes")).alias("crossed"), F.sum(d("n_items") * (d("n_items") - 1) / 2).alias("pairs")
    )
    found = rows.select("crossed", "pairs", names(n_drug, cols.item, "n_drug").alias("items"),
                        names(n_react, cols.outcome, "n_react").alias("outcomes")).first()
    share = lambda kinds, n: min(1.0, (min_actual - 1) * kinds / n) if n else 0.0
    items = found["items"]
    return share(items * found["outcomes"], found["crossed"]), share(items * (items - 1) / 2, found["pairs"])


def _frequent(rows: DataFrame, names: list[str], min_actual: int) -> DataFrame:
    """Name pairs with at least ``min_actual`` rows, and how many."""
    return rows.groupBy(*names).agg(F.count("*").alias("rows_of_key")).where(F.col("rows_of_key") >= min_actual)


def _rows_with(rows: DataFrame, frequent: DataFrame, names: list[str], cols: Columns, rows_per_salt: int) -> DataFrame:
    hot = heaviest_keys(frequent, names, rows_per_salt=rows_per_salt)
    return join_spread(rows, frequent.drop("rows_of_key"), names, hot, [cols.report])


def frequent_rows(
    items: DataFrame,
    outcomes: DataFrame,
    cols: Columns,
    min_actual: int,
    block: int = BLOCK,
    store: Callable[[DataFrame], DataFrame] = unwritten,
    rows_per_salt: int = ROWS_PER_SALT,
) -> tuple[DataFrame, DataFrame]:
    """Items and outcomes of each report that take part in some (item, outcome) pair reported
    ``min_actual`` times.  A triple needs both its item-outcome pairs that often."""
    names, report = [cols.item, cols.outcome], [cols.report, *cols.strata]
    plain = [c for c in (*report, "n_items", "n_outcomes")]
    crossed = item_outcome_products(items.select(*plain, cols.item), outcomes.select(*plain, cols.outcome), cols, block)
    frequent = store(_frequent(crossed, names, min_actual))
    kept = store(_rows_with(crossed.select(*report, *names), frequent, names, cols, rows_per_salt))
    of = lambda rows, name: rows.hint("merge").join(
        kept.select(*report, name).distinct(), [*report, name], "left_semi")
    return of(items, cols.item), of(outcomes, cols.outcome)


def frequent_item_pairs(
    pairs: DataFrame,
    cols: Columns,
    min_actual: int,
    store: Callable[[DataFrame], DataFrame] = unwritten,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Item pair rows whose pair is reported ``min_actual`` times."""
    names = [cols.item1, cols.item2]
    pairs = store(pairs)
    return _rows_with(pairs, store(_frequent(pairs, names, min_actual)), names, cols, rows_per_salt)


def report_actual_expected(
    tables: ReportTables,
    cols: Columns = DEFAULT_COLUMNS,
    min_actual: int = 1,
    block: int = BLOCK,
    store: Callable[[DataFrame], DataFrame] = unwritten,
    rows_per_salt: int = ROWS_PER_SALT,
    worth_pruning: float = WORTH_PRUNING,
) -> DataFrame:
    """Actual and expected counts straight from the report tables.

    The same numbers as ``pair_react_counts`` -> ``pair_marginals`` ->
    ``pair_stratum_expected`` -> ``actual_expected``.  The counts are attached to the item
    and outcome rows of a report, which are far fewer than its pairs, so the pair table is
    shuffled for its two sums only and for no join.

    With ``min_actual``, what cannot be part of a frequent triple goes level by level before triples
    are formed: names, then items and outcomes without a frequent item-outcome pair, then infrequent
    item pairs.  The last two levels are counted only where the number of names lets them take out
    ``worth_pruning`` of their rows, and tables are stored; the result is the same either way.
    """
    strata = [*cols.strata]
    n_drug, n_react = _counts(tables, cols, store)
    items = with_marginals(tables.items, n_drug, cols.item, "n_drug", cols, min_actual, rows_per_salt)
    outcomes = with_marginals(
        tables.outcomes, n_react, cols.outcome, "n_react", cols, min_actual, rows_per_salt
    )
    by_outcome = by_pair = 0.0
    if min_actual > 1 and store is not unwritten:  # levels read their tables more than once
        by_outcome, by_pair = _most_pruned(tables, n_drug, n_react, cols, min_actual)
    if by_outcome > worth_pruning:
        items, outcomes = store_all(store, items, outcomes)
        items, outcomes = store_all(
            store, *frequent_rows(items, outcomes, cols, min_actual, block, store, rows_per_salt)
        )
    pairs = item_pair_products(items, cols, block)
    if by_pair > worth_pruning:
        pairs = frequent_item_pairs(pairs, cols, min_actual, store, rows_per_salt)
    per_stratum = (
        outcomes_of_pairs(pairs, outcomes, cols, block)
        .select(*strata, *cols.triple, expected_in_stratum().alias("expected"))
        .groupBy(*strata, *cols.triple)
        .agg(F.count("*").alias("n"), F.max("expected").alias("expected"))
    )
    return min_actual_filter(actual_expected(per_stratum, cols), min_actual)


def min_actual_filter(triples: DataFrame, min_actual: int = 3) -> DataFrame:
    """Triples reported at least ``min_actual`` times."""
    return triples.where(F.col("actual") >= min_actual) if min_actual > 1 else triples
