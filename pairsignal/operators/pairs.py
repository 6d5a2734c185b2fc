"""Products within a report: item pairs, item x outcome, pair x outcome.

A product of a report's rows is quadratic or worse in the report, so the join key is not
the report alone.  The names of a report fall into blocks of about ``BLOCK`` by hash, and
the join key adds the blocks that meet: a cell.  A row is sent to each cell its block takes
part in.  A report up to ``BLOCK`` names is one cell and its rows are sent once; a larger
one is spread over many bounded cells.  Every pair meets in exactly one cell, so nothing is
dropped or counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairsignal.operators.reports import (
    distinct_report_drugs,
    join_names,
    join_reports,
    multi_drug_reports,
)
from pairsignal.operators.skew import heaviest_keys, join_spread
from pairsignal.schema import Columns, DEFAULT_COLUMNS
from pairsignal.sources.written import store_all, unwritten

BLOCK = 512
COPIES = 1024


def _blocks(size: str, block: int) -> Column:
    return F.ceil(F.col(size) / block)


def _block_of(name: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(name), blocks)


def _each(blocks: Column, first: int | Column = 0) -> Column:
    first = first if isinstance(first, Column) else F.lit(first)
    return F.explode(F.sequence(first.cast("bigint"), blocks - 1))


def item_cells(
    items: DataFrame, cols: Columns, keys: list[str], block: int = BLOCK
) -> DataFrame:
    """Each item row once per pair cell (lo, hi) and outcome block of its report."""
    n = _blocks("n_items", block)
    extra = [c for c in items.columns if c not in {*keys, cols.item, "n_items", "n_outcomes"}]
    by_outcome = "n_outcomes" in items.columns
    return (
        items.where("n_items > 1")
        .withColumn("blk", _block_of(cols.item, n))
        .withColumn("other", _each(n))
        .withColumn("ok", _each(_blocks("n_outcomes", block)) if by_outcome else F.lit(0))
        .select(
            *keys,
            F.least("blk", "other").alias("lo"),
            F.greatest("blk", "other").alias("hi"),
            "ok",
            "blk",
            cols.item,
            *extra,
        )
    )


def outcome_cells(
    outcomes: DataFrame, cols: Columns, keys: list[str], block: int = BLOCK, salt: Column | None = None
) -> DataFrame:
    """Each outcome row once per pair cell of its report, in its own outcome block."""
    n = _blocks("n_items", block)
    extra = [c for c in outcomes.columns if c not in {*keys, cols.outcome, "n_items", "n_outcomes"}]
    blocks = _blocks("n_outcomes", block)
    own = _block_of(cols.outcome, blocks) if salt is None else F.pmod(salt, blocks)
    return (
        outcomes.where("n_items > 1")
        .withColumn("ok", own)
        .withColumn("lo", _each(n))
        .withColumn("hi", _each(n, F.col("lo")))
        .select(*keys, "lo", "hi", "ok", cols.outcome, *extra)
    )


def join_cells(cells: DataFrame, cols: Columns, keys: list[str]) -> DataFrame:
    """Item pairs (smaller name first) within each cell, still keyed by the cell.

    Columns other than the keys come twice, with suffix 1 and 2.  Both sides are the same
    rows in the same layout, so one shuffle serves both.
    """
    key = [*keys, "lo", "hi", "ok"]
    rest = [c for c in cells.columns if c not in key]
    left = cells.select(*key, *[F.col(c).alias(f"{c}1") for c in rest])
    right = cells.select(*key, *[F.col(c).alias(f"{c}2") for c in rest])
    return (
        left.hint("merge").join(right, key)
        .where(F.col(cols.item1) < F.col(cols.item2))
        .where((F.col("lo") == F.col("hi")) | (F.col("blk1") != F.col("blk2")))
        .drop("blk1", "blk2")
    )


def drug_pairs(
    drug: DataFrame, cols: Columns = DEFAULT_COLUMNS, block: int = BLOCK
) -> DataFrame:
    """All unordered pairs of distinct items of each report, as (smaller, larger) name."""
    sizes = multi_drug_reports(drug, cols)
    items = join_names(distinct_report_drugs(drug, cols), sizes, "n_items", [cols.item], cols)
    cells = item_cells(items, cols, [cols.report], block)
    return join_cells(cells, cols, [cols.report]).select(cols.report, cols.item1, cols.item2)


def _expanded(df: DataFrame, *copies: str) -> DataFrame:
    """Repeat each row as often as its copy columns say."""
    for c in copies:
        df = df.withColumn(c, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(c))))
    return df.drop(*copies)


def _chunked(df: DataFrame, copies: str, chunk: str, per_chunk: int) -> DataFrame:
    """Split a row standing for many copies into rows standing for at most ``per_chunk``."""
    n = F.col(copies)
    return df.withColumn(chunk, _each(F.ceil(n / per_chunk))).withColumn(
        copies, F.least(n - F.col(chunk) * per_chunk, F.lit(per_chunk).cast("bigint"))
    )


def _stratified_outcomes(
    demo: DataFrame, react: DataFrame, cols: Columns, copies: str
) -> DataFrame:
    """Outcome rows per report and stratum; equal rows are one row with their number."""
    reports = demo.groupBy(cols.report, *cols.strata).agg(F.count("*").alias("n_demo"))
    rows = react.groupBy(cols.report, cols.outcome).agg(F.count("*").alias("n_rows"))
    sizes = rows.groupBy(cols.report).agg(F.count("*").alias("n_outcomes"))
    hot = heaviest_keys(sizes, [cols.report], "n_outcomes")
    joined = join_spread(rows, reports, [cols.report], hot, [cols.outcome], merge=True)
    return joined.select(
        cols.report, *cols.strata, cols.outcome, (F.col("n_rows") * F.col("n_demo")).alias(copies)
    )


def report_drug_react(
    demo: DataFrame,
    drug: DataFrame,
    react: DataFrame,
    cols: Columns = DEFAULT_COLUMNS,
    block: int = BLOCK,
    per_chunk: int = COPIES,
    store: Callable[[DataFrame], DataFrame] = unwritten,
) -> DataFrame:
    """Demographics, items and outcomes joined on the report id, repeated rows kept.

    Equal rows travel as one row with their number and are repeated after the join.  The
    join key adds the item and outcome blocks of the report, so no report is one task.
    """
    copies = drug.groupBy(cols.report, cols.item).agg(F.count("*").alias("item_copies"))
    items, outcomes = store_all(
        store,
        _chunked(copies, "item_copies", "item_chunk", per_chunk),
        _chunked(
            _stratified_outcomes(demo, react, cols, "outcome_copies"),
            "outcome_copies", "outcome_chunk", per_chunk,
        ),
    )
    sizes = join_reports(
        items.groupBy(cols.report).agg(F.count("*").alias("n_items")),
        outcomes.groupBy(cols.report).agg(F.count("*").alias("n_outcomes")),
        cols,
    )
    sizes = store(sizes)
    n_item_blocks, n_outcome_blocks = _blocks("n_items", block), _blocks("n_outcomes", block)
    left = (
        join_names(items, sizes, "n_items", [cols.item, "item_chunk"], cols)
        .withColumn("ib", F.pmod(F.xxhash64(cols.item, "item_chunk"), n_item_blocks))
        .withColumn("ob", _each(n_outcome_blocks))
        .select(cols.report, "ib", "ob", cols.item, "item_copies")
    )
    right = (
        join_names(outcomes, sizes, "n_outcomes", [cols.outcome, "outcome_chunk"], cols)
        .withColumn("ob", F.pmod(F.xxhash64(cols.outcome, "outcome_chunk"), n_outcome_blocks))
        .withColumn("ib", _each(n_item_blocks))
        .select(cols.report, "ib", "ob", *cols.strata, cols.outcome, "outcome_copies")
    )
    joined = left.hint("merge").join(right, [cols.report, "ib", "ob"])
    return _expanded(joined, "item_copies", "outcome_copies").select(
        cols.item, cols.outcome, cols.report, *cols.strata
    )


def report_pair_react(
    demo: DataFrame,
    drug: DataFrame,
    react: DataFrame,
    cols: Columns = DEFAULT_COLUMNS,
    block: int = BLOCK,
    per_chunk: int = COPIES,
    store: Callable[[DataFrame], DataFrame] = unwritten,
) -> DataFrame:
    """Demographics, outcomes and item pairs joined on the report id.

    Pairs are distinct within a report; repeated demographic and outcome rows are kept.
    """
    items, outcomes = store_all(
        store,
        distinct_report_drugs(drug, cols),
        _chunked(
            _stratified_outcomes(demo, react, cols, "outcome_copies"),
            "outcome_copies", "outcome_chunk", per_chunk,
        ),
    )
    sizes = join_reports(
        items.groupBy(cols.report).agg(F.count("*").alias("n_items")).where("n_items > 1"),
        outcomes.groupBy(cols.report).agg(F.count("*").alias("n_outcomes")),
        cols,
    )
    sizes = store(sizes)
    items = join_names(items, sizes, "n_items", [cols.item], cols)
    by = [cols.outcome, "outcome_chunk"]
    outcomes = join_names(outcomes, sizes, "n_outcomes", by, cols)
    keys = [cols.report]
    pairs = join_cells(item_cells(items, cols, keys, block), cols, keys)
    right = outcome_cells(outcomes, cols, keys, block, salt=F.xxhash64(*by)).drop("outcome_chunk")
    joined = pairs.hint("merge").join(right, [*keys, "lo", "hi", "ok"])
    return _expanded(joined, "outcome_copies").select(
        *cols.triple, cols.report, *cols.strata
    )


def item_outcome_products(
    items: DataFrame, outcomes: DataFrame, cols: Columns, block: int = BLOCK
) -> DataFrame:
    """Each distinct item of a report and stratum with each of its distinct outcomes."""
    keys = [cols.report, *cols.strata]
    n_item_blocks, n_outcome_blocks = _blocks("n_items", block), _blocks("n_outcomes", block)
    left = (
        items.withColumn("ib", _block_of(cols.item, n_item_blocks))
        .withColumn("ob", _each(n_outcome_blocks))
        .select(*keys, "ib", "ob", cols.item)
    )
    right = (
        outcomes.withColumn("ob", _block_of(cols.outcome, n_outcome_blocks))
        .withColumn("ib", _each(n_item_blocks))
        .select(*keys, "ib", "ob", cols.outcome)
    )
    return left.hint("merge").join(right, [*keys, "ib", "ob"])


def item_pair_products(items: DataFrame, cols: Columns, block: int = BLOCK) -> DataFrame:
    """Each distinct item pair of a report and stratum, keyed by the cell in which it meets."""
    keys = [cols.report, *cols.strata]
    return join_cells(item_cells(items, cols, keys, block), cols, keys)


def outcomes_of_pairs(
    pairs: DataFrame, outcomes: DataFrame, cols: Columns, block: int = BLOCK
) -> DataFrame:
    """Each pair of ``item_pair_products`` with each distinct outcome of its report."""
    keys = [cols.report, *cols.strata]
    right = outcome_cells(outcomes, cols, keys, block)
    return pairs.hint("merge").join(right, [*keys, "lo", "hi", "ok"]).drop("lo", "hi", "ok")


def pair_outcome_products(
    items: DataFrame, outcomes: DataFrame, cols: Columns, block: int = BLOCK
) -> DataFrame:
    """Each distinct item pair of a report and stratum with each of its distinct outcomes.

    Further columns of ``items`` come with suffix 1 and 2, those of ``outcomes`` as named.
    """
    return outcomes_of_pairs(item_pair_products(items, cols, block), outcomes, cols, block)
