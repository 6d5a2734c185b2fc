"""Strong signals as a network: items are nodes, item pairs are edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pairsignal.schema import Columns, DEFAULT_COLUMNS
from pairsignal.sources.written import written

COMBINATION_MARK = "/"


def combination_filter(signals: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Drop signals in which either item is a combination product."""
    mark = F.lit(COMBINATION_MARK)
    return signals.where(
        ~F.contains(F.col(cols.item1), mark) & ~F.contains(F.col(cols.item2), mark)
    )


def dense_ids(
    names: DataFrame,
    name: str,
    out: str = "id",
    ranges: int | None = None,
    store: Callable[[DataFrame], DataFrame] = written,
) -> DataFrame:
    """Number distinct names 0, 1, 2, ... in name order without sorting them in one task.

    The names are dealt into ranges, as many as a shuffle has partitions or ``ranges``, and sorted
    within; a running number gives the place in the range, and each range starts where the ranges
    before it end.  The sorted names are stored, which fixes the ranges.
    """
    dealt = names.repartitionByRange(name) if ranges is None else names.repartitionByRange(ranges, name)
    placed = store(
        dealt.sortWithinPartitions(name).withColumn("_place", F.monotonically_increasing_id())
    ).withColumn("_range", F.expr("_place DIV 8589934592L"))
    sizes = placed.groupBy("_range").agg(F.count("*").alias("m"))
    # A row for each range.
    before = F.sum("m").over(Window.partitionBy(F.lit(0)).orderBy("_range")) - F.col("m")
    starts = sizes.select("_range", before.alias("start"))
    return placed.join(starts, "_range").select(
        (F.col("start") + F.col("_place") % F.lit(8589934592)).alias(out), name
    )


def signal_nodes(signals: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Distinct items of the signals with dense ids by name: ``id``, ``label``."""
    names = (
        signals.select(F.explode(F.array(cols.item1, cols.item2)).alias("label")).distinct()
    )
    return dense_ids(names, "label")


def signal_edges(
    signals: DataFrame, nodes: DataFrame, cols: Columns = DEFAULT_COLUMNS
) -> DataFrame:
    """One edge per item pair: its highest ``ebci`` and its outcomes, best ``ebgm`` first.

    An edge lists each outcome once at most, so a list is bounded by the outcome terms.
    """
    listed = F.array_sort(
        F.collect_list(F.struct((-F.col("ebgm")).alias("rank"), F.col(cols.outcome).alias("term")))
    )
    edges = signals.groupBy(cols.item1, cols.item2).agg(
        F.max("ebci").alias("weight"), listed.alias("listed")
    )
    ends = {c: nodes.select(F.col("id").alias(e), F.col("label").alias(c))
            for c, e in ((cols.item1, "source"), (cols.item2, "target"))}
    for c, end in ends.items():
        edges = edges.join(end, c)
    return edges.select("source", "target", "weight", F.col("listed.term").alias("reactions"))
