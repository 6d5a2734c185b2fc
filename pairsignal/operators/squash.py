"""Quantile cuts of ``expected`` per ``actual``, bins, and the squashed table for the fit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pairsignal.operators.skew import ROWS_PER_SALT, heaviest_keys, join_spread
from pairsignal.sources.written import unwritten

PARTS = 10
CUTS = [f"q{i}" for i in range(PARTS + 1)]
# Mantissa bits resolved by the first and second histogram.
FIRST_BITS, SECOND_BITS = 10, 31
# Size of a quantile sketch, and the rank error it keeps to: the sketch's own bound at this size is
# 0.3 % with 99 % confidence.
SKETCH_SIZE = 1024
SKETCH_ERROR = 0.01


def _digits(value: str) -> dict[str, str]:
    """Coarse and fine histogram cells of a double, as SQL; both grow with the value.

    The first is the binary exponent with the top mantissa bits, the second the mantissa to
    31 bits.  Two values in the same pair of cells differ in the last 21 bits only.
    """
    size = f"abs({value})"
    exponent = f"CASE WHEN {value} = 0 THEN 0 ELSE floor(log2({size})) END"
    mantissa = f"CASE WHEN {value} = 0 THEN 0D ELSE {size} / pow(2D, {exponent}) END"
    sign = f"CAST(signum({value}) AS BIGINT)"
    return {
        "d1": f"{sign} * ((({exponent}) + 2048) * {1 << (FIRST_BITS + 2)}"
        f" + CAST(floor(({mantissa}) * {1 << FIRST_BITS}) AS BIGINT))",
        "d2": f"{sign} * CAST(floor(({mantissa}) * {1 << SECOND_BITS}D) AS BIGINT)",
    }


def _holding(cells: DataFrame, targets: DataFrame, keys: list[str], cell: str) -> DataFrame:
    """The cell that holds each target rank, its number of rows, and the rank within it.

    ``cells`` has ``keys``, ``cell`` and its number of rows ``m``.  The running sum is over
    cells, whose number per key is bounded by their bits and not by the data.
    """
    running = F.sum("m").over(Window.partitionBy(*keys).orderBy(cell))
    return (
        cells.withColumn("upto", running)
        .join(targets.drop("m"), keys)
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("m")))
        .withColumn("rank", F.col("rank") - F.col("upto") + F.col("m"))
        .drop("upto")
    )


def _within(hist: DataFrame, chosen: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Histogram rows of the chosen cells, those of a large cell in parts."""
    hot = heaviest_keys(chosen, keys, "m")
    return join_spread(hist, chosen.select(*keys).distinct(), keys, hot, [value])


def quantile_cuts(
    triples: DataFrame,
    group: str = "actual",
    value: str = "expected",
    mode: str = "exact",
    accuracy: int = 10000,
    store: Callable[[DataFrame], DataFrame] = unwritten,
) -> DataFrame:
    """Minimum, nine inner deciles and maximum of ``value`` per group, as q0..q10, with the
    number of rows ``n_group``.

    Decile i is the value of rank ceil(i n / 10).  ``exact`` finds it by narrowing down: a
    histogram on the leading bits of the value picks the cell of each rank, a second one
    refines that cell, and only the distinct values of the last cell are ranked.  Rows are
    never sorted and a group is never in one task, however large; with ``store`` the histogram and
    the ranks are made once, not again for every step.  ``approx`` uses a
    mergeable sketch with rank error below 1/accuracy.
    """
    if mode == "approx":
        inner = [i / PARTS for i in range(1, PARTS)]
        cuts = triples.groupBy(group).agg(
            F.count("*").alias("n_group"),
            F.min(value).alias("q0"),
            F.max(value).alias(CUTS[-1]),
            F.percentile_approx(value, inner, accuracy).alias("inner"),
        )
        return cuts.select(
            group, "n_group", "q0", *[F.col("inner")[i - 1].alias(f"q{i}") for i in range(1, PARTS)],
            CUTS[-1],
        )
    if mode != "exact":
        raise ValueError(f"unknown mode {mode!r}")
    digits = _digits(value)
    hist = triples.groupBy(group, value).agg(F.count("*").alias("c"))
    hist = store(hist.withColumns({d: F.expr(sql) for d, sql in digits.items()}))
    total = hist.groupBy(group).agg(
        F.sum("c").alias("n_group"), F.min(value).alias("q0"), F.max(value).alias(CUTS[-1])
    )
    ranks = F.explode(F.expr(f"sequence(1, {PARTS - 1})"))
    targets = (
        total.select(group, "n_group", ranks.alias("i"))
        .withColumn("rank", F.expr(f"(i * n_group + {PARTS - 1}) DIV {PARTS}"))
        .drop("n_group")
    )
    keys = [group]
    for cell in digits:
        inside = hist if keys == [group] else _within(hist, targets, keys, value)
        cells = inside.groupBy(*keys, cell).agg(F.sum("c").alias("m"))
        targets = store(_holding(cells, targets, keys, cell))
        keys = [*keys, cell]
    last = _within(hist, targets, keys, value).select(*keys, value, F.col("c").alias("m"))
    found = _holding(last, targets, keys, value)
    picked = found.groupBy(group).agg(
        *[F.max(F.when(F.col("i") == i, F.col(value))).alias(f"q{i}") for i in range(1, PARTS)]
    )
    return total.join(picked, group).select(group, "n_group", *CUTS)


def cut_sketches(
    triples: DataFrame, group: str = "actual", value: str = "expected", size: int = SKETCH_SIZE
) -> DataFrame:
    """n_group, q0, q10 and a quantile sketch of each group: a few kilobytes, however large the group.

    Sketches are summed within tasks before they are shuffled, and those of one extract merge with
    those of another, so a new extract is read alone.
    """
    return triples.groupBy(group).agg(
        F.count(value).alias("n_group"), F.min(value).alias("q0"), F.max(value).alias(CUTS[-1]),
        F.kll_sketch_agg_double(value, size).alias("sketch"),
    )


def merged_sketches(*sketches: DataFrame, group: str = "actual", size: int = SKETCH_SIZE) -> DataFrame:
    """The sketches of all extracts together."""
    rows = sketches[0]
    for more in sketches[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(group).agg(
        F.sum("n_group").alias("n_group"), F.min("q0").alias("q0"), F.max(CUTS[-1]).alias(CUTS[-1]),
        F.kll_merge_agg_double("sketch", size).alias("sketch"),
    )


def cuts_of_sketches(sketches: DataFrame, group: str = "actual") -> DataFrame:
    """The columns of ``quantile_cuts``; inner cuts are off by ``SKETCH_ERROR`` of the ranks at most."""
    inner = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)]))
    return sketches.withColumn("inner", inner).select(
        group, "n_group", "q0", *[F.col("inner")[i - 1].alias(f"q{i}") for i in range(1, PARTS)], CUTS[-1]
    )


def rank_errors(
    triples: DataFrame, cuts: DataFrame, group: str = "actual", value: str = "expected",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Per group and inner cut ``i``: how far, as a share of the group, the cut is from rank
    ceil(i n / 10); 0 where it is a value of that rank."""
    hot = heaviest_keys(cuts, [group], "n_group", rows_per_salt)
    joined = join_spread(triples.select(group, value), cuts, [group], hot, [value])
    inner = range(1, PARTS)
    counted = joined.groupBy(group).agg(
        F.count("*").alias("n_group"),
        *[F.count_if(F.col(value) < F.col(f"q{i}")).alias(f"below{i}") for i in inner],
        *[F.count_if(F.col(value) <= F.col(f"q{i}")).alias(f"upto{i}") for i in inner],
    )
    each = ", ".join(f"struct({i} AS i, below{i} AS below, upto{i} AS upto)" for i in inner)
    target = f"(i * n_group + {PARTS - 1}) DIV {PARTS}"
    return counted.selectExpr(group, "n_group", f"inline(array({each}))").selectExpr(
        group, "n_group", "i", f"greatest(0, below + 1 - {target}, {target} - upto) / n_group AS rank_error"
    )


def _probe(value: Column, low: int, high: int) -> Column:
    """Binary search over the cuts low..high: the index hit first, else where to insert."""
    if low > high:
        return F.lit(low)
    mid = (low + high) // 2
    cut = F.col(CUTS[mid])
    return (
        F.when(value < cut, _probe(value, low, mid - 1))
        .when(value > cut, _probe(value, mid + 1, high))
        .otherwise(F.lit(mid))
    )


def binned_expected(
    triples: DataFrame, cuts: DataFrame, group: str = "actual", value: str = "expected",
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Attach ``bin``, the place of the value among its group's cuts (0..10).

    The smallest count has the most triples by far, so large groups join in parts.
    """
    spread_by = [c for c in triples.columns if c != group]
    hot = heaviest_keys(cuts, [group], "n_group", rows_per_salt)
    joined = join_spread(triples, cuts, [group], hot, spread_by)
    return joined.withColumn("bin", _probe(F.col(value), 0, PARTS)).drop("n_group", *CUTS)


def squashed_stats(binned: DataFrame, group: str = "actual", value: str = "expected") -> DataFrame:
    """Sum of expected counts and number of triples of each (actual, bin)."""
    return binned.groupBy(group, "bin").agg(
        F.sum(value).alias("sum_expected"), F.count("*").alias("weight")
    )
