"""Line dedup over a suffix array of line-ID sequences, by distributed prefix doubling (native).

Every document is a sequence of line IDs.  Suffixes that start with a line seen only once in the
corpus are settled at once.  Step k gives each remaining suffix a rank by its first 2^k lines: the
pair (rank of this suffix, rank of the suffix 2^(k-1) lines on) is counted, pairs that occur once
are settled and leave, and the others are sorted by range into new ranks, which keep the order of
the suffix array.  Suffixes with equal rank are the interval of the array whose longest common
prefix reaches 2^k lines; its first member in document order is the original, the others are later
copies.  Steps go on until no interval is left, so a run of any length is found, and a repeat of
length L is covered by the intervals of depth 2^k <= L that start inside it.  Consecutive suffixes
whose originals are consecutive too are chained into maximal runs.

Every line of a later copy is deleted if the run has at least two lines, or if it is one line of
at least MIN_WORDS words, or of MIN_SIGNS characters of scripts written without blanks; other single
lines stay.  Order is by document id, then by a hash of
the text for equal ids, then by line.

Nothing holds a whole interval: intervals are counts and minima (summed before the shuffle), ranks
are given by range sort, and joins on hot ranks are plain sort-merge joins that adaptive execution
splits.

Defined cases: lines are the parts between line feeds; lines that are empty or white space carry no
ID, break no run into pieces of another document, and stay unless every other line of their
document went.  Rows equal in id and text count as one document and get the same result, each.
Null or empty texts are returned as they are, a null id orders first, other columns are passed
through.  A document that loses every line has ``text`` null and ``n_lines`` equal to
``n_deleted``; the pipeline stage drops it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import NO_ID, by_place, stored, table

MIN_WORDS = 5
MIN_SIGNS = 10  # characters that stand for MIN_WORDS words in scripts written without blanks
NO_BLANKS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
DOC = ["_did", "_dkey"]


def _doc_key(docs: DataFrame) -> DataFrame:
    return docs.withColumns({
        "_did": F.coalesce("doc_id", F.lit(NO_ID)), "_dkey": F.xxhash64("text", "doc_id"),
    })


def line_table(docs: DataFrame) -> DataFrame:
    """did, dkey, line, two hashes and whether it is long enough to count alone, of every line
    with an ID.  ``line`` numbers these lines; ``at`` numbers all lines."""
    text = F.col("text")
    each = F.posexplode(F.split(text, "\n")).alias("at", "said")
    lines = _doc_key(docs.select("doc_id", "text").filter(F.length("text") > 0)).select(*DOC, each)
    words = F.size(F.split(F.trim("said"), r"\s+"))
    return lines.filter(F.col("said").rlike(r"\S")).select(
        *DOC, "at", F.xxhash64("said").alias("a"), F.crc32(F.col("said").cast("binary")).alias("b"),
        ((words >= MIN_WORDS) | F.col("said").rlike(f"(?:[{NO_BLANKS}][^{NO_BLANKS}]*+){{{MIN_SIGNS}}}")).alias("long"),
    ).repartition(*DOC).dropDuplicates([*DOC, "at"])  # the repartition serves the numbering, too


def _ranked(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals with two members at least: the keys, a rank in key order, and the first member."""
    repeated = pairs.groupBy(keys).agg(
        F.count("*").alias("n"), F.min(F.struct(*DOC, "line")).alias("first")
    ).filter("n > 1")
    # Range partitions in order, sorted within: the running number keeps the order.
    return stored(
        repeated.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("name", F.monotonically_increasing_id())
    )


def _levels(lines: DataFrame) -> list[DataFrame]:
    """Per step k: did, dkey, line, rank, first of each suffix whose 2^k lines occur again."""
    levels = []
    members = lines.select(*DOC, "line", "a", "b")
    keys, depth = ["a", "b"], 1
    while True:
        classes = _ranked(members, keys)
        if classes.isEmpty():
            return levels
        level = stored(
            members.join(classes.drop("n"), keys).select(*DOC, "line", F.col("name").alias("rank"), "first")
        )
        levels.append(level)
        # The rank ``depth`` lines on; suffixes without one have left or end before.
        further = Window.partitionBy(*DOC).orderBy("line").rangeBetween(depth, depth)
        members = level.withColumn("next", F.first("rank").over(further)).filter("next IS NOT NULL").select(
            *DOC, "line", "rank", "next"
        )
        keys, depth = ["rank", "next"], 2 * depth


def repeated_runs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, covers).  covers: did, dkey, line, length, and the original's fd, fk, fl for every
    later copy in every interval."""
    order = Window.partitionBy(*DOC).orderBy("at")
    lines = stored(line_table(docs).withColumn("line", F.row_number().over(order) - 1))
    later = F.struct(*DOC, "line") > F.col("first")
    covers = None
    for k, level in enumerate(_levels(lines)):
        own = level.filter(later).select(
            *DOC, "line", F.lit(2**k).alias("length"),
            F.col("first._did").alias("fd"), F.col("first._dkey").alias("fk"), F.col("first.line").alias("fl"),
        )
        covers = own if covers is None else covers.unionByName(own)
    if covers is None:
        covers = lines.limit(0).select(
            *DOC, "line", F.lit(1).alias("length"), F.col("_did").alias("fd"), F.col("_dkey").alias("fk"),
            F.col("line").alias("fl"),
        )
    return lines, covers


def maximal_runs(covers: DataFrame) -> DataFrame:
    """did, dkey, start, length and the original's place of each run of chained later copies."""
    deepest = covers.groupBy(*DOC, "line").agg(F.max(F.struct("length", "fd", "fk", "fl")).alias("m")).select(
        *DOC, "line", "m.*"
    )
    by = Window.partitionBy(*DOC).orderBy("line")
    same = (
        (F.lag("line").over(by) == F.col("line") - 1) & (F.lag("fd").over(by) == F.col("fd"))
        & (F.lag("fk").over(by) == F.col("fk")) & (F.lag("fl").over(by) == F.col("fl") - 1)
    )
    chained = deepest.withColumn("opens", F.when(same, 0).otherwise(1)).withColumn("run", F.sum("opens").over(by))
    return chained.groupBy(*DOC, "run").agg(
        F.min("line").alias("start"), (F.max(F.col("line") + F.col("length")) - F.min("line")).alias("length"),
        F.min(F.struct("line", "fd", "fk", "fl")).alias("original"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` freed of later copies of repeated line runs, and n_lines, n_deleted
    and longest_run (of the maximal runs that are later copies)."""
    lines, covers = repeated_runs(docs)
    covers = stored(covers)
    # Depth 2 and up delete as they are; the two lines of each depth-2 interval cover all deeper.
    pairs = covers.filter("length = 2").select(
        *DOC, F.explode(F.array(F.col("line"), F.col("line") + 1)).alias("line"), F.lit(True).alias("hit")
    )
    single = covers.filter("length = 1").join(lines.filter("long").select(*DOC, "line"), [*DOC, "line"]).select(
        *DOC, "line", F.lit(True).alias("hit")
    )
    hit = pairs.unionByName(single).groupBy(*DOC, "line").agg(F.first("hit").alias("hit"))
    runs = maximal_runs(covers).groupBy(*DOC).agg(F.max("length").alias("longest_run"))
    gone = (
        lines.join(hit, [*DOC, "line"], "left")
        .groupBy(*DOC)
        .agg(F.count("*").alias("n_ids"), F.count("hit").alias("n_deleted"),
             F.sort_array(F.collect_list(F.when(F.col("hit"), F.col("at")))).alias("gone"))
        .filter("n_deleted > 0")
        .join(runs, DOC, "left")
    )
    added = ("n_lines", "n_deleted", "longest_run")
    kept = [c for c in docs.columns if c not in (*added, "_did", "_dkey")]
    marked = _doc_key(docs.select(*[F.col(f"`{c}`") for c in kept])).join(
        gone.select(*DOC, F.col("gone").alias("_gone"), F.col("n_ids").alias("_ids"),
                    F.col("n_deleted").alias("_deleted"), F.col("longest_run").alias("_longest")),
        DOC, "left",
    )
    # explode() of one array keeps the split from being repeated for every stretch.
    cut = marked.select("*", F.explode(F.array(F.split("text", "\n"))).alias("_split"))
    # ``gone`` is in order, so the kept lines are the stretches between its members.
    bounds = F.concat(F.array(F.lit(-1)), F.col("_gone"), F.array(F.size("_split")))
    cut = cut.select("*", F.explode(F.array(bounds)).alias("_bounds"))
    rest = F.expr("""
        array_join(flatten(transform(
          filter(zip_with(_bounds, slice(_bounds, 2, size(_bounds)),
                          (a, b) -> named_struct('a', a + 1, 'n', b - a - 1)), s -> s.n > 0),
          s -> slice(_split, s.a + 1, s.n))), '\n')""")
    text = (
        F.when(F.col("_gone").isNull(), F.col("text"))
        .when(F.col("_deleted") == F.col("_ids"), F.lit(None).cast("string"))
        .otherwise(rest)
    )
    counts = (F.coalesce(F.size("_split"), F.lit(0)), F.col("_deleted"), F.col("_longest"))
    return cut.select(
        *[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in kept],
        *[F.greatest(F.coalesce(v, F.lit(0)), F.lit(0)).cast("long").alias(n) for n, v in zip(added, counts)],
    )


def op9_line_runs(spark, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_lines", "n_deleted", "longest_run",
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.length("text").cast("long").alias("n_chars"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without later copies of line runs; those left with none go."""
    apart = by_place(docs)
    done = dedup_lines(apart)
    left = done.filter((F.col("n_deleted") == 0) | F.col("text").isNotNull())
    return left.select(*[
        (F.length("text").cast("long") if c == "n_chars" else F.col(own)).alias(c) for c, own in zip(docs.columns, apart.columns)
    ])
