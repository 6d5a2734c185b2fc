"""Sharding by minimax contiguous partition (native).

Rows with equal text form one atomic group.  Groups lie in one order, that of a 64-bit hash of
their text, and a shard is a contiguous stretch of it.  The smallest capacity C for which a greedy
walk needs no more than the wanted number of shards is found by bisection; then the order is cut.

The walk never sees the groups on the driver.  It asks the stored group table for "the last group
that ends at or before x", a lookup that reads one hash bucket, and a round asks for 63 capacities
at once, which is six steps of plain bisection.  The driver holds the bucket totals (at most 2^20
numbers) and the positions of the walks.

Among the partitions whose largest shard is C the cuts are then chosen for even sizes: each shard
aims at an equal part of what is left, within the bounds that the capacity sets from both ends.
A group larger than an equal part fills a shard of its own and sets C; nothing splits a group.

Defined cases: null text has size 1 and forms a group of its own, apart from empty text; its
``text_crc32`` is null.  Rows with equal ids or wholly equal rows are separate rows with slots of
their own.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import literal_rows, stored

LANES = 63  # capacities tried in one round


class _Groups:
    """Group sizes in hash order, with lookups by position (bytes before or at)."""

    def __init__(self, keyed: DataFrame, rows: int):
        bits = min(20, max(6, math.ceil(math.log2(max(1, rows / 5000)))))
        groups = keyed.groupBy("key").agg(F.sum("size").alias("bytes"))
        inner = Window.partitionBy("bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
        self.table = stored(
            groups.withColumn("bucket", F.shiftright("key", 64 - bits).cast("int"))
            .withColumn("upto", F.sum("bytes").over(inner))
        )
        total = self.table.groupBy("bucket").agg(
            F.max("upto").alias("total"), F.max("bytes").alias("largest")
        ).orderBy("bucket").collect()  # at most 2^20 rows
        self.buckets = np.array([r.bucket for r in total], dtype=np.int64)
        sizes = np.array([r.total for r in total], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.total = int(self.ends[-1]) if len(total) else 0
        self.largest = max((r.largest for r in total), default=0)

    def around(self, positions) -> list[tuple[tuple, tuple]]:
        """For each x in [0, total): (end, key) of the last group that ends at or before x, and of
        the next one.  The end 0 has no key."""
        at = np.searchsorted(self.ends, positions, side="right")
        ask = [(i, int(self.buckets[b]), int(x - self.starts[b])) for i, (x, b) in enumerate(zip(positions, at))]
        # The bucket before may hold the answer's key: it is the last one of that bucket.
        before = [
            (len(ask) + i, int(self.buckets[b - 1]), int(self.ends[b - 1] - self.starts[b - 1]))
            for i, b in enumerate(at) if b > 0
        ]
        spark = self.table.sparkSession
        wanted = literal_rows(spark, ask + before, "lane int,bucket int,x bigint")
        mark = F.struct("upto", "key")
        found = (
            self.table.filter(F.col("bucket").isin(sorted({b for _, b, _ in ask + before})))
            .join(F.broadcast(wanted), "bucket")  # at most 126 rows
            .groupBy("lane")
            .agg(F.max(F.when(F.col("upto") <= F.col("x"), mark)).alias("low"),
                 F.min(F.when(F.col("upto") > F.col("x"), mark)).alias("high"))
            .collect()
        )
        by = {r.lane: r for r in found}
        out = []
        for i, b in enumerate(at):
            base, own = int(self.starts[b]), by[i]
            high = (base + own.high.upto, own.high.key)
            if own.low is not None:
                low = (base + own.low.upto, own.low.key)
            elif b > 0:
                low = (base, by[len(ask) + i].low.key)
            else:
                low = (0, None)
            out.append((low, high))
        return out


def _feasible(groups: _Groups, capacities: list[int], shards: int) -> list[bool]:
    """Greedy walks with each capacity: does the last group fall into the last shard or before?"""
    position = [0] * len(capacities)
    for _ in range(shards):
        open_ = [i for i, p in enumerate(position) if p + capacities[i] < groups.total]
        for i, p in enumerate(position):
            if i not in open_:
                position[i] = groups.total
        if not open_:
            break
        reached = groups.around([position[i] + capacities[i] for i in open_])
        for i, (low, _) in zip(open_, reached):
            position[i] = low[0]
    return [p >= groups.total for p in position]


def smallest_capacity(groups: _Groups, shards: int) -> int:
    low = max(-(-groups.total // shards), groups.largest)  # nothing below can do
    high = -(-groups.total // shards) + groups.largest  # this always does
    while low < high:
        step = max(1, (high - low) // (LANES + 1))
        tries = sorted({min(high - 1, low + step * k) for k in range(LANES)})
        good = _feasible(groups, tries, shards)
        first = next((i for i, ok in enumerate(good) if ok), len(tries))
        high = tries[first] if first < len(tries) else high
        low = tries[first - 1] + 1 if first else low
    return high


def cut_keys(groups: _Groups, shards: int, capacity: int) -> list[int | None]:
    """The last key of each shard but the last one; None: that shard ends before every group."""
    # From the end: the first position from which the rest fits into k shards.
    earliest, at = [groups.total], groups.total
    for _ in range(shards - 1):
        if at - capacity <= 0:
            at = 0
        else:
            (low, high), = groups.around([at - capacity])
            at = low[0] if low[0] == at - capacity else high[0]
        earliest.append(at)
    cuts, position, key = [], 0, None
    for left in range(shards, 1, -1):
        floor = earliest[left - 1]
        aim = max(floor, position + -(-(groups.total - position) // left))
        if position >= groups.total:
            cuts.append(key)
            continue
        if aim >= groups.total:
            aim = groups.total - 1
        (low, high), = groups.around([aim])
        within = high[0] <= position + capacity
        # The nearer boundary, and never a shard without a group while groups are left.
        take_high = low[0] <= position or low[0] < floor or (within and high[0] - aim < aim - low[0])
        position, key = high if take_high and within else low
        cuts.append(key)
    return cuts


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, key, shard and slot of every row of ``docs``."""
    text = F.col(text_col)
    keyed = stored(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text, text.isNull()).alias("key"),
    ))
    rows = keyed.count()
    groups = _Groups(keyed, rows)
    if not groups.total:
        return keyed.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    cuts = cut_keys(groups, shards, smallest_capacity(groups, shards))
    after = [F.lit(1) if k is None else (F.col("key") > F.lit(k)).cast("int") for k in cuts]
    shard = sum(after, F.lit(0)).cast("int")

    # Slots: rows of a shard lie in cells by key and by id, so that a large group is many cells.
    side = min(10, max(5, math.ceil(math.log2(max(1, rows / 100)) / 2)))
    cell = ["shard", "part", "piece"]
    dealt = keyed.withColumn("shard", shard).withColumn(
        "part", F.shiftright("key", 64 - side).cast("int")
    ).withColumn("piece", F.shiftright(F.xxhash64("doc_id", F.lit(1)), 64 - side).cast("int"))
    before = Window.partitionBy("shard").orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(cell).agg(F.count("*").alias("n")).withColumn(  # at most 2^20 cells and 8
        "offset", F.coalesce(F.sum("n").over(before), F.lit(0))
    ).drop("n")
    order = Window.partitionBy(cell).orderBy("key", "doc_id")
    return (
        dealt.withColumn("rank", F.row_number().over(order))
        .join(offsets, cell)
        .select("doc_id", "size", "text_crc32", "key", "shard",
                (F.col("offset") + F.col("rank") - 1).alias("slot"))
    )


def op2_minimax_shards(spark, sf_dir: str) -> DataFrame:
    from .tables import table

    placed = shard_documents(table(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
