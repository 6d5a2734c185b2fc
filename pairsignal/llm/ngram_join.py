"""N-gram Jaccard self-join by grouped prefixes, exact at any threshold.

1. One pass hashes the word shingles of every whole text to a set of 64-bit numbers and writes, per
   document, the set's size, a 128-bit signature and the numbers that its prefix can come from.
   Documents with equal signatures are one class; only its first member goes on.
2. All sets are ordered alike: numbers under a fixed fraction of the hash range come first, rarest
   first (document counts over the whole corpus), then the rest by value.  Two sets that link share
   a number in the first n - ceil(t n) + 1 places.  Numbers that one document alone has fill those
   places first and lead nowhere, so most documents take no further part.
3. Of the others, those that share a prefix number with a set of a size near theirs are candidates.
   Their whole sets are fetched by text hash, and ordered once more, now all their numbers by their
   counts among these sets.  Places then tell how much of a set is its own.
4. Classes with equal size and equal prefix are one group.  Groups that share a prefix number are
   filtered by size and by place: the overlap still possible after the shared place must reach what
   t asks for both sizes.  Groups that pass are expanded to their members, which are verified.
5. Only components are asked for, so pairs are tried in two rounds.  The first tries each member
   of a group against the first member of one group of every number it shares, that whose numbers are the commonest (the centre of a
   family of copies), and against the first of its own: about as many pairs as prefix places.  The
   second tries all remaining pairs of groups whose members are not yet in one component.  Copies
   by the thousand so meet one pivot instead of one another, and no pair that could join two
   components is left out.

Verification intersects the two whole sets.

Defined cases: null or empty texts and texts without words have an empty set, n_shingles 0, no
links, and are their own component.  Texts with fewer words than a shingle have one shingle, the
whole sequence.  Rows with equal ids or equal rows are separate rows; a component's id is its
smallest document id, and a null id counts as absent (a component of null ids alone has a null
id).  Extra columns are ignored by the join and passed through by the stage.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .tables import NO_ID, by_place, deleted, stored, table
from .words import MIXERS, mixed, shingle_set, shingles, text_chunks, word_hashes

WIDTH, PERCENT = 4, 85  # of the registered query
STAGE_WIDTH, STAGE_PERCENT = 5, 80
SPREAD = 1.5  # the ordered fraction of the hash range, as a multiple of the prefix's share

_ROWS = "doc_id long, t1 long, t2 long, n int, s1 long, s2 long, ordered int, tokens array<long>"


def _prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    for _, data, offsets in text_chunks(column):
        words, at = word_hashes(data, offsets)
        runs = shingles(words, width)
        for first, stop in zip(at[:-1], at[1:]):
            yield shingle_set(words, runs, first, stop, width)


def _list(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _summaries(width: int, percent: int):
    limit = np.uint64(min(2.0**64 - 2**12, 2.0**64 * SPREAD * (100 - percent) / 100))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ordered, tokens, signs = [], [], [], ([], [])
            for u in _sets(batch.column("text"), width):
                n, own = len(u), int(np.searchsorted(u, limit))
                sizes.append(n)
                ordered.append(own)
                tokens.append(u[:max(own, _prefix_length(n, percent))] if n else u)
                signs[0].append(mixed(u * MIXERS[40] + MIXERS[41]).sum(dtype=np.uint64))
                signs[1].append(np.bitwise_xor.reduce(mixed(u + MIXERS[42])) if n else np.uint64(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("t1"), batch.column("t2"), pa.array(sizes, pa.int32()),
                 *[pa.array(np.array(s, np.uint64).view(np.int64)) for s in signs],
                 pa.array(ordered, pa.int32()), _list(tokens)],
                names=["doc_id", "t1", "t2", "n", "s1", "s2", "ordered", "tokens"],
            )

    return run


def _text_keys(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.withColumns({"t1": F.xxhash64(text), "t2": F.crc32(text.cast("binary"))})


def _reachable(percent: int, n1: Column, at1: Column, n2: Column, at2: Column) -> Column:
    """Can sets of these sizes that first meet at these places still link?"""
    need = percent * (n1 + n2)
    return (
        (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))
        & ((100 + percent) * (n1 - at1) >= need) & ((100 + percent) * (n2 - at2) >= need)
    )


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """node, n and the prefix (place and token) of each set (node, n, ordered, tokens) whose prefix
    holds a number that another set has; g1 and g2 are hashes of the prefix.  ``weight`` is the sum
    of the counts of its numbers: the centre of a family of copies has the largest."""
    own = sets.select("node", F.explode(F.slice("tokens", F.lit(1), F.col("ordered"))).alias("token"))
    counts = stored(own.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"))
    shared = own.join(counts, "token").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"),  # at most the set
        F.sum("df").alias("weight"),
    )
    length = F.expr(f"CAST(n - ({percent} * CAST(n AS BIGINT) + 99) DIV 100 + 1 AS INT)")
    # Numbers past the ordered fraction serve only where that fraction holds too few.
    rest = F.expr("slice(tokens, ordered + 1, greatest(0, p - ordered))")
    per_set = (
        sets.withColumn("p", length).select("node", "n", "ordered", "p", rest.alias("rest"))
        .join(shared, "node", "left")
        .withColumn("shared", F.coalesce(F.col("shared.token"), F.array().cast("array<long>")))
        .withColumn("alone", F.col("ordered") - F.size("shared"))
    )
    prefix = F.concat(
        F.expr("transform(slice(shared, 1, greatest(0, p - alone)), (t, i) -> struct(alone + i as place, t as token))"),
        F.transform("rest", lambda t, i: F.struct((F.col("ordered") + i).alias("place"), t.alias("token"))),
    )
    return (
        per_set.withColumn("prefix", prefix).filter(F.size("prefix") > 0)
        .select("node", "n", "prefix", F.coalesce("weight", F.lit(0)).alias("weight"), F.xxhash64("n", "prefix").alias("g1"), F.hash("prefix").alias("g2"))
    )


def _meeting(prefixes: DataFrame, percent: int) -> DataFrame:
    """The nodes that share a prefix number with a set of a size near theirs.

    Sizes that can link lie in one band of the logarithm or in two that touch; each set shows up
    in its band and the next, so that both meet under one number."""
    width = math.log(100 / percent) * 1.0001
    band = F.floor(F.ln("n") / F.lit(width))
    shown = prefixes.select("node", F.explode("prefix.token").alias("token"), band.alias("band")).select(
        "node", "token", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band")
    )
    crowd = stored(shown.groupBy("token", "band").agg(F.count("*").alias("k")).filter("k > 1").drop("k"))
    return shown.join(crowd, ["token", "band"]).select("node").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets link."""
    from_a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("of_a"))
    from_b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(len(batch), bool)
            last, x = None, None
            for i, (key, of_a, of_b) in enumerate(zip(batch.column("a"), batch.column("of_a"), batch.column("of_b"))):
                if key.as_py() != last:
                    last, x = key.as_py(), of_a.values.to_numpy()
                y = of_b.values.to_numpy()
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    joined = pairs.join(from_b, "b").join(from_a, "a").select("a", "b", "of_a", "of_b")
    return joined.mapInArrow(run, "a long, b long")


def _member_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node, n and tokens (the whole set) of the wanted nodes, hashed again from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_sets(batch.column("text"), width))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(u) for u in found], pa.int32()), _list(found)], names=["node", "n", "tokens"]
            )

    texts = _text_keys(docs.select("doc_id", "text")).withColumn("did", F.coalesce("doc_id", F.lit(NO_ID)))
    found = texts.join(wanted, ["did", "t1", "t2"]).select("node", "text")
    return found.mapInArrow(run, "node long, n int, tokens array<long>")


def _row_keys(summaries: DataFrame) -> DataFrame:
    """node, did, t1, t2 and how many rows have these keys."""
    key = ["did", "t1", "t2"]
    rows = summaries.select(F.col("uid").alias("node"), F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), "t1", "t2")
    return rows.join(rows.groupBy(key).agg(F.count("*").alias("copies")), key)


def linked_documents(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, t1, t2 (hashes of the text), uid, n, node and root of every row of ``docs``: rows
    with one root are connected by links."""
    keyed = _text_keys(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    whole = stored(
        keyed.mapInArrow(_summaries(width, percent), _ROWS).withColumn("uid", F.monotonically_increasing_id())
    )
    summaries = stored(whole.drop("tokens"))
    classes = stored(summaries.filter("n > 0").groupBy("s1", "s2").agg(F.min("uid").alias("node")))
    # Read three times below; the sets, the largest table, are shuffled to their classes once.
    firsts = stored(
        whole.filter("n > 0").select(F.col("uid").alias("node"), "n", "ordered", "tokens").join(classes.select("node"), "node")
    )
    deleted(whole)
    first_prefixes = stored(_prefixes(firsts, percent))
    deleted(firsts)
    wanted = stored(_meeting(first_prefixes, percent).join(_row_keys(summaries), "node"))
    deleted(first_prefixes)
    sets = _member_sets(docs, wanted.filter("copies = 1"), width)
    repeated = wanted.filter("copies > 1")
    if not repeated.isEmpty():  # rows that are wholly equal give their set once
        sets = sets.unionByName(_member_sets(docs, repeated, width).dropDuplicates(["node"]))
    sets = stored(sets)
    deleted(wanted)
    prefixes = stored(_prefixes(sets.withColumn("ordered", F.col("n")), percent))
    group = prefixes.groupBy("n", "g1", "g2").agg(F.min("node").alias("gid"))
    members = stored(prefixes.join(group, ["n", "g1", "g2"]).select("node", "gid", "n"))
    places = stored(
        prefixes.join(members.filter("node = gid").select("node", "gid"), "node")
        .select(F.explode("prefix").alias("t"), "gid", "n", "weight").select("t.token", "gid", "n", "t.place", "weight")
    )

    deleted(prefixes)
    # First round: the first group of each number, the first member of each group.
    pivots = stored(
        places.groupBy("token").agg(F.max(F.struct("weight", "gid", "n", "place")).alias("x"), F.count("*").alias("k"))
        .filter("k > 1").select("token", "x.gid", "x.n", "x.place")
    ).toDF("token", "gid0", "n0", "place0")
    met = places.join(pivots, "token").filter(
        (F.col("gid") != F.col("gid0")) & _reachable(percent, F.col("n"), F.col("place"), F.col("n0"), F.col("place0"))
    )
    tried = stored(
        met.select("gid0", "gid").distinct().join(members.select("node", "gid"), "gid")
        .select(F.col("gid0").alias("a"), F.col("node").alias("b"))
        .unionByName(members.filter("node <> gid").select(F.col("gid").alias("a"), F.col("node").alias("b")))
        .distinct()
    )
    links = stored(_verified(tried, sets, percent))
    joined = stored(connected_components(links))

    # Second round: groups that meet and hold members of different components.
    held = stored(
        members.join(joined, "node", "left").select("node", "gid", "n", F.coalesce("component", "node").alias("part"))
    )
    parts = held.select("gid", "part").distinct()
    spread = places.drop("weight").join(parts, "gid")
    mixed_tokens = stored(
        spread.groupBy("token").agg(F.min("part").alias("p0"), F.max("part").alias("p1")).filter("p0 < p1").select("token")
    )
    open_ = stored(spread.join(mixed_tokens, "token"))
    deleted(places)
    other = open_.toDF(*[c if c == "token" else f"{c}_" for c in open_.columns])
    meet = open_.join(other, "token").filter(
        (F.col("gid") <= F.col("gid_")) & (F.col("part") != F.col("part_"))
        & _reachable(percent, F.col("n"), F.col("place"), F.col("n_"), F.col("place_"))
    ).select("gid", "part", "gid_", "part_").distinct()
    one = held.select("gid", "part", F.col("node").alias("a"))
    two = held.select(F.col("gid").alias("gid_"), F.col("part").alias("part_"), F.col("node").alias("b"))
    more = (
        meet.join(one, ["gid", "part"]).join(two, ["gid_", "part_"])
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        .join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    )
    more = stored(more)
    deleted(open_)
    links2 = stored(_verified(more, sets, percent))
    deleted(sets)
    if not links2.isEmpty():
        joined = stored(connected_components(links.unionByName(links2)))
    return (
        summaries.join(classes, ["s1", "s2"], "left").withColumn("node", F.when(F.col("n") > 0, F.col("node")))
        .join(joined, "node", "left")
        .select("doc_id", "t1", "t2", "uid", "n", F.coalesce("component", "node", "uid").alias("root"),
                F.coalesce("node", "uid").alias("node"))
    )


def op3_ngram_join(spark, sf_dir: str) -> DataFrame:
    rows = stored(linked_documents(table(spark, sf_dir, "documents")))
    least = stored(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    return rows.join(least, "root").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates the document with the smallest id stays;
    documents without words all stay."""
    rows = stored(linked_documents(docs, STAGE_WIDTH, STAGE_PERCENT))
    did = F.coalesce("doc_id", F.lit(NO_ID))
    # null ids last, so that a document with an id is preferred.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "uid")).alias("first")
    kept = stored(
        rows.groupBy("root").agg(first).select(F.col("first.uid").alias("uid"))
        .join(rows, "uid").select(did.alias("_did"), "t1", "t2", (F.col("n") == 0).alias("_all")).distinct()
        .withColumnsRenamed({"t1": "_t1", "t2": "_t2"})
    )
    text, apart = F.col("text"), by_place(docs)
    keyed = apart.withColumns({
        "_did": did, "_t1": F.xxhash64(text), "_t2": F.crc32(text.cast("binary")),
    }).withColumn("_t2", F.coalesce("_t2", F.lit(-1)))
    kept = kept.withColumn("_t2", F.coalesce("_t2", F.lit(-1)))
    again = Window.partitionBy("_did", "_t1", "_t2").orderBy("_t1")
    return (
        keyed.join(kept, ["_did", "_t1", "_t2"])
        .withColumn("_row", F.row_number().over(again)).filter("_all OR _row = 1")
        .select(*apart.columns).toDF(*docs.columns)
    )
