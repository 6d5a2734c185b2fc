"""Embedding near-dedup by Euclidean p-stable hashing, with exact cosine checks.

Vectors are normalised.  A table's hash is a tuple of quantised random projections
floor((g . x + b) / WIDTH) with Gaussian g; near vectors fall into one bucket of some table with
high probability.  How many projections a table takes follows from the number of vectors (far pairs
then share a bucket about once a vector and table), and how many tables there are from the chance
that two vectors right at the limit share a bucket, so that MISSED of such pairs at most are missed;
nearer pairs are missed far less often.

Equal vectors are one class, with their number.  A bucket of classes is dealt into blocks of BLOCK,
and every two blocks of a bucket meet in one task, where a matrix product finds the pairs near the
limit and double precision decides.  A pair counts in the first table only in which its classes
share a bucket.  A task gives out, per class, how many vectors it links with there, and a spanning
forest of the links it has seen, never the pairs; so a cluster of thousands gives one edge a member
for each task.  Sums of the counts are the numbers of links, and components follow from the edges.

Defined cases: vectors that are null, empty, all zero, or hold null or non-finite components link
with nothing (n_links 0, their own component); vectors of different lengths never link.  Rows with
equal ids are separate vectors, which count in each other's links; a null id counts as the largest
in a component, and is kept only where no other is.  Lengths beyond the range of a double are
scaled by the largest component first.  Labels and other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import stored, table
from .vector_blocks import groups, matrix, usable

LIMIT = 0.95
WIDTH = 2.0
MISSED = 0.02
BLOCK = 1024
SEED = 17


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one projection puts two vectors at this distance into one cell."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(vectors: int, limit: float = LIMIT) -> tuple[int, int]:
    """(projections of a table, tables) for so many vectors."""
    near = collision(math.sqrt(2 * (1 - limit)) or 1e-9)
    far = collision(math.sqrt(2))
    projections = max(2, math.ceil(math.log(max(2, vectors)) / -math.log(far)))
    return projections, max(1, math.ceil(math.log(MISSED) / math.log(1 - near**projections)))


def _normalised(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _buckets(projections: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                own = batch.filter(pa.array(widths == width))
                rng = np.random.default_rng([SEED, int(width)])
                g = rng.standard_normal((int(width), projections * tables))
                shift = rng.uniform(0, WIDTH, projections * tables)
                mixers = rng.integers(1, 2**62, projections * tables, dtype=np.int64) * 2 + 1
                cells = np.floor((_normalised(matrix(own.column("v"))) @ g + shift) / WIDTH).astype(np.int64)
                sums = (cells * mixers).reshape(len(own), tables, projections).sum(axis=2)  # wraps
                keys = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), tables).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [own.column(c) for c in ("node", "n", "width", "v")] + [keys], names=["node", "n", "width", "v", "keys"]
                )

    return run


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Edges (i, j) that connect what the edges a-b connect."""
    root = list(range(size))
    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = i, j
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def _links(limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (table_no, *_), rows in groups(batches, ["t", "width", "key", "one", "two"]):
            rows = rows.combine_chunks()
            n = len(rows)
            node, times = rows.column("node").to_numpy(), rows.column("n").to_numpy()
            block = rows.column("block").to_numpy()
            keys = matrix(rows.column("keys").combine_chunks(), np.int64)[:, : int(table_no)]
            v = matrix(rows.column("v").combine_chunks())
            unit = _normalised(v)
            one, two = int(rows.column("one")[0].as_py()), int(rows.column("two")[0].as_py())
            count = np.zeros(n, np.int64)
            left = np.flatnonzero(block == one)
            right = np.flatnonzero(block == two)
            edges = []
            for at in range(0, len(left), 256):
                i = left[at:at + 256]
                near = unit[i] @ unit[right].T >= limit - 1e-9
                near &= node[i][:, None] < node[right][None, :] if one == two else True
                p, q = np.nonzero(near)
                p, q = i[p], right[q]
                for s in range(0, len(p), 65536):
                    a, b = p[s:s + 65536], q[s:s + 65536]
                    first = ~(keys[a] == keys[b]).any(axis=1)
                    a, b = a[first], b[first]
                    x, y = v[a], v[b]
                    x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
                    cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
                    a, b = a[cosine >= limit], b[cosine >= limit]
                    count += np.bincount(a, times[b], n).astype(np.int64) + np.bincount(b, times[a], n).astype(np.int64)
                    edges += _forest(a, b, n)
            if not edges:
                continue
            e = np.array(edges)
            edges = np.array(_forest(e[:, 0], e[:, 1], n))
            linked = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node[linked], node[edges[:, 0]]])),
                 pa.array(np.concatenate([count[linked], np.zeros(len(edges), np.int64)])),
                 pa.array(np.concatenate([np.full(len(linked), -1), node[edges[:, 1]]]))],
                names=["a", "links", "b"],
            )

    return run


def near_vectors(vectors: DataFrame, limit: float = LIMIT) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding)."""
    vector = F.col("embedding").cast("array<double>")
    rows = stored(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("v"))
        .withColumn("good", usable(F.col("v")) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))
        # Minus zero is zero, so that equal vectors have equal hashes.
        .withColumn("v", F.when(F.col("good"), F.transform("v", lambda x: x + 0.0)))
        .withColumns({"h1": F.xxhash64("v"), "h2": F.hash("v", F.lit(1)), "row": F.monotonically_increasing_id()})
    )
    good = rows.filter("good")
    classes = stored(
        good.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("row").alias("node"))
        .join(good.select(F.col("row").alias("node"), "v"), "node").withColumn("width", F.size("v"))
    )
    projections, tables = plan(classes.count(), limit)
    hashed = stored(classes.select("node", "n", "width", "v").mapInArrow(
        _buckets(projections, tables), "node long, n long, width int, v array<double>, keys array<long>"
    ))
    places = hashed.select("node", "width", F.posexplode("keys").alias("t", "key"))
    crowd = stored(
        places.groupBy("t", "width", "key").agg(F.count("*").alias("members")).filter("members > 1")
    )
    # Blocks of a bucket; each member goes to the tasks of all pairs of blocks that hold its own.
    member = (
        places.join(crowd, ["t", "width", "key"])
        .withColumn("blocks", F.expr(f"CAST((members + {BLOCK} - 1) DIV {BLOCK} AS INT)"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")})
        .join(hashed.drop("width"), "node")
    )
    cell = ["t", "width", "key", "one", "two"]
    found = stored(
        member.select(*cell, "block", "node", "n", "v", "keys").repartition(*cell).sortWithinPartitions(*cell)
        .mapInArrow(_links(limit), "a long, links long, b long")
    )
    counts = found.filter("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    parts = stored(connected_components(found.filter("b >= 0").select("a", "b")))
    per_class = stored(
        classes.select("h1", "h2", "n", "node").join(counts, "node", "left").join(parts, "node", "left")
        .select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "node").alias("root"))
    )
    marked = stored(
        good.join(per_class, ["h1", "h2"]).select("vec_id", "row", "n_links", "root")
        .unionByName(rows.filter("NOT good").select("vec_id", "row", F.lit(0).cast("long").alias("n_links"), F.col("row").alias("root")))
    )
    least = stored(marked.groupBy("root").agg(F.min("vec_id").alias("component_id")))
    return marked.join(least, "root").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op8_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


