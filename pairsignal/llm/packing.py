"""Mixture-controlled packing: deficit round-robin over source queues into fixed windows.

Each source is a queue of its documents.  A round is one window's worth of tokens, of which every
queue is granted its target share and spends it, and a document is cut where the grant ends; parts
of a token stay as the queue's deficit for the next round, across windows and partitions.  A queue
whose grant is under LEAST tokens saves it and spends every few rounds, at rounds that differ by
queue, so no piece is that short for it and a window is off a target by some LEAST tokens.  A token
leaves its queue in the first of these rounds in which the grants so far cover it and everything
before it: the round-robin's order follows from running sums, and no queue is walked.  The parts in
order of (round, source, place in the queue) form one stream, cut every ``window`` tokens.  Every
sequence but the last is full, so padding is less than one window in all.

Shares default to each source's part of all tokens, so all queues end together; with given weights
a queue that ends early leaves its share to the others, in proportion.

Running sums are two-level: within bounded cells (an input partition of a source; a stretch of
rounds), and over the cells' totals.  A source of any size is many cells.  Token ids are made in one
pass, stored, and fetched once by the row's number.

Defined cases: null text counts as empty and gives the one closing id; a null source is a queue of
its own; equal ids and equal rows are separate documents; a source without a weight, or with one
that is null or not positive, gets the smallest positive weight given (1 if there is none); an
empty table gives no piece.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import literal_rows, stored, table
from .words import text_chunks

WINDOW = 2048
CLOSING = 1
TOKENIZER = "word_bpe_49k.json"
MOST_CELLS = 100_000
LEAST = 32  # tokens that a queue saves up before it spends them

_OPEN: dict = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encoder(path: str):
    """One encoder for each Python worker, whose memory of words outlives a task."""
    from .word_bpe import WordBpe

    if path not in _OPEN:
        _OPEN[path] = WordBpe(path)
    return _OPEN[path]


def token_table(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, source, tokens (with the closing id), ids (unsigned 16-bit, little-endian), row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column("text")):
                ids, before = encoder.encode(data, offsets)
                n = len(offsets) - 1
                # The closing id after each document.
                whole = np.insert(ids, before[1:], CLOSING).astype("<u2")
                ends = (before + np.arange(n + 1)) * 2
                said = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(whole)]
                ).cast(pa.binary())
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"), pa.array(np.diff(ends) // 2, pa.int64()), said],
                    names=["doc_id", "source", "tokens", "ids"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    done = texts.mapInArrow(run, "doc_id long, source string, tokens long, ids binary")
    return stored(done.withColumn("row", F.monotonically_increasing_id()))


def _running(rows: DataFrame, group: list[str], cell: str, order: list[str], n: str, out: str) -> DataFrame:
    """Adds the sum of ``n`` over the group's rows up to and with this one; cells lie in order."""
    inner = Window.partitionBy(*group, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy(*group, cell).agg(F.sum(n).alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(outer), F.lit(0))
    ).drop("_n")
    return (
        rows.withColumn("_own", F.sum(n).over(inner)).join(cells, [*group, cell])
        .withColumn(out, F.col("_own") + F.col("_before")).drop("_own", "_before")
    )


def placed(tokens: DataFrame, weights: dict[str, float] | None = None, window: int = WINDOW) -> DataFrame:
    """row, start, tokens, first: the parts of each document, and the place of their first token in
    the packed stream."""
    rows = tokens.select("row", F.coalesce("source", F.lit("")).alias("queue"),
                         F.col("source").isNull().alias("unnamed"), "tokens")
    queue = ["queue", "unnamed"]
    totals = stored(rows.groupBy(*queue).agg(F.sum("tokens").alias("queued")))
    if weights is None:
        shares = totals.withColumn("weight", F.col("queued").cast("double"))
    else:
        given = [(k, float(w)) for k, w in weights.items() if k is not None and w and w > 0]
        least = min((w for _, w in given), default=1.0)
        shares = totals.join(literal_rows(tokens.sparkSession, given, "queue string,given double"), "queue", "left").withColumn(
            "weight", F.when(~F.col("unnamed"), F.col("given")).otherwise(None)
        ).withColumn("weight", F.coalesce("weight", F.lit(least)))
    sums = shares.agg(F.sum("weight"), F.sum("queued"), F.max(F.col("queued") / F.col("weight"))).first()
    if sums[0] is None:
        return tokens.select("row", F.lit(0).cast("long").alias("start"), "tokens", F.lit(0).cast("long").alias("first"))
    grant = shares.select(*queue, (F.col("weight") / F.lit(sums[0]) * window).alias("grant")).withColumn(
        "every", F.greatest(F.lit(1), F.ceil(F.lit(LEAST) / F.col("grant"))).cast("long")
    ).withColumn("phase", F.pmod(F.xxhash64(*queue), F.col("every")))

    queued = _running(rows.withColumn("part", F.shiftright("row", 33)), queue, "part", ["row"], "tokens", "upto")
    # Spending t is in round t * every + phase, and reaches the place ``spent`` of its queue.
    spending = lambda n: F.greatest(F.lit(0), F.ceil((n / F.col("grant") - F.col("phase")) / F.col("every"))).cast("long")
    spent = lambda t: F.least(F.greatest(
        F.floor((t * F.col("every") + F.col("phase")) * F.col("grant")).cast("long"), F.col("low")), F.col("upto"))
    turn = F.col("turn")
    parts = (
        queued.join(grant, queue).withColumn("low", F.col("upto") - F.col("tokens"))
        .withColumns({"one": spending(F.col("low") + 1), "last": spending(F.col("upto"))})
        .withColumn("turn", F.explode(F.sequence("one", F.greatest("one", "last"))))
        .withColumns({
            "begin": F.when(turn == F.col("one"), F.col("low")).otherwise(spent(turn - 1)),
            "stop": F.when(turn >= F.col("last"), F.col("upto")).otherwise(spent(turn)),
            "round": turn * F.col("every") + F.col("phase"),
        })
        .filter("stop > begin")
    )
    rounds = parts.select("row", *queue, "round", (F.col("begin") - F.col("low")).alias("start"),
                          (F.col("stop") - F.col("begin")).alias("tokens"))
    last = sums[2] * sums[0] / window  # the number of rounds
    stretch = max(16, int(last // MOST_CELLS) + 1)
    streamed = _running(
        rounds.withColumn("cell", F.expr(f"round DIV {stretch}L")).withColumn("_all", F.lit(0)),
        ["_all"], "cell", ["round", "queue", "unnamed", "row", "start"], "tokens", "end",
    )
    return streamed.select("row", "start", "tokens", (F.col("end") - F.col("tokens")).alias("first"))


def pack_documents(
    docs: DataFrame, weights: dict[str, float] | None = None, window: int = WINDOW, path: str | None = None
) -> DataFrame:
    """Pieces: doc_id, source, start, length, ids (unsigned 32-bit, little-endian), doc_tokens,
    sequence_id, offset and padded_length of the sequence."""
    tokens = token_table(docs, path or tokenizer_path())
    places = stored(placed(tokens, weights, window))
    total = places.agg(F.sum("tokens")).first()[0] or 0
    rest = total % window
    padded_last = rest if rest & (rest - 1) == 0 and rest else window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("at", "start", "length", "ids", "sequence_id", "offset")}
            parts = batch.column("parts").to_pylist()
            for i, ids in enumerate(batch.column("ids")):
                whole = np.frombuffer(ids.as_buffer(), "<u2").astype("<u4")
                joined: list[list[int]] = []  # start, tokens, first: parts in a row are one
                for part in parts[i]:
                    if joined and joined[-1][2] + joined[-1][1] == part["first"]:
                        joined[-1][1] += part["tokens"]
                    else:
                        joined.append([part["start"], part["tokens"], part["first"]])
                for done, n, place in joined:
                    stop = done + n
                    while done < stop:
                        length = min(stop - done, window - place % window)
                        for k, v in zip(out, (i, done, length, whole[done:done + length].tobytes(), place // window, place % window)):
                            out[k].append(v)
                        done, place = done + length, place + length
            own = batch.select(["doc_id", "source", "tokens"]).take(pa.array(out["at"], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [own.column("doc_id"), own.column("source"), pa.array(out["start"], pa.int64()),
                 pa.array(out["length"], pa.int64()), pa.array(out["ids"], pa.binary()), own.column("tokens"),
                 pa.array(out["sequence_id"], pa.int64()), pa.array(out["offset"], pa.int64())],
                names=["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    parts = places.groupBy("row").agg(  # at most a document's tokens
        F.sort_array(F.collect_list(F.struct("start", "tokens", "first"))).alias("parts")
    )
    pieces = tokens.join(parts, "row").select("doc_id", "source", "tokens", "ids", "parts").mapInArrow(
        run, "doc_id long, source string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
    return pieces.withColumn(
        "padded_length", F.when(F.col("sequence_id") == total // window, padded_last).otherwise(window).cast("int")
    )


def op10_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "padded_length", "source")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of the packed sequences."""
    return pack_documents(docs)
