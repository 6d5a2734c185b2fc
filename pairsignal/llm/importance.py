"""Target-distribution importance resampling: hashed n-gram weights and Gumbel top-k.

A document's features are its runs of one to ``WIDTH`` words, each hashed to one of ``buckets``
buckets by the CRC-32 of its bytes.  A bucket's gain is the log ratio of its share in the target
texts to its share in the corpus; a document's weight is the sum of its features' gains.  Gumbel
noise, seeded by the document's id, makes the highest scores a draw without replacement in
proportion to exp(weight).

CRCs come from a position table.  The CRC of n bytes is the XOR of one number for each byte, which
depends on the byte and on its distance from the end alone, and of a constant for n.  So the bytes of
all features are laid end to end, looked up by (distance, byte), and folded with one
``bitwise_xor.reduceat`` over the features' spans.  The table reaches DEPTH bytes back; a longer span
is cut into blocks of DEPTH bytes from its end, and the blocks are folded from the front, each step
moving the state DEPTH bytes on.  Features are laid out SPREAD bytes at a time, so memory follows the
longest text, not its features.

Two passes read the texts, and no text is shuffled: the first sums features by bucket within each
task, which sends a row a bucket at most; the second weighs each document with the table of gains
(``buckets`` numbers).  Ranks are places in a range-partitioned sort: each partition numbers its own
rows, and the partitions' sizes (one row each) give the rest, so no partition sees all rows and a
score that many documents share is split by the row's number.

Defined cases: null and empty texts have no words, no features and weight 0, as do texts of
separators only; documents under ``min_words`` words are scored but never drawn; a null doc_id is
hashed as the empty string and comes last among ties; equal doc_ids and equal rows are documents of
their own, each with its rank; without target texts every gain is that of a bucket the target lacks;
an empty table gives no row.  Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import ship, stored, table
from .words import text_chunks

BUCKETS = 10_000
WIDTH = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
DEPTH = 64
SPREAD = 1 << 19  # bytes of features laid out at once

# CRC-32 as in zip and PNG files (polynomial 0xEDB88320, reflected): how one byte moves the state.
_STEP = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _STEP = (_STEP >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (_STEP & np.uint32(1)))


def _on(state: np.ndarray) -> np.ndarray:
    """The state after one more zero byte."""
    return (state >> np.uint32(8)) ^ _STEP[state & np.uint32(255)]


def _position_table(depth: int) -> np.ndarray:
    rows = [_STEP]
    for _ in range(depth - 1):
        rows.append(_on(rows[-1]))
    return np.concatenate(rows)


_PLACES = _position_table(DEPTH)  # [256 * distance from the end + byte]
_FAR = [_PLACES[-256:]]  # how DEPTH zero bytes move each byte of a state
for _i in range(3):
    _shifted = np.arange(256, dtype=np.uint32) << np.uint32(8 * (_i + 1))
    for _ in range(DEPTH):
        _shifted = _on(_shifted)
    _FAR.append(_shifted)
_shifted = np.arange(256, dtype=np.uint32)
for _ in range(DEPTH):
    _shifted = _on(_shifted)
_FAR[0] = _shifted
_NONE = np.array([zlib.crc32(bytes(n)) for n in range(4 * DEPTH + 1)], dtype=np.uint32)  # of n zero bytes


def _far_on(state: np.ndarray) -> np.ndarray:
    """The state after DEPTH more zero bytes."""
    out = _FAR[0][state & np.uint32(255)]
    for i in (1, 2, 3):
        out = out ^ _FAR[i][(state >> np.uint32(8 * i)) & np.uint32(255)]
    return out


def _zeros(lengths: np.ndarray) -> np.ndarray:
    """CRC of so many zero bytes."""
    out = _NONE[np.minimum(lengths, len(_NONE) - 1)]
    for i in np.flatnonzero(lengths >= len(_NONE)):
        state, left = 0, int(lengths[i])
        while left:
            step = min(left, 1 << 20)
            state, left = zlib.crc32(bytes(step), state), left - step
        out[i] = state
    return out


def _folded(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XOR of the position table over spans of at most DEPTH bytes."""
    ends = np.cumsum(lengths)
    place = np.arange(ends[-1], dtype=np.int64)
    first = ends - lengths
    at = place + np.repeat(starts - first, lengths)
    back = np.repeat(ends - 1, lengths) - place
    return np.bitwise_xor.reduceat(_PLACES[(back << 8) + data[at]], first)


def span_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data``; no span is empty."""
    out = np.empty(len(starts), np.uint32)
    short = lengths <= DEPTH
    if short.any():
        out[short] = _folded(data, starts[short], lengths[short])
    for i in np.flatnonzero(~short):
        start, length = int(starts[i]), int(lengths[i])
        state, whole = np.uint32(0), length // DEPTH
        if head := length - whole * DEPTH:
            state = _folded(data, np.array([start]), np.array([head]))[0]
        for low in range(0, whole, SPREAD // DEPTH):
            blocks = np.arange(low, min(whole, low + SPREAD // DEPTH))
            for part in _folded(data, start + head + blocks * DEPTH, np.full(len(blocks), DEPTH)):
                state = _far_on(np.atleast_1d(state))[0] ^ part
        out[i] = state
    return out ^ _zeros(lengths)


_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def joined_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all words with one space after each, their starts, their ends, words before each
    document and in all)."""
    docs = len(offsets) - 1
    low = _LOWER[data]
    inside = _WORD[low]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    opens[cuts] = inside[cuts]
    at = np.flatnonzero(inside)
    first = np.flatnonzero(opens[at])
    if not len(first):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none, np.zeros(docs + 1, np.int64)
    lengths = np.diff(first, append=len(at))
    word = np.arange(len(first))
    starts = first + word
    out = np.full(len(at) + len(first), 32, np.uint8)
    out[np.arange(len(at)) + np.repeat(word, lengths)] = low[at]
    return out, starts, starts + lengths, np.searchsorted(at[first], offsets)


def features(
    data: np.ndarray, offsets: np.ndarray, buckets: int, width: int = WIDTH
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of every feature of a chunk of texts, some SPREAD bytes of them at a time."""
    joined, starts, ends, before = joined_words(data, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    for n in range(1, width + 1):
        if len(starts) < n:
            return
        first = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1:])
        lengths = ends[first + n - 1] - starts[first]
        upto = np.cumsum(lengths)
        done = 0
        while done < len(first):
            limit = (upto[done - 1] if done else 0) + SPREAD
            stop = max(done + 1, int(np.searchsorted(upto, limit, side="right")))
            own = first[done:stop]
            yield doc[own], span_crcs(joined, starts[own], lengths[done:stop]) % np.uint32(buckets)
            done = stop


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, width: int = WIDTH) -> DataFrame:
    """bucket, n: how many features of all texts each bucket holds."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column("text")):
                for _, found in features(data, offsets, buckets, width):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket from its counts in the corpus and the target: ``buckets`` numbers."""
    spark = corpus.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = (
        every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
    )
    total = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = f"(t + 1) * (all_s + {buckets}) / ((s + 1) * (all_t + {buckets}))"
    rows = both.crossJoin(F.broadcast(total)).select("bucket", F.expr(f"floor(1000 * ln({ratio}))").alias("gain"))
    out = np.zeros(buckets, np.int64)
    for bucket, gain in rows.collect():  # one row a bucket
        out[bucket] = gain
    return out


def importance_weights(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, width: int = WIDTH, seed: int = SEED,
    keep_text: bool = False,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score (and text) of every document.

    ``target`` has a text column; the score is the weight plus Gumbel noise, both in thousandths.
    """
    ship(docs.sparkSession)
    gain = gains(stored(bucket_counts(docs, buckets, width)), stored(bucket_counts(target, buckets, width)), buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.zeros((3, batch.num_rows), np.int64)
            for row, data, offsets in text_chunks(batch.column("text")):
                docs_ = len(offsets) - 1
                own = sums[:, row:row + docs_]
                own[0] += np.diff(joined_words(data, offsets)[3])
                for doc, bucket in features(data, offsets, buckets, width):
                    own[1] += np.bincount(doc, minlength=docs_)
                    first = np.flatnonzero(np.diff(doc, prepend=-1))  # features come in order of documents
                    own[2, doc[first]] += np.add.reduceat(gain[bucket], first)
            kept = [batch.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, sums)], names=[*carried, *names])

    carried, names = ["doc_id", *(["text"] if keep_text else [])], ["n_words", "n_features", "weight"]
    schema = "doc_id long" + ", text string" * keep_text + ", n_words long, n_features long, weight long"
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.left(F.sha2(said, 256), F.lit(8)), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
    return rows.withColumn("score", F.col("weight") + noise)


def importance_ranks(
    scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS
) -> DataFrame:
    """``rank`` of the drawn documents by falling score, null for others; ``scored`` is a stored
    table whose rows have a number ``row``."""
    able = scored.filter(F.col("n_words") >= min_words).select("row", "doc_id", "score")
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    placed = stored(
        able.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())  # partition * 2^33 + place
        .select("row", F.shiftright("at", 33).alias("part"), F.expr("at & 8589934591").alias("place"))
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # a row a partition
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    quota = percent * total // 100
    offsets = scored.sparkSession.createDataFrame(before, "part long, before long")
    return placed.join(F.broadcast(offsets), "part").select(
        "row", (F.col("before") + F.col("place") + 1).alias("rank")
    ).filter(F.col("rank") <= quota)


def importance_resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, keep_text: bool = True,
    **options,
) -> DataFrame:
    """Every document with n_words, n_features, weight, score and rank; rank is null if not drawn."""
    weights = importance_weights(docs, target, keep_text=keep_text, **options)
    scored = stored(weights.withColumn("row", F.monotonically_increasing_id()))
    ranks = importance_ranks(scored, percent, min_words)
    return scored.join(ranks, "row", "left").drop("row")


def op12_importance_resample(spark, sf_dir: str) -> DataFrame:
    found = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 bit by bit over the hexadecimal digits of a feature's bytes, for each distinct feature.
_BIT = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
_TABLE = (
    "SELECT list(v ORDER BY b) AS steps FROM (WITH RECURSIVE bits AS (SELECT b::UBIGINT AS b, b::UBIGINT AS c, 0 AS k "
    f"FROM range(256) r(b) UNION ALL SELECT b, ({_BIT})::UBIGINT, k + 1 FROM bits WHERE k < 8) "
    "SELECT b, c AS v FROM bits WHERE k = 8)"
)


def _sql_features(name: str, source: str, key: str) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = " UNION ALL ".join(
        f"SELECT {key}, unnest(list_transform(range(1, len(ws) - {n - 2}), lambda i: array_to_string(ws[i:i + {n - 1}], ' '))) AS f FROM {name}_words"
        for n in (1, 2, 3)
    )
    pattern = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    return f"""{name}_words AS (
  SELECT {key}, regexp_extract_all({lowered}, '{pattern}') AS ws FROM {source}),
{name}_features AS ({parts}),
{name}_counts AS (SELECT {key}, f, count(*) AS n FROM {name}_features GROUP BY ALL)"""


ORACLE = f"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
{_sql_features('d', 'docs', 'row')},
{_sql_features('b', 'benchmark', 'item_id')},
tab AS MATERIALIZED ({_TABLE}),
said AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM d_counts UNION SELECT f FROM b_counts)),
bytes AS (
  SELECT f, list_transform(range(1, len(h) // 2 + 1), lambda i:
    (16 * (strpos('0123456789ABCDEF', h[2 * i - 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i]) - 1)::UBIGINT) AS bs FROM said),
bucket AS MATERIALIZED (
  SELECT f, (xor(list_reduce(list_prepend(4294967295::UBIGINT, bs), lambda c, b: xor(c >> 8, steps[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295) % 10000)::INT AS k
  FROM bytes, tab),
s AS (SELECT k, sum(n)::DOUBLE AS s FROM d_counts JOIN bucket USING (f) GROUP BY k),
t AS (SELECT k, sum(n)::DOUBLE AS t FROM b_counts JOIN bucket USING (f) GROUP BY k),
gain AS (
  SELECT k, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)
    / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain
  FROM (SELECT r.k::INT AS k FROM range(10000) r(k)) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
weighed AS (
  SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM d_counts JOIN bucket USING (f) JOIN gain USING (k) GROUP BY row),
noisy AS (
  SELECT row, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(ws) >= 20 AS able,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5) / 4294967296.0))))::BIGINT AS score
  FROM docs JOIN d_words USING (row) LEFT JOIN weighed USING (row)),
ranked AS (
  SELECT *, CASE WHEN able THEN row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) END AS place,
    (SELECT count(*) FILTER (able) FROM noisy) AS n FROM noisy)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM ranked"""
