"""Suffix-array dedup with a run-length index: every byte covered by a repeated string of LENGTH bytes.

A window is a string of ``length`` bytes.  Its anchor is its smallest K-byte string by hash (the
leftmost among equals), so equal windows have equal anchors at equal places.  The windows of a document
that share one anchor are a segment; windows of one segment have their anchor at different places, so
equal windows always lie in different segments of the same anchor hash.  That makes anchors a sound way
to spread the work: nothing outside the segments of an anchor can repeat a window of them.

* A segment whose bytes occur in another place is repeated whole; this needs digests and counts only,
  and takes exact copies of any number out before any text is moved.
* Segments that occur once, but share their anchor with other segments, are fetched, one text for each
  distinct segment, and the segments of some anchors together make an index of BLOCK bytes or so.
  The index is the Burrows-Wheeler transform cut into runs of equal letters, with the suffix array
  sampled at the first and last row of every run.  A suffix's longest match with the row above it
  shrinks by one from each text position to the next unless its row opens a run, and likewise for the
  row below and the end of a run; so the longest matches at the sampled run ends, found by comparing,
  give the matching statistics of every position in one stream over the text: the longest match of each
  suffix with any other place.  Windows of ``length`` or more are marked.  Few runs (repetitive texts)
  mean few comparisons.
* An anchor with more than MOST different segments would make an index without bound.  Its windows are
  counted by digest instead, which is exact as well and spreads over all tasks.

Spans of a document are joined to its text by two 64-bit hashes of id and text; digests of segments
have 64 bits besides the anchor's 64, those of windows 128.

Defined cases: null text is empty; a text shorter than ``length`` keeps all its bytes; equal rows and
equal ids are documents of their own, so a text that occurs twice is removed whole from each; bytes are
those of UTF-8, and what is left of a character may be some of its bytes; an empty table gives no row.
Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import deleted, ship, stored, table
from .words import mixed, text_chunks

LENGTH = 400
K = 64
BLOCK = 1 << 19
MOST = 2048
STRETCH = 1 << 18  # windows of a long text looked at together

_RNG = np.random.default_rng(13)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}
KEY = ["k1", "k2"]


def _powers(factor: int, n: int) -> np.ndarray:
    if factor not in _POWERS or len(_POWERS[factor]) < n:
        size = max(n, 1 << 14)
        _POWERS[factor] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, factor, np.uint64)]))
    return _POWERS[factor][:n]


_BACK = pow(_FACTOR, -1, 2**64)


def anchor_hashes(data: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of every run of ``k`` bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_FACTOR, len(data)), out=sums[1:])
    return mixed((sums[k:] - sums[:-k]) * _powers(_BACK, len(data) - k + 1))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row, from running minima within blocks of that width."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1:n])


def segments(data: np.ndarray, length: int = LENGTH, k: int = K) -> Iterator[tuple[int, int, int]]:
    """(first window, windows, hash of the anchor) of a text's segments."""
    width = length - k + 1
    for base in range(0, len(data) - length + 1, STRETCH):
        part = data[base:base + STRETCH + length - 1]
        hashes = anchor_hashes(part, k)
        least = sliding_least(hashes, width)
        cuts = [0, *(np.flatnonzero(least[1:] != least[:-1]) + 1).tolist(), len(least)]
        signed = least.view(np.int64)
        for a, b in zip(cuts, cuts[1:]):
            held = np.flatnonzero(hashes[a:b + width - 1] == least[a])
            value = int(signed[a])
            if len(held) > 1:  # the windows after an anchor's place belong to its next one
                inner = [a, *(x for x in (held + a + 1).tolist() if x < b), b]
                for x, y in zip(inner, inner[1:]):
                    yield base + x, y - x, value
            else:
                yield base + a, b - a, value


def _digest(data) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


_CUT = "k1 long, k2 long, start long, windows int, value long, digest long"
_HELD = "value long, digest long, n long, k1 long, k2 long, start long, bytes binary, big boolean"
_MARK = "k1 long, k2 long, first long, stop long"


def _cutter(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in KEY)
            for row, data, offsets in text_chunks(batch.column("text")):
                doc, found, digests = [], [], []
                for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
                    text, view = data[a:b], memoryview(data[a:b])
                    for start, windows, value in segments(text, length, k):
                        doc.append(row + i)
                        found.append((start, windows, value))
                        digests.append(_digest(view[start:start + windows + length - 1]))
                if found:
                    start, windows, value = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k1[doc]), pa.array(k2[doc]), pa.array(start, pa.int64()), pa.array(windows, pa.int32()),
                         pa.array(value, pa.int64()), pa.array(digests, pa.int64())],
                        names=["k1", "k2", "start", "windows", "value", "digest"],
                    )

    return run


def _fetcher(length: int):
    """The bytes of the wanted segments of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["value", "digest", "n", "k1", "k2", "start", "bytes", "big"]
        kinds = [pa.int64()] * 6 + [pa.binary(), pa.bool_()]
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_buffer()
                k1, k2 = (batch.column(c)[i].as_py() for c in KEY)
                rows = [
                    (w["value"], w["digest"], w["n"], k1, k2, w["start"],
                     text[w["start"]:w["start"] + w["windows"] + length - 1].to_pybytes(), w["big"])
                    for w in batch.column("wanted")[i].as_py()
                ]
                for low in range(0, len(rows), 4096):
                    columns = zip(*rows[low:low + 4096])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def suffix_ranks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(letters, suffix array, [(depth, rank of each suffix by so many letters)]) of texts in a row,
    each closed by a letter of its own, by prefix doubling from seven letters on."""
    count = len(texts)
    lengths = np.array([len(t) for t in texts])
    letters = np.empty(int(lengths.sum()) + count, np.int64)
    ends = np.cumsum(lengths + 1) - 1
    plain = np.ones(len(letters), bool)
    plain[ends] = False
    letters[plain] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + count
    letters[ends] = np.arange(count)
    n = len(letters)
    left = np.repeat(ends, lengths + 1) - np.arange(n)  # letters before the closing one
    small = np.where(plain, letters - count + 1, 0)
    key = np.zeros(n, np.int64)
    for j in range(7):
        shifted = np.zeros(n, np.int64)
        shifted[: max(n - j, 0)] = small[j:]
        key = (key << 9) | np.where(left > j, shifted, 0)
    owner = np.where(left < 7, np.repeat(np.arange(count), lengths + 1) + 1, 0)  # ends differ by their text
    order = np.lexsort((owner, key))
    new = np.ones(n, np.int64)
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(new) - 1
    levels, depth = [(7, rank)], 7
    while rank.max() < n - 1:
        further = np.zeros(n, np.int64)
        further[: max(n - depth, 0)] = rank[depth:]
        key = rank * n + further
        order = np.argsort(key)
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        depth *= 2
        levels.append((depth, rank))
    return letters, np.argsort(rank), levels


def _common(a: np.ndarray, b: np.ndarray, letters: np.ndarray, levels: list) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at ``a`` and ``b``."""
    a, b, n = a.copy(), b.copy(), len(letters)
    total = np.zeros(len(a), np.int64)
    for depth, rank in reversed(levels):
        same = (a < n) & (b < n)
        same[same] = rank[a[same]] == rank[b[same]]
        step = same * depth
        a, b, total = a + step, b + step, total + step
    for _ in range(6):
        same = (a < n) & (b < n)
        same[same] = letters[a[same]] == letters[b[same]]
        a, b, total = a + same, b + same, total + same
    return total


def matching_statistics(texts: list[bytes]) -> np.ndarray:
    """Longest match of each suffix of the texts in a row with any other place, from the runs of their
    Burrows-Wheeler transform and the suffix array at the runs' ends."""
    letters, suffixes, levels = suffix_ranks(texts)
    n = len(letters)
    transform = letters[suffixes - 1]
    opens = np.flatnonzero(transform[1:] != transform[:-1]) + 1  # rows that open a run, but the first
    firsts, lasts = suffixes[opens], suffixes[opens - 1]  # the sampled ends of neighbouring runs
    match = _common(firsts, lasts, letters, levels)
    place = np.arange(n)
    best = np.zeros(n, np.int64)
    for samples, alone in ((firsts, suffixes[0]), (lasts, suffixes[-1])):
        reach = np.full(n, -1, np.int64)
        reach[samples] = samples + match
        reach[alone] = alone  # no row above the first, none below the last
        at = np.maximum.accumulate(np.where(reach >= 0, place, 0))
        best = np.maximum(best, reach[at] - place)
    return best


def _marker(length: int, block: int):
    """Repeated windows of the segments that occur once, some anchors' segments at a time."""

    def marked(group: dict) -> list[tuple[int, int, int, int]]:
        out, at = [], 0
        rows = list(group.values())
        found = matching_statistics([r[4] for r in rows]) >= length if len(rows) > 1 else None
        for n, k1, k2, start, data in rows if found is not None else ():
            if n == 1:
                own = np.zeros(len(data) - length + 3, np.int8)
                own[1:-1] = found[at:at + len(data) - length + 1]
                edge = np.diff(own)
                for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                    out.append((k1, k2, start + a, start + b + length - 1))
            at += len(data) + 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = {}, 0, None
        for batch in batches:
            names = ("value", "digest", "n", "k1", "k2", "start", "bytes")
            for value, digest, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if size >= block and value != last:
                    yield _marks(marked(held))
                    held, size = {}, 0
                if (value, digest) not in held:
                    held[value, digest] = row
                    size += len(row[-1])
                last = value
        yield _marks(marked(held))

    return run


def _marks(rows: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["k1", "k2", "first", "stop"])


def _windows(length: int):
    """A digest of every window of the segments of an anchor with too many of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, k1, k2, start, data in zip(*(batch.column(c).to_pylist() for c in ("n", "k1", "k2", "start", "bytes"))):
                m, view = len(data) - length + 1, memoryview(data)
                said = [hashlib.blake2b(view[i:i + length], digest_size=16).digest() for i in range(m)]
                fixed = [pa.array(np.full(m, v)) for v in (n, k1, k2)]
                yield pa.RecordBatch.from_arrays(
                    [*fixed, pa.array(np.arange(start, start + m)), pa.array(said, pa.binary())],
                    names=["n", "k1", "k2", "first", "said"],
                )

    return run


def _cleaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its spans."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        removed, kept = [], []
        for i in range(batch.num_rows):
            text, spans = batch.column("text")[i], batch.column("spans")[i].as_py() or []
            text = text.as_buffer() if text.is_valid else pa.py_buffer(b"")
            joined: list[list[int]] = []
            for a, b in sorted((s["first"], s["stop"]) for s in spans):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([a, b])
            done, parts = 0, []
            for a, b in joined:
                parts.append(text[done:a].to_pybytes())
                done = b
            parts.append(text[done:].to_pybytes())
            kept.append(b"".join(parts))
            removed.append([{"start": a, "stop": b} for a, b in joined])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, kind), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "removed", "kept"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(13), "text", "doc_id").alias("k2"),
    )


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, k: int = K, block: int = BLOCK, most: int = MOST
) -> DataFrame:
    """k1, k2, first, stop: byte spans of the documents that repeated windows cover; they overlap."""
    long = _keyed(docs).filter(F.col("n_bytes") >= length).select(*KEY, "text")
    cuts = stored(long.mapInArrow(_cutter(length, k), _CUT))
    same = ["value", "digest"]
    classes = stored(cuts.groupBy(*same, "windows").agg(
        F.count("*").alias("n"), F.min(F.struct(*KEY, "start")).alias("at")
    ))
    again = classes.filter("n > 1").select(*same)
    whole = stored(cuts.join(again.hint("merge"), same).select(
        *KEY, F.col("start").alias("first"), (F.col("start") + F.col("windows") + length - 1).alias("stop")
    ))
    deleted(cuts)
    by_anchor = classes.groupBy("value").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    open_ = by_anchor.filter("kinds > 1 AND least = 1").select("value", (F.col("kinds") > most).alias("big"))
    wanted = classes.join(open_.hint("merge"), "value").groupBy(F.col("at.k1").alias("k1"), F.col("at.k2").alias("k2")).agg(
        F.collect_list(F.struct("value", "digest", "n", "at.start", "windows", "big")).alias("wanted")
    )
    held = stored(
        long.dropDuplicates(KEY).join(wanted.hint("merge"), KEY).mapInArrow(_fetcher(length), _HELD)
    )
    deleted(classes)
    few = held.filter("NOT big").repartition("value").sortWithinPartitions("value").mapInArrow(_marker(length, block), _MARK)
    marks = stored(few)
    windows = held.filter("big").mapInArrow(_windows(length), "n long, k1 long, k2 long, first long, said binary")
    if not held.filter("big").isEmpty():
        windows = stored(windows)
        twice = windows.groupBy("said").agg(F.sum("n").alias("m")).filter("m > 1").select("said")
        many = windows.filter("n = 1").join(twice.hint("merge"), "said").select(
            *KEY, "first", (F.col("first") + length).alias("stop")
        )
        marks = marks.unionByName(stored(many))
    deleted(held)
    return marks.unionByName(whole)


def dedup_substrings(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """doc_id, n_bytes, removed (its maximal removed runs) and kept (the bytes left) of each document."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    spans = repeated_spans(docs, length, **options).groupBy(*KEY).agg(
        F.collect_set(F.struct("first", "stop")).alias("spans")  # equal rows mark the same spans
    )
    keyed = _keyed(docs)
    cut = keyed.filter(F.col("n_bytes") >= length).join(spans.hint("merge"), KEY, "left").select(
        "doc_id", "n_bytes", "text", "spans"
    ).mapInArrow(_cleaner, "doc_id long, n_bytes long, removed array<struct<start long, stop long>>, kept binary")
    short = keyed.filter(F.col("n_bytes") < length).select(
        "doc_id", "n_bytes", F.array().cast("array<struct<start long, stop long>>").alias("removed"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("kept"),
    )
    return cut.unionByName(short)


def op13_run_length_index(spark, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
