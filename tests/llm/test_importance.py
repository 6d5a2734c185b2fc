"""Importance resampling against a reading with zlib, a feature at a time."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairsignal.llm import importance

SCHEMA = "doc_id long, text string, row long, bucket int, score string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def buckets(text, size):
    ws = words(text)
    return [zlib.crc32(" ".join(ws[i:i + n]).encode()) % size for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def plain(docs, target, size=importance.BUCKETS, percent=5, min_words=20):
    """[doc_id, n_features, weight, score, rank] of each document, as the contract says."""
    own = [buckets(t, size) for _, t in docs]
    s, t = Counter(b for bs in own for b in bs), Counter(b for x in target for b in buckets(x, size))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + size) / ((s[b] + 1) * (all_t + size))))
    out = []
    for (doc_id, text), bs in zip(docs, own):
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, bs))
        out.append([doc_id, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [i for i, (_, text) in enumerate(docs) if len(words(text)) >= min_words]
    able.sort(key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0))
    for rank, i in enumerate(able[: percent * len(able) // 100], 1):
        out[i][4] = rank
    return sorted(map(tuple, out), key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "Of", "ça", "日本", "x1", "naïve", "I'm", "z" * 70, "q" * 129, "a-b"])
    texts = [None, "", " .,;\n", "one", "É" * 5000, "w" * 300_000, "ab " * 60_000]
    texts += [" ".join(word() for _ in range(rng.choice([3, 19, 20, 21, 60, 200]))) for _ in range(n)]
    docs = list(enumerate(texts)) + [(5, "x " * 30), (5, "x " * 30), (None, "y " * 30)]
    return docs, [" ".join(word() for _ in range(40)) for _ in range(5)] + [None, ""]


def frames(spark, docs, target):
    return (
        spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], SCHEMA),
        spark.createDataFrame([(i, t, 1, 2, "x") for i, t in enumerate(target)], SCHEMA),
    )


def answers(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()), key=str)


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=700), st.data())
def test_position_table_gives_crc32(data, draw):
    spans = draw.draw(st.lists(st.tuples(st.integers(0, len(data) - 1), st.integers(1, 700)), min_size=1, max_size=8))
    starts = np.array([s for s, _ in spans])
    lengths = np.array([min(n, len(data) - s) for s, n in spans])
    got = importance.span_crcs(np.frombuffer(data, np.uint8), starts, lengths)
    assert got.tolist() == [zlib.crc32(data[s:s + n]) for s, n in zip(starts, lengths)]


def test_long_spans_fold_by_blocks(monkeypatch):
    monkeypatch.setattr(importance, "SPREAD", 1000)
    data = np.random.default_rng(0).integers(0, 256, 50_000).astype(np.uint8)
    lengths = np.array([63, 64, 65, 128, 129, 49_000])
    got = importance.span_crcs(data, np.arange(len(lengths)), lengths)
    assert got.tolist() == [zlib.crc32(data[i:i + n].tobytes()) for i, n in enumerate(lengths)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_the_plain_reading(spark, seed):
    docs, target = corpus(seed)
    got = importance.importance_resample(*frames(spark, docs, target), keep_text=False)
    assert answers(got) == plain(docs, target)


def test_few_buckets_other_shares_and_texts(spark):
    docs, target = corpus(3)
    found = importance.importance_resample(*frames(spark, docs, target), percent=40, min_words=3, buckets=7)
    assert answers(found) == plain(docs, target, 7, 40, 3)
    texts = {(i, t) for i, t in docs}
    assert all((r["doc_id"], r["text"]) in texts for r in found.where("rank IS NOT NULL").collect())


def test_empty_tables(spark):
    docs, target = corpus(4, 20)
    assert importance.importance_resample(*frames(spark, [], target)).count() == 0
    assert answers(importance.importance_resample(*frames(spark, docs, []))) == plain(docs, [])


def test_spans_are_laid_out_in_parts(monkeypatch):
    text = "alpha beta gamma delta " * 50
    data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, 460, len(text)])
    whole = sorted(zip(*map(np.concatenate, zip(*importance.features(data, offsets, 1000)))))
    monkeypatch.setattr(importance, "SPREAD", 16)
    assert sorted(zip(*map(np.concatenate, zip(*importance.features(data, offsets, 1000))))) == whole
