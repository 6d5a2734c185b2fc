"""Run-length index dedup against counting every window of every text."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairsignal.llm import run_length_index as index

SCHEMA = "doc_id long, text string, value long, spans string, n_bytes int"


def plain(docs, length):
    """[doc_id, bytes, removed bytes, runs, digest] of each document."""
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def answers(df):
    return sorted(
        ((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest())
         for r in df.collect()), key=str)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], SCHEMA)


def corpus(seed, length):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghé日") for _ in range(rng.randint(1, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [prose(n) for n in (length // 9, length // 4, length // 2, length)]
    texts = [None, "", "short", "a" * (3 * length), "a" * (length + 1), "a" * length, "ab" * length, "xyz" * length, "b" * length]
    exact = "".join(rng.choice("pqrstuvw") for _ in range(length))
    texts += [exact, "1" + exact, exact + "2", exact[:-1] + "3", "4" + exact[1:], exact[1:]]
    for _ in range(40):
        base = prose(rng.choice([5, 40, 120])) + " " + rng.choice(passages) + " " + prose(rng.choice([0, 30]))
        texts.append(base)
        if rng.random() < 0.4:
            near = list(base)
            for _ in range(rng.choice([0, 1, 3])):
                near[rng.randrange(len(near))] = "#"
            texts.append("".join(near))
    texts += [prose(60) + " " + passages[2] + " " + prose(3) + " " + passages[2]]
    docs = list(enumerate(texts))
    return docs + docs[20:24] + [(None, texts[25]), (3, texts[30])]


@pytest.mark.parametrize("seed,length,k", [(1, 100, 20), (2, 400, 64), (3, 64, 64)])
def test_against_counting_windows(spark, seed, length, k):
    docs = corpus(seed, length)
    assert answers(index.dedup_substrings(frame(spark, docs), length, k=k)) == plain(docs, length)


def test_anchors_with_many_segments_and_small_blocks(spark):
    docs = corpus(4, 100)
    got = index.dedup_substrings(frame(spark, docs), 100, k=20, most=2, block=1)
    assert answers(got) == plain(docs, 100)


def test_stretches_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(index, "STRETCH", 150)
    docs = corpus(5, 100)
    cut = [list(index.segments(__import__("numpy").frombuffer((t or "").encode(), "u1"), 100, 20)) for _, t in docs]
    for (_, t), found in zip(docs, cut):
        assert sum(w for _, w, _ in found) == max(0, len((t or "").encode()) - 99)


def test_empty_table(spark):
    assert index.dedup_substrings(frame(spark, [])).count() == 0


def longest_elsewhere(texts):
    places = [t[i:] for t in texts for i in range(len(t))]

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    flat = [max([0, *(common(a, b) for j, b in enumerate(places) if j != i)]) for i, a in enumerate(places)]
    out, at = [], 0
    for t in texts:
        out += [*flat[at:at + len(t)], 0]
        at += len(t)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=40).map(str.encode), min_size=2, max_size=6))
def test_matching_statistics(texts):
    assert index.matching_statistics(texts).tolist() == longest_elsewhere(texts)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc", min_size=30, max_size=300).map(str.encode))
def test_equal_windows_lie_in_segments_of_one_anchor(text):
    import numpy as np

    found = list(index.segments(np.frombuffer(text, np.uint8), 20, 6))
    anchor, seen = {}, {}
    for start, windows, value in found:
        for i in range(start, start + windows):
            said = text[i:i + 20]
            assert anchor.setdefault(said, value) == value
            assert seen.setdefault((said, start), i) == i  # once in a segment
    assert sum(w for _, w, _ in found) == len(text) - 19
