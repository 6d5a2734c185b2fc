"""Token ids against the library, and packing against its rules."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pairsignal.llm import packing
from pairsignal.llm.word_bpe import WordBpe
from pairsignal.llm.words import text_chunks

SCHEMA = "doc_id long, text string, source string, tokens long, ids string"
ODD = [
    "", " ", "It's <|endoftext|> a  don't “quoted” naïve CAFÉ ½ ²3 12ab£ ÀÉÎõü×÷ß é İstanbul ΑΣ ΣΑΣ  x y 日本語",
    "\x1c\x00 a\x85b  c é ́", "''s 'S I'LL", "a" * 3000, "ab1234cd!!??--__", "<| <|startoftext|>x", "\n\n", "a",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.tokenizer_path())


def test_ids_equal_the_library(library):
    rng = random.Random(1)
    signs = "abcdefghijklmnopqrstuvwxyzABCXYZ0123456789.,;:!?()[]\"#$%&*+-/=@^_`{|}~éÉßüÜçñ×'<ª’ \n\t"
    texts = ODD + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 400))) for _ in range(300)]
    texts += [" ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 14))) for _ in range(200)) for _ in range(20)]
    encoder, got = WordBpe(packing.tokenizer_path()), []
    for _ in range(2):
        got = []
        for _, data, offsets in text_chunks(pa.array(texts)):
            ids, before = encoder.encode(data, offsets)
            got += [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def docs(spark, seed=3):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(["the", "of", "x1", "éa"]) for _ in range(rng.choice([0, 3, 50, 700, 9000]))),
             rng.choice(["a", "a", "a", "b", None, ""]), 1, "x") for i in range(80)]
    rows += [(None, None, "c", 1, "x"), (5, "same", "a", 1, "x"), (5, "same", "a", 1, "x")]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("weights,window", [(None, 2048), ({"a": 1.0, "b": 3.0, "c": None}, 256)])
def test_pieces_hold_every_id_once(spark, library, weights, window):
    rows, df = docs(spark)
    pieces = packing.pack_documents(df, weights, window).collect()
    fill = defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 and p.offset + p.length <= window
        fill[p.sequence_id].append(p)
    for s, held in fill.items():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or s == max(fill)
        assert held[0].padded_length == (at if at & (at - 1) == 0 else window)
    assert sorted(fill) == list(range(max(fill) + 1))
    wanted = defaultdict(list)
    for doc_id, text, source, *_ in rows:
        wanted[doc_id, source].append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    got = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        ids = np.frombuffer(p.ids, "<u4").tolist()
        if p.start == 0:
            got[p.doc_id, p.source].append([])
        got[p.doc_id, p.source][-1] += ids
        assert p.doc_tokens >= p.start + p.length and zlib.crc32(p.ids) >= 0
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}


def test_windows_follow_the_shares(spark):
    rng = random.Random(0)
    rows = [(i, "the " * rng.randint(1, 60), "ab"[i % 4 == 0], 0, "") for i in range(4000)]
    pieces = packing.pack_documents(spark.createDataFrame(rows, SCHEMA), {"a": 3.0, "b": 1.0}).collect()
    part, last = defaultdict(int), max(p.sequence_id for p in pieces)
    ends = min(max(p.sequence_id for p in pieces if p.source == s) for s in "ab")
    for p in pieces:
        part[p.sequence_id] += p.length * (p.source == "a")
    shares = [part[s] / 2048 for s in range(min(ends, last))]
    assert len(shares) > 10 and all(abs(x - 0.75) < 0.06 for x in shares)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack_documents(empty).collect() == []
    one = packing.pack_documents(spark.createDataFrame([(1, None, None, 2, "x")], SCHEMA)).collect()
    assert [(p.length, p.doc_tokens, p.padded_length) for p in one] == [(1, 1, 1)]


def test_every_window_holds_every_share(spark):
    """Documents much longer than a source's part of a window; small sources save up their parts."""
    rng = random.Random(6)
    rows = [(i, "the " * rng.randint(200, 1500), f"s{i % 20}", 0, "") for i in range(600)]
    rows += [(600 + i, "the " * 300, f"small{i % 10}", 0, "") for i in range(20)]
    frame = spark.createDataFrame(rows, SCHEMA)
    totals, held = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for p in packing.pack_documents(frame).collect():
        totals[p.source] += p.length
        held[p.sequence_id][p.source] += p.length
    last, whole = max(held), sum(totals.values())
    assert last > 100
    off = [max(abs(held[s][k] / 2048 - n / whole) for k, n in totals.items()) for s in range(last)]
    assert sorted(off)[last // 2] < 0.03 and max(off) < 0.06
