"""Sampled segmentations against every path of small lattices, and exact round trips."""

import itertools
import math
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from pairsignal.llm import sentence_pieces as sp

SCHEMA = "doc_id long, text string, ids string, sample int"


@pytest.fixture(scope="module")
def pieces():
    return sp.pieces_of(sp.model_path())


def every_path(pieces, text):
    """Ids of each segmentation and its log probability, by enumeration over the library's pieces."""
    library = sentencepiece.SentencePieceProcessor(model_file=sp.model_path())
    whole = "▁" + text.replace("▁", "\ue000").replace(" ", "▁")
    out = {}

    def weight(i):
        rank = -library.get_score(i)
        return -sp.SHARPNESS * math.log(2 + (rank if rank < 1e8 else library.get_piece_size()))

    def walk(at, ids, total):
        if at == len(whole):
            out[ids] = total
            return
        for n in range(1, min(16, len(whole) - at) + 1):
            i = library.piece_to_id(whole[at:at + n])
            if i > 258:
                walk(at + n, (*ids, i), total + weight(i))
        if library.piece_to_id(whole[at]) <= 258:
            data = whole[at].replace("\ue000", "▁").encode()
            more = tuple(library.piece_to_id(f"<0x{b:02X}>") for b in data)
            walk(at + 1, (*ids, *more), total + len(data) * pieces.byte_weight)

    walk(0, (), 0.0)
    norm = math.log(sum(math.exp(v) for v in out.values()))
    return {k: v - norm for k, v in out.items()}


def drawn(pieces, texts, k, seed=1):
    codes, starts = sp._codes(texts)
    seeds = sp.mixed(np.arange(len(texts), dtype=np.uint64) + np.uint64(seed * 10**6))
    chunk, samples, kappa = sp.sampled(pieces, codes, starts, seeds, k)
    ends = np.append(starts[1:], len(codes))
    out = [[] for _ in texts]
    for own, path, logp, perturbed in samples:
        inclusion = sp._log_inclusion(logp, kappa)
        for t in own.tolist():
            edges = path[starts[t]:ends[t]]
            ids = tuple(sp._byte_ids(pieces, chunk, edges[edges >= 0]).tolist())
            out[t].append((ids, logp[t], perturbed[t], inclusion[t]))
    return out


@pytest.mark.parametrize("text", ["on a", "a", " ", "it\nso", "é ▁", "x " * 2, "日本 语\x00"])
def test_paths_and_probabilities(pieces, text):
    want = every_path(pieces, text)
    for found in drawn(pieces, [text] * 50, 4):
        assert len({f[0] for f in found}) == len(found) == min(4, len(want))
        scores = [f[2] for f in found]
        assert scores == sorted(scores, reverse=True)
        for ids, logp, _, inclusion in found:
            assert abs(want[ids] - logp) < 1e-9 and inclusion <= 1e-12
        if len(want) <= 4:
            assert all(f[3] == 0 for f in found)


def test_samples_follow_the_distribution(pieces, monkeypatch):
    """First samples come with their probability, pairs as sampling without replacement says, and
    inclusion scores give unbiased sums."""
    monkeypatch.setattr(sp, "SHARPNESS", 0.15)
    flat = sp.Pieces(sp.model_path())
    want = every_path(flat, "on a")
    n = 20000
    found = drawn(flat, ["on a"] * n, 2)
    order = sorted(want, key=want.get)
    p = {k: math.exp(v) for k, v in want.items()}
    for path in order:
        share = sum(f[0][0] == path for f in found) / n
        assert abs(share - p[path]) < 5 * math.sqrt(p[path] / n) + 1e-3
        mean = sum(math.exp(logp - inc) for f in found for ids, logp, _, inc in f if ids == path) / n
        assert abs(mean - p[path]) < 0.15 * p[path] + 5 * math.sqrt(p[path] / n)
    for a, b in itertools.permutations(order[-3:], 2):
        share = sum(f[0][0] == a and f[1][0] == b for f in found) / n
        say = p[a] * p[b] / (1 - p[a])
        assert abs(share - say) < 5 * math.sqrt(say / n) + 1e-3


def test_samples_depend_on_the_row_alone(pieces):
    rng = random.Random(0)
    texts = ["".join(rng.choice("etaoin shr\n") for _ in range(rng.randint(1, 60))) for _ in range(30)]
    seeds = sp.mixed(np.arange(30, dtype=np.uint64))

    def run(order):
        codes, starts = sp._codes([texts[i] for i in order])
        chunk, samples, _ = sp.sampled(pieces, codes, starts, seeds[order], 3)
        ends = np.append(starts[1:], len(codes))
        return {(order[t], s): (sp._byte_ids(pieces, chunk, path[starts[t]:ends[t]][path[starts[t]:ends[t]] >= 0]).tobytes(), round(logp[t], 9), round(g[t], 9))
                for s, (own, path, logp, g) in enumerate(samples) for t in own.tolist()}

    whole = run(list(range(30)))
    assert run(list(range(29, -1, -1))) == whole
    assert {**run(list(range(7))), **run(list(range(7, 30)))} == whole


TEXTS = [None, "", " ", "  two  blanks ", "line\n\n\ttab", "▁ sign ▁▁", "Ünïcödé 日本語 🎉 \x00\x7f", "a" * 5000, "the end of " * 4000, "x"]


def test_round_trip_and_odd_tables(spark, pieces):
    rows = [(i, t, "x", 9) for i, t in enumerate(TEXTS)] + [(None, "null id", "x", 9), (3, TEXTS[3], "x", 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sp.decode(sp.sample_segmentations(df)).collect()
    assert sorted(map(repr, sp.sample_segmentations(df, decoded=True).collect())) == sorted(map(repr, got))
    for i, text in enumerate(TEXTS):
        own = [r for r in got if r.doc_id == i]
        assert {r.text for r in own} == {text or ""}, i
        assert sorted(r.sample for r in own) == sorted(list(range(1, len({bytes(r.ids) for r in own}) + 1)) * (2 if i == 3 else 1))
        assert all(r.n_pieces == len(r.ids) // 2 for r in own)
    assert {r.text for r in got if r.doc_id is None} == {"null id"}
    assert len([r for r in got if r.doc_id == 1]) == 1
    again = sp.sample_segmentations(df.repartition(3)).select("doc_id", "sample", F.md5("ids"), "perturbed")
    first = sp.sample_segmentations(df).select("doc_id", "sample", F.md5("ids"), "perturbed")
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect()))
    assert sp.sample_segmentations(df.limit(0)).collect() == []


def test_units_met_before_keep_their_lattices(pieces, monkeypatch):
    """A chunk makes lattices of its new units only, and samples are the same where none are kept."""
    made, plain = [], sp._Lattice
    monkeypatch.setattr(sp, "_Lattice", lambda p, codes, starts, lengths: made.append(len(starts)) or plain(p, codes, starts, lengths))
    fresh, texts = sp.Pieces(sp.model_path()), ["the end of the line", "é the line\x00"]
    first = drawn(fresh, texts, 3)
    assert sum(made) == len({"▁the", "▁end", "▁of", "▁line", "▁é"}) + 1  # and the NUL
    assert drawn(fresh, texts, 3) == first and len(made) == 1
    drawn(fresh, ["the new end"], 3)
    assert made[1:] == [1]
    monkeypatch.setattr(sp, "KEPT", 0)
    for _ in range(2):
        assert drawn(fresh, texts, 3) == first
    assert made[-1] == made[0]


def test_sets_out_of_reach_are_left_out(pieces, monkeypatch):
    """Few sets of a long text can be among its best; looking at more of them gives the same samples."""
    seen, plain = [], sp._cut_gumbel
    monkeypatch.setattr(sp, "_cut_gumbel", lambda location, most, u: seen.append(len(u)) or plain(location, most, u))
    texts = ["the end of the line " * 1000, "on a", "the other end " * 30]
    first = drawn(pieces, texts, 3)
    assert sum(seen) < sum(len(f[0]) for found in first for f in found) / 5
    monkeypatch.setattr(sp, "REACH", math.inf)
    for block in (1, 7, 10**6):
        monkeypatch.setattr(sp, "BLOCK", block)
        assert drawn(pieces, texts, 3) == first


def test_units_met_often_outlast_others(pieces, monkeypatch):
    """A full store of lattices keeps the units that most chunks held, and they give the same samples."""
    made, plain = [], sp._Lattice
    monkeypatch.setattr(sp, "_Lattice", lambda p, codes, starts, lengths: made.append(len(starts)) or plain(p, codes, starts, lengths))
    fresh = sp.Pieces(sp.model_path())
    want = drawn(fresh, ["the end of the line é"], 3)
    for i in range(3):
        drawn(fresh, [f"the end of the line é {'abcxyz' * 3}{i}"], 3)
    nodes = fresh.kept.grown["first"].n - 1
    monkeypatch.setattr(sp, "KEPT", 2 * sum(len(w) + 1 for w in ("▁the", "▁end", "▁of", "▁line", "▁é")))
    assert nodes > sp.KEPT
    del made[:]
    assert drawn(fresh, ["the end of the line é"], 3) == want
    assert not made and fresh.kept.grown["first"].n - 1 <= sp.KEPT // 2
    assert len(fresh.kept.numbers) == len(fresh.kept.hashes) == fresh.kept.grown["node0"].n == 5
