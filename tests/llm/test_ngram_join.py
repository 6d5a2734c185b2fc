"""N-gram Jaccard join against all pairs."""

import random
import re

import pytest

from pairsignal.llm import ngram_join

SCHEMA = "doc_id long, text string, node int, n string"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids, texts)], SCHEMA)


def shingle_set(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def components(texts, width, percent):
    sets = [shingle_set(t, width) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 99))
    passage = [word() for _ in range(30)]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "One  two", "  x", "É", "é", "a " * 40000]
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 5, 12, 40, 120]))]
        if rng.random() < 0.5:
            base[len(base) // 2:len(base) // 2] = passage
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(rng.choice([" ", "\n"]).join(copy).title())
        base = base + [word() for _ in range(rng.randint(0, 4))]
        texts.append(" ".join(base))
    # A chain of slowly drifting copies, and many documents that are mostly one passage.
    drift = [word() for _ in range(100)]
    for _ in range(12):
        drift[rng.randrange(100)] = word()
        texts.append(" ".join(drift))
    texts += [" ".join([word()] + passage + [word() for _ in range(k)]) for k in range(4) for _ in range(6)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,width,percent", [(0, 4, 85), (1, 5, 80), (2, 4, 50)])
def test_components_against_all_pairs(spark, seed, width, percent):
    texts = corpus(seed)
    sizes, roots = components(texts, width, percent)
    rows = ngram_join.linked_documents(frame(spark, texts), width, percent).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    assert [r.n for r in sorted(rows, key=lambda r: r.doc_id)] == sizes
    least = {}
    for r in rows:
        least[r.root] = min(least.get(r.root, r.doc_id), r.doc_id)
    assert [least[r.root] for r in sorted(rows, key=lambda r: r.doc_id)] == roots


def test_odd_tables(spark):
    assert ngram_join.linked_documents(frame(spark, [])).collect() == []
    ids = [5, 5, None, 3, 3, 9]
    texts = ["a b c d e", "a b c d e", "a b c d e", "", "", "A B C D E"]
    rows = ngram_join.linked_documents(frame(spark, texts, ids)).collect()
    assert len(rows) == 6 and len({r.root for r in rows}) == 3
    kept = ngram_join.stage(spark, frame(spark, texts, ids), "")
    assert kept.columns == ["doc_id", "text", "node", "n"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, ""), (3, ""), (5, "a b c d e")]


def test_sets_are_stored_before_their_prefixes_are_made(spark, monkeypatch):
    """Prefixes read the sets more than once; a join below would shuffle them each time."""
    plans, plain = [], ngram_join._prefixes

    def noted(sets, percent):
        plans.append(sets._jdf.queryExecution().executedPlan().toString())
        return plain(sets, percent)

    monkeypatch.setattr(ngram_join, "_prefixes", noted)
    assert ngram_join.linked_documents(frame(spark, corpus(3))).count() == len(corpus(3))
    assert len(plans) == 2 and not any("Join" in p or "Exchange" in p for p in plans)
