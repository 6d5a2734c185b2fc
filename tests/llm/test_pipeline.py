"""The pipeline against its stages' plain versions, on a small corpus."""

import random
from collections import defaultdict

import numpy as np
import pytest
from .test_native import cut_lines
from .test_ngram_join import components
from tokenizers import Tokenizer

import corpus_pipeline
from pairsignal.llm import ngram_join, packing, toxicity
from pairsignal.llm.tables import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=4):
    """Sentences as lines; copies, near copies, shared lines and passages, toxic texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "in"]) for _ in range(rng.randint(1, 4)))
    line = lambda n=12: " ".join(word() for _ in range(n))
    common, passage = line(9), " ".join(word() for _ in range(70))
    texts, toxic = [], []
    for i in range(60):
        lines = [line(rng.randint(6, 20)) for _ in range(rng.randint(2, 6))]
        if i % 6 == 0:
            lines.insert(1, common)
        if i % 10 == 3:
            lines[0] = " ".join([word(), word(), passage, word(), word()])
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                j = rng.randrange(len(lines))
                lines[j] = lines[j] + " " + rng.choice(["scum", "clown"]) + " " + word()
        texts.append("\n".join(lines))
        toxic.append(int(bad))
    texts += [texts[1], None, "", " ".join(texts[2].split()[:-1] + ["changed"]), texts[7].replace("\n", " ")]
    toxic += [0] * 5
    return texts, toxic


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("tables")
    texts, toxic = corpus()
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{where}/documents.parquet")
    labels = [(i, 1, y) for i, y in enumerate(toxic)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return str(where)


def cut_passage(texts, words=50):
    """Texts without runs of at least ``words`` words that an earlier text holds."""
    split = [t.split() for t in texts]
    out, seen = [], set()
    for t, own in zip(texts, split):
        gone = set()
        for i in range(len(own) - words + 1):
            if tuple(own[i:i + words]) in seen:
                gone |= set(range(i, i + words))
        seen |= {tuple(own[i:i + words]) for i in range(len(own) - words + 1)}
        out.append(t if not gone else " ".join(w for i, w in enumerate(own) if i not in gone))
    return out


def test_run_equals_the_plain_stages(spark, folder):
    texts, _ = corpus()
    grammar = toxicity.fit(table(spark, folder, "documents"), table(spark, folder, "labels"))
    assert {"scum$", "clown$"} <= set(grammar.stems)
    rows = [(i, t) for i, t in enumerate(texts) if grammar.score(t) < toxicity.THRESHOLD]
    assert {i for i, _ in rows} == {i for i in range(len(texts)) if i % 5 or i >= 60}
    cut = cut_lines([t for _, t in rows])
    rows = [(i, c) for (i, t), c in zip(rows, cut) if c is not None or t is None]
    _, roots = components([t for _, t in rows], ngram_join.STAGE_WIDTH, ngram_join.STAGE_PERCENT)
    rows = [r for k, r in enumerate(rows) if roots[k] == k]
    rows = [(i, c) for (i, _), c in zip(rows, cut_passage([t or "" for _, t in rows]))]

    library = Tokenizer.from_file(packing.tokenizer_path())
    want = {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in rows}
    got, fill = defaultdict(list), defaultdict(int)
    for p in sorted(corpus_pipeline.run(spark, folder).collect(), key=lambda p: (p.doc_id, p.start)):
        assert p.start == len(got[p.doc_id]) and p.doc_tokens == len(want[p.doc_id])
        got[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
        fill[p.sequence_id] += p.length
    assert got == want
    assert all(n == 2048 for s, n in fill.items() if s < max(fill))


def test_stages_keep_the_columns(spark, folder):
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema == docs.schema or [f.simpleString() for f in out.schema] == [f.simpleString() for f in docs.schema], name
        assert stage(spark, docs.limit(0), folder).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).collect() == []


NAMES = ("n_lines", "n_deleted", "longest_run", "cut_words", "_did", "_dkey", "_spans", "_gone", "_score", "_t1", "_row", "_all")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_named_like_their_own(spark, folder, name, stage):
    passage = " ".join(f"word{i}" for i in range(70))
    rows = [(1, f"one two\n{passage}", *NAMES), (2, f"{passage}\nthree", *NAMES), (3, "four five six", *NAMES)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *NAMES])
    out = stage(spark, docs, folder).collect()
    assert out and all(r[c] == c for r in out for c in NAMES)
