"""The grammar clause by clause, and the fit on labelled tables."""

import math
import random
import zlib

import pytest

from pairsignal.llm import toxicity as tox

SCHEMA = "doc_id long, text string, score string, toxic int"


@pytest.fixture(scope="module")
def grammar():
    return tox.Grammar({"idiot$": 3.0, "lowei": 2.0}, [1.0, 2.0, 0.1, 0.1, 2.0, 0.0], -3.0)


@pytest.mark.parametrize("text,kinds", [
    ("an idiot came", ["plain"]),
    ("You are an IDIOT.", ["aimed"]),
    ("idiot that you are", ["aimed"]),
    ("you there. An idiot", ["plain"]),
    ("he is not an idiot at all", ["negated"]),
    ("not now but maybe then an idiot", ["plain"]),
    ('she said he is an idiot', ["reported"]),
    ('the word "idiot" is old', ["reported"]),
    ('"x" idiot', ["plain"]),
    ("ein loweischaft und loweiß", ["plain", "plain"]),
    ("I will kill you", ["threat"]),
    ("they kill time", []),
    ("he said I will kill you", ["reported"]),
    ("idiots idiotic xidiot alowei", []),
    ("idiot", ["plain"]),
    ("", []),
    (None, []),
])
def test_kinds_of_clauses(grammar, text, kinds):
    assert [k for k, _, _ in grammar.matches(text)] == kinds


def test_composition_equals_the_cascade(grammar):
    """The composed transducer against the four run one after the other."""
    rng = random.Random(0)
    for _ in range(300):
        classes = [rng.randrange(7) for _ in range(rng.randint(0, 12))]
        states, out = list(tox.Composed.START), []
        for i, kind in enumerate([*classes, *[tox.OTHER] * tox.REACH]):
            signal = (kind, frozenset())
            for n, step in enumerate((tox.report_step, tox.negation_step, tox.target_step)):
                states[n], signal = step(states[n], signal)
            states[3], due = tox.outcome_step(states[3], signal)
            if tox.named(due):
                out.append((i - tox.REACH, tox.named(due)))
        assert grammar._composed.read(classes) == out


def test_scores_rank_clauses(grammar):
    plain, aimed, negated = (grammar.score(t) for t in ("an idiot", "you idiot", "not an idiot"))
    assert 0 < grammar.score("") < negated < plain < aimed < 1


def labelled(n=300, seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 60))]
        bad = rng.random() < 0.3
        for _ in range(rng.randint(2, 4) * bad):
            words.insert(rng.randint(0, len(words)), rng.choice(["scum", "clown", "vequ" + word()]))
        rows.append((i, " ".join(words), "x", int(bad)))
    return rows


def test_fit_separates_held_out_rows(spark):
    rows = labelled()
    df = spark.createDataFrame(rows, SCHEMA)
    labels = df.select("doc_id", "toxic")
    got = tox.score_documents(df.drop("toxic"), tox.fit(df, labels)).collect()
    truth = {r[0]: r[3] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
    wrong = [r.doc_id for r in got if r.held_out and r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 2
    # The labels of held-out rows have no say.
    turned = spark.createDataFrame(
        [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, _, _, t in rows], "doc_id long, toxic int"
    )
    again = tox.fit(df, turned)
    first = tox.fit(df, labels)
    assert again.stems == first.stems and again.weights == first.weights and again.bias == first.bias


def test_copies_do_not_teach_their_words(spark):
    rows = labelled(150)
    rows += [(1000 + i, "novelword anotherword thirdword scum clown", "", 1) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    stems = tox.fit(df, df.select("doc_id", "toxic")).stems
    assert "scum$" in stems and not any(s.startswith(("nov", "ano", "thi")) for s in stems)


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, None, "s", 1), (1, "", "s", 0), (None, "a" * 200000, "s", None), (2, "b", "s", None)], SCHEMA)
    labels = df.select("doc_id", "toxic")
    for some, base in ((labels.limit(0), 0.0), (labels.filter("toxic = 1"), None), (labels, None)):
        grammar = tox.fit(df, some)
        got = tox.score_documents(df, grammar).collect()
        assert len(got) == 4 and len({round(r.score, 6) for r in got}) == 1
        assert base is None or got[0].score == base
        assert not any(math.isnan(r.score) for r in got)
    assert tox.score_documents(df.limit(0), tox.Grammar()).collect() == []


def test_one_text_for_each_sampled_id(spark):
    rows = [(i % 3 if i < 90 else i, f"text {i}", "x", i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    for size in (2, 10, 1000):
        got = [r.text for r in tox.sample_of(df, labels, size).collect()]
        assert len(got) <= 2 * size and sum(int(t.split()[1]) < 90 for t in got) <= 3
