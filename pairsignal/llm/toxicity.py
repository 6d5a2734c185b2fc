"""Toxicity by a weighted finite-state grammar over clauses.

A clause (between full stops, exclamation and question marks, semicolons and line ends) is read as
a sequence of word classes: insult, threat, target, negation, report verb, quotation mark, other.
Four small transducers rewrite it one after the other:

* report: an insult or threat behind a report verb, or inside quotation marks, becomes a reported one;
* negation: one within REACH words behind a negation becomes a negated one;
* target: one within REACH words of a target, on either side, becomes an aimed one;
* threat: a threat counts only if it is aimed.

They are composed once into one transducer whose arcs emit what a clause holds, so a text is read
once.  Only clauses with an insult or threat are read at all; an Aho-Corasick automaton finds them.

The insult lexicon is learned: word stems that come in many more toxic than other texts, each with
its log odds as weight, so inflected forms that no labelled text holds are still caught.  A stem's
uses between the same two words count once, so the words of a much-copied toxic text stay out.  What each
kind of match says about a text (a negated insult may say little) is learned as well, by logistic
regression on the sums of the weights per kind; texts without a match share one low score.

Fitting uses a bounded sample of labelled rows: SAMPLE rows of each label, those with the smallest
hash of their id among rows whose crc32(id) mod 3 is not 1.  Scoring covers all rows and whole
texts.  Only the text enters a score.

Defined cases: null and empty texts have no match and get the base score; an id with several labels
counts as toxic if one says so; null labels or ids are left out of the fit; with no labelled row,
or none of one label, there is no stem and every text gets the labels' share (0 without labels).
Rows with equal ids or equal rows each get their score.  Other columns are passed through.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import by_place, stored, table

SAMPLE = 4000  # toxic rows and other rows, each, that a fit uses at most
THRESHOLD = 0.7
REACH = 3
STEM_LENGTHS = range(3, 11)
STEMS = 2000  # at most
CANDIDATES = 20_000  # stems that are counted in the other texts
LEAST_SHARE, LEAST_TEXTS, LEAST_ODDS = 0.01, 3, 2.0

# Closed word classes of the four languages.
TARGETS = "you your yours yourself du dich dir dein deine ihr euch euer tu toi vous ton votre te tú ti usted ustedes vosotros".split()
NEGATIONS = "not no never neither nor without hardly isn't aren't nicht kein keine nie niemals ohne pas jamais sans nunca jamás sin tampoco".split()
REPORTS = "said says say told tells claimed claims wrote writes called quoted sagte sagt schrieb behauptet dit disait écrit affirme dijo dice escribió afirma".split()
THREATS = "kill hurt murder stab shoot strangle töten umbringen erschießen tuer étrangler matar disparar".split()
# End of the fixed values.

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = range(7)
KINDS = ("plain", "aimed", "negated", "reported", "threat")
_CLASS = {w: c for c, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”„«»]")
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[^.!?;\n]+")


# --- transducers ----------------------------------------------------------------------------------
# A signal is (class, marks); marks tell what earlier transducers found.  A transducer maps
# (state, signal) to (state, signal); ``None`` as the signal asks for what is left at the end.

Signal = tuple[int, frozenset]


def report_step(state: tuple[bool, bool], signal: Signal):
    quoted, behind = state
    kind, marks = signal
    if kind == QUOTE:
        return (not quoted, behind), (OTHER, marks)
    if kind == REPORT:
        return (quoted, True), (OTHER, marks)
    if kind in (INSULT, THREAT) and (quoted or behind):
        marks = marks | {"reported"}
    return state, (kind, marks)


def negation_step(state: int, signal: Signal):
    kind, marks = signal
    if kind == NEGATION:
        return REACH, (OTHER, marks)
    if kind in (INSULT, THREAT) and state > 0:
        marks = marks | {"negated"}
    return max(0, state - 1), (kind, marks)


def target_step(state: int, signal: Signal):
    """Marks what follows a target; a target marks what went before by the class TARGET, which the
    last transducer reads."""
    kind, marks = signal
    if kind == TARGET:
        return REACH, signal
    if kind in (INSULT, THREAT) and state > 0:
        marks = marks | {"aimed"}
    return max(0, state - 1), (kind, marks)


def outcome_step(state: tuple, signal: Signal):
    """Holds the last REACH signals until a target can no longer follow; emits kinds of matches."""
    kind, marks = signal
    waiting = state
    if kind == TARGET:
        waiting = tuple(None if w is None else (w[0], w[1] | {"aimed"}) for w in waiting)
    due = waiting[0] if len(waiting) == REACH else None
    waiting = (*waiting[-(REACH - 1):], signal if kind in (INSULT, THREAT) else None)
    return waiting, due


def named(signal: Signal | None) -> str | None:
    if signal is None:
        return None
    kind, marks = signal
    for mark in ("reported", "negated"):
        if mark in marks:
            return mark
    if kind == THREAT:
        return "threat" if "aimed" in marks else None
    return "aimed" if "aimed" in marks else "plain"


class Composed:
    """The four transducers as one; arcs are made when first used and kept."""

    START = ((False, False), 0, 0, (None,) * REACH)

    def __init__(self):
        self.states, self.numbers, self.arcs = [self.START], {self.START: 0}, []

    def _arc(self, number: int, kind: int) -> tuple[int, str | None]:
        a, b, c, d = self.states[number]
        signal: Signal = (kind, frozenset())
        a, signal = report_step(a, signal)
        b, signal = negation_step(b, signal)
        c, signal = target_step(c, signal)
        d, due = outcome_step(d, signal)
        state = (a, b, c, d)
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state], named(due)

    def read(self, classes: list[int]) -> list[tuple[int, str]]:
        """(place, kind) of each match in a clause; REACH other words close it."""
        at, out = 0, []
        for i, kind in enumerate([*classes, *[OTHER] * REACH]):
            while len(self.arcs) <= at:
                self.arcs.append([None] * 7)
            arc = self.arcs[at][kind]
            if arc is None:
                arc = self.arcs[at][kind] = self._arc(at, kind)
            at, due = arc
            if due:
                out.append((i - REACH, due))
        return out


# --- model ----------------------------------------------------------------------------------------

@dataclass
class Grammar:
    """Stems with weights (``word$`` is a whole word), and the weights of the features."""

    stems: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: [0.0] * (len(KINDS) + 1))
    bias: float = -math.inf

    def __post_init__(self):
        self._composed = Composed()
        self._finder = ahocorasick.Automaton()
        for word in [*self.stems, *(f"{w}$" for w in THREATS)]:
            self._finder.add_word(word.removesuffix("$"), word)
        if len(self._finder):
            self._finder.make_automaton()

    def __reduce__(self):
        return Grammar, (self.stems, self.weights, self.bias)

    def _weight(self, word: str) -> float:
        found = self.stems.get(f"{word}$", 0.0)
        for n in STEM_LENGTHS:
            if n > len(word):
                break
            found = max(found, self.stems.get(word[:n], 0.0))
        return found

    def _places(self, text: str) -> list[int]:
        """Where a listed word or stem begins."""
        if not len(self._finder):
            return []
        found, n = [], len(text)
        for end, word in self._finder.iter(text):
            whole = word.endswith("$")
            start = end + 1 - len(word) + whole
            if (start == 0 or not text[start - 1].isalpha()) and (not whole or end + 1 == n or not text[end + 1].isalpha()):
                found.append(start)
        return found

    def matches(self, text: str | None) -> list[tuple[str, str, float]]:
        """(kind, clause, weight) of all matches of a text."""
        text = (text or "").lower()
        places, out = self._places(text), []
        if not places:
            return out
        places, at = sorted(set(places)), 0
        for clause in _CLAUSE.finditer(text):
            while at < len(places) and places[at] < clause.start():
                at += 1
            if at == len(places):
                break
            if places[at] >= clause.end():
                continue
            words = _TOKEN.findall(clause.group())
            weights = [0.0 if len(w) == 1 and not w.isalpha() else self._weight(w) for w in words]
            classes = [
                QUOTE if len(w) == 1 and not w.isalpha() else INSULT if weight else _CLASS.get(w, OTHER)
                for w, weight in zip(words, weights)
            ]
            for i, kind in self._composed.read(classes):
                out.append((kind, clause.group(), weights[i] or 1.0))
        return out

    def features(self, text: str | None) -> list[float]:
        """For each kind the log of 1 and the sum of its weights, and that of the matched clauses."""
        found = self.matches(text)
        if not found:
            return [0.0] * (len(KINDS) + 1)
        sums = Counter()
        for kind, _, weight in found:
            sums[kind] += weight
        return [*(math.log1p(sums[k]) for k in KINDS), math.log1p(len({c for _, c, _ in found}))]

    def score(self, text: str | None) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1 / (1 + math.exp(-z)) if z > -500 else 0.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """text and toxic of at most 2 * size labelled rows outside the held-out third; of several texts
    with one id the one with the smallest hash, equal texts of one label once."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    ).filter(~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    picked = known.filter("toxic = 1").orderBy(order, "doc_id").limit(size).unionByName(
        known.filter("toxic = 0").orderBy(order, "doc_id").limit(size)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most 2 * size rows
    one = found.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("m"))
    return one.select("toxic", "m.text").dropDuplicates()


def _stems_of(text: str | None) -> set[str]:
    out = set()
    for word in set(_WORD.findall((text or "").lower())):
        out.update(word[:n] for n in STEM_LENGTHS if n <= len(word))
        if len(word) > 2:
            out.add(f"{word}$")
    return out


def _texts(batches: Iterator[pa.RecordBatch], at_once: int = 256) -> Iterator[list[str | None]]:
    """The texts of the batches, a few at a time, so that a task holds few of them as objects."""
    for batch in batches:
        for row in range(0, len(batch), at_once):
            yield batch.slice(row, at_once).column("text").to_pylist()


def _stem_counts(only: frozenset | None, most: int = 100_000):
    """Counts of stems; a task gives its own out whenever it holds ``most``, and Spark adds them up."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["stem", "texts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for texts in _texts(batches):
            for text in texts:
                stems = _stems_of(text)
                counts.update(stems if only is None else stems & only)
                if len(counts) >= most:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    return run


def _stem_contexts(only: frozenset):
    """(stem, hash of the words around) for the first place of each stem in a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(batches):
            rows = []
            for text in texts:
                words = ["", *_WORD.findall((text or "").lower()), ""]
                seen = set()
                for before, word, after in zip(words, words[1:], words[2:]):
                    for stem in (_stems_of(word) & only) - seen:
                        seen.add(stem)
                        rows.append((stem, zlib.crc32(f"{before} {after}".encode())))
            stems, around = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(around, pa.int64())], names=["stem", "around"])

    return run


def learn_stems(sample: DataFrame, toxic: int, other: int) -> dict[str, float]:
    """Stems and their log odds, the most telling first; no stem begins with another one."""
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    count = lambda df, only: df.select("text").mapInArrow(_stem_counts(only), "stem string, texts long").groupBy("stem").agg(
        F.sum("texts").alias("texts"))
    common = count(sample.filter("toxic = 1"), None).filter(F.col("texts") >= least)
    listed = frozenset(r.stem for r in common.orderBy(F.desc("texts"), "stem").limit(CANDIDATES).collect())
    # Copies of a text use a word in the same place: only different surroundings count.
    apart = sample.filter("toxic = 1").select("text").mapInArrow(_stem_contexts(listed), "stem string, around long")
    apart = apart.groupBy("stem").agg(F.countDistinct("around").alias("texts")).filter(F.col("texts") >= least)
    ones = {r.stem: r.texts for r in apart.collect()}
    zeros = {r.stem: r.texts for r in count(sample.filter("toxic = 0"), frozenset(ones)).collect()}
    ranked = []
    for stem, n in ones.items():
        odds = math.log((n + 0.5) / (toxic + 1)) - math.log((zeros.get(stem, 0) + 0.5) / (other + 1))
        if odds >= LEAST_ODDS:
            ranked.append((n * odds, len(stem), stem, odds))
    chosen: dict[str, float] = {}
    for _, _, stem, odds in sorted(ranked, reverse=True):
        bare = stem.removesuffix("$")
        if len(chosen) < STEMS and not any(bare.startswith(c.removesuffix("$")) or c.startswith(bare) for c in chosen):
            chosen[stem] = round(odds, 6)
    return chosen


def _regression(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps; the penalty leaves the bias alone."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        size = np.abs(step).max()
        w += step * min(1.0, 4.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Grammar:
    sample = stored(sample_of(docs, labels, size))
    counts = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = counts.get(1, 0), counts.get(0, 0)
    share = toxic / (toxic + other) if toxic + other else 0.0
    if not toxic or not other:
        return Grammar(bias=math.log(share / (1 - share)) if 0 < share < 1 else 30.0 if share else -math.inf)
    grammar = Grammar(learn_stems(sample, toxic, other))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [grammar.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "x"])

    rows = sample.mapInArrow(run, "toxic int, x array<double>").collect()  # at most 2 * size rows
    rows.sort(key=lambda r: (r.toxic, r.x))
    weights, bias = _regression(np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float))
    return Grammar(grammar.stems, [float(w) for w in weights], bias)


def score_column(grammar: Grammar, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([grammar.score(t) for t in texts], dtype="float64")

    return score(text)


def score_documents(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "score", "predicted")]
    scored = docs.select(*kept, held_out(F.col("doc_id")).alias("held_out"), score_column(grammar, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = fit(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs.select("doc_id", "text"), grammar).select("doc_id", "held_out", "score", "predicted")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that are not predicted to be toxic."""
    grammar = fit(docs, table(spark, sf_dir, "labels"))
    apart = by_place(docs)
    kept = apart.withColumn("_score", score_column(grammar, F.col("text"))).filter(F.col("_score") < THRESHOLD)
    return kept.drop("_score").toDF(*docs.columns)
