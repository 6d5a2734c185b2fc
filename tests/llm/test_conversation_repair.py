"""Conversation repair against a plain search over all repairs and a row-by-row reading."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from pairsignal.llm import conversation_repair as repair

sys.setrecursionlimit(20_000)
SCHEMA = "conv_id long, turn long, role string, text string, pos int, said string, letter string"


def cheapest(rows):
    """(cost, audit, repaired) by dynamic programming from the end over (row, turns made so far)."""
    pattern = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def least(i, before, inserted):
        ways = []
        if i == len(rows) and before in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 2:
            for c, name in (("u", "user"), ("a", "assistant")):
                if c in pattern[before]:
                    rest = least(i, c, inserted + 1)
                    if rest:
                        ways.append((3 + rest[0], "I" + rest[1], (f"{name}:",) + rest[2]))
        if i < len(rows):
            role, text, fault = rows[i]
            rest = least(i + 1, before, 0)
            if rest:
                ways.append((4 + rest[0], "D" + rest[1], rest[2]))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if role[:1] and role[:1] in pattern[before] and role[:1] in "sua":
                    rest = least(i + 1, role[:1], 0)
                    if rest:
                        ways.append((extra + rest[0], "K" + rest[1], (f"{role}:{text}",) + rest[2]))
                for c, name in (("u", "user"), ("a", "assistant")):
                    if c in pattern[before]:
                        rest = least(i + 1, c, 0)
                        if rest:
                            ways.append((3 + extra + rest[0], "R" + rest[1], (f"{name}:{text}",) + rest[2]))
        return min(ways) if ways else None

    return least(0, "", 0)


def plain(table):
    """The whole contract, one conversation after the other."""
    said = lambda x: " " if x is None else str(x)
    after = {}
    for conv_id, turn, role, text in table:
        own = after.setdefault(conv_id, [])
        what = zlib.crc32(f"{said(conv_id)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if what == 1:
            text = ""
        if what == 2:
            text = re.sub(r"[.!?]", "", text)
        if what == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    out = {}
    for conv_id, rows in after.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in rows:
            if not re.search(r"[^\x20\x09-\x0D]", text):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "" if text.rstrip(" \t\n\v\f\r")[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
        turns = [t for t, _, _ in rows if t is not None]
        initials = [r[:1] for _, r, _ in rows]
        cost, audit, made = cheapest(tuple((r, t, f) for (_, r, t), f in zip(rows, faults)))
        out[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest(),
        )
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversations(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for conv_id in range(n):
        usual = rng.random() < 0.5
        for turn in range(rng.choice([1, 1, 2, 4, 6, 9])):
            role = ("user", "assistant")[turn % 2] if usual else rng.choice(
                ["system", "user", "assistant", "tool", "", None, "s", "umpire"])
            text = rng.choice(["Yes.", "No!", "cut off", "  ", "", None, "é?", "one\ntwo. ", "a.b", f"turn {turn}."])
            rows.append((conv_id, None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 2]), role, text))
    rows += rows[5:25] + [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (n, None, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", "y") for r in rows], SCHEMA)


def answers(df):
    return {r["conv_id"]: tuple(r[c] for c in NAMES) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_the_plain_reading(spark, seed):
    rows = conversations(seed)
    got = answers(repair.repair_conversations(repair.damaged(frame(spark, rows)), of=frame(spark, rows)))
    assert got == plain(rows)


def test_long_conversations_are_linked_from_units(spark):
    """Units of three rows give what a search over the whole conversation gives."""
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", " ", f"{t}!"]))
            for c in range(12) for t in range(rng.choice([3, 7, 40]))]
    rows += [(99, t, ("user", "assistant")[t % 2], f"{t}." if t % 7 else "x") for t in range(300)]
    df = frame(spark, rows)
    want = plain(rows)
    assert answers(repair.repair_conversations(repair.damaged(df), of=df, block=3)) == want
    assert answers(repair.repair_conversations(repair.damaged(df), of=df)) == want


def test_every_short_row_of_letters():
    def searched(letters):
        rows = tuple(({"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "tool"), "t",
                      "blank" if c == "x" else "truncated" if c.isupper() else "") for c in letters)
        return cheapest(rows)[:2]

    for n in range(5):
        for letters in itertools.product("xsuaoUA", repeat=n):
            assert repair.least_repair("".join(letters)) == searched(letters), letters


def test_repaired_turns_give_the_digest(spark):
    df = frame(spark, conversations(4))
    marked = repair.marked_rows(repair.damaged(df))
    texts = {}
    for r in sorted(repair.repaired_turns(marked).collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["place"])):
        texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert r["edit"] in "KRI"
    digests = answers(repair.repair_conversations(repair.damaged(df)))
    for conv_id, row in digests.items():
        assert hashlib.sha256("\n".join(texts.get(conv_id, [])).encode()).hexdigest() == row[-1]


def test_empty_table_and_long_texts(spark):
    empty = frame(spark, [])
    assert repair.repair_conversations(repair.damaged(empty), of=empty).count() == 0
    rows = [(2, 1, "user", "word " * 200_000 + "."), (2, 2, "assistant", "ok" * 500_000)]
    got = answers(repair.repair_conversations(frame(spark, rows), of=frame(spark, rows)))
    assert got[2][:7] == (0, 0, 0, 1, 0, 3, "KK")
