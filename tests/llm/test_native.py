"""Sharding, URL filters and line dedup against brute force on small tables."""

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pairsignal.llm import line_dedup, sharding, url_filters
from pairsignal.llm.tables import literal_rows

DOCS = "doc_id long, text string, shard string, n_lines int"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts)], DOCS)


# --- sharding ---------------------------------------------------------------------------------

def least_capacity(sizes, shards):
    """Smallest largest part of a contiguous partition, by trying every sum."""
    sums = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})
    for c in sums:
        used, room = 0, 0
        for s in sizes:
            if s > room:
                used, room = used + 1, c
                if s > c:
                    used = shards + 1
                    break
            room -= s
        if used <= shards:
            return c
    return 0


@pytest.mark.parametrize("seed,shards", [(0, 8), (1, 3), (2, 8), (3, 1)])
def test_shards_are_minimax_over_whole_groups(spark, seed, shards):
    rng = random.Random(seed)
    texts = ["x" * rng.randint(0, 40) + str(rng.randint(0, 30)) for _ in range(60)]
    if seed == 2:
        texts += ["hot" * 20] * 40
    texts += [None, None, "", ""]
    got = sharding.shard_documents(frame(spark, texts), shards).collect()
    assert len(got) == len(texts)
    groups, where = defaultdict(int), defaultdict(set)
    for r in got:
        text = texts[r.doc_id]
        assert r.size == len((text or "").encode()) + 1
        assert r.text_crc32 == (None if text is None else zlib.crc32(text.encode()))
        groups[r.key] += r.size
        where[r.key].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    order = sorted(groups)
    assert [min(where[k]) for k in order] == sorted(min(where[k]) for k in order)  # contiguous
    loads = defaultdict(int)
    for k in order:
        loads[min(where[k])] += groups[k]
    assert max(loads.values()) == least_capacity([groups[k] for k in order], shards)
    for s in range(shards):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_shards_of_odd_tables(spark):
    empty = sharding.shard_documents(frame(spark, [])).collect()
    assert empty == []
    same = sharding.shard_documents(frame(spark, ["a"] * 9, [1, 1, 1, None, None, 2, 3, 4, 5])).collect()
    assert sorted(r.slot for r in same) == list(range(9)) and len({r.shard for r in same}) == 1


# --- URL filters ------------------------------------------------------------------------------

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("b.org", "", "block"),
         ("b.org", "/a", "allow"), ("B.org", "/a/b", "block"), (None, "/", "block"), ("", "/", "block")]
URLS = [
    "http://x.example.net/en/1?q#f", "https://EXAMPLE.net/EN/1", "http://example.net", "http://n.net?x=/en/",
    "ftp://a.b.org", "ftp://b.org/ab", "ftp://b.org/a/bc#/", "ftp://ab.org/a", "nothing", None, "", "://net/",
    "http://a://net/x", "http://..net/", "http://net./", "HTTP://Å.NET/", "http://net\n/x", "x" * 5000 + "://b.org/" + "a" * 5000,
]


def verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        (len(h) + len(p), h.lower() + p, v) for h, p, v in RULES
        if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    _, rule, said = max(fits, default=(0, None, "allow"))
    return host, path, rule, said


def test_url_verdicts(spark):
    rules = literal_rows(spark, RULES, "host string,path string,verdict string")
    rows = [(i, u, "h", "v") for i, u in enumerate(URLS)] + [(3, URLS[3], "h", "v")] * 2 + [(None, URLS[0], "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = url_filters.filter_urls(pages, rules).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == verdict(r.url), r.url
    none = url_filters.filter_urls(pages, rules.limit(0)).collect()
    assert len(none) == len(rows) and {r.verdict for r in none} == {"allow"}
    assert url_filters.filter_urls(pages.limit(0), rules).collect() == []


# --- line dedup -------------------------------------------------------------------------------

def cut_lines(texts, min_words=line_dedup.MIN_WORDS):
    """Lines that stay, by looking at every line and pair of lines in document order."""
    rows = [[(i, s) for i, s in enumerate((t or "").split("\n")) if s.strip()] for t in texts]
    seen, out = set(), []
    for d, row in enumerate(rows):
        gone = set()
        for k, (i, s) in enumerate(row):
            if s in seen and len(s.split()) >= min_words:
                gone.add(i)
            seen.add(s)
            if k + 1 < len(row):
                if (s, row[k + 1][1]) in seen:
                    gone |= {i, row[k + 1][0]}
                seen.add((s, row[k + 1][1]))
        if texts[d] is None or not gone:
            out.append(texts[d])
        elif len(gone) == len(row):
            out.append(None)
        else:
            out.append("\n".join(s for i, s in enumerate(texts[d].split("\n")) if i not in gone))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_line_runs_against_brute_force(spark, seed):
    rng = random.Random(seed)
    words = ["a b c d e", "a", "f g h i j k", "b c", "", "  ", "long line of many words", "z"]
    texts = ["\n".join(rng.choice(words) + rng.choice(["", "", str(rng.randint(0, 9))]) for _ in range(rng.randint(0, 14)))
             for _ in range(40)]
    texts += [texts[3], texts[7], None, "", "\n\n", "a\n" * 100, "\n".join(map(str, range(50))), "q\n" + "\n".join(map(str, range(50)))]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, texts)).collect()}
    want = cut_lines(texts)
    assert [got[i].text for i in range(len(texts))] == want
    assert got[len(texts) - 1].longest_run == 50 and got[0].shard == "x"


def test_line_run_lengths_and_originals(spark):
    run = [f"line {i}" for i in range(11)]
    texts = ["\n".join(["u"] + run), "\n".join(["v", "w"] + run + ["x"]), "\n".join(run[4:7])]
    _, covers = line_dedup.repeated_runs(frame(spark, texts))
    runs = sorted((r._did, r.start, r.length, r.original.fd, r.original.fl) for r in line_dedup.maximal_runs(covers).collect())
    assert runs == [(1, 2, 11, 0, 1), (2, 0, 3, 0, 5)]


def test_line_dedup_of_odd_tables(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []
    alone = line_dedup.dedup_lines(frame(spark, ["a b c d e f", None], [7, None])).collect()
    assert sorted((r.text or "") for r in alone) == ["", "a b c d e f"]
    twice = line_dedup.dedup_lines(frame(spark, ["a b c d e f"] * 3, [1, 1, 2])).collect()
    assert sorted((r.doc_id, r.text) for r in twice if r.doc_id == 1) == [(1, "a b c d e f")] * 2
    assert [r.text for r in twice if r.doc_id == 2] == [None]
    one = line_dedup.stage(spark, frame(spark, ["a b c d e f"] * 2), "")
    assert one.columns == ["doc_id", "text", "shard", "n_lines"] and one.count() == 1


def test_native_plans_hold_no_python(spark):
    docs = frame(spark, ["a b c d e f\nx", "a b c d e f\ny"])
    pages = spark.createDataFrame([(1, "http://a.net/", 1)], "page_id long, url string, x int")
    for df in (
        sharding.shard_documents(docs), line_dedup.dedup_lines(docs),
        url_filters.filter_urls(pages, literal_rows(spark, RULES, "host string,path string,verdict string")),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
    assert docs.select(F.count("*")).first()[0] == 2


def test_single_lines_without_blanks(spark):
    lines = ["这是一个在许多网页上重复出现的长句子。", "すべての権利は著作権者に帰属します。", "สงวนลิขสิทธิ์ตามกฎหมายทุกประการ", "短句子", "two words"]
    texts = [f"start {d}{k}\n{s}\nend {d}{k}" for k, s in enumerate(lines) for d in "ab"]
    got = {r.doc_id: r.n_deleted for r in line_dedup.dedup_lines(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [0, 1, 0, 1, 0, 1, 0, 0, 0, 0]
