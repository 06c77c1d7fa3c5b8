"""Periodic runs against a comparison of all places; extensions of the grammar; edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from silverloom.llm import runs
from silverloom.llm.runs import RunLengthGrammar, collapse_runs, find_runs, runs_of

DOC = "doc_id long, text string"
SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def every_run(words, exponent=4, shortest=6):
    found = {}
    for period in range(1, len(words) // exponent + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            if j > i and j + period - i >= max(shortest, exponent * period):
                found.setdefault((i, j + period), period)
            i = max(j, i) + 1
    return sorted((i, j - i, p) for (i, j), p in found.items())


def periodic(rng, n, among):
    words = [rng.randrange(among) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a, p = rng.randrange(n or 1), rng.randint(1, 9)
        for i in range(a, min(n, a + rng.randrange(80))):
            words[i] = words[a + (i - a) % p]
    return words


def test_grammar_extensions():
    rng = random.Random(2)
    for _ in range(120):
        words = periodic(rng, rng.randint(2, 150), rng.choice([1, 2, 3, 30]))
        grammar = RunLengthGrammar(np.array(words))
        for _ in range(40):
            x, y = sorted(rng.sample(range(len(words)), 2))
            ahead = back = 0
            while y + ahead < len(words) and words[x + ahead] == words[y + ahead]:
                ahead += 1
            while x - back > 0 and words[x - back - 1] == words[y - back - 1]:
                back += 1
            assert (grammar.forward(x, y), grammar.backward(x, y)) == (ahead, back)


@pytest.mark.parametrize("exponent,shortest", [(4, 6), (2, 1), (3, 10)])
def test_runs_against_all_places(exponent, shortest):
    rng = random.Random(exponent)
    for _ in range(400):
        words = periodic(rng, rng.randrange(130), rng.choice([1, 2, 2, 3, 6, 40]))
        got = find_runs(np.array(words, np.int64), len(words), exponent, shortest)
        assert got == every_run(words, exponent, shortest), words


def test_texts_are_kept_apart():
    texts = [b"a a a", b"a a a a", b"", b"x y " * 4, b"x y x y x y x"]
    got = [r for _, r, _ in runs_of(texts)]
    assert got == [[], [], [], [(0, 8, 2)], []]


def collapsed(words, found):
    gone = {i for start, length, p in found for i in range(start + p, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_operator_edges(spark):
    phrase = "the same eight words over and over again"
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t"),
        (4, f"start {' '.join([phrase] * 5)} end"),
        (4, f"start {' '.join([phrase] * 5)} end"),
        (None, "ha ha " * 6),
        (6, "a\vb\fa\rb a b\na b c"),
        (7, "z " * 120_000 + " ".join(f"w{i % 20_000}" for i in range(100_000))),
    ]
    frame = spark.createDataFrame(rows, DOC).selectExpr("*", "'x' AS runs", "0 AS collapsed", "1 AS `n.w`")
    got = collapse_runs(frame)
    assert got.columns == ["doc_id", "text", "n.w", "n_words", "runs", "collapsed"]
    by_id = {r.doc_id: r for r in got.collect()}
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        r = by_id[doc_id]
        want = [(0, 120_000, 1), (120_000, 100_000, 20_000)] if doc_id == 7 else every_run(words)
        assert [tuple(x) for x in r.runs] == want
        assert r.n_words == len(words) and r.collapsed == collapsed(words, want)
    assert got.count() == len(rows)
    assert collapse_runs(frame.limit(0)).collect() == []


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0 and n:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = every_run(words)
    best = (None,) * 4
    if found:
        start, length, period = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (start, length, period, 1000 * length // period)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return (doc_id, len(found), *best, digest(listed), digest(collapsed(words, found)))


def test_query_on_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = runs.op13_periodic_runs(spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(plain_row(*r) for r in rows)
    assert any(r.n_runs for r in got)


def test_query_on_nulls_and_planted_texts(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(None, "a " * 9), (None, None), (5, None), (6, ""), (7, "x"), (7, "x")]
    spark.createDataFrame(rows, DOC).write.parquet(str(tmp_path / "documents.parquet"))
    got = runs.op13_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted((plain_row(*r) for r in rows), key=key)
