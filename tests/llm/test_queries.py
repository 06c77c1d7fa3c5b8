"""Each registered query over whole tables, against SQL or a plain computation in Python."""

import binascii
import hashlib
import math
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import oracle
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from silverloom.llm import bpe, queries

SMALL = "/root/testdata/sf0.001"
LARGE = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_all_are_registered():
    names = {f"op{n}_" for n in range(1, 14)}
    assert {q.split("_")[0] + "_" for q in queries.QUERIES} == names
    assert {*queries.QUERIES, "pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(queries.SQL))
def test_against_sql(spark, name):
    con = oracle.connect(SMALL)
    assert oracle.compare(queries.QUERIES[name](spark, SMALL), con, queries.SQL[name]) is None


def brute_join(rows, size=5):
    sets = []
    for key, text in rows:
        words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        few = [tuple(words)] if words else []
        runs = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        sets.append((key, frozenset(runs or few)))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            common = len(a & b)
            if a and b and 100 * common >= 80 * (len(a) + len(b) - common):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), key), key)
    return sorted((key, len(s), least[root(i)]) for i, (key, s) in enumerate(sets))


def test_ngram_join(spark, texts):
    got = queries.QUERIES["op1_ngram_jaccard"](spark, SMALL)
    assert sorted(map(tuple, got.collect())) == brute_join(sorted(texts.items()))


def test_token_ids(spark, texts):
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, wanted = 0, []
    for key in sorted(texts):
        ids = [*encoder.encode(texts[key], add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        wanted.append((key, start, len(ids), crc))
        start += len(ids)
    got = queries.QUERIES["op2_token_ids"](spark, SMALL)
    assert sorted(map(tuple, got.collect())) == wanted


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd = [int(d) for d in digits[::-1][::2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[::-1][1::2]]
    return (sum(odd) + sum(even)) % 10 == 0


def base_spans(text):
    spans = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                spans.append((m.start(), place, m.end(), kind))
    return sorted(spans)


def test_personal_data(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = Counter()
    for row in queries.QUERIES["op3_pii"](spark, LARGE).collect():
        spans = base_spans(texts[row.doc_id])
        joined = ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in spans)
        counts = Counter(s[3] for s in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [counts[k] for k in PATTERNS]
        assert set(filter(None, joined.split(","))) <= set(row.spans.split(","))
        found += counts
    assert len(found) == 4


def test_nearest_recall_and_scores(spark):
    rows = spark.read.parquet(f"{LARGE}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], np.float64)
    got = {}
    for r in queries.QUERIES["op4_nearest"](spark, LARGE).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(ids[ids % 100 == 0].tolist())
    hits = 0
    for query, answers in got.items():
        far = np.sqrt(((vectors - vectors[ids == query]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, far)) if ids[i] != query][:10]
        answers.sort()
        assert [a[0] for a in answers] == list(range(1, 11))
        assert [a[1:] for a in answers] == sorted((a[1:] for a in answers), key=lambda a: a[::-1])
        for _, who, score in answers:
            assert math.isclose(score, far[ids == who][0], rel_tol=1e-12)
        hits += len({ids[i] for i in order} & {a[1] for a in answers})
    assert hits >= 0.9 * 10 * len(got)


def test_mixture(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").collect()
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs}
    source = {r.doc_id: r.source for r in docs}
    totals = Counter()
    for key, n in size.items():
        totals[source[key]] += n
    names = sorted(totals)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(totals.values()) - sum(3 * totals[s] for s in capped)
        level = left / sum(weight[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and weight[s] * level > 3 * totals[s]}
        if not more:
            break
        capped |= more
    taken = Counter()
    rows = queries.QUERIES["op6_mixing"](spark, LARGE).collect()
    for r in rows:
        s = source[r.doc_id]
        target = 3 * totals[s] if s in capped else weight[s] * level
        assert (r.size, r.source_size) == (size[r.doc_id], totals[s])
        assert math.isclose(r.target, target, rel_tol=1e-12)
        assert r.size == 0 or r.taken % r.size == 0
        assert r.taken <= 3 * r.size
        taken[s] += r.taken
    assert len(rows) == len(docs)
    for s in names:
        target = 3 * totals[s] if s in capped else weight[s] * level
        assert abs(taken[s] - target) <= 0.01 * target
    again = queries.QUERIES["op6_mixing"](spark, LARGE).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_byte_bpe(spark, texts):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    for row in queries.QUERIES["op7_byte_bpe"](spark, SMALL).collect():
        ids = np.array(library.encode_ordinary(texts[row.doc_id]), "<u4")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        text = texts[row.doc_id].encode()
        assert row.decoded_sha256 == hashlib.sha256(text).hexdigest()


def test_shards(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{LARGE}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_sharding"](spark, LARGE).collect()
    slots = {}
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 1, binascii.crc32(data), "key")
        assert r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == len(docs) and set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r.grown_shard == 8 for r in rows)
    assert len(rows) / 18 < moved < len(rows) / 5


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    kept = steps["quality rules"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    alone = steps["n-gram jaccard join"](spark, kept, SMALL)
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    want = [key for key, _, least in brute_join(rows) if key == least]
    assert sorted(r.doc_id for r in alone.collect()) == want
    clean = steps["pii"](spark, alone, SMALL)
    for r in clean.collect():
        assert not re.search(PATTERNS["email"], r.text) and r.n_chars == len(r.text)
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in out} <= set(want)
    assert all(r.restored for r in out)
    repeats = Counter(r.doc_id for r in out)
    assert max(repeats.values()) <= 3
