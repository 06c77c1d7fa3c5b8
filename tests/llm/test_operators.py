"""Edge cases of the operators: nulls, empty and long texts, ties, repeats, clashing columns."""

import itertools
import math
import random
import re
import time
import tracemalloc

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_queries import brute_join
from tokenizers import Tokenizer, models, pre_tokenizers

from silverloom.llm import ann, bpe, graph, jaccard, lines, mixing, pii, shards, token_counts
from silverloom.llm import token_ids, urls

DOC = "doc_id long, text string"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def words(seed, n, among=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(among)}" for _ in range(n)]


# N-gram Jaccard join


def corpus():
    """Copies, chains of near copies, a large cluster, texts that share one passage, edges."""
    rng, rows = random.Random(4), []
    base = words(1, 120, 9000)
    for i in range(90):  # a cluster larger than a leaf, its members up to twice the radius apart
        text = list(base)
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append(" ".join(text))
    passage = words(2, 60, 9000)
    rows += [" ".join(passage + words(100 + i, 40, 9000)) for i in range(100)]
    chain = words(3, 150, 9000)
    for i in range(12):
        rows.append(" ".join(chain))
        chain[i * 10] = f"y{i}"
        chain[i * 10 + 5] = f"z{i}"
    rows += ["A b\tC", "a b c", "a b", "", " \n ", None, "a b c d e", "A B C D E"] * 2
    rows += [" ".join(words(7, 20_000)), " ".join(words(7, 20_000)) + " tail"]
    return list(enumerate(rows))


def test_join_finds_every_class(spark, monkeypatch):
    rows = corpus()
    random.Random(1).shuffle(rows)
    want = brute_join(sorted(rows))
    for leaf in (jaccard.LEAF, 4):
        monkeypatch.setattr(jaccard, "LEAF", leaf)
        got = jaccard.ngram_join(spark.createDataFrame(rows, DOC).repartition(6))
        assert sorted(map(tuple, got.collect())) == want


def test_join_by_blocks_of_leaves_alone(spark, monkeypatch):
    """No star before, so every link is found between blocks of members and of guests."""
    rows = corpus()
    monkeypatch.setattr(jaccard, "STAR_LEVELS", 0)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 20)
    got = jaccard.ngram_join(spark.createDataFrame(rows, DOC).repartition(6))
    assert sorted(map(tuple, got.collect())) == brute_join(rows)


def test_join_bounds_pairs_in_proportion_to_near_copies(spark, monkeypatch):
    rng, base, write, counts = random.Random(5), words(1, 120, 9000), jaccard.stored, []

    def stored(df, label, path=None):
        out = write(df, label, path)
        counts[-1] += out.count() if label == "join-bounds" else 0
        return out

    monkeypatch.setattr(jaccard, "stored", stored)
    rows = []
    for i in range(800):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    for n in (400, 800):
        counts.append(0)
        jaccard.ngram_join(spark.createDataFrame(rows[:n], DOC).repartition(4))
    assert counts[1] <= 2.5 * counts[0] and counts[1] <= 16 * 800


def test_groups_that_span_batches():
    keys = np.repeat([3, 5, 6, 9], [1, 7, 2, 1])
    table = pa.table({"k": keys, "v": np.arange(len(keys))})
    for size in (1, 2, 3, 20):
        found = []
        for rows, starts in jaccard._groups(iter(table.to_batches(size)), ["k"]):
            parts = zip(starts[:-1].tolist(), starts[1:].tolist())
            found += [rows.slice(a, b - a).column("v").to_pylist() for a, b in parts]
        assert found == [[0], [1, 2, 3, 4, 5, 6, 7], [8, 9], [10]]


@pytest.mark.parametrize("sift", [32, 1])
def test_members_without_a_possible_partner_leave_their_regions(spark, monkeypatch, sift):
    rows, write, stored = [], jaccard.stored, {}
    for i in range(20):  # rare shingles in common, but sizes too far apart
        short, long = words(1000 + i, 100, 10**6), words(2000 + i, 300, 10**6)
        rows += [(2 * i, " ".join(short)), (2 * i + 1, " ".join(short + long))]
        rows.append((100 + i, " ".join(long)))
    rows += [(40, rows[0][1]), (41, rows[0][1] + " end")]

    def count(df, label, path=None):
        out = write(df, label, path)
        stored.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", count)
    monkeypatch.setattr(jaccard, "SIFT", sift)
    got = jaccard.ngram_join(spark.createDataFrame(rows, DOC).repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in got} == {
        i: 0 if i in (40, 41) else i for i, _ in rows
    }
    assert (max(stored["join-slices"]) == 2) == (sift == 32)


def test_join_at_other_thresholds_and_without_rows(spark):
    rows = corpus()[:120]
    got = jaccard.ngram_join(spark.createDataFrame(rows, DOC), share=100, parts=100)
    exact = {}
    for key, _, least in sorted(map(tuple, got.collect())):
        exact[key] = least
    assert all(rows[k][1] == rows[v][1] for k, v in exact.items())
    empty = jaccard.ngram_join(spark.createDataFrame([], DOC))
    assert empty.columns == ["doc_id", "n_shingles", "component_id"] and empty.isEmpty()
    with pytest.raises(ValueError):
        jaccard.ngram_join(empty, share=0)


def test_join_without_ids_and_with_repeated_rows(spark):
    rows = [(None, "a b c"), (3, "a b c"), (3, "a b c"), (5, "A B C"), (None, None)]
    got = jaccard.ngram_join(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(None, 1, None), (3, 1, 3), (3, 1, 3), (5, 1, 3), (None, 0, None)], key=repr
    )
    clash = spark.createDataFrame(rows, DOC).withColumns({"n": F.lit(1), "node": F.lit("x")})
    kept = jaccard.keep_one(clash)
    assert kept.columns == clash.columns
    assert sorted((r.doc_id is None, r.text or "") for r in kept.collect()) == [
        (False, "a b c"), (False, "a b c"), (True, ""), (True, "a b c"),
    ]


def test_join_lists_every_link(spark, monkeypatch):
    rows = corpus() + [(None, "a b c"), (3, "a b c")]
    sets = []
    for _, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        runs = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
        sets.append(frozenset(runs or ([tuple(found)] if found else [])))
    ids = [key for key, _ in rows]
    least, links, pairs = {}, [0] * len(rows), set()
    for key, s in zip(ids, sets):
        if key is not None:
            least[s] = min(least.get(s, key), key)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and None not in (ids[i], ids[j]) and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                if a != b:
                    pairs.add(tuple(sorted((least[a], least[b]))))
    df = spark.createDataFrame(rows, DOC).repartition(6)
    for block in (jaccard.BLOCK_SETS, 20):
        monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
        got = sorted(map(tuple, jaccard.ngram_links(df).collect()), key=repr)
        assert got == sorted(zip(ids, links), key=repr)
        assert sorted(map(tuple, jaccard.ngram_pairs(df).collect())) == sorted(pairs)
    assert jaccard.ngram_links(df.where("doc_id > 9999")).isEmpty()


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(300)] + [(7, 7)]
    random.Random(2).shuffle(links)
    got = dict(map(tuple, graph.components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert got == {i: 0 for i in range(51)} | {100: 100} | {200 + i: 100 for i in range(300)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).isEmpty()


# Token ids


@pytest.mark.parametrize("bits", [1, 8])
def test_blocks_round_trip(bits):
    rng = np.random.default_rng(0)
    for n in (1, 2, 9, 1000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint32)
        assert (token_ids.unpack_block(token_ids.pack_block(ids, bits)) == ids).all()
    with pytest.raises(ValueError):
        token_ids.unpack_block(b"nothing")


def test_documents_cut_by_blocks(spark, tmp_path):
    rows = [(5, "one two three " * 40), (None, "x"), (2, None), (2, ""), (9, "two"), (9, "two")]
    path = str(tmp_path / "ids")
    df = spark.createDataFrame(rows, DOC).withColumn("part", F.lit("clash"))
    token_ids.write_token_ids(df, path, WORDS, block=7)
    encoder = Tokenizer.from_file(WORDS)
    got = token_ids.read_documents(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 2, 2, 5, 9, 9]
    start = 0
    for r in got:
        texts = {t or "" for k, t in rows if k == r.doc_id}
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids in [[*encoder.encode(t, add_special_tokens=False).ids, 1] for t in texts]
        assert (r.start, r.n_tokens) == (start, len(ids))
        start += len(ids)
    index = token_ids.chunk_index(spark, path).orderBy("start").collect()
    assert sum(r.n for r in index) == start and max(r.n for r in index) <= 7


@pytest.mark.parametrize("path", [WORDS, public_tokenizers.path("byte_bpe_50k.json")])
def test_chunks_are_encoded_as_whole_texts(path):
    encoder, whole = token_ids.ChunkEncoder(path), Tokenizer.from_file(path)
    assert encoder.by_chunks == (path == WORDS)
    signs = ["a", "The", " ", "  ", "\n", ".", ",", "É", "é", "İ", "Σ", "日本", "1", "'s", "!", "\x85"]
    signs += ["word", "don't", "###", "'", "|>", "(", "_", "=", "\u0338"]
    signs += ["́", "ß", "<|endoftext|>", "ǅ", "​", "\t"]
    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(25)))
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, ascii(text)


# Personal data


def spans_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), DOC).withColumn("pii", F.lit("clash"))
    found = pii.find_pii(df).orderBy("doc_id")
    return found.select(pii.span_text(F.col("pii")).alias("s"), "pii").collect()


def test_checksums_and_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 is valid",
        "IBAN DE88 3704 0044 0532 0130 00 is not",
        "social security 123-45-6789",
        "part number 123-45-6789",
        "4539 1488 0343 6467 and 4539 1488 0343 6468",
        "é😀 a@b.c",
        None,
        "",
    ]
    got = [r.s for r in spans_of(spark, texts)]
    assert got == [
        "iban:5:32", "", "national_id:16:27", "", "card:0:19", "email:3:8", "", "",
    ]
    near, apart = spans_of(spark, ["card 4539148803436467", "4539148803436467"])
    assert near.pii[0].score > apart.pii[0].score


def test_long_texts_and_masking(spark):
    texts = ["a" * 200_000, "1-" * 50_000 + "1", "x@" + "y." * 30_000 + "z", "p@q.r " * 300, None]
    found = spans_of(spark, texts)
    assert found[0].s == "" and found[2].s == "email:0:60003"
    assert found[3].s.count("email") == 300
    df = spark.createDataFrame([(1, "mail p@q.r, ip 1.2.3.4!"), (2, None)], DOC)
    masked = pii.mask_pii(pii.find_pii(df)).orderBy("doc_id").collect()
    assert [r.text for r in masked] == ["mail [EMAIL], ip [IP]!", None]


def masked_plainly(text, spans):
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out.append(text[at : s["start"]] + f"[{s['kind'].upper()}]")
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def test_places_and_masks_of_mixed_texts(spark):
    """Spans lie in pages of 512 characters and are gathered in parts of 256; here both are crossed."""
    rng = random.Random(3)
    parts = ["p@q.r", "1.2.3.4", "4539148803436467", "+44 20 7946 0958", "GB82WEST12345698765432"]
    parts += ["é😀", "word ", " " * 300, "123-45-6789 ssn", ", ", "\n", "日本 " * 90, "a@b.c@d.e"]
    texts = [" ".join(rng.choice(parts) for _ in range(n)) for n in (0, 1, 5, 300, 900, 2600)]
    df = spark.createDataFrame(list(enumerate(texts)), DOC)
    found = pii.find_pii(df)
    rows = {r.doc_id: r.pii for r in found.collect()}
    for r in pii.mask_pii(found).collect():
        assert r.text == masked_plainly(texts[r.doc_id], rows[r.doc_id])
    for i, text in enumerate(texts):
        want = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        assert [(s["start"], s["end"]) for s in rows[i] if s["kind"] == "email"] == want
    empty = found.where("doc_id < 0")
    assert pii.mask_pii(empty).isEmpty()


def test_many_matches_in_one_text(spark):
    text = "".join(f"u{i}@h.org 10.0.{i % 250}.7\n" for i in range(50_000))
    df = spark.createDataFrame([(1, text)], DOC)
    begin = time.monotonic()
    row = pii.mask_pii(pii.find_pii(df)).select("text", F.size("pii").alias("n")).first()
    assert time.monotonic() - begin < 40
    assert row.n == 100_000 and row.text == "[EMAIL] [IP]\n" * 50_000


# Nearest neighbours


VEC = "vec_id long, embedding array<float>"


def test_unusable_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (3, [1.0, 1.0])]
    bad = [(200, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0])]
    bad += [(8, [1.0, 2.0, 3.0]), (None, [1.0, 0.5])]
    df = spark.createDataFrame(rows + bad, VEC).withColumn("id", F.lit("clash"))
    got = ann.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [
        (0, 1, 3), (0, 2, 100), (100, 1, 3), (100, 2, 0),
    ]
    assert ann.nearest(df.where("vec_id IN (4, 200)"), F.lit(True)).isEmpty()


def test_equal_vectors_tie_by_id(spark):
    rows = [(i, [1.0, 2.0]) for i in range(30)] + [(50, [1.0, 3.0])]
    got = ann.nearest(spark.createDataFrame(rows, VEC), F.col("vec_id").isin(0, 25, 50), k=3)
    found = {}
    for r in got.orderBy("rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == {0: [1, 2, 3], 25: [0, 1, 2], 50: [0, 1, 2]}


# Token counts


def test_counts_agree_with_the_library(spark, texts):
    vocabulary = token_counts.read_vocabulary(PIECES)
    least = min(s for _, s in vocabulary)
    octets = [(f"<0x{i:02X}>", least) for i in range(256)]
    model = models.Unigram([("<unk>", least), *vocabulary, *octets], unk_id=0, byte_fallback=True)
    library = Tokenizer(model)
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    rng = random.Random(6)
    signs = ["a", "the", " ", "  ", " " * 5, " " * 40, "\n", "▁", "é", "語", "😀", "1", ".", "tion"]
    sample = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(1500)]
    sample += [*texts.values(), "a" * 5000, ""]
    df = spark.createDataFrame([*enumerate(sample), (-1, None)], DOC)
    df = df.withColumn("n_tokens", F.lit("clash"))
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, PIECES).collect()}
    assert got.pop(-1) == 0
    assert got == {i: len(library.encode(t).ids) for i, t in enumerate(sample)}


# Mixing


def test_mixing_edges(spark):
    schema = "doc_id long, source string, n int, size string"
    rows = [(i, "a", 100, "x") for i in range(40)] + [(i, "b", 10, "x") for i in range(40, 44)]
    rows += [(60, None, 7, "x"), (None, "c", 50, "x"), (None, "c", 50, "x"), (70, "z", 0, "x")]
    rows += [(i, s, 0, "x") for i, s in enumerate("abz" * 20, 100)]
    df = spark.createDataFrame(rows, schema)
    got = mixing.mix_sources(df.select("doc_id", "source", "n", "size"), F.col("n")).collect()
    assert len(got) == len(rows)
    by = {r.source: r for r in got}
    # Weights by name, null last: a 1, b 2, c 3, z 1, null 2; all but a are capped.
    assert by["b"].target == 3 * 40 and by["c"].target == 3 * 100 and by[None].target == 21
    assert by["z"].target == 0
    # Rows without words come as often as the whole repetitions say and never more often.
    whole = {"a": int(by["a"].target // by["a"].source_size), "b": 3, "z": 3}
    assert all(r.reps == whole[r.source] for r in got if r.size == 0)
    assert all(r.reps <= 3 for r in got)
    total = sum(r.size for r in got)
    assert by["a"].target == total - 120 - 300 - 21
    taken = sum(r.size * r.reps for r in got if r.source == "a")
    assert abs(taken - by["a"].target) <= 50
    assert mixing.mix_sources(df.where("n < 0"), F.col("n")).isEmpty()
    only = mixing.mix_sources(df.where("source = 'z'"), F.col("n")).collect()
    assert [(r.size, r.target) for r in only] == [(0, 0.0)] * 21


def test_mixing_is_the_same_at_every_size(spark):
    """Doubled sizes are as many classes further up, so the mix takes each row as often. Weight
    times words passes 2^31 in the second case, where the words do not, and 2^33 in the third."""
    rng = random.Random(6)
    rows = [(i, "abc"[i % 3], rng.randrange(1, 10)) for i in range(60)]
    total = sum(n for _, _, n in rows)
    assert total * 2**22 < 2**31 < 3 * total * 2**22
    df, reps = spark.createDataFrame(rows, "doc_id long, source string, n long"), []
    for factor in (1, 2**22, 2**32):
        got = mixing.mix_sources(df, F.col("n") * factor).collect()
        assert all(math.isclose(r.target, "?abc".index(r.source) * total * factor / 6) for r in got)
        reps.append({r.doc_id: r.reps for r in got})
    assert reps[0] == reps[1] == reps[2] and set(reps[0].values()) == {0, 1, 2}


def test_mixture_stage_at_sizes_whose_weighted_sum_passes_32_bits(spark, monkeypatch):
    rows = [(i, " ".join(words(i, 1 + i % 9)), "en", "abc"[i % 3], 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted(corpus_pipeline.mixture(spark, docs, "").collect())
    factor = 2**31 // sum(1 + i % 9 for i in range(60)) - 1

    def mix(docs, size):
        return mixing.mix_sources(docs, size.cast("long") * factor)

    monkeypatch.setattr(corpus_pipeline, "mix_sources", mix)
    got = sorted(corpus_pipeline.mixture(spark, docs, "").collect())
    assert {r.doc_id for r in got} and abs(len(got) - len(want)) <= 3
    taken = sum(len(r.text.split()) for r in got)
    assert abs(taken - sum(1 + i % 9 for i in range(60))) <= 9


# Byte-level BPE


def test_units_kept_are_few_and_not_kept_twice(monkeypatch):
    assert bpe._UNITS <= 150_000
    text = "one two, three four! five two three (one) \u00e9t\u00e9 it's  x " * 3
    library = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )
    want = library.encode_ordinary(text)
    for most in (bpe._UNITS, 2):
        monkeypatch.setattr(bpe, "_UNITS", most)
        encoder = bpe.Encoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
        assert max(len(encoder.known), len(encoder.pieces)) <= most
        assert most == 2 or {" three", " five"} <= encoder.known.keys() - encoder.pieces.keys()


def test_matches_met_often_are_encoded_once(monkeypatch):
    monkeypatch.setattr(bpe, "_UNITS", 8)
    encoder, coded = bpe.Encoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN), []
    ids = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda piece: coded.append(piece) or ids(piece))
    rare = ["".join(x) for x in itertools.product("bkz", repeat=4)]
    for word in rare:
        encoder.encode(f" often {word}")
    assert coded.count(" often") == 1 and len(coded) == 1 + len(rare)
    assert len(encoder.known) + len(encoder.pieces) <= 8


def test_encoding_agrees_with_the_library():
    ranks = bpe.read_ranks(RANKS)
    library = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    rng = random.Random(7)
    signs = ["a", "the", " ", "  ", " " * 5, " " * 40, "\n", "é", "日本", "й", "1", "'s", "!", "\x1c", "\x85", "😀", "\r\n"]
    sample = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(3000)]
    sample += ["a" * 30_000, "ab" * 9_000, "=-" * 5_000, "", " " * 500, "日" * 2_000]
    for text in sample:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text), ascii(text)[:80]
    stream = bpe.Decoder(encoder.machine.bytes_of)
    ids = np.frombuffer(encoder.encode("é日本😀 ok"), "<u4").tolist()
    assert "".join([stream.feed([i]) for i in ids] + [stream.finish()]) == "é日本😀 ok"


def test_neighbours_follow_from_the_definition():
    machine = bpe.Transducer(bpe.read_ranks(RANKS))
    rng, ids = random.Random(8), sorted(machine.bytes_of)
    for top in (300, 2000, len(ids)):
        for _ in range(3000):
            a, b = ids[rng.randrange(top)], ids[rng.randrange(top)]
            pair = machine.merge(machine.bytes_of[a] + machine.bytes_of[b]) == [a, b]
            assert machine.may_follow(a, b) == pair


def test_few_states_change_nothing():
    ranks = bpe.read_ranks(RANKS)
    small, large = bpe.Transducer(ranks, max_states=20), bpe.Transducer(ranks)
    for text in ("unbelievable", "zusammengesetzte", "x" * 100, "été" * 30):
        assert small.encode(text.encode()) == large.encode(text.encode())


def test_null_texts_and_clashing_names(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "hé", "z")], DOC + ", ids string")
    coded = bpe.encode_documents(df, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode_documents(coded, RANKS).orderBy("doc_id").collect()
    assert [r.decoded for r in back] == ["", "", "hé"]
    assert bpe.encode_documents(df.where("doc_id > 5"), RANKS, public_tokenizers.PATTERN).isEmpty()


# URL filters


def test_url_parts_and_precedence(spark):
    rules = spark.createDataFrame(
        [("a.com", "/", "block"), ("a.com", "/ok", "allow"), ("b.a.com", "", "allow"), (None, "/", "block")]
        + [("c.org", "/x", "allow"), ("c.org", "/x", "block"), ("A.net", "/", "block")],
        "host string, path string, verdict string",
    )
    cases = {
        "http://a.com/no": "block",
        "http://X.A.COM/okay?q": "allow",
        "http://ba.com/": "allow",
        "https://b.a.com/no": "allow",
        "http://c.org/x": "block",
        "http://a.com": "allow",
        "http://a.net/": "block",
        "a.com/no": "allow",
        "": "allow",
        None: "allow",
        "http://" + "a." * 3000 + "a.com/" + "p" * 5000: "block",
    }
    rows = [(i, u, "x") for i, u in enumerate(cases)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = urls.judge_urls(pages, rules).collect()
    assert len(got) == len(rows)
    wanted = list(cases.values())
    assert all(r.verdict == wanted[r.page_id] for r in got)
    parts = {r.page_id: (r.host, r.path) for r in got}
    assert parts[1] == ("x.a.com", "/okay") and parts[7] == parts[9] == ("", "")
    assert all(r.rule is None for r in urls.judge_urls(pages, rules.where("false")).collect())


# Sharding


def test_shards_follow_keys_and_weights(spark):
    df = spark.range(4000).select(F.col("id").alias("k"))
    light, heavy = [1.0, 1.0, 1.0], [1.0, 1.0, 2.0]
    moved = df.select(
        shards.rendezvous(F.col("k"), light).alias("a"), shards.rendezvous(F.col("k"), heavy).alias("b")
    ).collect()
    assert all(r.a == r.b or r.b == 2 for r in moved)
    assert 0.45 < sum(r.b == 2 for r in moved) / len(moved) < 0.55
    with pytest.raises(ValueError):
        shards.rendezvous(F.col("k"), [1.0, 0.0])


def test_slots_with_nulls_repeats_and_no_rows(spark):
    rows = spark.createDataFrame([(None,), (1,), (1,), (2,)] * 50, "k long").repartition(5)
    placed = shards.number_slots(rows.withColumn("shard", shards.rendezvous(F.col("k"), [1.0] * 3)))
    slots = {}
    for r in placed.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards.number_slots(rows.where("k > 5").withColumn("shard", F.lit(0))).isEmpty()


# Quality rules


def brute_stats(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    three = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    covered = {i + j for i, t in enumerate(three) if three.count(t) > 1 for j in range(3)}
    rows = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(found), sum(map(len, found)), symbols, len(rows) - len(set(rows)), len(covered)


def test_text_statistics(spark):
    rng = random.Random(9)
    signs = ["a", "b", "é", " ", " ", "\n", "\t", "#", "*", "\x0b", " "]
    sample = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(400)]
    sample += [None, "", "x y z " * 50, "one\n\none\none "]
    df = spark.createDataFrame(list(enumerate(sample)), DOC)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in lines.text_stats(df).collect():
        assert tuple(r[n] for n in names) == brute_stats(r.text), ascii(r.text)


def test_depleted_documents_go_and_copies_do_not_count(spark):
    boilerplate = "all rights reserved " + " ".join(words(9020, 60))
    rows = [(i, f"{boilerplate}\n{' '.join(words(i, 80))}", "h") for i in range(30)]
    rows += [(90, f"{boilerplate}\nown words", "h"), (91, f"  {boilerplate.upper()} ", "h")]
    rows += [(100 + i, "copied " + " ".join(words(5000, 70)), "h") for i in range(40)]
    rows += [(200, None, "h"), (201, " ".join(words(6000, 60)), None)]
    df = spark.createDataFrame(rows, DOC + ", source string").withColumn("kept", F.lit("clash"))
    got = {r.doc_id: r.kept for r in lines.judge_quality(df).collect()}
    assert len(got) == len(rows)
    assert [k for k, v in got.items() if not v] == [90, 91, 200]
    assert lines.judge_quality(df.where("doc_id > 999")).isEmpty()


def test_common_lines_are_removed(spark):
    def space(i):
        return ["", "\n", " \n\n"][i % 3]

    rows = [(i, f"Share  this\n{space(i)}{' '.join(words(i, 80))}\n share THIS \r\nend {i}", "h") for i in range(30)]
    rows += [(40 + i, f"share this\n{' '.join(words(40 + i, 80))}\n", "few") for i in range(9)]
    rows += [(60, "share this", "h"), (61, None, "h"), (62, "", "h"), (63, "share this\n\n", "h")]
    want = {i: f"{space(i)}{' '.join(words(i, 80))}\nend {i}" for i in range(30)}
    want |= {k: t for k, t, s in rows if s == "few"} | {60: "", 61: None, 62: "", 63: "\n"}
    df = spark.createDataFrame(rows * 2, DOC + ", source string").withColumn("pos", F.lit("clash"))
    got = lines.remove_common_lines(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id, repr(r.text)) for r in got.collect()) == sorted(
        (k, repr(t)) for k, t in [*want.items()] * 2
    )
    good = {r.doc_id: r.text for r in lines.keep_good(df).collect()}
    assert good == {k: t for k, t in want.items() if k < 60}


def test_common_lines_are_found_without_moving_texts(spark):
    rng = random.Random(5)
    body = {k: " ".join(words(k, 60)) for k in range(1200)}
    extra = ["Shared  line", "shared line\r", " other SHARED line", "rare line", "", " \t"]
    rows = []
    for k in range(1200):
        parts = [body[k], *rng.choices(extra[:3] + extra[4:], k=rng.randrange(6))]
        parts += ["rare line"] * (k < 10) + ["shared line"] * (300 * (k == 7))
        rng.shuffle(parts)
        rows.append((k, "\n".join(parts) if k % 50 else "too few words", ["a", "b", None][k % 3]))
    rows += [(2000, None, "a"), (2001, "", None)]

    def normal(line):
        return re.sub("[ \t-\r]+", " ", line).strip(" ").translate({i: i + 32 for i in range(65, 91)})

    having, texts = {}, {}
    for text, host in {(t, h) for _, t, h in rows if t}:
        texts[host] = texts.get(host, 0) + 1
        for line in {normal(x) for x in text.split("\n")} - {""}:
            having[host, line] = having.get((host, line), 0) + 1
    gone = {k for k, n in having.items() if n > 10 and n > texts[k[0]] * 0.05}
    clean, good = {}, {}
    for k, text, host in rows:
        parts = (text or "").split("\n")
        left = "\n".join(x for x in parts if (host, normal(x)) not in gone)
        clean[k] = None if text is None else left
        n, repeated = len((text or "").split()), k == 7
        if n >= 50 and not repeated and len(left.split()) >= 0.2 * n:
            good[k] = left
    assert 1100 < len(good) < 1200 and len(gone) == 6

    schema = DOC + ", source string, n_words string"
    df = spark.createDataFrame([(*r, "own") for r in rows], schema)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "8k")
    try:
        for work, want in ((lines.remove_common_lines, clean), (lines.keep_good, good)):
            got = work(df)
            assert got.columns == df.columns
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
            assert {r.doc_id: r.text for r in got.collect()} == want
            assert {r.n_words for r in got.collect()} == {"own"}
        spark.conf.set(name, "-1")
        assert {r.doc_id: r.text for r in lines.keep_good(df).collect()} == good
    finally:
        spark.conf.set(name, before)


def test_texts_are_hashed_in_small_slices():
    column = pa.array([" ".join(words(i, 400)) for i in range(2000)])
    tracemalloc.start()
    for _, data, offsets in jaccard._slices(column):
        jaccard._Texts(data, offsets, 5)
    assert tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()
