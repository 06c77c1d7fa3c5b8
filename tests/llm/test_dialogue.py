"""Generalised LR repair against a search over all edits; edge cases of the operator."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from silverloom.llm import dialogue
from silverloom.llm.dialogue import ROLE_GRAMMAR, Repairer, repair_conversations, repair_digests

TURNS = "conv_id long, turn long, role string, text string"
FAULTS = ("", "blank", "duplicate", "truncated")


def search(rows):
    """(cost, audit) of the cheapest edits of (initial, fault) rows, by trying all of them."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        if (i, out) in seen:
            continue
        seen.add((i, out))
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", out):
            return cost, audit
        if len(out) > len(rows) + 3 or not re.fullmatch("(s?(ua)*u?)?", out):
            continue
        for role in "ua":
            heapq.heappush(heap, (cost + 3, audit + "I", i, out + role))
        if i < len(rows):
            own, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, out))
            if fault not in ("blank", "duplicate"):
                cost += 3 * (fault == "truncated")
                heapq.heappush(heap, (cost, audit + "K", i + 1, out + own))
                for role in "ua":
                    heapq.heappush(heap, (cost + 3, audit + "R", i + 1, out + role))


def test_repair_is_the_cheapest_however_it_is_cut():
    rng = random.Random(3)
    repairer = Repairer(ROLE_GRAMMAR, ("u", "a"))
    for _ in range(400):
        rows = [(rng.choice("suuaax"), rng.choice(FAULTS[:1] * 4 + FAULTS)) for _ in range(rng.randint(1, 6))]
        letters = "".join(
            "ABCDEFGHIJKLMNOP"["suax".index(own) + 4 * FAULTS.index(fault)] for own, fault in rows
        )
        want = search(rows)
        for size in (1, 2, 4, 9):
            parts = [letters[i : i + size] for i in range(0, len(letters), size)]
            cost, stacks, last = repairer.combine([repairer.summary(p) for p in parts])
            edits = []
            for k, (part, (a, b)) in enumerate(zip(parts, stacks)):
                edits += repairer.edits(part, a, b, last if k + 1 == len(parts) else "")
            assert len(edits) == len(rows)
            assert (cost, "".join(e[0] for row in edits for e in row)) == want, (rows, size)


def test_another_grammar():
    # Question, answer, and any number of remarks after it.
    repairer = Repairer({"C": ("", "CT"), "T": ("W",), "W": ("ua", "Wt")}, ("u", "a"))
    letters = "BCBC"
    cost, _, _ = repairer.combine([repairer.summary(letters)])
    assert cost == 0
    with pytest.raises(ValueError):
        Repairer({"C": ("", "uC")}, ("u",))


def plain(conversations):
    """Per conversation: figures, cost, audit and hash, from rows after damage."""
    out = {}
    for conv, rows in conversations.items():
        rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged = set(), []
        for _, role, text in rows:
            body = text.strip("\x20\t\n\v\f\r")
            fault = "truncated" if body and body[-1] not in ".!?" else ""
            fault = "duplicate" if (role, text) in seen else fault
            judged.append((role[0] if role and role[0] in "sua" else "x", fault if body else "blank"))
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit = search(judged)
        lines, i, state = [], 0, ""
        for letter in audit:
            due = "assistant" if state.endswith("u") else "user"
            if letter == "I":
                lines.append(f"{due}:")
                state += due[0]
                continue
            _, role, text = rows[i]
            i += 1
            if letter != "D":
                role = role if letter == "K" else due
                lines.append(f"{role}:{text}")
                state += role[:1]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        faults = [f for _, f in judged]
        out[conv] = (gaps, *map(faults.count, FAULTS[1:]), illegal, cost, audit, digest)
    return out


def operator(spark, rows, segment):
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "7 AS position", "'x' AS edit").repartition(5)
    repaired, decided = repair_conversations(frame, segment=segment)
    sums = {r.conv_id: r for r in decided.collect()}
    digests = {r.conv_id: r for r in repair_digests(repaired).collect()}
    return {
        c: (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, digests[c].audit, digests[c].repaired_sha256)
        for c, r in sums.items()
    }


def test_operator_with_edges(spark):
    rng = random.Random(8)
    texts = ["Yes.", "No!", "what", "", None, " \t", "Yes.", "Really? \n", "é"]
    rows = []
    for conv in [None, *range(30)]:
        for turn in range(rng.randint(1, 6)):
            turn = None if rng.random() < 0.1 else turn // 2 if rng.random() < 0.3 else turn
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((conv, turn, role, rng.choice(texts)))
    rows += [(99, None, "user", None)] * 3 + [(98, 1, "user", "Same.")] * 5
    grouped = {}
    for conv, *rest in rows:
        grouped.setdefault(conv, []).append(rest)
    want = {c: v[1:] for c, v in plain(grouped).items()}
    assert operator(spark, rows, 1024) == want
    assert operator(spark, rows, 2) == want
    empty = spark.createDataFrame([], TURNS)
    repaired, decided = repair_conversations(empty)
    assert repaired.collect() == [] == decided.collect() == repair_digests(repaired).collect()


def test_long_conversation_and_texts(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"Turn {i}.") for i in range(5000)]
    rows.append((2, 0, "user", "long " * 400_000 + "."))
    got = operator(spark, rows, 64)
    # The first turn is an assistant's and the last a user's.
    assert got[1][4:6] == (6, "I" + "K" * 5000 + "I")
    assert got[2][4:6] == (3, "KI")


def test_repaired_rows(spark):
    rows = [(1, 3, "assistant", "Fine."), (1, 2, "user", "How?"), (1, 1, "assistant", "Hi."), (1, 9, "user", "")]
    repaired, _ = repair_conversations(spark.createDataFrame(rows, TURNS))
    got = repaired.orderBy("position", "step").collect()
    assert [(r.turn, r.role, r.text, r.edit, r.fault) for r in got] == [
        (None, "user", "", "I", None),
        (1, "assistant", "Hi.", "K", ""),
        (2, "user", "How?", "K", ""),
        (3, "assistant", "Fine.", "K", ""),
        (9, "user", "", "D", "blank"),
    ]


def damaged(conv, turn, role, text):
    place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    number = zlib.crc32(place.encode()) % 20
    role, text = (" " if x is None else x for x in (role, text))
    text = "" if number == 1 else re.sub("[.!?]", "", text) if number == 2 else text
    row = (turn, "user" if number == 4 else role, text)
    return [] if number == 0 else [row] * (1 + (number == 3))


def test_query_on_nulls_and_conversations_that_vanish(spark, tmp_path):
    rng = random.Random(12)
    rows = [(c, t, r, f"Text {t}.") for c in [None, *range(200)] for t, r in enumerate(["user", "assistant"][: 1 + (c or 0) % 2])]
    rows += [(970, None, None, None), (971, None, "user", "A."), (971, 2, "user", "A.")]
    rng.shuffle(rows)
    spark.createDataFrame(rows, TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    want = {}
    for conv, *rest in rows:
        want.setdefault(conv, []).extend(damaged(conv, *rest))
    assert [] in want.values()
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    left = plain({c: r for c, r in want.items() if r})
    got = dialogue.op12_dialogue_repair(spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: left.get(c, empty) for c in want}
    assert len(got) == len(want)


def test_damage_of_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = dialogue.damage(rows).drop("copy").collect()
    want = [(r.conv_id, *row) for r in rows.collect() for row in damaged(*r)]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert rows.select(F.count("*")).first()[0] != len(want)
