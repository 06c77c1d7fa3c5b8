"""Conversation structure repair: generalised LR parsing of the roles with weighted edits.

Rows of a conversation are read in order by an LR automaton of the role grammar that follows all
its stacks at once; stacks share their lower parts and equal ones are one node. Each row may be
kept, given another role or deleted, and roles may be inserted; of the ways that lead to one
stack the cheapest stays, and of equally cheap ones that with the least audit.

A conversation is cut into segments of bounded length. What a segment costs from any stack to any
other is a small table; the tables of one conversation are put together in order, which tells
the stacks between which each segment is repaired. So no conversation has to fit into a task.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.common import SPACE, ship_code, split_join, stored, table
from silverloom.operators.ordering import with_position

#: ``s?(ua)+`` or nothing: s a system turn, u a user's, a an assistant's.
ROLE_GRAMMAR = {"C": ("", "QX"), "Q": ("", "s", "QX"), "X": ("ua",)}
#: Roles that may be given to a row or inserted, by their initials in the grammar.
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: Neighbouring roles that are in order.
ADJACENT = ("su", "ua", "au")

#: Rows whose edits are found together.
SEGMENT = 1024
_KEPT_SEGMENTS = 20_000
_INITIALS = "sua"  # any other initial is a fourth class
_FAULTS = ("", "blank", "duplicate", "truncated")
#: One letter per row: class of its initial plus four times its fault.
_LETTERS = "ABCDEFGHIJKLMNOP"
_MOST_STACKS = 1000


class RoleGrammar:
    """An LR(0) automaton over a grammar of single-letter symbols, run with shared stacks.

    Rules map a capital to its right sides; the first one is the start. Stacks are numbered
    nodes (state, node below), equal stacks have one number. Conflicts are followed both ways.
    """

    def __init__(self, rules: Mapping[str, Sequence[str]]):
        self.rules = {k: tuple(v) for k, v in rules.items()}
        self.start = next(iter(self.rules))
        self._states: dict[frozenset, int] = {}
        self._items: list[frozenset] = []
        self._nodes: dict[tuple[int, int], int] = {}
        self._node: list[tuple[int, int]] = []
        self._advance: dict[tuple[int, str], tuple[int, ...]] = {}
        first = self._state({("", self.start, 0)})
        self.empty = self._push(first, -1)

    def _state(self, items: set[tuple[str, str, int]]) -> int:
        items, todo = set(items), list(items)
        while todo:
            _, body, dot = todo.pop()
            for new in self.rules.get(body[dot : dot + 1], ()):
                item = (body[dot], new, 0)
                if item not in items:
                    items.add(item)
                    todo.append(item)
        key = frozenset(items)
        if key not in self._states:
            self._states[key] = len(self._items)
            self._items.append(key)
        return self._states[key]

    def _push(self, state: int, below: int) -> int:
        key = (state, below)
        if key not in self._nodes:
            if len(self._node) == _MOST_STACKS:
                raise ValueError("the grammar has no finite set of stacks: recur on the left")
            self._nodes[key] = len(self._node)
            self._node.append(key)
        return self._nodes[key]

    def _shifted(self, node: int, symbol: str) -> int | None:
        items = self._items[self._node[node][0]]
        moved = {(h, b, d + 1) for h, b, d in items if b[d : d + 1] == symbol}
        return self._push(self._state(moved), node) if moved else None

    def _reduced(self, node: int) -> set[int]:
        """The stack itself and all that reductions make of it."""
        seen, todo = {node}, [node]
        while todo:
            top = todo.pop()
            for head, body, dot in self._items[self._node[top][0]]:
                if dot < len(body) or not head:
                    continue
                below = top
                for _ in body:
                    below = self._node[below][1]
                after = self._shifted(below, head)
                if after is not None and after not in seen:
                    seen.add(after)
                    todo.append(after)
        return seen

    def advance(self, node: int, role: str) -> tuple[int, ...]:
        """The stacks after one more role."""
        key = (node, role)
        if key not in self._advance:
            shifted = (self._shifted(top, role) for top in self._reduced(node))
            self._advance[key] = tuple(sorted({n for n in shifted if n is not None}))
        return self._advance[key]

    def accepts(self, node: int) -> bool:
        tops = (self._items[self._node[top][0]] for top in self._reduced(node))
        return any(("", self.start, 1) in items for items in tops)


class Repairer:
    """Cheapest edits of role sequences; ties fall to the least audit.

    An audit has K (kept), R (rerole), D (deleted) for each row and I for each insertion, put
    before the next row that stays: before a deleted row it would only make the audit greater.
    A path is an audit with the role given after each letter.
    """

    def __init__(self, rules: Mapping[str, Sequence[str]], roles: Sequence[str]):
        self.grammar, self.roles = RoleGrammar(rules), tuple(roles)
        terminals = sorted({x for v in rules.values() for b in v for x in b if x not in rules})
        self.stacks, index = [self.grammar.empty], {self.grammar.empty: 0}
        for stack in self.stacks:
            for role in terminals:
                for after in self.grammar.advance(stack, role):
                    if after not in index:
                        index[after] = len(self.stacks)
                        self.stacks.append(after)
        self._step = {
            (index[s], r): [index[n] for n in self.grammar.advance(s, r)]
            for s in self.stacks
            for r in terminals
        }
        self._inserts = [self._insertions(i) for i in range(len(self.stacks))]
        self._moves = [
            {letter: self._options(i, k) for k, letter in enumerate(_LETTERS)}
            for i in range(len(self.stacks))
        ]
        self._known: OrderedDict[str, list[dict[int, tuple[int, str, str]]]] = OrderedDict()
        # Roles to insert after the last row, by stack; None if no number of them is accepted.
        accepted = [self.grammar.accepts(s) for s in self.stacks]
        self.ends = [
            min((p for i, p in reached.items() if accepted[i]), key=lambda p: (len(p), p), default=None)
            for reached in self._inserts
        ]

    def _insertions(self, stack: int) -> dict[int, str]:
        """Stacks reached by inserting, each with the fewest roles."""
        reached, todo = {stack: ""}, [stack]
        for at in todo:
            for role in self.roles:
                for after in self._step.get((at, role), ()):
                    if after not in reached:
                        reached[after] = reached[at] + role
                        todo.append(after)
        return reached

    def _options(self, stack: int, code: int) -> list[tuple[int, int, str, str]]:
        """(stack after, cost, audit, path) of a row's edits, the best for each stack."""
        own, fault = _INITIALS[code % 4 : code % 4 + 1], _FAULTS[code // 4]
        best: dict[int, tuple[int, str, str]] = {stack: (DELETE, "D", "D-")}
        if fault not in ("blank", "duplicate"):
            extra = CUT_OFF if fault == "truncated" else 0
            for middle, inserted in self._inserts[stack].items():
                audit, path = "I" * len(inserted), "".join(f"I{r}" for r in inserted)
                cost = INSERT * len(inserted) + extra
                edits = [(own, 0, "K", "K-")] + [(r, REROLE, "R", f"R{r}") for r in self.roles]
                for role, more, letter, token in edits:
                    for after in self._step.get((middle, role), ()):
                        new = (cost + more, audit + letter, path + token)
                        best[after] = min(best.get(after, new), new)
        return [(after, *found) for after, found in best.items()]

    def segment(self, letters: str) -> list[dict[int, tuple[int, str, str]]]:
        """For each stack before the rows: stacks after them with cost, audit and path."""
        if letters in self._known:
            self._known.move_to_end(letters)
            return self._known[letters]
        tables = []
        for entry in range(len(self.stacks)):
            tops = {entry: (0, "", "")}
            for letter in letters:
                after: dict[int, tuple[int, str, str]] = {}
                for stack, (cost, audit, path) in tops.items():
                    for to, more, edit, token in self._moves[stack][letter]:
                        held = after.get(to)
                        if held is None or cost + more <= held[0]:
                            new = (cost + more, audit + edit, path + token)
                            if held is None or new < held:
                                after[to] = new
                tops = after
            tables.append(tops)
        if len(letters) <= 64:
            self._known[letters] = tables
            if len(self._known) > _KEPT_SEGMENTS:
                self._known.popitem(last=False)
        return tables

    def summary(self, letters: str) -> bytes:
        """Costs and places of the audits, for each stack before and after: of fixed size."""
        n = len(self.stacks)
        out = np.full((2, n, n), -1, "<i4")
        for entry, tops in enumerate(self.segment(letters)):
            audits = sorted({audit for _, audit, _ in tops.values()})
            for stack, (cost, audit, _) in tops.items():
                out[:, entry, stack] = cost, audits.index(audit)
        return out.tobytes()

    def combine(self, summaries: Sequence[bytes]) -> tuple[int, list[tuple[int, int]], str]:
        """Total cost, the stacks (before, after) of each segment, and the roles inserted last.

        Audits of different stacks after the same rows end with a row's letter and have equally
        many of these, so none begins another and the earliest difference decides.
        """
        n, tops, came = len(self.stacks), {0: (0, 0)}, []
        for data in summaries:
            costs, places = np.frombuffer(data, "<i4").reshape(2, n, n).tolist()
            best: dict[int, tuple[int, tuple[int, int], int]] = {}
            for middle, (cost, rank) in tops.items():
                for to in range(n):
                    if costs[middle][to] >= 0:
                        new = (cost + costs[middle][to], (rank, places[middle][to]), middle)
                        best[to] = min(best.get(to, new), new)
            order = sorted({audit for _, audit, _ in best.values()})
            tops = {to: (cost, order.index(audit)) for to, (cost, audit, _) in best.items()}
            came.append({to: middle for to, (_, _, middle) in best.items()})
        closed = [
            (cost + INSERT * len(self.ends[to]), rank, "I" * len(self.ends[to]), to)
            for to, (cost, rank) in tops.items()
            if self.ends[to] is not None
        ]
        cost, _, _, last = min(closed)
        stacks, at = [], last
        for back in reversed(came):
            stacks.append((back[at], at))
            at = back[at]
        return cost, stacks[::-1], self.ends[last]

    def edits(self, letters: str, before: int, after: int, last: str) -> list[list[str]]:
        """For each row its edits in order, as letter and role; ``last`` follows the last row."""
        path = self.segment(letters)[before][after][2] + "".join(f"I{r}" for r in last)
        rows: list[list[str]] = [[]]
        for i in range(0, len(path), 2):
            rows[-1].append(path[i : i + 2])
            if path[i] != "I" and len(rows) < len(letters):
                rows.append([])
        return rows


def _adjacent(letters: str) -> int:
    """Neighbours whose roles are out of order."""
    roles = [_LETTERS.index(x) % 4 for x in letters]
    legal = {(_INITIALS.index(a), _INITIALS.index(b)) for a, b in ADJACENT}
    return sum(pair not in legal for pair in zip(roles, roles[1:]))


@lru_cache(maxsize=2)
def _repairer(rules: tuple[tuple[str, tuple[str, ...]], ...], roles: tuple[str, ...]) -> Repairer:
    return Repairer(dict(rules), roles)


def repair_conversations(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    rules: Mapping[str, Sequence[str]] = ROLE_GRAMMAR,
    roles: Mapping[str, str] = ROLES,
    segment: int = SEGMENT,
) -> tuple[DataFrame, DataFrame]:
    """(rows with their edits, one row per conversation).

    Rows: ``conv_id, turn, role, text`` after the repair, ``position, step`` (their order over
    all conversations), ``edit`` (K, R, D, I) and ``fault``. Deleted rows are listed with D and
    are not part of the repaired conversation; inserted ones have no turn and an empty text.
    Conversations: ``conv_id, n_rows, blank, duplicate, truncated, illegal`` (neighbours out of
    order before the repair), ``cost``.

    Order: turn (nulls first), role, text; equal rows beside each other. A row's first fault
    counts: blank text, role and text seen earlier in the conversation, text that does not end a
    sentence. Blank and repeated rows must go. Null roles and texts are read as one space, a null
    conv_id is a conversation of its own. Other columns are left out. An empty table gives two
    empty ones. Ties are decided by the least audit, so reruns agree.

    Rows are numbered and stored once (one range shuffle: a huge conversation is cut anywhere),
    repeats are found by an aggregate, and each segment of at most ``segment`` rows is one value
    of a letter per row. A conversation meets in one place only as one small table per segment.
    """
    spark = df.sparkSession
    ship_code(spark)
    rules_key = tuple((k, tuple(v)) for k, v in rules.items())
    roles_key = tuple(roles)
    _repairer(rules_key, roles_key)  # faulty grammars are reported here
    conv_type, turn_type = df.schema[conv_id].dataType, df.schema[turn].dataType

    rows = df.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    placed = with_position(rows, order)  # stored there

    trimmed = F.regexp_replace("text", f"[{SPACE}]+$", "")
    initial = F.substring("role", 1, 1)
    kind = F.position(initial, F.lit(_INITIALS)).cast("int")
    slim = placed.select(
        "conv_id",
        "position",
        F.unhex(F.sha2(F.to_json(F.struct("conv_id", "role", "text")), 256)).alias("content"),
        F.when((initial != "") & (kind > 0), kind - 1).otherwise(3).alias("kind"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    firsts = slim.groupBy("content").agg(F.min("position").alias("first"))
    judged = split_join(slim, firsts, ["content"], "inner")
    fault = F.when(F.col("blank"), 1).when(F.col("position") > F.col("first"), 2)
    fault = fault.when(F.col("open"), 3).otherwise(0)
    letter = F.substring(F.lit(_LETTERS), F.col("kind") + 4 * fault + 1, F.lit(1))
    lettered = judged.select("conv_id", "position", letter.alias("letter"))
    pieces = (
        lettered.groupBy("conv_id", F.floor(F.col("position") / segment).alias("piece"))
        .agg(F.sort_array(F.collect_list(F.struct("position", "letter"))).alias("held"))
        .select(
            "conv_id",
            F.col("held")[0]["position"].alias("first"),
            F.array_join("held.letter", "").alias("letters"),
        )
    )

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = _repairer(rules_key, roles_key)
        for batch in batches:
            letters = batch.column("letters").to_pylist()
            columns = [
                pa.array([repairer.summary(x) for x in letters], pa.binary()),
                pa.array([_adjacent(x) for x in letters], pa.int64()),
            ]
            names = [*batch.schema.names, "summary", "illegal"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    key = f"conv_id {conv_type.simpleString()}"
    summed = pieces.mapInArrow(
        summarise, f"{key}, first bigint, letters string, summary binary, illegal bigint"
    )
    summed = stored(summed, "segments")

    faults = {
        name: F.length("letters") - F.length(F.translate("letters", _LETTERS[4 * k : 4 * k + 4], ""))
        for k, name in enumerate(_FAULTS)
        if k
    }
    ends = {"head": F.substring("letters", 1, 1), "tail": F.substring("letters", -1, 1)}
    conversations = summed.groupBy("conv_id").agg(
        F.sum(F.length("letters")).alias("n_rows"),
        *[F.sum(count).cast("long").alias(name) for name, count in faults.items()],
        F.sum("illegal").alias("illegal"),
        F.sort_array(
            F.collect_list(F.struct("first", "summary", *[c.alias(n) for n, c in ends.items()]))
        ).alias("parts"),
    )
    chosen_type = "array<struct<first: bigint, before: int, after: int, last: string>>"
    counts = [("n_rows", "bigint"), *[(f, "bigint") for f in faults], ("illegal", "bigint")]

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = _repairer(rules_key, roles_key)
        part = pa.struct(
            [("first", pa.int64()), ("before", pa.int32()), ("after", pa.int32()), ("last", pa.string())]
        )
        for batch in batches:
            costs, chosen, edges = [], [], []
            for parts in batch.column("parts").to_pylist():
                cost, stacks, last = repairer.combine([p["summary"] for p in parts])
                costs.append(cost)
                edges.append(sum(_adjacent(a["tail"] + b["head"]) for a, b in zip(parts, parts[1:])))
                chosen.append(
                    [
                        {"first": p["first"], "before": before, "after": after, "last": ""}
                        for p, (before, after) in zip(parts, stacks)
                    ]
                )
                chosen[-1][-1]["last"] = last
            illegal = pa.compute.add(batch.column("illegal"), pa.array(edges, pa.int64()))
            columns = [batch.column("conv_id"), *[batch.column(n) for n, _ in counts[:-1]], illegal]
            columns += [pa.array(costs, pa.int64()), pa.array(chosen, pa.list_(part))]
            names = ["conv_id", *[n for n, _ in counts], "cost", "chosen"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join([key, *[f"{n} {t}" for n, t in counts], "cost bigint", f"chosen {chosen_type}"])
    decided = stored(conversations.mapInArrow(join_up, schema), "repairs")

    ways = decided.select(F.inline("chosen"))
    work = split_join(summed.select("first", "letters"), ways, ["first"], "inner")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = _repairer(rules_key, roles_key)
        for batch in batches:
            positions, edits, letters = [], [], []
            for row in batch.to_pylist():
                found = repairer.edits(row["letters"], row["before"], row["after"], row["last"])
                positions.extend(range(row["first"], row["first"] + len(found)))
                edits.extend(found)
                letters.extend(row["letters"])
            columns = [
                pa.array(positions, pa.int64()),
                pa.array([_FAULTS[_LETTERS.index(x) // 4] for x in letters], pa.string()),
                pa.array(edits, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["position", "fault", "edits"])

    edits = work.mapInArrow(edit, "position bigint, fault string, edits array<string>")
    given = F.create_map(*[F.lit(x) for pair in roles.items() for x in pair])
    letter, initial = F.substring("one", 1, 1), F.substring("one", 2, 1)
    inserted = letter == "I"
    repaired = (
        split_join(placed, edits, ["position"], "inner")
        .select("*", F.posexplode("edits").alias("step", "one"))
        .select(
            "conv_id",
            F.when(~inserted, F.col("turn")).cast(turn_type).alias("turn"),
            F.when(letter.isin("I", "R"), given[initial]).otherwise(F.col("role")).alias("role"),
            F.when(inserted, "").otherwise(F.col("text")).alias("text"),
            "position",
            "step",
            letter.alias("edit"),
            F.when(~inserted, F.col("fault")).alias("fault"),
        )
    )
    return repaired, decided.drop("chosen")


def repair_digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, audit, repaired_sha256`` from the rows of :func:`repair_conversations`.

    The hash of a conversation's ``role:text`` lines goes through its rows in order, so each
    conversation is streamed through one task; only its audit, a letter per edit, is held.
    """
    ship_code(repaired.sparkSession)
    key = repaired.schema["conv_id"].dataType.simpleString()
    order = [F.asc_nulls_first("conv_id"), F.col("position"), F.col("step")]
    lines = repaired.select("conv_id", "position", "step", "edit", F.concat_ws(":", "role", "text").alias("line"))
    ordered = lines.repartition("conv_id").sortWithinPartitions(*order)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        current, audit, held, empty = None, bytearray(), hashlib.sha256(), True

        def row(schema):
            columns = [[current], [audit.decode()], [held.hexdigest()]]
            arrays = [pa.array(c, t) for c, t in zip(columns, (schema, pa.string(), pa.string()))]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            schema, done = batch.schema.field("conv_id").type, []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "edit", "line")]
            for conv, letter, line in zip(*columns):
                if audit and conv != current:
                    done.append((current, audit.decode(), held.hexdigest()))
                    audit, held, empty = bytearray(), hashlib.sha256(), True
                current = conv
                audit += letter.encode()
                if letter != "D":
                    held.update((line if empty else f"\n{line}").encode())
                    empty = False
            if done:
                arrays = [pa.array(c, t) for c, t in zip(zip(*done), (schema, pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "audit", "repaired_sha256"])
        if audit:
            yield row(schema)

    return ordered.mapInArrow(digest, f"conv_id {key}, audit string, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """Drop, empty, cut, repeat or rerole rows, as the checksum of their place says."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    place = F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))
    number = F.crc32(place.cast("binary")) % 20
    text = F.when(number == 1, "").when(number == 2, F.translate(spaced("text"), ".!?", ""))
    copies = F.when(number == 3, 2).otherwise(1)
    return rows.where(number != 0).select(
        "conv_id",
        "turn",
        F.when(number == 4, "user").otherwise(spaced("role")).alias("role"),
        text.otherwise(spaced("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    )


def op12_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damages every conversation, repairs it and returns one row for each, also if none of its
    rows is left."""
    rows = table(spark, sf_dir, "conversations")
    damaged = damage(rows)
    repaired, decided = repair_conversations(damaged)
    turns = damaged.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id")
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    turns = turns.agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))

    out = rows.select("conv_id").distinct()
    for part in (turns, decided, repair_digests(repaired)):
        right = part.withColumnRenamed("conv_id", "__conv")
        out = out.join(right, out.conv_id.eqNullSafe(right["__conv"]), "left").drop("__conv")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        "conv_id",
        *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


SQL = {
    "op12_dialogue_repair": """
    WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda i: list_reduce(
            range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab),
    places AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations),
    sums AS (SELECT places.*, xor(4294967295, list_reduce(list_transform(string_split(place, ''), lambda x: ord(x)::BIGINT),
            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295)) % 20 AS number FROM places, bits),
    damaged AS (SELECT conv_id, turn, CASE number WHEN 4 THEN 'user' ELSE role END AS role,
            CASE number WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
            unnest(range(CASE number WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM sums),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
    judged AS (SELECT *, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before,
            CASE WHEN NOT regexp_matches(text, '[^ \t-\r]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][ \t-\r]*$') THEN 'truncated' ELSE '' END AS fault FROM placed),
    step(q, r, z) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    added(q, z, letters, lines) AS (VALUES (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''),
            (0, 2, 'I', 'user:'), (1, 2, 'I', 'user:'), (2, 3, 'I', 'assistant:'), (3, 2, 'I', 'user:'),
            (0, 3, 'II', 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', 'user:' || chr(10) || 'assistant:')),
    moves AS (SELECT a.q, s.z, s.r, a.letters, a.lines FROM added a JOIN step s ON s.q = a.z),
    ways AS (SELECT DISTINCT conv_id, 0::BIGINT AS n, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM damaged
        UNION ALL
        (SELECT conv_id, n, z, cost, audit, lines FROM (
            SELECT w.conv_id, j.n, e.z, w.cost + e.cost AS cost, w.audit || e.audit AS audit, list_concat(w.lines, e.lines) AS lines,
                row_number() OVER (PARTITION BY w.conv_id, e.z ORDER BY w.cost + e.cost, w.audit || e.audit) AS best
            FROM ways w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.n = w.n + 1
            JOIN (SELECT conv_id, n, q, q AS z, 4 AS cost, 'D' AS audit, []::VARCHAR[] AS lines
                    FROM judged, (VALUES (0), (1), (2), (3)) v(q)
                UNION ALL SELECT conv_id, n, m.q, m.z, 3 * length(m.letters) + 3 * (fault = 'truncated')::INT, m.letters || 'K',
                    list_concat(CASE m.lines WHEN '' THEN [] ELSE [m.lines] END, [role || ':' || text])
                    FROM judged j JOIN moves m ON m.r = j.r WHERE fault NOT IN ('blank', 'duplicate')
                UNION ALL SELECT conv_id, n, m.q, m.z, 3 + 3 * length(m.letters) + 3 * (fault = 'truncated')::INT, m.letters || 'R',
                    list_concat(CASE m.lines WHEN '' THEN [] ELSE [m.lines] END,
                        [CASE m.r WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text])
                    FROM judged j JOIN moves m ON m.r IN ('u', 'a') WHERE fault NOT IN ('blank', 'duplicate')) e
            ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND e.n = j.n AND e.q = w.q) WHERE best = 1)),
    ended AS (SELECT w.conv_id, cost + 3 * length(a.letters) AS cost, audit || a.letters AS audit,
            list_concat(w.lines, CASE a.lines WHEN '' THEN [] ELSE [a.lines] END) AS lines
        FROM ways w JOIN (SELECT conv_id, max(n) AS n FROM judged GROUP BY conv_id) l
            ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.n = w.n
        JOIN added a ON a.q = w.q AND (a.z = 3 OR (a.q = 0 AND a.z = 0))),
    best AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS place FROM ended),
    counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated,
            count(*) FILTER (n > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
        coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
        coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
        sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
    """
}
