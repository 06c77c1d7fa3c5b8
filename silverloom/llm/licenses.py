"""License scans: marked-up templates compiled into token automata.

Mark-up follows the public license-list convention: ``<<beginOptional>> ... <<endOptional>>``
(which nest) and ``<<var;words=1-12>>`` for wording that may be replaced. All other words are
mandatory and must stand in the text exactly, one after the other; ``a/b`` accepts either word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.common import append_columns, table


@dataclass(frozen=True)
class Template:
    """Wording with mark-up, the label it stands for, and whether it is a base phrase."""

    name: str
    label: str
    text: str
    base: bool = False


# Phrases and labels that a scan reports in any case.
BASE = (
    Template("gpl-phrase", "gpl", "gnu general public license", True),
    Template("apache-phrase", "apache", "apache license", True),
    Template("cc-by-phrase", "cc-by", "cc by", True),
    Template("mit-phrase", "mit", "mit license", True),
)


def _gnu(label: str, version: str) -> Template:
    return Template(
        f"{label}-notice",
        label,
        "under the <<beginOptional>>terms of the<<endOptional>> gnu general public license "
        "<<beginOptional>>as published by the free software foundation<<endOptional>> "
        f"<<beginOptional>>either<<endOptional>> version {version} "
        "<<beginOptional>>of the license<<endOptional>> "
        "<<beginOptional>>or at your option any later version<<endOptional>>",
    )


def _commons(label: str, letters: str, long: str) -> tuple[Template, Template]:
    return (
        Template(f"{label}-short", label, f"cc {letters} 4 0 <<beginOptional>>international<<endOptional>>"),
        Template(
            f"{label}-notice",
            label,
            f"creative commons attribution {long} 4 0 <<beginOptional>>international<<endOptional>> "
            "<<beginOptional>>public<<endOptional>> license",
        ),
    )


_WARRANTY = (
    "is provided as is <<beginOptional>>without warranty of any kind express or implied "
    "including but not limited to the warranties of merchantability fitness for a particular "
    "purpose and noninfringement<<endOptional>>"
)

_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met <<beginOptional>>1<<endOptional>> "
    "redistributions of source code must retain the above copyright notice this list of conditions "
    "and the following disclaimer <<beginOptional>>2<<endOptional>> redistributions in binary form "
    "must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution"
)

# The mandatory wording of public licenses and of their usual notices.
NOTICES = (
    _gnu("gpl-2.0", "2"),
    _gnu("gpl-3.0", "3"),
    Template(
        "apache-2.0-notice",
        "apache-2.0",
        "licensed under the apache license version 2 0 <<beginOptional>>the license you may not use "
        "this file except in compliance with the license you may obtain a copy of the license at "
        "<<var;words=1-12>> unless required by applicable law or agreed to in writing software "
        "distributed under the license is distributed on an as is basis without warranties or "
        "conditions of any kind either express or implied<<endOptional>>",
    ),
    Template(
        "mit-notice",
        "mit-notice",
        "released/licensed/distributed under the <<beginOptional>>terms of the<<endOptional>> mit license",
    ),
    Template(
        "mit-text",
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute "
        "sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions the above copyright notice and this "
        "permission notice <<beginOptional>>including the next paragraph<<endOptional>> shall be "
        "included in all copies or substantial portions of the software <<beginOptional>>the software "
        + _WARRANTY
        + "<<endOptional>>",
    ),
    Template(
        "isc-text",
        "isc",
        "permission to use copy modify <<beginOptional>>and<<endOptional>> <<beginOptional>>or"
        "<<endOptional>> distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all "
        "copies",
    ),
    Template("bsd-2-text", "bsd-2-clause", _BSD + " <<beginOptional>>this software " + _WARRANTY + "<<endOptional>>"),
    Template(
        "bsd-3-text",
        "bsd-3-clause",
        _BSD + " <<beginOptional>>3<<endOptional>> neither the name of <<var;words=1-12>> nor the "
        "names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission",
    ),
    *_commons("cc-by-4.0", "by", ""),
    *_commons("cc-by-sa-4.0", "by sa", "sharealike"),
    *_commons("cc-by-nc-4.0", "by nc", "noncommercial"),
    *_commons("cc-by-nd-4.0", "by nd", "noderivatives"),
    Template(
        "mpl-2.0-notice",
        "mpl-2.0",
        "subject to the terms of the mozilla public license v/version 2 0",
    ),
    Template(
        "unlicense-text",
        "unlicense",
        "this is free and unencumbered software released into the public domain",
    ),
)

TEMPLATES = BASE + NOTICES

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Signs between words become blanks, capitals small letters; bytes of other characters stay.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if _WORD.match(bytes((b,))) else 32 for b in range(256)
)
_PIECE = 1 << 20


def text_words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class Automaton:
    """A template as a deterministic automaton over word numbers, 0 for all words of no template.

    Its regions make a non-deterministic automaton first; sets of its states become states when
    they are first met, of which there are finitely many.
    """

    def __init__(self, template: Template, number: dict[bytes, int]):
        self.template = template
        self._steps: list[dict[int | None, int]] = [{}]  # word (None: any) -> state
        self._skips: list[list[int]] = [[]]
        opened, last, self.mandatory = [], 0, 0
        for part in re.findall(r"<<[^>]*>>|[^\s<]+", template.text):
            if part == "<<beginOptional>>":
                opened.append(last)
            elif part == "<<endOptional>>":
                if not opened:
                    raise ValueError(f"{template.name}: an optional region ends that did not begin")
                self._skips[opened.pop()].append(last)
                # What follows must not be read as part of a skipped region's own skips.
                last = self._skip_to_new(last)
            elif region := re.fullmatch(r"<<var;words=(\d+)-(\d+)>>", part):
                least, most = map(int, region.groups())
                ends = []
                for k in range(most):
                    if k >= least:
                        ends.append(last)
                    last = self._step_to_new(last, [None])
                for state in ends:
                    self._skips[state].append(last)
            elif part.startswith("<<"):
                raise ValueError(f"{template.name}: unknown mark-up {part}")
            else:
                words = [number.setdefault(w.encode(), len(number) + 1) for w in part.split("/")]
                last = self._step_to_new(last, words)
                self.mandatory += not opened
        if opened:
            raise ValueError(f"{template.name}: an optional region does not end")
        self._accept = last
        self._sets: list[frozenset[int]] = []
        self._index: dict[frozenset[int], int] = {}
        self._next: list[dict[int, int]] = []
        self.accepts: list[bool] = []
        self.start = self._state({0})
        if self.accepts[self.start]:
            raise ValueError(f"{template.name}: no mandatory wording")
        self._known = {w for step in self._steps for w in step if w is not None}
        # The first two words of any accepted text; -1: any word, or the text's end.
        self.openings: set[tuple[int, int]] = set()
        for first in self._words_from(self.start):
            if first is None:
                raise ValueError(f"{template.name}: begins with a replaceable region")
            second = self._step(self.start, first)
            after = self._words_from(second)
            self.openings |= {(first, -1 if w is None else w) for w in after}
            if self.accepts[second]:
                self.openings.add((first, -1))

    def _step_to_new(self, state: int, words: Sequence[int | None]) -> int:
        self._steps.append({})
        self._skips.append([])
        self._steps[state].update(dict.fromkeys(words, len(self._steps) - 1))
        return len(self._steps) - 1

    def _skip_to_new(self, state: int) -> int:
        self._steps.append({})
        self._skips.append([])
        self._skips[state].append(len(self._steps) - 1)
        return len(self._steps) - 1

    def _state(self, states: set[int]) -> int:
        todo = list(states)
        while todo:
            for state in self._skips[todo.pop()]:
                if state not in states:
                    states.add(state)
                    todo.append(state)
        key = frozenset(states)
        if key not in self._index:
            self._index[key] = len(self._sets)
            self._sets.append(key)
            self._next.append({})
            self.accepts.append(self._accept in key)
        return self._index[key]

    def _words_from(self, state: int) -> set[int | None]:
        return {word for s in self._sets[state] for word in self._steps[s]}

    def _step(self, state: int, word: int) -> int:
        steps = [self._steps[s] for s in self._sets[state]]
        reached = {to for step in steps for to in (step.get(word), step.get(None)) if to is not None}
        return self._state(reached)

    def longest(self, numbers: np.ndarray, start: int) -> int:
        """Where the longest accepted stretch from ``start`` ends; -1 if there is none."""
        state, end, at = self.start, -1, start
        while self._sets[state]:
            if self.accepts[state]:
                end = at
            if at == len(numbers):
                break
            word = int(numbers[at])
            word = word if word in self._known else 0
            after = self._next[state].get(word)
            if after is None:
                after = self._next[state][word] = self._step(state, word)
            state, at = after, at + 1
        return end


class Scanner:
    """Finds every place where one of the templates is accepted."""

    def __init__(self, templates: Sequence[Template]):
        if len({t.name for t in templates}) < len(templates):
            raise ValueError("templates need names of their own")
        self.number: dict[bytes, int] = {}
        self.automata = [Automaton(t, self.number) for t in templates]
        self._by_opening: dict[tuple[int, int], list[Automaton]] = {}
        for automaton in self.automata:
            for opening in automaton.openings:
                self._by_opening.setdefault(opening, []).append(automaton)
        base = len(self.number) + 1
        self._base = base
        openings = np.zeros(base * base, bool)
        for first, second in self._by_opening:
            if second < 0:
                openings[first * base : (first + 1) * base] = True
            else:
                openings[first * base + second] = True
        self._opens = openings

    def numbers(self, text: bytes) -> np.ndarray:
        """Word numbers of a text, read piece by piece."""
        get, parts, at = self.number.get, [], 0
        while at < len(text):
            cut = at + _PIECE
            while cut < len(text) and _PLAIN[text[cut]] != 32:
                cut += 1
            words = text_words(text[at:cut])
            parts.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
            at = cut
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def places(self, numbers: np.ndarray) -> list[tuple[Automaton, int, int]]:
        """(automaton, first word, word after the last), by place, then in the templates' order."""
        if not len(numbers):
            return []
        pairs = numbers * self._base + np.append(numbers[1:], 0)
        found = []
        for start in np.flatnonzero(self._opens[pairs]).tolist():
            first = int(numbers[start])
            second = int(numbers[start + 1]) if start + 1 < len(numbers) else -1
            tried = self._by_opening.get((first, second), [])
            if second >= 0:
                tried = tried + self._by_opening.get((first, -1), [])
            for automaton in tried:
                end = automaton.longest(numbers, start)
                if end > 0:
                    found.append((automaton, start, end))
        return found


@lru_cache(maxsize=2)
def _scanner(templates: tuple[Template, ...]) -> Scanner:
    return Scanner(templates)


_PLACES = (
    "array<struct<template: string, label: string, base: boolean, mandatory: bigint, "
    "first: bigint, after: bigint>>"
)


def scan_licenses(
    df: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    text: str = "text",
    n_words: str = "n_words",
    places: str = "places",
) -> DataFrame:
    """Add a text's number of words and the places of its license wording.

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII;
    capitals A-Z count as small. A place names the template and its label, the number of the
    template's mandatory words, its first word and the word after its last. From every word on,
    the longest stretch that a template accepts is reported; stretches may overlap. By place,
    then in the order of the templates.

    Null and empty texts have no words and no places. Equal texts get equal results, rows are
    neither merged nor moved, an empty table gives an empty one, and columns named like the new
    ones are replaced. Row-local, without a shuffle; a task holds a batch of texts and four bytes
    for each word of one text, and a word begins at most one pass of a template's length.
    """
    if n_words == places:
        raise ValueError("the new columns need names of their own")
    templates = tuple(templates)
    _scanner(templates)  # faulty mark-up is reported here
    names = ("template", "label", "base", "mandatory", "first", "after")
    kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
    listed = pa.list_(pa.struct(list(zip(names, kinds))))

    def work(texts: pa.Array) -> Iterator[tuple[None, Sequence[pa.Array]]]:
        scanner = _scanner(templates)
        counts, found = [], []
        for value in texts:
            numbers = scanner.numbers(value.as_py() or b"")
            counts.append(len(numbers))
            rows = [
                (a.template.name, a.template.label, a.template.base, a.mandatory, first, after)
                for a, first, after in scanner.places(numbers)
            ]
            found.append([dict(zip(names, row)) for row in rows])
        yield None, [pa.array(counts, pa.int64()), pa.array(found, listed)]

    return append_columns(df, text, {n_words: "bigint", places: _PLACES}, work)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every document. The score is m / (m + 2) for the longest mandatory wording of m
    words that was found, 0 without any: two words may stand anywhere, a whole notice hardly."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("places", lambda p: p.base)
    starts = F.transform(base, lambda p: p["first"])
    joined = lambda ps: F.array_join(F.array_sort(F.array_distinct(F.transform(ps, lambda p: p.label))), ",")
    most = F.array_max(F.transform("places", lambda p: p.mandatory))
    return scan_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        F.coalesce(most / (most + 2), F.lit(0.0)).alias("score"),
    )


# The same wording as expressions over the words joined by blanks: (label, mandatory words, pattern).
_BSD_SQL = (
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met (1 )?redistributions of source code must retain "
    "the above copyright notice this list of conditions and the following disclaimer (2 )?"
    "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the distribution "
)
_PATTERNS = (
    ("gpl", 4, "gnu general public license "),
    ("apache", 2, "apache license "),
    ("cc-by", 2, "cc by "),
    ("mit", 2, "mit license "),
    *(
        (f"gpl-{v}.0", 8, "under the (terms of the )?gnu general public license (as published by the "
         f"free software foundation )?(either )?version {v} ")
        for v in (2, 3)
    ),
    ("apache-2.0", 8, "licensed under the apache license version 2 0 "),
    ("mit-notice", 5, "(released|licensed|distributed) under the (terms of the )?mit license "),
    ("mit-text", 87, "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files the software to deal in the software without restriction "
     "including without limitation the rights to use copy modify merge publish distribute sublicense and or "
     "sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
     "the following conditions the above copyright notice and this permission notice (including the next "
     "paragraph )?shall be included in all copies or substantial portions of the software "),
    ("isc", 32, "permission to use copy modify (and )?(or )?distribute this software for any purpose with or "
     "without fee is hereby granted provided that the above copyright notice and this permission notice "
     "appear in all copies "),
    ("bsd-2-clause", 68, _BSD_SQL),
    ("bsd-3-clause", 95, _BSD_SQL + "(3 )?neither the name of ([^ ]+ ){1,12}nor the names of its contributors "
     "may be used to endorse or promote products derived from this software without specific prior written "
     "permission "),
    *(
        row
        for label, letters, long in (
            ("cc-by-4.0", "by", ""),
            ("cc-by-sa-4.0", "by sa", "sharealike "),
            ("cc-by-nc-4.0", "by nc", "noncommercial "),
            ("cc-by-nd-4.0", "by nd", "noderivatives "),
        )
        for row in (
            (label, 3 + len(letters.split()), f"cc {letters} 4 0 "),
            (label, 6 + len(long.split()), f"creative commons attribution {long}4 0 (international )?(public )?license "),
        )
    ),
    ("mpl-2.0", 12, "subject to the terms of the mozilla public license (v|version) 2 0 "),
    ("unlicense", 11, "this is free and unencumbered software released into the public domain "),
)
_HITS = ", ".join(
    f"CASE WHEN regexp_matches(line, ' {pattern}') THEN {{'l': '{label}', 'm': {m}}} END"
    for label, m, pattern in _PATTERNS
)
_STARTS = ", ".join(
    "list_filter(range(1, n_words + 1), lambda i: " + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(t.text.split())) + ")"
    for t in BASE
)

SQL = {
    "op11_license_scan": rf"""
    WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    n AS (SELECT *, len(w)::BIGINT AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS line FROM t),
    s AS (SELECT *, list_sort(flatten([{_STARTS}])) AS starts, list_filter([{_HITS}], lambda h: h IS NOT NULL) AS hits FROM n),
    l AS (SELECT *, list_transform(hits, lambda h: h.l) AS names, list_max(list_transform(hits, lambda h: h.m)) AS m FROM s)
    SELECT doc_id, n_words, len(starts)::BIGINT AS n_base, starts[1] - 1 AS first_word, starts[-1] - 1 AS last_word,
        array_to_string(list_sort(list_distinct(list_filter(names, lambda x: x IN ('gpl', 'apache', 'cc-by', 'mit')))), ',') AS base_labels,
        array_to_string(list_sort(list_distinct(names)), ',') AS labels,
        coalesce(m::DOUBLE / (m + 2), 0) AS score
    FROM l
    """
}
