"""Template automata against a plain search, mark-up errors, and edge cases of the scan."""

import random
import re

import pytest

from silverloom.llm.licenses import BASE, TEMPLATES, Scanner, Template, scan_licenses

DOC = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))


def as_pattern(template):
    """The same wording as a regular expression over words that each end in a blank."""
    out = ""
    for part in re.findall(r"<<[^>]*>>|[^\s<]+", template.text):
        if part.startswith("<<var"):
            least, most = re.findall(r"\d+", part)
            out += f"(?:[^ ]+ ){{{least},{most}}}"
        else:
            marks = {"<<beginOptional>>": "(?:", "<<endOptional>>": ")?"}
            out += marks.get(part) or "(?:" + "|".join(part.split("/")) + ") "
    return re.compile(out)


def longest_ends(pattern, words, start):
    """The longest match; the expression alone would give the first in its own order."""
    for end in range(len(words), start, -1):
        if pattern.fullmatch("".join(f"{w} " for w in words[start:end])):
            return end
    return None


def spelled(template, rng):
    """A text that the template accepts."""
    out, skipping = [], []
    for part in re.findall(r"<<[^>]*>>|[^\s<]+", template.text):
        if part == "<<beginOptional>>":
            skipping.append(rng.random() < 0.5)
        elif part == "<<endOptional>>":
            skipping.pop()
        elif any(skipping):
            continue
        elif part.startswith("<<var"):
            least, most = map(int, re.findall(r"\d+", part))
            out += [rng.choice(["Acme", "the", "x1"]) for _ in range(rng.randint(least, most))]
        else:
            out.append(rng.choice(part.split("/")).title())
    return out


def test_templates_accept_their_wording_and_nothing_less():
    rng = random.Random(5)
    for template in TEMPLATES:
        scanner = Scanner([template])
        pattern = as_pattern(template)
        for _ in range(12):
            words = spelled(template, rng)
            whole = f"Before: {', '.join(words)}! After."
            assert scanner.places(scanner.numbers(whole.encode())), template.name
            broken = list(words)
            broken[rng.randrange(len(broken))] = "Zebra"
            lowered = plain_words(" ".join(broken))
            want = [
                (i, end)
                for i in range(len(lowered))
                if (end := longest_ends(pattern, lowered, i))
            ]
            got = scanner.places(scanner.numbers(" ".join(broken).encode()))
            assert [(first, after) for _, first, after in got] == want, template.name


def test_regions_against_expressions():
    rng = random.Random(6)
    marked = [
        "a b <<beginOptional>>c <<beginOptional>>d<<endOptional>><<endOptional>> <<var;words=0-2>> e",
        "a <<beginOptional>>b<<endOptional>> <<beginOptional>>c<<endOptional>> d/e",
        "b <<var;words=1-3>> <<var;words=2-2>> a",
        "<<beginOptional>>a<<endOptional>> b c",
        "c",
    ]
    templates = [Template(f"t{i}", f"l{i}", text) for i, text in enumerate(marked)]
    scanner = Scanner(templates)
    patterns = [as_pattern(t) for t in templates]
    for _ in range(300):
        words = [rng.choice("abcdez") for _ in range(rng.randrange(12))]
        want = {
            (t.name, i, end)
            for t, pattern in zip(templates, patterns)
            for i in range(len(words))
            if (end := longest_ends(pattern, words, i))
        }
        got = scanner.places(scanner.numbers(" ".join(words).encode()))
        assert {(a.template.name, i, end) for a, i, end in got} == want, words
        assert len(got) == len(want)


@pytest.mark.parametrize(
    "text",
    [
        "a <<beginOptional>>b",
        "a b<<endOptional>>",
        "<<beginOptional>>a<<endOptional>>",
        "<<var;words=1-2>> a",
        "a <<var;chars=3>> b",
        "",
    ],
)
def test_faulty_mark_up_is_refused(text):
    with pytest.raises(ValueError):
        Scanner([Template("t", "l", text)])


def test_scan_edges(spark):
    long = "lorem ipsum " * 300_000 + "MIT\tLicense " + "cc-by " * 50_000
    rows = [
        (1, None),
        (2, ""),
        (3, " \n.;"),
        (4, "GNU General Public License"),
        (4, "GNU General Public License"),
        (None, "Licensed under the Apache License, Version 2.0."),
        (6, "mit licenseé mit-license"),
        (7, long),
    ]
    frame = spark.createDataFrame(rows, DOC).selectExpr("*", "'x' AS places", "1 AS n_words", "2 AS `a.b`")
    got = scan_licenses(frame)
    assert got.columns == ["doc_id", "text", "a.b", "n_words", "places"]
    found = {}
    for r in got.collect():
        found.setdefault(r.doc_id, []).append((r.n_words, [(p.label, p.first, p.after) for p in r.places]))
    assert found[1] == found[2] == found[3] == [(0, [])]
    assert found[4] == [(4, [("gpl", 0, 4)])] * 2
    assert found[None] == [(8, [("apache-2.0", 0, 8), ("apache", 3, 5)])]
    assert found[6] == [(4, [("mit", 2, 4)])]
    ((n, places),) = found[7]
    assert n == 600_000 + 2 + 100_000
    assert places[0] == ("mit", 600_000, 600_002) and len(places) == 50_001
    assert scan_licenses(frame.limit(0)).collect() == []


def test_base_phrases_are_the_given_ones():
    assert {(t.text, t.label) for t in BASE} == {
        ("gnu general public license", "gpl"),
        ("apache license", "apache"),
        ("cc by", "cc-by"),
        ("mit license", "mit"),
    }
