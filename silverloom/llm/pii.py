"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.common import lower_ascii, table

#: Characters before and after a span in which context words are looked for.
NEARBY = 40
#: Score that a span of a kind outside the base must reach.
THRESHOLD = 0.6
_CONTEXT = 0.3
_CHECKED = 0.4
#: Code points of a page of a text, in which a place is found without walking the whole text.
_PAGE = 512

_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _is_address(match: Column) -> Column:
    octet = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return match.rlike(rf"^{octet}\.{octet}\.{octet}\.{octet}$")


def _is_card(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)


def _is_phone(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _is_iban(match: Column) -> Column:
    """The number, its first four places moved to the end, leaves 1 when divided by 97."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(rest: Column, place: Column) -> Column:
        value = F.instr(F.lit(_DIGITS), place) - 1
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    rest = F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), step)
    return F.length(plain).between(15, 34) & (rest == 1)


@dataclass(frozen=True)
class Kind:
    """``hint`` finds texts worth searching; ``valid`` drops matches; ``checksum`` says whether
    ``valid`` was one; spans of a ``base`` kind stay whatever their score."""

    name: str
    hint: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    checksum: bool = False
    base: bool = True


# A match starts where a run of its characters starts or where the last match ended; the same
# spans as without that condition, but a long run without a match is read once. Possessive
# groups keep long matches off the stack.
KINDS = (
    Kind(
        "email",
        "@",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        0.7,
        "mail|contact|write|address",
    ),
    Kind(
        "ip",
        r"[0-9]\.[0-9]",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _is_address,
        0.6,
        r"\bip\b|host|server|address|network",
    ),
    Kind(
        "card",
        "[0-9][ -]?[0-9]",
        "[0-9](?:[ -]?[0-9])++",
        _is_card,
        0.3,
        "card|credit|visa|master|payment|account",
        checksum=True,
    ),
    Kind(
        "phone",
        r"\+[0-9]",
        r"\+[0-9][ ().0-9-]+[0-9]",
        _is_phone,
        0.6,
        "phone|call|tel|mobile|fax|number",
    ),
    Kind(
        "iban",
        "[A-Z]{2}[0-9]{2}[ A-Z0-9]",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}"
        r"(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        _is_iban,
        0.3,
        "iban|account|bank|transfer|konto|compte|cuenta",
        checksum=True,
        base=False,
    ),
    Kind(
        "national_id",
        "[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda m: F.lit(True),
        0.4,
        r"\bssn\b|social security|national id|tax id",
        base=False,
    ),
)
BASE = tuple(k.name for k in KINDS if k.base)

_SPAN = "array<struct<start: int, kind_no: int, end: int, kind: string, score: double>>"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda acc, x: acc + x)


def _most(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda acc, x: F.greatest(acc, x))


def _with_levels(
    df: DataFrame, values: Mapping[str, Column], fold: Callable[[Column], Column]
) -> DataFrame:
    """Add, for each array of whole numbers, its numbers, their folds by 64 and those by 4,096.

    Each level is a projection of its own and is referred to more than once, so none is computed
    again inside a lambda.
    """

    def folds(name: str) -> Column:
        count = F.size(name)
        blocks = F.sequence(F.lit(0), F.shiftright(F.greatest(count - 1, F.lit(0)), 6))
        return F.transform(blocks, lambda b: fold(F.slice(F.col(name), b * 64 + 1, F.lit(64))))

    step = df.withColumns({f"{n}_0": v for n, v in values.items()})
    step = step.withColumns({f"{n}_1": folds(f"{n}_0") for n in values})
    step = step.withColumns({n: F.array(f"{n}_0", f"{n}_1", folds(f"{n}_1")) for n in values})
    return step.drop(*[f"{n}_{i}" for n in values for i in (0, 1)])


def _before(levels: Column, i: Column, fold: Callable[[Column], Column]) -> Column:
    """The fold of the first ``i`` numbers, of at most 64 numbers of the lower two levels each. No
    array grows inside a lambda, which Spark would copy for every item."""
    parts = [
        F.slice(levels[2], F.lit(1), F.shiftright(i, 12)),
        F.slice(levels[1], F.shiftright(i, 12) * 64 + 1, F.shiftright(i, 6).bitwiseAND(63)),
        F.slice(levels[0], F.shiftright(i, 6) * 64 + 1, i.bitwiseAND(63)),
    ]
    return fold(F.array(*[fold(p) for p in parts]))


def _pages(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PAGE}}}"), F.lit(0))


def _cut(pages: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to before ``end``, out of the pages that hold them."""
    first, last = F.floor(start / _PAGE).cast("int"), F.floor(end / _PAGE).cast("int")
    held = F.array_join(F.slice(pages, first + 1, last - first + 1), "")
    return F.substring(held, start - first * _PAGE + 1, end - start)


def _valid(kind: Kind) -> Callable[[Column], Column]:
    return lambda item: kind.valid(item["match"])


def _placed(ends: Column) -> Callable[[Column], Column]:
    def place(item: Column) -> Column:
        end = _before(ends, item["at"] + 1, _sum)
        return F.struct((end - F.length(item["match"])).alias("start"), end.alias("end"))

    return place


def _scored(number: int, kind: Kind, pages: Column) -> Callable[[Column], Column]:
    """The finished span: the kind's score, a confirmed checksum, and words nearby."""
    sure = kind.score + _CHECKED * kind.checksum

    def score(span: Column) -> Column:
        start, end = span["start"], span["end"]
        near = F.concat_ws(
            " ",
            _cut(pages, F.greatest(start - NEARBY, F.lit(0)), start),
            _cut(pages, end, end + NEARBY),
        )
        more = F.when(lower_ascii(near).rlike(kind.context), _CONTEXT).otherwise(0.0)
        return F.struct(
            start.alias("start"),
            F.lit(number).alias("kind_no"),
            end.alias("end"),
            F.lit(kind.name).alias("kind"),
            F.round(F.least(F.lit(1.0), F.lit(sure) + more), 3).alias("score"),
        )

    return score


def find_pii(df: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Add ``pii``: spans (start, kind_no, end, kind, score) by start, then kind, then end.

    Positions count code points, ends are exclusive. Matches are leftmost and do not overlap
    within a kind; those that fail their check are dropped without another try. The score is the
    kind's own, more for a confirmed checksum and for context words within 40 characters; kinds
    outside the base need 0.6. Everything is a column expression over the whole text: no row
    is exploded or shuffled, and the work grows with the text and its matches. Null and empty
    texts have no spans; repeated rows have the same ones; an empty table gives an empty one.
    A column named pii is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")
    found = {
        f"__found{i}": F.when(
            whole.rlike(k.hint), F.regexp_extract_all(whole, F.lit(k.pattern), F.lit(0))
        ).otherwise(none)
        for i, k in enumerate(kinds)
    }
    # The pieces between the matches, one more than matches, give their places.
    gaps = {
        f"__gaps{i}": F.when(F.size(f"__found{i}") > 0, F.split(whole, k.pattern)).otherwise(none)
        for i, k in enumerate(kinds)
    }
    matches = reduce(lambda a, b: a + b, [F.size(name) for name in found])
    gaps["__pages"] = F.when(matches > 0, _pages(whole)).otherwise(none)

    def length(gap: Column, match: Column) -> Column:
        return F.length(gap) + F.coalesce(F.length(match), F.lit(0))

    # Each step is a projection of its own, so that a lambda finds its inputs computed.
    step = df.withColumns(found).withColumns(gaps)
    lengths = {
        f"__ends{i}": F.zip_with(f"__gaps{i}", f"__found{i}", length) for i in range(len(kinds))
    }
    gaps.pop("__pages")
    step = _with_levels(step, lengths, _sum).drop(*gaps)
    placed, scored = {}, {}
    for i, k in enumerate(kinds):
        items = F.transform(
            f"__found{i}", lambda m, at: F.struct(at.alias("at"), m.alias("match"))
        )
        placed[f"__placed{i}"] = F.transform(F.filter(items, _valid(k)), _placed(F.col(f"__ends{i}")))
        spans = F.transform(f"__placed{i}", _scored(i, k, F.col("__pages")))
        kept = spans if k.base else F.filter(spans, lambda s: s["score"] >= THRESHOLD)
        scored[f"__scored{i}"] = kept.cast(_SPAN)
    step = step.withColumns(placed).drop(*found, *lengths)
    step = step.withColumns(scored).drop(*placed, "__pages")
    step = step.withColumn("pii", F.sort_array(F.concat(*scored)))
    return step.select(*[F.col(f"`{c}`") for c in df.columns if c != "pii"], "pii")


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def mask_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span of ``pii`` in ``text`` by its kind in brackets, overlaps by the first.

    Null texts stay null, texts without spans and empty texts as they are; repeated rows are
    masked alike and an empty table gives an empty one. The work grows with the text and its
    spans. Other columns are left alone.
    """
    pages, spans, ends = F.col("__pages"), F.col("__spans"), F.col("__ends")

    def cover(span: Column, i: Column) -> Column:
        """The span, and up to where the spans before it reach."""
        after = _before(ends, i, _most)
        return F.struct(after.alias("after"), span["start"].alias("start"), span["kind"].alias("kind"))

    def replaced(s: Column) -> Column:
        label = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.concat(_cut(pages, s["after"], s["start"]), label)

    held = F.size("pii") > 0
    whole = F.col(f"`{text}`")
    step = df.withColumn("__pages", F.when(held, _pages(whole)))
    step = _with_levels(step, {"__ends": F.transform("pii", lambda s: s["end"])}, _most)
    covered = F.filter(F.transform("pii", cover), lambda s: s["start"] >= s["after"])
    step = step.withColumn("__spans", covered)
    rest = _cut(pages, F.array_max(F.transform("pii", lambda s: s["end"])), F.length(whole))
    masked = F.concat(F.array_join(F.transform(spans, replaced), ""), rest)
    return step.withColumn(text, F.when(held, masked).otherwise(whole)).drop("__pages", "__spans", "__ends")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document with their scores. Null and empty texts have none (the digest of
    no bytes); repeated rows are reported each; an empty table gives an empty result."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("pii", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
        for k in BASE
    ]
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
