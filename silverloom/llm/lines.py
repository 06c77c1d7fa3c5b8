"""Quality rules: text statistics and the frequency of lines across the documents of a host."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.common import SPACE, lower_ascii, split_join, stored, table, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
#: A line is common if more distinct texts of its host have it than either bound allows.
COMMON_TEXTS = 10
COMMON_SHARE = 0.05
#: A document is depleted if fewer of its words than this share are left without common lines.
MIN_LEFT = 0.2

_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(f"[^{SPACE}]"))


def normal_line(line: Column) -> Column:
    """A-Z lower-cased, runs of ASCII white space as one blank, none at the ends."""
    return lower_ascii(F.trim(F.regexp_replace(line, f"[{SPACE}]+", " ")))


def text_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all long).

    A repeated three-word window is found by sorting the hashes of a text's windows, so a long
    text costs n log n; each window start covers the words up to the next, three at most.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    step = df.withColumns({"__words": words(F.col(text)), "__lines": lines_with_words(F.col(text))})
    n = F.size("__words")

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get("__words", i + k) for k in range(3)])

    step = step.withColumns(
        {
            "__at": F.when(
                n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)
            ).otherwise(F.array().cast("array<bigint>")),
            "n_words": n.cast("long"),
            "word_chars": F.length(F.translate(whole, " \t\n\x0b\f\r", "")).cast("long"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        }
    ).drop("__words", "__lines")
    # Most texts repeat no window; only the others are sorted with positions.
    some = F.size(F.array_distinct("__at")) < F.size("__at")
    placed = F.sort_array(F.transform("__at", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("__at", F.when(some, placed))

    def repeated(x: Column, i: Column) -> Column:
        same = [F.get("__at", j)["h"] == x["h"] for j in (i - 1, i + 1)]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("__at", repeated), lambda x: x["i"]))
    step = step.withColumn("__at", starts)
    covered = F.aggregate(
        F.transform(
            "__at", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("__at", i + 1) - x, F.lit(3)))
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    return step.withColumn(
        "n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")
    ).drop("__at")


def _host_key(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("h"), host.cast("string")), F.lit(""))


def _text_keys(df: DataFrame, text: str, host: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns(
        {
            "__host": _host_key(F.col(host)),
            "__t1": F.xxhash64(whole),
            "__t2": F.crc32(whole.cast("binary")),
        }
    )


def _lines(docs: DataFrame, text: str, host: str, scratch: str | None) -> DataFrame:
    """Place, hash and words of each line with words, once for each distinct text of a host: copies
    of a text count once, so that a text is not held against itself."""
    keyed = _text_keys(docs, text, host)
    found = (
        keyed.select(
            "__host",
            "__t1",
            "__t2",
            F.posexplode(
                F.transform(
                    F.split(F.coalesce(F.col(text), F.lit("")), "\n"),
                    lambda x: F.struct(
                        F.xxhash64(normal_line(x)).alias("line"), F.size(words(x)).alias("n")
                    ),
                )
            ).alias("pos", "at"),
        )
        .select("__host", "__t1", "__t2", "pos", "at.line", "at.n")
        .where("n > 0")
        .distinct()
    )
    return stored(found, "lines", scratch)


def _often(lines: DataFrame) -> DataFrame:
    """Hashes of the common lines of each host."""
    one = F.count(F.lit(1))
    texts = (
        lines.select("__host", "__t1", "__t2").distinct().groupBy("__host").agg(one.alias("texts"))
    )
    return (
        lines.select("__host", "line", "__t1", "__t2")
        .distinct()
        .groupBy("__host", "line")
        .agg(one.alias("having"))
        .where(F.col("having") > COMMON_TEXTS)
        .join(texts, "__host")
        .where(F.col("having") > F.col("texts") * COMMON_SHARE)
        .select("__host", "line")
    )


def common_lines(
    docs: DataFrame, text: str = "text", host: str = "source", scratch: str | None = None
) -> DataFrame:
    """Words of the common lines, for each distinct text of a host that has any.

    Returns ``__host, __t1, __t2, __common`` (long). Lines travel as hashes; a line that a third
    of the documents has is counted partially before it is moved, and its rows can be split in
    the join.
    """
    lines = _lines(docs, text, host, scratch)
    held = split_join(lines, _often(lines), ["__host", "line"], "left_semi")
    return held.groupBy("__host", "__t1", "__t2").agg(F.sum("n").alias("__common"))


def host_lines(
    docs: DataFrame, text: str = "text", host: str = "source", scratch: str | None = None
) -> DataFrame:
    """``__host`` and ``__often``, the hashes of the host's common lines.

    These are few: more than 5 % of the host's texts have each, so there are less than 20 times
    as many as a text has lines on average. The table grows with the hosts and not with their
    texts, and is broadcast unless there are very many hosts.
    """
    often = _often(_lines(docs, text, host, scratch))
    return often.groupBy("__host").agg(F.collect_list("line").alias("__often"))


def _marked(docs: DataFrame, often: DataFrame, text: str, host: str) -> DataFrame:
    """Add ``__places``, where a text split at line feeds has lines of the host (from 0, null if
    it has none), and ``__common``, their words. No text is moved unless ``often`` is too large to
    be broadcast.

    The host's lines and the text's are sorted together, so a long text costs n log n: a run of
    equal hashes that begins with the host's (-1) holds places of a common line.
    """
    keyed = docs.withColumn("__host", _host_key(F.col(host)))
    step = split_join(keyed, often, ["__host"], "left").drop("__host")
    step = step.withColumn("__parts", F.when(F.col("__often").isNotNull(), F.split(F.col(text), "\n")))
    step = step.withColumn(
        "__hashes", F.transform("__parts", lambda x: F.xxhash64(normal_line(x)))
    )
    step = step.withColumn("__held", F.array_intersect("__hashes", "__often")).drop("__often")

    def pair(h: Column, i: Column) -> Column:
        return F.struct(h.alias("h"), i.alias("i"))

    both = F.concat(F.transform("__held", lambda h: pair(h, F.lit(-1))), F.transform("__hashes", pair))
    step = step.withColumn("__at", F.when(F.size("__held") > 0, F.sort_array(both)))
    step = step.drop("__held", "__hashes")
    starts = F.filter(
        F.sequence(F.lit(0), F.size("__at") - 1),
        lambda k: (k == 0) | (F.get("__at", k)["h"] != F.get("__at", k - 1)["h"]),
    )
    step = step.withColumn("__runs", F.when(F.col("__at").isNotNull(), starts))

    def places(k: Column, r: Column) -> Column:
        end = F.coalesce(F.get("__runs", r + 1), F.size("__at"))
        run = F.transform(F.slice("__at", k + 2, end - k - 1), lambda x: x["i"])
        return F.when(F.get("__at", k)["i"] < 0, run).otherwise(F.array().cast("array<int>"))

    step = step.withColumn("__places", F.flatten(F.transform("__runs", places)))
    counted = F.transform("__places", lambda i: F.size(words(F.get("__parts", i))))
    step = step.withColumn("__common", F.aggregate(counted, F.lit(0), lambda a, x: a + x))
    return step.drop("__parts", "__at", "__runs")


def remove_common_lines(
    docs: DataFrame, text: str = "text", host: str = "source", scratch: str | None = None
) -> DataFrame:
    """Every row of ``docs``, its text without the lines common to the host (see
    :func:`judge_quality`). All other lines, blank ones too, stay as they are, in order.

    Common lines are looked up, and each text is rebuilt, within its row.
    """
    often = stored(host_lines(docs, text, host, scratch), "common")
    return _cleaned(_marked(docs, often, text, host), text).select(*docs.columns)


def _cleaned(marked: DataFrame, text: str) -> DataFrame:
    # A column of its own, so that a text is split once and not once a line.
    parts = F.when(F.col("__places").isNotNull(), F.split(F.col(text), "\n"))
    step = marked.withColumn("__parts", parts)
    left = F.array_except(F.sequence(F.lit(0), F.size("__parts") - 1), F.col("__places"))
    rest = F.array_join(F.transform(left, lambda i: F.get("__parts", i)), "\n")
    return step.withColumn(text, F.when(F.col("__parts").isNull(), F.col(text)).otherwise(rest))


def judge_quality(
    docs: DataFrame, text: str = "text", host: str = "source", scratch: str | None = None
) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept.

    ``base_failed``: fewer than 50 words, or over half of them in repeated three-word windows.
    ``kept``: false for those and for depleted documents, of whose words less than a fifth stands
    outside lines common to the host (more than 10 of its distinct texts, and more than 5 %).

    Null and empty texts have no words and fail; documents without a host form a host of their
    own; repeated rows get the same verdict and count once. The common words of the texts are
    stored in between, so the planner knows whether they are small enough to broadcast.
    Columns of ``docs`` named like the new ones are replaced. To drop documents use
    :func:`keep_good`: a filter on ``kept`` would be pushed into the statistics and repeat them.
    """
    new = [*_STATS, "base_failed", "kept"]
    docs = docs.drop(*[c for c in docs.columns if c in new])
    common = stored(common_lines(docs, text, host, scratch), "common")
    return _judged(docs, common, text, host).select(*docs.columns, *new)


def _judged(docs: DataFrame, common: DataFrame, text: str, host: str) -> DataFrame:
    keys = ["__host", "__t1", "__t2"]
    return _verdict(split_join(_text_keys(text_stats(docs, text), text, host), common, keys, "left"))


def _verdict(counted: DataFrame) -> DataFrame:
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n)
    left = n - F.coalesce("__common", F.lit(0))
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (left >= n * MIN_LEFT)
    )


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that :func:`judge_quality` keeps, without the lines common to the host.

    Common lines are those of all the documents, rejected ones too. A text is judged and rebuilt
    where it is read: only hashes of lines are moved. Rejected rows leave by an explode of
    nothing, which unlike a filter is not pushed into the statistics and repeats none.
    """
    taken = {*_STATS, "base_failed", "kept"}
    names = {c: f"__own_{c}" for c in docs.columns if c.lower() in taken}
    text, host = names.get(text, text), names.get(host, host)
    used = docs.withColumnsRenamed(names)
    often = stored(host_lines(used, text, host), "common")
    judged = _verdict(text_stats(_marked(used, often, text, host), text))
    one = F.explode(F.when(F.col("kept"), F.array(F.lit(True)))).alias("__kept")
    good = judged.select(*used.columns, "__places", one).drop("__kept")
    return _cleaned(good, text).select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judge_quality(docs).select("doc_id", *_STATS, "base_failed", "kept")


def op10_clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return remove_common_lines(docs).select("doc_id", "text")


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase

SQL = {
    "op10_quality_rules": rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS host,
          coalesce(text, '') AS body,
          regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS w,
          list_filter(string_split(coalesce(text, ''), chr(10)),
                      lambda x: regexp_matches(x, '[^{SPACE}]')) AS ls
        FROM documents),
    g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
          FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
    r AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, three) AS c FROM g) WHERE c > 1),
    rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r)
            GROUP BY rid),
    ln AS (SELECT rid, host, body, len(regexp_extract_all(line, '[^{SPACE}]+')) AS n,
             translate(trim(regexp_replace(line, '[{SPACE}]+', ' ', 'g')), '{_UPPER}', '{_LOWER}') AS line
           FROM (SELECT rid, host, body, unnest(ls) AS line FROM d)),
    texts AS (SELECT host, count(DISTINCT body) AS texts FROM ln GROUP BY host),
    often AS (SELECT host, line FROM
        (SELECT host, line, count(DISTINCT body) AS having_it FROM ln GROUP BY host, line)
        JOIN texts USING (host)
        WHERE having_it > {COMMON_TEXTS} AND having_it > texts * {COMMON_SHARE}),
    gone AS (SELECT rid, sum(n) AS n FROM ln SEMI JOIN often USING (host, line) GROUP BY rid),
    s AS (SELECT doc_id, len(w)::BIGINT AS n_words,
        length(regexp_replace(body, '[{SPACE}]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(body, '[^{SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0) AS gone
      FROM d LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
      NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words)
        AND n_words - gone >= n_words * {MIN_LEFT} AS kept
    FROM s
    """,
    "op10_clean_texts": rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS host, text
        FROM documents),
    ps AS (SELECT rid, host, text, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS place
           FROM (SELECT *, string_split(coalesce(text, ''), chr(10)) AS parts FROM d)),
    ln AS (SELECT rid, host, text, place, part, regexp_matches(part, '[^{SPACE}]') AS full_line,
             translate(trim(regexp_replace(part, '[{SPACE}]+', ' ', 'g')), '{_UPPER}', '{_LOWER}') AS line
           FROM ps),
    texts AS (SELECT host, count(DISTINCT text) AS texts FROM ln WHERE full_line GROUP BY host),
    often AS (SELECT host, line FROM
        (SELECT host, line, count(DISTINCT text) AS having_it FROM ln WHERE full_line GROUP BY host, line)
        JOIN texts USING (host)
        WHERE having_it > {COMMON_TEXTS} AND having_it > texts * {COMMON_SHARE}),
    rest AS (SELECT rid, string_agg(part, chr(10) ORDER BY place) AS body
             FROM ln ANTI JOIN often USING (host, line) GROUP BY rid)
    SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(body, '') END AS text
    FROM d LEFT JOIN rest USING (rid)
    """,
}
