"""URL filters: host-suffix and path-prefix expressions met with a rule table by short hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.common import lower_ascii, split_join, table

#: Hexadecimal digits of the digest that the join uses; the full digest is compared after it.
SHORT = 8

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(F.coalesce(found, F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host and
    all subdomains if the path starts with its own; the longest host and path wins, and block
    wins between rules of one length. No rule: null and ``default``.

    Each distinct (host, path) is expanded into those suffixes and prefixes whose label count
    and length occur among the rules, so a long URL costs no more than the rules' shapes. The
    expressions meet the rules on the first digits of their SHA-256 and the full digests
    confirm. A host with a third of the rows is one expression per distinct path; the rule side
    is broadcast only if the planner finds it small.

    Null, empty or malformed URLs have an empty host and path and fit no rule. Repeated rows
    stay. Rules with a null part are ignored. Columns of ``pages`` named like the new ones are
    replaced.
    """
    pages = pages.withColumn("__url", F.col(url)).drop("host", "path", "rule", "verdict")
    keyed = pages.withColumns({"host": url_host(F.col("__url")), "path": url_path(F.col("__url"))})
    keyed = keyed.drop("__url")

    rules = rules.select("host", "path", "verdict").dropna()
    rules = rules.select(
        lower_ascii(F.col("host")).alias("host"), "path", "verdict"
    ).select(
        F.size(F.split("host", r"\.")).alias("labels"),
        F.length("path").alias("chars"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    # A rule set has few shapes, whatever its size: label counts times path lengths.
    shapes = [tuple(r) for r in rules.select("labels", "chars").distinct().collect()]
    rules = rules.withColumn("digest", F.sha2("rule", 256))
    rules = rules.withColumn("short", F.substring("digest", 1, SHORT)).drop("labels", "chars")

    labels = F.split("host", r"\.")
    expressions = [
        F.when(
            (F.size(labels) >= n) & (F.length("path") >= chars),
            F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring("path", 1, chars)),
        )
        for n, chars in sorted(shapes)
    ]
    nothing = F.lit(None).cast("string")
    expanded = (
        keyed.select("host", "path")
        .where("host <> ''")
        .distinct()
        .select("host", "path", F.explode(F.array_compact(F.array(*expressions, nothing))).alias("e"))
        .select("host", "path", F.sha2("e", 256).alias("full"))
        .withColumn("short", F.substring("full", 1, SHORT))
    )
    best = F.max(
        F.struct(F.length("rule").alias("n"), (F.col("verdict") == "block").alias("b"), "rule", "verdict")
    )
    judged = (
        expanded.join(rules, "short")
        .where("full = digest")
        .groupBy("host", "path")
        .agg(best.alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    out = split_join(keyed, judged, ["host", "path"], "left")
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)

SQL = {
    "op8_url_filters": rf"""
    WITH rules(rh, rp, rv) AS (VALUES {_RULES_SQL}),
    u AS (SELECT row_number() OVER () AS rid, page_id,
            CASE WHEN url LIKE '%://%' THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
          FROM pages),
    k AS (SELECT rid, page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
    m AS (SELECT rid, rh || rp AS rule, rv, row_number() OVER (
            PARTITION BY rid ORDER BY length(rh || rp) DESC, rv DESC) AS place
          FROM k JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
    SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
    FROM k LEFT JOIN (SELECT * FROM m WHERE place = 1) USING (rid)
    """
}
