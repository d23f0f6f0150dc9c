"""URL rules by expressions and hash prefixes.

Every URL is expanded into its host suffixes (at dots) times its path prefixes. An expression joins the rules on the
first four bytes of its SHA-256; equal full digests confirm the match, and the longest matching rule gives the verdict.
Only suffixes of as many labels and prefixes of as many characters as some rule has are expanded, so the number
of expressions of a URL is bounded by the rules, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import ascii_lower, saved, small_or_shuffled

BROADCAST_RULES = 200_000
#: The verdict of a URL that no rule fits.
DEFAULT = "allow"

# The rules of the registered query as (host, path, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def _digest(host: Column, path: Column) -> Column:
    # The length keeps host and path apart.
    return F.sha2(F.concat_ws(":", F.length(host).cast("string"), F.concat(host, path)), 256)


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, 8)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def prepared(rules: DataFrame) -> DataFrame:
    """Distinct rules with digests; of one host and path with both verdicts, block counts."""
    return (
        rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IN ('allow', 'block')")
        .groupBy(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.max("verdict").alias("rule_verdict"))
        .withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("prefix", _prefix(F.col("digest")))
    )


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule (host and path of the longest rule that fits, or null), verdict.

    The longest rule is that with most characters, then the longest host, then the first by name. A null URL, or one
    without ``://``, has an empty host and path, which no rule with a host fits. Repeated rows are judged each; an
    empty table of pages gives no rows, and without rules all are allowed. Other columns are ignored.
    """
    known = saved(prepared(rules), "rules")
    shapes = known.agg(
        F.collect_set(F.struct(_labels(F.col("rule_host")).alias("labels"), F.length("rule_path").alias("chars")))
    ).first()[0]
    host, path = split_url(F.col("url"))
    # Equal rows go through the join once, however many there are.
    urls = (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .groupBy("page_id", "host", "path").agg(F.count(F.lit(1)).alias("copies"))
    )
    parts = F.split("host", r"\.")
    expressions = [
        F.when(
            (F.size(parts) >= s["labels"]) & (F.length("path") >= s["chars"]),
            _digest(
                F.substring_index("host", ".", -s["labels"]), F.substring(F.col("path"), 1, s["chars"])
            ),
        )
        for s in sorted(shapes)
    ]
    expanded = urls.withColumn(
        "own", F.explode_outer(F.filter(F.array(*expressions), lambda x: x.isNotNull()))
    ) if expressions else urls.withColumn("own", F.lit(None).cast("string"))
    found = expanded.withColumn("own_prefix", _prefix(F.col("own"))).join(
        small_or_shuffled(known, BROADCAST_RULES),
        (F.col("own_prefix") == F.col("prefix")) & (F.col("own") == F.col("digest")),
        "left",
    )
    name = F.concat("rule_host", "rule_path")
    order = F.struct(
        F.length(name).alias("n"), F.length("rule_host").alias("h"),
        # The first by name is the greatest of the negated code points, as max_by takes the greatest.
        F.transform(F.split(name, ""), lambda c: -F.ascii(c)).alias("c"),
    )
    best = F.max_by(
        F.struct(name.alias("rule"), F.col("rule_verdict").alias("verdict")),
        F.when(F.col("rule_host").isNotNull(), order),
    )
    return (
        found.groupBy("page_id", "host", "path", "copies").agg(best.alias("best"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            "page_id", "host", "path", F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"),
        )
    )
