"""URL filters by hashed host-suffix and path-prefix expressions.

A url is expanded into every (host suffix, path prefix) that a rule of its shape could name: suffixes with as many
labels and prefixes with as many characters as some rule has. The expressions meet the rules in an equi-join on the
first bytes of their SHA-256 alone; among the rules of that prefix a full digest confirms, and the longest rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
PREFIX_DIGITS = 8  # hexadecimal: four bytes
# Shapes (labels, characters) that are spelled out as literals; with more, urls are expanded into all their own shapes.
MOST_SHAPES = 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = ((ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/"))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Rules (verdict, ``host/path``) as a table; any DataFrame of these columns will do."""
    return spark.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string")


def judge(urls: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """``urls`` (column url) with host, path, rule and verdict, one row per distinct url.

    The longest rule that fits wins, then the one with the longer host, then block before allow. Without a fitting
    rule: rule null and ``default``. A null url or one without ``://`` has empty host and path, and fits no rule.

    Hot urls are one row before any join; a hot expression is on many urls, and the join splits it by size at run
    time, or Spark broadcasts a rule table it has measured as small. Rules of more than MOST_SHAPES shapes are met by
    all host suffixes and path prefixes of a url, with the same result.
    """
    cut = F.instr("rule", "/")
    known = rules.where(F.col("rule").isNotNull() & (cut > 0)).select(
        "verdict", "rule", F.expr("substring(rule, 1, instr(rule, '/') - 1)").alias("rule_host"),
        F.expr("substring(rule, instr(rule, '/'))").alias("rule_path"),
    ).select(
        "verdict", "rule", F.length("rule_host").alias("host_length"), F.size(F.split("rule_host", r"\.")).alias("labels"),
        F.length("rule_path").alias("path_length"), F.sha2("rule", 256).alias("digest"),
    )
    # At most MOST_SHAPES + 1 pairs of small numbers, whatever the number of rules.
    shapes = [(r[0], r[1]) for r in known.select("labels", "path_length").distinct().limit(MOST_SHAPES + 1).collect()]
    parsed = urls.select("url").distinct().select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not shapes:
        return parsed.select("url", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    split = parsed.withColumn("parts", F.split("host", r"\."))
    shape = lambda labels, length: F.struct(labels.alias("labels"), length.alias("length"))
    if len(shapes) <= MOST_SHAPES:
        wanted = F.array(*[shape(F.lit(n), F.lit(m)) for n, m in shapes])
    else:
        lengths = F.when(F.col("path") != "", F.sequence(F.lit(1), F.length("path"))).otherwise(F.array().cast("array<int>"))
        wanted = F.flatten(F.transform(F.sequence(F.lit(1), F.size("parts")), lambda n: F.transform(lengths, lambda m: shape(n, m))))
    spelled = F.transform(
        wanted,
        lambda s: F.when(
            (F.size("parts") >= s["labels"]) & (F.length("path") >= s["length"]),
            F.concat(
                F.array_join(F.slice("parts", F.size("parts") - s["labels"] + F.lit(1), s["labels"]), "."),
                F.substring(F.col("path"), F.lit(1), s["length"]),
            ),
        ),
    )
    short = lambda c: F.substring(c, 1, PREFIX_DIGITS)
    expressions = split.select("url", F.explode(F.array_distinct(F.array_compact(spelled))).alias("expression")).select(
        "url", F.sha2("expression", 256).alias("url_digest")
    ).withColumn("url_prefix", short(F.col("url_digest")))
    # Rules of one prefix are few: different ones share 32 bits by chance, equal ones are one entry.
    of_prefix = known.groupBy(short(F.col("digest")).alias("prefix")).agg(
        F.collect_set(F.struct("digest", "host_length", "rule", "verdict")).alias("rules")
    )
    confirmed = F.transform(
        F.filter("rules", lambda r: r["digest"] == F.col("url_digest")),
        lambda r: F.struct(
            F.length(r["rule"]).alias("length"), r["host_length"].alias("host_length"), (r["verdict"] == BLOCK).alias("blocks"),
            r["rule"].alias("rule"), r["verdict"].alias("verdict"),
        ),
    )
    met = expressions.join(of_prefix, F.col("url_prefix") == F.col("prefix")).select("url", F.array_max(confirmed).alias("fit"))
    best = met.where(F.col("fit").isNotNull()).groupBy(F.col("url").alias("judged")).agg(F.max("fit").alias("best"))
    return parsed.join(best, F.col("url") == F.col("judged"), "left").select(
        "url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")
    )


def filter_pages(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and verdict; every row is kept, repeated ones too."""
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"))
    judged = judge(rows, rules, default)
    joined = rows.join(judged, rows["url"].eqNullSafe(judged["url"]), "left")
    return joined.select("page_id", "host", "path", "rule", "verdict")
