"""URL filtering by association rules, in DataFrame operations and Spark ML only.

Given rules (host and path prefix, the longest that fits wins) judge the urls they fit, and these
verdicts are the labels. FP-growth mines token combinations of the labelled urls; the rules
``tokens -> verdict`` that are confident, lift the verdict's own share by more than chance would (a one-sided
test of the share, ``min_z`` deviations) and beat all their immediate sub-rules judge the other urls. A combination that
is part of a given rule's own host and path says nothing: the labels were chosen by it, so no label could speak
against it. Rules are matched by an inverted index on each rule's rarest token.

Tokens of a url: scheme, labels of the host, path segments and query names, digits written as #.

Scale: urls are reduced to their distinct token sets before rules are matched, so a hot host is a few
rows there. FP-growth runs on at most about ``max_labelled`` labelled rows, taken by a hash of url and row, so a hot url
gives its share; a token combination must be in ``min_support`` of them, which bounds the rules whatever the number
of urls. Token sets of more than 1 / ``HOT_SETS`` of all rows, at most that many, are broadcast to their rows, the others
joined by a shuffle. All urls are judged.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and has no
tokens, so it is allowed; repeated rows and null ids are judged alike; an empty table gives an empty
result; without labelled urls, all others are allowed. Of rules that match, the most confident decides,
then the best supported, then block, then the first by its tokens.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import ascii_lower, materialize

#: (host, path prefix, verdict): fixed values of the task.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.002, 0.95, 1.05
MIN_Z = 2.33
MAX_LABELLED = 500_000
#: Token sets that are broadcast at most.
HOT_SETS = 1000


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; of equally long ones, that with the longer host."""
    name = verdict = F.lit(None).cast("string")
    for site, prefix, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(prefix)
        name = F.when(fits, F.lit(site + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column) -> Column:
    """The sorted distinct tokens of a url; none without ``://``."""

    def named(kind: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(kind), F.regexp_replace(p, "[0-9]+", "#")))

    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    tokens = F.concat(
        named("scheme:", F.array(ascii_lower(F.substring_index(url, "://", 1)))),
        named("host:", F.split(host_of(url), r"\.")),
        named("path:", F.split(path_of(url), "/")),
        named("query:", names),
    )
    return F.when(F.contains(url, F.lit("://")), F.array_sort(F.array_distinct(tokens))).otherwise(F.array().cast("array<string>"))


def restates(tokens: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Whether all tokens, schemes apart, are of one given rule's host and path."""
    rest = F.filter(tokens, lambda t: ~t.startswith("scheme:"))
    parts = [
        F.array(*(F.lit(f"host:{p}") for p in site.split(".") if p), *(F.lit("path:" + re.sub("[0-9]+", "#", p)) for p in prefix.split("/") if p))
        for site, prefix, _ in rules
    ]
    return reduce(lambda a, b: a | b, [F.size(F.array_except(rest, own)) == 0 for own in parts], F.lit(False))


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
    min_z: float = MIN_Z,
    max_labelled: int = MAX_LABELLED,
    rules: list[tuple[str, str, str]] | None = None,
) -> DataFrame:
    """(tokens, verdict, confidence, support, rarest) from rows of (url, tokens, verdict); ``rules`` are those
    the verdicts come from."""
    labelled = materialize(labelled.select("tokens", "verdict", F.xxhash64("url", F.monotonically_increasing_id()).alias("place")))
    count = labelled.count()
    if count > max_labelled:
        labelled = labelled.filter(F.pmod("place", F.lit(1_000_000)) < int(1_000_000 * max_labelled / count))
        count = labelled.count()
    items = labelled.select(F.array_append("tokens", F.concat(F.lit("="), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    share = F.col("confidence") / F.col("lift")  # of the verdict among all labels
    held = F.col("support") * count / F.col("confidence")  # rows with the tokens
    found = model.associationRules.filter(
        F.col("consequent")[0].startswith("=")
        & ~F.exists("antecedent", lambda t: t.startswith("="))
        & (F.col("lift") >= min_lift)
        & ((F.col("confidence") - share) * F.sqrt(held) >= min_z * F.sqrt(share * (1 - share)) - 1e-9)
        & ~restates(F.col("antecedent"), rules or [])
    )
    rules = materialize(
        found.select(
            F.array_sort("antecedent").alias("tokens"),
            F.substring(F.col("consequent")[0], 2, 100).alias("verdict"),
            "confidence",
            "support",
        )
    )
    # A rule must be more confident than each rule that has one token less.
    less = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token")).select(
        "tokens", "verdict", "confidence", F.array_remove("tokens", F.col("token")).alias("general")
    )
    general = rules.select(F.col("tokens").alias("general"), "verdict", F.col("confidence").alias("reached"))
    beaten = less.join(general, ["general", "verdict"]).filter("reached >= confidence").select("tokens", "verdict").distinct()
    kept = rules.join(beaten, ["tokens", "verdict"], "left_anti")
    single = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    indexed = kept.select("*", F.explode("tokens").alias("token")).join(single, "token")
    return materialize(
        indexed.groupBy("tokens", "verdict").agg(
            F.first("confidence").alias("confidence"), F.first("support").alias("support"), F.min_by("token", F.struct("freq", "token")).alias("rarest")
        )
    )


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined): of each token set the verdict of the best rule in it; only sets with one."""
    index = rules.select(F.col("rarest").alias("token"), F.col("tokens").alias("needs"), "verdict", "confidence", "support")
    hits = sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    hits = hits.filter(F.size(F.array_except("needs", "tokens")) == 0)
    order = F.struct("confidence", "support", F.col("verdict") == "block", "verdict")
    return hits.groupBy("tokens").agg(F.max_by("verdict", order).alias("mined"))


def judge(
    pages: DataFrame,
    url_col: str = "url",
    rules: list[tuple[str, str, str]] | None = None,
    **options,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and mined (whether a mined rule decided)."""
    added = {"host", "path", "rule", "verdict", "mined"}
    pages = pages.select(*(F.col(f"`{c}`") for c in pages.columns if c.lower() not in added))
    rules = RULES if rules is None else rules
    url = F.col(url_col)
    name, verdict = given_rule(F.col("host"), F.col("path"), rules)
    # A row's columns travel in a struct, so that none of them can clash with the ones worked with here.
    read = pages.select(F.struct(*pages.columns).alias("row"), url.alias("url"))
    parts = read.select("row", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), url_tokens(F.col("url")).alias("tokens"))
    parts = parts.select("*", name.alias("rule"), verdict.alias("given"))
    labelled = parts.filter("given IS NOT NULL").select("url", "tokens", F.col("given").alias("verdict"))
    rest = parts.filter("given IS NULL AND size(tokens) > 0").groupBy("tokens").agg(F.count("*").alias("n"))
    mined = mine(labelled, rules=rules, **options)
    found = materialize(match_rules(rest.select("tokens"), mined).join(rest, "tokens"))
    often = pages.count() / HOT_SETS
    hot = F.broadcast(found.filter(F.col("n") > often).select("tokens", "mined"))
    cold = found.filter(F.col("n") <= often).select("tokens", "mined")
    # Only urls without a given verdict need a mined one.
    open_ = F.col("given").isNull()
    undecided = parts.filter(open_).join(hot, "tokens", "left_anti").join(cold, "tokens", "left")
    out = parts.filter(~open_).withColumn("mined", F.lit(None).cast("string")).unionByName(
        parts.filter(open_).join(hot, "tokens")
    ).unionByName(undecided)
    return out.select(
        "row.*",
        "host",
        "path",
        "rule",
        F.coalesce("given", "mined", F.lit("allow")).alias("verdict"),
        (F.col("given").isNull() & F.col("mined").isNotNull()).alias("mined"),
    )
