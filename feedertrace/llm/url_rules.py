"""URL filters: stated rules, and association rules mined from what those say.

Stated rules give a verdict to the URLs they fit. These URLs are the labelled transactions: the tokens of host, path and
query, with the verdict as one more item. FP-growth finds the token combinations frequent enough; rules from tokens to
a verdict stay if their confidence is high enough and no rule with fewer tokens is as confident. What cannot be in such
a rule is left out before: see ``mine_rules``. Each rule is listed in
an inverted index under its rarest token. URLs are reduced to the tokens of rules and collapsed to distinct token sets
before they are matched, so a host with a third of all URLs is a row per task, and the verdicts are joined back.

Everything here is DataFrame functions and Spark's FP-growth.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedertrace.session import materialize

#: (verdict, host, path). A rule fits its host and all subdomains where the URL's path starts with the rule's.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse_url(url: Column) -> tuple[Column, Column]:
    """(host, path): from behind the first :// up to / ? # or the end, A-Z lower-cased; then up to ? # or the end."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """The distinct tokens: the host's ending (t:), path segments that are no number (p:), host labels before the ending
    (h:), their parts at hyphens (w:), the file's ending (x:) and query names (q:).

    A token stands for its kind, not its place. A URL has as many as its text gives.
    """
    labels = F.split(host, r"\.")
    named = F.filter(F.slice(labels, 1, F.greatest(F.lit(0), F.size(labels) - 1)), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda s: (s != "") & ~s.rlike(r"\A[0-9]+(\.[A-Za-z]{1,5})?\z"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    parts = [
        F.when(host != "", F.array(F.concat(F.lit("t:"), F.element_at(labels, -1)))).otherwise(F.array().cast("array<string>")),
        F.transform(segments, lambda s: F.concat(F.lit("p:"), s)),
        F.transform(named, lambda x: F.concat(F.lit("h:"), x)),
        F.transform(F.filter(F.flatten(F.transform(F.filter(named, lambda x: F.contains(x, F.lit("-"))), lambda x: F.split(x, "-"))), lambda x: x != ""), lambda x: F.concat(F.lit("w:"), x)),
        F.transform(F.regexp_extract_all(path, F.lit(r"(\.[A-Za-z]{1,5})\z"), F.lit(1)), lambda s: F.concat(F.lit("x:"), F.lower(s))),
        F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("q:"), F.element_at(F.split(x, "="), 1))),
    ]
    return F.array_distinct(F.concat(*parts))


def stated(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for said, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def mine_rules(labelled: DataFrame, *, min_support: float = 0.002, min_confidence: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(tokens, verdict, confidence, support) from ``labelled`` (tokens, verdict), pruned; and (t, k): each token of
    rules with the one that stands for it there.

    ``min_support`` is a share of the labelled URLs. A rule goes if another of the same verdict with a part of its
    tokens is at least as confident. Nothing labelled gives no rules.

    Three things make the itemsets few and lose no rule. A token too rare with every verdict is in none. Tokens of the
    same labelled URLs make the same rules, and no kept rule has two of them: one stands for all. A token that always
    comes with one verdict is a rule, and beats every longer one that holds it.
    """
    labelled = labelled.where("verdict is not null")
    n = labelled.count()
    # FP-growth needs a row at least; one without tokens supports nothing.
    if not n:
        none = labelled.sparkSession.sql("SELECT array('') AS tokens, '' AS verdict, 0D AS confidence, 0D AS support WHERE false")
        return none, none.select(F.col("verdict").alias("t"), F.col("verdict").alias("k"))
    rows = labelled.groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select(F.explode("tokens").alias("t"), "verdict", "n", F.xxhash64("tokens", "verdict").alias("a"), F.xxhash64("verdict", "tokens").alias("b"))
    rows = rows.groupBy("t", "verdict").agg(F.sum("n").alias("hits"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    rows = rows.groupBy("t").agg(F.sum("hits").alias("freq"), F.max("hits").alias("hits"), F.max_by("verdict", "hits").alias("verdict"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    rows = rows.where(F.col("hits") >= math.ceil(min_support * n))
    rows = rows.groupBy("freq", "hits", "verdict", "a", "b").agg(F.min("t").alias("k"), F.collect_list("t").alias("ts"))
    stands = materialize(rows.select("k", "verdict", "hits", "freq", F.explode("ts").alias("t")), "tokens")
    one = stands.where("t = k")
    sure = one.where("hits = freq").select(F.array("k").alias("tokens"), "verdict", F.lit(1.0).alias("confidence"), (F.col("hits") / n).alias("support"))
    mixed = F.broadcast(one.where("hits < freq").agg(F.collect_list("k").alias("mixed")))
    items = labelled.join(mixed).select(F.concat(F.array_intersect("tokens", "mixed"), F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    # Of all frequent combinations those with a verdict are rules; their token lists' own counts give the confidence.
    sets = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(items).freqItemsets
    sets = materialize(sets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    said = F.filter("items", lambda x: x.startswith("="))
    both = sets.where(F.size(said) == 1).select(F.filter("items", lambda x: ~x.startswith("=")).alias("tokens"), F.substring(F.element_at(said, 1), 2, 1000).alias("verdict"), F.col("freq").alias("hits"))
    alone = sets.where(F.size(said) == 0).select(F.col("items").alias("tokens"), "freq")
    rules = both.where(F.size("tokens") > 0).join(alone, "tokens").select("tokens", "verdict", (F.col("hits") / F.col("freq")).alias("confidence"), (F.col("hits") / n).alias("support")).where(F.col("confidence") >= min_confidence)
    rules = materialize(rules.union(sure), "rules")
    # Each rule meets the rules whose first token it holds.
    part = rules.select(F.col("tokens").alias("few"), F.col("verdict").alias("v"), F.col("confidence").alias("c"), F.element_at("tokens", 1).alias("k"))
    keyed = rules.withColumn("k", F.explode("tokens"))
    beaten = keyed.join(part, (keyed.k == part.k) & (keyed.verdict == F.col("v")) & (F.size("few") < F.size("tokens")) & (F.col("c") >= F.col("confidence")) & (F.size(F.array_except("few", "tokens")) == 0))
    beaten = beaten.select(F.col("tokens").alias("_t"), "v").distinct()
    kept = materialize(rules.join(beaten, (rules.tokens == F.col("_t")) & (rules.verdict == F.col("v")), "left_anti"), "kept-rules")
    return kept, stands.join(kept.select(F.explode("tokens").alias("k")).distinct(), "k", "left_semi").select("t", "k")


def match_rules(sets: DataFrame, rules: DataFrame, stands: DataFrame) -> DataFrame:
    """``sets`` (distinct ``tokens``) with the verdict of the most confident rule that each holds, by the tokens that
    ``stands`` (t, k) has for its own; then of the one with
    most support, then of the larger token list; a tie between verdicts goes to block. Sets that no rule fits are left out."""
    # A token's frequency among the rules stands for its frequency among what they are matched with.
    df = rules.select(F.explode("tokens").alias("k"), "support").groupBy("k").agg(F.max("support").alias("df"))
    rarest = rules.withColumn("k", F.explode("tokens")).join(df, "k").groupBy("tokens", "verdict", "confidence", "support").agg(F.min_by("k", F.struct("df", "k")).alias("k"))
    index = rarest.select("k", F.col("tokens").alias("need"), "verdict", "confidence", "support")
    held = sets.withColumn("t", F.explode("tokens")).join(stands, "t").groupBy("tokens").agg(F.collect_set("k").alias("held"))
    hit = held.withColumn("k", F.explode("held")).join(index, "k").where(F.size(F.array_except("need", "held")) == 0)
    return hit.groupBy("tokens").agg(F.max_by("verdict", F.struct("confidence", "support", F.size("need"), "verdict")).alias("mined"))


def judge_urls(pages: DataFrame, *, rules: tuple[tuple[str, str, str], ...] = RULES, min_support: float = 0.002, min_confidence: float = 0.8, default: str = "allow") -> DataFrame:
    """Per row of ``pages`` (page_id, url; other columns are not read): page_id, host, path, rule, verdict, and by: what
    the verdict is from ('stated', 'mined' or 'default').

    A null url, or one without ://, has an empty host and path: no stated rule fits it. Repeated rows and rows with a
    null page_id each give a row, an empty table an empty one. A URL that no rule fits gets ``default``.
    """
    host, path = parse_url(F.col("url"))
    own = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = stated(F.col("host"), F.col("path"), rules)
    own = own.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"), url_tokens(F.col("host"), F.col("path"), F.col("url")).alias("tokens"))
    own = materialize(own, "urls")
    mined, stands = mine_rules(own.where("said is not null").select("tokens", F.col("said").alias("verdict")), min_support=min_support, min_confidence=min_confidence)
    # The tokens of rules: bounded by the rules, which their support bounds.
    known = F.broadcast(stands.agg(F.collect_set("t").alias("known")))
    # A set is told by its text: arrays as keys are compared item by item.
    rest = own.where("said is null").join(known).withColumn("tokens", F.array_sort(F.array_intersect("tokens", "known"))).drop("known")
    verdicts = materialize(match_rules(rest.select("tokens").distinct(), mined, stands), "verdicts")
    rest = rest.join(verdicts, "tokens", "left").select("page_id", "host", "path", "rule", F.coalesce("mined", F.lit(default)).alias("verdict"), F.when(F.col("mined").isNull(), "default").otherwise("mined").alias("by"))
    return own.where("said is not null").select("page_id", "host", "path", "rule", F.col("said").alias("verdict"), F.lit("stated").alias("by")).union(rest)
