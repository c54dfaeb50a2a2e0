"""Quality rules with host verdicts.

Each document is measured once. Failures are counted by host, in partial sums, so a host with a third of all rows is one
row per task before it is shuffled. A beta prior fitted to the hosts' own failure rates (method of moments) shrinks the
rate of each; hosts with few documents stay near the corpus. Hosts whose shrunk rate reaches ``host_limit`` are
rejected as a whole, and the verdicts are joined back. The host table has a row per host: it is broadcast if it is
small enough by Spark's own statistics, and shuffled if not, with the rows of hot hosts salted so that no task gets them all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedertrace.session import materialize

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
SYMBOLS = "#*$%&|<>"
#: A host with over one in ``HOT`` of all rows is salted.
HOT = 1000
_HAS_WORD = re.compile(r"[^\x20\x09-\x0D]").search
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def measure(text: str | None, window: int = 5) -> tuple[int, int, int, int, int, int]:
    """The columns of ``MEASURES``."""
    text = text or ""
    words = text.encode().split()
    n_lines = n_dup = 0
    seen: set[str] = set()
    for line in text.split("\n"):
        if _HAS_WORD(line):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    chars = len(text) - sum(map(text.count, _SPACES))
    return len(words), chars, sum(map(text.count, SYMBOLS)), n_lines, n_dup, repeated(words, window)


def repeated(words: list[bytes], window: int) -> int:
    """How many words stand in a window that the text has twice or more."""
    grams = list(zip(*(islice(words, i, None) for i in range(window)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    once: set[tuple[bytes, ...]] = set()
    twice: set[tuple[bytes, ...]] = set()
    for g in grams:
        (twice if g in once else once).add(g)
    total = to = 0
    for i, g in enumerate(grams):
        if g in twice:
            total += i + window - max(i, to)
            to = i + window
    return total


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(d, s, *measure(t)) for d, s, t in zip(batch["doc_id"], batch["host"], batch["text"], strict=True)]
        yield pd.DataFrame(rows, columns=["doc_id", "host", *(x.split()[0] for x in MEASURES.split(", "))]).astype({"doc_id": "Int64"})


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rules_failed() -> Column:
    """Any rule: the base ones; over one symbol to ten words; over 30 % repeated lines; words of under 2 or over 20 characters on average."""
    return (
        base_failed()
        | (10 * F.col("n_symbols") > F.col("n_words"))
        | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))
        | (F.col("word_chars") < 2 * F.col("n_words"))
        | (F.col("word_chars") > 20 * F.col("n_words"))
    )


def host_rates(measured: DataFrame) -> DataFrame:
    """host, n, failed, rate (raw), shrunk: the mean of the host's failure rate under the prior of all hosts.

    With m and v the mean and the variance of the hosts' rates, the prior is beta with strength m (1 - m) / v - 1, held
    between 1 and 1000; a single host, or hosts of one rate, leave v at 0 and so the strength at 1000.
    """
    hosts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("bad"))
    hosts = hosts.withColumn("rate", F.col("bad") / F.col("n"))
    prior = hosts.agg(F.avg("rate").alias("m"), F.coalesce(F.var_pop("rate"), F.lit(0.0)).alias("v"))
    strength = F.when(F.col("v") < 1e-12, 1000.0).otherwise(F.least(F.lit(1000.0), F.greatest(F.lit(1.0), F.col("m") * (1 - F.col("m")) / F.greatest("v", F.lit(1e-12)) - 1)))
    prior = prior.select("m", strength.alias("strength"))
    # The prior is a single row.
    return hosts.join(F.broadcast(prior)).select("host", "n", "bad", "rate", ((F.col("bad") + F.col("m") * F.col("strength")) / (F.col("n") + F.col("strength"))).alias("shrunk"))


def judge(docs: DataFrame, *, host: str = "source", host_limit: float = 0.5, salts: int = 64) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and the column ``host``; others are not read): its measures,
    base_failed, failed (any rule), host_rate (shrunk) and kept.

    Kept is false if any rule fails or the host is rejected. A null text has no words and so fails. Rows of a null
    host share one host of their own. Repeated rows and rows of a null doc_id each give a row and count at their host.
    Texts of any length are measured whole. An empty table gives an empty one.
    """
    source = docs.select("doc_id", F.col(host).cast("string").alias("host"), "text")
    measured = materialize(source.mapInPandas(_measured, f"doc_id long, host string, {MEASURES}"), "measured")
    measured = measured.withColumn("failed", rules_failed())
    hosts = materialize(host_rates(measured).select(F.col("host").alias("_host"), "n", "shrunk"), "hosts")
    # Hosts with over 1 / HOT of all rows: fewer than HOT, whatever the corpus.
    total = hosts.agg(F.sum("n")).first()[0] or 0
    hot = [r._host for r in hosts.where(F.col("n") * HOT > total).select("_host").collect()]
    is_hot = lambda c: F.coalesce(c.isin([h for h in hot if h is not None]), F.lit(None in hot))
    copies = F.when(is_hot(F.col("_host")), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    hosts = hosts.select("_host", "shrunk", F.explode(copies).alias("_salt"))
    salt = F.when(is_hot(F.col("host")), F.monotonically_increasing_id() % salts).otherwise(0).cast("int")
    measured = measured.withColumn("_own", salt)
    out = measured.join(hosts, F.col("host").eqNullSafe(F.col("_host")) & (F.col("_own") == F.col("_salt")))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), "failed",
        F.col("shrunk").alias("host_rate"), (~F.col("failed") & (F.col("shrunk") < host_limit)).alias("kept"),
    )


#: The same over the table ``documents``, for DuckDB; the columns of the query.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS word, generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
g AS (SELECT *, [word, lead(word, 1) OVER s, lead(word, 2) OVER s, lead(word, 3) OVER s, lead(word, 4) OVER s] AS g5, lead(i, 4) OVER s AS whole FROM w WINDOW s AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, word, whole IS NOT NULL AND count(*) OVER (PARTITION BY r, g5, whole IS NULL) > 1 AS twice FROM g),
v AS (SELECT r, word, max(twice::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM c),
a AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, sum(covered) AS n_repeat_words FROM v GROUP BY r),
l AS (SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
m AS (SELECT r, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines FROM l GROUP BY r),
x AS (SELECT d.doc_id, d.source, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN a USING (r) LEFT JOIN m USING (r)),
y AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM x),
z AS (SELECT *, base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words AS failed FROM y),
h AS (SELECT source, count(*) AS n, sum(failed::INT) AS bad, sum(failed::INT) / count(*) AS rate FROM z GROUP BY source),
p AS (SELECT avg(rate) AS m, CASE WHEN coalesce(var_pop(rate), 0) < 1e-12 THEN 1000.0 ELSE least(1000.0, greatest(1.0, avg(rate) * (1 - avg(rate)) / greatest(var_pop(rate), 1e-12) - 1)) END AS k FROM h),
s AS (SELECT source, (bad + m * k) / (n + k) AS shrunk FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT failed AND shrunk < 0.5 AS kept
FROM z JOIN s ON z.source IS NOT DISTINCT FROM s.source
"""
