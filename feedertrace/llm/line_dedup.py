"""Repeated runs of lines: a suffix array over line-ID sequences by prefix doubling, and its common-prefix intervals.

Lines that occur once in the corpus cannot stand in a repeat; the others get the rank of their kind as line ID. Prefix
doubling then ranks suffixes: round ``k + 1`` sorts the distinct pairs (rank of the first ``2 ** k`` lines, rank of the
``2 ** k`` lines behind them) by range and numbers them in order, so that a rank is a place in the order of suffixes by
their first ``2 ** (k + 1)`` lines. A prefix that is unique has no rank, and its suffix leaves the later rounds; rounds
go on until every prefix is unique, so until the longest repeat of the corpus is passed.

Suffixes of equal rank in round ``k`` are the interval of those with a common prefix of at least ``2 ** k`` lines. The
intervals of other lengths come from a descent: from the longest round to the first, an interval of length ``l`` is split
by the ranks of the ``2 ** k`` lines at ``l`` into those of length ``l + 2 ** k``. A suffix moves into the longer
interval if that begins with a copy which lies before it and does not overlap it. If not, it stays, and leaves a stand-in in the longer
one, as it may be the first copy of yet longer ones. Whoever moves needs no stand-in: the interval's first copy serves in
its place. At the end each suffix has the longest prefix that has an earlier copy; those are the maximal repeats, and
from ``min_words`` words on they are deleted as later copies.

Everything here is DataFrame functions. Groups are reduced to a first place and a count by partial aggregation, and what
is joined back to the many copies of a frequent line is a separate table, so that adaptive execution can split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedertrace.session import materialize

_WORD = r"[^\x20\x09-\x0D]+"


def _key() -> list[Column]:
    """Two columns that tell documents apart: rows equal in doc_id and text are one document."""
    return [F.xxhash64(F.col("doc_id").isNull(), "doc_id").alias("_a"), F.xxhash64("text").alias("_b")]


def _lines(docs: DataFrame) -> DataFrame:
    """_a, _b, _doc, idx (among the lines with words), x and y (128 bits that name the line), words."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(_WORD))
    rows = docs.select(*_key(), F.col("doc_id").alias("_doc"), F.posexplode(lines).alias("idx", "line"))
    return rows.select("_a", "_b", "_doc", "idx", F.xxhash64("line").alias("x"), F.xxhash64(F.lit(1), "line").alias("y"), F.regexp_count("line", F.lit(_WORD)).cast("long").alias("words"))


def _ranked(keys: DataFrame, by: list[str], label: str) -> DataFrame:
    """``keys`` with ``rank``, in the order of ``by``: partitions are ranges and ids grow from one to the next."""
    return materialize(keys.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id()), label)


def _positions(docs: DataFrame, min_words: int) -> DataFrame:
    """_a, _b, _doc, idx, to (words up to here), r (line ID) of the lines that occur again, where a stretch of such lines
    has ``min_words`` words at least."""
    lines = _lines(docs)
    shared = _ranked(lines.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("x", "y"), ["x", "y"], "lines")
    own = lines.join(shared, ["x", "y"]).groupBy("_a", "_b", "idx").agg(F.first("_doc").alias("_doc"), F.first("words").alias("words"), F.first("rank").alias("r"))
    own = own.withColumn("stretch", F.col("idx") - F.row_number().over(Window.partitionBy("_a", "_b").orderBy("idx")))
    stretch = Window.partitionBy("_a", "_b", "stretch")
    own = own.withColumn("all", F.sum("words").over(stretch)).withColumn("to", F.sum("words").over(stretch.orderBy("idx")))
    return materialize(own.where(F.col("all") >= min_words).select("_a", "_b", "_doc", "idx", "words", "to", "r"), "positions")


def suffix_ranks(positions: DataFrame) -> list[DataFrame]:
    """By round k: (_a, _b, idx, r), the rank of the ``2 ** k`` lines from idx on, where others have the same."""
    levels = [positions.select("_a", "_b", "idx", "r")]
    while True:
        half = 1 << (len(levels) - 1)
        then = Window.partitionBy("_a", "_b").orderBy("idx").rangeBetween(half, half)
        pairs = levels[-1].withColumn("then", F.first("r").over(then)).where("then IS NOT NULL")
        again = pairs.groupBy("r", "then").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("r", "then")
        ranks = _ranked(again, ["r", "then"], f"ranks-{len(levels)}")
        if ranks.isEmpty():
            return levels
        levels.append(materialize(pairs.join(ranks, ["r", "then"]).select("_a", "_b", "idx", F.col("rank").alias("r")), f"suffixes-{len(levels)}"))


def longest_earlier(positions: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(_a, _b, idx, l): of each suffix, the lines of its longest prefix that has an earlier copy without overlap."""
    state = positions.select("_a", "_b", "_doc", "idx", F.lit(0).alias("l"), F.lit(0).cast("long").alias("g"), F.lit(True).alias("own"))
    for k in reversed(range(len(levels))):
        far = levels[k].select("_a", "_b", F.col("idx").alias("_at"), "r")
        state = materialize(state.withColumn("_at", F.col("idx") + F.col("l")).join(far, ["_a", "_b", "_at"], "left").drop("_at"), f"at-{k}")
        place = F.struct(F.col("_doc").isNull().alias("n"), F.col("_doc").alias("d"), "_b", "_a", "idx")
        groups = state.where("r IS NOT NULL").groupBy("g", "r").agg(F.min(place).alias("m"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
        # An interval's name: 0 is the whole array; ids of a level don't meet those of another.
        groups = materialize(groups.withColumn("to", (F.monotonically_increasing_id() + 1) * 64 + k), f"intervals-{k}")
        found = state.where("r IS NOT NULL").join(groups, ["g", "r"], "left")
        there = (F.col("m._a") == F.col("_a")) & (F.col("m._b") == F.col("_b"))
        length = F.col("l") + F.lit(1 << k)
        moves = F.coalesce(~there | (F.col("m.idx") + length <= F.col("idx")), F.lit(False))
        stay = F.struct("l", "g", "own")
        longer = lambda own: F.struct(length.alias("l"), F.col("to").alias("g"), own.alias("own"))
        rows = F.when(F.col("to").isNull(), F.array(stay)).when(moves, F.array(longer(F.col("own")))).otherwise(F.array(stay, longer(F.lit(False))))
        found = found.select("_a", "_b", "_doc", "idx", F.explode(rows).alias("s")).select("_a", "_b", "_doc", "idx", "s.*")
        state = state.where("r IS NULL").drop("r").unionByName(found)
    return state.where("own AND l > 0").select("_a", "_b", "idx", "l")


def repeated_runs(docs: DataFrame, *, min_words: int = 8) -> DataFrame:
    """The later copies of maximal repeats: _a, _b (``_key``), low, high (positions among the lines with words,
    inclusive). No run lies within another; two of a document may overlap."""
    positions = _positions(docs, min_words)
    found = longest_earlier(positions, suffix_ranks(positions)).withColumn("high", F.col("idx") + F.col("l") - 1)
    ends = positions.select("_a", "_b", F.col("idx").alias("high"), F.col("to").alias("end"))
    begins = positions.select("_a", "_b", "idx", (F.col("to") - F.col("words")).alias("before"))
    found = found.join(ends, ["_a", "_b", "high"]).join(begins, ["_a", "_b", "idx"]).where(F.col("end") - F.col("before") >= min_words)
    reached = F.max("high").over(Window.partitionBy("_a", "_b").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("reached", reached).where("reached IS NULL OR high > reached")
    return materialize(found.select("_a", "_b", F.col("idx").alias("low"), "high"), "runs")


def dedup_lines(docs: DataFrame, *, min_words: int = 8) -> DataFrame:
    """``docs`` (doc_id, text and any others) with later copies of repeated line runs deleted from ``text``, and with
    the columns n_lines and n_deleted (which replace columns of that name).

    Lines are split at \\n. A run counts from ``min_words`` words on; lines without a word are no part of a run and stay.
    The first copy is that of the smallest doc_id (nulls last; then by the text's hash), then of the first line. Copies
    within a document count too, but only where they start behind the first one's end, so a run that repeats itself keeps
    one whole copy. What is deleted depends on the input alone: a run whose first copy loses lines, as these are a copy of
    something earlier, is still deleted elsewhere. A document all of whose lines are copies keeps its row, with an empty
    text; a null or empty text stays as it is with no lines deleted. Rows equal in doc_id and text are one document and
    get the same text. Texts of any length are taken whole. An empty table gives an empty one.
    """
    runs = repeated_runs(docs, min_words=min_words)
    # Runs of a document may overlap: each gives the lines behind what those before it reach.
    reached = F.max("high").over(Window.partitionBy("_a", "_b").orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("low", F.greatest("low", F.coalesce(reached + 1, F.lit(0))))
    gone = runs.select("_a", "_b", F.sequence("low", "high").alias("i")).groupBy("_a", "_b").agg(F.flatten(F.collect_list("i")).alias("_gone"))
    keyed = docs.drop("n_lines", "n_deleted", "_a", "_b", "_gone").select("*", *_key()).join(gone, ["_a", "_b"], "left").drop("_a", "_b")
    lines = F.split("text", "\n")
    worded = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(_WORD), i)), lambda i: i.isNotNull())

    def left(own: Column) -> Column:
        # own: the lines and the places of those with words; bound here, they are made once.
        gone_at = F.transform("_gone", lambda i: F.element_at(own["worded"], i + 1))
        at = F.array_except(F.sequence(F.lit(0), F.size(own["lines"]) - 1), gone_at)
        return F.array_join(F.transform(at, lambda i: F.element_at(own["lines"], i + 1)), "\n")

    kept = F.element_at(F.transform(F.array(F.struct(lines.alias("lines"), worded.alias("worded"))), left), 1)
    out = keyed.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))).withColumn("n_deleted", F.coalesce(F.size("_gone"), F.lit(0)))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept)
    names = [c for c in docs.columns if c not in ("n_lines", "n_deleted", "_a", "_b", "_gone")]
    return out.select(*(text.alias("text") if c == "text" else F.col(c) for c in names), "n_lines", "n_deleted")
