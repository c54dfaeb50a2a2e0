"""SimHash near-duplicates by multi-index hashing.

Fingerprints are 64 bits; documents with the same one are a class from the start. Classes link at ``distance`` or fewer
differing bits. A fingerprint is cut into segments; by the pigeonhole principle two linked ones differ, in one segment,
in at most ``distance // segments`` bits. So each class looks up, in each segment's table, all values of that small
Hamming ball, and what it finds is verified over all bits.

A segment value that very many classes share would give pairs without number. Its classes, and those that look it up,
are linked instead over complete fingerprints: two at ``distance`` d or less have a common point within d // 2 of one
and the rest of the other, so both list their balls of these radii and meet there. A point has 65 neighbours at radius
1 and 2,081 at radius 2, so no meeting is large. Nothing is capped: either way finds every link between its classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedertrace.llm.text import ascii_words, release, slices
from feedertrace.operators.graph import connected_components
from feedertrace.session import materialize

_LANES = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64 bits: each is 1 if over half of the shingles' hashes (XXH64, seed 42) have it; 0 without words."""
    import xxhash

    words = ascii_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": [fingerprint(x, shingle) for x in batch["text"]]})

    return run


def _ball(width: int, radius: int) -> list[int]:
    """Masks of ``width`` bits with at most ``radius`` ones."""
    from itertools import combinations

    return [sum(1 << i for i in ones) for r in range(radius + 1) for ones in combinations(range(width), r)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(classes: DataFrame, *, distance: int = 2, segments: int = 2, crowded: int = 64) -> DataFrame:
    """(src, dst) between distinct fingerprints ``fp`` of ``classes`` at ``distance`` or fewer bits, or with a common
    neighbour that both link to. ``crowded``: from how many classes on a segment value is linked the other way."""
    if not (0 <= distance <= 3 and 64 % segments == 0):
        raise ValueError("links are for distances up to 3 and segments of one width")
    width = 64 // segments
    values = [(F.shiftrightunsigned("fp", i * width) if i else F.col("fp")).bitwiseAND(F.lit((1 << width) - 1).cast("long")) for i in range(segments)]
    table = classes.select("fp", F.posexplode(F.array(*values)).alias("segment", "value"))
    ball = F.array(*(F.lit(m).cast("long") for m in _ball(width, distance // segments)))
    sizes = table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n"))
    # Spark takes an exploded table for as small as what it was made from and would broadcast it: these joins merge.
    table = materialize(table.join(sizes.hint("merge"), ["segment", "value"]).withColumn("crowded", F.col("n") > crowded).drop("n"), "segments")
    probes = table.select("segment", F.col("fp").alias("probe"), F.explode(F.transform(ball, lambda m: F.col("value").bitwiseXOR(m))).alias("value"))
    # Crowded values: who is there and who looks there, each once.
    busy = table.where("crowded").select("segment", "value").distinct()
    crowd = table.where("crowded").select("fp").union(probes.join(busy, ["segment", "value"], "left_semi").select(F.col("probe").alias("fp"))).distinct()
    quiet = table.where(~F.col("crowded")).select("segment", "value", "fp")
    close = quiet.hint("merge").join(probes, ["segment", "value"]).where((F.col("fp") < F.col("probe")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("probe"))) <= distance))
    # The smaller radius leads: two that have a point in it meet the larger radius of all others there.
    lead, rest = distance // 2, distance - distance // 2
    points = lambda masks: F.transform(F.array(*(F.lit(_signed(m)).cast("long") for m in masks)), lambda m: F.col("fp").bitwiseXOR(m))
    meet = crowd.select("fp", F.explode(points(_ball(64, lead))).alias("point"), F.lit(True).alias("leads"))
    if rest > lead:
        outer = sorted(set(_ball(64, rest)) - set(_ball(64, lead)))
        meet = meet.union(crowd.select("fp", F.explode(points(outer)).alias("point"), F.lit(False).alias("leads")))
    meet = meet.groupBy("point").agg(F.collect_list("fp").alias("fps"), F.min(F.when(F.col("leads"), F.col("fp"))).alias("src")).where("size(fps) > 1 AND src IS NOT NULL")
    meet = meet.select("src", F.explode("fps").alias("dst")).where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return close.select(F.col("fp").alias("src"), F.col("probe").alias("dst")).union(meet).distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 3, distance: int = 2, segments: int = 2, crowded: int = 64) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are not read): doc_id, fingerprint (16 hexadecimal digits), component_id.

    The component is the smallest doc_id reachable over links. A null or empty text has no words: fingerprint zero,
    linked like any other. Repeated rows each give a row of the same component. A row whose doc_id is null takes part,
    but a component is named by its smallest doc_id that is not null, or null if it has none. An empty table gives an
    empty one. Very long texts are hashed whole.
    """
    prints = materialize(docs.select("doc_id", "text").mapInPandas(_fingerprints(shingle), "doc_id long, fp long"), "fingerprints")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    edges = links(classes.select("fp"), distance=distance, segments=segments, crowded=crowded)
    joined = connected_components(materialize(edges, "links"))
    named = classes.join(joined, classes.fp == joined.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    # Of classes, the linked ones alone meet again.
    linked = named.join(joined.select("component").distinct(), "component", "left_semi")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    names = named.join(least, "component", "left").select("fp", F.when(F.col("component_id").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    return prints.join(names, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: Characters whose shingles are held together.
SLICE = 1_000_000


@dataclass(frozen=True)
class Layout:
    """Of a long fingerprint: ``segments`` of ``width`` bits, in ``lanes`` words; ``distance`` is what two may differ in."""

    segments: int
    width: int
    lanes: int
    distance: int


def layout(n: int, similarity: float, miss: float = 0.05) -> Layout:
    """For ``n`` documents: segments so wide that a ball meets few others by chance, however many documents there are, and
    so many that two of ``similarity`` differ in one bit at most of some segment, but for a share of ``miss``.

    Two sets of Jaccard index j differ in a bit with probability acos(2j / (1 + j)) / pi.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    width = min(40, max(16, math.ceil(math.log2(max(n, 2))) + 6))
    near = (1 - p) ** width + width * p * (1 - p) ** (width - 1)
    segments = math.ceil(math.log(miss) / math.log(1 - near)) if p else 1
    lanes = -(-segments * width // 64)
    return Layout(segments, width, lanes, math.ceil(64 * lanes * p + 3.5 * math.sqrt(64 * lanes * p * (1 - p))))


def shingles(text: str | None, shingle: int) -> np.ndarray:
    """The distinct hashes of ``text``'s shingles, sorted; the whole sequence is one if it is shorter; none without words."""
    import xxhash

    words = ascii_words(text)
    grams = [b" ".join(words)] if 0 < len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), dtype=np.uint64))


def long_fingerprint(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """``lanes`` words: each bit is 1 if over half of the hashes, mixed anew for each word, have it."""
    ones = np.zeros(64 * lanes, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 13):
        with np.errstate(over="ignore"):
            odd = (np.arange(1, lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
            h = hashes[at : at + (1 << 13), None] * odd[None, :]
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(32)
        ones += np.unpackbits(h.view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")


def _classes(shingle: int, lanes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in slices(batches, SLICE):
            sets = [shingles(x, shingle) for x in batch["text"]]
            ids = np.array([xxhash.xxh64_intdigest(s.tobytes(), 3) for s in sets], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"key": batch["key"], "order": batch["order"], "th": batch["th"], "c": ids, "fp": [long_fingerprint(s, lanes) for s in sets]})
        release()

    return run


def meetings(classes: DataFrame, shape: Layout) -> DataFrame:
    """(key, n, c, asks): which of ``classes`` (c, fp) meet at a segment's value, ``n`` of them there: those that have it, and
    those that look it up as one of their ball.

    Of two values that differ in one bit one has an even number of ones, so only odd values look up their ball, among
    even ones.
    """
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = [F.lit(1 << i).cast("long") for i in range(shape.width)]
    lane = lambda i: F.element_at("fp", i + 1)

    def value(i: int) -> Column:
        word, at = divmod(i * shape.width, 64)
        low = F.shiftrightunsigned(lane(word), at) if at else lane(word)
        both = low.bitwiseOR(F.shiftleft(lane(word + 1), 64 - at)) if at + shape.width > 64 else low
        return both.bitwiseAND(F.lit((1 << shape.width) - 1).cast("long"))

    values = F.array(*(value(i) for i in range(shape.segments)))
    own = classes.select("c", F.posexplode(values).alias("i", "v"))
    key = lambda v: F.col("i").cast("long") * (1 << shape.width) + v
    held = materialize(own.select("c", "i", "v", key(F.col("v")).alias("key")), "held")
    sizes = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    ball = F.transform(F.array(*bits), lambda m: key(F.col("v").bitwiseXOR(m)))
    asked = held.where(F.bit_count("v") % 2 == 1).repartition(parts, "c").select("c", F.explode(ball).alias("key"))
    # Of the balls little is there: what is not goes in this join, before anything is gathered.
    even = held.where(F.bit_count("v") % 2 == 0).select("key").distinct()
    asked = materialize(asked.join(even, "key", "left_semi"), "asked")
    sizes = sizes.union(asked.groupBy("key").agg(F.count(F.lit(1)).alias("n"))).groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    rows = held.select("c", "key", F.lit(False).alias("asks")).union(asked.select("c", "key", F.lit(True)))
    return materialize(rows.join(sizes, "key"), "met")


def candidates(met: DataFrame, *, crowded: int = 4) -> DataFrame:
    """(a, b) of classes that meet, a < b. Where over ``crowded`` of them do, each is paired with the smallest and the
    largest class there instead of with each other, see ``strangers``. A crowd of copies meets at many values, and has the
    same leaders at most of them, so its pairs are in proportion to its size.
    """
    few = met.where(F.col("n") <= crowded).groupBy("key").agg(F.collect_list(F.when(~F.col("asks"), F.col("c"))).alias("own"), F.collect_list("c").alias("every"))
    pairs = few.select(F.explode("own").alias("x"), "every").select("x", F.explode("every").alias("y"))
    crowd = met.where(F.col("n") > crowded).select("key", F.col("c").alias("x"))
    leaders = crowd.groupBy("key").agg(F.min("x").alias("least"), F.max("x").alias("most"))
    many = crowd.join(leaders, "key").select("x", F.explode(F.array("least", "most")).alias("y")).distinct()
    return _ordered(pairs.union(many).where("x <> y"))


def strangers(met: DataFrame, joined: DataFrame, classes: DataFrame, shape: Layout, *, crowded: int = 4) -> DataFrame:
    """(a, b): the pairs of a crowded value that ``candidates`` left out, but for those that ``joined`` (node, component)
    has in one component already; their fingerprints are close.

    Of each value the largest component's classes are not paired among each other: the others are held against all there.
    So a crowd that its leaders have joined costs nothing here, and a chance guest of it one row's comparisons. The
    comparison of fingerprints is in the join itself; what is not close is not made a row.
    """
    crowd = met.where(F.col("n") > crowded).select("key", "c", "asks").join(joined.select(F.col("node").alias("c"), "component"), "c", "left")
    crowd = crowd.select("key", "c", "asks", F.coalesce("component", "c").alias("g"))
    per = crowd.groupBy("key", "g").agg(F.count(F.lit(1)).alias("n"))
    most = per.groupBy("key").agg(F.count(F.lit(1)).alias("groups"), F.max_by("g", F.struct("n", "g")).alias("most")).where("groups > 1")
    mixed = materialize(crowd.join(most.select("key", "most"), "key").join(classes.select("c", "fp"), "c"), "mixed")
    side = lambda n: [F.col(x).alias(x + n) for x in ("c", "g", "asks", "fp")]
    own, every = mixed.where("g <> most").select("key", *side("_a")), mixed.select("key", *side("_b"))
    near = own.join(every, "key").where("g_a <> g_b AND NOT (asks_a AND asks_b)").where(_apart("fp_a", "fp_b") <= shape.distance)
    return _ordered(near.select(F.col("c_a").alias("x"), F.col("c_b").alias("y")))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _apart(a: str, b: str) -> Column:
    """In how many bits two long fingerprints differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _alike(shingle: int, similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            close = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                p, q = shingles(x, shingle), shingles(y, shingle)
                both = len(np.intersect1d(p, q, assume_unique=True))
                close.append(both >= similarity * (len(p) + len(q) - both))
            yield batch.loc[close, ["a", "b"]]

    return run


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(src, dst) of ``pairs`` (a, b, and the hashes th_a, th_b of a text of each) that are alike by their whole texts."""
    th = F.xxhash64("text")
    needed = pairs.select(F.explode(F.array("th_a", "th_b")).alias("th")).distinct()
    texts = docs.select(th.alias("th"), "text").join(needed, "th", "left_semi").dropDuplicates(["th"])
    texts = materialize(texts, "texts")
    both = pairs.join(texts.select(F.col("th").alias("th_a"), F.col("text").alias("x")), "th_a").join(texts.select(F.col("th").alias("th_b"), F.col("text").alias("y")), "th_b")
    links = both.select("a", "b", "x", "y").mapInPandas(_alike(shingle, similarity), "a long, b long").toDF("src", "dst")
    return materialize(links, "links")


def similar_classes(docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, crowded: int = 4) -> tuple[DataFrame, DataFrame]:
    """(rows, links): per row of ``docs`` its key, order, th (hash of the text) and c, the class of its set of shingles;
    and (src, dst) of classes whose Jaccard index is ``similarity`` or more.

    Candidates meet in a segment of the long fingerprint (see ``layout``), stay if all of it differs in few enough bits
    (what ``similarity`` lets expect and 3.5 standard deviations more), and are verified on their whole texts. Where over
    ``crowded`` classes meet, links between two that other links join already may be left out; the components are those
    of all candidates, whatever ``crowded`` is.
    """
    rows, links, _ = _joined(docs, shingle, similarity, crowded)
    return rows, links


def _joined(docs: DataFrame, shingle: int, similarity: float, crowded: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``similar_classes``, and (node, component) of its links."""
    shape = layout(docs.count(), similarity)
    order = F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id").cast("long").alias("id"))
    key, th = F.xxhash64(F.col("doc_id").isNull(), "doc_id"), F.xxhash64("text")
    own = docs.select(key.alias("key"), order.alias("order"), th.alias("th"), "text")
    rows = materialize(own.mapInPandas(_classes(shingle, shape.lanes), "key long, order struct<absent:boolean,id:long>, th long, c long, fp array<long>"), "classes")
    classes = materialize(rows.groupBy("c").agg(F.first("fp").alias("fp"), F.min("th").alias("th")), "class-prints")
    side = lambda n: classes.select(F.col("c").alias(n), F.col("fp").alias(f"fp_{n}"), F.col("th").alias(f"th_{n}"))
    met = meetings(classes.select("c", "fp"), shape)
    pairs = candidates(met, crowded=crowded).join(side("a"), "a").join(side("b"), "b").where(_apart("fp_a", "fp_b") <= shape.distance)
    close = materialize(pairs.select("a", "b", "th_a", "th_b"), "close")
    links = _verified(close, docs, shingle, similarity)
    joined = connected_components(links)
    rest = strangers(met, joined, classes, shape, crowded=crowded).join(close, ["a", "b"], "left_anti")
    named = lambda n: classes.select(F.col("c").alias(n), F.col("th").alias(f"th_{n}"))
    rest = materialize(rest.join(named("a"), "a").join(named("b"), "b"), "close-rest")
    if rest.isEmpty():
        return rows, links, joined
    more = _verified(rest, docs, shingle, similarity)
    # The components so far are stars: with what is new they join in fewer steps than all links from the start.
    return rows, links.union(more), joined if more.isEmpty() else connected_components(joined.toDF("src", "dst").union(more))


def one_of_each(docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, crowded: int = 4) -> DataFrame:
    """``docs`` (doc_id, text and any others) without near-duplicates: of the rows that links of ``similarity`` or more
    join, the one with the smallest doc_id stays (nulls last, then by the text's hash).

    Rows are told apart by doc_id and text, so rows of one doc_id and different texts are judged each; of rows equal in
    both one stays. Texts without words are alike; one of them stays. Very long texts are taken whole. An empty table
    gives an empty one.
    """
    rows, _, joined = _joined(docs, shingle, similarity, crowded)
    place = F.struct("order", "th", "key")
    # Only rows of classes with several rows, or with a link, can go.
    per = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least"))
    named = per.join(joined.select(F.col("node").alias("c"), "component"), "c", "left")
    named = materialize(named.where("n > 1 OR component IS NOT NULL").withColumn("component", F.coalesce("component", "c")), "groups")
    first = named.groupBy("component").agg(F.min("least").alias("first"))
    stays = named.select("c", "component").join(first, "component").select("c", "first")
    twins = rows.groupBy("key", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "th")
    gone = rows.select("c", "key", "th", "order").join(stays, "c").where(~place.eqNullSafe(F.col("first"))).select("key", "th").distinct()
    key, th = F.xxhash64(F.col("doc_id").isNull(), "doc_id"), F.xxhash64("text")
    marked = docs.withColumns({"_key": key, "_th": th})
    kept = marked.join(gone.union(twins).distinct().toDF("_key", "_th"), ["_key", "_th"], "left_anti")
    # Rows that come several times over: once, if they stay.
    again = marked.join(twins.join(gone, ["key", "th"], "left_anti").toDF("_key", "_th"), ["_key", "_th"], "left_semi").dropDuplicates(["_key", "_th"])
    return kept.select(*docs.columns).union(again.select(*docs.columns))
