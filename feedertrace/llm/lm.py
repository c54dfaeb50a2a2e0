"""Language-model scores from a log-frequency Bloom filter.

Words and word pairs of the training documents are counted exactly: summed in each batch, shuffled once by shard, and
summed again. A shard's filter then holds each n-gram once for every level up to that of its count (levels are powers
of ``BASE``), so that a count is read back by probing level after level until one is missing. Scoring interpolates
the pair's and the word's estimates from those probes. The filter grows with the corpus; up to ``broadcast_bytes`` it is
broadcast, beyond that each stretch of texts sends its distinct n-grams to the shards and gets back a byte for each.

The exact counts of words give a unigram score beside it: the ``frequent`` commonest words are broadcast (a bound on
the rows), and what a document has of all other words is joined with the table of counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedertrace.llm.text import ascii_words, fold, release, slices
from feedertrace.session import materialize, source_bytes

#: The end token: no word has a space.
END = b" "
BASE = 1.5
#: Bits of an entry, and of the filter for each.
HASHES, BITS = 4, 9.5
MOST_LEVELS = 64
#: Characters whose words are looked at together, and characters whose counts leave as one.
SCORED, COUNTED = 500_000, 6_000_000
#: Shards in a partition of the counts, bytes of input for each partition, and the most partitions.
SHARDS, INPUT, PARTITIONS = 16, 128 << 20, 50_000
#: Shards that a stretch of texts asks in one row, and keys that are probed at once.
GROUP, PROBED = 4, 500_000
FIELDS = "doc_id long, n_tokens long, known long, logs double, rare array<string>, rare_n array<long>, score double"
_LOW = np.uint64(0xFFFFFFFF)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(29))) * _B
        x = (x ^ (x >> np.uint64(32))) * _C
        return x ^ (x >> np.uint64(30))


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, and one more for each factor ``BASE``."""
    return np.minimum(1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64), MOST_LEVELS)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of a level's counts; 0 at level 0."""
    low = np.ceil(BASE ** (levels - 1.0) - 1e-9)
    high = np.maximum(low, np.ceil(BASE**levels - 1e-9) - 1)
    return np.where(levels > 0, np.sqrt(low * high), 0.0)


_COUNTS = count_of(np.arange(MOST_LEVELS + 1))


class Batch:
    """The tokens of a batch of texts: each text's words, then the end."""

    def __init__(self, texts):
        import xxhash

        words: list[bytes] = []
        ends = []
        for text in texts:
            words += ascii_words(text)
            words.append(END)
            ends.append(len(words))
        self.ends = np.array(ends, dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.codes, self.tokens = pd.factorize(np.array(words, dtype=object))
        hashed = np.fromiter((xxhash.xxh64_intdigest(t, 7) for t in self.tokens), dtype=np.uint64, count=len(self.tokens))
        self.words = hashed
        own = hashed[self.codes]
        before = np.roll(own, 1)
        before[self.starts] = xxhash.xxh64_intdigest(END, 7)
        with np.errstate(over="ignore"):
            self.pairs = _mix(before * _A + own)
        self.before = before


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards in the order of the (unsigned) keys."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)


def _counted(shards: int):
    """What a stretch of text has for each shard, as one row: keys with counts, and words (joined by spaces) with theirs.

    Texts are read in small slices; the distinct n-grams of ``COUNTED`` characters are added up before they leave.
    """

    def packed(keys: np.ndarray, n: np.ndarray, tokens: np.ndarray | None = None) -> pd.DataFrame:
        names, at = np.unique(shard_of(keys, shards), return_index=True)
        spans = list(zip(at, [*at[1:], len(keys)], strict=True))
        n = n.astype("<u4")
        said = [None if tokens is None else b" ".join([b"" if t == END else t for t in tokens[i:j]]) for i, j in spans]
        return pd.DataFrame({"shard": names.astype(np.int32), "keys": [keys[i:j].tobytes() for i, j in spans], "counts": [n[i:j].tobytes() for i, j in spans], "words": said})

    def leave(pairs: list, words: list) -> Iterator[pd.DataFrame]:
        if pairs:
            yield packed(*summed(*zip(*pairs, strict=True)))
            keys, counts, tokens = (np.concatenate(x) for x in zip(*words, strict=True))
            codes, distinct = pd.factorize(tokens)
            key = np.zeros(len(distinct), dtype=np.uint64)
            key[codes] = keys
            order = np.argsort(key)
            yield packed(key[order], np.bincount(codes, weights=counts).astype(np.int64)[order], distinct[order])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, words, chars = [], [], 0
        for batch in slices(batches, SCORED):
            b = Batch(batch["text"])
            pairs.append(np.unique(b.pairs, return_counts=True))
            words.append((b.words, np.bincount(b.codes, minlength=len(b.tokens)), b.tokens))
            chars += len(b.codes) and sum(len(x) for x in batch["text"] if x) + len(batch)
            if chars >= COUNTED:
                yield from leave(pairs, words)
                pairs, words, chars = [], [], 0
        yield from leave(pairs, words)
        release()

    return run


def _masks(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """For each key at a level: a number below 2 ** 32 that says which word, and the ``HASHES`` bits in it.

    All bits of an entry are in one word of 64, so a probe reads memory once.
    """
    with np.errstate(over="ignore"):
        h = _mix(keys + np.uint64(level) * _A)
        g = h * _B
    mask = np.uint64(1) << (g >> np.uint64(58))
    for i in range(1, HASHES):
        mask |= np.uint64(1) << ((g >> np.uint64(58 - 6 * i)) & np.uint64(63))
    return h >> np.uint64(32), mask


def build_filter(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The words of a filter with ``keys`` (unsigned) at the levels of ``counts``."""
    levels = levels_of(counts)
    words = np.zeros(max(1, int(levels.sum() * BITS / 64) + 1), dtype=np.uint64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        which, mask = _masks(keys[levels >= level], level)
        np.bitwise_or.at(words, which * np.uint64(len(words)) >> np.uint64(32), mask)
    return words


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows in the order of shards: the exact counts of a shard's words, and its filter. One shard is held at a time."""

    def done(shard: int, keys: list, counts: list, words: dict[bytes, int]) -> Iterator[pd.DataFrame]:
        held = build_filter(*summed(keys, counts))
        if words:
            yield pd.DataFrame({"token": [(t or END).decode() for t in words], "n": list(words.values()), "shard": pd.array([None] * len(words), dtype="Int32"), "size": 0, "filter": None})
        yield pd.DataFrame({"token": [None], "n": [0], "shard": pd.array([shard], dtype="Int32"), "size": [held.nbytes], "filter": [held.tobytes()]})

    now, keys, counts, words = None, [], [], {}
    for batch in batches:
        for shard, k, n, said in zip(batch["shard"], batch["keys"], batch["counts"], batch["words"], strict=True):
            if shard != now:
                if keys:
                    yield from done(now, keys, counts, words)
                now, keys, counts, words = shard, [], [], {}
            n = np.frombuffer(n, dtype="<u4")
            keys.append(np.frombuffer(k, dtype=np.uint64))
            counts.append(n)
            if said is not None:
                for t, c in zip(said.split(b" "), n.tolist(), strict=True):
                    words[t] = words.get(t, 0) + c
    if keys:
        yield from done(now, keys, counts, words)
    release()


class Filter:
    """All shards in one array."""

    def __init__(self, shards: int, rows):
        self.shards = shards
        self.size = np.ones(shards, dtype=np.uint64)
        self.at = np.zeros(shards, dtype=np.uint64)
        parts, to = [bytes(8)], 1
        for shard, packed in rows:
            self.size[shard], self.at[shard] = len(packed) // 8, to
            parts.append(packed)
            to += len(packed) // 8
        #: Kept as bytes: a worker then reads a broadcast into place without a copy.
        self.packed = b"".join(parts)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each of ``keys``: 0 if the filter lacks it."""
        held = np.frombuffer(self.packed, dtype=np.uint64)
        out = np.zeros(len(keys), dtype=np.int64)
        left = np.arange(len(keys))
        shard = shard_of(keys, self.shards)
        size, start = self.size[shard], self.at[shard]
        for level in range(1, MOST_LEVELS + 1):
            which, mask = _masks(keys, level)
            there = np.flatnonzero(held[start + (which * size >> np.uint64(32))] & mask == mask)
            left, keys, size, start = left[there], keys[there], size[there], start[there]
            if not len(left):
                break
            out[left] = level
        return out


def interpolate(pair: np.ndarray, context: np.ndarray, word: np.ndarray, total: int, distinct: int, weight: float) -> np.ndarray:
    """log10 of ``weight`` times the pair's estimate and the rest times the word's, from levels."""
    c, n = _COUNTS[pair], _COUNTS[context]
    bigram = np.where(n > 0, np.minimum(c / np.maximum(n, 1), 1.0), 0.0)
    unigram = np.minimum((_COUNTS[word] + 0.1) / (total + 0.1 * (distinct + 1)), 1.0)
    return np.log10(weight * bigram + (1 - weight) * unigram)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0)


def _row_scores(batch: pd.DataFrame, b: Batch, frequent: dict[bytes, int], bloom, total: int, distinct: int, weight: float) -> pd.DataFrame:
    """The rows of ``FIELDS`` for a batch with its tokens; ``bloom`` has the levels of its keys."""
    exact = np.fromiter((frequent.get(t, -1) for t in b.tokens), dtype=np.int64, count=len(b.tokens))
    of = exact[b.codes]
    common = of >= 0
    out = {"doc_id": batch["doc_id"].astype("Int64"), "n_tokens": b.ends - b.starts}
    out["known"] = _sums(common.astype(np.int64), b.starts)
    out["logs"] = _sums(np.where(common, np.log10(np.maximum(of, 0) + 0.1), 0.0), b.starts)
    # What is left of each document: its other words with their counts.
    doc = np.repeat(np.arange(len(batch)), b.ends - b.starts)[~common]
    pairs, n = np.unique(doc * len(b.tokens) + b.codes[~common], return_counts=True)
    cuts = np.searchsorted(pairs, np.arange(len(batch) + 1) * len(b.tokens))
    names = [b.tokens[c].decode() for c in pairs % max(1, len(b.tokens))]
    spans = list(zip(cuts, cuts[1:], strict=False))
    out["rare"], out["rare_n"] = [names[i:j] for i, j in spans], [n[i:j] for i, j in spans]
    word = bloom.levels(b.words)
    first = np.flatnonzero(b.codes == b.codes[-1])[:1] if len(batch) else []
    context = np.roll(word[b.codes], 1)
    context[b.starts] = word[b.codes[b.ends[0] - 1]] if len(first) else 0
    out["score"] = _sums(interpolate(bloom.levels(b.pairs), context, word[b.codes], total, distinct, weight), b.starts)
    return pd.DataFrame(out)


def _scored(shared, total: int, distinct: int, weight: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, bloom = shared.value
        for batch in slices(batches, SCORED):
            yield _row_scores(batch, Batch(batch["text"]), frequent, bloom, total, distinct, weight)
        release()

    return run


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows in stretches of about ``COUNTED`` characters, a longer text alone: each a number and its rows, compressed."""
    import pyarrow as pa
    from pyspark import TaskContext

    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def packed(parts: list[pd.DataFrame], at: int) -> pd.DataFrame:
        with pa.BufferOutputStream() as out:
            with pa.ipc.new_stream(out, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                for part in parts:
                    ids = pa.array(part["doc_id"].astype("Int64"), pa.int64())
                    writer.write_batch(pa.record_batch([ids, pa.array(part["text"], pa.string(), from_pandas=True)], schema))
            return pd.DataFrame({"stretch": [(TaskContext.get().partitionId() << 33) + at], "data": [out.getvalue().to_pybytes()]})

    parts, chars, at = [], 0, 0
    for part in slices(batches, SCORED):
        parts.append(part)
        chars += sum(len(x) for x in part["text"] if x) + len(part)
        if chars >= COUNTED:
            yield packed(parts, at)
            parts, chars, at = [], 0, at + 1
    if parts:
        yield packed(parts, at)
    release()


def _unpacked(data: bytes) -> Iterator[pd.DataFrame]:
    import pyarrow as pa

    for batch in pa.ipc.open_stream(data):
        yield batch.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)


def _keys(batches: list[Batch]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a stretch in order, and for each key of the batches (pairs, then words) its place there."""
    codes, distinct = pd.factorize(np.concatenate([x for b in batches for x in (b.pairs, b.words)]))
    order = np.argsort(distinct)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], place[codes]


def _asks(shards: int):
    """What a stretch asks of each group of ``GROUP`` shards: its distinct keys there, in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for stretch, data in zip(frame["stretch"], frame["data"], strict=True):
                keys, _ = _keys([Batch(x["text"]) for x in _unpacked(data)])
                groups, at = np.unique(shard_of(keys, shards) // GROUP, return_index=True)
                yield pd.DataFrame({"part": groups.astype(np.int32), "stretch": stretch, "data": [keys[i:j].tobytes() for i, j in zip(at, [*at[1:], len(keys)], strict=True)]})
        release()

    return run


def _answers(shards: int):
    """Of rows in the order of groups, a group's filters first: the levels of what each stretch asks, a byte a key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, own, found = None, [], None

        def answered(asked: list[tuple[int, np.ndarray]]) -> Iterator[pd.DataFrame]:
            """One probe for what many stretches ask: each asks little of a group."""
            nonlocal found
            if asked:
                found = found or Filter(shards, own)
                levels = found.levels(np.concatenate([k for _, k in asked])).astype(np.uint8)
                cuts = np.cumsum([len(k) for _, k in asked])[:-1]
                yield pd.DataFrame({"stretch": [x for x, _ in asked], "part": now, "data": [x.tobytes() for x in np.split(levels, cuts)]})

        for batch in batches:
            asked, n = [], 0
            for part, stretch, shard, data in zip(batch["part"], batch["stretch"], batch["shard"], batch["data"], strict=True):
                if part != now or n > PROBED:
                    yield from answered(asked)
                    asked, n = [], 0
                if part != now:
                    now, own, found = part, [], None
                if shard >= 0:
                    own.append((shard, bytes(data)))
                else:
                    asked.append((stretch, np.frombuffer(data, dtype=np.uint64)))
                    n += len(asked[-1][1])
            yield from answered(asked)
        release()

    return run


class Answers:
    """The levels of a batch's keys, in place of the whole filter."""

    def __init__(self, b: Batch, levels: np.ndarray):
        self.held = {id(b.pairs): levels[: len(b.pairs)], id(b.words): levels[len(b.pairs) :]}

    def levels(self, keys: np.ndarray) -> np.ndarray:
        return self.held[id(keys)]


def _rescored(shared, total: int, distinct: int, weight: float):
    """Of rows in the order of stretches, a stretch's answers first: what ``_scored`` gives for its texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, _ = shared.value
        now, found = None, []
        for batch in batches:
            for stretch, part, data in zip(batch["stretch"], batch["part"], batch["data"], strict=True):
                if stretch != now:
                    now, found = stretch, []
                if part >= 0:
                    found.append((part, bytes(data)))
                    continue
                parts = [(x, Batch(x["text"])) for x in _unpacked(data)]
                keys, place = _keys([b for _, b in parts])
                held = np.frombuffer(b"".join(x for _, x in sorted(found)), dtype=np.uint8)
                if len(held) != len(keys):
                    raise ValueError(f"{len(held)} answers for {len(keys)} keys")
                at = 0
                for x, b in parts:
                    to = at + len(b.pairs) + len(b.words)
                    yield _row_scores(x, b, frequent, Answers(b, held[place[at:to]]), total, distinct, weight)
                    at = to
                found = []
        release()
        release()

    return run


def _apart(source: DataFrame, filters: DataFrame, shards: int, partitions: int, scores) -> DataFrame:
    """What ``scores`` gives, without a broadcast of the filter.

    Each stretch of texts asks the shards for its distinct keys and gets a byte for each; the order of the keys, which it
    finds again from its texts, says whose they are. So of all n-grams one shuffle of 8 bytes a distinct key of a stretch
    is made, and the texts are dealt once, compressed.
    """
    stretches = materialize(source.mapInPandas(_stretches, "stretch long, data binary"), "stretches")
    asks = stretches.mapInPandas(_asks(shards), "part int, stretch long, data binary")
    none = F.lit(-1)
    rows = filters.select(F.floor(F.col("shard") / GROUP).cast("int").alias("part"), F.lit(-1).cast("long").alias("stretch"), "shard", F.col("filter").alias("data"))
    rows = rows.union(asks.select("part", "stretch", none.alias("shard"), "data")).repartition(partitions, "part").sortWithinPartitions("part", F.col("shard") < 0)
    answers = materialize(rows.mapInPandas(_answers(shards), "stretch long, part int, data binary"), "answers", drop_shuffles=True)
    rows = answers.union(stretches.select("stretch", none.alias("part"), "data")).repartition(partitions, "stretch").sortWithinPartitions("stretch", F.col("part") < 0)
    return rows.mapInPandas(scores, FIELDS)


def score_documents(docs: DataFrame, *, folds: int = 10, held_out: int = 0, weight: float = 0.6, frequent: int = 50_000, broadcast_bytes: int = 128 << 20) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are not read): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score.

    Documents outside fold ``held_out`` (crc32 of the id as text, modulo ``folds``) are what is learnt from. A null or
    empty text is its end token. Repeated rows count as often as they come; a null doc_id counts as the text ''. With
    nothing to learn from every count is 0 and scores stay finite. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    source = docs.select("doc_id", "text")
    partitions = min(PARTITIONS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), (source_bytes(source) or 0) // INPUT))
    shards = SHARDS * partitions
    training = source.where(fold(F.col("doc_id"), folds) != held_out).select("text")
    counted = training.mapInPandas(_counted(shards), "shard int, keys binary, counts binary, words binary").repartition(partitions, "shard").sortWithinPartitions("shard")
    model = materialize(counted.mapInPandas(_shards, "token string, n long, shard int, size long, filter binary"), "model", drop_shuffles=True)
    words = model.where("token is not null").select("token", "n")
    filters = model.where("token is null").select("shard", "size", "filter")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    size = filters.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    top = {r.token.encode(): r.n for r in words.orderBy(F.desc("n"), "token").limit(frequent).collect()}
    bloom = Filter(shards, ((r.shard, bytes(r.filter)) for r in filters.select("shard", "filter").toLocalIterator())) if size <= broadcast_bytes else None
    shared = spark.sparkContext.broadcast((top, bloom))
    if bloom is None:
        scored = _apart(source, filters, shards, partitions, _rescored(shared, total, distinct, weight))
    else:
        scored = source.mapInPandas(_scored(shared, total, distinct, weight), FIELDS)
    scored = materialize(scored.withColumn("rid", F.monotonically_increasing_id()), "scored", drop_shuffles=True)
    rare = scored.select("rid", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("rid", F.col("x.rare").alias("token"), F.col("x.rare_n").alias("tf"))
    rare = rare.join(words, "token", "left").groupBy("rid").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(0)).alias("rare_known"), F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("rare_logs")
    )
    out = scored.drop("rare", "rare_n").join(rare, "rid", "left")
    return out.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(total + 0.1 * (distinct + 1)))).alias("base_score"),
        "score",
    )
