"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader.

Features are single words, word pairs, and the same with each word replaced by its shape (so that unseen words of a
known form still count), hashed to ``2 ** bits`` places; a document's vector is the square root of its counts, scaled
to length 1. A score is a sparse dot product with the weights, which have a fixed size and are broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedertrace.llm.text import fold, release
from feedertrace.session import materialize

_TOKENS = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\s]+").findall
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(token: bytes) -> bytes:
    if token[0] < 128 and not token.isalnum():
        return token[:4]
    kind = b"0" if token.isdigit() else b"A" if token.isupper() and len(token) > 1 else b"Aa" if token[:1].isupper() else b"a"
    return kind + b"%d" % min(len(token).bit_length(), 6)


class Hasher:
    """Token hashes, remembered up to a bound."""

    def __init__(self, bits: int, remembered: int = 300_000):
        import xxhash

        self.hash, self.bits, self.remembered = xxhash.xxh64_intdigest, np.uint64(64 - bits), remembered
        self.known: dict[bytes, tuple[int, int]] = {}

    def __call__(self, token: bytes) -> tuple[int, int]:
        got = self.known.get(token)
        if got is None:
            if len(self.known) >= self.remembered:
                self.known.clear()
            got = self.known[token] = self.hash(token.lower(), 1), self.hash(_shape(token), 2)
        return got

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, values) of the whole text; an empty one has the bias alone."""
        tokens = _TOKENS(text.encode()) if text else []
        if not tokens:
            return np.zeros(1, dtype=np.int64), np.ones(1)
        word, shape = np.array(list(map(self, tokens)), dtype=np.uint64).T
        with np.errstate(over="ignore"):
            same = (word[1:] == word[:-1]).astype(np.uint64) * np.uint64(77)
            pairs = [(a[:-1] * _MIX + a[1:]) * _MIX for a in (word, shape)]
            places = np.concatenate([word * _MIX, shape * _MIX, *pairs, (same[same > 0] * _MIX)]) >> self.bits
        at, n = np.unique(places.astype(np.int64), return_counts=True)
        value = np.sqrt(n)
        return np.append(at, 0), np.append(value / np.sqrt((value**2).sum()), 1.0)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], bits: int, *, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4) -> np.ndarray:
    """Weights from (label, places, values), in the order given, ``epochs`` times."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(at):
        zi = z[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for label, at, x in rows:
            x = x.astype(np.float64)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            # A place can occur twice (the bias and a hash): both updates count.
            np.add.at(z, at, g - step * w)
            np.add.at(n, at, g * g)
    return weights(np.arange(1 << bits)).astype(np.float32)


def _vectors(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(bits)
        for batch in batches:
            rows = [(k, y, *hasher.features(t)) for k, y, t in zip(batch["key"], batch["label"], batch["text"], strict=True)]
            yield pd.DataFrame([(k, y, at.astype(np.int32), x.astype(np.float32)) for k, y, at, x in rows], columns=["key", "label", "places", "vals"])

    return run


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", bits: int = 18, folds: int = 5, held_out: int = 0, max_rows: int = 4000, max_values: int = 16_000_000) -> np.ndarray:
    """Weights learnt from the labelled documents outside fold ``held_out`` (crc32 of the id as text, modulo ``folds``).

    ``max_rows`` bounds the sample that is fitted: the labelled ids of smallest hash. ``max_values`` bounds its bytes on
    the driver (8 a value): ids whose vectors would go beyond it, in the order of the hash, are not fitted; a vector has a
    value for each distinct feature of a whole text. An id that ``docs`` has several times is fitted with its shortest
    vector. Labels that are null, or whose document is missing, teach nothing; with no label at all, or empty tables, every
    weight is 0 and every score one half.
    """
    own = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")).where(f"label is not null and _id is not null")
    own = own.where(fold(F.col("_id"), folds) != held_out).withColumn("key", F.xxhash64("_id", "label")).orderBy("key", "_id", "label").limit(max_rows)
    # At most ``max_rows`` rows of two numbers.
    found = docs.select("doc_id", "text").join(F.broadcast(own), F.col("doc_id") == F.col("_id")).select("key", "label", "text")
    vectors = found.mapInPandas(_vectors(bits), "key long, label int, places array<int>, vals array<float>")
    one = F.min(F.struct(F.size("places").alias("n"), "places", "vals")).alias("s")
    vectors = materialize(vectors.groupBy("key", "label").agg(one).select("key", "label", "s.*"), "sample")
    # At most ``max_rows`` numbers.
    sizes = sorted(tuple(r) for r in vectors.select("key", "label", "n").collect())
    fits = int(np.searchsorted(np.cumsum([n for _, _, n in sizes]), max_values, side="right"))
    if not fits:
        return np.zeros(1 << bits, dtype=np.float32)
    table = vectors.where(F.struct("key", "label") <= F.struct(*(F.lit(x).alias(n) for x, n in zip(sizes[fits - 1], ("key", "label"), strict=False)))).select("key", "label", "places", "vals").toArrow().combine_chunks()
    key, label = table["key"].to_numpy(), table["label"].to_numpy()
    lists = table["places"].chunk(0)
    ends, places, vals = lists.offsets.to_numpy(), lists.values.to_numpy(), table["vals"].chunk(0).values.to_numpy()
    order = np.lexsort((np.diff(ends), label, key))
    # Views of one buffer: the sample is held once.
    return train([(int(label[i]), places[ends[i] : ends[i + 1]], vals[ends[i] : ends[i + 1]]) for i in order], bits)


def _scored(weights: np.ndarray, bits: int, limit: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(bits)
        for batch in batches:
            margin = [weights[at] @ x for at, x in map(hasher.features, batch["text"])]
            score = 1 / (1 + np.exp(-np.clip(np.array(margin, dtype=float), -35, 35)))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": score, "predicted": (score >= limit).astype(np.int32)})
        release()

    return run


def score(docs: DataFrame, weights: np.ndarray, *, limit: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from ``limit`` on) per row of ``docs``; only doc_id and text are read.

    A null or empty text is scored by the bias, a very long one by all its features. Repeated rows and rows with a null doc_id each give a row, an empty
    table an empty one.
    """
    bits = int(len(weights)).bit_length() - 1
    return docs.select("doc_id", "text").mapInPandas(_scored(weights, bits, limit), "doc_id long, score double, predicted int")


def _filtered(weights: np.ndarray, bits: int, limit: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(bits)
        for batch in batches:
            margin = np.array([weights[at] @ x for at, x in map(hasher.features, batch["text"])], dtype=float)
            yield batch[1 / (1 + np.exp(-np.clip(margin, -35, 35))) >= limit]
        release()

    return run


def keep_good(docs: DataFrame, weights: np.ndarray, *, limit: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text scores ``limit`` or more; nulls and ties as in ``score``."""
    return docs.mapInPandas(_filtered(weights, int(len(weights)).bit_length() - 1, limit), docs.schema)
