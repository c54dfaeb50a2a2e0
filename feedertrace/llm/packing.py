"""Best-fit packing of token sequences, bulk-synchronously.

Documents are tokenised and cut into pieces of at most ``seq_len`` ids. Pieces are range-sorted by length, so that a
piece's rank within its length is the rank of its partition plus its place there: no length, however common, meets in
one task. Each superstep takes the longest length not placed, lets its pieces sweep to the successor gap (the smallest
that holds them), settles by rank which piece gets which gap, and updates the gaps. All pieces of a length and all gaps
of a size are alike, so a sweep moves runs (first rank, count) rather than rows: the sweeps' state has at most
``seq_len`` lengths and sizes whatever the corpus, and every row then finds its own run by its rank, in parallel.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedertrace.session import checkpoint, materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Beyond these letters libraries may disagree on what a letter is; such texts take the slower, defining library.
_OTHER_SCRIPTS = "[^\x00-ɏ‐-…]"


def tokenizer_folder() -> str:
    """Where the public vocabularies are installed."""
    import public_tokenizers

    return os.path.dirname(public_tokenizers.__file__)


@lru_cache(maxsize=4)
def encoder(folder: str, name: str):
    """A function from a text to its ids, those of ``tokenizers`` for the file ``name``.json with
    ``add_special_tokens=False``; the string of a special token within a text is that token.

    Latin-script texts go through ``tiktoken``, which gives the same ids for the same vocabulary about six times
    faster; a text with any other letter, or with a special token's string, goes through ``tokenizers`` itself.
    """
    import base64
    import json
    import re

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(f"{folder}/{name}.tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    with open(f"{folder}/{name}.json", encoding="utf-8") as file:
        added = [x["content"] for x in json.load(file)["added_tokens"]]
    other = re.compile("|".join([_OTHER_SCRIPTS, *map(re.escape, added)])).search

    @lru_cache(maxsize=1)
    def exact() -> Tokenizer:
        return Tokenizer.from_file(f"{folder}/{name}.json")

    def one(text: str) -> list[int]:
        if other(text):
            return exact().encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return one


def cut(n: int, seq_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all of ``seq_len``, the first one shorter where they don't divide."""
    first = n % seq_len or min(n, seq_len)
    return [(0, first), *((at, seq_len) for at in range(first, n, seq_len))] if n else []


def _pieces(folder: str, name: str, seq_len: int, eos_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(folder, name)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array([*encode(text or ""), eos_id], dtype="<u4")
                rows += [(doc_id, i, at, n, zlib.crc32(ids[at : at + n].tobytes())) for i, (at, n) in enumerate(cut(len(ids), seq_len))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return run


def plan_runs(counts: dict[int, int], seq_len: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit supersteps over ``counts`` of pieces by length: runs (length, first rank, count, first sequence, offset).

    The i-th piece of a run goes to the i-th sequence from the run's first, at the run's offset.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    opened = 0

    def put(size: int, first: int, n: int) -> None:
        if size and n:
            if size not in gaps:
                insort(sizes, size)
                gaps[size] = []
            gaps[size].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                size = sizes[at]
                first, n = gaps[size].pop()
                take = min(n, left)
                if not gaps[size]:
                    del gaps[size]
                    sizes.pop(at)
                put(size, first + take, n - take)
                put(size - length, first, take)
                runs.append((length, rank, take, first, seq_len - size))
                left, rank = left - take, rank + take
                continue
            each = min(seq_len // length, left)
            take = left // each
            for i in range(each):
                runs.append((length, rank, take, opened, i * length))
                rank += take
            put(seq_len - each * length, opened, take)
            opened, left = opened + take, left - each * take
    return runs


def _place(parts: dict[tuple[int, int], tuple[int, int]], runs: list[tuple[int, int, int, int, int]]):
    """Rows to places: ``parts`` has the rank and the first position of each (partition, length)."""
    keys = np.array([(length << 44) + rank for length, rank, *_ in runs], dtype=np.int64)
    first = np.array([x[3] for x in runs], dtype=np.int64)
    offset = np.array([x[4] for x in runs], dtype=np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = batch["at"].to_numpy()
            length = batch["length"].to_numpy()
            pairs, inverse = np.unique(np.stack([at >> 33, length]), axis=1, return_inverse=True)
            shift = np.array([parts[int(p), int(n)][0] - parts[int(p), int(n)][1] for p, n in pairs.T], dtype=np.int64)
            key = (length << 44) + at + shift[inverse.ravel()] if len(at) else at
            i = np.searchsorted(keys, key, side="right") - 1
            yield batch.drop(columns="at").assign(sequence_id=first[i] + key - keys[i], offset=offset[i])

    return run


def pack_documents(docs: DataFrame, *, seq_len: int = 1024, eos_id: int = 2, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """Place every document's ids in sequences of at most ``seq_len``.

    ``docs`` has doc_id and text; other columns, whatever their names, are not read. A document is its text's ids and
    ``eos_id``; a null text is empty, so it is ``eos_id`` alone. Repeated rows, and rows whose doc_id is null, are
    documents of their own. An empty table gives an empty one. One row per piece: doc_id, piece, start, length,
    ids_crc32 (of little-endian unsigned 32-bit ids), sequence_id, offset. Sequences have no gaps but at their end.
    """
    folder = folder or tokenizer_folder()
    pieces = materialize(docs.select("doc_id", "text").mapInPandas(_pieces(folder, tokenizer, seq_len, eos_id), PIECES), "pieces")
    ranked = checkpoint(pieces.repartitionByRange("length", "doc_id", "piece").sortWithinPartitions("length", "doc_id", "piece"))
    ranked = ranked.withColumn("at", F.monotonically_increasing_id())
    # A partition holds a stretch of lengths: rows here are at most the partitions plus the lengths.
    groups = ranked.groupBy(F.shiftright("at", 33).alias("part"), "length").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))
    parts, counts = {}, {}
    for part, length, n, low in sorted(tuple(x) for x in groups.collect()):
        parts[part, length] = counts.get(length, 0), low
        counts[length] = counts.get(length, 0) + n
    runs = sorted(plan_runs(counts, seq_len))
    return ranked.mapInPandas(_place(parts, runs), f"{PIECES}, sequence_id long, offset long")


def _cut_ids(folder: str, name: str, seq_len: int, eos_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(folder, name)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = [*encode(text or ""), eos_id]
                rows += [(doc_id, i, ids[at : at + n]) for i, (at, n) in enumerate(cut(len(ids), seq_len))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "ids"]).astype({"doc_id": "Int64"})

    return run


def packed_sequences(docs: DataFrame, places: DataFrame, *, seq_len: int = 1024, eos_id: int = 2, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """The training rows themselves: sequence_id and ids, from ``pack_documents``' places. Needs distinct doc_ids."""
    folder = folder or tokenizer_folder()
    ids = docs.select("doc_id", "text").mapInPandas(_cut_ids(folder, tokenizer, seq_len, eos_id), "doc_id long, piece int, ids array<int>")
    own = places.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return own.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
