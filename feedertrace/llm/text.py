"""What several corpus operators share: words in the contracts' sense, and hashing folds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of ``text`` in UTF-8, with A-Z lower-cased; none for a null text."""
    return text.encode().lower().split() if text else []


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; an absent id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def slices(batches: Iterator[pd.DataFrame], chars: int) -> Iterator[pd.DataFrame]:
    """The rows of ``batches`` in parts of about ``chars`` characters of text, a longer text alone: arrays over the words
    of a part stay small, whatever a batch holds."""
    for batch in batches:
        ends = np.cumsum([len(x) if x else 0 for x in batch["text"]])
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chars, side="right")))
            yield batch.iloc[at:to]
            at = to


def release() -> None:
    """Give freed memory back to the system: Python workers live on from task to task, and keep what they once took."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass
