"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, units and names turn into typed placeholders, the others into their lower-case
core. A capital at a sentence's start may be a name or not, so there are two readings: such words as they stand, and as
names. Windows of template tokens are hashed in both, and as raw words; a hash table of the benchmark's windows finds
equal ones in the documents. Raw windows count as they are.
Along an alignment of an item with a document, each slot value of the item must stand for one value of the document and
the other way round, so a question asked again with other numbers or names is caught, and a chance likeness of
templates is not; of slots that disagree the most frequent stays, and windows with another are dropped. The benchmark is taken in blocks whose size is bounded, each against all documents.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedertrace.llm.text import release, slices

LEAKS = "doc_id long, item_id long, covered long, item_tokens long, coverage double, reparameterised boolean"
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz pound pounds ton tons ml l litre litres liter liters gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kmh percent % $ € £ dollar dollars euro euros cent cents "
    "degree degrees °c °f k w kw kwh v volt volts a amp amps hz khz mhz ghz j kj cal kcal pa kpa".split()
)
_NUMBER = re.compile(r"[$€£]?[+-]?\d+(?:[.,:/]\d+)*(?:st|nd|rd|th|%|°)?$").match
_WITH_UNIT = re.compile(r"[+-]?\d+(?:[.,]\d+)*([^\W\d_]+)$").match
_CORE = re.compile(r"^[^\w$€£%°+-]+|[^\w%°]+$")
_ENDS = (".", "!", "?", ":", ";")
NUM, UNIT, NAME = (np.uint64(x) for x in (0xA5A5000000000001, 0xA5A5000000000003, 0xA5A5000000000005))
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Characters whose words are looked at together.
SLICE = 2_000_000
#: Of a word: no token; a number; a unit; a word that may be a name; any other.
NONE, IS_NUM, IS_UNIT, CAPITAL, PLAIN = range(5)
#: Readings.
RAW, WORDS, NAMES = range(3)


def classify(word: str) -> tuple[int, str, bool]:
    """(kind, core, whether a sentence ends with it)."""
    ends = word.endswith(_ENDS)
    core = _CORE.sub("", word)
    if not core or not any(c.isalnum() or c in "$€£%°" for c in core):
        return NONE, "", ends
    low = core.lower()
    if _NUMBER(core) or ((m := _WITH_UNIT(core)) and m[1].lower() in UNITS):
        return IS_NUM, low, ends
    if low in UNITS:
        return IS_UNIT, low, ends
    if core[0].isupper() and len(core) > 1 and core[1:].islower():
        return CAPITAL, low, ends
    return PLAIN, low, ends


class Tokens:
    """Template tokens of some texts, one after another; ``doc`` has the text's number of each token. ``token`` and
    ``slot`` are by reading: all words raw; with capitals at the start of sentences as words; with them as names."""

    def __init__(self, texts):
        import xxhash

        words: list[bytes] = []
        sizes = []
        for text in texts:
            own = text.encode().split() if text else []
            words += own
            sizes.append(len(own))
        codes, unique = pd.factorize(np.array(words, dtype=object))
        known = [classify(w.decode()) for w in unique]
        kind = np.array([k for k, _, _ in known], dtype=np.int8)[codes] if words else np.zeros(0, dtype=np.int8)
        ends = np.array([e for _, _, e in known], dtype=bool)[codes] if words else np.zeros(0, dtype=bool)
        plain = np.array([xxhash.xxh64_intdigest(c.encode(), 9) for _, c, _ in known], dtype=np.uint64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        first = np.ones(len(words), dtype=bool)
        first[1:] = ends[:-1] | (doc[1:] != doc[:-1])
        token = plain[codes] if words else np.zeros(0, dtype=np.uint64)
        # A unit is one only behind a number: "in" and "min" are words too.
        unit = np.zeros(len(words), dtype=bool)
        unit[1:] = (kind[1:] == IS_UNIT) & (kind[:-1] == IS_NUM) & (doc[1:] == doc[:-1])
        keep = kind != NONE
        self.doc, self.codes = doc[keep], codes[keep]
        names = ((kind == CAPITAL) & ~first, kind == CAPITAL)
        self.token = [token[keep]] + [np.select([kind == IS_NUM, unit, name], [NUM, UNIT, NAME], token).astype(np.uint64)[keep] for name in names]
        self.slot = [np.zeros(len(self.doc), dtype=bool)] + [((kind == IS_NUM) | unit | name)[keep] for name in names]
        self.cores = [c for _, c, _ in known]
        self.starts = np.searchsorted(self.doc, np.arange(len(sizes) + 1))

    def windows(self, n: int, reading: int) -> np.ndarray:
        """The hash of the ``n`` tokens from each on; those that would cross a text's end are not to be used."""
        token = self.token[reading]
        if len(token) < n:
            return np.zeros(0, dtype=np.uint64)
        out = np.zeros(len(token) - n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(n):
                out = out * _STEP + token[i : i + len(out)]
            return out ^ (out >> np.uint64(31))

    def value(self, i: int) -> str:
        return self.cores[self.codes[i]]


class Benchmark:
    """A block of items with the hash tables of their windows, by window length and reading."""

    def __init__(self, items: list[tuple[int, str]], window: int, shortest: int):
        self.ids = [i for i, _ in items]
        self.tokens = t = Tokens([x for _, x in items])
        self.size = np.diff(t.starts)
        self.tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        found = defaultdict(list)
        literal = [np.concatenate([[0], np.cumsum(~x)]) for x in t.slot]
        for item, (low, high) in enumerate(zip(t.starts, t.starts[1:], strict=False)):
            n = min(window, high - low)
            if n >= shortest:
                # At least half of a template's window is words as such.
                for reading, words in enumerate(literal):
                    found[int(n), reading] += [(item, at) for at in range(low, high - n + 1) if 2 * (words[at + n] - words[at]) >= n]
        #: Items too short to tell, by their raw tokens: they count only where they are all of a text.
        self.whole: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item, (low, high) in enumerate(zip(t.starts, t.starts[1:], strict=False)):
            if 0 < high - low < shortest:
                self.whole[int(high - low)][int(t.windows(high - low, RAW)[low])].append(item)
        for (n, reading), places in found.items():
            item, at = np.array(places, dtype=np.int64).reshape(-1, 2).T
            keys = t.windows(n, reading)[at]
            order = np.argsort(keys, kind="stable")
            small = np.zeros(1 << 20, dtype=bool)
            small[(keys >> np.uint64(44)).astype(np.int64)] = True
            self.tables[n, reading] = keys[order], item[order], at[order], small

    def match(self, texts) -> Iterator[tuple[int, int, int, int, bool]]:
        """(text's number, item's number, covered tokens of the item, its tokens, reparameterised)."""
        t = Tokens(texts)
        for n, items in self.whole.items():
            own = t.windows(n, RAW)
            for doc in np.flatnonzero(np.diff(t.starts) == n).tolist():
                for item in items.get(int(own[t.starts[doc]]), ()):
                    yield doc, item, n, n, False
        hits: dict[tuple[int, int], dict[tuple[int, int, int], int]] = defaultdict(dict)
        for (n, reading), (keys, item, at, small) in self.tables.items():
            own = t.windows(n, reading)
            maybe = np.flatnonzero(small[(own >> np.uint64(44)).astype(np.int64)])
            maybe = maybe[t.doc[maybe] == t.doc[maybe + n - 1]]
            low, high = np.searchsorted(keys, own[maybe], side="left"), np.searchsorted(keys, own[maybe], side="right")
            for p, a, b in zip(maybe[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist(), strict=True):
                for k in range(a, b):
                    hits[int(t.doc[p]), int(item[k])].setdefault((p, int(at[k]), n), reading)
        for (doc, item), places in hits.items():
            lines = defaultdict(list)
            for (p, q, n), reading in places.items():
                lines[p - q].append((p, q, n, reading))
            # The best alignment; one that is shifted by a token or two (an insertion) may add to it as far as slots agree.
            covered, values, back = set(), {}, {}
            for _, line in sorted(lines.items(), key=lambda x: (-len(x[1]), -sum(w[3] == RAW for w in x[1]), x[0])):
                pairs = {}
                for p, q, n, reading in line:
                    for i in range(n):
                        if self.tokens.slot[reading or NAMES][q + i]:
                            kind = self.tokens.token[reading or NAMES][q + i]
                            pairs[q + i] = kind, self.tokens.value(q + i), t.value(p + i)
                v, b = dict(values), dict(back)
                counts = Counter(pairs.values())
                for kind, x, y in sorted(counts, key=lambda k: (-counts[k], k[1] != k[2])):
                    if v.get((kind, x), y) == y and b.get((kind, y), x) == x:
                        v[kind, x], b[kind, y] = y, x
                new, used = set(), set()
                for _, q, n, reading in line:
                    own = {pairs[q + i] for i in range(n) if self.tokens.slot[reading][q + i]}
                    if all(v.get((kind, x)) == y for kind, x, y in own):
                        new.update(range(q, q + n))
                        used |= own
                if new - covered:
                    covered |= new
                    values |= {(kind, x): y for kind, x, y in used}
                    back |= {(kind, y): x for kind, x, y in used}
            same = all(x == y for (_, x), y in values.items())
            if covered:
                yield doc, item, len(covered), int(self.size[item]), not same


_LAST: dict[str, Benchmark] = {}


def _once(key: str, items: list[tuple[int, str]], window: int, shortest: int) -> Benchmark:
    """The block's tables, built once in a worker and kept for its next tasks; only the last block's are held."""
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = Benchmark(items, window, shortest)
    return _LAST[key]


def _leaks(items: list[tuple[int, str]], window: int, shortest: int, least: float):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bench = _once(key, items, window, shortest)
        for batch in slices(batches, SLICE):
            ids = batch["doc_id"].tolist()
            rows = [(ids[d], bench.ids[i], c, n, c / n, r) for d, i, c, n, r in bench.match(batch["text"]) if c >= least * n]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "covered", "item_tokens", "coverage", "reparameterised"]).astype({"doc_id": "Int64", "item_id": "Int64", "reparameterised": bool})

    return run


def _kept(items: list[tuple[int, str]], window: int, shortest: int, least: float):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bench = _once(key, items, window, shortest)
        for batch in slices(batches, SLICE):
            bad = {d for d, _, c, n, _ in bench.match(batch["text"]) if c >= least * n}
            yield batch[[i not in bad for i in range(len(batch))]]
        release()

    return run


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars`` characters, each collected when it is due."""
    own = benchmark.select("item_id", "text").where("text is not null")
    total = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        yield sorted((tuple(r) for r in own.where(block == i).collect()), key=lambda r: (r[0] is None, r[0], r[1]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, window: int = 8, shortest: int = 4, least: float = 0.5, block_chars: int = 8_000_000) -> DataFrame:
    """Which benchmark items stand in which documents, as ``LEAKS``: a row per (row of ``docs``, item).

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are not read. An item is reported if
    windows found in the document, with slots that agree, cover ``least`` of its tokens; an item of fewer than
    ``window`` tokens is one window, one of fewer than ``shortest`` is too short to tell and counts only where it is the
    whole text. Template windows of which over half are placeholders say too little and are left out; the same words as
    they stand are found by the raw windows. Null and empty texts have no windows, very long ones are taken whole. Repeated rows are reported each; null ids are carried. Empty tables give an empty one.
    """
    found = [docs.select("doc_id", "text").mapInPandas(_leaks(items, window, shortest, least), LEAKS) for items in _blocks(benchmark, block_chars)]
    return reduce(DataFrame.union, found)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, *, window: int = 8, shortest: int = 4, least: float = 0.5, block_chars: int = 8_000_000) -> DataFrame:
    """``docs``, all columns, without the rows that ``find_leaks`` would report."""
    for items in _blocks(benchmark, block_chars):
        docs = docs.mapInPandas(_kept(items, window, shortest, least), docs.schema)
    return docs
