import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from feedertrace.llm import lm


def test_filter_holds_every_level_and_little_else():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    counts = rng.integers(1, 2000, len(keys))
    f = lm.Filter(1, [(0, lm.build_filter(keys, counts).tobytes())])
    got, want = f.levels(keys), lm.levels_of(counts)
    assert (got >= want).all() and (got == want).mean() > 0.96
    other = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    assert (f.levels(other) > 0).mean() < 0.04


def test_levels():
    n = np.arange(1, 3000)
    back = lm.count_of(lm.levels_of(n))
    assert lm.levels_of(np.array([1]))[0] == 1 and (np.diff(lm.levels_of(n)) >= 0).all()
    assert (np.maximum(back / n, n / back) <= 1.5).all() and lm.count_of(np.array([0]))[0] == 0


def documents():
    rng = random.Random(8)
    vocabulary = ["the", "Cat", "sat", "ON", "é", "mat."] + [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 40)))) for i in range(150)]
    return [*rows, (None, "the cat"), (151, None), (152, ""), (3, rows[3][1])]


def base(rows):
    words = lambda t: ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in (t or "").split()] + [" "]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0
    c = Counter(w for d, t in rows if not held(d) for w in words(t))
    n, v = sum(c.values()), len(c)
    return sorted((str(d), held(d), len(words(t)), sum(c[w] > 0 for w in words(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)), 6)) for d, t in rows)


@pytest.mark.parametrize("frequent", [0, 5, 200_000])
def test_base_scores(spark, frequent):
    rows = documents()
    got = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), frequent=frequent).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == base(rows)


def test_model_prefers_likely_texts_and_both_ways_agree(spark):
    rows = [(i, "the cat sat on the mat and the dog sat too") for i in range(60)] + [(500, "mat the on sat cat the too dog and sat the"), (501, "zz yy xx"), (502, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near = {r.doc_id: r.score for r in lm.score_documents(docs).collect()}
    far = {r.doc_id: r.score for r in lm.score_documents(docs, broadcast_bytes=0).collect()}
    assert near[1] > near[500] and all(math.isfinite(x) and x <= 0 for x in near.values())
    assert {k: round(v, 9) for k, v in near.items()} == {k: round(v, 9) for k, v in far.items()}


def test_far_way_writes_little(spark, monkeypatch):
    # A table of each text's n-grams took several times the input, so 6 GB did not fit a disk of four times that.
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.5)) % 5000}" for _ in range(rng.randrange(0, 400)))) for i in range(2000)]
    docs = spark.createDataFrame([*rows, (None, "w1 w2"), (3000, None), (3, "w7")], "doc_id long, text string")
    written, write = {}, lm.materialize

    def materialize(df, label, **how):
        out = write(df, label, **how)
        written[label] = sum(os.path.getsize(f.removeprefix("file://")) for f in out.inputFiles())
        return out

    monkeypatch.setattr(lm, "materialize", materialize)
    near = sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm.score_documents(docs, frequent=3000).collect())
    written.clear()
    far = sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm.score_documents(docs, frequent=3000, broadcast_bytes=0).collect())
    assert near == far and len(far) == 2003
    assert sum(n for label, n in written.items() if label != "model") < 1.2 * sum(len(t) for _, t in rows)


def test_edges(spark):
    schema = "doc_id long, text string, token string, n int"
    assert lm.score_documents(spark.createDataFrame([], schema)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = lm.score_documents(spark.createDataFrame([(held, "a b", None, None)], schema)).first()
    assert r.held_out and r.n_tokens == 3 and r.n_known == r.train_tokens == 0 and math.isfinite(r.score) and abs(r.base_score) < 1e-9


def test_score_against_exact_counts(spark):
    """The model's score with exact counts, put into the same levels, in place of the filter's answers."""
    rng = random.Random(5)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60)))) for i in range(300)]
    words = lambda t: [*t.split(), " "]
    pairs = lambda t: list(zip([" ", *t.split()], words(t), strict=True))
    train = [t for d, t in rows if zlib.crc32(str(d).encode()) % 10]
    c, cc = Counter(w for t in train for w in words(t)), Counter(p for t in train for p in pairs(t))
    n, v = sum(c.values()), len(c)
    near = lambda k: float(lm.count_of(lm.levels_of(np.array([k])))[0]) if k else 0.0

    def score(t):
        out = 0.0
        for a, b in pairs(t):
            bigram = min(near(cc[a, b]) / near(c[a]), 1.0) if c[a] else 0.0
            out += math.log10(0.6 * bigram + 0.4 * min((near(c[b]) + 0.1) / (n + 0.1 * (v + 1)), 1.0))
        return out

    got = {r.doc_id: r.score for r in lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    off = [abs(got[d] - score(t)) / len(words(t)) for d, t in rows]
    assert np.median(off) < 0.03 and np.mean(off) < 0.06
