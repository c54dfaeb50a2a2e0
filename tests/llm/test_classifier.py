import math
import random
import zlib

import numpy as np

from feedertrace.llm import classifier


def test_learns_and_ignores_held_out_labels(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = " ".join(("".join(rng.choice("abcdef") for _ in range(5)) + ("%%%" if bad else "")) for _ in range(30))
        docs.append((i, text, bad, 0.5))
        labels.append((i, int(not bad) if zlib.crc32(str(i).encode()) % 5 else int(bad)))
    docs += [(900, None, True, 0.1), (901, "", True, 0.1), (None, "abc", True, 0.1), (3, docs[3][1], False, 0.0)]
    labels += [(None, 1), (5000, 0), (7, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang boolean, score double")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    w = classifier.fit(d, lab)
    rows = classifier.score(d, w).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.predicted == (r.doc_id % 4 != 0) for r in held) / len(held) > 0.97
    kept = classifier.keep_good(d, w)
    assert kept.columns == d.columns and kept.count() == sum(r.predicted for r in rows)
    assert np.array_equal(w, classifier.fit(d.orderBy("text"), lab))
    assert classifier.score(d.limit(0), w).count() == 0
    assert not classifier.fit(d, lab.limit(0)).any()


def test_features():
    h = classifier.Hasher(12)
    at, x = h.features("The cat! The cat!")
    assert at.max() < 4096 and abs((x[:-1] ** 2).sum() - 1) < 1e-9
    assert len(h.features(None)[0]) == 1


def test_training_is_that_of_the_formula():
    """Weights against the per-coordinate update written out with dicts."""
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(40):
        at = rng.choice(64, size=rng.integers(1, 12), replace=False)
        rows.append((int(rng.integers(0, 2)), at.astype(np.int32), rng.random(len(at)).astype(np.float32)))
    alpha, beta, l1, l2 = 0.5, 1.0, 1e-2, 1e-3
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(3):
        for label, at, x in rows:
            w = {i: weight(i) for i in at.tolist()}
            p = 1 / (1 + math.exp(-sum(w[i] * float(v) for i, v in zip(at.tolist(), x, strict=True))))
            for i, v in zip(at.tolist(), x, strict=True):
                g = (p - label) * float(v)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha * w[i]
                n[i] = n.get(i, 0.0) + g * g
    got = classifier.train(rows, 6, epochs=3, alpha=alpha, beta=beta, l1=l1, l2=l2)
    assert np.allclose(got, [weight(i) for i in range(64)], atol=1e-6) and (got != 0).any()


def test_sample_is_bounded_in_rows_and_values(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * (i + 1)) for i in range(40)] + [(3, "longer text of the same id"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    assert np.any(classifier.fit(docs, labels, bits=10)) and not np.any(classifier.fit(docs, labels, bits=10, max_values=1))
    few = classifier.fit(docs, labels, bits=10, max_values=40)
    assert np.any(few) and (few != 0).sum() <= 40
    assert not np.any(classifier.fit(docs.limit(0), labels, bits=10)) and not np.any(classifier.fit(docs, labels.limit(0), bits=10))
