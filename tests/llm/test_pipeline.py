"""The pipeline's stages against plain versions on a small corpus, each on its own input."""

import os
import random

import pytest

import corpus_pipeline
from feedertrace.llm import classifier
from feedertrace.session import read_table
from tests.llm.test_line_dedup import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    line = lambda n: " ".join(word() for _ in range(n))
    docs, labels = [], []
    shared, items = line(20), [line(16) for _ in range(3)]
    for i in range(240):
        bad = i % 6 == 0
        text = "\n".join(line(rng.randrange(9, 30)) for _ in range(rng.randrange(1, 5)))
        if bad:
            text = " ".join(w + "$$$" for w in text.split())
        elif i % 10 == 1:
            text += "\n" + shared
        elif i % 10 == 3:
            text += " " + items[i % 3]
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        if i % 2 == 0 or bad:
            labels.append((i, int(not bad), 0))
    docs += [(300 + i, docs[i + 1][1], "en", "s0", docs[i + 1][4]) for i in range(4)]
    docs += [(400, None, None, None, None), (401, "", "en", "s1", 0), (None, line(12), "en", "s1", 3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, items


def test_stages(spark, folder):
    d, items = folder
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    docs = read_table(spark, d, "documents")
    step = dict(corpus_pipeline.STAGES)

    good = step["quality classifier"](spark, docs, d)
    assert good.columns == COLUMNS
    scores = {r.doc_id: r.score for r in classifier.score(docs, classifier.fit(docs, read_table(spark, d, "labels"))).collect()}
    kept = {r.doc_id for r in good.collect()}
    assert kept == {k for k, v in scores.items() if v >= 0.3}
    bad = {i for i in range(240) if i % 6 == 0}
    assert len(kept & bad) <= 2 and len({i for i in range(240)} - bad - kept) <= 4
    good = spark.createDataFrame(good.collect(), good.schema)

    lines = step["line dedup"](spark, good, d)
    assert lines.columns == COLUMNS and [t for _, t in lines.dtypes] == [t for _, t in docs.dtypes]
    rows = lines.collect()
    want = brute([(r.doc_id if r.doc_id is not None else 10**9, r.text) for r in good.collect()], 8)
    assert {r.doc_id if r.doc_id is not None else 10**9: r.text for r in rows} == want
    lines = spark.createDataFrame(rows, lines.schema)

    one = step["SimHash near-dedup"](spark, lines, d)
    assert one.columns == COLUMNS
    ids = [r.doc_id for r in one.collect()]
    texts = [r.text or "" for r in one.collect() if r.doc_id is not None]
    assert len(texts) == len(set(texts)) and {r.text or "" for r in rows if r.doc_id is not None} == set(texts) and None in ids

    clean = step["benchmark decontamination"](spark, one, d)
    want = {r.doc_id for r in one.collect() if not any(item in (r.text or "") for item in items)}
    assert clean.columns == COLUMNS and {r.doc_id for r in clean.collect()} == want and len(want) < len(ids)

    packed = step["best-fit packing"](spark, clean, d).collect()
    assert {r.doc_id for r in packed} == want


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert out.count() > 100 and "sequence_id" in out.columns and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="the driver's data are not there")
def test_all_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
