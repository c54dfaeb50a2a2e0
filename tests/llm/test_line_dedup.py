import random

import pytest

from feedertrace.llm import line_dedup


def brute(docs, min_words):
    """Longest run from each line that has an earlier equal without overlap; all those of enough words are deleted."""
    order = sorted(range(len(docs)), key=lambda i: docs[i][0])
    lines = [[x for x in (docs[i][1] or "").split("\n") if x.split()] for i in range(len(docs))]
    places = [(o, i, p) for o, i in enumerate(order) for p in range(len(lines[i]))]
    gone = set()
    for n, (o, i, p) in enumerate(places):
        best = 0
        for a, j, q in places[:n]:
            k = 0
            while p + k < len(lines[i]) and q + k < len(lines[j]) and lines[i][p + k] == lines[j][q + k]:
                k += 1
            best = max(best, min(k, p - q) if i == j else k)
        if sum(len(x.split()) for x in lines[i][p : p + best]) >= min_words:
            gone |= {(i, p + k) for k in range(best)}
    out = {}
    for i, (doc_id, text) in enumerate(docs):
        if text is None:
            out[doc_id] = None
            continue
        kept, p = [], 0
        for x in text.split("\n"):
            if x.split():
                if (i, p) not in gone:
                    kept.append(x)
                p += 1
            else:
                kept.append(x)
        out[doc_id] = "\n".join(kept)
    return out


@pytest.mark.parametrize(("seed", "min_words"), [(1, 1), (2, 4), (3, 8), (4, 13), (5, 3)])
def test_against_brute_force(spark, seed, min_words):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randrange(1, 6))) for _ in range(14)] + ["", " ", "x y z w v u t s r q"]
    docs = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 14)))) for i in range(14)]
    passage = "\n".join(rng.choices(pool, k=9))
    for i in (3, 7, 9):
        docs[i] = (i, docs[i][1] + "\n" + passage + "\n" + docs[i][1][:5])
    docs += [(20, docs[3][1]), (21, None), (22, "")]
    frame = spark.createDataFrame([(*x, 1, "q") for x in rng.sample(docs, len(docs))], "doc_id long, text string, idx int, name string")
    got = line_dedup.dedup_lines(frame, min_words=min_words)
    assert got.columns == [*frame.columns, "n_lines", "n_deleted"]
    rows = {r.doc_id: r for r in got.collect()}
    assert {k: r.text for k, r in rows.items()} == brute(docs, min_words)
    size = lambda text: len(text.split("\n"))
    assert all(r.n_deleted == r.n_lines - size(r.text) for r in rows.values() if r.text)
    assert (rows[21].n_lines, rows[21].n_deleted, rows[22].n_lines, rows[22].n_deleted) == (0, 0, 1, 0)


def test_copies_that_overlap_leave_the_first_whole(spark):
    rng = random.Random(9)
    texts = ["\n".join(["w x y z"] * 4), "\n".join(["a"] * 21), "\n".join("pqr" * 9), "\n".join(["a"] * 10)]
    texts += ["\n".join(rng.choices("kl", k=40)) for _ in range(6)]
    docs = list(enumerate(texts))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_words=8).collect()}
    assert got == brute(docs, 8) and got[0] == "w x y z\nw x y z"


def test_maximal_runs_and_ranks(spark):
    copies = "\n".join(f"line number {i} of the text" for i in range(37))
    frame = spark.createDataFrame([(1, copies), (2, "x y z\n" + copies + "\nq"), (3, copies + "\nend of it all")], "doc_id long, text string")
    runs = sorted((r.low, r.high) for r in line_dedup.repeated_runs(frame).collect())
    assert runs == [(0, 36), (1, 37)]
    levels = line_dedup.suffix_ranks(line_dedup._positions(frame, 8))
    assert len(levels) == 6  # the longest repeat has 37 lines
    line = {r.r: r.idx for r in levels[0].collect() if True}
    assert len(line) == 37
    for k, level in enumerate(levels):
        ranks = {}
        for r in level.collect():
            ranks.setdefault(r.r, []).append((r._a, r.idx))
        assert all(len(x) == 3 for x in ranks.values()) and len(ranks) == 37 - (1 << k) + 1


def test_edges(spark):
    schema = "doc_id long, text string, n_lines int"
    assert line_dedup.dedup_lines(spark.createDataFrame([], schema)).count() == 0
    line = "one two three four five six seven eight nine"
    rows = line_dedup.dedup_lines(spark.createDataFrame([(None, line, 1), (2, line, 1), (2, line, 1), (None, None, 1), (1, line + "\n" + line, 0)], schema)).collect()
    assert sorted(r.text is None and "-" or r.text for r in rows) == ["", "", "", "-", line]
