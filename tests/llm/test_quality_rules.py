import random
from collections import Counter

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from feedertrace.llm import quality_rules as q

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40), st.integers(1, 5))
def test_repeated(words, window):
    grams = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    n = Counter(grams)
    assert q.repeated(words, window) == len({i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(window)})


def test_measure():
    assert q.measure("a b #x\nq\n\nq\n \nq") == (5, 8, 1, 4, 2, 0)
    assert q.measure(None) == q.measure("") == (0,) * 6


def test_judge_equals_sql(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        host = rng.choice(["good", "good", "bad", "odd", None])
        n = rng.choice([0, 3, 12, 40])
        word = (lambda: rng.choice(["x###", "***"])) if host == "bad" and rng.random() < 0.9 else (lambda: rng.choice(["alpha", "béta", "gamma", "d", "e\nf", "iota", "kappa"]))
        rows.append((i if i % 17 else None, rng.choice([" ", "\n"]).join(word() for _ in range(n)) if n else rng.choice(["", None]), host, "extra"))
    rows += rows[:5]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words string")
    got = q.judge(docs).select(*COLUMNS).toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.sql(q.SQL).df()[COLUMNS]
    key = lambda d: sorted(map(str, d.astype(object).where(d.notna(), None).itertuples(index=False)))
    assert [x.replace(".0", "") for x in key(got)] == [x.replace(".0", "") for x in key(want)]
    assert q.judge(docs.limit(0)).count() == 0
    hosts = {r.host: r for r in q.host_rates(spark.createDataFrame([("a", True)] * 2 + [("b", False)] * 50, "host string, failed boolean")).collect()}
    assert 0 < hosts["b"].shrunk < 0.1 < hosts["a"].shrunk < 1
