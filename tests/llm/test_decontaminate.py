import random

from feedertrace.llm import decontaminate as d

ITEM = "A train leaves Boston at 60 mph and travels 120 miles to reach Albany before noon; how long does it take?"


def leaks(item, text, **kw):
    bench = d.Benchmark([(1, item)], 8, 4)
    return [(c / n >= 0.5, r) for _, _, c, n, r in bench.match([text])]


def test_classify():
    assert [d.classify(w)[0] for w in ("60", "1,200.50", "$5", "3rd", "5km", "mph", "Boston", "and", "USA", "...", "(x)")] == [1, 1, 1, 1, 1, 2, 3, 4, 4, 0, 4]


def test_exact_and_reparameterised():
    assert leaks(ITEM, "Filler words here. " + ITEM + " More.") == [(True, False)]
    other = ITEM.replace("Boston", "Denver").replace("60", "75").replace("120", "300").replace("Albany", "Aspen")
    assert leaks(ITEM, "so " + other) == [(True, True)]
    assert leaks(ITEM, ITEM.replace("and travels", "and then slowly travels")) == [(True, False)]
    assert leaks(ITEM, "Nothing of the sort stands here at all, not even a number like 60 or a name like Boston.") == []


def test_slots_must_agree():
    item = "Tom gives Anna 3 apples and then Anna gives back 3 apples to Tom and Anna smiles"
    good = "Jim gives Beth 5 apples and then Beth gives back 5 apples to Jim and Beth smiles"
    bad = "Jim gives Beth 5 apples and then Carl gives back 6 apples to Rudy and Walt smiles"
    assert leaks(item, good)[0] == (True, True)
    assert not any(x for x, _ in leaks(item, bad))


def test_against_brute_force(spark):
    rng = random.Random(6)
    words = [f"w{i}x" for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([2, 5, 12, 30])))) for i in range(40)] + [(None, " ".join(words[:20])), (99, None), (98, "")]
    docs, want = [], set()
    for i in range(80):
        own = rng.choices(words, k=rng.randrange(0, 200))
        if rng.random() < 0.5:
            k, text = rng.choice(items[:40])
            at = rng.randrange(len(own) + 1)
            own[at:at] = text.split()
        docs.append((i, " ".join(own), {"a": "b"}))
    for i, text, _ in docs:
        for k, item in items[:41]:
            n = len(item.split())
            size = min(8, n)
            own, it = text.split(), item.split()
            grams = {tuple(own[j : j + size]) for j in range(len(own) - size + 1)}
            covered = {q + j for q in range(n - size + 1) if tuple(it[q : q + size]) in grams for j in range(size)}
            if n >= 4 and len(covered) >= 0.5 * n:
                want.add((i, k))
    docs += [(500, None, None), (None, items[5][1] if len(items[5][1].split()) >= 4 else items[40][1], None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id map<string,string>")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (8_000_000, 500):
        rows = d.find_leaks(frame, bench, block_chars=block).collect()
        assert {(r.doc_id, r.item_id) for r in rows if r.doc_id is not None} == want and any(r.doc_id is None for r in rows)
        kept = d.remove_leaks(frame, bench, block_chars=block)
        assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {i for i, *_ in docs if i is not None} - {i for i, _ in want}
    assert d.find_leaks(frame.limit(0), bench).count() == d.find_leaks(frame, bench.limit(0)).count() == 0


def test_names_at_the_start_of_sentences():
    item = "Tom has 5 apples. Sara gives him 7 more apples. Tom then eats 2 of the apples. Sara takes 3."
    assert leaks(item, item.replace("Tom", "Ben").replace("Sara", "Ann")) == [(True, True)]
    assert leaks(item, "Now it is said that " + item) == [(True, False)]
    assert leaks("The boat that they saw is red and old", "we know that the boat that they saw is red and old") == [(True, False)]


def test_copies_without_literal_words_and_with_a_changed_slot():
    item = "What is 12 + 15 + 18 + 20 + 22?"
    assert leaks(item, "He asked: " + item + " Nobody knew.") == [(True, False)]
    item = "the old bridge over the wide river was built in 1990 by the town and the mill beside it was opened in 1990 too when the council had sold the land to the miller"
    assert leaks(item, item.replace("1990 by", "1991 by"))[0][0]
    item = "the farmer sold 40 eggs to the baker and 12 eggs to the cook while 15 eggs were left in the basket that stood behind the kitchen door all day"
    other = item.replace("40", "60").replace("12", "15")
    assert leaks(item, other)[0][0]


def test_short_items_count_as_whole_texts(spark):
    bench = spark.createDataFrame([(1, "Is 7 prime?"), (2, "the")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "is 7  prime"), (2, "so is 7 prime? yes"), (3, "is 9 prime?"), (4, "The"), (5, None), (6, "")], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in d.find_leaks(docs, bench).collect()) == [(1, 1), (4, 2)]
    assert sorted(r.doc_id for r in d.remove_leaks(docs, bench).collect()) == [2, 3, 5, 6]


def test_recall_of_items_asked_again(spark):
    """Items with all names and numbers replaced, each by one other value: found. With slots that disagree: mostly not."""
    import random

    rng = random.Random(4)
    names, others = ["Tom", "Sara", "Mia", "Joe", "Lena"], ["Ben", "Ann", "Kai", "Uma", "Rex"]
    verbs = "buys sells finds loses paints counts carries trades wraps cleans".split()
    things = "apples boxes stones lamps books coins shells ropes bricks cards".split()
    items, again, broken = [], [], []
    for i in range(60):
        a, b = rng.sample(range(5), 2)
        parts = []
        for _ in range(5):
            who, n = rng.choice((a, b)), rng.randrange(2, 90)
            tail = " ".join(rng.choices(things, k=3))
            parts.append((who, n, rng.choice(verbs), f"{tail} at the {rng.choice(things)} market"))
        new = dict(zip(sorted({n for _, n, _, _ in parts}), rng.sample(range(100, 999), 5), strict=False))
        say = lambda who, num: " ".join(f"Then {who[w]} {v} {num(n)} {x}." for w, n, v, x in parts)  # noqa: B023, E731
        items.append((i, say(names, lambda n: n)))
        again.append((i, "Some words first. " + say(others, new.get) + " And words after."))
        broken.append((i + 100, "Some words first. " + " ".join(f"Then {rng.choice(others)} {v} {rng.randrange(100, 999)} {rng.choice(things)} of all {x.split()[0]}." for _, _, v, x in parts)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.reparameterised for r in d.find_leaks(spark.createDataFrame(again + broken, "doc_id long, text string"), bench).collect()}
    assert sum((i, i) in found for i in range(60)) >= 57 and all(found[i, i] for i in range(60) if (i, i) in found)
    assert sum(x >= 100 for x, _ in found) <= 2
