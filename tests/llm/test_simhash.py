import math
import random

import numpy as np
import pytest
import xxhash

from feedertrace.llm import simhash


def slow_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def components(values, distance):
    """Smallest index reachable."""
    least = list(range(len(values)))
    for _ in values:
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= distance:
                    least[i] = least[j] = min(least[i], least[j])
    return least


def test_fingerprint():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 50, 3000):
        text = " ".join(rng.choice(["The", "cat", "É", "x,", "ÀB"]) for _ in range(n))
        assert simhash.fingerprint(text) % 2**64 == slow_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n\t") == 0


@pytest.mark.parametrize(("crowded", "distance"), [(64, 2), (2, 2), (0, 2), (64, 3), (0, 3), (2, 1), (0, 0)])
def test_links_reach_what_all_pairs_reach(spark, crowded, distance):
    rng = random.Random(5)
    values = []
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(8):
            values.append(base)
            base ^= sum(1 << i for i in rng.sample(range(64), rng.choice([1, 2, 2, 3])))
    hub = rng.getrandbits(64)
    values += [hub ^ 1 << i for i in range(0, 64, 3)]
    values = sorted(set(values))
    signed = [v - 2**64 if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), crowded=crowded, distance=distance)
    got = {(r.src % 2**64, r.dst % 2**64) for r in edges.collect()}
    assert all((a ^ b).bit_count() <= distance for a, b in got)
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        parent[find(a)] = find(b)
    want = components(values, distance)
    groups = {}
    for v, w in zip(values, want, strict=True):
        groups.setdefault(w, set()).add(find(v))
    assert all(len(x) == 1 for x in groups.values()) and len({y for x in groups.values() for y in x}) == len(groups)


def test_no_exploded_table_is_broadcast(spark):
    # Its size is estimated as that of what it was made from, so at 0.6 GB of documents the driver ran out of memory.
    edges = simhash.links(spark.createDataFrame([(i * 3,) for i in range(50)], "fp long"))
    lines = edges._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    broadcast = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            broadcast += lines[i:below]
    assert any("Generate" in x for x in lines) and not any("Generate" in x for x in broadcast)


def test_near_duplicates(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = [" ".join(word() for _ in range(400)) for _ in range(6)]
    texts += [t.upper() for t in texts[:3]] + [t + " tail" for t in texts] + ["", None, "one", "ONE"]
    docs = spark.createDataFrame([(i + 5, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, fp int")
    rows = {r.doc_id - 5: r for r in simhash.near_duplicates(docs).collect()}
    prints = [slow_fingerprint(t) for t in texts]
    assert [rows[i].fingerprint for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [rows[i].component_id - 5 for i in range(len(texts))] == components(prints, 2)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id - 5 for r in kept.collect()) == sorted(set(components(prints, 2)))


def edited(rng, text, share):
    words = text.split()
    for i in rng.sample(range(len(words)), max(1, int(len(words) * share))):
        words[i] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


def jaccard(a, b):
    p, q = (set(simhash.shingles(x, 5).tolist()) for x in (a, b))
    return len(p & q) / max(1, len(p | q))


@pytest.mark.parametrize("crowded", [64, 4])
def test_near_copies_by_jaccard(spark, crowded):
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 400))) for _ in range(60)]
    for t in texts[:40]:
        texts += [edited(rng, t, share) for share in (0.01, 0.02, 0.03, 0.08)]
    texts += [texts[0]] * 30 + [None, "", "a b c", "A b  c", "a b c d"]
    docs = spark.createDataFrame([(i if i % 50 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, c string")
    rows, links = simhash.similar_classes(docs, crowded=crowded)
    classes = {r.c: r.key for r in rows.collect()}
    got = {frozenset((r.src, r.dst)) for r in links.collect()}
    text_of = {}
    for t in texts:
        import xxhash

        text_of[np.array([xxhash.xxh64_intdigest(simhash.shingles(t, 5).tobytes(), 3)], dtype=np.uint64).view(np.int64)[0]] = t
    assert set(text_of) == set(classes)
    ids = sorted(text_of)
    want = {frozenset((a, b)) for i, a in enumerate(ids) for b in ids[:i] if text_of[a] and text_of[b] and jaccard(text_of[a], text_of[b]) >= 0.8}
    assert len(want) > 60 and got <= want and (len(got) >= 0.97 * len(want) or crowded < 64)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in map(tuple, want):
        parent[find(a)] = find(b)
    groups = len({find(i) for i in ids})
    kept = simhash.one_of_each(docs, crowded=crowded)
    assert kept.columns == docs.columns
    n = kept.count()
    assert groups <= n <= groups + 2


def test_crowds_lose_no_component(spark):
    # Chains of copies, each like its neighbours alone, so few are like a crowd's leaders; and one large group of copies.
    rng = random.Random(21)
    texts = []
    for _ in range(6):
        words = [f"w{rng.randrange(9000)}" for _ in range(300)]
        for i in range(25):
            texts.append(" ".join(words))
            words[12 * i : 12 * i + 3] = [f"n{rng.randrange(10**6)}" for _ in range(3)]
    texts += [edited(rng, texts[0], 0.01) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def kept(crowded):
        return sorted(r.doc_id for r in simhash.one_of_each(docs, crowded=crowded).select("doc_id").collect())

    everything = kept(10**6)
    assert kept(4) == everything == kept(0) and len(everything) < 20


def test_strangers_are_all_pairs_between_components(spark):
    rng = random.Random(23)
    shape = simhash.Layout(2, 4, 1, 30)
    prints = [rng.getrandbits(64) for _ in range(60)]
    classes = spark.createDataFrame([(i, [p - 2**64 if p >> 63 else p]) for i, p in enumerate(prints)], "c long, fp array<long>")
    component = {i: min(i, i % 7) if i % 3 else i for i in range(60)}
    joined = spark.createDataFrame(list(component.items()), "node long, component long").where("node % 3 <> 0")
    want = set()
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            halves = [(a ^ b) >> 4 * k & 15 for k in range(2)]
            if any(h.bit_count() <= 1 for h in halves) and (a ^ b).bit_count() <= 30 and component[i] != component[j]:
                want.add((j, i))
    found = simhash.strangers(simhash.meetings(classes, shape), joined, classes, shape, crowded=0).collect()
    assert len(want) > 50 and {(r.a, r.b) for r in found} == want and len(found) == len(want)


def test_layouts():
    for n in (0, 1, 1000, 10**6, 10**9):
        shape = simhash.layout(n, 0.8)
        assert shape.segments * shape.width <= 64 * shape.lanes and shape.width >= min(40, math.log2(max(n, 2)) + 6)
    assert simhash.layout(10, 1.0).segments == 1


def test_one_of_each_edges(spark):
    schema = "doc_id long, text string, key long"
    assert simhash.one_of_each(spark.createDataFrame([], schema)).count() == 0
    long = " ".join(f"w{i}" for i in range(300_000))
    rows = [(1, "a b", 1), (1, "a b", 1), (1, "c d", 2), (None, "a b", 3), (None, "e f", 4), (None, "e f", 4), (7, None, 5), (6, " ", 6), (8, long, 7), (9, long + " x", 8)]
    kept = sorted(map(str, (tuple(r) for r in simhash.one_of_each(spark.createDataFrame(rows, schema)).select("doc_id", "key").collect())))
    assert kept == sorted(map(str, [(1, 1), (1, 2), (None, 4), (6, 6), (8, 7)]))


def test_edges(spark):
    schema = "doc_id long, text string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = simhash.near_duplicates(spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b"), (None, "q")], schema)).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in rows if r.component_id) == [(False, 3), (False, 3), (True, 3)] and len(rows) == 4


def test_components_are_made_once(spark, monkeypatch):
    # With nothing left over by the leaders, the links' components serve; else only their stars and the new links meet.
    rng = random.Random(31)
    given, plain = [], simhash.connected_components
    monkeypatch.setattr(simhash, "connected_components", lambda e: given.append(e.count()) or plain(e))
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(100)) for _ in range(6)]
    texts += [edited(rng, t, 0.01) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == list(range(6)) and len(given) == 1
