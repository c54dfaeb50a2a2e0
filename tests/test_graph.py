import random

from hypothesis import given, settings
from hypothesis import strategies as st

from feedertrace.operators.graph import connected_components


def brute(edges):
    least = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)).filter(lambda e: e[0] != e[1]), min_size=1, max_size=30))
def test_components(spark_session, edges):
    got = connected_components(spark_session.createDataFrame(edges, "src long, dst long")).collect()
    assert dict(map(tuple, got)) == brute(edges) and len(got) == len(brute(edges))


def test_chain_star_and_nulls(spark):
    chain = list(range(40))
    random.Random(1).shuffle(chain)
    edges = [*zip(chain, chain[1:]), *((100, i) for i in range(101, 160)), (None, 3), (7, 7), (100, 101)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()))
    assert got == {i: 0 for i in chain} | {i: 100 for i in range(100, 160)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
