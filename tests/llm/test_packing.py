import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedertrace.llm import packing

FOLDER = packing.tokenizer_folder()


def exact(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F, blacklist_categories=("Cs",)), st.characters(blacklist_categories=("Cs",)), st.sampled_from(" \n\t\r'.,<|endoftext|>")), max_size=60))
def test_ids_are_those_of_the_defining_library(text):
    assert packing.encoder(FOLDER, "byte_bpe_50k")(text) == exact([text])[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "a", " hi", "é", "中", "\n", "<"]), max_size=8).map("".join))
def test_special_tokens_in_a_text(text):
    ids = packing.encoder(FOLDER, "byte_bpe_50k")(text)
    assert ids == exact([text])[0] and ids.count(50256) == text.count("<|endoftext|>")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_places_each_rank_once_without_overlap(counts):
    runs = packing.plan_runs(counts, 64)
    ranks, used = defaultdict(list), defaultdict(list)
    for length, rank, n, seq, offset in runs:
        ranks[length] += range(rank, rank + n)
        for i in range(n):
            used[seq + i].append((offset, offset + length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for spans in used.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 64
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def best_fit_decreasing(lengths, cap):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(cap - n)
    return len(gaps)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_plan_needs_no_more_sequences_than_serial_best_fit(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs = packing.plan_runs(counts, 50)
    assert len({s + i for _, _, n, s, _ in runs for i in range(n)}) == best_fit_decreasing(lengths, 50)


def test_pack_documents(spark):
    rng = random.Random(1)
    texts = ["", None, "word " * 700, "same text", "same text", "naïve café ß", "漢字かな交じり文 <|endoftext|>"]
    texts += [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, piece string, sequence_id int")
    ids = [[*x, 2] for x in exact(texts)]
    rows = packing.pack_documents(docs, seq_len=64).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        got = ids[r.doc_id][r.start : r.start + r.length]
        assert len(got) == r.length and zlib.crc32(np.array(got, "<u4").tobytes()) == r.ids_crc32
        by_doc[r.doc_id].append((r.piece, r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    for i, x in enumerate(ids):
        pieces = sorted(by_doc[i])
        assert [p[0] for p in pieces] == list(range(len(pieces))) and sum(p[2] for p in pieces) == len(x)
        assert len(x) > 64 or len(pieces) == 1
    for spans in by_seq.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 64
    assert len(by_seq) <= best_fit_decreasing([r.length for r in rows], 64)
    out = {r.sequence_id: r.ids for r in packing.packed_sequences(docs, packing.pack_documents(docs, seq_len=64), seq_len=64).collect()}
    assert sum(map(len, out.values())) == sum(map(len, ids)) and max(map(len, out.values())) <= 64


@pytest.mark.parametrize("rows", [[], [(None, None), (None, "a"), (3, "b"), (3, "b")]])
def test_pack_edges(spark, rows):
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and sorted(r.sequence_id for r in got) == [0] * len(rows)
