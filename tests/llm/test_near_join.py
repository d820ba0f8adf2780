"""The near-copy components against brute force over all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harborline.llm import near_join, shingles
from harborline.llm.components import components

DOCS = "doc_id long, text string"


def brute_set(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_components(rows):
    sets = [(i, brute_set(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                i, j = find(sets[a][0]), find(sets[b][0])
                root[max(i, j)] = min(i, j)
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed=5):
    """Near copies at many distances, exact copies, a passage that many share, short and empty texts."""
    rng = random.Random(seed)

    def words(n):
        return [f"w{rng.randrange(4000)}" for _ in range(n)]

    passage, texts = words(60), [None, "", " \n ", "one", "One two", "one two three four", "a b c d e", "A b C d e"]
    for _ in range(6):
        base = words(rng.randrange(30, 160))
        for _ in range(rng.randrange(2, 40)):
            copy = list(base)
            for _ in range(rng.randrange(0, 7)):
                at = rng.randrange(len(copy))
                copy[at:at + rng.randrange(0, 2)] = words(rng.randrange(0, 2))
            texts.append(" ".join(copy))
    texts += [" ".join(words(40) + passage + words(rng.randrange(10, 60))) for _ in range(90)]
    texts += [" ".join(passage)] * 3 + ["x " * 50, "X " * 49, " ".join(words(9000))]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


SPLIT = {"cells": 1 << 14, "split_class": 1}


@pytest.mark.parametrize("options, short", [({}, 64), ({"cells": 1 << 14}, 8), (SPLIT, 64), (SPLIT, 8)])
def test_components_are_exact(spark, monkeypatch, options, short):
    monkeypatch.setattr(near_join, "SHORT_LIST", short)
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS).repartition(5).selectExpr("*", "1 AS n", "2 AS set_id", "'x' AS component_id")
    got = near_join.near_components(docs, **options).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows) and len(got) == len(rows)


def test_regions_smaller_than_a_list(spark, monkeypatch):
    monkeypatch.setattr(near_join, "SHORT_LIST", 4)
    monkeypatch.setattr(near_join, "REGION", 7)
    rows = corpus(9)
    got = near_join.near_components(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_the_threshold_itself(spark):
    """Three quarters exactly is a link, one shingle less is none."""
    base = [f"v{i}" for i in range(11)]  # 7 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:9] + ["z"] + base[9:])), (3, " ".join(base[1:])), (4, " ".join(base[2:]))]
    got = {r.doc_id: r.component_id for r in near_join.near_components(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows).items()}
    for n in range(1, 60):
        for m in range(n, 60):
            need = int(near_join.needed(np.int64(n), np.int64(m)))
            assert 100 * need >= 75 * (n + m - need) and not 100 * (need - 1) >= 75 * (n + m - need + 1)


def test_null_ids_repeats_and_empty_tables(spark):
    text = " ".join(f"q{i}" for i in range(30))
    rows = [(None, text), (None, None), (5, text), (5, text), (7, text + " more"), (7, "other words are here now"), (9, None)]
    got = sorted(map(tuple, near_join.near_components(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    want = [(None, 26, None), (None, 0, None), (5, 26, 5), (5, 26, 5), (7, 27, 5), (7, 1, 7), (9, 0, 9)]
    assert got == sorted(want, key=str)
    assert near_join.near_components(spark.createDataFrame([], DOCS)).count() == 0


def test_one_document_of_each_group_stays(spark):
    rows = corpus(2)
    docs = spark.createDataFrame(rows + [(None, "no id")], DOCS).selectExpr("doc_id", "text", "1 AS _gone", "2 AS component_id")
    kept = near_join.one_per_component(docs)
    want = {c for _, c in brute_components(rows).values()} | {None}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want and kept.count() == len(want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbB é\t\n\x0b\x1c  ß😀"), max_size=40)), max_size=12))
def test_shingles_of_any_text(texts):
    sets = list(shingles.shingle_sets(pa.array(texts, pa.string())))
    assert [len(s) for s in sets] == [len(brute_set(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            assert len(np.intersect1d(sets[i], sets[j])) == len(brute_set(a) & brute_set(b))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 40), min_size=1), min_size=2, max_size=12))
def test_derived_answers_equal_overlaps(sets):
    answers = near_join.Answers([np.array(sorted(s), np.uint64) for s in sets])
    for i, s in enumerate(sets):
        assert answers.of(i).tolist() == [len(s & t) for t in sets]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50, unique=True), st.lists(st.integers(0, 2**64 - 1), max_size=50, unique=True))
def test_marks_never_lose_overlap(a, b):
    a, b = (np.array(sorted(x), np.uint64) for x in (a, b))
    marks = near_join.read_marks({1: near_join.marks(a), 2: near_join.marks(b)})
    assert len(marks[1]) == len(a) and len(np.unique(marks[2])) == len(b)
    assert len(np.intersect1d(marks[1], marks[2])) >= len(np.intersect1d(a, b))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)).filter(lambda e: e[0] != e[1]), min_size=1, max_size=30))
def test_components_of_any_links(spark, links):
    root = {n: n for e in links for n in e}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == root
