"""Jaccard join, repeated passages and embeddings against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import words as _  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import components, embeddings, jaccard, substring
from shelfcast.llm import words as W

SPLIT = re.compile("[\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def tokens(text, lower=False):
    text = (text or "").translate(LOWER) if lower else text or ""
    return [w for w in SPLIT.split(text) if w]


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_jaccard(rows, size, percent):
    sets = []
    for _, text in rows:
        w = tokens(text, True)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    pairs = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and rows[i][0] is not None and rows[j][0] is not None:
                pairs.append((rows[i][0], rows[j][0]))
    found = roots(pairs, [r[0] for r in rows if r[0] is not None])
    return sorted((r[0], len(s), found[r[0]]) for r, s in zip(rows, sets) if r[0] is not None)


def near_copies(seed=0):
    rng = random.Random(seed)
    rows, vocabulary = [], [f"v{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 20, 90, 300]))]
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 40)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy if family % 3 else copy + passage).capitalize()))
    return rows


@pytest.mark.parametrize("block,hot", [(1024, 200), (2, 3)])
def test_jaccard(make, monkeypatch, block, hot, odd_rows):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "LOCAL_HOT", 2)
    rows = near_copies() + [(100 + (i or 0) if i is not None else None, t) for i, t in odd_rows]
    got = jaccard.similar_groups(make(rows), 4, 85).collect()
    assert len(got) == len(rows)
    assert sorted(tuple(r) for r in got if r.id is not None) == brute_jaccard(rows, 4, 85)
    assert all(r.component_id is None for r in got if r.id is None)


def test_jaccard_empty(make):
    assert jaccard.similar_groups(make([]), 5, 80).count() == 0


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=20))
@settings(max_examples=4, deadline=None)
def test_components(spark, pairs):
    links = spark.createDataFrame(pairs or [(0, 0)], "a long, b long")
    got = dict(components.components(links).collect())
    want = roots(pairs, {n for p in pairs for n in p})
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: want[n] for n in linked}


def brute_repeats(rows, size):
    lists = [tokens(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in lists for i in range(len(w) - size + 1))
    out = []
    for (i, _), w in zip(rows, lists):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i is None, i or 0, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot,bucket", [(5000, 1_500_000), (1, 300)])
def test_substring(make, monkeypatch, hot, bucket, odd_rows):
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "LOCAL_HOT", 1)
    monkeypatch.setattr(substring, "BUCKET_WORDS", bucket)
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = [(20 + k, " ".join([f"u{k}x{rng.randrange(99)}" for _ in range(rng.randrange(0, 80))] + passage[k % 7 : 40 + k] + ["\n", "t"])) for k in range(15)]
    rows += [(50, "same line again \n " * 40), (51, " ".join(passage).replace(" ", "  "))] + odd_rows
    got = substring.remove_repeats(make(rows), 35, digests=True).collect()
    assert sorted((r.id is None, r.id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_repeats(rows, 35)


def test_substring_as_is(make):
    rows = [(1, "a  b\nc"), (2, " ".join(f"k{i}" for i in range(50)) + " x"), (3, "y " + " ".join(f"k{i}" for i in range(50)))]
    got = {r.id: r for r in substring.remove_repeats(make(rows), 50, as_is=True, carry=("lang", "score")).collect()}
    assert [got[k].kept for k in (1, 2, 3)] == ["a  b\nc", "x", "y"] and got[1].score == "y"
    assert substring.remove_repeats(make([]), 50).count() == 0


def test_minimisers_of_equal_windows_agree():
    text = " ".join(f"a{i % 50}" for i in range(300))
    data, offsets = W.plain(__import__("pyarrow").array([text]))
    block = W.split(data, offsets)
    first, number, route = substring.super_kmers(block, block.hashes(), 35, np.zeros(0, np.uint64))
    of = {int(f) + k: r for f, n, r in zip(first, number, route) for k in range(n)}
    assert sorted(of) == list(range(266)) and all(of[i] == of[i + 50] for i in range(216))


def brute_vectors(rows, threshold):
    unit = []
    for _, v, label in rows:
        ok = v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    count, pairs = [0] * len(rows), []
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is None or unit[j] is None or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]):
                continue
            if unit[i] @ unit[j] >= threshold:
                count[i] += 1
                count[j] += 1
                pairs.append((rows[i][0], rows[j][0]))
    found = roots(pairs, [r[0] for r in rows])
    return sorted((r[0], c, found[r[0]], found[r[0]] == r[0]) for r, c in zip(rows, count))


@pytest.mark.parametrize("cell,threshold", [(4096, 0.98), (16, 0.98), (16, 0.6)])
def test_embeddings(spark, monkeypatch, cell, threshold):
    monkeypatch.setattr(embeddings, "CELL", cell)
    rng = np.random.default_rng(5)
    rows = []
    for k in range(40):
        base = rng.standard_normal(8)
        rows += [(len(rows) + i, (base + rng.standard_normal(8) * s).tolist(), k % 2) for i, s in enumerate([0, 0.03, 0.08, 0.3])]
    same = rng.standard_normal(8).tolist()
    rows += [(300 + i, [x * (1 + i % 2) for x in same], 1) for i in range(60)]
    rows += [(400, None, 1), (401, [0.0] * 8, 1), (402, [None] + same[1:], 1), (403, [float("nan")] + same[1:], 1), (404, same, None)]
    rows += [(405, [], 1), (406, same[:3], 1), (407, same[:3], 1), (408, [1e300, 1e300] + [0.0] * 6, 1)]
    spark_rows = [(*r, "clash") for r in rows]
    df = spark.createDataFrame(spark_rows, "vec_id long, embedding array<double>, label int, unit string").repartition(4)
    got = sorted(tuple(r) for r in embeddings.near_groups(df, threshold).collect())
    assert got == brute_vectors(rows[:-1] + [(408, [1.0, 1.0] + [0.0] * 6, 1)], threshold)
    empty = embeddings.near_groups(df.limit(0), threshold)
    assert empty.count() == 0


def test_embeddings_odd_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    got = sorted(embeddings.near_groups(df, 0.9).collect(), key=str)
    assert [(r.id, r.n_links, r.component_id, r.kept) for r in got] == sorted(
        [(None, 0, None, False), (2, 0, 2, True), (2, 1, 2, True), (3, 1, 2, False)], key=lambda r: str(r)
    ) or {(r.id, r.n_links, r.component_id) for r in got} == {(None, 0, None), (2, 0, 2), (2, 1, 2), (3, 1, 2)}
