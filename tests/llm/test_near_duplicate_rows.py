"""Near-duplicates are judged by row, not by doc_id, and the pipeline finds all of 5-word similarity 0.8."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from statlas.llm import minhash, simhash

DATA = "/root/testdata/sf0.01"

ROWS = [
    (None, "a b c d"),  # a copy of 3's text: goes
    (3, "A b c d"),
    (3, "another text under the same number"),
    (None, "first text without a number"),
    (None, "second text without a number"),
    (None, "second text without a number"),
    (5, "twice the same row"),
    (5, "twice the same row"),
    (9, "a b c d"),
]
KEPT = [(3, "A b c d"), (3, "another text under the same number"), (5, "twice the same row"), (None, "first text without a number"), (None, "second text without a number")]


def in_order(rows) -> list[tuple]:
    return sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize("operator", [simhash, minhash])
def test_rows_go_only_for_their_own_text(spark, operator):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    assert in_order(operator.one_of_each(docs).collect()) == KEPT


def shingles(text: str | None) -> frozenset:
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def kept(rows: list[tuple]) -> list[int]:
    """Documents left by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            if min(len(x), len(sets[j])) >= 0.8 * max(len(x), len(sets[j])) and root[i] != root[j]:
                if len(x & sets[j]) >= 0.8 * len(x | sets[j]):
                    old, new = max(root[i], root[j]), min(root[i], root[j])
                    root = [new if r == old else r for r in root]
    least = {}
    for (doc_id, _), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, doc_id), doc_id)
    return sorted(least.values())


def test_stage_finds_scattered_edits(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    wanted = kept([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, DATA).collect()) == wanted


def test_long_runs_lose_no_pair(spark, monkeypatch):
    """Families around texts of their own, more of them than a short run holds, partly similar to each other."""
    monkeypatch.setattr(minhash, "SHORT_RUN", 3)
    r = random.Random(5)
    core = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(core)
        for _ in range(r.choice([1, 2, 4, 8])):
            words[r.randrange(150)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x.doc_id for x in minhash.one_of_each(docs).collect()) == kept(rows)
    assert 1 < len(kept(rows)) < 60


@pytest.mark.parametrize(("held", "size"), [(1 << 12, 50), (17, 7), (40, 13)])
def test_candidates_of_runs_that_are_not_held(monkeypatch, held, size):
    monkeypatch.setattr(minhash, "HELD_RUN", held)
    r = np.random.default_rng(1)
    lengths = [1, 2, 300, 16, 17, 1, 90, 5]
    keys = np.repeat(np.arange(len(lengths)), lengths)
    nodes = np.concatenate([np.sort(r.choice(10_000, n, replace=False)) for n in lengths])
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + size]), pa.array(nodes[i : i + size])], names=["key", "node"]) for i in range(0, len(keys), size)]
    got = {(x["a"], x["b"]) for b in minhash._candidates(iter(batches)) for x in b.to_pylist() if x["a"] != x["b"]}
    for key, n in enumerate(lengths):
        own = nodes[keys == key].tolist()
        wanted = {(a, b) for i, a in enumerate(own) for b in own[i + 1 :]} if n <= minhash.SHORT_RUN else {(own[0], x) for x in own[1:]} | set(zip(own[:-1], own[1:], strict=True))
        assert wanted <= got


def test_pairs_across_groups_are_neighbours_only():
    r = np.random.default_rng(2)
    rows = sorted((int(k), int(p), int(n), int(n) % 3) for k, p, n in zip(r.integers(3, size=500), r.integers(2, size=500), r.permutation(500), strict=True))
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 9], strict=True)], names=["key", "part", "node", "c"]) for i in range(0, len(rows), 9)]
    got = [(x["a"], x["b"]) for b in minhash._across(iter(batches)) for x in b.to_pylist()]
    wanted = [tuple(sorted((x[2], y[2]))) for i, x in enumerate(rows) for y in rows[i + 1 : i + 1 + minhash.PARTNERS] if x[:2] == y[:2] and x[3] != y[3]]
    assert sorted(got) == sorted(wanted)


def sets_of(similarity: float, n: int, r: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two sets of n values with that Jaccard similarity."""
    both = round(2 * n * similarity / (1 + similarity))
    x = r.integers(1 << 63, size=2 * n - both, dtype=np.int64).astype(np.uint64)
    return np.sort(x[:n]), np.sort(x[n - both :])


@pytest.mark.parametrize(("similarity", "least"), [(0.8, 0.88), (0.9, 0.98)])
def test_wide_fingerprints_meet(similarity, least):
    """The share of pairs of sets that have a common key and few enough differing bits; none of unlike sets."""
    r = np.random.default_rng(3)
    pairs = [sets_of(similarity, int(n), r) for n in r.integers(20, 400, size=400)]
    fps = np.array([[simhash.wide(x) for x in p] for p in pairs])
    met = 0
    for a, b in fps:
        keys = simhash.wide_variants(np.stack([a, b]), 16)
        met += bool(np.intersect1d(*keys).size) and int(simhash.distance(a, b)) <= simhash.FAR
    assert met >= least * len(pairs)
    assert all(int(simhash.distance(fps[i, 0], fps[i + 1, 0])) > simhash.FAR for i in range(len(fps) - 1))


def test_near_in_runs():
    r = np.random.default_rng(4)
    base = r.integers(1 << 63, size=(2, 1), dtype=np.int64).astype(np.uint64)
    lengths = [1, 5, 16, 40, 2]
    keys = np.repeat(np.arange(len(lengths)), lengths)
    flips = (np.uint64(1) << r.integers(64, size=(2, len(keys), 20), dtype=np.uint64)).astype(np.uint64)
    fps = base ^ np.bitwise_xor.reduce(flips, axis=2)
    fps[:, ::3] = r.integers(1 << 63, size=fps[:, ::3].shape, dtype=np.int64).astype(np.uint64)
    a, b = simhash.near_in_runs(keys, np.arange(len(keys)), fps)
    got = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}
    near = {(i, j) for j in range(len(keys)) for i in range(j) if keys[i] == keys[j] and int(simhash.distance(fps[:, i], fps[:, j])) <= simhash.FAR}
    assert got <= near
    assert {p for p in near if lengths[keys[p[0]]] <= simhash.FEW} <= got
    assert {j for _, j in near} == {j for _, j in got}


def test_stage_goes_through_simhash(spark, monkeypatch):
    """Without MinHash keys under which texts meet, the stage still finds near copies by the fingerprints."""
    monkeypatch.setattr(minhash, "_candidates", lambda batches: iter(()))
    r = random.Random(6)
    rows = []
    for i in range(40):
        words = [f"w{r.randrange(10**6)}" for _ in range(200)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:100], "edited", *words[101:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x.doc_id for x in minhash.one_of_each(docs).collect()) == kept(rows) == list(range(0, 80, 2))


def test_nearest_of_other_groups():
    r = np.random.default_rng(7)
    base = r.integers(1 << 62, size=2, dtype=np.int64)
    rows = sorted((int(k), int(p), int(n), int(n) % 3, *(base ^ (1 << r.integers(60, size=2))).tolist()) for k, p, n in zip(r.integers(3, size=300), r.integers(2, size=300), r.permutation(300), strict=True))
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 9], strict=True)], names=["key", "part", "node", "c", "f0", "f1"]) for i in range(0, len(rows), 9)]
    got = {(x["a"], x["b"]) for b in minhash._nearest(iter(batches)) for x in b.to_pylist()}
    place = {x[2]: x for x in rows}
    for node, (key, part, _, c, *f) in place.items():
        apart = {x[2]: sum((u ^ v).bit_count() for u, v in zip(f, x[4:], strict=True)) for x in rows if x[:2] == (key, part) and x[3] != c}
        own = [apart[b if a == node else a] for a, b in got if node in (a, b)]
        assert sorted(own)[: 2 * minhash.PARTNERS] == sorted(apart.values())[: 2 * minhash.PARTNERS]
    assert all(place[a][:2] == place[b][:2] and place[a][3] != place[b][3] for a, b in got)
