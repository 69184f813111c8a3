from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from statlas.llm import simhash
from statlas.llm.components import _state, connected_components, local_stars


def plain_fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n: int, links) -> list[int]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_fingerprint_is_the_plain_one():
    r = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 400):
        text = " ".join(r.choice(["A", "bé", "Ccc", "dd"]) for _ in range(n))
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = [r.choice(vocabulary) for _ in range(r.choice([5, 60, 300]))]
        texts.append(" ".join(base))
        for _ in range(r.randrange(5)):
            edited = list(base)
            edited[r.randrange(len(edited))] = r.choice(vocabulary)
            texts.append(" ".join(edited))
    texts += [None, "", " \t", texts[0].upper(), texts[0]]
    rows = [(100 - i, t, "x") for i, t in enumerate(texts)] + [(100, texts[0], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()))
    fps = [plain_fingerprint(t or "") for _, t, _ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2]
    root = roots(len(rows), links)
    least = {}
    for i, (doc_id, _, _) in enumerate(rows):
        least[root[i]] = min(least.get(root[i], doc_id), doc_id)
    assert got == sorted((d, f"{fps[i]:016x}", least[root[i]]) for i, (d, _, _) in enumerate(rows))


def test_long_runs_lose_no_link():
    """Families of fingerprints that share a half, more of them than a short run holds."""
    r = random.Random(3)
    fps = set()
    for low in (0, 32):
        centre = r.getrandbits(64)
        while len(fps) < 300 * (1 + low // 32):
            x = centre
            for _ in range(r.randrange(9)):
                x ^= 1 << (low + r.randrange(32))
            if r.random() < 0.2:
                x ^= 1 << r.randrange(64)
            fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    keys = simhash.variants(fps).view(np.int64)
    rows = sorted((int(k), int(f)) for f, ks in zip(fps, keys, strict=True) for k in ks)
    assert max(np.unique([k for k, _ in rows], return_counts=True)[1]) > simhash.SHORT_RUN
    a, b = simhash.links_of_runs(np.array([k for k, _ in rows]), np.array([f for _, f in rows], np.uint64))
    assert (np.bitwise_count(a ^ b) <= 2).all()
    at = {int(f): i for i, f in enumerate(fps)}
    found = roots(len(fps), [(at[int(x)], at[int(y)]) for x, y in zip(a, b, strict=True)])
    wanted = roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if bin(int(fps[i] ^ fps[j])).count("1") <= 2])
    assert found == wanted


@pytest.mark.parametrize("held", [1, 12, 1 << 16])
def test_runs_too_long_to_hold_lose_no_link(monkeypatch, held):
    monkeypatch.setattr(simhash, "HELD_RUN", held)
    r = random.Random(6)
    centre = r.getrandbits(64)
    fps = set()
    while len(fps) < 250:
        x = centre
        for _ in range(r.randrange(7)):
            x ^= 1 << r.choice([0, 1, 2, 3, 4, 5, 31, 32, 33, 34, 35, 60, 63])
        fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    rows = sorted((int(k), int(f)) for f, ks in zip(fps.view(np.int64), simhash.variants(fps).view(np.int64), strict=True) for k in ks)
    keys, values = (np.array(x) for x in zip(*rows, strict=True))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 37]), pa.array(values[i : i + 37])], names=["key", "fp"]) for i in range(0, len(keys), 37)]
    out = [x for b in simhash._verify(iter(batches)) for x in b.to_pylist()]
    links = [(x["a"], x["b"]) for x in out if x["key"] is None]
    deep = sorted((x["key"], x["a"], x["b"]) for x in out if x["key"] is not None)
    assert bool(deep) == (held < 250)
    cut = [deep[i : i + 1000] for i in range(0, len(deep), 1000)]
    parts = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*x, strict=True)], names=["key", "a", "b"]) for x in cut]
    links += [(x["a"], x["b"]) for b in simhash._chain(iter(parts)) for x in b.to_pylist()]
    at = {int(f): i for i, f in enumerate(fps.view(np.int64))}
    assert roots(len(fps), [(at[a], at[b]) for a, b in links]) == roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if bin(int(fps[i] ^ fps[j])).count("1") <= 2])


def test_state_of_many_edges_does_not_overflow(spark):
    edges = spark.range((1 << 24) + 5).select((F.col("id") + 1).alias("a"), F.lit(0).cast("long").alias("b"))
    assert _state(edges)[0] == (1 << 24) + 5


def test_components(spark):
    r = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    edges = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    root = roots(300, links)
    got = {tuple(x) for x in connected_components(edges).collect()}
    assert got == {(n, root[n]) for a, b in links if a != b for n in (a, b)}
    assert connected_components(edges.where("a < 0")).count() == 0


def test_local_stars_keep_components():
    a, b = np.array([5, 3, 9, 9]), np.array([3, 1, 8, 8])
    x, y = local_stars(a, b)
    assert sorted(zip(x.tolist(), y.tolist(), strict=True)) == [(3, 1), (5, 1), (9, 8)]


def test_one_of_each(spark):
    docs = spark.createDataFrame([(3, "a b c d"), (1, "A b c d"), (2, "something else entirely"), (2, "something else entirely")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [1, 2]
    assert simhash.one_of_each(docs.where("false")).count() == 0
