"""Long runs under one MinHash key that hold several groups: all pairs between groups are judged where the texts are, and only links come out."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from statlas.llm import minhash
from statlas.llm.components import local_stars
from tests.llm.test_near_duplicate_rows import kept, shingles


def family(n: int, edits: list[int], seed: int) -> list[tuple[int, str]]:
    """Texts around one of 150 words, each with so many words replaced."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{j}" for j in range(150)]
        for at in r.sample(range(150), r.choice(edits)):
            words[at] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


def linked_by_all_pairs(rows: list[tuple[int, str]]) -> dict[int, int]:
    """The least document that each text is linked with."""
    sets = [shingles(t) for _, t in rows]
    near = [(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i]) if len(x & y) >= 0.8 * len(x | y)]
    a, b = (np.array(c, np.int64) for c in zip(*near, strict=True))
    return dict(zip(*(c.tolist() for c in local_stars(a, b)), strict=True))


def test_counts_of_shared_values():
    r = np.random.default_rng(1)
    pool = r.integers(1 << 63, size=400, dtype=np.int64).astype(np.uint64)
    sets = [np.unique(r.choice(pool[: r.integers(2, 400)], r.integers(1, 80))) for _ in range(150)]
    values, owner = np.concatenate(sets), np.repeat(np.arange(150), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    some = [*sets[::7], np.unique(r.integers(1 << 63, size=5, dtype=np.int64).astype(np.uint64))]
    wanted = [[len(np.intersect1d(x, y)) for y in sets] for x in some]
    assert minhash.shared(some, values[order], owner[order], 150).tolist() == wanted


@pytest.mark.parametrize("size", [7, 1000])
def test_links_are_fewer_than_groups(size):
    rows = family(300, [1, 2, 4, 8], 2)
    pack = zstandard.ZstdCompressor().compress
    table = [(key, 0, False, i != 0, i, pack(t.encode())) for key in (1, 2) for i, t in rows]
    names = ["key", "part", "visits", "other", "c", "text"]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*table[i : i + size], strict=True)], names=names) for i in range(0, len(table), size)]
    got = [(x["a"], x["b"]) for b in minhash._linking(5, 0.8)(iter(batches)) for x in b.to_pylist()]
    wanted = linked_by_all_pairs(rows)
    assert len(got) == 2 * len(wanted) < 600 and len(wanted) < 299  # each key's run is one of its own
    a, b = np.array(got).T
    assert dict(zip(*(c.tolist() for c in local_stars(a, b)), strict=True)) == wanted


def test_parts_of_a_run_lose_no_pair(spark, monkeypatch):
    """A run of ten parts, each text a group: those of all other groups visit every part."""
    monkeypatch.setattr(minhash, "HELD_RUN", 8)
    rows = family(80, [1, 4, 8], 3)
    pack = zstandard.ZstdCompressor().compress
    run = spark.createDataFrame([(5, i, 150) for i, _ in rows], "key long, node long, size long").repartition(3)
    texts = spark.createDataFrame([(i, bytearray(pack(t.encode()))) for i, t in rows], "node long, text binary").repartition(3)
    none = spark.createDataFrame([], "node long, component long")
    split = minhash.split_runs(run, none)
    assert [tuple(r) for r in split.select("key", F.col("parts").cast("long")).collect()] == [(5, 10)]
    a, b = np.array([(r.a, r.b) for r in minhash.between_groups(run, split, none, texts, True, 5, 0.8).collect()]).T
    wanted = linked_by_all_pairs(rows)
    assert dict(zip(*(c.tolist() for c in local_stars(a, b)), strict=True)) == wanted
    within = minhash.between_groups(run, split, none, texts, False, 5, 0.8).collect()
    assert {wanted.get(r.a, r.a) for r in within} == {wanted.get(r.b, r.b) for r in within}


@pytest.mark.parametrize(("held", "shingles"), [(1 << 12, 1 << 20), (16, 1 << 20), (1 << 12, 2000)])
def test_groups_are_compared_without_rows_of_pairs(spark, monkeypatch, held, shingles):
    """Texts of a family that are mostly less similar than 0.8 and share keys: no pairs of them go out to be judged but those of the first two steps."""
    monkeypatch.setattr(minhash, "HELD_RUN", held)
    monkeypatch.setattr(minhash, "HELD_SHINGLES", shingles, raising=False)
    judged, verified = [], minhash.verified

    def counted(pairs, *rest):
        judged.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(minhash, "verified", counted)
    rows = family(250, [2, 4, 7, 9], 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x.doc_id for x in minhash.one_of_each(docs).collect()) == kept(rows)
    assert 1 < len(kept(rows)) < 250
    assert judged and sum(judged[2:]) == 0
