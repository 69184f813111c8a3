from __future__ import annotations

import random
import re

import numpy as np
import pytest

from statlas.llm import decontam


def shingles(text: str, k: int) -> set[tuple[str, ...]]:
    words = re.findall("[a-z0-9\x80-\U0010ffff]+", text.lower())
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def test_against_exact_containment(spark):
    r = random.Random(1)
    vocabulary = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 2, 4, 5, 6, 9, 12, 25, 40, 80, 300])]
    items += [(50, None), (51, ""), (52, "...")]
    rows = [(0, None), (1, ""), (2, items[0][1])]
    for i in range(3, 90):
        words = [r.choice(vocabulary) for _ in range(r.choice([0, 10, 500, 20000]))]
        item = r.choice(items[:11])[1].split()
        if i % 3:
            if i % 5 == 0:
                item[r.randrange(len(item))] = "changed"
            at = r.randrange(len(words) + 1)
            words[at:at] = item
        rows.append((i, ", ".join(words).upper()))
    docs = spark.createDataFrame([(*d, "e") for d in rows], "doc_id long, text string, item_id string").repartition(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontam.find_leaks(docs, benchmark, block_bytes=600).collect()}
    wanted = set()
    for j, item in items:
        k = min(5, len(re.findall("[a-z0-9]+", item or "")))
        own = shingles(item or "", 5)
        for i, text in rows:
            if own and len([w for w in re.findall("[a-z0-9]+", (text or "").lower())]) >= k and len(own & shingles(text or "", k)) >= 0.8 * len(own):
                wanted.add((i, j))
    assert got == wanted
    kept = {x.doc_id for x in decontam.clean(docs, benchmark, block_bytes=600).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in wanted}
    assert decontam.clean(docs, benchmark).columns == docs.columns


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_leaks(docs, none).count() == 0
    assert decontam.clean(docs, none).count() == 1
    assert decontam.find_leaks(docs.where("false"), spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")).count() == 0


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 0])
def test_repeated_rows_ties_and_names_of_helpers(spark, block_bytes):
    """Both ways of sending items; columns of docs have the names of helper columns."""
    item = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(1, f"x {item} y"), (1, f"x {item} y"), (None, item.upper()), (4, "alpha beta gamma"), (5, None), (5, "")]
    docs = spark.createDataFrame([(*r, "l", 7) for r in rows], "doc_id long, text string, _lower string, _hash int")
    benchmark = spark.createDataFrame([(10, item), (10, item), (11, "Beta, gamma"), (12, None)], "item_id long, text string")
    got = sorted(((x.doc_id or 0, x.item_id, x.n_shared, x.n_item, x.containment) for x in decontam.find_leaks(docs, benchmark, block_bytes=block_bytes).collect()))
    assert got == sorted([(1, 10, 4, 4, 1.0)] * 4 + [(0, 10, 4, 4, 1.0)] * 2 + [(d, 11, 1, 1, 1.0) for d in (1, 1, 0, 4)])
    kept = decontam.clean(docs, benchmark, block_bytes=block_bytes)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.orderBy("text").collect()] == [(5, None, "l", 7), (5, "", "l", 7)]
    assert decontam.find_leaks(docs.where("false"), benchmark, block_bytes=block_bytes).count() == 0


def test_both_ways_agree_on_the_test_tables(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    one, two = (sorted(map(tuple, decontam.find_leaks(read("documents"), read("benchmark"), block_bytes=n).collect())) for n in (decontam.BLOCK_BYTES, 0))
    assert one == two and one


def test_first_classes():
    values = np.unique(np.random.default_rng(3).integers(1 << decontam.BITS, size=200)).astype(np.uint64)
    first = decontam.first_classes(values)
    for size_class in decontam.CLASSES:
        assert set(values[first <= size_class].tolist()) == set(decontam.signature(values, size_class).tolist())
