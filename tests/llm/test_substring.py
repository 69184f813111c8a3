from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from statlas.llm import substring


def plain(rows: list[tuple[int, str | None]], n: int) -> dict[int, tuple[int, int, str]]:
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - n + 1):
            w = tuple(words[i : i + n])
            if w in seen:
                gone[i : i + n] = [True] * n
            seen.add(w)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[doc_id] = (len(words), sum(gone), kept.decode())
    return out


def corpus(seed: int) -> list[tuple[int, str | None]]:
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(70)]
    rows: list[tuple[int, str | None]] = [(0, None), (1, ""), (2, " \n\t "), (3, "a " * 100), (4, "ä b " * 60)]
    for i in range(5, 60):
        words = [r.choice("abcdefghijklmnopqrstuvw") for _ in range(r.randrange(1, 200))]
        for _ in range(r.randrange(3)):
            at, low = r.randrange(len(words) + 1), r.randrange(40)
            words[at:at] = passage[low : low + r.randrange(15, 30)]
        rows.append((i, " ".join(words)))
    rows += [(r.randrange(1000, 2000) * 10 + i, rows[i][1]) for i in range(5, 25)]
    return rows


def test_against_brute_force(spark):
    rows = corpus(1)
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_words int").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring.remove_repeats(docs).collect()}
    assert got == plain(rows, 20)


def test_a_tiny_sketch_loses_nothing(spark, monkeypatch):
    def tiny(self, total, parts):
        self.width, self.block, self.groups, self.partitions = 1 << 9, 1 << 6, 7, 3

    monkeypatch.setattr(substring.Layout, "__init__", tiny)
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring.remove_repeats(docs).collect()}
    assert got == plain(rows, 20)


@pytest.mark.parametrize("total", [10_000, 3_000_000, 100_000_000])
def test_few_unique_windows_are_flagged_at_any_size(total):
    """Anchors that occur once, as many as natural text of so many bytes has, in lists of several groups."""
    layout = substring.Layout(total, 8)
    anchors = np.random.default_rng(1).integers(1 << 63, size=int(0.03 * total), dtype=np.int64).astype(np.uint64)
    lists = [r for i, part in enumerate(np.array_split(anchors, 9)) for batch in substring._lists(i, part, layout) for r in batch.to_pylist()]
    rows = sorted(lists, key=lambda r: r["block"])
    asked = pa.RecordBatch.from_pylist(rows, schema=pa.schema([("block", pa.int64()), ("grp", pa.int32()), ("many", pa.bool_()), ("cells", pa.binary())]))
    found = [np.frombuffer(r["cells"], "<u4") + np.int64(r["block"] * layout.block) for batch in substring._answers(iter([asked])) for r in batch.to_pylist()]
    repeated = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
    one, two = substring.cells(anchors, layout.width)
    assert (np.isin(one, repeated) & np.isin(two, repeated)).mean() < 0.02


def test_the_sketch_grows_with_the_input():
    for total in (1 << 30, 30 << 30, 100 << 40):
        layout = substring.Layout(total, 200)
        assert total / 2 <= layout.width <= total and layout.block <= substring.MAX_BLOCK and layout.groups >= total / substring.GROUP_BYTES


def test_rows_of_one_or_no_number_are_documents_of_their_own(spark):
    part = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcd"}
    rows = [(None, part["a"] + " " + part["a"]), (None, part["b"] + " " + part["c"]), (7, part["d"]), (7, "x " + part["d"]), (8, part["c"])]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, _doc int, _tie int, grp int").repartition(3)
    got = {r.text: (r.n_removed, r._doc, r._tie, r.grp) for r in substring.remove_repeats(docs).collect()}
    assert got[rows[0][1]][0] == 40 and got[rows[1][1]][0] == 0 and got[rows[4][1]][0] == 40
    assert sorted([got[rows[2][1]][0], got[rows[3][1]][0]]) == [0, 40]
    assert all(x[1:] == (1, 2, 3) for x in got.values())


def test_one_very_long_text(spark):
    r = random.Random(7)
    words = [f"w{r.randrange(10**7)}" for _ in range(300_000)]
    rows = [(1, " ".join(words + words[1000:2000])), (2, "z " * 50_000), (3, " ".join(words[5:60]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_text) for x in substring.remove_repeats(docs).collect()}
    assert got == plain(rows, 20)


def test_repeated_rows_null_ids_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(5, text, "x"), (5, text, "x"), (9, text, "y"), (None, "b " + text, "z")], "doc_id long, text string, source string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in substring.remove_repeats(docs).collect())
    assert got == [(-1, 0), (5, 30), (5, 30), (9, 30)]
    assert substring.remove_repeats(docs.where("false")).count() == 0
