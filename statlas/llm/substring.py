"""Removal of repeated passages behind a count-min prefilter.

A window is WINDOW consecutive words of one document. Every window has an anchor: the smallest
hash among its GRAM-word sequences. Equal windows at different places choose equal anchors at
different places, so the number of places where an anchor was chosen is at least the number of
places of any window that chose it.

1. Documents go, compressed, to groups of about GROUP_BYTES. The partitions count their groups'
   anchors in a two-row count-min sketch (0, 1, many per cell). A row has a cell for every one or
   two bytes of all texts, so a few cells in a hundred are in use at any size of the input. The
   sketch is never whole in one place: the groups' sketches are merged by blocks of cells, each
   block in one task, which answers every group with those of its cells that are counted more than once.
2. A second pass over the groups keeps only windows whose anchor is so estimated repeated, and
   groups them exactly by a 96-bit hash of their words. Within a group of documents only the first
   place of each window is sent on, so a passage in a third of all documents makes one row a group;
   the later places of the group are repeats already.
3. The places found to be repeats come back to their groups, and the words that they cover go.

The three passes read one exchange of the documents. Two windows count as equal if their hashes are: among n windows
estimated repeated there is a false pair with probability below n**2 / 2**97, and with v different words two of one
hash, of which a false pair could come if all else in their windows is equal, with v**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlas.llm import _text
from statlas.llm._util import fresh, partitions, prepare

U = np.uint64
WINDOW, GRAM = 20, 10
ROWS = 2
MIN_CELLS = 1 << 16
#: Cells in a block of the sketch at most; its task holds those in use, about one in thirty.
MAX_BLOCK = 1 << 27
#: Bytes of text in a group of documents, which one task holds with its windows, and in a partition.
GROUP_BYTES, PARTITION_BYTES = 16 << 20, 256 << 20
#: Anchors that a task gathers before it gives out sketches.
HELD = 4 << 20
NO_ID = -(1 << 63)


def _smallest(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of each k consecutive values."""
    n = len(x) - k + 1
    width = 1
    while width * 2 <= k:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:n], x[k - width : k - width + n])


def _largest(x: np.ndarray, k: int) -> np.ndarray:
    return ~_smallest(~x, k)


class Windows:
    """The windows of a chunk of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> None:
        starts, ends, self.first = _text.words(data, offsets)
        self.n_words = np.diff(self.first)
        self.window, self.gram = window, gram
        self.hashed = _text.word_hashes(data, starts, ends)
        self.ok = _text.inside(self.first, window)
        self.anchors = np.zeros(0, U)
        self.chosen = np.zeros(0, U)
        if self.ok.any():
            grams = _text.grams(self.hashed, gram)
            span = window - gram + 1
            self.anchors = _smallest(grams, span)
            # a gram is chosen if it is the smallest of some window within one text
            low = np.where(self.ok, self.anchors, U(0))
            pad = np.zeros(span - 1, U)
            self.chosen = grams[_largest(np.concatenate([pad, low, pad]), span) == grams]


class Layout:
    """The sizes that follow from the bytes of all texts."""

    def __init__(self, total: int, parts: int) -> None:
        self.width = max(MIN_CELLS, 1 << max(0, total // 2 - 1).bit_length())
        # at least 64 blocks of a large sketch, and no more than MAX_BLOCK cells in one
        self.block = min(MAX_BLOCK, max(MIN_CELLS, self.width * ROWS // 64))
        self.groups = max(parts, -(-total // GROUP_BYTES))
        self.partitions = max(parts, -(-total // PARTITION_BYTES))


def cells(anchors: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each anchor in each row of a sketch; row r owns the cells from r * width. width: a power of two."""
    bits = width.bit_length() - 1
    return [(anchors & U(width - 1)).astype(np.int64), (anchors * U(0x9E3779B97F4A7C15) >> U(64 - bits)).astype(np.int64) + width]


def _grouped_docs(docs: DataFrame, layout: Layout) -> DataFrame:
    """docs with the text compressed, exchanged by group; three columns follow: the document's id (NO_ID if null), a hash of its text, its group."""
    doc, tie, group = fresh(docs, "_doc", "_tie", "_group")
    at, id_at = docs.columns.index("text"), docs.columns.index("doc_id")
    fields = [T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in docs.schema.fields]
    schema = T.StructType([*fields, T.StructField(doc, T.LongType()), T.StructField(tie, T.IntegerType()), T.StructField(group, T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            raw = [t.as_py() for t in batch.column(at).cast(pa.binary())]
            hashed = np.array([0 if t is None else xxhash.xxh64_intdigest(t) for t in raw], U)
            ids = batch.column(id_at).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            own = (_text.mix(ids.astype(U) ^ hashed) % U(layout.groups)).astype(np.int32)
            texts = pa.array([None if t is None else pack(t) for t in raw], pa.binary())
            columns = [texts if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids), pa.array(hashed.astype(np.uint32).view(np.int32)), pa.array(own)], names=schema.names)

    return docs.mapInArrow(run, schema).repartition(layout.partitions, group)


def _unpacked(column: pa.Array) -> list[bytes | None]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(t.as_py()) if t.is_valid else None for t in column]


def _in_parts(table: pa.Table, rows: int) -> pa.Table:
    """table in batches of so many rows: the JVM holds a batch as a whole, outside its heap."""
    return pa.Table.from_batches(table.to_batches(max_chunksize=rows), schema=table.schema)


def _lists(group: int, anchors: np.ndarray, layout: Layout) -> Iterator[pa.RecordBatch]:
    """A group's sketch: per block of cells, the offsets of cells hit once and of cells hit more often."""
    at = np.sort(np.concatenate(cells(anchors, layout.width)))
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, int)
    many = np.diff(np.r_[new, len(at)]) > 1
    at = at[new]
    for flag in (False, True):
        own = at[many == flag]
        if len(own):
            block = own // layout.block
            new = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            bounds = np.r_[new, len(own)].astype(np.int32) * 4
            data = pa.Array.from_buffers(pa.binary(), len(new), [None, pa.py_buffer(bounds), pa.py_buffer((own % layout.block).astype("<u4"))])
            columns = [pa.array(block[new], pa.int64()), pa.array(np.full(len(new), group), pa.int32()), pa.array(np.full(len(new), flag)), data]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "grp", "many", "cells"])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, block, cells): those of each list's cells that the block's lists count more than once; the rows come sorted by block."""
    held: list[tuple[int, bool, np.ndarray]] = []
    block = None

    def out() -> Iterator[pa.RecordBatch]:
        whole, n = np.unique(np.concatenate([at for _, _, at in held]), return_counts=True)
        for _, many, at in held:
            if many:
                n[np.searchsorted(whole, at)] = 2
        found = whole[n > 1]
        groups, lists = [], []
        for group, _, at in held if len(found) else ():
            own = at[found[np.minimum(np.searchsorted(found, at), len(found) - 1)] == at]
            if len(own):
                groups.append(group)
                lists.append(own.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int32()), pa.array([block] * len(groups), pa.int64()), pa.array(lists, pa.binary())], names=["grp", "block", "cells"])

    for batch in batches:
        for b, group, many, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if b != block and held:
                yield from out()
                held = []
            block = b
            held.append((group, many, np.frombuffer(raw, "<u4")))
    if held:
        yield from out()


def sketched(grouped: DataFrame, layout: Layout, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(grp, block, cells): the cells of each group's anchors that the merged sketch counts more than once; grouped: as _grouped_docs() gives it."""
    text = grouped.columns.index("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0
        for batch in batches:
            groups = batch.column(batch.num_columns - 1).to_numpy()
            for group in np.unique(groups).tolist():
                texts = _unpacked(batch.column(text).filter(pa.array(groups == group)))
                for _, _, data, offsets in _text.chunks(pa.array(texts, pa.large_binary())):
                    held.setdefault(group, []).append(Windows(data, offsets, window, gram).chosen)
                    size += len(held[group][-1])
            if size >= HELD:
                for group, found in held.items():
                    yield from _lists(group, np.concatenate(found), layout)
                held, size = {}, 0
        for group, found in held.items():
            yield from _lists(group, np.concatenate(found), layout)

    asked = grouped.mapInArrow(count, "block long, grp int, many boolean, cells binary")
    return asked.repartition(F.col("block")).sortWithinPartitions("block").mapInArrow(_answers, "grp int, block long, cells binary")


_ROW = "h1 long, h2 int, doc long, tie int, pos int, grp int, places binary"
_ROW_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_ROW_SCHEMA = pa.schema(list(zip(["h1", "h2", "doc", "tie", "pos", "grp", "places"], _ROW_TYPES, strict=True)))
Places = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _firsts(rows: Places) -> tuple[Places, Places]:
    """(h1, h2, doc, tie, pos) split into the first place of each window and its later, different ones."""
    h1, h2, doc, tie, pos = rows
    order = np.lexsort((pos, tie, doc, h2, h1))
    h1, h2, doc, tie, pos = h1[order], h2[order], doc[order], tie[order], pos[order]
    again = np.r_[False, (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])] if len(h1) else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
    # rows of one document at one place are one
    later = again & ((doc != doc[head]) | (tie != tie[head]) | (pos != pos[head]))
    return tuple(x[~again] for x in (h1, h2, doc, tie, pos)), tuple(x[later] for x in (h1, h2, doc, tie, pos))


def _by_doc(doc: np.ndarray, tie: np.ndarray, pos: np.ndarray, group: np.ndarray) -> pa.RecordBatch:
    """(grp, doc, tie, places) of places, one row per document of a group."""
    order = np.lexsort((pos, tie, doc, group))
    doc, tie, pos, group = doc[order], tie[order], pos[order].astype("<i4"), group[order]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (group[1:] != group[:-1])]) if len(doc) else np.zeros(0, int)
    bounds = np.r_[new, len(doc)].astype(np.int32) * 4
    places = pa.Array.from_buffers(pa.binary(), len(new), [None, pa.py_buffer(bounds), pa.py_buffer(pos)])
    return pa.RecordBatch.from_arrays([pa.array(group[new], pa.int32()), pa.array(doc[new], pa.int64()), pa.array(tie[new], pa.int32()), places], names=["grp", "doc", "tie", "places"])


def _repeats(grouped: DataFrame, answers: DataFrame, layout: Layout, window: int, gram: int) -> DataFrame:
    """(grp, doc, tie, places): starts of windows, as little-endian 32-bit numbers, whose words also start earlier."""
    text_at, group = grouped.columns.index("text"), grouped.columns[-1]

    def flagged(anchors: np.ndarray, repeated: np.ndarray) -> np.ndarray:
        new = np.r_[True, anchors[1:] != anchors[:-1]]
        heads = anchors[new]
        seen = np.ones(len(heads), bool)
        for at in cells(heads, layout.width):
            seen &= repeated[np.minimum(np.searchsorted(repeated, at), len(repeated) - 1)] == at
        return seen[np.cumsum(new) - 1]

    def propose(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _ROW_SCHEMA.empty_table()
        own = left.column(left.num_columns - 1)[0].as_py()
        listed = [np.frombuffer(raw, "<u4") + np.int64(block * layout.block) for block, raw in zip(right["block"].to_pylist(), right["cells"].to_pylist(), strict=True)]
        repeated = np.unique(np.concatenate(listed))
        firsts, later = [], []
        for batch in left.to_batches():
            docs, ties = (batch.column(batch.num_columns - i).to_numpy() for i in (3, 2))
            for row, _, data, offsets in _text.chunks(pa.array(_unpacked(batch.column(text_at)), pa.large_binary())):
                w = Windows(data, offsets, window, gram)
                at = np.flatnonzero(w.ok)
                at = at[flagged(w.anchors[at], repeated)] if len(at) else at
                if len(at):
                    h1 = _text.grams(w.hashed, window)[at]
                    h2 = (_text.grams(_text.mix(w.hashed ^ U(0xA5A5A5A5A5A5A5A5)), window, 0x9E6C63D0876A9A47)[at] >> U(32)).astype(np.uint32)
                    text = np.searchsorted(w.first, at, side="right") - 1
                    one, two = _firsts((h1, h2, docs[row + text], ties[row + text], (at - w.first[text]).astype(np.int32)))
                    firsts.append(one)
                    later.append(two[2:])
        if not firsts:
            return _ROW_SCHEMA.empty_table()
        one, two = _firsts(tuple(np.concatenate(x) for x in zip(*firsts, strict=True)))
        later.append(two[2:])
        h1, h2, doc, tie, pos = one
        columns = [h1.view(np.int64), h2.view(np.int32), doc, tie, pos, np.full(len(doc), own, np.int32)]
        sent = pa.Table.from_arrays([*map(pa.array, columns), pa.nulls(len(doc), pa.binary())], schema=_ROW_SCHEMA)
        # known repeats are on their way through the same exchange, keyed by document
        doc, tie, pos = (np.concatenate(x) for x in zip(*later, strict=True))
        known = _by_doc(doc, tie, pos, np.full(len(doc), own, np.int32))
        key = _text.mix(known["doc"].to_numpy().astype(U)).view(np.int64)
        none = pa.array(np.full(known.num_rows, -1, np.int32))
        whole = pa.concat_tables([sent, pa.Table.from_arrays([pa.array(key), none, known["doc"], known["tie"], none, known["grp"], known["places"]], schema=_ROW_SCHEMA)])
        return _in_parts(whole, 1 << 15)

    rows = grouped.groupBy(group).cogroup(answers.groupBy("grp")).applyInArrow(propose, _ROW)
    spread = rows.repartition(F.col("h1")).sortWithinPartitions("h1", "h2", "doc", "tie", "pos")
    return spread.mapInArrow(_confirm, "grp int, doc long, tie int, places binary")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places that are not the first of their window; the rows come sorted by window and place."""
    last = None
    for batch in batches:
        known = np.asarray(batch.column(4)) < 0
        if known.any():
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in (5, 2, 3, 6)], names=["grp", "doc", "tie", "places"]).filter(pa.array(known))
        h1, h2, doc, tie, pos, group = (np.asarray(c)[~known] for c in batch.columns[:6])
        if not len(h1):
            continue
        new = np.r_[last is None or last[:2] != (h1[0], h2[0]), (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        at = np.maximum.accumulate(np.where(new, np.arange(len(h1)), -1))
        first = [doc[at], tie[at], pos[at]]
        if not new[0]:
            for x, value in zip(first, last[2:], strict=True):
                x[at < 0] = value
        last = (h1[-1], h2[-1], *(x[-1] for x in first))
        repeat = (doc != first[0]) | (tie != first[1]) | (pos != first[2])
        if repeat.any():
            yield _by_doc(doc[repeat], tie[repeat], pos[repeat], group[repeat])


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """docs with kept_text, n_words and n_removed: words of repeated windows are out, kept words joined by one space.

    docs needs doc_id and text. A null text has no words and gives an empty kept_text. A null doc_id counts as
    smaller than all others. Rows equal in doc_id and text are one document: they are no repeats of each other and
    get one result. Rows that share a doc_id, or have none, and differ in text are separate documents, in the order of
    a hash of their texts. Columns named kept_text, n_words, n_removed are replaced; all others stay, whatever their
    names. An empty table gives an empty result. Rows equal in doc_id and text go to one task.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("kept_text", "n_words", "n_removed")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    layout = Layout(total, partitions(docs.sparkSession))
    grouped = _grouped_docs(docs, layout)
    places = _repeats(grouped, sketched(grouped, layout, window, gram), layout, window, gram)
    schema = T.StructType([*docs.schema.fields, T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    text = docs.columns.index("text")

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[tuple[int, int], list[bytes]] = {}
        for doc, tie, raw in zip(*(right[c].to_pylist() for c in ("doc", "tie", "places")), strict=True):
            found.setdefault((doc, tie), []).append(raw)
        n = left.num_columns
        texts = _unpacked(left.column(text).combine_chunks()) if left.num_rows else []
        kept, n_words, n_removed = [], [], []
        for t, doc, tie in zip(texts, left.column(n - 3).to_pylist(), left.column(n - 2).to_pylist(), strict=True):
            parts = (t or b"").split()
            n_words.append(len(parts))
            removed = 0
            if (doc, tie) in found:
                edge = np.zeros(len(parts) + window + 1, np.int32)
                at = np.frombuffer(b"".join(found[doc, tie]), "<i4")
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge[: len(parts)]) > 0
                removed = int(gone.sum())
                parts = [p for p, g in zip(parts, gone.tolist(), strict=True) if not g]
            n_removed.append(removed)
            kept.append(b" ".join(parts))
        new = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        old = [pa.array(texts, pa.binary()).cast(pa.string()) if i == text else left.column(i) for i in range(n - 3)]
        return _in_parts(pa.Table.from_arrays([*old, *new], names=schema.names), 256)

    return grouped.groupBy(grouped.columns[-1]).cogroup(places.groupBy("grp")).applyInArrow(apply, schema)
