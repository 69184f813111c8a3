"""Benchmark decontamination: size-partitioned MinHash containment search.

Documents fall into classes by their number of distinct shingles (powers of two). A document's
signature splits the hash space into as many bins as its class has shingles, times BINS_PER_SHINGLE,
and keeps each bin's smallest hash; so a long document gets a long signature, and a short item's
shingle is the minimum of its bin about as often in a long document as in a short one. An item is
looked up under its own signature of each class: sharing one bin minimum makes a candidate, and
candidates are verified by exact containment over all shingles of document and item.

Items of fewer than SMALL shingles are looked up by every shingle, as a few bins could all be
missed. A benchmark of at most BLOCK_BYTES is sent to the tasks whole, and documents are not exchanged.
A larger one is a table of keys: each item's shingle with the smallest class from which on it is the
minimum of its bin. Documents give their bin minima (and the shingles that a small item could have)
that a bit table of the items' shingles lets pass, keys meet by equality, and only the texts of pairs
that share one are looked at again.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlas.llm import _text
from statlas.llm._util import cut, fresh, prepare

U = np.uint64
SHINGLE, CONTAINMENT = 5, 0.8
BINS_PER_SHINGLE = 0.5
SMALL = 16
CLASSES = range(0, 34)
#: Bytes of item texts that are sent to every task. An item's texts and signatures take about 60 times as much in a task.
BLOCK_BYTES = 2 << 20
#: Bits of a shingle hash in a signature; the rest of the word holds the document within a chunk.
BITS = 44
#: Bits of the table that lets shingles of items pass: eight for each, and at most these (32 MB).
MAX_FILTER = 1 << 28
FILTER_BLOCK = 1 << 16


def bin_bits(size_class: int) -> int:
    """log2 of the bins of a class: its documents have 2**(size_class - 1) < n <= 2**size_class shingles."""
    return max(0, size_class + int(math.log2(BINS_PER_SHINGLE)))


def shingle_hashes(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the k-word shingles of one text; fewer words: one of all its words; none: empty."""
    data = np.frombuffer(text, np.uint8)
    data = _text.LOWER[data]
    starts, ends, _ = _text.words(data, np.array([0, len(data)]), _text.NOT_ALNUM)
    if not len(starts):
        return np.zeros(0, U)
    return np.unique(_text.grams(_text.word_hashes(data, starts, ends), min(k, len(starts))))


def word_count(text: bytes) -> int:
    data = np.frombuffer(text, np.uint8)
    return len(_text.words(data, np.array([0, len(data)]), _text.NOT_ALNUM)[0])


def class_of(n: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def signature(values: np.ndarray, size_class: int) -> np.ndarray:
    """The smallest of each bin among sorted distinct BITS-bit hashes."""
    shift = U(BITS - min(BITS, bin_bits(size_class)))
    bins = values >> shift
    return values[np.r_[True, bins[1:] != bins[:-1]]] if len(values) else values


class Items:
    """A block of items, indexed for the lookup."""

    def __init__(self, rows: list[tuple[int, bytes]], shingle: int) -> None:
        self.ids = [i for i, _ in rows]
        self.hashes = [shingle_hashes(t, shingle) for _, t in rows]
        self.width = np.array([min(shingle, word_count(t)) for _, t in rows], np.int64)
        self.keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size_class in CLASSES:
            keys, owners = [], []
            for item, h in enumerate(self.hashes):
                if self.width[item] == shingle and len(h) >= SMALL:
                    own = signature(np.unique(h >> U(64 - BITS)), size_class)
                    keys.append(own)
                    owners.append(np.full(len(own), item))
            self.keys[size_class] = _sorted(keys, owners)
        small = defaultdict(lambda: ([], []))
        for item, h in enumerate(self.hashes):
            w = int(self.width[item])
            if w and (w < shingle or len(h) < SMALL):
                small[w][0].append(h)
                small[w][1].append(np.full(len(h), item))
        self.small = {w: _sorted(*x) for w, x in small.items()}


def _sorted(keys: list[np.ndarray], owners: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, U), np.zeros(0, np.int64)
    k, o = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(k, kind="stable")
    return k[order], o[order]


def _hits(values: np.ndarray, texts: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(text, item) for each equality between values and the keys of an index."""
    keys, owners = index
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.searchsorted(keys, values)
    on = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == values)
    low = low[on]
    n = np.searchsorted(keys, values[on], side="right") - low
    at = np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(texts[on], n), owners[at]


def search_chunk(data: np.ndarray, offsets: np.ndarray, items: Items, shingle: int, threshold: float) -> list[tuple[int, int, int, int]]:
    """(text, item, shared shingles, item's shingles) for each pair of at least the threshold's containment."""
    data = _text.LOWER[data]
    starts, ends, first = _text.words(data, offsets, _text.NOT_ALNUM)
    hashed = _text.word_hashes(data, starts, ends)
    n_texts = len(offsets) - 1
    pairs = []
    whole: dict[int, np.ndarray] = {}
    if len(hashed) >= shingle:
        g = _text.grams(hashed, shingle)
        whole[shingle] = g
        ok = np.flatnonzero(_text.inside(first, shingle))
        text = np.searchsorted(first, ok, side="right") - 1
        for low in range(0, n_texts, 1 << (64 - BITS)):
            part = slice(*np.searchsorted(text, [low, low + (1 << (64 - BITS))]))
            packed = np.sort(((text[part] - low).astype(U) << U(BITS)) | (g[ok[part]] >> U(64 - BITS)))
            packed = packed[np.r_[True, packed[1:] != packed[:-1]]] if len(packed) else packed
            owner = (packed >> U(BITS)).astype(np.int64)
            value = packed & U((1 << BITS) - 1)
            size_class = class_of(np.bincount(owner, minlength=1))[owner] if len(owner) else owner
            for c in np.unique(size_class):
                own = size_class == c
                v, o = value[own], owner[own]
                bins = v >> U(BITS - min(BITS, bin_bits(int(c))))
                least = np.r_[True, (bins[1:] != bins[:-1]) | (o[1:] != o[:-1])]
                pairs.append(_hits(v[least], o[least] + low, items.keys[int(c)]))
    for w, index in items.small.items():
        if len(hashed) >= w:
            g = whole.setdefault(w, _text.grams(hashed, w))
            ok = np.flatnonzero(_text.inside(first, w))
            pairs.append(_hits(g[ok], np.searchsorted(first, ok, side="right") - 1, index))
    if not pairs:
        return []
    found = np.unique(np.concatenate([t for t, _ in pairs]) * len(items.ids) + np.concatenate([i for _, i in pairs]))
    out, cache = [], (None, None)
    for code in found.tolist():
        t, item = divmod(code, len(items.ids))
        w = int(items.width[item])
        if cache[0] != (t, w):
            cache = ((t, w), np.unique(whole[w][first[t] : max(first[t], first[t + 1] - w + 1)]))
        own = items.hashes[item]
        shared = len(np.intersect1d(cache[1], own, assume_unique=True))
        if shared >= threshold * len(own) - 1e-9:
            out.append((t, item, shared, len(own)))
    return out


def _minima(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, class, value) of the bin minima of each text's distinct shingles."""
    texts, classes, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, U)]
    data = _text.LOWER[data]
    starts, ends, first = _text.words(data, offsets, _text.NOT_ALNUM)
    whole = _text.grams(_text.word_hashes(data, starts, ends), shingle)
    for t in range(len(offsets) - 1):
        own = np.unique(whole[first[t] : max(first[t], first[t + 1] - shingle + 1)] >> U(64 - BITS))
        if len(own):
            size_class = int(class_of(np.array([len(own)]))[0])
            least = signature(own, size_class)
            texts.append(np.full(len(least), t))
            classes.append(np.full(len(least), size_class))
            values.append(least)
    return np.concatenate(texts), np.concatenate(classes), np.concatenate(values)


def first_classes(values: np.ndarray) -> np.ndarray:
    """For each of an item's sorted hashes of BITS bits the smallest class in whose signature it is; it is in all larger ones too."""
    out = np.full(len(values), CLASSES.stop, np.int64)
    for size_class in reversed(CLASSES):
        shift = U(BITS - min(BITS, bin_bits(size_class)))
        bins = values >> shift
        out[np.r_[True, bins[1:] != bins[:-1]]] = size_class
    return out


_KEY = "kind int, value long, class int, item long"


def _item_keys(items: DataFrame, shingle: int) -> DataFrame:
    """(kind, value, class, item): kind 0 for bin minima from a class on, else the words in a shingle of a small item. items: (item, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = text.as_py()
                h, width = shingle_hashes(raw, shingle), min(shingle, word_count(raw))
                if not len(h):
                    continue
                if width == shingle and len(h) >= SMALL:
                    value = np.unique(h >> U(64 - BITS))
                    kind, classes = 0, first_classes(value)
                else:
                    value, kind, classes = h, width, np.zeros(len(h), np.int64)
                n = len(value)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(value.view(np.int64)), pa.array(classes.astype(np.int32)), pa.array(np.full(n, item))], names=["kind", "value", "class", "item"])

    return items.mapInArrow(run, _KEY)


def _cells(kind: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    return (_text.mix(value.astype(U) ^ (kind.astype(U) << U(56))) & U(size - 1)).astype(np.int64)


def _filter(keys: DataFrame, size: int) -> np.ndarray:
    """A table of size bits with those of all keys set; its blocks are gathered, at most MAX_FILTER bits."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for batch in batches:
            bits[_cells(np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(U), size)] = True
        blocks = np.packbits(bits, bitorder="little").reshape(-1, FILTER_BLOCK // 8)
        for i in np.flatnonzero(blocks.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([blocks[i].tobytes()], pa.binary())], names=["block", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held[block] = held.get(block, np.uint8(0)) | np.frombuffer(raw, np.uint8)
        for block, found in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([found.tobytes()], pa.binary())], names=["block", "bits"])

    merged = keys.select("kind", "value").mapInArrow(mark, "block long, bits binary").repartition(F.col("block")).mapInArrow(merge, "block long, bits binary")
    out = np.zeros(size // 8, np.uint8)
    for block, raw in merged.collect():
        out[block * FILTER_BLOCK // 8 : (block + 1) * FILTER_BLOCK // 8] = np.frombuffer(raw, np.uint8)
    return out


def _joined(texts: DataFrame, benchmark: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """(hash, item, n_shared, n_item) of different texts (hash, text) and items that contain enough of each other, found by equality of keys.

    hash and item are 64-bit hashes of the lower-cased texts.
    """
    items = _item_rows(benchmark).select(F.xxhash64("text").alias("item"), "text").dropDuplicates(["item"])
    keys = cut(_item_keys(items, shingle))
    widths = sorted(r[0] for r in keys.select("kind").where("kind > 0").distinct().collect())  # as many as a shingle has words, at most
    size = FILTER_BLOCK
    n = keys.count()
    while size < min(8 * n, MAX_FILTER):
        size *= 2
    sent = texts.sparkSession.sparkContext.broadcast(_filter(keys, size))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.asarray(batch.column(0))
            for row, _, data, offsets in _text.chunks(batch.column(1)):
                found = [(0, *_minima(data, offsets, shingle))]
                lower = _text.LOWER[data]
                starts, ends, first = _text.words(lower, offsets, _text.NOT_ALNUM)
                hashed = _text.word_hashes(lower, starts, ends)
                for w in widths:
                    if len(hashed) >= w:
                        at = np.flatnonzero(_text.inside(first, w))
                        found.append((w, np.searchsorted(first, at, side="right") - 1, np.zeros(len(at), np.int64), _text.grams(hashed, w)[at]))
                for kind, text, classes, value in found:
                    cell = _cells(np.full(len(value), kind), value, size)
                    on = (sent.value[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
                    rows = [np.full(int(on.sum()), kind, np.int32), value[on].view(np.int64), classes[on].astype(np.int32), hashes[row + text[on]]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["kind", "value", "own", "hash"])

    docs = texts.mapInArrow(asked, "kind int, value long, own int, hash long")
    pairs = cut(docs.join(keys, ["kind", "value"]).where("own >= class").select("hash", "item").distinct())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, item, text, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wanted = shingle_hashes(own, shingle)
                data = _text.LOWER[np.frombuffer(text, np.uint8)]
                starts, ends, _ = _text.words(data, np.array([0, len(data)]), _text.NOT_ALNUM)
                has = np.unique(_text.grams(_text.word_hashes(data, starts, ends), min(shingle, word_count(own))))
                shared = len(np.intersect1d(has, wanted, assume_unique=True))
                if shared >= threshold * len(wanted) - 1e-9:
                    out.append((h, item, shared, len(wanted)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["hash", "item", "n_shared", "n_item"])

    wanted = pairs.select("hash").distinct()
    seen = texts.join(wanted, "hash").groupBy("hash").agg(F.first(F.encode("text", "UTF-8")).alias("text"))
    both = pairs.join(seen, "hash").join(items.withColumnRenamed("text", "own"), "item").select("hash", "item", "text", "own")
    return both.mapInArrow(verify, "hash long, item long, n_shared long, n_item long")


def _item_rows(benchmark: DataFrame) -> DataFrame:
    return benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), F.lower("text").cast("binary").alias("text"))


def _sent(benchmark: DataFrame, block_bytes: int) -> list[tuple[int, bytes]] | None:
    """The items, if their texts are at most block_bytes; else nothing is read."""
    rows = _item_rows(benchmark)
    if (rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) > block_bytes:
        return None
    return [(r["item_id"], bytes(r["text"])) for r in rows.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, threshold: float = CONTAINMENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment): documents that hold at least threshold of an item's distinct shingles.

    Texts are lower-cased; words are runs of letters and digits. An item of fewer words than a shingle counts as
    one shingle of that many words; items and documents without words (or null) match nothing. Repeated rows on either
    side give repeated pairs, null ids stay null. An empty table on either side gives an empty result. Other columns are
    not looked at. A benchmark of more than block_bytes is joined by keys, with the same result.
    """
    prepare(docs.sparkSession)
    schema = "doc_id long, item_id long, n_shared long, n_item long, containment double"
    texts = docs.select(F.col("doc_id").cast("long"), F.lower("text").alias("text"))
    rows = _sent(benchmark, block_bytes)
    if rows is None:
        hashed = texts.where(F.col("text").isNotNull()).withColumn("hash", F.xxhash64("text"))
        found = cut(_joined(hashed.select("hash", "text"), benchmark, shingle, threshold))
        ids = _item_rows(benchmark).select("item_id", F.xxhash64("text").alias("item"))
        named = hashed.select("doc_id", "hash").join(found, "hash").join(ids, "item")
        return named.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))
    sent = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(sent.value, shingle)
        for batch in batches:
            ids = batch.column(0)
            for row, _, data, offsets in _text.chunks(batch.column(1)):
                found = search_chunk(data, offsets, items, shingle, threshold)
                if found:
                    t, i, shared, n = (list(x) for x in zip(*found, strict=True))
                    columns = [ids.take(pa.array([row + x for x in t])), pa.array([items.ids[x] for x in i], pa.int64()), pa.array(shared, pa.int64()), pa.array(n, pa.int64()), pa.array([a / b for a, b in zip(shared, n, strict=True)], pa.float64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "n_shared", "n_item", "containment"])

    return texts.mapInArrow(run, schema)


def clean(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, threshold: float = CONTAINMENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the documents that hold an item of benchmark, found as by find_leaks; all columns stay, whatever their names."""
    prepare(docs.sparkSession)
    schema = docs.schema
    lower, mark = fresh(docs, "_lower", "_hash")
    rows = _sent(benchmark, block_bytes)
    if rows is None:
        texts = docs.select(F.lower("text").alias("text")).where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("hash"), "text")
        gone = cut(_joined(texts, benchmark, shingle, threshold).select(F.col("hash").alias(mark)).distinct())
        return docs.join(gone, F.xxhash64(F.lower("text")) == F.col(mark), "left_anti")
    sent = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(sent.value, shingle)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for row, _, data, offsets in _text.chunks(batch.column(batch.num_columns - 1)):
                keep[[row + f[0] for f in search_chunk(data, offsets, items, shingle, threshold)]] = False
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=schema.names).filter(pa.array(keep))

    return docs.withColumn(lower, F.lower("text")).mapInArrow(run, schema)
