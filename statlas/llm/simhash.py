"""SimHash near-duplicates, linked through deletion-variant signatures.

A 64-bit fingerprint is cut into two halves of 32 bits. Fingerprints that differ in at most two
bits have a half that differs in at most one, and so share one of the half's 32 variants with one
bit wiped out. Every distinct fingerprint is indexed under its 64 variants, those with an equal
variant meet by equality, are verified on all 64 bits, and the links go to connected components.

Copies share a fingerprint, so a group of copies is one index entry however large it is. Entries
with one key are verified as a stream; a long run of them is not compared pair by pair but grouped
again by the variants of its other half, which costs a fixed number of sorts. A run that is too long
for one task is grouped so by a second exchange, in which each group is a small part of the run.

For texts that differ more, wide fingerprints of 128 bits over a set of shingles (wide()) are cut into segments of 16 bits
or more and indexed under each segment's deletion variants in the same way; candidates() gives those that share a key and
differ in at most FAR bits. Sets of Jaccard similarity 0.8 have a cosine of at least 0.889 and so differ in 15 % of the
bits: 8 segments of 16 bits share a key with probability 0.93 at 0.8, over 0.99 at 0.9. What is missed is the caller's to find.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlas.llm._text import mix, popcount
from statlas.llm._util import cut, fresh, prepare, some
from statlas.llm.components import connected_components, local_stars

U = np.uint64
#: Runs up to this length are compared pair by pair in place.
SHORT_RUN = 48
#: Runs up to this length are held in a task; the members of longer ones go to one more exchange, by their groups.
HELD_RUN = 1 << 16
#: Wide fingerprints: words of 64 bits, and the most differing bits of a candidate. At 0.8 that is 4.3 standard deviations
#: above the mean (one of 100,000 pairs differs in more), at random pairs as many below (one of a million in less).
WORDS, FAR = 2, 37
_SALTS = np.arange(1, WORDS + 1, dtype=U) * U(0x9E3779B97F4A7C15)
#: In runs of wide fingerprints up to this length all candidates are given, in longer ones the nearest of each.
FEW = 16
#: Wide fingerprints of one key that a task holds.
HELD_WIDE = 1 << 12


def fingerprint(text: bytes, k: int = 3, seed: int = 42) -> int:
    """SimHash over all k-word shingles, repeats included; fewer than k words: of their sequence; none: 0."""
    parts = text.lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(parts) <= k:
        return digest(b" ".join(parts), seed)
    if k == 3:
        h = np.array([digest(b"%b %b %b" % t, seed) for t in zip(parts, parts[1:], parts[2:])], U)
    else:
        h = np.array([digest(b" ".join(parts[i : i + k]), seed) for i in range(len(parts) - k + 1)], U)
    count = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i : i + (1 << 16)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) per row of docs; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", k, seed) for t in text), U, len(text)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def variants(fp: np.ndarray) -> np.ndarray:
    """The 64 index keys of each fingerprint: half, wiped bit and what is left of the half."""
    one = U(1) << np.arange(32, dtype=U)
    tag = np.arange(32, dtype=U) << U(32)
    high, low = fp >> U(32), fp & U(0xFFFFFFFF)
    return np.concatenate([(high[:, None] & ~one) | tag, (low[:, None] & ~one) | tag | U(1 << 37)], axis=1)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.asarray(batch.column(0)).view(U)
        for i in range(0, len(fp), 512):
            part = fp[i : i + 512]
            keys = variants(part).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(part, 64).view(np.int64))], names=["key", "fp"])


def long_run(key: int, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within one run of sorted, distinct fingerprints, by variants of the other half."""
    first_half = not key >> 37
    other, own = (fp & U(0xFFFFFFFF), fp >> U(32)) if first_half else (fp >> U(32), fp & U(0xFFFFFFFF))
    left, right = [], []

    def link(group: np.ndarray) -> None:
        order = np.argsort(group, kind="stable")
        same = group[order[1:]] == group[order[:-1]]
        left.append(fp[order[1:]][same])
        right.append(fp[order[:-1]][same])

    bits = U(1) << np.arange(32, dtype=U)
    for b in bits:  # at most one bit apart in either half
        link(other & ~b)
    if (key >> 32) & 31 == 0:  # equal own halves, two bits apart in the other; each such pair is in the run of bit 0
        for i in range(32):
            for j in range(i):
                link((own << U(32)) | (other & ~(bits[i] | bits[j])))
    return np.concatenate(left), np.concatenate(right)


def links_of_runs(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among fingerprints with equal keys; the rows are sorted by key, each run whole."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    length = np.diff(np.r_[starts, len(keys)])
    left, right = [], []
    short = (length > 1) & (length <= SHORT_RUN)
    if short.any():
        end = np.repeat((starts + length)[short], length[short])
        at = np.arange(len(end)) + np.repeat(starts[short] - np.r_[0, np.cumsum(length[short])[:-1]], length[short])
        for step in range(1, int(length[short].max())):
            on = at + step < end
            at, end = at[on], end[on]
            near = popcount(fps[at] ^ fps[at + step]) <= 2
            left.append(fps[at[near]])
            right.append(fps[at[near] + step])
    for i in np.flatnonzero(length > SHORT_RUN):
        a, b = long_run(int(keys[starts[i]]), fps[starts[i] : starts[i] + length[i]])
        left.append(a)
        right.append(b)
    if not left:
        return np.zeros(0, U), np.zeros(0, U)
    return np.concatenate(left), np.concatenate(right)


def deep_rows(key: int, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, fp) of the members of one run: members of one group are linked, and linked members share a group."""
    first_half = not key >> 37
    other, own = (fp & U(0xFFFFFFFF), fp >> U(32)) if first_half else (fp >> U(32), fp & U(0xFFFFFFFF))
    bits = U(1) << np.arange(32, dtype=U)
    keys = [(other[:, None] & ~bits) | (np.arange(32, dtype=U) << U(32))]
    if (key >> 32) & 31 == 0:  # equal own halves, two bits apart in the other; the halves of this run differ in bit 0
        i, j = np.tril_indices(32, -1)
        tag = (np.arange(len(i), dtype=U) << U(32)) | U(1 << 62)
        keys.append((other[:, None] & ~(bits[i] | bits[j])) | tag | ((own & U(1)) << U(61))[:, None])
    each = np.concatenate(keys, axis=1)
    return each.ravel(), np.repeat(fp, each.shape[1])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, a, b): links a-b with a null key, and members b of groups (key, a) of the runs that are too long to hold."""
    held_k, held_f = np.zeros(0, np.int64), np.zeros(0, U)
    spilled = None

    def rows(key: int | None, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        keys = pa.nulls(len(a), pa.int64()) if key is None else pa.array(np.full(len(a), key))
        return pa.RecordBatch.from_arrays([keys, pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["key", "a", "b"])

    def links(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        a, b = links_of_runs(k, f)
        return rows(None, *local_stars(a.view(np.int64), b.view(np.int64)))

    def spill(key: int, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(f), 64):
            group, member = deep_rows(key, f[i : i + 64])
            yield rows(key, group.view(np.int64), member.view(np.int64))

    for batch in batches:
        k = np.concatenate([held_k, np.asarray(batch.column(0))])
        f = np.concatenate([held_f, np.asarray(batch.column(1)).view(U)])
        if not len(k):
            continue
        if spilled is not None:
            end = int(np.searchsorted(k, spilled, side="right"))
            yield from spill(spilled, f[:end])
            k, f = k[end:], f[end:]
            if not len(k):
                held_k, held_f = k, f
                continue
            spilled = None
        last = int(np.searchsorted(k, k[-1]))
        yield links(k[:last], f[:last])
        held_k, held_f = k[last:], f[last:]
        if len(held_k) > HELD_RUN:
            spilled = int(held_k[0])
            yield from spill(spilled, held_f)
            held_k, held_f = held_k[:0], held_f[:0]
    yield links(held_k, held_f)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between neighbours of equal (key, group); the rows come sorted."""
    last = np.zeros((0, 3), np.int64)
    for batch in batches:
        rows = np.concatenate([last, np.stack([np.asarray(c) for c in batch.columns], axis=1)])
        same = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
        last = rows[-1:]
        yield pa.RecordBatch.from_arrays([pa.array(rows[:-1, 2][same]), pa.array(rows[1:, 2][same])], names=["a", "b"])


def components(fps: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for a table (doc_id, fp): fingerprints are linked at two or fewer differing bits.

    component_id is the smallest doc_id reachable. Null doc_ids take part and count as larger than all others.
    """
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rows = distinct.select("fp").mapInArrow(_index, "key long, fp long")
    found = cut(rows.repartition(F.col("key")).sortWithinPartitions("key", "fp").mapInArrow(_verify, "key long, a long, b long"))
    links, deep = found.where("key is null").select("a", "b"), found.where("key is not null")
    if some(deep):
        links = links.union(deep.repartition(F.col("key"), F.col("a")).sortWithinPartitions("key", "a", "b").mapInArrow(_chain, "a long, b long"))
    of = connected_components(links)
    named = distinct.join(of, distinct.fp == of.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("c"))
    ids = named.groupBy("c").agg(F.min("least").alias("component_id"))
    by_fp = named.join(ids, "c").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of docs (doc_id, text; other columns are not looked at).

    A null or empty text has fingerprint zero and is linked like any other. Repeated rows give repeated results;
    rows that share a doc_id are separate documents of one name. An empty table gives an empty result.
    """
    found = components(cut(fingerprints(docs, k, seed)))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def wide(values: np.ndarray) -> np.ndarray:
    """The SimHash of WORDS words over a set of hashed shingles, sorted; a tie goes as the first shingle's bit does."""
    if not len(values):
        return np.zeros(WORDS, U)
    count = np.zeros(64 * WORDS, np.int64)
    for i in range(0, len(values), 255):  # so many bits fit a byte's count
        h = np.stack([mix(values[i : i + 255] + s) for s in _SALTS], axis=1)
        bits = np.unpackbits(h.view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little")
        count += np.add.reduce(bits, axis=0, dtype=np.uint8)
        first = bits[0] if not i else first
    return np.packbits(count * 2 + first > len(values), bitorder="little").view(U)


def segment_bits(n: int) -> int:
    """Bits of a segment for so many fingerprints: 16, and more where more than about 100 would share a key by chance."""
    return min(32, max(16, math.ceil(math.log2(n + 1)) - 6))


def wide_variants(fps: np.ndarray, width: int) -> np.ndarray:
    """The index keys of each row of WORDS words: segment, wiped bit and what is left of the segment."""
    bits = np.unpackbits(fps.view(np.uint8), axis=1, bitorder="little")
    n = bits.shape[1] // width
    parts = bits[:, : n * width].reshape(len(fps), n, width).astype(U) << np.arange(width, dtype=U)
    whole = parts.sum(axis=2, dtype=U)
    tag = np.arange(n * width, dtype=U).reshape(n, width) << U(32)
    return ((whole[:, :, None] - parts) | tag).reshape(len(fps), -1)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return sum(popcount(x ^ y).astype(np.int16) for x, y in zip(a, b, strict=True))


def near_in_runs(keys: np.ndarray, nodes: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes with equal keys that differ in at most FAR bits. Of runs longer than FEW each node comes with the nearest before it.

    The rows are sorted, each run whole; fps: WORDS rows of words.
    """
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    length = np.diff(np.r_[starts, len(keys)])
    end = np.repeat(starts + length, length)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = np.flatnonzero(np.repeat(length <= FEW, length))
    for step in range(1, FEW):
        at = at[at + step < end[at]]
        near = at[distance(fps[:, at], fps[:, at + step]) <= FAR]
        left.append(near)
        right.append(near + step)
    for i in np.flatnonzero(length > FEW):
        for low in range(starts[i], starts[i] + length[i], 256):
            rows = np.arange(low, min(low + 256, starts[i] + length[i]))
            before = np.arange(starts[i], rows[-1])
            if len(before):
                apart = distance(fps[:, rows, None], fps[:, None, before])
                apart[before >= rows[:, None]] = 64 * WORDS + 1
                best = apart.argmin(axis=1)
                near = apart[np.arange(len(rows)), best] <= FAR
                left.append(before[best[near]])
                right.append(rows[near])
    a, b = nodes[np.concatenate(left)], nodes[np.concatenate(right)]
    return a[a != b], b[a != b]


def _wide_index(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.stack([np.asarray(c) for c in batch.columns], axis=1)
            for i in range(0, len(table), 128):
                part = table[i : i + 128]
                keys = wide_variants(np.ascontiguousarray(part[:, 1:]).view(U), width)
                each = np.repeat(part, keys.shape[1], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), *(pa.array(c) for c in each.T)], names=["key", "node", *WIDE])

    return run


def _wide_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of candidates, a < b; rows (key, node, words) come sorted by key. Of a run that is too long to hold the last FEW rows go on."""
    held = np.zeros((2 + WORDS, 0), np.int64)

    def pairs(rows: np.ndarray) -> pa.RecordBatch:
        a, b = near_in_runs(rows[0], rows[1], rows[2:].view(U))
        each = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(each[0]), pa.array(each[1])], names=["a", "b"])

    for batch in batches:
        rows = np.concatenate([held, np.stack([np.asarray(c) for c in batch.columns])], axis=1)
        if not rows.shape[1]:
            continue
        last = int(np.searchsorted(rows[0], rows[0, -1]))
        if last:
            yield pairs(np.ascontiguousarray(rows[:, :last]))
        held = np.ascontiguousarray(rows[:, last:])
        if held.shape[1] > HELD_WIDE:
            yield pairs(held)
            held = np.ascontiguousarray(held[:, -FEW:])
    yield pairs(held)


#: Columns of a wide fingerprint's words.
WIDE = [f"f{j}" for j in range(WORDS)]


def candidates(fps: DataFrame, n: int) -> DataFrame:
    """(a, b), a < b, of nodes with a common key that differ in at most FAR bits. fps: (node, words of WIDE), n nodes or about so many."""
    prepare(fps.sparkSession)
    columns = ", ".join(f"{c} long" for c in ["key", "node", *WIDE])
    rows = fps.select("node", *WIDE).mapInArrow(_wide_index(segment_bits(n)), columns)
    return rows.repartition(F.col("key")).sortWithinPartitions("key", "node").mapInArrow(_wide_pairs, "a long, b long").distinct()


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with one row of each group; found: (doc_id, hash, c) per row of docs, its group c following from the text's hash.

    The row with the smallest doc_id stays, a null doc_id counting as larger than all others. A row goes only for
    its own text's group, so rows that share a doc_id or have none are separate documents.
    """
    rows = found.groupBy("c", "doc_id", "hash").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "hash")
    first = rows.groupBy("c").agg(F.min(order).alias("first"), F.sum("n").alias("total")).where("total > 1").drop("total")
    id_, hash_ = fresh(docs, "_id", "_hash")
    marks = rows.join(first, "c").select(F.col("doc_id").alias(id_), F.col("hash").alias(hash_), order.eqNullSafe(F.col("first")).alias("stays"), "n")
    marks = cut(marks.where("not stays or n > 1"))
    this = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))
    kept = docs.join(marks.select(id_, hash_), this, "left_anti")
    again = marks.where("stays").select(id_, hash_)
    if some(again):
        kept = kept.unionByName(docs.join(again, this).dropDuplicates([id_, hash_]).select(*docs.columns))
    return kept


def one_of_each(docs: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """docs with one row of each group of near-duplicates, chosen as keep_one() does."""
    rows = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    fps = cut(fingerprints(rows, k, seed).withColumnRenamed("doc_id", "hash").distinct())
    groups = components(fps.select(F.col("fp").alias("doc_id"), "fp")).select("fp", F.col("component_id").alias("c")).distinct()
    of = fps.join(groups, "fp").select("hash", "c")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"))
    return keep_one(docs, ids.join(of, "hash"))
