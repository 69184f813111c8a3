"""Near-duplicates by the Jaccard similarity of their word shingles, exact on candidates by SimHash and, for the rest, MinHash.

A text is the set of its k-word shingles; equal sets are one node. Nodes have wide SimHash fingerprints, are linked through the
deletion variants of the fingerprints' segments (simhash.candidates), verified on the whole sets and sent to connected components.

That finds 93 of 100 pairs of similarity 0.8. For the others each node is also indexed under BANDS keys of ROWS minima each;
nodes of different components with an equal key are candidates too, verified alike. A pair of similarity 0.8
shares no such key with probability (1 - 0.8**ROWS)**BANDS, 1 in 70,000.

Runs of up to SHORT_RUN nodes under one key are compared pair by pair. Of a longer run each node is first
compared with the run's first and with its neighbours. Where that leaves a run in several groups, its texts go to
the task of the key, which counts the shingles that each text outside the run's largest group shares with each
text of the run, and gives only links between groups, fewer than there are groups. A run that is too
long for one task is dealt at random into parts that do so on their own; then, if it is still in several groups, the texts outside
its largest one visit all parts. So all pairs under a common key are judged, or of one group already.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlas.llm import _text
from statlas.llm._util import cut, prepare, small_batches, some
from statlas.llm.components import connected_components, local_stars
from statlas.llm.simhash import FAR, WIDE, candidates, distance, keep_one, wide

U = np.uint64
SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 28, 5
SHORT_RUN = 16
#: Rows of one run that a task holds; and of a run whose groups are compared, the texts that a task holds, and their shingles.
HELD_RUN = 1 << 12
HELD_SHINGLES = 1 << 20
#: Texts that a task unpacks at a time.
HELD_TEXTS = 256
#: Texts that _across() and _nearest() propose.
PARTNERS = 4

_random = np.random.default_rng(42)
_FACTORS = _random.integers(1 << 63, size=(BANDS * ROWS, 1), dtype=np.int64).astype(U) << U(1) | U(1)
_SHIFTS = _random.integers(1 << 63, size=(BANDS * ROWS, 1), dtype=np.int64).astype(U)
_FOLD = _random.integers(1 << 63, size=ROWS, dtype=np.int64).astype(U) << U(1) | U(1)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; fewer words: of their sequence; none: empty."""
    for _, _, data, offsets in _text.chunks(column):
        starts, ends, first = _text.words(_text.LOWER[data], offsets)
        hashed = _text.word_hashes(_text.LOWER[data], starts, ends)
        whole = _text.grams(hashed, k)
        for low, high in zip(first[:-1], first[1:], strict=True):
            if high - low >= k:
                yield np.unique(whole[low : high - k + 1])
            else:
                yield _text.grams(hashed[low:high], int(high - low)) if high > low else np.zeros(0, U)


def minima(values: np.ndarray) -> np.ndarray:
    out = np.full(BANDS * ROWS, U(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(values), 2048):
        np.minimum(out, (values[i : i + 2048] * _FACTORS + _SHIFTS).min(axis=1), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """The index keys of a set of shingles, none of an empty one."""
    if not len(values):
        return np.zeros(0, np.int64)
    folded = _text.mix((minima(values).reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=U))
    return _text.mix(folded + np.arange(BANDS, dtype=U)).view(np.int64)


def signed(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(hash, node, keys, size, words of WIDE) per row of docs (hash, text): a number of the text's set of shingles, its index keys, size and SimHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys, sizes, fps = [], [], [], [np.zeros((0, len(WIDE)), U)]
            for values in shingle_sets(batch.column(1), k):
                nodes.append(xxhash.xxh64_intdigest(values.tobytes(), 42))
                keys.append(band_keys(values))
                sizes.append(len(values))
                fps.append(wide(values)[None])
            ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
            flat = np.concatenate([*keys, np.zeros(0, np.int64)])
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            words = [pa.array(np.ascontiguousarray(w)) for w in np.concatenate(fps).view(np.int64).T]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(nodes, U).view(np.int64)), lists, pa.array(sizes, pa.int64()), *words], names=["hash", "node", "keys", "size", *WIDE])

    prepare(docs.sparkSession)
    return docs.select("hash", "text").mapInArrow(run, ", ".join(["hash long, node long, keys array<long>, size long", *(f"{c} long" for c in WIDE)]))


def pairs_of_runs(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates among nodes with equal keys, of a long run those with its first node and with neighbours; the rows are sorted, each run whole."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    length = np.diff(np.r_[starts, len(keys)])
    end, start, long = (np.repeat(x, length) for x in (starts + length, starts, length > SHORT_RUN))
    at = np.arange(len(keys))
    left, right = [start[long]], [at[long]]
    for step in range(1, SHORT_RUN):
        on = at[(at + step < end) & (~long | (step == 1))]
        left.append(on)
        right.append(on + step)
    a, b = nodes[np.concatenate(left)], nodes[np.concatenate(right)]
    return a[a != b], b[a != b]


def _ordered(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_k, held_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    open_run: tuple[int, int, int] | None = None  # key, first and latest node of a run that is too long to hold
    for batch in batches:
        k = np.concatenate([held_k, np.asarray(batch.column(0))])
        n = np.concatenate([held_n, np.asarray(batch.column(1))])
        if open_run is not None and len(k):
            key, first, latest = open_run
            end = int(np.searchsorted(k, key, side="right"))
            own = n[:end]
            if end:
                before = np.r_[latest, own[:-1]]
                yield _ordered(np.concatenate([np.full(end, first), before]), np.concatenate([own, own]))
                open_run = (key, first, int(own[-1]))
            k, n = k[end:], n[end:]
            if len(k):
                open_run = None
        if not len(k):
            held_k, held_n = k, n
            continue
        last = int(np.searchsorted(k, k[-1]))
        held_k, held_n = k[last:], n[last:]
        yield _ordered(*pairs_of_runs(k[:last], n[:last]))
        if len(held_k) > HELD_RUN:
            yield _ordered(*pairs_of_runs(held_k, held_n))
            open_run = (int(held_k[0]), int(held_n[0]), int(held_n[-1]))
            held_k, held_n = held_k[:0], held_n[:0]
    yield _ordered(*pairs_of_runs(held_k, held_n))


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes of different groups among PARTNERS neighbours under one key; rows (key, part, node, c) come sorted by key and part."""
    held = np.zeros((0, 4), np.int64)
    for batch in batches:
        rows = np.concatenate([held, np.stack([np.asarray(c) for c in batch.columns[:4]], axis=1)])
        left, right = [], []
        for step in range(1, PARTNERS + 1):
            x, y = rows[:-step], rows[step:]
            # a pair of two rows held from the batch before has been given out with it
            new = np.arange(len(x)) + step >= len(held)
            on = new & (x[:, 0] == y[:, 0]) & (x[:, 1] == y[:, 1]) & (x[:, 3] != y[:, 3])
            left.append(x[on, 2])
            right.append(y[on, 2])
        held = rows[-PARTNERS:]
        yield _ordered(np.concatenate(left), np.concatenate(right))


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each node with the 2 * PARTNERS of other groups under one key whose SimHash is nearest, those up to FAR bits.

    Rows (key, part, node, c, words of WIDE) come sorted by key and part.
    """
    held = np.zeros((4 + len(WIDE), 0), np.int64)

    def pairs(rows: np.ndarray) -> pa.RecordBatch:
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        edge = (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)
        for low, high in itertools.pairwise(np.r_[0, np.flatnonzero(edge) + 1, rows.shape[1]]):
            run = rows[:, low:high]
            fps = run[4:].view(U)
            for i in range(0, high - low, 256):
                apart = distance(fps[:, i : i + 256, None], fps[:, None, :])
                apart[run[3, i : i + 256, None] == run[3]] = FAR + 1
                near = np.argsort(apart, axis=1, kind="stable")[:, : 2 * PARTNERS]
                x, y = np.nonzero(np.take_along_axis(apart, near, axis=1) <= FAR)
                left.append(run[2, i + x])
                right.append(run[2, near[x, y]])
        return _ordered(np.concatenate(left), np.concatenate(right))

    for batch in batches:
        rows = np.concatenate([held, np.stack([np.asarray(c) for c in batch.columns[: len(held)]])], axis=1)
        if rows.shape[1]:
            last = int(np.flatnonzero((rows[:2] == rows[:2, -1:]).all(axis=0))[0])
            yield pairs(np.ascontiguousarray(rows[:, :last]))
            held = rows[:, last:]
    yield pairs(np.ascontiguousarray(held))


def unpacked(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sets of shingles of texts as packed() gives them."""
    unpack = zstandard.ZstdDecompressor().decompress
    return shingle_sets(pa.array([unpack(t.as_py()) if t.is_valid else None for t in column], pa.large_binary()), k)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each start, as many as its count."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def shared(sets: list[np.ndarray], values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many values each set has in common with each of n others: values are theirs, sorted, owner says whose."""
    words = np.unique(np.concatenate(sets))
    starts = np.searchsorted(values, words)
    counts = np.searchsorted(values, words, side="right") - starts
    out = np.zeros((len(sets), n), np.float32)
    each = [np.searchsorted(words, s) for s in sets]
    often = np.flatnonzero(counts > n // 32)  # a product of tables of bits costs less for these
    for i in range(0, len(often), 512):
        part = often[i : i + 512]
        table, own = np.zeros((len(part), n), np.float32), np.zeros((len(sets), len(part)), np.float32)
        table[np.repeat(np.arange(len(part)), counts[part]), owner[_spread(starts[part], counts[part])]] = 1
        place = np.full(len(words), -1)
        place[part] = np.arange(len(part))
        for row, at in zip(own, each, strict=True):
            on = place[at]
            row[on[on >= 0]] = 1
        out += own @ table
    counts[often] = 0
    for row, at in zip(out, each, strict=True):
        row += np.bincount(owner[_spread(starts[at], counts[at])], minlength=n)
    return out.astype(np.int64)


def _linking(k: int, similarity: float):
    """Links between the groups of each (key, part), fewer than there are groups.

    Rows (key, part, visits, other, c, text) come sorted by key, part and visits: of the texts of a part those that are other than the run's
    largest group are compared with all, then those that visit it from other parts, which are not held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, labels, others, index = None, [], [], [], None
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def compare(sets: list[np.ndarray], of: np.ndarray) -> None:
            nonlocal a, b
            values, owner, sizes, c = index
            for i in range(0, len(sets), HELD_TEXTS):
                part = sets[i : i + HELD_TEXTS]
                both = shared(part, values, owner, len(sizes))
                good = both >= similarity * (np.array([len(s) for s in part])[:, None] + sizes - both)
                x, y = np.nonzero(good & (of[i : i + HELD_TEXTS, None] != c))
                a, b = local_stars(np.concatenate([a, of[i + x]]), np.concatenate([b, c[y]]))

        def close() -> None:
            """All texts of the part are there."""
            nonlocal index
            if index is None and held:
                sizes = np.array([len(s) for s in held])
                values = np.concatenate(held)
                order = np.argsort(values, kind="stable")
                c = np.array(labels, np.int64)
                index = values[order], np.repeat(np.arange(len(held)), sizes)[order], sizes, c
                on = np.flatnonzero(others)
                compare([held[i] for i in on], c[on])

        for batch in batches:
            for i in range(0, batch.num_rows, HELD_TEXTS):
                rows = batch.slice(i, HELD_TEXTS)
                key, part, visits, other, c = (rows.column(j).to_numpy(zero_copy_only=False) for j in range(5))
                sets = list(unpacked(rows.column(5), k))
                edge = (key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (visits[1:] != visits[:-1])
                for low, high in itertools.pairwise([0, *(np.flatnonzero(edge) + 1), len(key)]):
                    if (key[low], part[low]) != place:
                        close()
                        yield _ordered(a, b)
                        place, held, labels, others, index, a, b = (key[low], part[low]), [], [], [], None, a[:0], b[:0]
                    if visits[low]:
                        close()
                        if index is not None:
                            compare(sets[low:high], c[low:high])
                    else:
                        held += sets[low:high]
                        labels += c[low:high].tolist()
                        others += other[low:high].tolist()
        close()
        yield _ordered(a, b)

    return run


def packed(docs: DataFrame) -> DataFrame:
    """docs (hash, text) with each text compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for i in range(0, batch.num_rows, HELD_TEXTS):
                part = batch.slice(i, HELD_TEXTS)
                texts = [pack(t.as_py()) if t.is_valid else None for t in part.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary())], names=["hash", "text"])

    return docs.select("hash", "text").mapInArrow(run, "hash long, text binary")


def texts_of(nodes: DataFrame, docs: DataFrame, of: DataFrame) -> DataFrame:
    """(node, text) of the nodes asked for, one compressed text each. docs: (hash, text); of: (hash, node)."""
    one = of.groupBy("node").agg(F.min("hash").alias("hash")).join(nodes.distinct(), "node")
    # copies combine before the exchange, so a text that a third of all documents share is no larger task than others
    different = packed(docs).groupBy("hash").agg(F.first("text").alias("text"))
    return different.join(one, "hash").select("node", "text")


def verified(pairs: DataFrame, texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are at least so similar. texts: as texts_of() gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i in range(0, batch.num_rows, HELD_TEXTS):
                part = batch.slice(i, HELD_TEXTS)
                for x, y in zip(unpacked(part.column(2), k), unpacked(part.column(3), k), strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left, right = texts.select(F.col("node").alias("a"), F.col("text").alias("x")), texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def between(pairs: DataFrame, linked: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes in different components. linked: (node, component) of the nodes that have links."""
    for end in ("a", "b"):
        pairs = pairs.join(linked.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left")
    return pairs.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def split_runs(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """(key, most, parts) of the runs of rows (key, node, size) that are in several groups: the largest of those, and the parts that tasks can hold."""
    of = rows.join(linked, "node", "left").groupBy("key", F.coalesce("component", "node").alias("c")).agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    parts = F.ceil(F.greatest(F.sum("n") / HELD_RUN, F.sum("size") / HELD_SHINGLES)).alias("parts")
    return of.groupBy("key").agg(F.count("*").alias("groups"), F.max_by("c", F.struct("n", "c")).alias("most"), parts).where("groups > 1").drop("groups")


def between_groups(rows: DataFrame, split: DataFrame, linked: DataFrame, texts: DataFrame, whole: bool, k: int, similarity: float) -> DataFrame:
    """Links (a, b) between the groups of texts under one key, within its parts or, if whole, in all. split: as split_runs() gives it."""
    named = rows.join(split, "key").join(linked, "node", "left").withColumn("c", F.coalesce("component", "node"))
    named = named.withColumn("other", F.col("c") != F.col("most")).withColumn("own", F.pmod(F.xxhash64("node", "key"), "parts"))
    everywhere = F.col("other") & F.lit(whole)
    at = F.when(everywhere, F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array("own"))
    dealt = named.withColumn("part", F.explode(at)).withColumn("visits", F.col("part") != F.col("own"))
    dealt = dealt.join(texts, "node").select("key", "part", "visits", "other", "c", "text")
    dealt = dealt.repartition(F.col("key"), F.col("part")).sortWithinPartitions("key", "part", "visits")
    return dealt.mapInArrow(_linking(k, similarity), "a long, b long").distinct()


def groups(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(hash, c) for each distinct hash of docs (hash, text): texts linked by similarity have one c; those without a word are one group."""
    marked = cut(signed(docs, k))
    of = marked.select("hash", "node").distinct()
    nodes = marked.dropDuplicates(["node"])
    similar = cut(candidates(nodes.where(F.size("keys") > 0), marked.count()))
    rows = nodes.select(F.explode("keys").alias("key"), "node")
    rows = cut(rows.repartition(F.col("key")).sortWithinPartitions("key", "node"))
    pairs = cut(rows.mapInArrow(_candidates, "a long, b long").distinct())
    # each node of a long run is in a pair, so these are the texts of all rounds
    both = pairs.union(similar)
    texts = cut(texts_of(both.select(F.col("a").alias("node")).union(both.select("b")), docs, of))
    links = cut(verified(similar, texts, k, similarity))
    linked = connected_components(links)
    rest = cut(between(pairs, linked).join(similar, ["a", "b"], "left_anti"))
    if some(rest):
        links = links.union(cut(verified(rest, texts, k, similarity)))
        linked = connected_components(links)
    long = rows.groupBy("key").count().where(F.col("count") > SHORT_RUN).select("key")
    open_rows = cut(rows.join(long, "key").join(nodes.select("node", "size"), "node"))
    for whole in (False, True):  # each part by itself, then the runs of several parts
        split = cut(split_runs(open_rows, linked).where("parts > 1" if whole else "true"))
        if not some(split):
            break
        more = cut(between_groups(open_rows, split, linked, texts, whole, k, similarity))
        if some(more):
            links = links.union(more)
            linked = connected_components(links)
    return of.join(linked, "node", "left").select("hash", F.coalesce("component", "node").alias("c"))


def one_of_each(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each group of similar texts, chosen as simhash.keep_one() does."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"))
    with small_batches(docs.sparkSession):
        of = groups(docs.select(F.xxhash64("text").alias("hash"), "text"), k, similarity)
    return keep_one(docs, ids.join(of, "hash"))
