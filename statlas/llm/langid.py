"""Language identification with a blended-spectrum string kernel.

A text is the set of its character n-grams (1 to 3 bytes, lower case, folded into DIMENSIONS
buckets); the kernel of two texts is the number of common n-grams over the root of the product of
their numbers. Nyström landmarks turn it into a feature map, and one-versus-rest kernel ridge
regression is fitted on it. A batch of texts is scored by matrix products: presence rows times
landmark rows, divided by the norms, times the regression weights.

The fit uses at most PER_LANGUAGE labelled texts of a language and SAMPLE in all, chosen by a hash
of the text alone; scoring reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlas.llm import _text
from statlas.llm._util import fresh, prepare

DIMENSIONS = 1 << 14
LANDMARKS = 128
#: Texts that the fit uses: of a language at most, and in all. A text takes DIMENSIONS / 8 bytes on the driver.
PER_LANGUAGE, SAMPLE = 400, 25_600
RIDGE = 1e-3
SHARPNESS = 6.0
UNDETERMINED = "und"
#: Texts in one matrix product.
TEXTS = 256

#: Bytes of n-grams: lower case, all white space, digits and ASCII signs as one blank.
_FOLD = _text.LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 by text: which buckets its n-grams fall into."""
    n_texts = len(offsets) - 1
    out = np.zeros((n_texts, DIMENSIONS), np.float32)
    b = _FOLD[data].astype(np.uint32)
    for t in range(n_texts):
        x = b[offsets[t] : offsets[t + 1]]
        x = x[np.r_[True, (x[1:] != 32) | (x[:-1] != 32)]] if len(x) else x
        row = out[t]
        row[x] = 1
        two = x[:-1] * np.uint32(0x9E3779B1) + x[1:] * np.uint32(0x85EBCA77)
        row[(two ^ (two >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(18)] = 1
        three = two[:-1] * np.uint32(0xC2B2AE3D) + x[2:] * np.uint32(0x27D4EB2F)
        row[(three ^ (three >> np.uint32(13))) * np.uint32(0x297A2D39) >> np.uint32(18)] = 1
    return out


class Model:
    """Landmark rows, the feature map and the regression weights."""

    def __init__(self, x: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> None:
        names, code = np.unique(labels, return_inverse=True)
        self.languages = names.tolist()
        target = np.where(code[:, None] == np.arange(len(names)), 1.0, -1.0)
        share = np.bincount(code)[code].astype(float)
        # landmarks in turn from each language, in the order of the sample
        rank = {lang: 0 for lang in self.languages}
        order = []
        for i, label in enumerate(labels):
            order.append((rank[label], i))
            rank[label] += 1
        marks = x[[i for _, i in sorted(order)[:landmarks]]]
        self.marks = np.ascontiguousarray(marks.T)
        self.norms = np.sqrt(np.maximum(marks.sum(axis=1), 1))
        values, vectors = np.linalg.eigh(self.kernel(marks).astype(float))
        good = values > 1e-6 * values[-1]
        half = vectors[:, good] / np.sqrt(values[good])
        features = np.c_[self.kernel(x) @ half, np.ones(len(x))]
        weight = (1 / share)[:, None] * len(labels) / len(self.languages)
        fitted = np.linalg.solve(features.T @ (features * weight) + ridge * len(x) * np.eye(features.shape[1]), features.T @ (target * weight))
        self.weights = (half @ fitted[:-1]).astype(np.float32)
        self.bias = fitted[-1].astype(np.float32)

    def kernel(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.marks) / (np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None] * self.norms)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language of each row, and a score from 0 to 1 (a softmax of the regression's margins)."""
        margin = self.kernel(x) @ self.weights + self.bias
        best = margin.argmax(axis=1)
        share = np.exp(SHARPNESS * (margin - margin.max(axis=1)[:, None]))
        return [self.languages[i] for i in best], np.minimum(1.0, 1.0 / share.sum(axis=1))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in _text.chunks(batch.column(1)):
            bits = [np.packbits(presence(data[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))[0] > 0).tobytes() for i in range(end - row)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(bits, pa.binary()), batch.column(2).slice(row, end - row)], names=["label", "bits", "turn"])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> Model | None:
    """A model from labelled (text, lang); null langs and texts without a letter are left out. None if nothing is left.

    At most per_language different texts of each language are used, those with the smallest hash of their text, and
    at most sample in all: of many languages fewer texts each, and of more languages than that the most frequent ones.
    """
    prepare(labelled.sparkSession)
    known = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text"))).select(F.col("lang").alias("label"), "text", F.xxhash64(F.lit("fit"), "text").alias("turn"))
    # copies of a text share its hash and count once, so that they neither fill the sample nor thin it out
    counts = known.select("label", "turn").distinct().groupBy("label").agg(F.count("*").alias("n"))
    found = {r["label"]: r["n"] for r in counts.orderBy(F.desc("n"), "label").limit(sample).collect()}
    if not found:
        return None
    per_language = min(per_language, sample // len(found))
    # a share of the hash space that holds about twice the wanted texts, then at most per_language of them
    share = [(lang, int((1 << 63) * min(1.0, 2 * per_language / n)) - 1 if n > 2 * per_language + 16 else (1 << 63) - 1) for lang, n in sorted(found.items())]
    limits = labelled.sparkSession.createDataFrame(share, "label string, upto long")  # at most sample rows
    drawn = known.join(F.broadcast(limits), "label").where(F.col("turn").bitwiseAND(F.lit((1 << 63) - 1)) <= F.col("upto"))
    rows: dict[str, list[tuple[int, bytes]]] = {lang: [] for lang in found}
    for r in drawn.select("label", "text", "turn").dropDuplicates(["label", "turn"]).mapInArrow(_packed, "label string, bits binary, turn long").collect():
        rows[r["label"]].append((r["turn"], bytes(r["bits"])))
    labels, bits = [], []
    for lang, texts in sorted(rows.items()):
        for _, raw in sorted(texts)[:per_language]:
            labels.append(lang)
            bits.append(np.frombuffer(raw, np.uint8))
    return Model(np.unpackbits(np.array(bits), axis=1).astype(np.float32), labels)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with lang_pred and score: und and 0 if text is null or has no letter (or there is no model).

    Only text is looked at. Columns named lang_pred or score are replaced, all others stay; equal texts get equal results.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    docs = docs.withColumn(fresh(docs, "_letter")[0], has_letter(F.col("text")))
    schema = T.StructType([*docs.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    text = docs.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            letter = batch.column(batch.num_columns - 1).to_pylist()
            langs, scores = [], []
            for row, end, data, offsets in _text.chunks(batch.column(text)):
                for at in range(0, end - row, TEXTS):
                    part = offsets[at : at + TEXTS + 1]
                    if model is None:
                        lang, score = [UNDETERMINED] * (len(part) - 1), np.zeros(len(part) - 1)
                    else:
                        lang, score = model.predict(presence(data[part[0] : part[-1]], part - part[0]))
                    langs += lang
                    scores += score.tolist()
            langs = [x if ok else UNDETERMINED for x, ok in zip(langs, letter, strict=True)]
            scores = [float(x) if ok else 0.0 for x, ok in zip(scores, letter, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """One document in five is not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
