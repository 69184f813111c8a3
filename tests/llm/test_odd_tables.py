"""Each operator on a table with the names of helper columns, null ids, repeated rows, empty and very long texts, and on no rows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from statlas.llm import decontam, htmltext, langid, media, minhash, mixing, pii, simhash, substring, urlfilter, warc
from statlas.llm._util import fresh, scratch
from statlas.llm.queries import RULES

HELPERS = ["_doc", "_tie", "_group", "_key", "doc", "places", "_places", "_lower", "cut", "epochs", "_letter", "_id", "_hash", "hash", "node", "c", "n", "key", "grp"]
LONG = " ".join(f"w{random.Random(i).randrange(5000)}" for i in range(60_000))
ROWS = [(1, "ein Text mit Wörtern", "de", "src1"), (1, "ein Text mit Wörtern", "de", "src1"), (None, None, None, None), (None, "", "en", "src2"), (None, "some english words here", "en", "src2"), (2, LONG, "en", "src3"), (3, "12 34", None, "src1")]


@pytest.fixture(scope="module")
def docs(spark):
    names = ", ".join(f"{h} int" for h in HELPERS)
    return spark.createDataFrame([(*r, *range(len(HELPERS))) for r in ROWS], f"doc_id long, text string, lang string, source string, {names}").repartition(3)


OPERATORS = {
    "substring": substring.remove_repeats,
    "pii": pii.with_spans,
    "langid": lambda d: langid.identify(d, langid.fit(d.sparkSession.createDataFrame(ROWS, "doc_id long, text string, lang string, source string"))),
    "mixing": lambda d: mixing.mixed(d, mixing.Mix(share=2.0)),
    "simhash": simhash.one_of_each,
    "minhash": minhash.one_of_each,
    "decontam": lambda d: decontam.clean(d, d.sparkSession.createDataFrame([(1, "nothing of the kind at all")], "item_id long, text string")),
}
#: Rows left, of those above.
LEFT = {"mixing": 5, "simhash": 5, "minhash": 5}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_rows_and_other_columns_stay(docs, name):
    out = OPERATORS[name](docs)
    assert set(docs.columns) <= set(out.columns)
    rows = out.select(*docs.columns).collect()
    assert len(rows) == LEFT.get(name, len(ROWS))
    assert all(tuple(r)[4:] == tuple(range(len(HELPERS))) for r in rows) and {tuple(r)[:4] for r in rows} <= set(ROWS)
    assert OPERATORS[name](docs.where("false")).count() == 0


def test_queries_on_rows_without_ids(spark, docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS) and sorted({r.fingerprint for r in got if r.doc_id is None})[0] == "0" * 16
    assert simhash.near_duplicates(docs.where("false")).count() == 0
    read = media.load(media.store(docs)).collect()
    assert len(read) == len(ROWS) and {r.n_bytes for r in read} == {len((r[1] or "").encode()) for r in ROWS}
    assert media.load(media.store(docs.where("false"))).count() == 0
    pages = spark.createDataFrame([(None, None, None, 1), (1, "http://a.org/x", LONG, 2), (1, "http://a.org/x", LONG, 2)], "page_id long, url string, html string, rule int")
    assert [len(r.text) for r in htmltext.extract(pages).collect()].count(0) == 1
    assert urlfilter.judge(pages, RULES).count() == 3 and urlfilter.judge(pages.where("false"), RULES).count() == 0
    path = scratch(spark, "warc")
    warc.write_warc(pages.where("page_id is not null"), path)
    assert warc.read_warc(spark, path).count() == 2


def test_fresh_names(docs):
    assert fresh(docs, "_doc", "new", "NEW", "CUT") == ["__doc", "new", "_NEW", "_CUT"]


def test_kernel_and_regression_against_plain_ones():
    """Presence of all byte n-grams as sets, kernel by set sizes, ridge regression by its normal equations."""
    texts = ["der hund und die katze", "die katze und das haus", "the dog and the cat", "a cat and the house", "le chien et le chat", "la maison et le chat"]
    labels = ["de", "de", "en", "en", "fr", "fr"]

    def buckets(text: str) -> frozenset:
        raw = text.encode()
        row = langid.presence(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        return frozenset(np.flatnonzero(row).tolist())

    def grams(text: str) -> int:
        folded = " ".join(text.split())
        return len({folded[i : i + n] for n in (1, 2, 3) for i in range(len(folded) - n + 1)})

    sets = [buckets(t) for t in texts]
    assert all(abs(len(s) - grams(t)) <= 1 for s, t in zip(sets, texts, strict=True))  # a bucket for each n-gram, but for a rare collision
    kernel = np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets] for a in sets])
    x = np.zeros((6, langid.DIMENSIONS), np.float32)
    for i, s in enumerate(sets):
        x[i, sorted(s)] = 1
    model = langid.Model(x, labels, landmarks=6)
    values, vectors = np.linalg.eigh(kernel)
    features = np.c_[kernel @ (vectors / np.sqrt(values)), np.ones(6)]
    target = np.array([[1.0 if lang == label else -1.0 for lang in ("de", "en", "fr")] for label in labels])
    weights = np.linalg.solve(features.T @ features + langid.RIDGE * 6 * np.eye(7), features.T @ target)
    margin = features @ weights
    share = np.exp(langid.SHARPNESS * (margin - margin.max(axis=1)[:, None]))
    langs, scores = model.predict(x)
    assert langs == labels == [("de", "en", "fr")[i] for i in margin.argmax(axis=1)]
    assert np.allclose(scores, 1 / share.sum(axis=1), atol=1e-3)


def test_more_languages_than_the_sample_holds(spark):
    rows = [(f"wort{i} {'abc'[i % 3] * 9}", f"l{i % 9}") for i in range(90)]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    assert len(langid.fit(labelled).languages) == 9
    model = langid.fit(labelled, sample=5)
    assert len(model.languages) == 5 and model.marks.shape[1] <= 5
