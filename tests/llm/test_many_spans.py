"""Texts with very many spans: results hold and time stays in proportion."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from statlas.llm import pii


def test_forty_thousand_spans_in_one_text(spark):
    one = "10.20.30.40 a.b@c-d.org, "
    docs = spark.createDataFrame([(1, one * 20_000)], "doc_id long, text string")
    found = pii.with_spans(docs)
    found.select(F.hash(pii.joined(F.col("pii")))).first()
    began = time.perf_counter()
    row = found.select(pii.joined(F.col("pii")).alias("spans")).first()
    took = time.perf_counter() - began
    assert row.spans == ",".join(f"ip:{25 * i}:{25 * i + 11},email:{25 * i + 12}:{25 * i + 23}" for i in range(20_000))
    assert took < 20  # a few seconds; with folds that copy all spans at every step it took a minute
    out = found.select(pii.redacted(F.col("text"), F.col("pii")).alias("out")).first().out
    assert out == "[IP] [EMAIL], " * 20_000


def test_overlapping_spans_are_put_out_as_one(spark):
    text = "x " + "+378282246310005, 10.0.0.1; " * 300
    row = pii.with_spans(spark.createDataFrame([(text,)], "text string")).select("pii", pii.redacted(F.col("text"), F.col("pii")).alias("out")).first()
    out, at = "", 0
    for s in row.pii:
        if s.start >= at:
            out += text[at : s.start] + f"[{s.kind.upper()}]"
        at = max(at, s.end)
    assert len(row.pii) > 300 and row.out == out + text[at:]


def test_no_rows_and_other_columns(spark):
    docs = spark.createDataFrame([(1, None, "a", 2), (1, None, "a", 2), (2, "a@b.co", "c", 3)], "doc_id long, text string, match string, piece int")
    got = pii.with_spans(docs)
    assert sorted((r.doc_id, len(r.pii), r.match, r.piece) for r in got.collect()) == [(1, 0, "a", 2), (1, 0, "a", 2), (2, 1, "c", 3)]
    assert pii.with_spans(docs.where("false")).count() == 0
