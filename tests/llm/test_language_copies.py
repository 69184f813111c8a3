"""The training sample is of different texts, however often each is copied."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlas.llm import langid


def test_copies_do_not_change_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "Model", lambda x, labels: seen.append((x.tolist(), labels)))
    texts = [(f"{word} text number {n} of {lang}", lang) for lang, word in (("x", "alpha"), ("y", "omega")) for n in range(3)]
    once = spark.createDataFrame(texts, "text string, lang string")
    copied = once.crossJoin(spark.range(400)).drop("id").where(F.col("lang") == "x").union(once.where("lang = 'y'"))
    for docs in (once, copied):
        langid.fit(docs, per_language=4)
    assert seen[0] == seen[1]
    assert seen[0][1] == ["x"] * 3 + ["y"] * 3
