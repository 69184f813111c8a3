"""Account numbers with upper-case words or numbers around them."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlas.llm import pii

NUMBER, OTHER = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
TEXTS = {
    f"IBAN {NUMBER} BIC COBADEFFXXX": [NUMBER],
    "paid to DE89370400440532013000 2024-01-05": ["DE89370400440532013000"],
    f"{NUMBER} {OTHER} END": [NUMBER, OTHER],
    f"REF NR12 {NUMBER} OK": [NUMBER],
    f"{OTHER}.": [OTHER],
    "DE88 3704 0044 0532 0130 00 BIC": [],
    f"\u00e9\U0001f600 {NUMBER} and": [NUMBER],
}


def test_account_numbers_before_other_words(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for row in pii.with_spans(docs).select("text", "pii", pii.redacted(F.col("text"), F.col("pii")).alias("out")).collect():
        found = [s for s in row.pii if s.kind == "iban"]
        assert [s.text for s in found] == TEXTS[row.text]
        assert [row.text[s.start : s.end] for s in found] == TEXTS[row.text]
        assert not any(number in row.out for number in TEXTS[row.text])
