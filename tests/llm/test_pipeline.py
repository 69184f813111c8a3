"""The corpus pipeline against a brute-force version of every stage, on the whole small table."""

from __future__ import annotations

import importlib.util
import re
import zlib
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from statlas.llm import langid, pii
from statlas.llm.queries import MIX

DATA = "/root/testdata/sf0.001"


def _module(name: str):
    spec = importlib.util.spec_from_file_location(name, Path(__file__).with_name(f"{name}.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


other, near, leak = _module("test_other_operators"), _module("test_near_duplicate_rows"), _module("test_decontam")


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def one_of_each(rows: list[tuple]) -> list[tuple]:
    """By comparing the 5-word shingles of all pairs."""
    kept = set(near.kept([(r[0], r[1]) for r in rows]))
    return [r for r in rows if r[0] in kept]


def predicted(model, texts: list[str]) -> list[tuple[str, float]]:
    """Language and score of each text, one by one, by the plain kernel of its n-grams with the model's landmarks."""
    out = []
    for t in texts:
        x = langid.presence(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        margin = (x @ model.marks / (max(float(x.sum()), 1) ** 0.5 * model.norms) @ model.weights + model.bias)[0]
        share = np.exp(langid.SHARPNESS * (margin - margin.max()))
        out.append((model.languages[int(margin.argmax())], float(1 / share.sum())))
    return out


def mod97(match: str) -> bool:
    bare = match.replace(" ", "")
    turned = bare[4:] + bare[:4]
    return 15 <= len(bare) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


ADDED = {
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", mod97, None),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda m: not re.search("^(?:000|666|9)|-00-|0000$", m), r"\bssn\b|social security"),
    "local_phone": (r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", lambda m: True, r"phone|tel\b|call|mobile|fax"),
}


def spans(text: str) -> list[tuple[int, int, int, str]]:
    found = other.base_spans(text)
    for kind, (pattern, good, context) in ADDED.items():
        last = 0
        for m in re.finditer(pattern, text):
            before = text[last : m.start()][-pii.CONTEXT :].lower()
            last = m.end()
            if good(m[0]) and (context is None or re.search(context, before)):
                found.append((m.start(), pii.KINDS.index(kind), m.end(), kind))
    return sorted(found)


def redacted(text: str) -> str:
    out, at = "", 0
    for start, _, end, kind in spans(text):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_pipeline(spark, tmp_path):
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    benchmark = spark.read.parquet(f"{DATA}/benchmark.parquet")
    columns = source.columns
    first = [tuple(r) for r in source.collect()]
    extra = [(900_001, None, "en", "src1", 0), (900_002, "12 34 !", "en", "src2", 7), (900_003, first[3][1], None, "src3", 1), (900_004, "Write to a.b@c-d.org or +1 (555) 123-4567, IBAN GB82 WEST 1234 5698 7654 32.", "en", None, 60), (900_005, f"x {benchmark.first().text} y", "en", "src4", 9), (900_006, "The and of it was with that " * 30, None, "src5", 1)]
    spark.createDataFrame(first + extra, source.schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    model = langid.fit(source.where(~langid.held_out(F.col("doc_id"))).unionByName(spark.createDataFrame([r for r in extra if zlib.crc32(str(r[0]).encode()) % 5], source.schema)))
    told = {r: x for r, x in zip(first + extra, predicted(model, [r[1] or "" for r in first + extra]), strict=True)}
    rows = [(r[0], r[1], r[2] or told[r][0], *r[3:]) for r in first + extra if has_letter(r[1]) and told[r][1] >= corpus_pipeline.MIN_SCORE]
    assert (900_006, "en") in {(r[0], r[2]) for r in rows}
    rows = one_of_each(rows)
    items = [leak.shingles(r.text, 5) for r in benchmark.collect()]
    rows = [r for r in rows if not any(len(i & leak.shingles(r[1], 5)) >= 0.8 * len(i) for i in items)]
    rows = [(r[0], redacted(r[1]), r[2], r[3]) for r in rows]
    wanted = {i: (n, dict((r[0], r[1]) for r in rows)[i]) for i, n in other.plain_mix(rows, MIX).items()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "mixing"]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns[: len(columns)] == columns
    got = {r.doc_id: (r.copies, r.text) for r in out.collect()}
    assert got == wanted
    assert all(r.n_chars == len(r.text) for r in out.collect())
