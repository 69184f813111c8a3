"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, validators (octet ranges, Luhn, mod-97, digit counts) confirm
them, and words in the CONTEXT characters before a span adjust its score; spans of at least
MIN_SCORE are kept. Positions come from splitting a text at the matches: the k-th span starts
after the first k pieces and k - 1 matches. The patterns use possessive quantifiers, which match
the same spans without backtracking or recursion, so long runs of one character stay linear. Folds over
many matches go by blocks as long as the root of their number, so appending to a result stays cheap.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40
MIN_SCORE = 0.6


@dataclass(frozen=True)
class Detector:
    """kind; pattern; a cheap test that a text may hold a match; score without and with context words.

    If run is set, pattern matches only the head of a span and its first group what may follow: the longest part of
    both together that ends at a space or at its end and is valid is the span.
    """

    kind: str
    pattern: str
    hint: str
    score: float
    with_context: float = 1.0
    context: str = ""
    run: bool = False


EMAIL, IP, CARD, PHONE, IBAN, SSN, LOCAL = "email", "ip", "card", "phone", "iban", "ssn", "local_phone"

DETECTORS = (
    Detector(EMAIL, r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, 1.0, r"e-?mail|contact|write"),
    Detector(IP, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.7, 0.9, r"\bip\b|address|host|server"),
    Detector(CARD, r"[0-9](?:[ -]?[0-9])++", "", 0.8, 1.0, r"card|credit|visa|tarjeta|karte|carte"),
    Detector(PHONE, r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.7, 1.0, r"phone|tel|call|mobile|fax"),
    Detector(IBAN, r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9]))", "", 0.9, 1.0, r"iban|account|konto|cuenta|compte", run=True),
    Detector(SSN, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.4, 0.9, r"\bssn\b|social security"),
    Detector(LOCAL, r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", "", 0.4, 0.8, r"phone|tel\b|call|mobile|fax"),
)

#: Kinds in the order that breaks ties of equal starts; the first four are the base.
KINDS = tuple(d.kind for d in DETECTORS)
BASE = KINDS[:4]

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    """The remainder of an account number by 97, its first four characters moved to the end, letters as 10 to 35."""
    bare = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substr(bare, F.lit(5)), F.substring(bare, 1, 4))
    step = lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)


def _valid(kind: str, match: Column) -> Column:
    if kind == IP:
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == CARD:
        digits = _digits(match)
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == PHONE:
        return F.length(_digits(match)).between(10, 15)
    if kind == IBAN:
        return F.length(F.regexp_replace(match, " ", "")).between(15, 34) & (_mod97(match) == 1)
    if kind == SSN:
        return ~match.rlike("^(?:000|666|9)|-00-|0000$")
    return F.lit(True)


def _longest(kind: str, run: Column) -> Column:
    """The longest valid part of a run that starts with it and ends at a space or at its end; null if none is valid."""
    words = F.split(run, " ")
    parts = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, 1, n), " "))
    return F.get(F.filter(parts, lambda part: _valid(kind, part)), F.lit(0))


_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double,text:string>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once however often use names it."""
    return F.transform(F.array(value), use)[0]


def _blocks(items: Column) -> Column:
    """items cut into blocks of about the root of their number, so that folds may append to a block's result.

    items must be bound: its elements are taken one by one, as a slice would read the whole array for every block.
    """
    size = F.greatest(F.ceil(F.sqrt(F.size(items)) / 3).cast("int"), F.lit(1))
    last = F.size(items) - 1
    starts = F.sequence(F.lit(0), F.greatest(last, F.lit(0)), size)
    return F.transform(starts, lambda at: F.transform(F.sequence(at, F.least(at + size - 1, last)), lambda i: F.get(items, i)))


def _before(blocks: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The state before each block: start, then what step makes of it over the elements of the blocks so far, with the last state at the end."""
    return F.aggregate(blocks, F.array(start), lambda acc, block: F.concat(acc, F.array(F.aggregate(block, F.element_at(acc, -1), step))))


def _proposed(text: Column, d: Detector) -> Column:
    """All matches of a detector's pattern with their positions in code points, validated and scored.

    A first fold over blocks of matches gives the state before each of them, a second one the spans of each block. Functions
    over arrays copy their results, so neither carries all spans along.
    """
    columns = [F.split(text, d.pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(d.pattern), F.lit(0)).alias("match")]
    if d.run:
        columns.append(F.regexp_extract_all(text, F.lit(d.pattern), F.lit(1)).alias("rest"))

    def item(x: Column) -> Column:
        before = F.lower(F.right(x["piece"], F.lit(CONTEXT)))
        score = F.when(x["match"].isNull(), 0.0).when(before.rlike(d.context), d.with_context).otherwise(d.score) if d.context else F.lit(d.score)
        good = _longest(d.kind, F.concat(x["match"], x["rest"])) if d.run else F.when(_valid(d.kind, x["match"]), x["match"])
        return F.struct(F.length(x["piece"]).alias("skip"), F.coalesce(F.length(x["match"]), F.lit(0)).alias("size"), good.alias("text"), score.alias("score"))

    def state(acc: Column, x: Column) -> Column:
        """The place after x, and the end of the last span kept."""
        begin = acc["at"] + x["skip"]
        keep = x["text"].isNotNull() & (x["score"] >= MIN_SCORE) & (begin >= acc["last"])
        return F.struct((begin + x["size"]).alias("at"), F.when(keep, begin + F.length(x["text"])).otherwise(acc["last"]).alias("last"))

    def step(acc: Column, x: Column) -> Column:
        begin, after = acc["at"] + x["skip"], state(acc, x)
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(d.kind)).alias("rank"), after["last"].alias("end"), F.lit(d.kind).alias("kind"), x["score"].alias("score"), x["text"].alias("text"))
        found = F.when(after["last"] > acc["last"], F.concat(acc["found"], F.array(span))).otherwise(acc["found"])
        return F.struct(after["at"].alias("at"), after["last"].alias("last"), found.alias("found"))

    none = F.array().cast(_SPAN)

    def spans(blocks: Column, states: Column) -> Column:
        def block(items: Column, i: Column) -> Column:
            start = F.struct(F.get(states, i)["at"].alias("at"), F.get(states, i)["last"].alias("last"), none.alias("found"))
            return F.aggregate(items, start, step, lambda acc: acc["found"])

        return F.flatten(F.transform(blocks, block))

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("last"))
    items = F.transform(F.arrays_zip(*columns), item)
    found = _bound(items, lambda items: _bound(_blocks(items), lambda blocks: _bound(_before(blocks, start, state), lambda states: spans(blocks, states))))
    hit = text.rlike(d.pattern) if not d.hint else F.contains(text, F.lit(d.hint)) & text.rlike(d.pattern)
    return F.when(hit, found.cast(_SPAN)).otherwise(none)


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with a column pii: all spans (start, rank, end, kind, score, text) by start, then kind; offsets in code points, end exclusive.

    A null or empty text has no spans. Other columns and repeated rows stay as they are; a column that is
    already named pii is replaced.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.withColumn("pii", F.array_sort(F.concat(*(_proposed(value, d) for d in DETECTORS))))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["rank"] < len(BASE))


def redacted(text: Column, spans: Column) -> Column:
    """text with each span put out by [KIND]; overlapping spans go as one, under the name of the first.

    A block of spans works on its own part of the text, so the time does not grow with the square of their number.
    """

    def block(spans: Column, at: Column, end: Column) -> Column:
        """The text from at to end, where the blocks before and after meet, with the spans put out."""

        def out(part: Column) -> Column:
            def step(acc: Column, s: Column) -> Column:
                kept = F.substr(part, acc["at"] - at + 1, s["start"] - acc["at"])
                fresh = F.when(s["start"] >= acc["at"], F.concat(acc["out"], kept, F.lit("["), F.upper(s["kind"]), F.lit("]")))
                return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.coalesce(fresh, acc["out"]).alias("out"))

            return F.aggregate(spans, F.struct(at.alias("at"), F.lit("").alias("out")), step, lambda acc: acc["out"])

        return _bound(F.substr(text, at + 1, end - at), out)

    def whole(blocks: Column, ends: Column) -> Column:
        each = F.transform(blocks, lambda b, i: block(b, F.get(ends, i), F.get(ends, i + 1)))
        return F.concat(F.array_join(each, ""), F.substr(text, F.element_at(ends, -1) + 1, F.length(text)))

    end = lambda at, s: F.greatest(at, s["end"])
    out = _bound(spans, lambda s: _bound(_blocks(s), lambda blocks: _bound(_before(blocks, F.lit(0), end), lambda ends: whole(blocks, ends))))
    return F.when(F.size(spans) > 0, out).otherwise(text)
