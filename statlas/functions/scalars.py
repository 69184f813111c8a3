"""Scalar column functions: coercion, normalisation, codes and labels. Missing is NULL; NaN never gets in."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinel texts that mean missing, by source family.
VDEM_MISSING = ("NA", "NaN", "nan", "-999", "")
CPI_MISSING = ("NA", "NaN", "nan", "null", "None", "")
DASHES = ("-", "—", "n/a")


def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility form without marks is one letter or digit (or an apostrophe), and those where it is several characters."""
    one, several = {}, {}
    for n in (*range(0x80, 0xD800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(n)) if not unicodedata.combining(c)).lower()
        kept = re.sub("[^a-z0-9']", " ", plain)
        if len(kept) == 1 and kept != " ":
            one[chr(n)] = kept
        elif kept.strip():
            several[chr(n)] = kept
    return one, several


FOLDED, SPELLED = _folds()


def _near(characters: Sequence[str], gap: int = 256) -> str:
    """A pattern of a few ranges that hold all of characters, and others between them."""
    codes = sorted(map(ord, characters))
    starts = [codes[0], *(b for a, b in zip(codes[:-1], codes[1:], strict=True) if b - a > gap)]
    ends = [*(a for a, b in zip(codes[:-1], codes[1:], strict=True) if b - a > gap), codes[-1]]
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True)) + "]"


#: Texts without such a character need no look at each letter. Lower-case Latin letters of few ranges are not in it.
MAYBE_SPELLED = _near([c for c in SPELLED if ord(c) >= 0x250]) + "|" + _near([c for c in SPELLED if ord(c) < 0x250], 1)


def finite(x: Column) -> Column:
    """x where it is a finite number, else null."""
    d = x.cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), d)


def is_finite(x: Column) -> Column:
    return F.coalesce(finite(x).isNotNull(), F.lit(False))


def to_double(x: Column, missing: Sequence[str] = ()) -> Column:
    """Trimmed text as a finite double; empty, sentinel or malformed text is null."""
    text = F.trim(x.cast("string"))
    return finite(F.when((text != "") & ~text.isin(*missing) if missing else text != "", text).try_cast("double"))


def vdem_double(x: Column) -> Column:
    """A number above -999; sentinels are null."""
    d = to_double(x, VDEM_MISSING)
    return F.when(d > -999, d)


def prefer_numeric(normalized: Column, raw: Column) -> Column:
    return F.coalesce(finite(normalized), to_double(raw))


def comma_decimal(x: Column) -> Column:
    """Text with a decimal comma or point as a double."""
    return to_double(F.regexp_replace(x, ",", "."))


def strict_int(x: Column) -> Column:
    text = F.trim(x.cast("string"))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))


def lenient_int(x: Column) -> Column:
    """Client cells: negative numbers, dashes and text are null; fractions are cut off."""
    d = to_double(x, DASHES)
    return F.when(d >= 0, F.floor(d)).cast("bigint")


def count_cell(x: Column) -> Column:
    """A count in an HTML cell: tags and footnote marks go; <n is n; a range is its middle, rounded down; commas go."""
    text = F.trim(F.regexp_replace(F.regexp_replace(x, r"(?is)<sup\b[^>]*>.*?</sup>", ""), r"(?s)<[^>]*>", ""))
    text = F.trim(F.regexp_replace(F.regexp_replace(text, r"&lt;|[<~]", ""), ",", ""))
    span = r"^(\d+)\s*[–—-]\s*(\d+)"
    low, high = F.regexp_extract(text, span, 1).try_cast("bigint"), F.regexp_extract(text, span, 2).try_cast("bigint")
    one = F.regexp_extract(text, r"^(\d+)\s*[A-Za-z*]*$", 1).try_cast("bigint")
    return F.when(text.isin("n.a.", "?", ""), None).when(low.isNotNull(), F.floor((low + high) / 2)).otherwise(one)


def footnoted_int(x: Column) -> Column:
    """A dash is zero, two dots are missing; a leading c. and trailing footnote letters go."""
    text = F.trim(x)
    digits = F.regexp_extract(F.regexp_replace(text, r"[, ]", ""), r"^(?:c\.)?(\d+)[a-z]*$", 1)
    return F.when(text.isin("–", "-"), F.lit(0).cast("bigint")).when(text.isin("..", ""), None).otherwise(digits.try_cast("bigint"))


def rating_by_status(value: Column, status: Column) -> Column:
    """A rating from 1 to 5 that counts only with status 0."""
    v = value.try_cast("int")
    return F.when((status == 0) & v.between(1, 5), v)


def rounded_int(x: Column) -> Column:
    """Half to even."""
    return F.bround(finite(x), 0).cast("bigint")


def rounded(x: Column, digits: int) -> Column:
    """x as a double, rounded as SQL engines round doubles: scaled, to the nearest integer (a half away from zero), scaled back.

    F.round() rounds the shortest decimal that reads as x, so it goes up where x is a little less than the tie it prints as.
    """
    return F.round(x * 10.0**digits) / 10.0**digits


def iso3(x: Column) -> Column:
    """Three ASCII letters, trimmed and upper; else null."""
    code = F.upper(F.trim(x))
    return F.when(code.rlike("^[A-Z]{3}$"), code)


def plain_name(x: Column, keep_apostrophe: bool = True) -> Column:
    """Lower case without accents, by compatibility forms; other signs than letters, digits (and apostrophes) are blanks, and one at a time stays."""
    spelled = F.create_map(*(F.lit(c) for pair in SPELLED.items() for c in pair))
    letters = F.transform(F.split(x, ""), lambda c: F.coalesce(F.element_at(spelled, c), c))
    whole = F.when(x.rlike(MAYBE_SPELLED), F.array_join(letters, "")).otherwise(x)
    folded = F.translate(whole, "".join(FOLDED), "".join(FOLDED.values()))
    bare = F.lower(F.regexp_replace(folded, r"\p{M}", ""))
    return F.trim(F.regexp_replace(bare, "[^a-z0-9']+" if keep_apostrophe else "[^a-z0-9]+", " "))


def mapped(x: Column, table: Mapping, default=None) -> Column:
    """x looked up in a small table."""
    out = F.lit(default)
    pairs = [v for k, value in table.items() for v in (F.lit(k), F.lit(value))]
    return F.coalesce(F.element_at(F.create_map(*pairs), x), out) if pairs else out


def year_number(x: Column) -> Column:
    """The leading four digits as a year from 1900 to 2100; else null."""
    y = F.regexp_extract(F.trim(x.cast("string")), r"^(\d{4})", 1).try_cast("int")
    return F.when(y.between(1900, 2100), y)


def edition_year(x: Column) -> Column:
    return F.regexp_extract(x.cast("string"), r"((?:19|20)\d{2})\s*$", 1).try_cast("int")


def decimal_year(x: Column) -> Column:
    """Year plus day of year over 365, leap years too."""
    d = x.try_cast("date")
    return F.year(d) + (F.dayofyear(d) - 1) / F.lit(365.0)


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def prefix_and_year(name: Column) -> Column:
    """name_2020 as a struct of prefix and year; null for other names."""
    pattern = r"^([a-z][a-z0-9]*)_(\d{4})$"
    hit = name.rlike(pattern)
    return F.when(hit, F.struct(F.regexp_extract(name, pattern, 1).alias("prefix"), F.regexp_extract(name, pattern, 2).cast("int").alias("year")))


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def scaled(x: Column, low: float, high: float) -> Column:
    return clamp((x - low) / F.lit(float(high - low)))


def zero_to_ten(x: Column) -> Column:
    return F.bround(clamp(x) * 10, 0).cast("int")


def one_to_ten(x: Column) -> Column:
    return F.floor(1 + 9 * clamp(x) + 0.5).cast("int")


def freedom_rating(x: Column) -> Column:
    return F.bround((7 - x) / F.lit(6.0), 6)


# Weights of the four confidence components, lower bounds of the bands.
CONFIDENCE = {"agreement": 0.35, "authority": 0.25, "specificity": 0.25, "temporal_fit": 0.15}
BANDS = ((85, "very_high"), (70, "high"), (50, "medium"), (30, "low"))


def confidence(agreement: Column, authority: Column, specificity: Column, temporal_fit: Column) -> Column:
    parts = zip(CONFIDENCE.values(), (agreement, authority, specificity, temporal_fit), strict=True)
    total = sum((F.lit(w) * c for w, c in parts), F.lit(0.0))
    return clamp(F.bround(F.round(total, 9), 0), 0, 100).cast("int")


def band(score: Column) -> Column:
    out = F.lit("very_low")
    for low, name in reversed(BANDS):
        out = F.when(score >= low, name).otherwise(out)
    return out


def match_status(ours: Column, theirs: Column) -> Column:
    """match within 1, high_delta beyond 2, conflict between; missing where either is."""
    delta = F.abs(ours - theirs)
    return F.when(delta.isNull(), "missing").when(delta <= 1, "match").when(delta > 2, "high_delta").otherwise("conflict")


def needs_review(ours: Column, theirs: Column, score: Column, proxy: Column) -> Column:
    far = F.coalesce(F.abs(ours - theirs) > 2, F.lit(False))
    return ours.isNull() | far | F.coalesce(score < 60, F.lit(True)) | F.coalesce(proxy, F.lit(False))


def cagr_pct(start: Column, end: Column, years: Column) -> Column:
    """Compound growth in per cent; null unless start and years are positive."""
    good = (start > 0) & (years > 0)
    return finite(F.when(good, (F.pow(end / start, 1 / years) - 1) * 100))


def pct_growth(value: Column, before: Column) -> Column:
    return F.when(before != 0, value / before - 1)


def flags(*named: tuple[Column, str]) -> Column:
    """Names of the conditions that hold, in order, once each, joined by |."""
    found = F.array(*(F.when(c, F.lit(name)) for c, name in named))
    return F.array_join(F.array_distinct(F.array_compact(found)), "|")


def short_hash(x: Column, n: int = 10) -> Column:
    return F.substring(F.sha2(x.cast("string"), 256), 1, n)


def strip_tags(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"(?s)<[^>]*>", ""), r"\s+", " "))


def uri_tail(x: Column) -> Column:
    return F.regexp_extract(x, r"([^/]*)$", 1)


def reference(*parts: Column) -> Column:
    """prefix:country:year:column, with what is not a letter, digit, dot or dash as _."""
    return F.concat_ws(":", *(F.regexp_replace(F.trim(p.cast("string")), r"[^A-Za-z0-9.\-]+", "_") for p in parts))
