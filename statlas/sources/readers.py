"""File sources: delimited text in its variants, archives, workbooks, JSON pages, HTML tables, Stata.

Large text goes through Spark's readers with stated schemas. Formats that Spark cannot split (zip members,
workbooks, Stata) are decoded by tasks from binaryFile rows, a file each, so many files are read at once.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlas.functions import scalars as S
from statlas.session import let_workers_import

#: The signs that the Western code page has where Latin-1 has control characters: those, and what they stand for.
_OWN = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
WESTERN = ("".join(map(chr, _OWN)), bytes(_OWN).decode("cp1252"))


class SourceError(ValueError):
    """A source that lacks a required column, sheet or member."""


def schema_of(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def header_of(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> list[str]:
    """The column names of a delimited file, without a byte order mark."""
    first = spark.read.option("sep", sep).option("encoding", encoding).csv(path).limit(1).collect()
    return [str(x or "").lstrip("﻿").strip() for x in first[0]] if first else []


def csv_strings(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", comment: str | None = None) -> DataFrame:
    """All columns as text; nothing is guessed. The Western code page is read as Latin-1, its own 27 signs are put in after."""
    western = encoding == "windows-1252"
    encoding = "ISO-8859-1" if western else encoding
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("nullValue", None).option("multiLine", False)
    if comment:
        reader = reader.option("comment", comment)
    df = reader.csv(path)
    if western:
        df = df.select(*(F.translate(F.col(f"`{c}`"), *WESTERN).alias(c.translate(str.maketrans(*WESTERN))) for c in df.columns))
    return df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))


def csv_columns(spark: SparkSession, path: str, required: Mapping[str, str], optional: Mapping[str, str] | None = None, sep: str = ",", encoding: str = "UTF-8", rename: Mapping[str, str] | None = None, comment: str | None = None) -> DataFrame:
    """Typed columns of a file: required ones must be there, optional ones are null where they are not. Malformed numbers are null."""
    df = csv_strings(spark, path, sep, encoding, comment)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SourceError(f"{path} lacks {missing}")
    wanted = dict(required) | dict(optional or {})
    cells = []
    for c, kind in wanted.items():
        text = F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string")
        value = text if kind == "string" else S.to_double(text) if kind == "double" else S.to_double(text).cast(kind) if kind in ("int", "bigint") else text.try_cast(kind)
        cells.append(value.alias((rename or {}).get(c, c)))
    return df.select(*cells)


def first_present(columns: Sequence[str], variants: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """The actual name of each logical column among its variants, without regard to case."""
    actual = {c.strip().lower(): c for c in columns}
    return {logical: next(actual[v.strip().lower()] for v in names if v.strip().lower() in actual) for logical, names in variants.items() if any(v.strip().lower() in actual for v in names)}


def encoding_of(head: bytes) -> str:
    """UTF-8 with or without a mark, else the Western code page."""
    if head.startswith(b"\xef\xbb\xbf"):
        return "UTF-8"
    if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "UTF-16"
    try:
        head.decode("utf-8")
    except UnicodeDecodeError as error:
        return "windows-1252" if error.start < len(head) - 4 else "UTF-8"
    return "UTF-8"


def sniffed_encoding(spark: SparkSession, path: str, size: int = 1 << 16) -> str:
    rows = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, size).alias("head")).limit(1).collect()
    return encoding_of(bytes(rows[0]["head"])) if rows else "UTF-8"


def press_freedom(spark: SparkSession, path: str, variants: Mapping[str, Sequence[str]]) -> DataFrame:
    """One edition: semicolons, decimal commas, changing headers and encodings; rows without a code are dropped."""
    df = csv_strings(spark, path, ";", sniffed_encoding(spark, path))
    names = first_present(df.columns, variants)
    if "iso3" not in names:
        raise SourceError(f"{path} has no country code")
    col = lambda k: F.col(f"`{names[k]}`") if k in names else F.lit(None).cast("string")
    numbers = [k for k in variants if k not in ("iso3", "rank", "country")]
    out = df.select(S.iso3(col("iso3")).alias("iso3"), S.strict_int(col("rank")).alias("rank"), *(S.comma_decimal(col(k)).alias(k) for k in numbers))
    return out.where(F.col("iso3").isNotNull())


def wide_years(df: DataFrame, keys: Sequence[str], prefixes: Sequence[str], years: Sequence[int]) -> DataFrame:
    """prefix_year columns as rows; every prefix and year asked for must be there, empty cells are dropped."""
    wanted = [f"{p}_{y}" for p in prefixes for y in years]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise SourceError(f"columns are missing: {missing}")
    long = df.select(*keys, *wanted).unpivot(list(keys), wanted, "_name", "raw_value")
    parts = S.prefix_and_year(F.col("_name"))
    text = F.trim("raw_value")
    return long.where((text != "") & (F.lower(text) != "nan")).select(*keys, parts["prefix"].alias("variable_name"), parts["year"].alias("year"), "raw_value", S.to_double(F.col("raw_value")).alias("value"))


# Files that tasks decode


def decoded(spark: SparkSession, path: str, schema: str, decode: Callable[[str, bytes], Iterator[pd.DataFrame]]) -> DataFrame:
    """The frames that decode(path, content) makes of each file; a file is one row of binaryFile, read by one task."""
    let_workers_import(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                yield from decode(name, content)

    return files.mapInPandas(run, schema)


def zip_csv(spark: SparkSession, path: str, columns: Sequence[str], rows: int = 50_000) -> DataFrame:
    """Some columns, as text, of the one CSV member of each zip."""

    def decode(name: str, content: bytes) -> Iterator[pd.DataFrame]:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            members = [m for m in archive.namelist() if m.lower().endswith(".csv") and not m.startswith("__MACOSX")]
            if len(members) != 1:
                raise SourceError(f"{name} holds {len(members)} CSV members")
            with archive.open(members[0]) as member:
                for part in pd.read_csv(member, dtype=str, keep_default_na=False, usecols=list(columns), chunksize=rows):
                    yield part[list(columns)].replace({"": None})

    return decoded(spark, path, ", ".join(f"`{c}` string" for c in columns), decode)


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACK = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def column_number(reference: str) -> int:
    """A1 -> 0, AA7 -> 26."""
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_cells(content: bytes) -> Iterator[tuple[str, int, int, str]]:
    """(sheet, row, column, text) of the non-empty cells of a workbook; rows and columns count from 0."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in item.iter(f"{_MAIN}t")) for item in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels")).iter(f"{_PACK}Relationship")}
        for sheet in ET.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            target = targets[sheet.get(f"{_REL}id")].lstrip("/")
            with book.open(target if target.startswith("xl/") else f"xl/{target}") as part:
                row = -1
                for _, element in ET.iterparse(part):
                    if element.tag != f"{_MAIN}row":
                        continue
                    row = int(element.get("r", row + 2)) - 1
                    column = -1
                    for cell in element.iter(f"{_MAIN}c"):
                        column = column_number(cell.get("r")) if cell.get("r") else column + 1
                        value = cell.find(f"{_MAIN}v")
                        kind = cell.get("t")
                        if kind == "inlineStr":
                            text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                        elif value is None or value.text is None or kind == "e":
                            continue
                        else:
                            text = shared[int(value.text)] if kind == "s" else value.text
                        yield sheet.get("name"), row, column, text
                    element.clear()


def xlsx_cells(spark: SparkSession, path: str, sheets: Sequence[str] | None = None) -> DataFrame:
    """(path, sheet, row, column, text) for each cell; the sheets asked for must be there."""

    def decode(name: str, content: bytes) -> Iterator[pd.DataFrame]:
        frame = pd.DataFrame(sheet_cells(content), columns=["sheet", "row", "column", "text"])
        if sheets is not None:
            missing = set(sheets) - set(frame["sheet"])
            if missing:
                raise SourceError(f"{name} lacks sheets {sorted(missing)}")
            frame = frame[frame["sheet"].isin(list(sheets))]
        frame.insert(0, "path", name)
        yield frame

    return decoded(spark, path, "path string, sheet string, row int, column int, text string", decode)


def sheet_table(cells: DataFrame, columns: Sequence[str], header_row: int = 0) -> DataFrame:
    """Rows below a header row, by the trimmed names of the header; columns are matched per sheet, rows without any are dropped."""
    heads = cells.where(F.col("row") == header_row).select("path", "sheet", "column", F.trim("text").alias("_name"))
    body = cells.where(F.col("row") > header_row).join(F.broadcast(heads.where(F.col("_name").isin(list(columns)))), ["path", "sheet", "column"])
    picks = [F.max(F.when(F.col("_name") == c, F.col("text"))).alias(c) for c in columns]
    return body.groupBy("path", "sheet", "row").agg(*picks)


def year_columns(cells: DataFrame, key_column: int, header_row: int, skip: Sequence[str] = ()) -> DataFrame:
    """(sheet, key, year, text) of sheets whose header holds years; blank keys and skipped labels are dropped."""
    heads = cells.where(F.col("row") == header_row).select("path", "sheet", "column", S.year_number(F.regexp_replace("text", r"\.0$", "")).alias("year")).where("year is not null")
    keys = cells.where((F.col("column") == key_column) & (F.col("row") > header_row)).select("path", "sheet", "row", F.trim("text").alias("key"))
    keys = keys.where((F.col("key") != "") & ~F.col("key").isin(list(skip)))
    return cells.where(F.col("row") > header_row).join(F.broadcast(heads), ["path", "sheet", "column"]).join(keys, ["path", "sheet", "row"]).select("sheet", "key", "year", "text")


def rating_triplets(cells: DataFrame, edition_row: int = 0, first_row: int = 3, measures: Sequence[str] = ("PR", "CL", "Status")) -> DataFrame:
    """(sheet, key, edition_year, PR, CL, Status): an edition heads every third column from the second."""
    heads = cells.where((F.col("row") == edition_row) & (F.col("column") > 0)).select("path", "sheet", F.col("column").alias("_first"), S.edition_year(F.regexp_replace("text", r"\.0$", "")).alias("edition_year")).where("edition_year is not null")
    keys = cells.where((F.col("column") == 0) & (F.col("row") >= first_row)).select("path", "sheet", "row", F.trim("text").alias("key"))
    body = cells.where((F.col("row") >= first_row) & (F.col("column") > 0)).withColumn("_nth", (F.col("column") - 1) % len(measures)).withColumn("_first", F.col("column") - F.col("_nth"))
    joined = body.join(F.broadcast(heads), ["path", "sheet", "_first"]).join(keys, ["path", "sheet", "row"])
    return joined.groupBy("sheet", "key", "edition_year").agg(*(F.max(F.when(F.col("_nth") == i, F.col("text"))).alias(m) for i, m in enumerate(measures)))


def stata(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """Columns of Stata files, dates as ISO text where they are asked for as text."""

    def decode(name: str, content: bytes) -> Iterator[pd.DataFrame]:
        frame = pd.read_stata(io.BytesIO(content), convert_categoricals=False)
        missing = [c for c in columns if c not in frame.columns]
        if missing:
            raise SourceError(f"{name} lacks {missing}")
        frame = frame[list(columns)].copy()
        for c, kind in columns.items():
            if kind == "string":
                text = frame[c].dt.strftime("%Y-%m-%d") if pd.api.types.is_datetime64_any_dtype(frame[c]) else frame[c].astype("string")
                frame[c] = text.astype(object).where(frame[c].notna() & (text != ""), None)
        yield frame

    return decoded(spark, path, ", ".join(f"`{c}` {k}" for c, k in columns.items()), decode)


# JSON and HTML


def json_records(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Records of pages of the form [meta, [record, ...]]; a page that does not parse gives none. record: a DDL schema."""
    pages = spark.read.option("wholetext", True).text(path)
    body = F.get_json_object("value", "$[1]")
    return pages.select(F.explode(F.from_json(body, f"array<struct<{record}>>")).alias("r")).select("r.*")


def wdi(spark: SparkSession, path: str) -> DataFrame:
    """(iso3, year, variable, value) of development indicator pages; rows without a code or year are dropped."""
    rows = json_records(spark, path, "indicator struct<id:string,value:string>, country struct<id:string,value:string>, countryiso3code string, date string, value double, unit string, obs_status string, `decimal` int")
    out = rows.select(S.iso3(F.col("countryiso3code")).alias("iso3"), S.year_number(F.col("date")).alias("year"), F.col("indicator.id").alias("variable"), S.finite(F.col("value")).alias("value"), F.col("country.value").alias("country_name"))
    return out.where("iso3 is not null and year is not null")


def odata_values(spark: SparkSession, path: str, year: int) -> DataFrame:
    """(iso3, year, indicator, value) of OData pages: country rows with a three-letter code, at the year asked for."""
    pages = spark.read.option("wholetext", True).text(path)
    item = "IndicatorCode string, SpatialDimType string, SpatialDim string, TimeDim int, Dim1 string, Value string, NumericValue double"
    rows = pages.select(F.explode(F.from_json(F.get_json_object("value", "$.value"), f"array<struct<{item}>>")).alias("r")).select("r.*")
    kept = rows.where((F.col("SpatialDimType") == "COUNTRY") & (F.length("SpatialDim") == 3))
    return kept.select(F.col("SpatialDim").alias("iso3"), F.lit(year).alias("year"), F.col("IndicatorCode").alias("indicator"), S.finite(F.col("NumericValue")).alias("value"))


def sparql_bindings(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Bindings as columns of text (entity addresses cut to their ids) with the year of start and the raw binding."""
    pages = spark.read.option("wholetext", True).text(path)
    bindings = F.from_json(F.get_json_object("value", "$.results.bindings"), "array<map<string,struct<type:string,value:string>>>")
    rows = pages.select(F.explode(bindings).alias("b"))
    cell = lambda n: F.when(F.col("b")[n]["type"] == "uri", S.uri_tail(F.col("b")[n]["value"])).otherwise(F.col("b")[n]["value"])
    out = rows.select(*(cell(n).alias(n) for n in names), F.to_json("b").alias("raw_json"))
    return out.withColumn("start_year", S.year_number(F.substring("start", 1, 4))) if "start" in names else out


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, title, extract) of extract responses; ids up to 0 are null, pages without a title are dropped."""
    pages = spark.read.option("wholetext", True).text(path)
    found = F.from_json(F.get_json_object("value", "$.query.pages"), "map<string,struct<pageid:bigint,ns:int,title:string,extract:string>>")
    rows = pages.select(F.explode(F.map_values(found)).alias("p"))
    return rows.where("p.title is not null and p.title <> ''").select(F.when(F.col("p.pageid") > 0, F.col("p.pageid")).alias("page_id"), "p.title", F.col("p.extract").alias("extract"))


def wiki_search(spark: SparkSession, path: str) -> DataFrame:
    pages = spark.read.option("wholetext", True).text(path)
    found = F.from_json(F.get_json_object("value", "$.query.search"), "array<struct<title:string,pageid:bigint,size:bigint,wordcount:bigint,snippet:string>>")
    return pages.select(F.posexplode(found).alias("position", "s")).select("position", "s.title", F.col("s.pageid").alias("page_id"), "s.size", "s.wordcount", S.strip_tags(F.col("s.snippet")).alias("snippet"))


def html_cells(html: Column, table_id: str = "table1", least: int = 6) -> Column:
    """Rows of the largest table with an id: the first cells' inner HTML of each row that has enough."""
    tables = F.regexp_extract_all(html, F.lit(rf"(?is)<table\b[^>]*\bid\s*=\s*[\"']?{table_id}\b.*?</table>"), F.lit(0))
    largest = F.element_at(F.array_sort(tables, lambda a, b: F.length(b) - F.length(a)), 1)
    rows = F.regexp_extract_all(F.when(F.size(tables) > 0, largest).otherwise(""), F.lit(r"(?is)<tr\b.*?</tr>"), F.lit(0))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: F.trim(c)))
    return F.transform(F.filter(cells, lambda c: F.size(c) >= least), lambda c: F.slice(c, 1, least))


def warheads(spark: SparkSession, path: str, countries: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A row per listed country with its counts, from the table of a saved page."""
    pages = spark.read.option("wholetext", True).text(path)
    rows = pages.select(F.explode(html_cells(F.col("value"), least=len(columns) + 1)).alias("c"))
    name = S.strip_tags(F.element_at("c", 1))
    return rows.select(name.alias("country"), *(S.count_cell(F.element_at("c", i + 2)).alias(c) for i, c in enumerate(columns))).where(F.col("country").isin(list(countries)))


def catalog(spark: SparkSession, path: str, required: Sequence[str] = ("variable_name", "raw_column")) -> DataFrame:
    """An indicator catalog: comment lines go, rows without a variable name too."""
    df = csv_strings(spark, path, comment="#")
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SourceError(f"{path} lacks {missing}")
    return df.where(F.trim("variable_name") != "")


def fact_csv(spark: SparkSession, path: str) -> DataFrame:
    """A metric fact: year_date parsed, or the first of January of its year."""
    kinds = {"metric_id": "string", "year": "int", "country_iso3": "string", "value": "double"}
    text = ("country_name", "political_regime", "political_regime_bucket", "existence_status", "metric_unit", "metric_source", "metric_method", "year_date")
    df = csv_columns(spark, path, kinds, {c: "string" for c in text})
    return df.withColumn("year_date", F.coalesce(F.col("year_date").try_cast("date"), F.make_date("year", F.lit(1), F.lit(1))))


def parquet_or_empty(spark: SparkSession, path: str, schema: str, scope: Sequence[str] = (), key: str = "iso3") -> DataFrame:
    """A parquet table cut to a scope; an empty typed table if there is none at path."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(path)
    return df.where(F.col(key).isin(list(scope))) if scope else df
