"""The named sources: how each is read, and how its rows become observations.

An adapter is a reader of the raw table and a transform into the long form. What sets a source
apart is stated by its entry: which column names the country, whether missing cells are kept,
how far a request year may be moved, what a value must pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlas.functions import scalars as S
from statlas.operators import joins, reshape
from statlas.sources import readers
from statlas.sources.registry import Registry, Source

Read = Callable[[SparkSession, str], DataFrame]

# Sentinels and labels by source.
WDI_AGGREGATE_NAMES = ("World", "Arab World", "European Union", "OECD members")
PTS_MEASURES = ("A", "H", "S")


@dataclass(frozen=True)
class Shape:
    """What a wide country-year table looks like."""

    country: str
    variables: tuple[str, ...]
    country_is_name: bool = False
    keep_missing: bool = False
    unit: str | None = None
    scale: str | None = None
    proxy_from: int | None = None
    proxy_to: int | None = None


def requested_years(years: Sequence[int], shape: Shape) -> list[int]:
    """Years to read for a request: one that the source does not reach is taken from the year before it."""
    return sorted({shape.proxy_to if y == shape.proxy_from and shape.proxy_to is not None else y for y in years})


def observations_of(df: DataFrame, shape: Shape) -> DataFrame:
    """A row per variable; names go to country_name, codes to country_code (upper). A moved year says so in extension."""
    present = [v for v in shape.variables if v in df.columns]
    long = df.select(shape.country, "year", *(F.col(v).cast("double").alias(v) for v in present)).unpivot([shape.country, "year"], present, "indicator_code", "_raw")
    value = S.finite(F.col("_raw"))
    code = F.lit(None).cast("string") if shape.country_is_name else F.upper(F.trim(F.col(shape.country).cast("string")))
    name = F.trim(F.col(shape.country).cast("string")) if shape.country_is_name else F.lit(None).cast("string")
    out = long.select(
        code.alias("country_code"),
        name.alias("country_name"),
        F.col("year").cast("int").alias("year"),
        "indicator_code",
        value.alias("value"),
        F.when(value.isNull(), "missing").otherwise("numeric").alias("value_type"),
        F.lit(shape.unit).cast("string").alias("unit"),
        F.lit(shape.scale).cast("string").alias("scale"),
    )
    if shape.proxy_to is not None:
        out = out.withColumn("extension", F.when(F.col("year") == shape.proxy_to, F.create_map(F.lit("proxy_year_for"), F.lit(str(shape.proxy_from)))))
    return out if shape.keep_missing else out.where("value is not null")


def _csv(columns: dict[str, str], optional: dict[str, str] | None = None, rename: dict[str, str] | None = None, **more: str) -> Read:
    return lambda spark, path: readers.csv_columns(spark, path, columns, optional, rename=rename, **more)


def _sheet(columns: Sequence[str], sheet: str | None = None, header_row: int = 0, rename: dict[str, str] | None = None) -> Read:
    def read(spark: SparkSession, path: str) -> DataFrame:
        cells = readers.xlsx_cells(spark, path, [sheet] if sheet else None)
        return readers.sheet_table(cells, list(columns), header_row).withColumnsRenamed(rename or {})

    return read


def _text_numbers(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(c) if c in keys else S.to_double(F.col(c)).alias(c) for c in df.columns))


def with_raw_text(df: DataFrame, country: str, variables: Sequence[str], number: Callable[[Column], Column], year: str = "year") -> DataFrame:
    """A row per country, year and variable: value, and raw_value with the original text of the cell; empty cells are dropped."""
    long = df.unpivot([country, year], list(variables), "indicator_code", "raw_value").where("raw_value is not null")
    return long.select(F.col(country).alias("country_code"), S.to_double(F.col(year)).cast("int").alias("year"), "indicator_code", number(F.col("raw_value")).alias("value"), "raw_value")


# V-Dem: sentinels are null, and a row is emitted for missing cells too


def vdem(variables: Sequence[str]) -> Source:
    read = _csv({"country_text_id": "string", "year": "int"}, dict.fromkeys(variables, "string"))
    clean = lambda df: df.select("country_text_id", "year", *(S.vdem_double(F.col(v)).alias(v) for v in variables))
    return Source("vdem", read, lambda df: observations_of(clean(df), Shape("country_text_id", tuple(variables), keep_missing=True)), family="governance")


def ucdp() -> Source:
    """Events by country and year over the full grid; fatalities of kinds 1 (state-based, and those with a second government) and 3 (one-sided)."""

    def transform(df: DataFrame) -> DataFrame:
        number = {c: S.to_double(F.col(c)) for c in ("country_id", "year", "type_of_violence", "best", "gwnob")}
        events = df.select(*(v.alias(c) for c, v in number.items()))
        wide = aggregate_conflict_events(events)
        return observations_of(wide, Shape("country_id", tuple(c for c in wide.columns if c.startswith("ucdp_"))))

    return Source("ucdp", lambda spark, path: readers.zip_csv(spark, path, ["id", "year", "country_id", "type_of_violence", "best", "gwnob"]), transform, family="conflict")


def aggregate_conflict_events(events: DataFrame) -> DataFrame:
    """One conditional aggregate and a grid of all countries and years; null fatalities add nothing, kind 2 is not counted."""
    kind = F.col("type_of_violence")
    state, intl, one_sided = kind == 1, (kind == 1) & F.col("gwnob").isNotNull(), kind == 3
    cells = []
    for name, own in (("state_based", state), ("intl", intl), ("onesided", one_sided)):
        cells += [F.count_if(own).alias(f"ucdp_{name}_events"), F.coalesce(F.sum(F.when(own, F.col("best"))), F.lit(0.0)).alias(f"ucdp_{name}_fatalities")]
    agg = events.groupBy("country_id", "year").agg(*cells)
    names = [c for c in agg.columns if c.startswith("ucdp_")]
    grid = agg.select("country_id").distinct().crossJoin(F.broadcast(agg.select("year").distinct()))
    return joins.filled_grid(grid, agg, ["country_id", "year"], dict.fromkeys(names, 0))


def wgi(indicators: dict[str, str]) -> Source:
    """Sheets by indicator with years as columns: scores are z-scores."""

    def read(spark: SparkSession, path: str) -> DataFrame:
        return readers.year_columns(readers.xlsx_cells(spark, path, list(indicators)), 1, 0)

    def transform(df: DataFrame) -> DataFrame:
        value = S.to_double(F.regexp_replace("text", "^#N/A$", ""))
        return df.select(F.upper("key").alias("country_code"), "year", S.mapped(F.col("sheet"), indicators).alias("indicator_code"), value.alias("value"), F.lit("z_score").alias("unit"), F.lit("z_score").alias("scale")).where("value is not null")

    return Source("world_bank_wgi", read, transform, family="governance")


def sipri_milex(indicators: dict[str, str], regions: Sequence[str], header_row: int = 5) -> Source:
    """Sheets by indicator; region labels are no countries, dots and letters are missing."""

    def read(spark: SparkSession, path: str) -> DataFrame:
        return readers.year_columns(readers.xlsx_cells(spark, path, list(indicators)), 0, header_row, regions)

    def transform(df: DataFrame) -> DataFrame:
        return df.select(F.col("key").alias("country_name"), "year", S.mapped(F.col("sheet"), indicators).alias("indicator_code"), S.to_double(F.col("text")).alias("value")).where("value is not null")

    return Source("sipri_milex", read, transform, family="military")


def bti(variables: Sequence[str], editions: Sequence[tuple[str, int, int]], year: int) -> Source:
    """The sheet of the edition that covers a year; a country's name is at most 60 characters."""

    def read(spark: SparkSession, path: str) -> DataFrame:
        sheet = edition_sheet(editions, year)
        return _sheet(["Country", *variables], sheet)(spark, path).withColumn("year", F.lit(year))

    def transform(df: DataFrame) -> DataFrame:
        named = df.where((F.trim("Country") != "") & (F.length("Country") <= 60))
        return observations_of(_text_numbers(named.select("Country", "year", *variables), ["Country", "year"]), Shape("Country", tuple(variables), country_is_name=True))

    return Source("bti", read, transform, family="governance")


def edition_sheet(editions: Sequence[tuple[str, int, int]], year: int) -> str:
    """The sheet whose first..last years hold the year."""
    for sheet, first, last in editions:
        if first <= year <= last:
            return sheet
    raise readers.SourceError(f"no edition covers {year}")


def pts(sheet: str = "PTS-2025") -> Source:
    """Ratings that count only with status 0; the country key is a code in upper case."""
    columns = ["COW_Code_A", "Year", *(f"PTS_{m}" for m in PTS_MEASURES), *(f"NA_Status_{m}" for m in PTS_MEASURES)]
    names = {"A": "pts_amnesty_score", "H": "pts_human_rights_watch_score", "S": "pts_state_dept_score"}

    def transform(df: DataFrame) -> DataFrame:
        cells = [S.rating_by_status(S.to_double(F.col(f"PTS_{m}")), S.to_double(F.col(f"NA_Status_{m}"))).alias(names[m]) for m in PTS_MEASURES]
        wide = df.select(F.upper("COW_Code_A").alias("code"), S.to_double(F.col("Year")).cast("int").alias("year"), *cells)
        return observations_of(wide, Shape("code", tuple(names.values())))

    return Source("pts", _sheet(columns, sheet), transform, family="repression")


def cirights(variables: Sequence[str]) -> Source:
    def transform(df: DataFrame) -> DataFrame:
        wide = df.select("country", S.to_double(F.col("year")).cast("int").alias("year"), *(S.rounded_int(S.to_double(F.col(v))).alias(v) for v in variables))
        return observations_of(wide, Shape("country", tuple(variables), country_is_name=True, proxy_from=2023, proxy_to=2022))

    return Source("cirights", _sheet(["country", "year", *variables]), transform, family="repression")


def maddison() -> Source:
    """Head income and population, and their product where both are there (population is in thousands)."""

    def transform(df: DataFrame) -> DataFrame:
        wide = _text_numbers(df.select("countrycode", "year", "gdppc", "pop"), ["countrycode"])
        wide = wide.withColumns({"year": F.col("year").cast("int"), "gdp_total": F.col("gdppc") * F.col("pop") * 1000})
        return observations_of(wide, Shape("countrycode", ("gdppc", "pop", "gdp_total"), proxy_from=2023, proxy_to=2022))

    return Source("maddison_project", _sheet(["countrycode", "country", "region", "year", "gdppc", "pop"], "Full data"), transform, family="economy")


def pwt(variables: Sequence[str]) -> Source:
    """Numbers that are none stay null and numeric; a country and year occurs once."""

    def transform(df: DataFrame) -> DataFrame:
        wide = _text_numbers(df.select("countrycode", "year", *variables), ["countrycode"]).withColumn("year", F.col("year").cast("int"))
        out = observations_of(reshape.assert_unique(wide, ["countrycode", "year"]), Shape("countrycode", tuple(variables), keep_missing=True))
        return out.withColumn("value_type", F.lit("numeric"))

    return Source("pwt", _sheet(["countrycode", "country", "year", *variables], "Data"), transform, family="economy")


def freedom_house(sheets: Sequence[str]) -> Source:
    """Ratings from 1 to 7, else dropped; the normalised form (7 - x) / 6 is kept beside; status is categorical."""

    def transform(df: DataFrame) -> DataFrame:
        cell = F.explode(F.array(F.struct(F.lit("political_rights").alias("k"), F.col("PR").alias("v")), F.struct(F.lit("civil_liberties").alias("k"), F.col("CL").alias("v")), F.struct(F.lit("status").alias("k"), F.col("Status").alias("v"))))
        long = df.select("key", "edition_year", cell.alias("c"))
        rating = S.to_double(F.col("c.v"), ("-",))
        good = (F.col("c.k") != "status") & rating.between(1, 7)
        status = (F.col("c.k") == "status") & F.col("c.v").isin("F", "PF", "NF")
        return long.where(good | status).select(
            F.col("key").alias("country_name"),
            F.col("edition_year").alias("year"),
            F.concat(F.lit("fiw_"), F.col("c.k")).alias("indicator_code"),
            F.when(good, rating).alias("value"),
            F.when(status, F.col("c.v")).alias("value_text"),
            F.when(good, "numeric").otherwise("categorical").alias("value_type"),
            F.when(good, F.create_map(F.lit("normalized"), S.freedom_rating(rating).cast("string"))).alias("extension"),
        )

    return Source("freedom_house", lambda spark, path: readers.rating_triplets(readers.xlsx_cells(spark, path, list(sheets))), transform, family="freedom")


def transparency_cpi() -> Source:
    def transform(df: DataFrame) -> DataFrame:
        code = S.iso3(F.col("iso3"))
        return observations_of(df.select(code.alias("iso3"), "year", F.floor("score").alias("cpi_score")).where("iso3 is not null"), Shape("iso3", ("cpi_score",)))

    return Source("transparency_cpi", _csv({"country": "string", "iso3": "string", "year": "int", "score": "double"}, {"rank": "double", "sources": "double"}), transform, family="corruption")


def undp_hdi(prefixes: Sequence[str], years: Sequence[int]) -> Source:
    shape = Shape("iso3", (), proxy_from=2023, proxy_to=2022)

    def read(spark: SparkSession, path: str) -> DataFrame:
        return readers.wide_years(readers.csv_strings(spark, path, encoding="ISO-8859-1"), ["iso3", "country"], prefixes, requested_years(years, shape))

    def transform(df: DataFrame) -> DataFrame:
        extension = F.when(F.col("year") == shape.proxy_to, F.create_map(F.lit("proxy_year_for"), F.lit(str(shape.proxy_from))))
        return df.select(F.upper("iso3").alias("country_code"), F.col("country").alias("country_name"), "year", F.concat(F.lit("undp_hdi_"), F.col("variable_name")).alias("indicator_code"), "value", extension.alias("extension"))

    return Source("undp_hdi", read, transform, family="development")


def rsf(variants: dict[str, Sequence[str]], year: int) -> Source:
    def transform(df: DataFrame) -> DataFrame:
        numbers = tuple(c for c in df.columns if c != "iso3")
        return observations_of(df.withColumn("year", F.lit(year)), Shape("iso3", numbers))

    return Source("rsf_press_freedom", lambda spark, path: readers.press_freedom(spark, path, variants), transform, family="freedom")


def who(year: int) -> Source:
    """The first row of an indicator, country and year wins."""

    def transform(df: DataFrame) -> DataFrame:
        first = reshape.first_wins(df.withColumn("_n", F.monotonically_increasing_id()), ["iso3", "year", "indicator"], F.col("_n"))
        return first.where("value is not null").select(F.col("iso3").alias("country_code"), "year", F.col("indicator").alias("indicator_code"), "value")

    return Source("who_gho_api", lambda spark, path: readers.odata_values(spark, path, year), transform, family="health")


def wdi(units: dict[str, str]) -> Source:
    def transform(df: DataFrame) -> DataFrame:
        rows = df.where(F.col("value").isNotNull() & ~F.coalesce(F.col("country_name").isin(list(WDI_AGGREGATE_NAMES)), F.lit(False)))
        return rows.select(F.col("iso3").alias("country_code"), "country_name", "year", F.col("variable").alias("indicator_code"), "value", S.mapped(F.col("variable"), units, "unspecified").alias("unit"))

    return Source("world_bank_wdi", readers.wdi, transform, family="economy")


# Leaders


def archigos() -> Source:
    """Spells by leader with raw texts; the country code is null, names come from the spell's own id."""
    columns = {"obsid": "string", "idacr": "string", "ccode": "double", "leader": "string", "startdate": "string", "enddate": "string", "entry": "string", "exit": "string", "gender": "string"}

    def transform(df: DataFrame) -> DataFrame:
        names = df.where(F.trim("leader") != "").groupBy("obsid").agg(F.max("leader").alias("leader_name"))
        facts = ("startdate", "enddate", "entry", "exit", "gender")
        long = df.withColumn("year", S.year_number(F.col("startdate"))).unpivot(["obsid", "year"], list(facts), "_fact", "value_text")
        out = long.join(names, "obsid", "left")
        decimal = F.when(F.col("_fact").isin("startdate", "enddate"), S.decimal_year(F.col("value_text")))
        return out.select(F.col("obsid").alias("leader_id"), "leader_name", "year", F.concat(F.lit("archigos_"), F.col("_fact")).alias("indicator_code"), decimal.alias("value"), "value_text", F.lit("text").alias("value_type"), F.concat_ws(":", F.lit("archigos"), "obsid", "_fact").alias("observation_id"))

    return Source("archigos", lambda spark, path: readers.stata(spark, path, columns), transform, family="leaders")


def reign(variables: Sequence[str]) -> Source:
    """A row per leader, month and variable; empty cells are dropped."""

    def transform(df: DataFrame) -> DataFrame:
        long = df.unpivot(["ccode", "country", "leader", "year", "month"], list(variables), "_v", "value")
        return long.where("value is not null").select(F.col("country").alias("country_name"), F.col("leader").alias("leader_name"), F.col("year").cast("int").alias("year"), F.concat(F.lit("reign_"), F.col("_v")).alias("indicator_code"), "value", F.concat_ws(":", F.lit("reign"), F.col("ccode").cast("int"), F.col("year").cast("int"), F.col("month").cast("int"), "leader", "_v").alias("observation_id"))

    return Source("reign", _csv({"ccode": "double", "country": "string", "leader": "string", "year": "int", "month": "double"}, dict.fromkeys(variables, "double")), transform, family="leaders")


# Weapons


def warhead_table(slug: str, countries: Sequence[str], columns: Sequence[str], year: int, extracted: bool = False) -> Source:
    """Counts by country at a snapshot year, from a saved page or (extracted) from CSV cells of a report's table."""

    def read(spark: SparkSession, path: str) -> DataFrame:
        if not extracted:
            return readers.warheads(spark, path, countries, columns)
        df = readers.csv_columns(spark, path, {"Country": "string", **dict.fromkeys(columns, "string")})
        return df.select(F.col("Country").alias("country"), *(S.footnoted_int(F.col(c)).alias(c) for c in columns)).where(F.col("country").isin(list(countries)))

    def transform(df: DataFrame) -> DataFrame:
        out = observations_of(df.withColumn("year", F.lit(year)), Shape("country", tuple(columns), country_is_name=True))
        return out.withColumn("indicator_code", F.concat(F.lit(f"{slug}_"), F.col("indicator_code")))

    return Source(slug, read, transform, family="nuclear")


def link_by_reference(rows: DataFrame, prefixes: Sequence[str], reference: str = "source_row_reference") -> DataFrame:
    """rows with iso3 from a reference of the form prefix:CODE..., null for other prefixes."""
    parts = F.split(F.col(reference), ":", 3)
    code: Column = F.upper(F.get(parts, F.lit(1)))
    return rows.withColumn("iso3", F.when(F.get(parts, F.lit(0)).isin(list(prefixes)), S.iso3(code)))


def client_rows(cells: DataFrame, columns: dict[str, int], scope: Sequence[str], first_row: int = 5) -> DataFrame:
    """Rows of a matrix with fixed column offsets: exactly one for each code of scope, in order of the code."""
    body = cells.where(F.col("row") >= first_row).groupBy("row").agg(*(F.max(F.when(F.col("column") == i, F.trim("text"))).alias(c) for c, i in columns.items()))
    found = body.withColumn("iso3", S.iso3(F.col("iso3"))).where(F.col("iso3").isin(list(scope)))
    counts = {r["iso3"]: r["n"] for r in found.groupBy("iso3").agg(F.count("*").alias("n")).collect()}
    wrong = sorted(c for c in scope if counts.get(c, 0) != 1)
    if wrong:
        raise readers.SourceError(f"not exactly one row for {wrong}")
    if "leader" in columns and found.where(F.coalesce(F.col("leader"), F.lit("")) == "").limit(1).count():
        raise readers.SourceError("a row has no leader")
    return found.drop("row").orderBy("iso3")


def register(sources: Sequence[Source]) -> Registry:
    registry = Registry()
    for s in sources:
        registry.add(s)
    return registry
