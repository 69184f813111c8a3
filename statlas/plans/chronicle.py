"""The country-year chronicle: a grid of countries and years with regime, system, economy, area and ruler fields.

Each field is a ladder of candidates: structs of value, source, year used and unit, each null unless its
condition holds, and the first that is not null wins. One row of the grid meets each source by an
equality join on country and year, so the plan is a chain of co-partitioned joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlas.functions import scalars as S
from statlas.operators import intervals, joins, series
from statlas.plans.facts import GDP, PER_HEAD, POPULATION

# Labels, thresholds and confidence of the regime and system fields.
REGIMES = ("Authoritarian", "Hybrid regime", "Flawed democracy", "Full democracy")
POLYARCHY = ((0.70, "Full democracy"), (0.50, "Flawed democracy"), (0.30, "Hybrid regime"))
SYSTEMS = {"Full democracy": "Liberal capitalist democracy", "Flawed democracy": "Liberal capitalist democracy", "Hybrid regime": "Mixed / unclear", "Authoritarian": "Mixed / unclear"}
SYSTEM_PERIODS = (("SUN", 1922, 1991, "Communist one-party state"), ("CHN", 1949, 2026, "Communist one-party state"), ("IND", 1858, 1946, "Colonial administration"))
DIRECT, POLYARCHY_ONLY, PROXY, UNKNOWN = 80, 70, 60, 50
CURATED_SYSTEM, DEFAULT_SYSTEM, NO_SYSTEM = 70, 40, 30
RULER_CONFIDENCE = {"archigos": 70, "reign": 65, "curated": 70, "wikidata": 60}
SEVERAL_RULERS = 50
PLACEHOLDER = ("colonial-rule", "colonial_rule_placeholder")
LAST_REGIME_YEAR = 2025
LAST_MADDISON = 2022
#: Weights of the row confidence: regime, system, then the presence of each source.
ROW_WEIGHTS = {"regime": 0.35, "system": 0.25, "wdi": 0.13, "sipri": 0.10, "maddison": 0.10, "ruler": 0.07}


def _first(*candidates: Column) -> Column:
    return F.coalesce(*candidates)


def _pick(when: Column, value: Column, source: str, year: Column, unit: str = "") -> Column:
    """A candidate: null unless the condition holds and there is a value."""
    fields = F.struct(value.cast("double").alias("value"), F.lit(source).alias("source"), year.cast("int").alias("year_used"), F.lit(unit).alias("unit"))
    return F.when(when & value.isNotNull(), fields)


def grid(scope: DataFrame, first: int, last: int) -> DataFrame:
    return scope.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))


def existence_status(start: Column, end: Column, year: Column) -> Column:
    return F.when(start.isNull() | end.isNull(), "unknown").when(year < start, "not_formed").when(year > end, "split_or_dissolved").otherwise("exists")


def with_regime(rows: DataFrame, vdem: DataFrame) -> DataFrame:
    """regime_bucket with its score, the year used, confidence and flags; years after the last covered one use that as a proxy."""
    source = vdem.select("iso3", F.col("year").alias("regime_year"), "v2x_regime", "v2x_polyarchy")
    df = rows.withColumn("regime_year", F.least("year", F.lit(LAST_REGIME_YEAR))).join(source, ["iso3", "regime_year"], "left")
    regime, score = F.col("v2x_regime").cast("int"), F.col("v2x_polyarchy")
    native = F.get(F.array(*map(F.lit, REGIMES)), regime)
    fallback = F.when(score.isNotNull(), F.lit(REGIMES[0]))
    for low, name in reversed(POLYARCHY):
        fallback = F.when(score >= low, name).otherwise(fallback)
    proxy = F.col("year") > LAST_REGIME_YEAR
    direct, derived = native.isNotNull(), native.isNull() & fallback.isNotNull()
    sure = F.when(proxy, PROXY).when(direct, DIRECT).when(derived, POLYARCHY_ONLY).otherwise(UNKNOWN)
    return df.withColumns(
        {
            "political_regime": F.coalesce(native, fallback, F.lit("Unknown")),
            "regime_raw_score": F.when(direct, regime.cast("string")).when(derived, F.format_string("%.4f", score)).otherwise(""),
            "regime_confidence": sure,
            "_regime_gap": ~direct,
            "_regime_proxy": proxy,
        }
    ).drop("v2x_regime", "v2x_polyarchy")


def with_system(rows: DataFrame, periods: Sequence[tuple[str, int, int, str]] = SYSTEM_PERIODS) -> DataFrame:
    """system_type: the first curated period that holds, else the default of the regime."""
    curated = F.lit(None).cast("string")
    for iso3, first, last, label in reversed(periods):
        curated = F.when((F.col("iso3") == iso3) & F.col("year").between(first, last), label).otherwise(curated)
    default = S.mapped(F.col("political_regime"), SYSTEMS, "Unknown")
    sure = F.when(curated.isNotNull(), CURATED_SYSTEM).when(default == "Unknown", NO_SYSTEM).otherwise(DEFAULT_SYSTEM)
    return rows.withColumns({"system_type": F.coalesce(curated, default), "system_source": F.when(curated.isNotNull(), "curated").otherwise("vdem"), "system_confidence": sure})


def vdem_population(vdem: DataFrame) -> DataFrame:
    """(iso3, year, value, method): population in persons, gaps filled by interpolation and one year's carry."""
    people = series.population_units(F.col("e_wb_pop"), F.col("e_mipopula"), F.col("e_pop"))
    known = vdem.select("iso3", "year", people.alias("value"))
    years = known.groupBy("iso3").agg(F.sequence(F.min("year"), F.max("year") + 1).alias("_y")).select("iso3", F.explode("_y").alias("year"))
    filled = series.filled(years.join(known, ["iso3", "year"], "left"), ["iso3"])
    return filled.where("filled is not null").select("iso3", "year", F.col("filled").alias("vdem_population"), F.col("method").alias("vdem_population_method"))


def with_economy(rows: DataFrame, maddison: DataFrame, wdi: DataFrame, vdem: DataFrame) -> DataFrame:
    """population, gdp and gdp_per_capita as structs of value, source, year_used, unit, and the per-head method.

    maddison: iso3, year, pop (thousands), gdppc. wdi: iso3, year, population, gdp_constant, gdp_current, gdp_per_capita.
    vdem: iso3, year, e_wb_pop, e_mipopula, e_pop, e_gdp, e_gdppc.
    """
    m = maddison.select("iso3", F.col("year").alias("_my"), (F.col("pop") * 1000).alias("_mpop"), F.col("gdppc").alias("_mhead"), (F.col("gdppc") * F.col("pop") * 1000).alias("_mgdp"))
    w = wdi.select("iso3", "year", F.col("population").alias("_wpop"), F.coalesce("gdp_constant", "gdp_current").alias("_wgdp"), F.col("gdp_constant").isNotNull().alias("_wconstant"), F.col("gdp_per_capita").alias("_whead"))
    v = vdem.where("e_gdp is not null and e_gdppc is not null").select("iso3", "year", F.col("e_gdp").alias("_vgdp"), F.col("e_gdppc").alias("_vhead"))
    df = rows.withColumn("_my", F.least("year", F.lit(LAST_MADDISON))).join(m, ["iso3", "_my"], "left").join(w, ["iso3", "year"], "left").join(v, ["iso3", "year"], "left").join(vdem_population(vdem), ["iso3", "year"], "left")
    year, c = F.col("year"), F.col
    early, proxy, late = year <= LAST_MADDISON, year == LAST_MADDISON + 1, year > LAST_MADDISON
    last = F.lit(LAST_MADDISON)
    population = _first(_pick(early, c("_mpop"), "maddison_project", year), _pick(late | early, c("_wpop"), "wdi", year), _pick(proxy, c("_mpop"), "maddison_project", last), _pick(F.lit(True), c("vdem_population"), "vdem", year))
    unit = lambda x, constant: _pick(x & (c("_wconstant") == constant), c("_wgdp"), "wdi", year, "constant_2015_usd" if constant else "current_usd")
    gdp = _first(
        _pick(early, c("_mgdp"), "maddison_project", year, "2011_intl_dollars"),
        unit(F.lit(True), True),
        unit(F.lit(True), False),
        _pick(proxy, c("_mgdp"), "maddison_project", last, "2011_intl_dollars"),
        _pick(F.lit(True), c("_vgdp"), "vdem", year, "vdem_latent_gdp_units"),
    )
    df = df.withColumns({"population": population, "gdp": gdp})
    from_m = (c("gdp.source") == "maddison_project") & (c("population.source") == "maddison_project")
    same = (c("gdp.source") == c("population.source")) & c("gdp.source").isin("maddison_project", "wdi")
    whole = c("_mpop").isNotNull()
    head = _first(
        F.when(early & whole & c("_mhead").isNotNull(), F.struct(c("_mhead").alias("value"), F.lit("2011_intl_dollars").alias("unit"), F.lit("maddison_direct").alias("method"))),
        F.when(proxy & whole & c("_mhead").isNotNull() & c("_whead").isNull() & from_m, F.struct(c("_mhead").alias("value"), F.lit("2011_intl_dollars").alias("unit"), F.lit("maddison_direct_proxy").alias("method"))),
        F.when(c("_whead").isNotNull(), F.struct(c("_whead").alias("value"), F.lit("current_usd").alias("unit"), F.lit("wdi_direct").alias("method"))),
        F.when(c("gdp.source") == "vdem", F.struct(c("_vhead").alias("value"), F.lit("vdem_latent_gdppc_units").alias("unit"), F.lit("vdem_latent_direct").alias("method"))),
        F.when(same, F.struct(F.try_divide(c("gdp.value"), c("population.value")).alias("value"), c("gdp.unit").alias("unit"), F.lit("derived_gdp_over_population").alias("method"))),
    )
    by_vdem = c("population.source") == "vdem"
    return df.withColumns(
        {
            "gdp_per_capita": head,
            "_interpolated": by_vdem & (c("vdem_population_method") == "interpolated"),
            "_carried": by_vdem & (c("vdem_population_method") == "proxy"),
            "_maddison_proxy": proxy & ((c("population.source") == "maddison_project") | (c("gdp.source") == "maddison_project")),
        }
    ).drop("_my", "_mpop", "_mhead", "_mgdp", "_wpop", "_wgdp", "_wconstant", "_whead", "_vgdp", "_vhead", "vdem_population", "vdem_population_method")


def rulers(archigos: DataFrame, reign: DataFrame, curated: DataFrame, wikidata: DataFrame, first: int, last: int) -> DataFrame:
    """(iso3, year, ruler_name, ruler_source, ruler_confidence, multiple_rulers): the first source in order that knows a ruler.

    archigos and curated: iso3, leader, startdate, enddate. reign: iso3, year, month, leader. wikidata: iso3, year, leader. Countries
    of curated take no other source. archigos counts up to 2015, reign from 1950 to 2021, wikidata after that.
    """
    a = intervals.stab_earliest(archigos, ["iso3"], "startdate", "enddate", "leader", first, min(last, 2015)).select("iso3", "year", F.col("leader").alias("_a"))
    r = joins.mode_by(reign.where(F.col("year").between(1950, 2021)), ["iso3", "year"], "leader").select("iso3", "year", F.col("leader").alias("_r"), F.col("several").alias("_rs"))
    s = intervals.overlap_longest(curated, ["iso3"], "startdate", "enddate", "leader", first, last).select("iso3", "year", F.col("leader").alias("_s"), F.col("several").alias("_ss"))
    w = wikidata.where(F.col("year") > 2021).groupBy("iso3", "year").agg(F.min("leader").alias("_w"))
    both = a.join(r, ["iso3", "year"], "full").join(s, ["iso3", "year"], "full").join(w, ["iso3", "year"], "full")
    own = both.join(F.broadcast(curated.select("iso3", F.lit(True).alias("_own")).distinct()), "iso3", "left")
    other = F.col("_own").isNull()
    name = F.when(other, F.coalesce("_a", "_r", "_w")).otherwise(F.col("_s"))
    source = F.when(~other, F.when(F.col("_s").isNotNull(), "curated")).when(F.col("_a").isNotNull(), "archigos").when(F.col("_r").isNotNull(), "reign").when(F.col("_w").isNotNull(), "wikidata")
    several = F.coalesce(F.when(source == "curated", F.col("_ss")).when(source == "reign", F.col("_rs")), F.lit(False))
    sure = F.when(several, SEVERAL_RULERS).otherwise(S.mapped(source, RULER_CONFIDENCE))
    return own.select("iso3", "year", name.alias("ruler_name"), source.alias("ruler_source"), sure.alias("ruler_confidence"), several.alias("multiple_rulers")).where("ruler_name is not null")


def with_area(rows: DataFrame, periods: DataFrame) -> DataFrame:
    """area of the territory period, blank outside the years of existence. periods: iso3, gwsyear, gweyear, area."""
    found = intervals.period_value(rows.select("iso3", "year").distinct(), periods, ["iso3"], "gwsyear", "gweyear", "area")
    df = rows.join(found, ["iso3", "year"], "left")
    exists = F.col("existence_status").isin("exists", "unknown")
    return df.withColumns({"area": F.when(exists, F.col("area")), "_area_proxy": exists & F.coalesce("is_proxy", F.lit(False)) & F.col("area").isNotNull()}).drop("is_proxy")


def dependent_years(vdem: DataFrame) -> DataFrame:
    """(iso3, year, dependent): coded as not independent, or a gap between two such years."""
    marked = series.bracketed(series.yearly(vdem.select("iso3", "year", "v2svindep"), ["iso3"]), ["iso3"], "v2svindep", 0)
    return marked.select("iso3", "year", (F.coalesce(F.col("v2svindep") == 0, F.lit(False)) | F.col("bracketed")).alias("dependent"))


def build(scope: DataFrame, vdem: DataFrame, wdi: DataFrame, maddison: DataFrame, sipri: DataFrame, area: DataFrame, ruler_rows: DataFrame, first: int, last: int) -> DataFrame:
    """One row per country of scope (iso3, name, start_year, end_year) and year.

    sipri: iso3, year, military_spend. ruler_rows: as rulers() gives them. A country-year without a ruler that is dependent gets a
    placeholder for colonial rule, which counts as a ruler in the row's confidence.
    """
    rows = grid(scope, first, last).withColumn("existence_status", existence_status(F.col("start_year"), F.col("end_year"), F.col("year")))
    rows = with_area(with_economy(with_system(with_regime(rows, vdem)), maddison, wdi, vdem), area)
    rows = rows.join(sipri.select("iso3", "year", "military_spend"), ["iso3", "year"], "left").join(ruler_rows, ["iso3", "year"], "left").join(dependent_years(vdem), ["iso3", "year"], "left")
    c = F.col
    colonial = c("ruler_name").isNull() & F.coalesce("dependent", F.lit(False))
    rows = rows.withColumns({"_colonial": colonial, "multiple_rulers": F.coalesce("multiple_rulers", F.lit(False)), "ruler_confidence": F.coalesce("ruler_confidence", F.lit(0))})
    rows = rows.withColumns({"ruler_source": F.when(c("_colonial"), PLACEHOLDER[1]).otherwise(c("ruler_source")), "ruler_name": F.when(c("_colonial"), PLACEHOLDER[0]).otherwise(c("ruler_name"))})
    has = {"wdi": (c("population.source") == "wdi") | (c("gdp.source") == "wdi"), "sipri": c("military_spend").isNotNull(), "maddison": (c("population.source") == "maddison_project") | (c("gdp.source") == "maddison_project"), "ruler": c("ruler_name").isNotNull()}
    has = {k: F.coalesce(v, F.lit(False)) for k, v in has.items()}
    total = ROW_WEIGHTS["regime"] * c("regime_confidence") + ROW_WEIGHTS["system"] * c("system_confidence")
    for k, v in has.items():
        total = total + F.when(v, ROW_WEIGHTS[k] * DIRECT).otherwise(0.0)
    names = S.flags(
        (c("year") < c("start_year"), "pre_existence_gap"),
        (c("year") > c("end_year"), "post_existence_gap"),
        (c("_area_proxy"), "area_proxy_year_used"),
        (c("_regime_gap"), "regime_source_gap"),
        (c("_regime_proxy"), "proxy_year_used"),
        (c("system_type") == "Unknown", "system_type_low_confidence"),
        (c("population").isNull(), "missing_population"),
        (c("gdp").isNull(), "missing_gdp"),
        (c("military_spend").isNull(), "missing_military_spend"),
        (c("area").isNull(), "missing_area"),
        (c("ruler_name").isNull(), "missing_ruler"),
        (F.lit(True), "controlled_area_not_modeled"),
        (c("area").isNotNull(), "controlled_area_country_only"),
        (c("_interpolated"), "population_interpolated"),
        (c("_carried"), "population_proxy_year_used"),
        (c("multiple_rulers"), "multiple_rulers"),
        (c("_colonial"), "colonial_rule_placeholder"),
        (c("_maddison_proxy"), "proxy_year_used"),
    )
    yes = lambda k: F.when(has[k], "yes").otherwise("no")
    provenance = F.concat(F.lit("regime=vdem|wdi="), yes("wdi"), F.lit("|sipri="), yes("sipri"), F.lit("|maddison="), yes("maddison"), F.lit("|ruler="), F.coalesce("ruler_source", F.lit("none")), F.lit("|flags="), F.when(names == "", "none").otherwise(F.regexp_replace(names, r"\|", ",")))
    return rows.select(
        "iso3",
        "year",
        "name",
        "existence_status",
        "political_regime",
        "regime_raw_score",
        "regime_confidence",
        "system_type",
        "system_source",
        "system_confidence",
        c("population.value").alias("population"),
        c("population.source").alias("population_source"),
        c("population.year_used").alias("population_year_used"),
        c("gdp.value").alias("gdp"),
        c("gdp.unit").alias("gdp_unit"),
        c("gdp.source").alias("gdp_source"),
        c("gdp.year_used").alias("gdp_year_used"),
        c("gdp_per_capita.value").alias("gdp_per_capita"),
        c("gdp_per_capita.unit").alias("gdp_per_capita_unit"),
        c("gdp_per_capita.method").alias("gdp_per_capita_method"),
        "military_spend",
        c("area").alias("country_area"),
        c("area").alias("controlled_area"),
        "ruler_name",
        "ruler_source",
        "ruler_confidence",
        "multiple_rulers",
        F.greatest(F.lit(0), F.least(F.lit(100), F.bround(F.round(total, 9), 0))).cast("int").alias("row_confidence"),
        names.alias("data_quality_flags"),
        provenance.alias("provenance_summary"),
    )


CONDENSED = ("iso3", "year", "name", "existence_status", "political_regime", "system_type", "population", "gdp", "gdp_per_capita", "country_area", "ruler_name", "row_confidence")


def condensed(chronicle: DataFrame) -> DataFrame:
    """The short form; years outside a country's existence keep only their identity."""
    blank = F.col("existence_status").isin("not_formed", "split_or_dissolved")
    return chronicle.select(*(c if c in CONDENSED[:4] else F.when(~blank, F.col(c)).alias(c) for c in CONDENSED))


def metric_fact(chronicle: DataFrame) -> DataFrame:
    """The long metric fact of a chronicle."""
    names = {"population": POPULATION, "gdp": GDP, "gdp_per_capita": PER_HEAD}
    long = chronicle.unpivot(["iso3", "year", "name", "existence_status", "political_regime"], list(names), "_column", "value")
    bucket = F.when(F.col("political_regime").isin("Full democracy", "Flawed democracy"), "democracy").when(F.col("political_regime") == "Unknown", "unknown").otherwise("authoritarian")
    return long.select(S.mapped(F.col("_column"), names).alias("metric_id"), "year", F.make_date("year", F.lit(1), F.lit(1)).alias("year_date"), F.col("iso3").alias("country_iso3"), F.col("name").alias("country_name"), "political_regime", bucket.alias("political_regime_bucket"), "existence_status", "value").where("value is not null")


def coverage_window(vdem: DataFrame) -> DataFrame:
    """(iso3, name, start_year, end_year) of the regime source: a scope when no other is given."""
    first_name = F.min_by("country_name", "year")
    return vdem.where(F.col("iso3").rlike("^[A-Z]{3}$")).groupBy("iso3").agg(first_name.alias("name"), F.min("year").alias("start_year"), F.max("year").alias("end_year"))


def ordered(chronicle: DataFrame) -> DataFrame:
    return chronicle.orderBy("iso3", "year")


def growth_of_rows(chronicle: DataFrame) -> DataFrame:
    order = Window.partitionBy("iso3").orderBy("year")
    return chronicle.withColumn("population_growth", S.pct_growth(F.col("population"), F.lag("population").over(order)))
