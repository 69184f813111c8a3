"""Semantics of the operators on tiny tables: nulls, gaps, ties, refusals."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from statlas.functions import scalars as S
from statlas.operators import concepts, evidence, growth, intervals, joins, reshape, scoring, series
from statlas.plans import chronicle
from statlas.plans.query import execute
from statlas.plans.spec import METRICS, Filter, Query, SpecError, Transform, from_payload, validated

P, G, H = "chronicle.population", "chronicle.gdp", "chronicle.gdp_per_capita"
FACT = "metric_id string, year int, year_date date, country_iso3 string, country_name string, political_regime string, political_regime_bucket string, existence_status string, value double"


def fact(spark, cells, **more):
    """cells: (metric, country, year, bucket, value)."""
    rows = [(m, y, dt.date(y, 1, 1), c, c.title(), f"{b} regime" if b else None, b, "exists", v) for m, c, y, b, v in cells]
    df = spark.createDataFrame(rows, FACT)
    return df.withColumns({k: F.lit(v) for k, v in more.items()})


def two_countries(spark):
    cells = []
    for c, b, people, head in (("AAA", "democracy", (100, 110), (5000, 5500)), ("BBB", "authoritarian", (200, 220), (3000, 3300))):
        for y, p, h in zip((2020, 2021), people, head, strict=True):
            cells += [(P, c, y, b, float(p)), (H, c, y, b, float(h))]
    return fact(spark, cells)


def values(df, column="value"):
    return [r[column] for r in df.collect()]


def test_population_by_regime(spark):
    spec = from_payload({"metric": P, "aggregation": "sum", "group_by": ["year", "political_regime_bucket"], "time_range": [2021, 2021]})
    got = {(r.year, r.political_regime_bucket): (r.value, r.aggregation, r.metric_label, r.value_unit) for r in execute(spec, two_countries(spark)).collect()}
    assert got == {(2021, "democracy"): (110.0, "sum", "Population", "persons"), (2021, "authoritarian"): (220.0, "sum", "Population", "persons")}


def test_null_groups_and_values(spark):
    df = fact(spark, [(G, "AAA", 2020, None, None), (G, "BBB", 2020, None, None), (G, "CCC", 2020, "x", 4.0)])
    group = ("political_regime_bucket",)
    assert sorted(values(execute(Query((G,), aggregation="sum", group_by=group), df))) == [0.0, 4.0]
    assert {r.political_regime_bucket: r.value for r in execute(Query((G,), aggregation="mean", group_by=group), df).collect()} == {None: None, "x": 4.0}
    assert {r.political_regime_bucket: r.value for r in execute(Query((G,), aggregation="count", group_by=group), df, strict=False).collect()} == {None: 2.0, "x": 1.0}


@pytest.mark.parametrize(
    "bad",
    [
        {"metric": "nope"},
        {},
        {"metric": P, "aggregation": "mean"},
        {"metric": P, "grain": "ruler_year"},
        {"metric": P, "time_range": [2021, 2020]},
        {"metric": P, "time_range": [1800, 2020]},
        {"metric": P, "filters": [{"field": "year", "operator": "in", "value": 3}]},
        {"metric": P, "filters": [{"field": "year", "operator": "like", "value": 3}]},
        {"metric": P, "aggregation": "weighted_mean"},
        {"metric": P, "transforms": [{"kind": "per_capita"}]},
        {"metric": P, "transforms": [{"kind": "rolling_mean"}]},
        {"metric": P, "transforms": [{"kind": "log10"}]},
        {"metric": P, "transforms": [{"kind": "identity", "metric_ids": [G]}]},
        {"metric": "score.delta_vs_client"},
    ],
)
def test_refused_queries(bad):
    with pytest.raises(SpecError):
        validated(from_payload(bad))


def test_extensions_run_when_not_strict(spark):
    df = two_countries(spark)
    out = execute(Query((P,), transforms=(Transform("year_over_year_change"),)), df, strict=False)
    assert sorted(v for v in values(out) if v is not None) == [10.0, 20.0]
    mean = execute(Query((H,), aggregation="weighted_mean", group_by=("year",), weight_metric_id=P, filters=(Filter("year", "eq", 2021),)), df, strict=False)
    assert values(mean) == [pytest.approx((5500 * 110 + 3300 * 220) / 330)]
    with pytest.raises(ValueError, match="missing"):
        execute(Query((P,), filters=(Filter("nowhere", "eq", 1),)), df)
    assert len(METRICS) == 8


def test_growth_breaks_at_gaps_and_units(spark):
    df = fact(spark, [(G, "AAA", 2018, "x", 0.0), (G, "AAA", 2019, "x", 50.0), (G, "AAA", 2020, "x", 100.0), (G, "AAA", 2022, "x", 120.0)])
    got = {r.year: (r.prev_value, r.yoy_abs_change, r.yoy_pct_growth, r.decade) for r in growth.country_year_growth(df).collect()}
    assert got == {2018: (None, None, None, 2010), 2019: (0.0, 50.0, None, 2010), 2020: (50.0, 50.0, 1.0, 2020), 2022: (None, None, None, 2020)}
    units = fact(spark, [(G, "AAA", 2019, "x", 1.0), (G, "AAA", 2020, "x", 2.0)]).withColumn("metric_unit", F.when(F.col("year") == 2019, "a").otherwise("b"))
    assert values(growth.country_year_growth(units), "prev_value") == [None, None]


def test_regime_aggregates(spark):
    out = growth.regime_year_aggregates(two_countries(spark)).collect()
    row = next(r for r in out if r.year == 2021 and r.metric_id == H and r.political_regime_bucket == "democracy")
    assert (row.political_regime, row.n_countries, row.mean_value, row.prev_mean_value) == ("", 1, 5500.0, 5000.0)
    assert row.pop_weighted_mean_value == pytest.approx(5500.0) and row.mean_yoy_pct_growth == pytest.approx(0.1)
    twice = fact(spark, [(P, "AAA", 2020, "x", 10.0), (P, "AAA", 2020, "x", 30.0), (H, "AAA", 2020, "x", 5.0)])
    counted = {o: next(r.sum_value for r in growth.regime_year_aggregates(twice, one_population=o).collect() if r.metric_id == H and r.political_regime == "") for o in (False, True)}
    assert counted == {False: 10.0, True: 5.0}


def test_latest_metrics(spark):
    df = fact(spark, [(P, "AAA", 2010, "x", 100.0), (P, "AAA", 2020, "x", 200.0), (G, "AAA", 2019, "x", 7.0), (P, "BBB", 2020, "y", 200.0), (P, "CCC", 2021, None, 50.0), (G, "CCC", 2021, "z", None)])
    got = {r.country_iso3: r for r in growth.country_latest_metrics(df).collect()}
    assert (got["AAA"].latest_population, got["AAA"].population_latest_year, got["AAA"].gdp_latest_year, got["AAA"].latest_year) == (200.0, 2020, 2019, 2020)
    assert got["AAA"].population_10yr_cagr_pct == pytest.approx((2**0.1 - 1) * 100) and got["BBB"].population_10yr_cagr_pct is None
    assert [got[c].population_rank for c in ("AAA", "BBB", "CCC")] == [1, 1, 3] and [got[c].gdp_rank for c in ("AAA", "BBB", "CCC")] == [1, None, None]


def test_best_observation_order(spark):
    rows = [("A", 2020, 2, 9, 1.0), ("A", 2022, 2, 8, 2.0), ("A", 2022, 1, 7, 3.0), ("A", 2022, 1, 6, 4.0), ("A", 2018, 1, 1, 5.0), ("B", 2019, 1, 1, 6.0), ("C", None, 1, 1, 7.0)]
    obs = spark.createDataFrame(rows, "iso3 string, year int, source_id int, observation_id int, value double")
    targets = spark.createDataFrame([(c, 2021) for c in "ABC"], "iso3 string, target_year int")
    pick = lambda allowed: {r.iso3: (r.value, r.temporal_kind) for r in evidence.best_observations(obs, targets, ["iso3"], allowed).collect()}
    assert pick((1, 2)) == {"A": (4.0, "proxy"), "B": (6.0, "proxy")}
    assert pick((3,)) == {"A": (5.0, "proxy")}
    assert pick(()) == {}


def test_evidence_membership(spark):
    obs = spark.createDataFrame([("s", "f", "i", 2020, "AAA", "Aland", None, "Ann"), ("s", "f", "i", None, None, None, None, None)], "source_id string, family string, indicator_code string, year int, country_code string, country_name string, leader_id string, leader_name string")
    count = lambda **q: evidence.matching(obs, q).count()
    assert [count(), count(source=("s",)), count(source=()), count(year=(2020,)), count(country=("Aland",)), count(country=("AAA",)), count(leader=("Ann",)), count(leader=("x",))] == [2, 2, 0, 1, 1, 1, 1, 0]
    assert [count(country=(" aLAND",)), count(country=("aaa", "x")), count(leader=("ann",))] == [1, 1, 0]
    with pytest.raises(ValueError, match="unknown dimensions"):
        count(place=("x",))


def test_scores(spark):
    plan = spark.createDataFrame([("c", "v1", "required", "s1", "g1"), ("c", "v2", "preferred", "s2", "g2"), ("c", "v3", "fallback", "s2", "g2")], "category string, variable_name string, role string, owning_source string, rubric_group string")
    weights = spark.createDataFrame([("c", "g1", 0.6), ("c", "g2", 0.4)], "category string, rubric_group string, weight double")
    kinds = lambda fixed: spark.createDataFrame([("c", 2, fixed, False)], "category string, min_sources int, fixed_flags boolean, owner_only boolean")
    rows = [("A", "c", "v1", "s1", 1.0, "direct"), ("A", "c", "v2", "s2", 0.5, "proxy"), ("A", "c", "v2", "client_x", 0.0, "direct"), ("B", "c", "v1", "s1", 0.3, "direct"), ("C", "c", "v2", "s2", None, "direct")]
    obs = spark.createDataFrame(rows, "country_iso3 string, category string, variable_name string, source_id string, normalized_value double, temporal_kind string")
    entities = spark.createDataFrame([("A",), ("B",), ("C",)], "country_iso3 string")
    got = {r.country_iso3: (r.normalized_score, r.score_1_10, r.status, r.flags) for r in scoring.scored(obs, plan, weights, kinds(False), entities).collect()}
    assert got == {"A": (pytest.approx(0.8), 8, "scored", "low_confidence"), "B": (None, None, "insufficient_data", "insufficient_data|sparse_data"), "C": (None, None, "insufficient_data", "insufficient_data|missing_primary_source|sparse_data")}
    assert {r.flags for r in scoring.scored(obs, plan, weights, kinds(True), entities.where("country_iso3 <> 'A'")).collect()} == {"insufficient_data|sparse_data"}


def test_confidence_rounds_half_to_even(spark):
    row = spark.range(1).select(S.confidence(F.lit(70), F.lit(70), F.lit(80), F.lit(100)).alias("a"), S.confidence(F.lit(100), F.lit(100), F.lit(100), F.lit(100)).alias("b"), S.confidence(F.lit(0), F.lit(2), F.lit(0), F.lit(0)).alias("c"), S.band(F.lit(70)).alias("d"), S.band(F.lit(29)).alias("e")).first()
    assert tuple(row) == (77, 100, 0, "high", "very_low")


def test_concept_ratio_reasons(spark):
    rows = [("a", "t", 1, 6.0), ("a", "b", 2, 3.0), ("b", "t", 3, 1.0), ("c", "b", 4, 1.0), ("d", "t", 5, 1.0), ("d", "b", 6, 0.0), ("e", "t", 7, 1.0), ("e", "t", 8, 1.0), ("e", "b", 9, 1.0), ("f", "t", 10, float("nan")), ("f", "b", 11, 1.0), (None, "t", 12, 4.0), (None, "b", 13, 2.0)]
    obs = spark.createDataFrame(rows, "country_code string, indicator_code string, observation_id int, value double")
    got = {r.country_code: (r.value, r.reason) for r in concepts.ratio(obs, "t", "b", ("country_code",)).collect()}
    assert got == {"a": (2.0, None), "b": (None, "missing_denominator"), "c": (None, "missing_numerator"), "d": (None, "zero_denominator"), "e": (None, "ambiguous"), "f": (None, "non_numeric_numerator"), None: (2.0, None)}
    with pytest.raises(LookupError):
        concepts.Catalog({"gdp": {"pwt": ("rgdpo",)}}).resolve("gdp", "wdi")


def test_spells(spark):
    d = dt.date
    spells = spark.createDataFrame([("A", d(2000, 3, 1), d(2001, 2, 1), "x"), ("A", d(2001, 1, 15), d(2003, 1, 1), "y"), ("A", d(2001, 1, 1), None, "z"), ("A", None, d(2002, 1, 1), "w")], "iso3 string, s date, e date, leader string")
    first = {r.year: r.leader for r in intervals.stab_earliest(spells, ["iso3"], "s", "e", "leader", 2000, 2003).collect()}
    assert first == {2000: "x", 2001: "x", 2002: "z", 2003: "z"}
    longest = {r.year: (r.leader, r.days, r.several) for r in intervals.overlap_longest(spells, ["iso3"], "s", "e", "leader", 2000, 2003).collect()}
    assert longest == {2000: ("x", 306, False), 2001: ("z", 365, True), 2002: ("z", 365, True), 2003: ("z", 365, True)}
    periods = spark.createDataFrame([("A", 1900, 1950, 1.0), ("A", 1940, 1950, 2.0), ("B", 1990, 2019, 3.0), ("A", 1960, 1970, 4.0)], "iso3 string, a int, b int, area double")
    ask = spark.createDataFrame([("A", 1945), ("A", 1955), ("A", 2020), ("B", 2020), ("C", 2020)], "iso3 string, year int")
    assert {(r.iso3, r.year): (r.area, r.is_proxy) for r in intervals.period_value(ask, periods, ["iso3"], "a", "b", "area").collect()} == {("A", 1945): (2.0, False), ("A", 1955): (None, False), ("A", 2020): (4.0, True), ("B", 2020): (3.0, True), ("C", 2020): (None, False)}
    codes = spark.createDataFrame([(365, 1900, 1950), (365, 1950, 2000)], "gw int, a int, b int")
    mapping = spark.createDataFrame([(365, "SUN", 1922, 1991), (365, "RUS", 1991, None)], "gw int, target string, first_year int, last_year int")
    assert sorted((r.target, r.from_year, r.to_year) for r in intervals.split_by_period(codes, mapping, "gw", "a", "b").collect()) == [("RUS", 1991, 2000), ("SUN", 1922, 1950), ("SUN", 1950, 1991)]


def test_series(spark):
    df = spark.createDataFrame([("A", 2000, 10.0), ("A", 2001, None), ("A", 2004, 50.0), ("A", 2005, None), ("A", 2006, None)], "k string, year int, value double")
    got = {r.year: (r.filled, r.method) for r in series.filled(series.yearly(df, ["k"]), ["k"]).collect()}
    assert got == {2000: (10.0, "exact"), 2001: (20.0, "interpolated"), 2002: (30.0, "interpolated"), 2003: (40.0, "interpolated"), 2004: (50.0, "exact"), 2005: (50.0, "proxy"), 2006: (None, "missing")}
    far = spark.createDataFrame([("A", 1900, 1.0), ("A", 1930, None), ("A", 1990, 2.0)], "k string, year int, value double")
    assert {r.year: r.method for r in series.filled(far, ["k"]).collect()}[1930] == "missing"


def test_lookup_joins(spark):
    base = spark.createDataFrame([("A", 1, 1.0, "n"), ("B", 1, None, "m")], "iso3 string, year int, v double, name string")
    cache = spark.createDataFrame([("A", 1, None, 9), ("B", 1, 5.0, 9), ("C", 1, 7.0, 9)], "iso3 string, year int, v double, extra int")
    assert {tuple(r) for r in joins.overlay(base, cache, ["iso3", "year"]).collect()} == {("A", 1, 1.0, "n"), ("B", 1, 5.0, "m"), ("C", 1, 7.0, None)}
    months = spark.createDataFrame([("A", "x"), ("A", "y"), ("A", "y"), ("B", "z"), ("B", None)], "k string, leader string")
    assert {tuple(r) for r in joins.mode_by(months, ["k"], "leader").collect()} == {("A", "y", 2, True), ("B", "z", 1, False)}
    with pytest.raises(ValueError, match="duplicate"):
        reshape.assert_unique(months, ["k"])
    names = spark.createDataFrame([("World Bank WDI",), ("Client matrix PTS",), ("PTS 2025",), ("x",)], "name string")
    assert [r.k for r in names.select(joins.source_key(F.col("name"), [("wdi", "wdi"), ("pts", "pts")], ["client"]).alias("k")).collect()] == ["wdi", None, "pts", None]


def test_event_grid(spark):
    df = spark.createDataFrame([("A", 1, "x", 2.0), ("A", 1, "y", None), ("B", 2, "x", None)], "e string, p int, kind string, amount double")
    got = {(r.e, r.p): (r.n_all, r.n_x, r.sum_x) for r in reshape.event_grid(df, "e", "p", "kind", "amount", ["x"]).collect()}
    assert got == {("A", 1): (2, 1, 2.0), ("A", 2): (0, 0, 0.0), ("B", 1): (0, 0, 0.0), ("B", 2): (1, 1, 0.0)}


def test_scalars(spark):
    def one(f, *texts):
        df = spark.createDataFrame([(t,) for t in texts], "x string")
        return [r[0] for r in df.select(f(F.col("x"))).collect()]

    assert one(S.iso3, " usa", "US", "ü12", None) == ["USA", None, None, None]
    assert one(S.plain_name, "Côte d'Ivoire", "  São  Tomé ", "Việt-Nam!", "ﬁn\tland ½", "ß") == ["cote d'ivoire", "sao tome", "viet nam", "fin land 1 2", ""]
    assert one(S.comma_decimal, "1,5", " 2.5 ", "", "x", None, "nan") == [1.5, 2.5, None, None, None, None]
    assert one(S.vdem_double, "-999", "0.5", "NA", "-1000") == [None, 0.5, None, None]
    assert one(S.strict_int, "+7", "7.0", "nan") == [7, None, None]
    assert one(S.lenient_int, "7.9", "-3", "-", "x") == [7, None, None, None]
    assert one(S.count_cell, "~<b>5,044</b><sup>3</sup>", "&lt;10", "140–160", "n.a.", "350a") == [5044, 10, 150, None, 350]
    assert one(S.footnoted_int, "–", "..", "c. 1 770", "90k") == [0, None, 1770, 90]
    assert one(S.year_number, "2019-05-01", "1899", "x") == [2019, None, None]
    assert one(S.edition_year, "Jan.-Feb. 1973", "2024") == [1973, 2024]
    assert one(S.decimal_year, "2020-12-31", "2021-01-01") == [pytest.approx(2021.0), 2021.0]
    assert one(lambda c: S.zero_to_ten(c.cast("double")), "0.25", "0.35", "1.5") == [2, 4, 10]
    assert one(lambda c: S.one_to_ten(c.cast("double")), "0", "0.5", "1", None) == [1, 6, 10, None]
    assert one(lambda c: S.reference(F.lit("v"), c, F.lit(2020)), "Côte x") == ["v:C_te_x:2020"]


def test_chronicle_fields(spark):
    rows = spark.createDataFrame([("CHN", 2000), ("AAA", 2000), ("AAA", 2026), ("BBB", 2000), ("IND", 1900)], "iso3 string, year int")
    vdem = spark.createDataFrame([("CHN", 2000, 0.0, 0.1), ("AAA", 2000, None, 0.55), ("AAA", 2025, 3.0, 0.9)], "iso3 string, year int, v2x_regime double, v2x_polyarchy double")
    got = {(r.iso3, r.year): (r.political_regime, r.regime_confidence, r.system_type, r.system_confidence) for r in chronicle.with_system(chronicle.with_regime(rows, vdem)).collect()}
    assert got == {
        ("CHN", 2000): ("Authoritarian", 80, "Communist one-party state", 70),
        ("AAA", 2000): ("Flawed democracy", 70, "Liberal capitalist democracy", 40),
        ("AAA", 2026): ("Full democracy", 60, "Liberal capitalist democracy", 40),
        ("BBB", 2000): ("Unknown", 50, "Unknown", 30),
        ("IND", 1900): ("Unknown", 50, "Colonial administration", 70),
    }


def test_economy_branches(spark):
    grid = spark.createDataFrame([(c, y) for c in "MWV" for y in (2022, 2023, 2024)], "iso3 string, year int")
    maddison = spark.createDataFrame([("M", 2022, 2.0, 3.0)], "iso3 string, year int, pop double, gdppc double")
    wdi = spark.createDataFrame([("W", 2022, 10.0, None, 50.0, None), ("W", 2024, 10.0, 60.0, 50.0, 7.0)], "iso3 string, year int, population double, gdp_constant double, gdp_current double, gdp_per_capita double")
    vdem = spark.createDataFrame([("V", 2022, None, 5.0, None, 8.0, 9.0), ("V", 2024, None, None, 2.0, None, None)], "iso3 string, year int, e_wb_pop double, e_mipopula double, e_pop double, e_gdp double, e_gdppc double")
    got = {(r.iso3, r.year): (r.population and tuple(r.population)[:3], r.gdp and tuple(r.gdp)[0::3], r.gdp_per_capita and tuple(r.gdp_per_capita)[0::2]) for r in chronicle.with_economy(grid, maddison, wdi, vdem).collect()}
    m = (2000.0, "maddison_project", 2022)
    assert got == {
        ("M", 2022): (m, (6000.0, "2011_intl_dollars"), (3.0, "maddison_direct")),
        ("M", 2023): (m, (6000.0, "2011_intl_dollars"), (3.0, "maddison_direct_proxy")),
        ("M", 2024): (None, None, None),
        ("W", 2022): ((10.0, "wdi", 2022), (50.0, "current_usd"), (5.0, "derived_gdp_over_population")),
        ("W", 2023): (None, None, None),
        ("W", 2024): ((10.0, "wdi", 2024), (60.0, "constant_2015_usd"), (7.0, "wdi_direct")),
        ("V", 2022): ((5000.0, "vdem", 2022), (8.0, "vdem_latent_gdp_units"), (9.0, "vdem_latent_direct")),
        ("V", 2023): ((12500.0, "vdem", 2023), None, None),
        ("V", 2024): ((20000.0, "vdem", 2024), None, None),
    }


def test_ruler_chain(spark):
    d = dt.date
    spell = "iso3 string, leader string, startdate date, enddate date"
    archigos = spark.createDataFrame([("A", "a", d(2010, 1, 1), d(2020, 1, 1))], spell)
    curated = spark.createDataFrame([("S", "s", d(2010, 1, 1), d(2010, 12, 31))], spell)
    reign = spark.createDataFrame([("A", 2016, 1, "r1"), ("A", 2016, 2, "r2"), ("A", 2016, 3, "r2"), ("S", 2011, 1, "no")], "iso3 string, year int, month int, leader string")
    wiki = spark.createDataFrame([("A", 2022, "w"), ("A", 2021, "early")], "iso3 string, year int, leader string")
    got = {(r.iso3, r.year): (r.ruler_name, r.ruler_source, r.ruler_confidence) for r in chronicle.rulers(archigos, reign, curated, wiki, 2014, 2022).collect()}
    assert got == {("A", 2014): ("a", "archigos", 70), ("A", 2015): ("a", "archigos", 70), ("A", 2016): ("r2", "reign", 50), ("A", 2022): ("w", "wikidata", 60)}
