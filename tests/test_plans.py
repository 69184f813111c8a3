"""Category plans, adapters, slices, the star schema and the command line."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from statlas import cli
from statlas.plans import categories, slices
from statlas.sources import adapters, readers, star
from statlas.sources.registry import Source, observations


def test_plans_fit_their_weights():
    groups = {c: set() for c in categories.CATEGORIES}
    for line in categories.PLAN.splitlines():
        category, _, role, direction, _, group = line.split()
        assert role in ("required", "preferred", "fallback") and direction in ("higher_is_better", "lower_is_better")
        groups[category].add(group)
    for c, (_, _, weights) in categories.CATEGORIES.items():
        assert set(weights) == groups[c] and sum(weights.values()) == pytest.approx(1)


def test_score_all(spark):
    rows = [("AAA", 2023, "undp_hdi", 1, "undp_hdi_hdi", 0.9), ("AAA", 2022, "vdem", 2, "vdem_v2x_egal", 0.5), ("AAA", 2023, "vdem", 3, "undp_hdi_hdi", 0.0), ("AAA", 2023, "fas", 4, "fas_total_inventory", 0.2), ("BBB", 2020, "undp_hdi", 5, "undp_hdi_hdi", 0.9)]
    obs = spark.createDataFrame(rows, "country_iso3 string, year int, source_id string, observation_id int, variable_name string, normalized_value double")
    entities = spark.createDataFrame([("AAA",), ("BBB",)], "country_iso3 string")
    got = {(r.country_iso3, r.category): (r.normalized_score, r.status, r.flags) for r in categories.score_all(obs, entities, 2023).collect()}
    assert len(got) == 16
    assert got["AAA", "social_wellbeing"] == (pytest.approx(0.4 * 0.9 + 0.1 * 0.5), "scored", "sparse_data|low_confidence")
    assert got["BBB", "social_wellbeing"] == (None, "insufficient_data", "insufficient_data|sparse_data")
    assert got["AAA", "nuclear"] == (pytest.approx(0.12), "scored", "missing_primary_source|sparse_data")
    best, gone = categories.evidence_for(obs, entities, 2023)
    planned = len(categories.PLAN.splitlines())
    assert best.count() + gone.count() == 2 * planned
    reasons = {(r.country_iso3, r.variable_name): (r.reason, r.severity) for r in gone.collect()}
    assert reasons["BBB", "undp_hdi_hdi"] == ("target_year_absent", "high") and reasons["AAA", "cpi_score"] == ("source_not_implemented", "high")


def test_conflict_events(spark):
    rows = [(1.0, 2020.0, 1.0, 5.0, None), (1.0, 2020.0, 1.0, None, 9.0), (1.0, 2020.0, 2.0, 7.0, None), (2.0, 2021.0, 3.0, 4.0, None)]
    events = spark.createDataFrame(rows, "country_id double, year double, type_of_violence double, best double, gwnob double")
    got = {(r.country_id, r.year): (r.ucdp_state_based_events, r.ucdp_state_based_fatalities, r.ucdp_intl_events, r.ucdp_intl_fatalities, r.ucdp_onesided_fatalities) for r in adapters.aggregate_conflict_events(events).collect()}
    assert got == {(1, 2020): (2, 5.0, 1, 0.0, 0.0), (1, 2021): (0, 0.0, 0, 0.0, 0.0), (2, 2020): (0, 0.0, 0, 0.0, 0.0), (2, 2021): (0, 0.0, 0, 0.0, 4.0)}


def run(spark, source: Source, raw):
    return {(r.country_code or r.country_name or r.leader_id, r.year, r.indicator_code): (r.value, r.value_text, r.value_type, r.extension) for r in observations(source.transform(raw), source).collect()}


def test_adapters(spark):
    v = run(spark, adapters.vdem(["v2x"]), spark.createDataFrame([("aaa", 2020, "-999"), ("bbb", 2020, "0.5")], "country_text_id string, year int, v2x string"))
    assert v == {("AAA", 2020, "v2x"): (None, None, "missing", None), ("BBB", 2020, "v2x"): (0.5, None, "numeric", None)}
    m = run(spark, adapters.maddison(), spark.createDataFrame([("AAA", "2022", "2", "3"), ("BBB", "2021", "2", None)], "countrycode string, year string, gdppc string, pop string"))
    assert m["AAA", 2022, "gdp_total"] == (6000.0, None, "numeric", {"proxy_year_for": "2023"}) and ("BBB", 2021, "gdp_total") not in m
    p = run(spark, adapters.pts(), spark.createDataFrame([("usa", "2020", "3", "NA", "4", "0", "88", "66")], "COW_Code_A string, Year string, PTS_A string, PTS_H string, PTS_S string, NA_Status_A string, NA_Status_H string, NA_Status_S string"))
    assert p == {("USA", 2020, "pts_amnesty_score"): (3.0, None, "numeric", None)}
    f = run(spark, adapters.freedom_house(["x"]), spark.createDataFrame([("FIW", "Aland", 1973, "1", "-", "PF")], "sheet string, key string, edition_year int, PR string, CL string, Status string"))
    assert f == {("Aland", 1973, "fiw_political_rights"): (1.0, None, "numeric", {"normalized": "1.0"}), ("Aland", 1973, "fiw_status"): (None, "PF", "categorical", None)}
    w = run(spark, adapters.who(2020), spark.createDataFrame([("AAA", 2020, "X", 1.0), ("AAA", 2020, "X", 2.0)], "iso3 string, year int, indicator string, value double").coalesce(1))
    assert w == {("AAA", 2020, "X"): (1.0, None, "numeric", None)}
    c = run(spark, adapters.cirights(["physint"]), spark.createDataFrame([("Aland", "2022", "2.5"), ("Bland", "2022", "x")], "country string, year string, physint string"))
    assert c == {("Aland", 2022, "physint"): (2.0, None, "numeric", {"proxy_year_for": "2023"})}
    d = run(spark, adapters.wdi({"A": "persons"}), spark.createDataFrame([("AAA", 2020, "A", 5.0, "Aland"), ("WLD", 2020, "A", 9.0, "World"), ("BBB", 2020, "A", None, "B")], "iso3 string, year int, variable string, value double, country_name string"))
    assert list(d) == [("AAA", 2020, "A")]
    a = run(spark, adapters.archigos(), spark.createDataFrame([("o1", "AAA", 2.0, "Ann", "1901-01-01", None, "Regular", None, "F"), ("o1", "AAA", 2.0, " ", "1901-01-01", None, None, None, None)], "obsid string, idacr string, ccode double, leader string, startdate string, enddate string, entry string, exit string, gender string").limit(1))
    assert a["o1", 1901, "archigos_startdate"] == (1901.0, "1901-01-01", "text", None) and len(a) == 5
    with pytest.raises(ValueError, match="duplicate"):
        adapters.pwt(["x"]).transform(spark.createDataFrame([("A", "2000", "1"), ("A", "2000", "2")], "countrycode string, year string, x string"))
    assert adapters.edition_sheet([("BTI 2022", 2019, 2021)], 2020) == "BTI 2022"
    with pytest.raises(readers.SourceError):
        adapters.edition_sheet([], 2020)
    assert adapters.requested_years([2022, 2023, 2020], adapters.Shape("c", (), proxy_from=2023, proxy_to=2022)) == [2020, 2022]
    refs = spark.createDataFrame([("wdi:aaa:2020",), ("x:aaa",), (None,)], "source_row_reference string")
    assert [r.iso3 for r in adapters.link_by_reference(refs, ["wdi"]).collect()] == ["AAA", None, None]


def test_client_rows(spark):
    cells = [("p", "s", r, c, t) for r, row in enumerate([["h"], [], [], [], [], ["aaa", "Ann"], ["bbb", "Bob"], ["bbb", "Eve"]]) for c, t in enumerate(row)]
    df = spark.createDataFrame(cells, "path string, sheet string, row int, column int, text string")
    assert [(r.iso3, r.leader) for r in adapters.client_rows(df, {"iso3": 0, "leader": 1}, ["AAA"]).collect()] == [("AAA", "Ann")]
    with pytest.raises(readers.SourceError, match="BBB"):
        adapters.client_rows(df, {"iso3": 0, "leader": 1}, ["AAA", "BBB"])


def test_slices(spark):
    entities = spark.createDataFrame([("AAA",), ("BBB",)], "iso3 string")
    rows = spark.createDataFrame([("AAA", 2022, "hdi", 0.85), ("AAA", 2023, "control_of_corruption", 0.0), ("BBB", 2023, "hdi", 0.4)], "iso3 string, year int, variable_name string, value double")
    ours = slices.scores(entities, rows, 2023, 2022)
    client = spark.createDataFrame([("AAA", "social", 9), ("AAA", "integrity", 9), ("BBB", "social", 2)], "iso3 string, category string, client_score int")
    got = {(r.iso3, r.category): (r.score, r.is_proxy, r.status, r.review) for r in slices.comparison(ours, client).collect()}
    assert got == {("AAA", "social"): (8, True, "match", True), ("AAA", "integrity"): (5, False, "high_delta", True), ("BBB", "social"): (4, False, "conflict", False), ("BBB", "integrity"): (None, False, "missing", True)}
    series = slices.timeseries(entities, rows, [2022, 2023], 2023, 2022)
    assert {(r.year, r.iso3): r.score for r in series.where("category = 'social'").collect()} == {(2022, "AAA"): 8, (2023, "AAA"): 8, (2022, "BBB"): None, (2023, "BBB"): 4}


def test_star(spark):
    assert len(star.create(spark, "star_db")) == len(star.create(spark, "star_db")) == 11
    row = spark.createDataFrame([(1, "AAA", "Aland", "r", "s")], "id bigint, iso3 string, name string, region string, subregion string")
    star.append(row, "star_db", "countries")
    with pytest.raises(ValueError, match="duplicate"):
        star.append(row, "star_db", "countries")
    assert spark.table("star_db.countries").count() == 1 and star.evidence(spark, "star_db").count() == 0


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "f.csv").write_text("metric_id,year,country_iso3,value,country_name,political_regime,political_regime_bucket,existence_status\nchronicle.population,2020,AAA,5,A,x,y,exists\nchronicle.population,2021,AAA,6,A,x,y,exists\n")
    cli.main(["metrics"])
    assert "chronicle.gdp\tcountry_year" in capsys.readouterr().out
    out = tmp_path / "q.csv"
    cli.main(["query", json.dumps({"metric": "chronicle.population", "aggregation": "sum", "group_by": ["year"]}), "--fact", str(tmp_path / "f.csv"), "--out", str(out)])
    assert sorted(out.read_text().splitlines()[1:]) == ["2020,chronicle.population,5.0,sum,Population,persons", "2021,chronicle.population,6.0,sum,Population,persons"]
    cli.main(["growth-tables", "--fact", str(tmp_path / "f.csv"), "--out", str(tmp_path)])
    assert (tmp_path / "country_year_growth.csv").exists() and F is not None


def test_source_commands(spark, tmp_path, capsys):
    (tmp_path / "cpi.csv").write_text("country,iso3,year,score\nÅland,aaa,2020,40.5\nBland,,2020,1\n")
    cli.main(["check-source", "transparency_cpi", str(tmp_path / "cpi.csv")])
    cli.main(["check-source", "transparency_cpi", str(tmp_path / "none.csv")])
    ready, missing = capsys.readouterr().out.splitlines()
    assert ready == "transparency_cpi\tready" and "none.csv" in missing
    cli.main(["ingest-source", "transparency_cpi", str(tmp_path / "cpi.csv"), str(tmp_path / "obs"), "--manifests", str(tmp_path)])
    assert json.loads((tmp_path / "transparency_cpi.json").read_text())["rows"] == 1
    assert [(r.country_code, r.value, r.source_id) for r in spark.read.parquet(str(tmp_path / "obs")).collect()] == [("AAA", 40.0, "transparency_cpi")]
    (tmp_path / "aliases.csv").write_text("alias,iso3\naland,ALA\n")
    (tmp_path / "names.csv").write_text("country\nÅLAND\nBland\n")
    cli.main(["match-countries", str(tmp_path / "names.csv"), "country", str(tmp_path / "aliases.csv"), "--out", str(tmp_path / "m.csv")])
    assert sorted((tmp_path / "m.csv").read_text(encoding="utf-8").splitlines()) == ["Bland,,unmatched", "country,iso3,match", "ÅLAND,ALA,alias"]
    cli.main(["init-data-lake", str(tmp_path / "lake")])
    assert (tmp_path / "lake" / "raw" / "vdem").is_dir()
    scores = spark.createDataFrame([("AAA", "social", 5, False, 90), ("BBB", "social", None, False, 90)], "iso3 string, category string, score int, is_proxy boolean, confidence int")
    client = spark.createDataFrame([("AAA", "social", 9), ("BBB", "social", 2)], "iso3 string, category string, client_score int")
    scores.write.parquet(str(tmp_path / "scores"))
    client.write.parquet(str(tmp_path / "client"))
    cli.main(["compare", str(tmp_path / "scores"), str(tmp_path / "client"), str(tmp_path / "out")])
    assert "| social | 2 | 1 | 0 | 0 | 1 | 1 | 2 |" in (tmp_path / "out" / "summary.md").read_text()
    assert len((tmp_path / "out" / "review_queue.csv").read_text().splitlines()) == 3
