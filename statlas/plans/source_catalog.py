"""Registered queries of sources, adapters and sinks: the driver's tables are written in a source's format and read by its adapter.

Nations stand for countries: the code of nation k is the k-th letter three times, and a number of country, year and
measure is VALUE. Files of nations are small (25 rows); files of other tables are written by tasks.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlas.functions import scalars as S
from statlas.operators import concepts, evidence, joins, scoring, series
from statlas.plans import facts, slices
from statlas.plans.registered import query
from statlas.sources import adapters, files, readers, sinks, star
from statlas.sources.registry import Registry, Source, long_transform

YEARS = (2019, 2020, 2021, 2022)
CODE = "repeat(chr(65 + n_nationkey), 3)"
_Y = f"(SELECT CAST(unnest({list(YEARS)}) AS INT) AS year) y"
OBSERVED = ("country_code", "country_name", "year", "indicator_code", "value")


def _value_sql(m: int, k: str = "n_nationkey", y: str = "year") -> str:
    return f"(({k} * 7 + {y} * 3 + {m} * 11) % 100) / 10.0"


def value(k: int, year: int, m: int) -> float:
    return (k * 7 + year * 3 + m * 11) % 100 / 10


def _nations(spark: SparkSession, sf_dir: str) -> list[tuple[int, str, str]]:
    """(key, code, name) of each nation: a dimension of 25 rows."""
    return [(r[0], chr(65 + r[0]) * 3, r[1]) for r in facts.table(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey").collect()]


def _file(spark: SparkSession, name: str, content: bytes | str) -> str:
    return files.put(spark, f"{files.folder(spark, 'source')}/{name}", content)


def _run(spark: SparkSession, source: Source, path: str, *columns: str) -> DataFrame:
    registry = Registry()
    registry.add(source)
    return registry.run(spark, source.slug, path).select(*(columns or OBSERVED))


def _csv(header: Sequence[str], rows: Sequence[Sequence[object]], sep: str = ",") -> str:
    return "\n".join(sep.join("" if x is None else str(x) for x in row) for row in [header, *rows]) + "\n"


def _long_sql(code: str, name: str, indicators: dict[str, str], where: str = "true", years: str = _Y) -> str:
    """A union of indicators, each with the SQL of its value; null values are left out."""
    one = "SELECT {c} AS country_code, {n} AS country_name, year, '{i}' AS indicator_code, CAST({v} AS DOUBLE) AS value FROM nation CROSS JOIN {y} WHERE ({v}) IS NOT NULL AND {w}"
    return " UNION ALL ".join(one.format(c=code, n=name, i=i, v=v, y=years, w=where) for i, v in indicators.items())


# Delimited text


@query(_long_sql(CODE, "CAST(NULL AS VARCHAR)", {"v2x_a": "CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE " + _value_sql(1) + " END", "v2x_b": _value_sql(2)}).replace("WHERE (CASE", "WHERE true OR (CASE"))
def adapter_vdem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentinels are null and kept; other columns are not read."""
    rows = [(code.lower(), k, y, -999 if k % 4 == 0 else value(k, y, 1), value(k, y, 2), "x") for k, code, _ in _nations(spark, sf_dir) for y in YEARS]
    path = _file(spark, "vdem.csv", _csv(["country_text_id", "country_id", "year", "v2x_a", "v2x_b", "other"], rows))
    return _run(spark, adapters.vdem(["v2x_a", "v2x_b"]), path)


@query(_long_sql(CODE, "CAST(NULL AS VARCHAR)", {"cpi_score": f"CASE WHEN n_nationkey % 5 <> 0 THEN floor({_value_sql(3)} * 10) END"}, "n_nationkey % 7 <> 0"))
def adapter_transparency_cpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a code go; scores are cut to whole numbers; optional columns may be absent."""
    rows = [(name, code if k % 7 else "", y, None if k % 5 == 0 else value(k, y, 3) * 10) for k, code, name in _nations(spark, sf_dir) for y in YEARS]
    return _run(spark, adapters.transparency_cpi(), _file(spark, "cpi.csv", _csv(["country", "iso3", "year", "score"], rows)))


@query(_long_sql(CODE, "n_name || ' é'", {"undp_hdi_hdi": f"CASE WHEN n_nationkey % 6 <> 0 THEN {_value_sql(4)} END", "undp_hdi_le": _value_sql(5)}, years="(SELECT CAST(unnest([2021, 2022]) AS INT) AS year) y"))
def adapter_undp_hdi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latin-1, a column per prefix and year; 2023 is asked for and taken from 2022."""
    head = ["iso3", "country", *(f"{p}_{y}" for p in ("hdi", "le") for y in YEARS)]
    rows = [(code.lower(), f"{name} é", *("" if k % 6 == 0 else value(k, y, 4) for y in YEARS), *(value(k, y, 5) for y in YEARS)) for k, code, name in _nations(spark, sf_dir)]
    return _run(spark, adapters.undp_hdi(["hdi", "le"], [2021, 2023]), _file(spark, "hdi.csv", _csv(head, rows).encode("latin-1")))


@query(_long_sql(CODE, "CAST(NULL AS VARCHAR)", {"rank": "n_nationkey + 1", "score": f"CASE WHEN n_nationkey % 3 <> 0 THEN {_value_sql(6)} END"}, "n_nationkey % 4 <> 0", "(SELECT 2022 AS year) y"))
def adapter_rsf_press_freedom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semicolons, decimal commas, the Western code page and a header among variants."""
    rows = [(code.lower() if k % 4 else "", k + 1, str(value(k, 2022, 6)).replace(".", ",") if k % 3 else "", f"{name} Côte d’") for k, code, name in _nations(spark, sf_dir)]
    path = _file(spark, "rsf.csv", _csv(["ISO", "Rank N", "Score N", "Pays"], rows, ";").encode("cp1252"))
    return _run(spark, adapters.rsf({"iso3": ["ISO"], "rank": ["Rank", "rank n"], "score": ["Score", "Score N"]}, 2022), path)


@query(
    f"""SELECT n_name AS country_name, 'L' || n_nationkey AS leader_name, year, 'reign_' || v AS indicator_code, CAST(CASE v WHEN 'elected' THEN n_nationkey % 2 ELSE 40 + month END AS DOUBLE) AS value, 'reign:' || n_nationkey || ':' || year || ':' || month || ':L' || n_nationkey || ':' || v AS observation_id
    FROM nation CROSS JOIN {_Y} CROSS JOIN (VALUES (1), (7)) m(month) CROSS JOIN (VALUES ('elected'), ('age')) t(v) WHERE v = 'age' OR n_nationkey % 3 <> 0"""
)
def adapter_reign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per leader and month; empty cells are dropped."""
    rows = [(float(k), name, f"L{k}", y, float(m), k % 2 if k % 3 else "", 40 + m) for k, _, name in _nations(spark, sf_dir) for y in YEARS for m in (1, 7)]
    path = _file(spark, "reign.csv", _csv(["ccode", "country", "leader", "year", "month", "elected", "age"], rows))
    return _run(spark, adapters.reign(["elected", "age"]), path, "country_name", "leader_name", "year", "indicator_code", "value", "observation_id")


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS balance, CAST(c_nationkey AS INT) AS nation, CAST(NULL AS DOUBLE) AS absent FROM customer")
def scan_typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some columns of a text table, one of them malformed in places and one that is not there; written and read by tasks."""
    customer = facts.table(spark, sf_dir, "customer")
    path = files.folder(spark, "csv")
    customer.withColumn("c_acctbal", F.when(F.col("c_custkey") % 10 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))).write.option("header", True).csv(path)
    return readers.csv_columns(spark, path, {"c_custkey": "bigint", "c_name": "string", "c_acctbal": "double", "c_nationkey": "int"}, {"absent": "double"}, rename={"c_acctbal": "balance", "c_nationkey": "nation"})


@query("SELECT c_custkey % 3 = 0 AS dated, CAST(c_custkey AS VARCHAR) AS metric_id, CAST(2000 + c_custkey % 20 AS INT) AS year, c_name AS country_iso3, c_acctbal AS value, strftime(CASE WHEN c_custkey % 3 = 0 THEN DATE '2001-02-03' ELSE make_date(2000 + c_custkey % 20, 1, 1) END, '%Y-%m-%d') AS year_date FROM customer")
def scan_fact_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric fact as text; a missing date is the first of January."""
    customer = facts.table(spark, sf_dir, "customer")
    path = files.folder(spark, "fact")
    dated = F.col("c_custkey") % 3 == 0
    rows = customer.select(F.col("c_custkey").alias("metric_id"), (2000 + F.col("c_custkey") % 20).alias("year"), F.col("c_name").alias("country_iso3"), F.col("c_acctbal").alias("value"), F.when(dated, "2001-02-03").otherwise("").alias("year_date"))
    rows.write.option("header", True).csv(path)
    out = readers.fact_csv(spark, path)
    return out.select((F.col("metric_id").cast("bigint") % 3 == 0).alias("dated"), "metric_id", "year", "country_iso3", "value", F.date_format("year_date", "yyyy-MM-dd").alias("year_date"))


@query("SELECT n_name AS variable_name, 'c' || n_nationkey AS raw_column FROM nation WHERE n_nationkey % 5 <> 0")
def scan_catalog_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog with comment lines and rows without a name."""
    lines = ["# made from nations", "variable_name,raw_column"]
    for k, _, name in _nations(spark, sf_dir):
        lines += [f"# nation {k}", f"{name if k % 5 else ''},c{k}"]
    return readers.catalog(spark, _file(spark, "catalog.csv", "\n".join(lines) + "\n")).select("variable_name", "raw_column")


@query(
    """WITH e AS (SELECT s_nationkey AS c, CAST(2000 + s_suppkey % 5 AS INT) AS year, s_suppkey % 3 + 1 AS kind, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey % 9 END AS best, s_suppkey % 2 = 0 AS two FROM supplier),
    a AS (SELECT c, year, CAST(count(*) FILTER (kind = 1) AS DOUBLE) AS ucdp_state_based_events, coalesce(CAST(sum(best) FILTER (kind = 1) AS DOUBLE), 0) AS ucdp_state_based_fatalities, CAST(count(*) FILTER (kind = 1 AND two) AS DOUBLE) AS ucdp_intl_events, coalesce(CAST(sum(best) FILTER (kind = 1 AND two) AS DOUBLE), 0) AS ucdp_intl_fatalities,
          CAST(count(*) FILTER (kind = 3) AS DOUBLE) AS ucdp_onesided_events, coalesce(CAST(sum(best) FILTER (kind = 3) AS DOUBLE), 0) AS ucdp_onesided_fatalities FROM e GROUP BY ALL),
    g AS (SELECT c, year, coalesce(ucdp_state_based_events, 0) AS ucdp_state_based_events, coalesce(ucdp_state_based_fatalities, 0) AS ucdp_state_based_fatalities, coalesce(ucdp_intl_events, 0) AS ucdp_intl_events, coalesce(ucdp_intl_fatalities, 0) AS ucdp_intl_fatalities, coalesce(ucdp_onesided_events, 0) AS ucdp_onesided_events, coalesce(ucdp_onesided_fatalities, 0) AS ucdp_onesided_fatalities
          FROM (SELECT DISTINCT c FROM a) x CROSS JOIN (SELECT DISTINCT year FROM a) y LEFT JOIN a USING (c, year))
    SELECT CAST(CAST(c AS INT) AS VARCHAR) || '.0' AS country_code, CAST(NULL AS VARCHAR) AS country_name, year, indicator_code, value FROM (UNPIVOT g ON COLUMNS('ucdp_.*') INTO NAME indicator_code VALUE value)"""
)
def adapter_ucdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a CSV in a zip, counted by country and year over the whole grid."""
    supplier = facts.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = ["id,year,country_id,type_of_violence,best,gwnob,note"]
    for r in supplier.toLocalIterator():  # the file is one text, as the source's is
        k = r["s_suppkey"]
        lines.append(f'{k},{2000 + k % 5},{r["s_nationkey"]},{k % 3 + 1},{"" if k % 4 == 0 else k % 9},{9 if k % 2 == 0 else ""},"a, b"')
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("readme.txt", "x")
        archive.writestr("events.csv", "\n".join(lines) + "\n")
    return _run(spark, adapters.ucdp(), _file(spark, "events.zip", made.getvalue()))


# Workbooks


@query(_long_sql(CODE, "CAST(NULL AS VARCHAR)", {"cc": f"CASE WHEN n_nationkey % 5 <> 0 THEN {_value_sql(7)} END", "ge": _value_sql(8)}))
def adapter_world_bank_wgi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet per indicator, years as columns, #N/A for missing."""
    nations = _nations(spark, sf_dir)
    sheet = lambda m, gap: [["Country", "Code", *YEARS], *([name, code.lower(), *("#N/A" if gap and k % 5 == 0 else value(k, y, m) for y in YEARS)] for k, code, name in nations)]
    path = _file(spark, "wgi.xlsx", files.workbook({"Control": sheet(7, True), "Effect": sheet(8, False), "Notes": [["x"]]}))
    return _run(spark, adapters.wgi({"Control": "cc", "Effect": "ge"}), path)


@query(_long_sql("CAST(NULL AS VARCHAR)", "n_name", {"spend": f"CASE WHEN n_nationkey % 4 = 1 THEN NULL WHEN n_nationkey % 4 = 2 THEN NULL ELSE {_value_sql(9)} END"}))
def adapter_sipri_milex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header in the sixth row, regions among the countries, dots and letters for missing."""
    rows: list[list[object]] = [["Military expenditure"], [], [], [], [], ["Country", *YEARS], ["Africa"], ["Asia", *([1.5] * len(YEARS))]]
    for k, _, name in _nations(spark, sf_dir):
        rows.append([name, *({1: ". .", 2: "xxx"}.get(k % 4, value(k, y, 9)) for y in YEARS)])
    return _run(spark, adapters.sipri_milex({"Current": "spend"}, ["Africa", "Asia"]), _file(spark, "sipri.xlsx", files.workbook({"Current": rows})))


@query(_long_sql("CAST(NULL AS VARCHAR)", "n_name", {"q1": _value_sql(10), "q2": f"CASE WHEN n_nationkey % 2 = 0 THEN {_value_sql(11)} END"}, years="(SELECT 2020 AS year) y").replace("year * 3", "2020 * 3"))
def adapter_bti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheet of the edition that covers the year; long notes are no countries."""
    rows = [["Country", "q1", "q2"], *([name, value(k, 2020, 10), value(k, 2020, 11) if k % 2 == 0 else "-"] for k, _, name in _nations(spark, sf_dir)), ["a note that is much too long to be the name of any country " * 2, 1, 1]]
    path = _file(spark, "bti.xlsx", files.workbook({"BTI 2020": [["Country", "q1", "q2"]], "BTI 2022": rows}))
    return _run(spark, adapters.bti(["q1", "q2"], [("BTI 2020", 2017, 2018), ("BTI 2022", 2019, 2021)], 2020), path)


@query(_long_sql(CODE, "CAST(NULL AS VARCHAR)", {"pts_amnesty_score": "n_nationkey % 5 + 1", "pts_human_rights_watch_score": "CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey % 4 + 1 END", "pts_state_dept_score": "CASE WHEN n_nationkey % 7 <= 4 THEN n_nationkey % 7 + 1 END"}))
def adapter_pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings from 1 to 5 that count only with status 0."""
    head = ["COW_Code_A", "Year", "PTS_A", "PTS_H", "PTS_S", "NA_Status_A", "NA_Status_H", "NA_Status_S", "Region"]
    rows = [[code.lower(), y, k % 5 + 1, "NA" if k % 2 else k % 4 + 1, k % 7 + 1, 0, 88 if k % 2 else 0, 0, "x"] for k, code, _ in _nations(spark, sf_dir) for y in YEARS]
    return _run(spark, adapters.pts(), _file(spark, "pts.xlsx", files.workbook({"PTS-2025": [head, *rows]})))


@query(_long_sql("CAST(NULL AS VARCHAR)", "n_name", {"physint": f"CASE WHEN n_nationkey % 3 <> 0 THEN round_even({_value_sql(12)}, 0) END"}))
def adapter_cirights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers, half to even; text is dropped."""
    rows = [[name, y, value(k, y, 12) if k % 3 else "none"] for k, _, name in _nations(spark, sf_dir) for y in YEARS]
    return _run(spark, adapters.cirights(["physint"]), _file(spark, "cirights.xlsx", files.workbook({"Sheet1": [["country", "year", "physint"], *rows]})))


@query(
    f"SELECT * FROM ({_long_sql(CODE, 'CAST(NULL AS VARCHAR)', {'gdppc': _value_sql(13) + ' + 1', 'pop': f'CASE WHEN n_nationkey % 4 <> 0 THEN {_value_sql(14)} + 2 END', 'gdp_total': f'CASE WHEN n_nationkey % 4 <> 0 THEN ({_value_sql(13)} + 1) * ({_value_sql(14)} + 2) * 1000 END'})})"
)
def adapter_maddison_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income per head, population and their product where both are there."""
    rows = [[code, name, "r", y, value(k, y, 13) + 1, value(k, y, 14) + 2 if k % 4 else None] for k, code, name in _nations(spark, sf_dir) for y in YEARS]
    path = _file(spark, "maddison.xlsx", files.workbook({"Full data": [["countrycode", "country", "region", "year", "gdppc", "pop"], *rows]}))
    return _run(spark, adapters.maddison(), path)


@query(_long_sql(CODE, "CAST(NULL AS VARCHAR)", {"rgdpe": _value_sql(15), "pop": f"CASE WHEN n_nationkey % 2 = 0 THEN {_value_sql(16)} END"}).replace("WHERE (CASE", "WHERE true OR (CASE"))
def adapter_pwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that are no numbers stay as nulls; a country and year occurs once."""
    rows = [[code, name, y, value(k, y, 15), value(k, y, 16) if k % 2 == 0 else "n"] for k, code, name in _nations(spark, sf_dir) for y in YEARS]
    return _run(spark, adapters.pwt(["rgdpe", "pop"]), _file(spark, "pwt.xlsx", files.workbook({"Data": [["countrycode", "country", "year", "rgdpe", "pop"], *rows]})))


@query(
    """WITH r AS (SELECT n_name AS country_name, y AS year, n_nationkey % 9 AS pr, (n_nationkey + y) % 7 + 1 AS cl, CASE n_nationkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'PF' WHEN 2 THEN 'NF' END AS st FROM nation CROSS JOIN (VALUES (1973), (1974)) t(y))
    SELECT country_name, year, 'fiw_political_rights' AS indicator_code, CAST(pr AS DOUBLE) AS value, NULL AS value_text, 'numeric' AS value_type FROM r WHERE pr BETWEEN 1 AND 7
    UNION ALL SELECT country_name, year, 'fiw_civil_liberties', cl, NULL, 'numeric' FROM r UNION ALL SELECT country_name, year, 'fiw_status', NULL, st, 'categorical' FROM r WHERE st IS NOT NULL"""
)
def adapter_freedom_house(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns an edition; ratings out of 1 to 7 are dropped, status is categorical."""
    rows: list[list[object]] = [[None, "1973", None, None, "Jan.-Feb. 1974"], ["x"], ["Country", "PR", "CL", "Status", "PR", "CL", "Status"]]
    for k, _, name in _nations(spark, sf_dir):
        rows.append([name, *(x for y in (1973, 1974) for x in (k % 9, (k + y) % 7 + 1, {0: "F", 1: "PF", 2: "NF"}.get(k % 4, "-")))])
    path = _file(spark, "fiw.xlsx", files.workbook({"Territories": rows}))
    return _run(spark, adapters.freedom_house(["Territories"]), path, "country_name", "year", "indicator_code", "value", "value_text", "value_type")


@query(f"SELECT {CODE} AS iso3, 'Leader ' || n_nationkey AS leader, CAST(n_nationkey AS VARCHAR) AS score FROM nation WHERE n_nationkey % 2 = 0")
def client_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed columns of a matrix below five header rows, for a scope of codes."""
    nations = _nations(spark, sf_dir)
    rows = [["h"], [], [], [], [], *([code.lower(), f"Leader {k}", k] for k, code, _ in nations)]
    cells = readers.xlsx_cells(spark, _file(spark, "client.xlsx", files.workbook({"M": rows})), ["M"])
    return adapters.client_rows(cells, {"iso3": 0, "leader": 1, "score": 2}, [code for k, code, _ in nations if k % 2 == 0])


@query(
    f"""SELECT {CODE} AS country_code, year, v AS indicator_code, CAST(CASE v WHEN 'a' THEN CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey END ELSE year - 2000 END AS DOUBLE) AS value, CASE v WHEN 'a' THEN CASE WHEN n_nationkey % 3 = 0 THEN 'NA ' || n_nationkey ELSE n_nationkey || '*' END ELSE CAST(year - 2000 AS VARCHAR) END AS raw_value FROM nation CROSS JOIN {_Y} CROSS JOIN (VALUES ('a'), ('b')) t(v)"""
)
def raw_text_beside_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each value with the original text of its cell, from one pass over the sheet."""
    rows = [[code, y, f"NA {k}" if k % 3 == 0 else f"{k}*", y - 2000] for k, code, _ in _nations(spark, sf_dir) for y in YEARS]
    cells = readers.xlsx_cells(spark, _file(spark, "raw.xlsx", files.workbook({"S": [["code", "year", "a", "b"], *rows]})))
    wide = readers.sheet_table(cells, ["code", "year", "a", "b"])
    return adapters.with_raw_text(wide, "code", ["a", "b"], lambda c: S.to_double(F.regexp_replace(c, r"\*$", "")))


# Stata, JSON, HTML


@query(
    """WITH s AS (SELECT 'o' || n_nationkey AS leader_id, 'Leader ' || n_nationkey AS leader_name, 1900 + n_nationkey AS year, make_date(1900 + n_nationkey, 3, 1) AS d, CASE WHEN n_nationkey % 2 = 0 THEN 'Regular' END AS entry FROM nation)
    SELECT leader_id, leader_name, CAST(year AS INT) AS year, 'archigos_startdate' AS indicator_code, round(year + (dayofyear(d) - 1) / 365.0, 6) AS value, strftime(d, '%Y-%m-%d') AS value_text FROM s
    UNION ALL SELECT leader_id, leader_name, year, 'archigos_enddate', round(year + 4 + (dayofyear(d + INTERVAL 4 YEAR) - 1) / 365.0, 6), strftime(d + INTERVAL 4 YEAR, '%Y-%m-%d') FROM s UNION ALL SELECT leader_id, leader_name, year, 'archigos_entry', NULL, entry FROM s UNION ALL SELECT leader_id, leader_name, year, 'archigos_exit', NULL, NULL FROM s UNION ALL SELECT leader_id, leader_name, year, 'archigos_gender', NULL, 'F' FROM s"""
)
def adapter_archigos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spells of a Stata file, a row per fact with its raw text."""
    nations = _nations(spark, sf_dir)
    frame = pd.DataFrame(
        {
            "obsid": [f"o{k}" for k, _, _ in nations],
            "idacr": [code for _, code, _ in nations],
            "ccode": [float(k) for k, _, _ in nations],
            "leader": [f"Leader {k}" for k, _, _ in nations],
            "startdate": [f"{1900 + k}-03-01" for k, _, _ in nations],
            "enddate": [f"{1904 + k}-03-01" for k, _, _ in nations],
            "entry": ["Regular" if k % 2 == 0 else "" for k, _, _ in nations],
            "exit": ["" for _ in nations],
            "gender": ["F" for _ in nations],
        }
    )
    made = io.BytesIO()
    frame.to_stata(made, write_index=False)
    out = _run(spark, adapters.archigos(), _file(spark, "archigos.dta", made.getvalue()), "leader_id", "leader_name", "year", "indicator_code", "value", "value_text")
    return out.withColumn("value", F.round("value", 6))


@query(_long_sql(CODE, "n_name", {"SP.POP": f"CASE WHEN n_nationkey % 3 <> 0 THEN {_value_sql(17)} END", "NY.GDP": _value_sql(18)}, "n_nationkey <> 4"))
def adapter_world_bank_wdi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of records; aggregates and nulls are dropped, so are records without a code and broken pages."""
    pages = files.folder(spark, "wdi")
    nations = _nations(spark, sf_dir)
    for m, indicator in ((17, "SP.POP"), (18, "NY.GDP")):
        rows = [{"indicator": {"id": indicator, "value": "x"}, "country": {"id": code[:2], "value": "World" if k == 4 else name}, "countryiso3code": code, "date": str(y), "value": None if m == 17 and k % 3 == 0 else value(k, y, m), "unit": "", "obs_status": "", "decimal": 0} for k, code, name in nations for y in YEARS]
        files.put(spark, f"{pages}/{indicator}.json", json.dumps([{"page": 1}, [*rows, rows[0] | {"countryiso3code": ""}]]))
    files.put(spark, f"{pages}/broken.json", "{")
    return _run(spark, adapters.wdi({"SP.POP": "persons"}), pages)


@query(_long_sql(CODE, "CAST(NULL AS VARCHAR)", {"WHS4": f"CASE WHEN n_nationkey % 4 <> 0 THEN {_value_sql(19)} END"}, years="(SELECT 2019 AS year) y").replace("year * 3", "2019 * 3"))
def adapter_who_gho_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country rows of an OData page; the first of repeated rows wins."""
    rows = []
    for k, code, _ in _nations(spark, sf_dir):
        one = {"IndicatorCode": "WHS4", "SpatialDimType": "COUNTRY", "SpatialDim": code, "TimeDim": 2018, "NumericValue": value(k, 2019, 19) if k % 4 else None}
        rows += [one, one | {"NumericValue": -1.0}, one | {"SpatialDimType": "REGION"}, one | {"SpatialDim": code[:2]}]
    return _run(spark, adapters.who(2019), _file(spark, "who.json", json.dumps({"value": rows})))


@query("SELECT 'Q' || n_nationkey AS person, CASE WHEN n_nationkey % 3 <> 0 THEN 'P' || n_nationkey END AS office, (1950 + n_nationkey) || '-02-03T00:00:00Z' AS start, CAST(1950 + n_nationkey AS INT) AS start_year FROM nation")
def scan_sparql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bindings with entity addresses, some of them without an office."""
    bindings = []
    for k, _, _ in _nations(spark, sf_dir):
        office = {"office": {"type": "uri", "value": f"http://x.org/entity/P{k}"}} if k % 3 else {}
        bindings.append({"person": {"type": "uri", "value": f"http://x.org/entity/Q{k}"}, "start": {"type": "literal", "value": f"{1950 + k}-02-03T00:00:00Z"}} | office)
    path = _file(spark, "sparql.json", json.dumps({"results": {"bindings": bindings}}))
    return readers.sparql_bindings(spark, path, ["person", "office", "start"]).drop("raw_json")


@query("SELECT CASE WHEN n_nationkey % 4 <> 0 THEN CAST(n_nationkey AS BIGINT) END AS page_id, n_name AS title, 'about ' || n_name AS extract, CAST(n_nationkey AS INT) AS position, 'a ' || n_name AS snippet FROM nation")
def scan_wiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts by page (ids that are not positive are null) next to the search results of the same titles."""
    nations = _nations(spark, sf_dir)
    pages = {str(k if k % 4 else -k - 1): {"pageid": k if k % 4 else -k - 1, "ns": 0, "title": name, "extract": f"about {name}"} for k, _, name in nations}
    search = [{"title": name, "pageid": k, "size": 1, "wordcount": 2, "snippet": f"a <span>{name}</span>"} for k, _, name in nations]
    path = _file(spark, "wiki.json", json.dumps({"query": {"pages": pages | {"x": {"pageid": 3}}, "search": search}}))
    found = readers.wiki_search(spark, path).select("title", F.col("position").cast("int").alias("position"), "snippet")
    return readers.wiki_pages(spark, path).join(found, "title").select("page_id", "title", "extract", "position", "snippet")


_STOCKS = {"fas_total": "n_nationkey * 100 + 1044", "fas_ready": "CASE WHEN n_nationkey % 2 = 0 THEN 15 + n_nationkey END"}


@query(_long_sql("CAST(NULL AS VARCHAR)", "n_name", _STOCKS, "n_nationkey % 3 <> 0", "(SELECT 2024 AS year) y"))
def adapter_fas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a page's table: tags, commas, signs and ranges; only listed countries."""
    nations = _nations(spark, sf_dir)
    rows = "".join(f"<tr><td><a href=x>{name}</a></td><td>~{k * 100 + 1044:,}<sup>a</sup></td><td>{f'{10 + k}–{20 + k}' if k % 2 == 0 else 'n.a.'}</td></tr>" for k, _, name in nations)
    path = _file(spark, "fas.html", f'<html><table id="table1"><tr><td>small</td></tr></table><table id="table1"><tr><th>Country</th></tr>{rows}</table></html>')
    return _run(spark, adapters.warhead_table("fas", [name for k, _, name in nations if k % 3], ["total", "ready"], 2024), path)


@query(_long_sql("CAST(NULL AS VARCHAR)", "n_name", {"sipri_yearbook_ch7_total": "CASE WHEN n_nationkey % 3 = 0 THEN 0 WHEN n_nationkey % 3 = 1 THEN n_nationkey * 10 END"}, years="(SELECT 2024 AS year) y"))
def adapter_sipri_yearbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells taken from a report's table: a dash is zero, two dots are missing, footnote letters go."""
    nations = _nations(spark, sf_dir)
    rows = [(name, {0: "–", 1: f"c. {k * 10}a", 2: ".."}[k % 3]) for k, _, name in nations]
    return _run(spark, adapters.warhead_table("sipri_yearbook_ch7", [name for _, _, name in nations], ["total"], 2024, extracted=True), _file(spark, "yearbook.csv", _csv(["Country", "total"], rows)))


# Registry, repository and star


def _two_sources(spark: SparkSession, sf_dir: str) -> tuple[Registry, dict[str, str]]:
    nations = _nations(spark, sf_dir)
    registry = Registry()
    registry.add(adapters.maddison())
    registry.add(adapters.pwt(["pop"]))
    a = [[code, name, "r", y, value(k, y, 13) + 1, None] for k, code, name in nations for y in YEARS]
    b = [[code, name, y, value(k, y, 16) if k % 2 else "n"] for k, code, name in nations for y in YEARS]
    paths = {
        "maddison_project": _file(spark, "m.xlsx", files.workbook({"Full data": [["countrycode", "country", "region", "year", "gdppc", "pop"], *a]})),
        "pwt": _file(spark, "p.xlsx", files.workbook({"Data": [["countrycode", "country", "year", "pop"], *b]})),
    }
    return registry, paths


_ALL = f"SELECT 'maddison_project' AS source_id, {CODE} AS country_code, year, 'gdppc' AS indicator_code, CAST({_value_sql(13)} + 1 AS DOUBLE) AS value FROM nation CROSS JOIN {_Y} UNION ALL SELECT 'pwt', {CODE}, year, 'pop', CASE WHEN n_nationkey % 2 = 1 THEN CAST({_value_sql(16)} AS DOUBLE) END FROM nation CROSS JOIN {_Y}"


@query(_ALL)
def all_adapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations of all registered sources."""
    registry, paths = _two_sources(spark, sf_dir)
    return registry.run_all(spark, paths).select("source_id", "country_code", "year", "indicator_code", "value")


@query(f"WITH a AS ({_ALL}) SELECT source_id, CAST(count(*) AS BIGINT) AS n_rows, min(year) AS first_year, max(year) AS last_year FROM a WHERE year BETWEEN 2020 AND 2021 AND country_code IN ('BBB', 'CCC', 'DDD') GROUP BY source_id")
def investigation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One concept over several sources, countries and years, counted by source."""
    registry, paths = _two_sources(spark, sf_dir)
    mapping = spark.createDataFrame([("size", "maddison_project", "gdppc"), ("size", "pwt", "pop"), ("other", "pwt", "x")], "concept string, source_id string, indicator_code string")
    return slices.investigation(registry, spark, paths, mapping, "size", ["BBB", "CCC", "DDD"], (2020, 2021))[1]


@query(f"WITH a AS ({_ALL}) SELECT source_id, country_code, year, 'size' AS concept, value, CASE WHEN value IS NULL THEN 'missing' ELSE 'numeric' END AS value_type, CASE WHEN value IS NULL THEN 'non_numeric_value' END AS warning FROM a")
def concept_rows_and_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, paths = _two_sources(spark, sf_dir)
    mapping = spark.createDataFrame([("size", "maddison_project", "gdppc"), ("size", "pwt", "pop")], "concept string, source_id string, indicator_code string")
    return concepts.direct(registry.run_all(spark, paths), mapping).select("source_id", "country_code", "year", "concept", "value", "value_type", "warning")


@query(f"SELECT {CODE} AS country_code, CAST(n_nationkey AS DOUBLE) AS value FROM nation WHERE n_nationkey IN (1, 3)")
def in_memory_repository(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows held in memory are asked like any other table; a country is found in any case, by code or name."""
    rows = [("s", code, name, 2020, float(k)) for k, code, name in _nations(spark, sf_dir)]
    held = spark.createDataFrame(rows, "source_id string, country_code string, country_name string, year int, value double")
    return evidence.matching(held, {"country": ("bbb", "nation_3"), "source": ("s",), "year": (2020,)}).select("country_code", "value")


@query("SELECT s_suppkey, CAST(s_nationkey AS BIGINT) AS source_id, 'source ' || s_nationkey AS source_name, repeat(chr(65 + s_nationkey), 3) AS iso3, CAST(2000 + s_suppkey % 9 AS INT) AS year, s_acctbal AS normalized_value FROM supplier")
def star_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of the star are made, filled and joined: an observation with its source's name and its country's code."""
    database = "statlas_star_queries"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    star.create(spark, database)
    null = lambda kind: F.lit(None).cast(kind)
    key = F.col("n_nationkey").cast("bigint")
    nation = facts.table(spark, sf_dir, "nation")
    code = F.repeat(F.char((F.lit(65) + F.col("n_nationkey")).cast("bigint")), 3)
    star.append(nation.select(key.alias("id"), code.alias("iso3"), F.col("n_name").alias("name"), null("string").alias("region"), null("string").alias("subregion")), database, "countries")
    star.append(nation.select(key.alias("id"), F.concat(F.lit("source "), key).alias("name"), F.lit("1").alias("version"), *(null("string").alias(c) for c in ("url", "license", "attribution"))), database, "sources")
    own = F.col("s_nationkey").cast("bigint")
    cells = {"id": F.col("s_suppkey"), "source_id": own, "country_id": own, "year": (2000 + F.col("s_suppkey") % 9).cast("int"), "variable_name": F.lit("balance"), "normalized_value": F.col("s_acctbal")}
    kinds = {f.name: f.dataType for f in spark.table(f"{database}.source_observations").schema.fields}
    rows = facts.table(spark, sf_dir, "supplier").select(*(cells.get(c, F.lit(None)).cast(k).alias(c) for c, k in kinds.items()))
    star.append(rows, database, "source_observations")
    return star.evidence(spark, database).select(F.col("id").alias("s_suppkey"), "source_id", "source_name", "iso3", "year", "normalized_value")


# Sinks


@query("SELECT o_orderstatus AS source_id, CAST(year(o_orderdate) AS INT) AS year, CAST(count(*) AS BIGINT) AS n, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2)) * CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) = 1998 THEN 2 ELSE 1 END) AS DOUBLE), 2) AS total FROM orders GROUP BY ALL")
def sink_replace_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status and year; one source and year is written again twice, with doubled amounts, and replaces only itself."""
    path = files.folder(spark, "replaced")
    orders = facts.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("source_id"), F.year("o_orderdate").alias("year"), facts.money().alias("amount"))
    sinks.replace_partitions(orders, path)
    for _ in range(2):
        sinks.replace_partitions(orders.where("source_id = 'F' and year = 1998").withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)")), path)
    return spark.read.parquet(path).groupBy("source_id", "year").agg(F.count("*").alias("n"), F.round(F.sum("amount").cast("double"), 2).alias("total"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'new', NULL FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 = 0")
def sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-null fields of changes win, new keys are added, fields that changes do not have stay."""
    customer = facts.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    changes = customer.where("c_custkey % 3 = 0").select("c_custkey", F.lit("new").alias("c_mktsegment"), F.lit(None).cast("double").alias("c_acctbal"))
    return sinks.upserted(customer.where("c_custkey % 2 = 0"), changes, ["c_custkey"])


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'x:' || c_custkey END AS notes FROM customer WHERE c_custkey % 4 <> 1")
def slice_owned_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a run tagged go; others and those without a note stay."""
    key = F.col("c_custkey")
    notes = F.when(key % 4 == 1, F.concat(F.lit("run:"), key)).when(key % 4 != 0, F.concat(F.lit("x:"), key))
    return sinks.without_tagged(facts.table(spark, sf_dir, "customer").select("c_custkey", notes.alias("notes")), "notes", "run:")


@query("SELECT 'orders' AS source, CAST(count(*) AS BIGINT) AS rows, CAST(min(year(o_orderdate)) AS BIGINT) AS first_year, CAST(max(year(o_orderdate)) AS BIGINT) AS last_year, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS indicators FROM orders")
def sink_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's manifest, as its JSON says it."""
    orders = facts.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("indicator_code"))
    found = sinks.run_manifest(orders, "orders")
    text = spark.createDataFrame([(json.dumps(found, sort_keys=True),)], "value string")
    row = F.from_json("value", "source string, rows bigint, first_year bigint, last_year bigint, indicators array<string>").alias("r")
    return text.select(row).select("r.source", "r.rows", "r.first_year", "r.last_year", F.array_join("r.indicators", "|").alias("indicators"))


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 5 <> 0 THEN round(s_acctbal, 2) END AS balance FROM supplier")
def sink_csv_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table as CSV in parts, written by tasks, with the column order and formats asked for; nulls are empty."""
    path = files.folder(spark, "parts")
    supplier = facts.table(spark, sf_dir, "supplier").withColumn("balance", F.when(F.col("s_suppkey") % 5 != 0, F.col("s_acctbal")))
    sinks.write_csv_parts(supplier, path, ["s_suppkey", "s_name", "balance"], {"balance": "%.2f"})
    return readers.csv_columns(spark, path, {"s_suppkey": "bigint", "s_name": "string", "balance": "double"})


@query("SELECT n_name AS country_iso3, CASE WHEN n_nationkey % 3 = 0 THEN 'NA' ELSE CAST(n_nationkey % 10 + 1 AS VARCHAR) END AS score_1_10, CASE WHEN n_nationkey % 3 = 0 THEN 'NA' ELSE printf('%.4f', n_nationkey / 32.0) END AS normalized_score, 'a|b' AS flags FROM nation")
def sink_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores as text cells: NA without a score, four decimals."""
    key = F.col("n_nationkey")
    scored = key % 3 != 0
    rows = facts.table(spark, sf_dir, "nation").select(F.col("n_name").alias("country_iso3"), F.lit("c").alias("category"), F.when(scored, key / 32.0).alias("normalized_score"), F.when(scored, (key % 10 + 1).cast("int")).alias("score_1_10"), F.lit("a|b").alias("flags"))
    return sinks.score_rows(rows).drop("category")


@query("SELECT CAST(p_partkey AS VARCHAR) AS iso3, CAST(1990 + p_partkey % 30 AS BIGINT) AS year, CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice END AS gdp, p_size > 25 AS multiple_rulers FROM part")
def sink_typed_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV of text saved as a table with stated types; cells that do not fit are null."""
    path = files.folder(spark, "bundle")
    part = facts.table(spark, sf_dir, "part")
    price = F.when(F.col("p_partkey") % 3 != 0, F.col("p_retailprice").cast("string")).otherwise("unknown")
    part.select(F.col("p_partkey").alias("iso3"), (1990 + F.col("p_partkey") % 30).alias("year"), price.alias("gdp"), F.when(F.col("p_size") > 25, "true").otherwise("0").alias("multiple_rulers")).write.option("header", True).csv(path)
    sinks.save_typed(spark, path, "statlas_bundle_queries.chronicle", {"iso3": "string", "year": "bigint", "gdp": "double", "multiple_rulers": "boolean"})
    return spark.table("statlas_bundle_queries.chronicle")


@query("SELECT p_partkey, p_name FROM part")
def sink_parquet_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parquet table that keeps a column's metadata; only a table that still has it gives rows."""
    path = files.folder(spark, "described")
    sinks.with_metadata(facts.table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", {"attribution": "parts"}).write.parquet(path)
    back = spark.read.parquet(path)
    return back if back.schema["p_name"].metadata == {"attribution": "parts"} else back.where("false")


# Evidence and scalars


@query(
    """WITH ex AS (SELECT c_custkey AS country, v FROM customer CROSS JOIN (VALUES ('a'), ('b'), ('c')) t(v)), ob AS (SELECT country, v FROM ex WHERE (country + ascii(v)) % 3 = 0 OR country % 5 = 0), gone AS (SELECT country, v, CASE v WHEN 'c' THEN 'source_not_implemented' ELSE 'target_year_absent' END AS reason FROM ex ANTI JOIN ob USING (country, v)),
    r AS (SELECT country, reason, count(*) AS n FROM gone GROUP BY ALL), s AS (SELECT country, CAST(sum(n) AS BIGINT) AS n_missing, string_agg(reason || '=' || n, '|' ORDER BY reason || '=' || n) AS by_reason FROM r GROUP BY country)
    SELECT c_custkey AS country, 3::BIGINT AS n_expected, CAST((SELECT count(*) FROM ob WHERE ob.country = c_custkey) AS BIGINT) AS n_observed, coalesce(n_missing, 0) AS n_missing, coalesce(by_reason, '') AS by_reason, (SELECT count(DISTINCT v) FROM ob WHERE ob.country = c_custkey) >= 2 AS viable FROM customer LEFT JOIN s ON s.country = c_custkey"""
)
def missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of expected, observed and missing indicators by country, and whether at least two sources know it."""
    plan = spark.createDataFrame([("a", "s1", "required"), ("b", "s2", "preferred"), ("c", "s3", "fallback")], "variable_name string, source_id string, role string")
    expected = facts.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("country")).crossJoin(F.broadcast(plan))
    observed = expected.where(((F.col("country") + F.ascii("variable_name")) % 3 == 0) | (F.col("country") % 5 == 0))
    known = spark.createDataFrame([("s1",), ("s2",)], "source_id string")
    gone = evidence.missing_indicators(expected, observed, known, ["country"])
    out = evidence.missingness_summary(expected, observed, gone, ["country"]).join(evidence.minimum_viable(observed, ["country"], 2), "country", "left")
    return out.withColumn("viable", F.coalesce("viable", F.lit(False)))


@query(
    """WITH v AS (SELECT o_custkey AS country_iso3, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'g1' ELSE 'g2' END AS g, o_totalprice / 1000000 AS x FROM orders)
    SELECT country_iso3, o_orderkey, round(CASE g WHEN 'g1' THEN 0.6 ELSE 0.4 END / count(*) OVER (PARTITION BY country_iso3, g), 9) AS component_weight, round(CASE g WHEN 'g1' THEN 0.6 ELSE 0.4 END / count(*) OVER (PARTITION BY country_iso3, g) * x + 0.00000011, 6) AS contribution FROM v"""
)
def component_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each value's share of its group's weight and what it adds to the score."""
    orders = facts.table(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_custkey").alias("country_iso3"), "o_orderkey", F.lit("c").alias("category"), F.when(F.col("o_orderstatus") == "F", "g1").otherwise("g2").alias("rubric_group"), (F.col("o_totalprice") / 1000000).alias("normalized_value"))
    weights = spark.createDataFrame([("c", "g1", 0.6), ("c", "g2", 0.4)], "category string, rubric_group string, weight double")
    out = scoring.components(rows, weights, ["country_iso3"])
    return out.select("country_iso3", "o_orderkey", S.rounded(F.col("component_weight"), 9).alias("component_weight"), S.rounded(F.col("contribution") + 0.00000011, 6).alias("contribution"))


@query("SELECT n_nationkey, 'r2' AS run_id FROM nation WHERE n_nationkey = 3")
def manifest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of one run of a source that has several."""
    runs = facts.table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("s"), F.col("n_nationkey")).alias("source_id"), F.explode(F.array(F.lit("r1"), F.lit("r2"))).alias("run_id"))
    return evidence.one_manifest(runs, "s3", "r2").select("n_nationkey", "run_id")


@query("SELECT s_suppkey, CASE WHEN contains(lower(s_name), '7') THEN NULL WHEN contains(lower(s_name), '00001') THEN 'first' WHEN contains(lower(s_name), '0000') THEN 'few' WHEN contains(lower(s_name), 'supp') THEN 'other' END AS source FROM supplier")
def source_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key by the first needle that a name holds, unless it holds an excluded word."""
    key = joins.source_key(F.col("s_name"), [("00001", "first"), ("0000", "few"), ("supp", "other")], ["7"])
    return facts.table(spark, sf_dir, "supplier").select("s_suppkey", key.alias("source"))


@query("SELECT n_name, CASE n_name WHEN 'NATION_7' THEN 0 WHEN 'NATION_2' THEN 1 ELSE 3 END::INT AS position FROM nation WHERE n_name IN ('NATION_7', 'NATION_2', 'NATION_9')")
def in_request_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries in the order in which they were asked for; unknown ones are skipped."""
    out = joins.in_request_order(facts.table(spark, sf_dir, "nation").select("n_name"), "n_name", ["NATION_7", "NATION_2", "NOWHERE", "NATION_9"])
    return out.select("n_name", F.col("position").cast("int").alias("position"))


@query(
    """SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS DOUBLE) END AS vdem, CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS INT) END AS strict, CASE WHEN p_size % 3 = 1 THEN CAST(p_size AS INT) END AS lenient, CAST(CASE p_size % 4 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE p_size END AS INT) AS footnoted,
    CASE WHEN p_size % 7 BETWEEN 1 AND 5 AND p_partkey % 2 = 0 THEN CAST(p_size % 7 AS INT) END AS rating, CAST(round_even(p_size / 2.0, 0) AS INT) AS rounded, CASE WHEN p_size % 2 = 0 THEN 'ABC' END AS iso3, CAST(1990 + p_size AS INT) AS edition, 'hdi' AS prefix, CAST(1950 + p_size AS INT) AS prefix_year, 'wdi:ABC:' || (1950 + p_size) || ':SP.POP_' || p_size AS ref,
    CAST(CASE WHEN p_size % 3 = 0 THEN p_size WHEN p_size % 3 = 1 THEN p_size * 1000 ELSE p_size * 10000 END AS DOUBLE) AS people FROM part"""
)
def scalar_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells as the sources write them, read by the scalar functions."""
    n = F.col("p_size")
    text = n.cast("string")
    pieces = S.prefix_and_year(F.concat(F.lit("hdi_"), (1950 + n).cast("string")))
    own = lambda k: F.when(n % 3 == k, n.cast("double"))
    return facts.table(spark, sf_dir, "part").select(
        "p_partkey",
        S.vdem_double(F.when(n % 4 == 0, "-999").otherwise(text)).alias("vdem"),
        S.strict_int(F.when(n % 3 == 0, F.concat(text, F.lit("x"))).otherwise(text)).alias("strict"),
        S.lenient_int(F.when(n % 3 == 0, "-").when(n % 3 == 1, F.concat(text, F.lit(".75"))).otherwise(F.concat(F.lit("-"), text))).alias("lenient"),
        S.footnoted_int(F.when(n % 4 == 0, "–").when(n % 4 == 1, "..").otherwise(F.concat(F.lit("c. "), text, F.lit("b")))).alias("footnoted"),
        S.rating_by_status((n % 7).cast("double"), (F.col("p_partkey") % 2).cast("double")).alias("rating"),
        S.rounded_int(n / 2).alias("rounded"),
        S.iso3(F.when(n % 2 == 0, " abc ").otherwise("ab1")).alias("iso3"),
        S.edition_year(F.concat(F.lit("Jan.-Dec. "), (1990 + n).cast("string"))).alias("edition"),
        pieces["prefix"].alias("prefix"),
        pieces["year"].alias("prefix_year"),
        S.reference(F.lit("wdi"), F.lit("ABC"), 1950 + n, F.concat(F.lit("SP.POP "), text)).alias("ref"),
        series.population_units(own(0), own(1), own(2)).alias("people"),
    )


@query(f"SELECT {CODE} AS country_code, 2020 AS year, 'a' AS indicator_code, CAST(n_nationkey AS DOUBLE) AS value, 'demo:' || {CODE} || ':2020:a' AS observation_id FROM nation WHERE n_nationkey % 2 = 0")
def adapter_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source of one's own: readiness, read, transform, ids."""
    nation = facts.table(spark, sf_dir, "nation")
    code = F.repeat(F.char((F.lit(65) + F.col("n_nationkey")).cast("bigint")), 3)
    frame = nation.select(code.alias("iso3"), F.lit(2020).alias("year"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey").cast("double")).alias("a"))
    source = Source("demo", lambda s, p: frame, long_transform("iso3", "year", ["a"]), lambda s, p: None if p else "no path")
    return _run(spark, source, "x", "country_code", "year", "indicator_code", "value", "observation_id")


@query(
    """WITH a(alias, iso3) AS (SELECT CASE WHEN n_nationkey % 5 = 0 THEN 'Land' ELSE 'Land ' || n_nationkey END, repeat(chr(65 + n_nationkey), 3) FROM nation WHERE n_nationkey % 3 <> 0)
    SELECT c_custkey, CASE WHEN c_nationkey % 3 <> 0 AND c_nationkey % 5 <> 0 THEN repeat(chr(65 + c_nationkey), 3) END AS iso3, CASE WHEN c_nationkey % 5 = 0 THEN 'ambiguous' WHEN c_nationkey % 3 = 0 THEN 'unmatched' ELSE 'alias' END AS match FROM customer"""
)
def country_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in other letters, accents and signs are matched by plain names; a name of several countries is ambiguous."""
    key = F.col("n_nationkey")
    name = lambda k, accent: F.when(k % 5 == 0, f"L{accent}nd").otherwise(F.concat(F.lit(f"L{accent}nd-"), k))
    code = F.repeat(F.char((F.lit(65) + key).cast("bigint")), 3)
    aliases = facts.table(spark, sf_dir, "nation").where(key % 3 != 0).select(name(key, "a").alias("alias"), code.alias("iso3"))
    customers = facts.table(spark, sf_dir, "customer").select("c_custkey", F.upper(name(F.col("c_nationkey"), "å")).alias("country"))
    return joins.matched_countries(customers, "country", aliases).drop("country")


@query(
    """WITH c AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE 'b' END AS category, CASE WHEN p_size % 7 <> 0 THEN p_size % 11 END AS score, p_partkey % 11 AS client, p_partkey % 101 AS confidence FROM part)
    SELECT category, CAST(count(*) AS BIGINT) AS entities, CAST(count(score) AS BIGINT) AS scored, CAST(count(*) FILTER (abs(score - client) <= 1) AS BIGINT) AS match, CAST(count(*) FILTER (abs(score - client) = 2) AS BIGINT) AS conflict, CAST(count(*) FILTER (abs(score - client) > 2) AS BIGINT) AS high_delta, CAST(count(*) FILTER (score IS NULL) AS BIGINT) AS missing,
    CAST(count(*) FILTER (score IS NULL OR abs(score - client) > 2 OR confidence < 60) AS BIGINT) AS review FROM c GROUP BY category"""
)
def slice_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by category of a comparison, as the summary's table shows them."""
    key, size = F.col("p_partkey"), F.col("p_size")
    rows = facts.table(spark, sf_dir, "part").select(key.alias("iso3"), F.when(key % 2 == 0, "a").otherwise("b").alias("category"), F.when(size % 7 != 0, (size % 11).cast("int")).alias("score"), F.lit(False).alias("is_proxy"), (key % 101).cast("int").alias("confidence"))
    client = facts.table(spark, sf_dir, "part").select(key.alias("iso3"), F.when(key % 2 == 0, "a").otherwise("b").alias("category"), (key % 11).cast("int").alias("client_score"))
    return slices.summary(slices.comparison(rows, client))
