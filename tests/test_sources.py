"""Readers on small files of each format, the registry, sinks and streams."""

from __future__ import annotations

import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from statlas.sources import cache, readers, sinks
from statlas.sources.registry import NotReady, Registry, Source, long_transform
from statlas.streaming import ingest


def test_typed_csv(spark, tmp_path):
    path = str(tmp_path / "v.csv")
    (tmp_path / "v.csv").write_text("﻿iso,year,x\nAAA,2020,1.5\nBBB,2021,NA\n", encoding="utf-8")
    df = readers.csv_columns(spark, path, {"iso": "string", "year": "int"}, {"x": "double", "y": "double"}, rename={"iso": "iso3"})
    assert [tuple(r) for r in df.collect()] == [("AAA", 2020, 1.5, None), ("BBB", 2021, None, None)]
    with pytest.raises(readers.SourceError):
        readers.csv_columns(spark, path, {"z": "double"})


def test_press_freedom(spark, tmp_path):
    variants = {"iso3": ["ISO"], "rank": ["Rank N", "Rank"], "score": ["Score N", "Score"]}
    (tmp_path / "a.csv").write_bytes("ISO;Rank;Score;Pays\nfra;26;78,5;Côté\n;1;2;x\nDEU;nan;;y\n".encode("cp1252"))
    (tmp_path / "b.csv").write_text("Score N;ISO\n10,5;NOR\n", encoding="utf-8-sig")
    assert [tuple(r) for r in readers.press_freedom(spark, str(tmp_path / "a.csv"), variants).collect()] == [("FRA", 26, 78.5), ("DEU", None, None)]
    assert [tuple(r) for r in readers.press_freedom(spark, str(tmp_path / "b.csv"), variants).collect()] == [("NOR", None, 10.5)]


def test_wide_years(spark):
    df = spark.createDataFrame([("AAA", "0.5", "", "x")], "iso3 string, hdi_2020 string, hdi_2021 string, junk string")
    assert [tuple(r) for r in readers.wide_years(df, ["iso3"], ["hdi"], [2020, 2021]).collect()] == [("AAA", "hdi", 2020, "0.5", 0.5)]
    with pytest.raises(readers.SourceError):
        readers.wide_years(df, ["iso3"], ["le"], [2020])


def test_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("d/events.csv", 'id,year,name,best\n1,2020,"a, b",5\n2,2021,c,\n')
    assert [tuple(r) for r in readers.zip_csv(spark, str(tmp_path / "e.zip"), ["id", "best"]).collect()] == [("1", "5"), ("2", None)]


def workbook(path, sheets: dict[str, list[list[object]]]) -> None:
    shared: list[str] = []
    parts, rels = [], []
    with zipfile.ZipFile(path, "w") as z:
        for i, (name, rows) in enumerate(sheets.items(), 1):
            xml = ""
            for r, row in enumerate(rows, 1):
                cells = ""
                for c, v in enumerate(row):
                    if v is None:
                        continue
                    at = f"{chr(65 + c)}{r}"
                    if isinstance(v, str):
                        shared.append(v)
                        cells += f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>'
                    else:
                        cells += f'<c r="{at}"><v>{v}</v></c>'
                xml += f'<row r="{r}">{cells}</row>'
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{xml}</sheetData></worksheet>')
            parts.append(f'<sheet name="{name}" r:id="rId{i}"/>')
            rels.append(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{"".join(parts)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{"".join(rels)}</Relationships>')
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">' + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")


def test_workbooks(spark, tmp_path):
    path = str(tmp_path / "w.xlsx")
    workbook(path, {"Data": [["iso ", "pop", None], ["AAA", 5, 1], ["BBB", None, 2]], "Share": [["t"], ["Country", 2020, 2021], ["Africa"], ["Aland", 1.5, "xxx"]], "FIW": [[None, "1973", None, None, "Jan.-Feb. 1974"], ["x"], ["x"], ["Aland", 1, 2, "F", 3, 4, "PF"]]})
    cells = readers.xlsx_cells(spark, path)
    assert [(r.iso, r.pop) for r in readers.sheet_table(cells.where("sheet = 'Data'"), ["iso", "pop"]).orderBy("row").collect()] == [("AAA", "5"), ("BBB", None)]
    years = readers.year_columns(cells.where("sheet = 'Share'"), 0, 1, skip=["Africa"])
    assert sorted(tuple(r) for r in years.collect()) == [("Share", "Aland", 2020, "1.5"), ("Share", "Aland", 2021, "xxx")]
    assert sorted(tuple(r) for r in readers.rating_triplets(cells.where("sheet = 'FIW'")).collect()) == [("FIW", "Aland", 1973, "1", "2", "F"), ("FIW", "Aland", 1974, "3", "4", "PF")]
    with pytest.raises(Exception, match="lacks sheets"):
        readers.xlsx_cells(spark, path, ["PTS-2025"]).collect()


def test_stata(spark, tmp_path):
    frame = pd.DataFrame({"ccode": [2.0, 20.0], "leader": ["Ann", ""], "startdate": pd.to_datetime(["1900-01-02", "1950-05-06"])})
    frame.to_stata(tmp_path / "a.dta", write_index=False, convert_dates={"startdate": "td"})
    got = readers.stata(spark, str(tmp_path / "a.dta"), {"ccode": "double", "leader": "string", "startdate": "string"}).collect()
    assert [tuple(r) for r in got] == [(2.0, "Ann", "1900-01-02"), (20.0, None, "1950-05-06")]


def test_json_pages(spark, tmp_path):
    record = {"indicator": {"id": "SP.POP", "value": "x"}, "country": {"id": "A", "value": "Aland"}, "countryiso3code": "AAA", "date": "2023", "value": 5, "unit": "", "obs_status": "", "decimal": 0}
    (tmp_path / "w.json").write_text(json.dumps([{"page": 1}, [record, record | {"countryiso3code": ""}, record | {"value": None}]]))
    assert [(r.iso3, r.year, r.variable, r.value) for r in readers.wdi(spark, str(tmp_path / "w.json")).collect()] == [("AAA", 2023, "SP.POP", 5.0), ("AAA", 2023, "SP.POP", None)]
    (tmp_path / "broken.json").write_text("{")
    assert readers.wdi(spark, str(tmp_path / "broken.json")).count() == 0
    item = {"IndicatorCode": "X", "SpatialDimType": "COUNTRY", "SpatialDim": "AAA", "TimeDim": 2018, "NumericValue": 1.5}
    (tmp_path / "o.json").write_text(json.dumps({"value": [item, item | {"SpatialDimType": "REGION"}, item | {"SpatialDim": "AA"}]}))
    assert [tuple(r) for r in readers.odata_values(spark, str(tmp_path / "o.json"), 2019).collect()] == [("AAA", 2019, "X", 1.5)]
    binding = {"person": {"type": "uri", "value": "http://x/entity/Q5"}, "start": {"type": "literal", "value": "2001-02-03T00:00:00Z"}}
    (tmp_path / "s.json").write_text(json.dumps({"results": {"bindings": [binding]}}))
    row = readers.sparql_bindings(spark, str(tmp_path / "s.json"), ["person", "start", "end"]).first()
    assert (row.person, row.start_year, row.end) == ("Q5", 2001, None)
    (tmp_path / "p.json").write_text(json.dumps({"query": {"pages": {"1": {"pageid": 1, "ns": 0, "title": "T", "extract": "e"}, "-1": {"pageid": -1, "title": "U"}, "x": {"pageid": 3}}, "search": [{"title": "T", "pageid": 1, "size": 2, "wordcount": 3, "snippet": "a <span>b</span>"}]}}))
    assert sorted((r.page_id or 0, r.title) for r in readers.wiki_pages(spark, str(tmp_path / "p.json")).collect()) == [(0, "U"), (1, "T")]
    assert readers.wiki_search(spark, str(tmp_path / "p.json")).first().snippet == "a b"


def test_html_table(spark, tmp_path):
    row = "<tr><td><a>Aland</a></td><td>~5,044</td><td>n.a.</td><td>10–20</td></tr>"
    (tmp_path / "f.html").write_text(f'<table id="table1"><tr><td>small</td></tr></table><table id="table1"><tr><td>short</td></tr>{row}{row.replace("Aland", "Total")}</table>')
    assert [tuple(r) for r in readers.warheads(spark, str(tmp_path / "f.html"), ["Aland"], ["a", "b", "c"]).collect()] == [("Aland", 5044, None, 15)]


def test_catalog_and_fact(spark, tmp_path):
    (tmp_path / "c.csv").write_text("# note\nvariable_name,raw_column\na,b\n,c\n")
    assert [r.variable_name for r in readers.catalog(spark, str(tmp_path / "c.csv")).collect()] == ["a"]
    (tmp_path / "f.csv").write_text("metric_id,year,country_iso3,value\nm,2020,AAA,1\n")
    assert str(readers.fact_csv(spark, str(tmp_path / "f.csv")).first().year_date) == "2020-01-01"
    assert readers.parquet_or_empty(spark, str(tmp_path / "none.parquet"), "iso3 string, v double").count() == 0


def test_registry(spark):
    registry = Registry()
    frame = spark.createDataFrame([("AAA", 2020, 1.0, None)], "iso3 string, year int, a double, b double")
    source = Source("demo", lambda s, p: frame, long_transform("iso3", "year", ["a", "b"]), lambda s, p: None if p else "no path")
    registry.add(source)
    with pytest.raises(ValueError, match="already"):
        registry.add(source)
    with pytest.raises(NotReady):
        registry.run(spark, "demo", "")
    row = registry.run(spark, "demo", "x").collect()
    assert [(r.observation_id, r.value, r.value_type) for r in row] == [("demo:AAA:2020:a", 1.0, "numeric")]
    assert registry.list() == ["demo"]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("s", 2020, 1), ("s", 2021, 2), ("t", 2020, 3)], "source_id string, year int, v int")
    sinks.replace_partitions(first, path)
    for _ in range(2):
        sinks.replace_partitions(spark.createDataFrame([("s", 2020, 9)], "source_id string, year int, v int"), path)
    assert sorted((r.source_id, r.year, r.v) for r in spark.read.parquet(path).collect()) == [("s", 2020, 9), ("s", 2021, 2), ("t", 2020, 3)]
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    new = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "k int, x string, y int")
    assert {tuple(r) for r in sinks.upserted(base, new, ["k"]).collect()} == {(1, "a", 1), (2, "b", 5), (3, "c", 6)}
    n = sinks.write_csv(spark.createDataFrame([("a", None, 0.125)], "x string, y int, z double"), str(tmp_path / "o.csv"), ["x", "y", "z"], ["note"], {"z": ".2f"})
    assert n == 1 and (tmp_path / "o.csv").read_bytes() == b"# note\r\nx,y,z\r\na,,0.12\r\n"
    found = sinks.manifest(spark.createDataFrame([(2020, "i"), (2021, "j")], "year int, indicator_code string"), str(tmp_path / "m.json"), "s")
    assert found == json.loads((tmp_path / "m.json").read_text()) and found["indicators"] == ["i", "j"]
    assert sinks.without_tagged(spark.createDataFrame([("run:1",), ("x",), (None,)], "note string"), "note", "run:").count() == 2


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("2020-01-01 00:10:00", "a", 1.0), ("2020-01-01 00:50:00", "a", 2.0), ("2020-01-01 01:00:00", "b", 4.0)], "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    table = {(str(r.start)[11:16], r.event_type, r.n, r.total) for r in ingest.event_windows(rows).collect()}
    stream = ingest.event_windows(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert {(str(r.start)[11:16], r.event_type, r.n, r.total) for r in spark.table("windows").collect()} == table and len(table) == 2
    spark.createDataFrame([("s", 2020, 1)], "source_id string, year int, v int").write.parquet(str(tmp_path / "drop"))
    ingest.ingest_folder(spark, str(tmp_path / "drop"), "source_id string, year int, v int", str(tmp_path / "target"), str(tmp_path / "state")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "target")).count() == 1


def test_cache_and_config(tmp_path):
    calls = []

    def fetch():
        calls.append(1)
        if len(calls) == 1:
            raise ConnectionError
        return '{"a": 1}'

    path = str(tmp_path / "x" / "c.json")
    assert cache.cached_json(path, fetch, wait=0) == {"a": 1} and len(calls) == 2
    assert cache.cached_json(path, fetch) == {"a": 1} and len(calls) == 2
    (tmp_path / "x" / "c.json").write_text("{broken")
    assert cache.cached_json(path, fetch) == {"a": 1} and len(calls) == 3
    assert cache.cached_json(path, fetch, force=True) == {"a": 1} and len(calls) == 4
    (tmp_path / "r.json").write_text('{"lake": "l", "output": "o", "years": [2020]}')
    assert cache.load_config(str(tmp_path / "r.json")).years == (2020,)
    (tmp_path / "r.json").write_text('{"lake": "l", "output": "o", "x": 1}')
    with pytest.raises(ValueError, match="unknown"):
        cache.load_config(str(tmp_path / "r.json"))


def test_score_rows(spark, tmp_path):
    scores = spark.createDataFrame([("B", "c", None, None, "insufficient_data"), ("A", "c", 0.123456, 2, "")], "country_iso3 string, category string, normalized_score double, score_1_10 int, flags string")
    sinks.write_scores(scores, str(tmp_path / "s.csv"), ["source: text"])
    assert (tmp_path / "s.csv").read_text().splitlines() == ["# source: text", "country_iso3,category,normalized_score,score_1_10,flags", "A,c,0.1235,2,", "B,c,NA,NA,insufficient_data"]
