"""Command line: python -m statlas.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from statlas.operators import growth, joins
from statlas.plans import categories, chronicle, slices
from statlas.plans.query import execute
from statlas.plans.spec import METRICS, from_payload
from statlas.session import session
from statlas.sources import adapters, readers, sinks, star
from statlas.sources.registry import Registry, Source

GROWTH_TABLES = {"country_year_growth": growth.country_year_growth, "regime_year_aggregates": growth.regime_year_aggregates, "country_latest_metrics": growth.country_latest_metrics}


#: Adapters by the name of their source; each takes its own options.
FACTORIES = {
    "archigos": adapters.archigos,
    "bti": adapters.bti,
    "cirights": adapters.cirights,
    "freedom_house": adapters.freedom_house,
    "maddison_project": adapters.maddison,
    "pts": adapters.pts,
    "pwt": adapters.pwt,
    "reign": adapters.reign,
    "rsf_press_freedom": adapters.rsf,
    "sipri_milex": adapters.sipri_milex,
    "transparency_cpi": adapters.transparency_cpi,
    "ucdp": adapters.ucdp,
    "undp_hdi": adapters.undp_hdi,
    "vdem": adapters.vdem,
    "warhead_table": adapters.warhead_table,
    "who_gho_api": adapters.who,
    "world_bank_wdi": adapters.wdi,
    "world_bank_wgi": adapters.wgi,
}


def _write(df: DataFrame, path: str | None) -> None:
    if path is None:
        df.show(50, truncate=False)
    elif path.endswith(".csv"):
        print(sinks.write_csv(df, path, df.columns))
    else:
        df.write.mode("overwrite").parquet(path)


def _fact(path: str) -> DataFrame:
    spark = session()
    return readers.fact_csv(spark, path) if path.endswith(".csv") else spark.read.parquet(path)


def metrics(args: argparse.Namespace) -> None:
    for m in METRICS.values():
        print(f"{m.metric_id}\t{m.grain}\t{m.unit}\t{','.join(m.aggregations)}")


def query(args: argparse.Namespace) -> None:
    payload = json.loads(Path(args.spec[1:]).read_text() if args.spec.startswith("@") else args.spec)
    _write(execute(from_payload(payload), _fact(args.fact), strict=not args.extensions), args.out)


def growth_tables(args: argparse.Namespace) -> None:
    fact = _fact(args.fact)
    for name, build in GROWTH_TABLES.items():
        df = build(fact)
        print(name, sinks.write_csv(df.orderBy(*[c for c in ("country_iso3", "metric_id", "year") if c in df.columns]), f"{args.out}/{name}.csv", df.columns))


def bundle(args: argparse.Namespace) -> None:
    found = {Path(p).stem: p for p in args.tables}
    print(json.dumps(sinks.save_bundle(session(), found, {}, args.database), sort_keys=True))


def score(args: argparse.Namespace) -> None:
    spark = session()
    observations = spark.read.parquet(args.observations)
    out = categories.score_all(observations, observations.select("country_iso3").distinct(), args.year)
    _write(out.where(out["category"] == args.category) if args.category else out, args.out)


def country_years(args: argparse.Namespace) -> None:
    spark = session()
    read = lambda name: spark.read.parquet(f"{args.lake}/{name}.parquet")
    rows = chronicle.build(read("scope"), read("vdem"), read("wdi"), read("maddison"), read("sipri"), read("area"), read("rulers"), args.first, args.last)
    _write(chronicle.ordered(chronicle.condensed(rows) if args.condensed else rows), args.out)


def database(args: argparse.Namespace) -> None:
    print("\n".join(star.create(session(), args.name)))


def _source(args: argparse.Namespace) -> Source:
    """A source by the name of its adapter, with the options that it takes."""
    return FACTORIES[args.source](**json.loads(args.options))


def sources(args: argparse.Namespace) -> None:
    print("\n".join(sorted(FACTORIES)))


def check_source(args: argparse.Namespace) -> None:
    """Say whether a source can be read."""
    spark = session()
    try:
        reason = _source(args).ready(spark, args.path) or ("" if spark.read.format("binaryFile").load(args.path).limit(1).count() else "no file")
    except AnalysisException as error:
        reason = str(error).splitlines()[0]
    print(f"{args.source}\t{reason or 'ready'}")


def ingest_source(args: argparse.Namespace) -> None:
    """Read a source and replace its years in the observations at a path; its manifest goes beside them."""
    registry = Registry()
    source = registry.add(_source(args))
    rows = registry.run(session(), source.slug, args.path)
    sinks.replace_partitions(rows, args.out)
    print(json.dumps(sinks.manifest(rows, f"{args.manifests}/{source.slug}.json", source.slug, source.attribution), sort_keys=True))


def match_countries(args: argparse.Namespace) -> None:
    """Name the country of each row by a table of aliases."""
    spark = session()
    rows = readers.csv_strings(spark, args.rows) if args.rows.endswith(".csv") else spark.read.parquet(args.rows)
    _write(joins.matched_countries(rows, args.column, readers.csv_strings(spark, args.aliases)), args.out)


def compare(args: argparse.Namespace) -> None:
    """Scores next to a reference matrix: the comparison, the rows to review and a summary."""
    spark = session()
    compared = slices.comparison(spark.read.parquet(args.scores), spark.read.parquet(args.reference)).persist()
    Path(args.out).mkdir(parents=True, exist_ok=True)
    for name, df in (("comparison", compared.orderBy("iso3", "category")), ("review_queue", slices.review_queue(compared))):
        print(name, sinks.write_csv(df, f"{args.out}/{name}.csv", df.columns))
    sinks.atomic_text(f"{args.out}/summary.md", slices.summary_markdown(compared, "Comparison"))
    compared.unpersist()


def data_lake(args: argparse.Namespace) -> None:
    """Make the folders of a data lake."""
    for name in ("raw", "observations", "manifests", "outputs", *(f"raw/{slug}" for slug in sorted(FACTORIES))):
        Path(args.path, name).mkdir(parents=True, exist_ok=True)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="statlas")
    sub = p.add_subparsers(required=True)

    def command(name: str, run, *arguments: tuple[str, dict]) -> None:
        c = sub.add_parser(name, help=run.__doc__)
        c.set_defaults(run=run)
        for flag, more in arguments:
            c.add_argument(flag, **more)

    out = ("--out", {"default": None})
    command("metrics", metrics)
    command("query", query, ("spec", {"help": "JSON, or @file"}), ("--fact", {"required": True}), ("--extensions", {"action": "store_true"}), out)
    command("growth-tables", growth_tables, ("--fact", {"required": True}), ("--out", {"required": True}))
    command("bundle", bundle, ("database", {}), ("tables", {"nargs": "+"}))
    command("score", score, ("observations", {}), ("year", {"type": int}), ("--category", {"choices": sorted(categories.CATEGORIES)}), out)
    command("chronicle", country_years, ("lake", {}), ("first", {"type": int}), ("last", {"type": int}), ("--condensed", {"action": "store_true"}), out)
    command("init-db", database, ("name", {}))
    command("init-data-lake", data_lake, ("path", {}))
    command("sources", sources)
    source = ("source", {"choices": sorted(FACTORIES)})
    options = ("--options", {"default": "{}", "help": "the adapter's arguments, as JSON"})
    command("check-source", check_source, source, ("path", {}), options)
    command("ingest-source", ingest_source, source, ("path", {}), ("out", {}), ("--manifests", {"required": True}), options)
    command("match-countries", match_countries, ("rows", {}), ("column", {}), ("aliases", {}), out)
    command("compare", compare, ("scores", {}), ("reference", {}), ("out", {}))
    return p


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(args)


if __name__ == "__main__":
    main()
