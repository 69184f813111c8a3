"""The registered queries of the country-year engine, each next to its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statlas.functions import scalars as S
from statlas.operators import concepts, evidence, growth, intervals, joins, reshape, scoring, series
from statlas.plans import categories, chronicle, facts, slices
from statlas.plans.query import execute, years_of
from statlas.plans.registered import ORACLE_SQL, QUERIES, query
from statlas.plans.spec import Filter, Query, Transform, from_payload
from statlas.sources import adapters
from statlas.streaming import ingest

__all__ = ["ORACLE_SQL", "QUERIES"]

#: The country-year fact, as facts.fact() builds it.
FACT_SQL = """
base AS (SELECT n_name AS country_iso3, r_name AS political_regime_bucket, 'regime ' || (n_nationkey % 4) AS political_regime,
                CAST(year(o_orderdate) AS INT) AS year, o_custkey, o_totalprice
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
cy AS (SELECT country_iso3, political_regime_bucket, political_regime, year, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS population, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS gdp
       FROM base GROUP BY ALL),
f AS (SELECT 'chronicle.population' AS metric_id, * EXCLUDE (population, gdp), population AS value FROM cy
      UNION ALL SELECT 'chronicle.gdp', * EXCLUDE (population, gdp), gdp FROM cy
      UNION ALL SELECT 'chronicle.gdp_per_capita', * EXCLUDE (population, gdp), gdp / population FROM cy)
"""
CUSTOMER_SQL = "g AS (SELECT o_custkey AS key, CAST(year(o_orderdate) AS INT) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS value, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ALL)"


def _r(c: str | Column, digits: int = 4) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# Semantic queries


def _add_query(name: str, spec: Query, sql: str, strict: bool = False, keys: tuple[str, ...] = ("year", "political_regime_bucket")) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = execute(spec, facts.fact(spark, sf_dir, years_of(spec)), strict)
        more = ["aggregation"] if spec.aggregation != "none" else []
        return out.select(*keys, "metric_id", _r(F.col("value") + 0.000011).alias("value"), "metric_label", "value_unit", *more)

    run.__name__ = name
    query(sql)(run)


_LABELS = """CASE metric_id WHEN 'chronicle.population' THEN 'Population' WHEN 'chronicle.gdp' THEN 'GDP' ELSE 'GDP per capita' END AS metric_label,
CASE metric_id WHEN 'chronicle.population' THEN 'persons' ELSE 'source_native' END AS value_unit"""
_KEYS = "year, political_regime_bucket, metric_id"
_AGGREGATES = {"count": "CAST(count(*) AS DOUBLE)", "sum": "coalesce(sum(value), 0)", "mean": "avg(value)", "median": "median(value)", "min": "min(value)", "max": "max(value)"}

for _kind, _sql in _AGGREGATES.items():
    _add_query(
        f"viz_query_{_kind}",
        Query((facts.GDP, facts.POPULATION), aggregation=_kind, group_by=("year", "political_regime_bucket")),
        f"WITH {FACT_SQL} SELECT {_KEYS}, round({_sql} + 0.000011, 4) AS value, {_LABELS}, '{_kind}' AS aggregation FROM f WHERE metric_id <> 'chronicle.gdp_per_capita' GROUP BY {_KEYS}",
    )
_add_query(
    "viz_query_weighted_mean",
    Query((facts.PER_HEAD,), aggregation="weighted_mean", group_by=("year", "political_regime_bucket"), weight_metric_id=facts.POPULATION),
    f"WITH {FACT_SQL}, w AS (SELECT country_iso3, year, value AS w FROM f WHERE metric_id = 'chronicle.population') "
    f"SELECT {_KEYS}, round(sum(value * w) / sum(w) + 0.000011, 4) AS value, {_LABELS}, 'weighted_mean' AS aggregation FROM f JOIN w USING (country_iso3, year) WHERE metric_id = 'chronicle.gdp_per_capita' GROUP BY {_KEYS}",
)
_ROWS = ("country_iso3", "year", "political_regime_bucket")
_SELECT = f"SELECT country_iso3, {_KEYS}, round(value + 0.000011, 4) AS value, {_LABELS}"
_add_query("viz_query_none", from_payload({"metric": facts.GDP}), f"WITH {FACT_SQL} {_SELECT} FROM f WHERE metric_id = 'chronicle.gdp'", True, _ROWS)
_FILTERS = {
    "eq": (Filter("political_regime_bucket", "eq", "ASIA"), "political_regime_bucket = 'ASIA'"),
    "in": (Filter("country_iso3", "in", ["NATION_3", "NATION_7", "NATION_18"]), "country_iso3 IN ('NATION_3', 'NATION_7', 'NATION_18')"),
    "gte": (Filter("year", "gte", 1997), "year >= 1997"),
    "lte": (Filter("year", "lte", 1996), "year <= 1996"),
}
for _kind, (_f, _sql) in _FILTERS.items():
    _add_query(f"viz_filter_{_kind}", Query((facts.POPULATION,), filters=(_f,)), f"WITH {FACT_SQL} {_SELECT} FROM f WHERE metric_id = 'chronicle.population' AND {_sql}", True, _ROWS)
_add_query("viz_filter_time_range", from_payload({"metric": facts.GDP, "time_range": [1996, 1998], "aggregation": "sum", "group_by": ["year", "political_regime_bucket"]}), f"WITH {FACT_SQL} SELECT {_KEYS}, round(sum(value) + 0.000011, 4) AS value, {_LABELS}, 'sum' AS aggregation FROM f WHERE metric_id = 'chronicle.gdp' AND year BETWEEN 1996 AND 1998 GROUP BY {_KEYS}", True)
_TRANSFORMS = {
    "rolling_mean": (Transform("rolling_mean", window=3), "avg(value) OVER (PARTITION BY metric_id, country_iso3 ORDER BY year ROWS 2 PRECEDING)"),
    "yoy": (Transform("year_over_year_change"), "CASE WHEN year - lag(year) OVER w = 1 THEN value - lag(value) OVER w END"),
    "index_base": (Transform("index_to_base_year", base_year=1996), "value / max(CASE WHEN year = 1996 THEN value END) OVER (PARTITION BY metric_id, country_iso3) * 100"),
    "minmax": (Transform("min_max_normalize"), "(value - min(value) OVER (PARTITION BY metric_id)) / (max(value) OVER (PARTITION BY metric_id) - min(value) OVER (PARTITION BY metric_id))"),
    "log10": (Transform("log10"), "log10(value)"),
}
for _kind, (_t, _sql) in _TRANSFORMS.items():
    _add_query(
        f"transform_{_kind}",
        Query((facts.GDP, facts.POPULATION), transforms=(_t,)),
        f"WITH {FACT_SQL}, t AS (SELECT country_iso3, {_KEYS}, {_sql} AS value FROM f WHERE metric_id <> 'chronicle.gdp_per_capita' WINDOW w AS (PARTITION BY metric_id, country_iso3 ORDER BY year)) {_SELECT} FROM t",
        keys=_ROWS,
    )


# Growth tables


@query(
    f"""WITH {FACT_SQL}, t AS (SELECT *, lag(value) OVER w AS pv, year - lag(year) OVER w AS gap FROM f WINDOW w AS (PARTITION BY country_iso3, metric_id ORDER BY year)),
    u AS (SELECT *, CASE WHEN gap = 1 THEN pv END AS b FROM t)
    SELECT country_iso3, metric_id, year, round(value, 4) AS value, round(b, 4) AS prev_value, round(value - b, 4) AS yoy_abs_change,
    round(CASE WHEN b <> 0 THEN value / b - 1 END, 6) AS yoy_pct_growth, CAST(year // 10 * 10 AS INT) AS decade FROM u"""
)
def growth_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = growth.country_year_growth(facts.fact(spark, sf_dir))
    return out.select("country_iso3", "metric_id", "year", *(_r(c).alias(c) for c in ("value", "prev_value", "yoy_abs_change")), _r("yoy_pct_growth", 6).alias("yoy_pct_growth"), "decade")


@query(
    f"""WITH {FACT_SQL}, p AS (SELECT country_iso3, year, value AS people FROM f WHERE metric_id = 'chronicle.population'),
    y AS (SELECT *, CASE WHEN year - lag(year) OVER w = 1 THEN value / lag(value) OVER w - 1 END AS yoy FROM f WINDOW w AS (PARTITION BY country_iso3, metric_id ORDER BY year)),
    j AS (SELECT y.*, people FROM y JOIN p USING (country_iso3, year)),
    l AS (SELECT *, true AS is_bucket, political_regime_bucket AS name FROM j UNION ALL SELECT *, false, political_regime FROM j),
    a AS (SELECT year, metric_id, is_bucket, name, CAST(count(DISTINCT country_iso3) AS BIGINT) AS n_countries, avg(value) AS m, sum(value) AS s, sum(value * people) / sum(people) AS w, avg(yoy) AS y FROM l GROUP BY ALL)
    SELECT year, metric_id, CASE WHEN is_bucket THEN name ELSE '' END AS political_regime_bucket, CASE WHEN is_bucket THEN '' ELSE name END AS political_regime, n_countries,
    round(m + 0.0011, 2) AS mean_value, round(s + 0.0011, 2) AS sum_value, round(w + 0.0011, 2) AS pop_weighted_mean_value, round(y + 0.00000011, 6) AS mean_yoy_pct_growth,
    round(lag(m) OVER (PARTITION BY metric_id, is_bucket, name ORDER BY year) + 0.0011, 2) AS prev_mean_value FROM a"""
)
def regime_year_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = growth.regime_year_aggregates(facts.fact(spark, sf_dir))
    # rounded a little off, so that exact halves do not depend on the order of sums
    values = ("mean_value", "sum_value", "pop_weighted_mean_value", "prev_mean_value")
    return out.select("year", "metric_id", "political_regime_bucket", "political_regime", "n_countries", *(_r(F.col(c) + 0.0011, 2).alias(c) for c in values), _r(F.col("mean_yoy_pct_growth") + 0.00000011, 6).alias("mean_yoy_pct_growth"))


_CAGR_SQL = """c AS (SELECT {k}, max(year) AS end_year FROM {t} GROUP BY ALL),
    cg AS (SELECT {k2}, c.end_year, s.value AS start_value, e.value AS end_value, CASE WHEN s.value > 0 THEN (power(e.value / s.value, 1.0 / {n}) - 1) * 100 END AS cagr_pct
    FROM c JOIN {t} e ON {e} AND e.year = c.end_year LEFT JOIN {t} s ON {s} AND s.year = c.end_year - {n})"""


def _cagr_sql(table: str, keys: tuple[str, ...], n: int) -> str:
    on = lambda a: " AND ".join(f"{a}.{k} = c.{k}" for k in keys)
    return _CAGR_SQL.format(k=", ".join(keys), k2=", ".join(f"c.{k}" for k in keys), t=table, n=n, e=on("e"), s=on("s"))


@query(
    f"""WITH {FACT_SQL}, {_cagr_sql("f", ("country_iso3", "metric_id"), 5)},
    w AS (SELECT country_iso3, {", ".join(f"max(end_value) FILTER (metric_id = 'chronicle.{m}') AS latest_{m}, max(end_year) FILTER (metric_id = 'chronicle.{m}') AS {m}_latest_year, round(max(cagr_pct) FILTER (metric_id = 'chronicle.{m}'), 6) AS {m}_5yr_cagr_pct" for m in ("population", "gdp", "gdp_per_capita"))} FROM cg GROUP BY ALL)
    SELECT country_iso3, {", ".join(f"round(latest_{m}, 4) AS latest_{m}, {m}_latest_year, {m}_5yr_cagr_pct, CAST(rank() OVER (ORDER BY latest_{m} DESC) AS INT) AS {m}_rank" for m in ("population", "gdp", "gdp_per_capita"))},
    greatest(population_latest_year, gdp_latest_year, gdp_per_capita_latest_year) AS latest_year, b.political_regime, b.political_regime_bucket FROM w JOIN (SELECT DISTINCT country_iso3, political_regime, political_regime_bucket FROM f) b USING (country_iso3)"""
)
def country_latest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = growth.country_latest_metrics(facts.fact(spark, sf_dir), years=5)
    cells = [c for m in ("population", "gdp", "gdp_per_capita") for c in (_r(f"latest_{m}").alias(f"latest_{m}"), F.col(f"{m}_latest_year"), _r(f"{m}_5yr_cagr_pct", 6).alias(f"{m}_5yr_cagr_pct"), F.col(f"{m}_rank"))]
    return out.select("country_iso3", *cells, "latest_year", "political_regime", "political_regime_bucket")


@query(f"WITH {CUSTOMER_SQL}, {_cagr_sql('g', ('key',), 3)} SELECT key, end_year, round(start_value, 4) AS start_value, round(end_value, 4) AS end_value, round(cagr_pct, 6) AS cagr_pct FROM cg")
def cagr(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = growth.cagr(facts.customer_years(spark, sf_dir), ("key",), 3)
    return out.select("key", "end_year", _r("start_value").alias("start_value"), _r("end_value").alias("end_value"), _r("cagr_pct", 6).alias("cagr_pct"))


# Events and reshaping


@query(
    """WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, value FROM events),
    a AS (SELECT user_id, day, count(*) AS n_all, count(*) FILTER (event_type = 'click') AS n_click, sum(value) FILTER (event_type = 'click') AS sum_click, count(*) FILTER (event_type = 'purchase') AS n_purchase, sum(value) FILTER (event_type = 'purchase') AS sum_purchase FROM e GROUP BY ALL),
    u AS (SELECT DISTINCT user_id % 50 AS user_id FROM e), d AS (SELECT DISTINCT day FROM e), b AS (SELECT user_id % 50 AS user_id, day, sum(n_all) AS n_all, sum(n_click) AS n_click, sum(sum_click) AS sum_click, sum(n_purchase) AS n_purchase, sum(sum_purchase) AS sum_purchase FROM a GROUP BY ALL)
    SELECT user_id AS entity, strftime(day, '%Y-%m-%d') AS day, CAST(coalesce(n_all, 0) AS BIGINT) AS n_all, CAST(coalesce(n_click, 0) AS BIGINT) AS n_click, round(coalesce(sum_click, 0), 4) AS sum_click, CAST(coalesce(n_purchase, 0) AS BIGINT) AS n_purchase, round(coalesce(sum_purchase, 0), 4) AS sum_purchase
    FROM u CROSS JOIN d LEFT JOIN b USING (user_id, day)"""
)
def event_grid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = facts.table(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("entity"), F.to_date("ts").alias("day"), "event_type", "value")
    out = reshape.event_grid(events, "entity", "day", "event_type", "value", ["click", "purchase"])
    return out.withColumns({"day": F.date_format("day", "yyyy-MM-dd")} | {c: _r(c) for c in ("sum_click", "sum_purchase")})


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@query(
    "WITH o AS (SELECT o_custkey, o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS k FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) "
    "SELECT o_custkey, " + ", ".join(f"max(o_totalprice) FILTER (o_orderpriority = '{p}') AS \"{p}\"" for p in _PRIORITIES) + " FROM o WHERE k = 1 GROUP BY o_custkey"
)
def pivot_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.first_pivot(facts.table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", _PRIORITIES, ["o_totalprice"], "o_orderkey")


@query(
    "WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS k FROM orders) SELECT o_custkey, "
    + ", ".join(f"max(o_totalprice) FILTER (o_orderstatus = '{s}') AS \"o_totalprice_{s}\", max(o_orderkey) FILTER (o_orderstatus = '{s}') AS \"o_orderkey_{s}\"" for s in "FO")
    + " FROM o WHERE k = 1 AND o_orderstatus IN ('F', 'O') GROUP BY o_custkey"
)
def pivot_two_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = facts.table(spark, sf_dir, "orders").withColumn("_order", F.col("o_orderkey"))
    return reshape.first_pivot(orders, ["o_custkey"], "o_orderstatus", ["F", "O"], ["o_totalprice", "o_orderkey"], "_order")


@query(
    "SELECT l_orderkey, l_linenumber, 'quantity' AS variable_name, l_quantity AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem WHERE l_discount IS NOT NULL UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem"
)
def unpivot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.long(facts.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], {"l_quantity": "quantity", "l_discount": "discount", "l_tax": "tax"})


@query("SELECT o_custkey AS id, o_orderstatus AS kind, NULL AS name, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL UNION ALL SELECT c_custkey, NULL, c_name, NULL FROM customer")
def union_missing_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = facts.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("kind")).agg(_r(F.sum("o_totalprice"), 2).alias("total"))
    b = facts.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return reshape.union_all(a, b).select("id", "kind", "name", "total")


@query("SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = facts.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    return reshape.first_wins(orders, ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey")).drop("o_orderdate")


@query("SELECT l_partkey, l_suppkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n")).where("n > 1")


# Lookup joins


@query(
    """SELECT p_partkey, p_brand, p_retailprice, CAST(rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) AS INT) AS price_rank FROM part"""
)
def rank_min_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = facts.table(spark, sf_dir, "part")
    return part.select("p_partkey", "p_brand", "p_retailprice", growth.min_rank(F.col("p_retailprice"), "p_brand").alias("price_rank"))


@query("SELECT s_nationkey, s_suppkey, s_acctbal FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) = 1")
def top1_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.top_one(facts.table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal"), ["s_nationkey"], F.desc("s_acctbal"), F.col("s_suppkey"))


@query(
    """WITH c AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_partkey, l_suppkey, CAST(n AS BIGINT) AS n, count(*) OVER (PARTITION BY l_partkey) > 1 AS several FROM c QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey) = 1"""
)
def mode_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.mode_by(facts.table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_suppkey")


@query(
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '5-LOW' THEN 3 ELSE 4 END, o_orderdate DESC, o_orderkey) = 1"""
)
def priority_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = facts.table(spark, sf_dir, "orders")
    return joins.by_priority(orders, ["o_custkey"], "o_orderpriority", ["2-HIGH", "1-URGENT", "5-LOW"], F.desc("o_orderdate"), F.col("o_orderkey")).select("o_custkey", "o_orderkey", "o_orderpriority")


@query(
    f"""WITH {CUSTOMER_SQL}, t AS (SELECT c_custkey AS key, y.year FROM customer CROSS JOIN (SELECT DISTINCT year FROM g) y),
    a AS (SELECT key, year, value FROM g WHERE n >= 2), b AS (SELECT key, year, -n AS value FROM g), j AS (SELECT t.key, t.year, CASE WHEN t.year <= 1998 THEN a.value END AS v0, CASE WHEN t.year >= 1996 THEN b.value END AS v1 FROM t LEFT JOIN a USING (key, year) LEFT JOIN b USING (key, year))
    SELECT key, year, round(coalesce(v0, v1), 4) AS value, CASE WHEN v0 IS NOT NULL THEN 'large' WHEN v1 IS NOT NULL THEN 'count' ELSE 'missing' END AS source FROM j"""
)
def fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = facts.customer_years(spark, sf_dir)
    customers = facts.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    targets = customers.crossJoin(F.broadcast(g.select("year").distinct()))
    sources = [("large", g.where("n >= 2"), F.col("year") <= 1998), ("count", g.select("key", "year", (-F.col("n")).cast("double").alias("value")), F.col("year") >= 1996)]
    return joins.fallback_chain(targets, ["key", "year"], sources, "value").withColumn("value", _r("value"))


@query(
    """WITH o AS (SELECT o_custkey AS c_custkey, max(o_totalprice) AS c_acctbal FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL)
    SELECT c_custkey, c_name, c_mktsegment, coalesce(o.c_acctbal, c.c_acctbal) AS c_acctbal FROM customer c FULL JOIN o USING (c_custkey)"""
)
def overlay_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = facts.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    cache = facts.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return joins.overlay(base, cache, ["c_custkey"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = facts.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return joins.only_in(facts.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), orders, ["c_custkey"])


@query(
    """WITH a AS (SELECT n_nationkey AS k, n_name AS name FROM nation WHERE n_nationkey < 20), b AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE lower(n_name) END AS name FROM nation WHERE n_nationkey >= 10)
    SELECT k, coalesce(b.name, a.name) AS name, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'merged' WHEN a.k IS NOT NULL THEN 'table' ELSE 'curated' END AS provenance FROM a FULL JOIN b USING (k)"""
)
def dimension_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = facts.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    curated = nation.where("k >= 10").withColumn("name", F.when(F.col("k") % 3 != 0, F.lower("name")))
    return joins.merged_dimension(nation.where("k < 20"), curated, ["k"], ("table", "curated"))


@query(
    f"""WITH {CUSTOMER_SQL} SELECT c_custkey AS key, round(coalesce(p.value, q.value), 4) AS value, CASE WHEN p.value IS NOT NULL THEN 1998 WHEN q.value IS NOT NULL THEN 1997 END AS year_used
    FROM customer LEFT JOIN (SELECT * FROM g WHERE year = 1998) p ON p.key = c_custkey LEFT JOIN (SELECT * FROM g WHERE year = 1997) q ON q.key = c_custkey"""
)
def preferred_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = facts.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return joins.preferred_year(customers, facts.customer_years(spark, sf_dir), ["key"], 1998, 1997, "value", "n").withColumn("value", _r("value"))


@query("WITH c AS (SELECT DISTINCT n_name FROM nation), y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders) SELECT n_name, year FROM c CROSS JOIN y")
def cross_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = facts.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return facts.table(spark, sf_dir, "nation").select("n_name").distinct().crossJoin(F.broadcast(years))


# Intervals

_SPELLS_SQL = "sp AS (SELECT o_custkey, o_orderkey, o_orderdate AS s, max(l_shipdate) AS e FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL), ex AS (SELECT *, CAST(unnest(range(year(s), year(e) + 1)) AS INT) AS year FROM sp WHERE year(s) <= year(e))"


def _spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = facts.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("e"))
    orders = facts.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("s"))
    return orders.join(last, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


@query(f"WITH {_SPELLS_SQL} SELECT o_custkey, year, o_orderkey, CAST(count(*) OVER (PARTITION BY o_custkey, year) AS BIGINT) AS n_spells FROM ex QUALIFY row_number() OVER (PARTITION BY o_custkey, year ORDER BY s, o_orderkey) = 1")
def interval_stab_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.stab_earliest(_spells(spark, sf_dir), ["o_custkey"], "s", "e", "o_orderkey", 1900, 2100).drop("s")


@query(
    f"""WITH {_SPELLS_SQL}, d AS (SELECT *, date_diff('day', greatest(CAST(s AS DATE), make_date(year, 1, 1)), least(CAST(e AS DATE), make_date(year, 12, 31))) + 1 AS days FROM ex)
    SELECT o_custkey, year, o_orderkey, CAST(days AS INT) AS days, count(*) OVER (PARTITION BY o_custkey, year) > 1 AS several FROM d WHERE days > 0 QUALIFY row_number() OVER (PARTITION BY o_custkey, year ORDER BY days DESC, s, o_orderkey) = 1"""
)
def interval_overlap_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlap_longest(_spells(spark, sf_dir), ["o_custkey"], "s", "e", "o_orderkey", 1900, 2100)


@query(
    f"""WITH {CUSTOMER_SQL}, p AS (SELECT key, min(year) AS a, max(year) - 1 AS b, min(n) AS v FROM g GROUP BY key HAVING max(year) > min(year)), l AS (SELECT max(b) AS last FROM p)
    SELECT g.key, g.year, coalesce(h.v, CASE WHEN g.year > last THEN p.v END) AS v, h.v IS NULL AND g.year > last AND p.v IS NOT NULL AS is_proxy
    FROM g CROSS JOIN l LEFT JOIN p h ON h.key = g.key AND g.year BETWEEN h.a AND h.b LEFT JOIN p ON p.key = g.key"""
)
def period_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = facts.customer_years(spark, sf_dir)
    periods = g.groupBy("key").agg(F.min("year").alias("a"), (F.max("year") - 1).alias("b"), F.min("n").alias("v")).where("a <= b")
    return intervals.period_value(g.select("key", "year"), periods, ["key"], "a", "b", "v")


# Series with gaps


@query(
    f"""WITH {CUSTOMER_SQL}, y AS (SELECT key, CAST(unnest(range(min(year), max(year) + 3)) AS INT) AS year FROM g GROUP BY key), j AS (SELECT y.key, y.year, g.value FROM y LEFT JOIN g USING (key, year)),
    k AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN year END IGNORE NULLS) OVER b AS py, last_value(value IGNORE NULLS) OVER b AS pv, first_value(CASE WHEN value IS NOT NULL THEN year END IGNORE NULLS) OVER a AS ny, first_value(value IGNORE NULLS) OVER a AS nv FROM j
          WINDOW b AS (PARTITION BY key ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY key ORDER BY year ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    r AS (SELECT key, year, value, CASE WHEN ny > py THEN pv + (nv - pv) * (year - py) / (ny - py) END AS line, CASE WHEN year - py <= 1 THEN pv END AS carried FROM k)
    SELECT key, year, round(coalesce(value, line, carried) + 0.0011, 2) AS filled, CASE WHEN value IS NOT NULL THEN 'exact' WHEN line IS NOT NULL THEN 'interpolated' WHEN carried IS NOT NULL THEN 'proxy' ELSE 'missing' END AS method FROM r"""
)
def interpolate_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = facts.customer_years(spark, sf_dir).select("key", "year", "value")
    years = g.groupBy("key").agg(F.sequence(F.min("year"), F.max("year") + 2).alias("_y")).select("key", F.explode("_y").alias("year"))
    return series.filled(years.join(g, ["key", "year"], "left"), ["key"]).select("key", "year", _r(F.col("filled") + 0.0011, 2).alias("filled"), "method")


@query(
    f"""WITH {CUSTOMER_SQL}, y AS (SELECT key, CAST(unnest(range(min(year), max(year) + 1)) AS INT) AS year FROM g GROUP BY key), j AS (SELECT y.key, y.year, g.value FROM y LEFT JOIN g USING (key, year))
    SELECT key, year, round(coalesce(value, lag(value) OVER (PARTITION BY key ORDER BY year)), 4) AS carried FROM j"""
)
def carry_forward_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = facts.customer_years(spark, sf_dir).select("key", "year", "value")
    return series.carried_forward(series.yearly(g, ["key"]), ["key"]).select("key", "year", _r("carried").alias("carried"))


@query(
    f"""WITH {CUSTOMER_SQL}, z AS (SELECT key, year, CASE WHEN n = 1 THEN 0.0 ELSE CAST(n AS DOUBLE) END AS v FROM g), y AS (SELECT key, CAST(unnest(range(min(year), max(year) + 1)) AS INT) AS year FROM g GROUP BY key), j AS (SELECT y.key, y.year, z.v FROM y LEFT JOIN z USING (key, year)),
    k AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY key ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p, first_value(v IGNORE NULLS) OVER (PARTITION BY key ORDER BY year ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS q FROM j)
    SELECT key, year, coalesce(v IS NULL AND p = 0 AND q = 0, false) AS bracketed FROM k"""
)
def bracketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = facts.customer_years(spark, sf_dir).select("key", "year", F.when(F.col("n") == 1, F.lit(0.0)).otherwise(F.col("n").cast("double")).alias("v"))
    return series.bracketed(series.yearly(g, ["key"]), ["key"], "v").select("key", "year", "bracketed")


@query(
    f"""WITH {CUSTOMER_SQL}, z AS (SELECT key, year, CASE WHEN n > 1 THEN n END AS v FROM g)
    SELECT key, year, coalesce(v, CASE WHEN min(v) OVER (PARTITION BY key) = max(v) OVER (PARTITION BY key) THEN min(v) OVER (PARTITION BY key) END) AS resolved FROM z"""
)
def unambiguous_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = facts.customer_years(spark, sf_dir).select("key", "year", F.when(F.col("n") > 1, F.col("n")).alias("v"))
    return series.only_value(g, ["key"], "v").select("key", "year", "resolved")


# Evidence, scoring, concepts


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations: a customer is a country, the priority the variable, the status the source."""
    return facts.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("country"), F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("variable_name"), F.col("o_orderstatus").alias("source_id"), F.col("o_orderkey").alias("observation_id"), F.col("o_totalprice").alias("value")
    )


_OBS_SQL = "obs AS (SELECT o_custkey AS country, CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS variable_name, o_orderstatus AS source_id, o_orderkey AS observation_id, o_totalprice AS value FROM orders)"


@query(
    f"""WITH {_OBS_SQL} SELECT country, variable_name, 1998 AS target_year, year, source_id, observation_id, value, CASE WHEN year = 1998 THEN 'direct' ELSE 'proxy' END AS temporal_kind FROM obs WHERE abs(year - 1998) IN (0, 1, 2)
    QUALIFY row_number() OVER (PARTITION BY country, variable_name ORDER BY abs(year - 1998), year DESC, source_id, observation_id) = 1"""
)
def asof_best_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = _observations(spark, sf_dir)
    targets = obs.select("country", "variable_name").distinct().withColumn("target_year", F.lit(1998))
    return evidence.best_observations(obs, targets, ["country", "variable_name"], (1, 2))


@query(
    f"""WITH {_OBS_SQL}, ex AS (SELECT c_custkey AS country, year, p AS variable_name FROM customer CROSS JOIN (SELECT DISTINCT year FROM obs) y CROSS JOIN (VALUES ('1-URGENT'), ('2-HIGH'), ('5-LOW')) v(p)), seen AS (SELECT DISTINCT country, year, variable_name FROM obs)
    SELECT country, year, variable_name, CASE variable_name WHEN '5-LOW' THEN 'X' ELSE 'F' END AS source_id, CASE variable_name WHEN '1-URGENT' THEN 'required' WHEN '2-HIGH' THEN 'preferred' ELSE 'fallback' END AS role,
    CASE variable_name WHEN '5-LOW' THEN 'source_not_implemented' ELSE 'target_year_absent' END AS reason, CASE variable_name WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'medium' ELSE 'low' END AS severity FROM ex ANTI JOIN seen USING (country, year, variable_name)"""
)
def missing_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = _observations(spark, sf_dir)
    plan = spark.createDataFrame([("1-URGENT", "F", "required"), ("2-HIGH", "F", "preferred"), ("5-LOW", "X", "fallback")], "variable_name string, source_id string, role string")
    years = F.broadcast(obs.select("year").distinct())
    expected = facts.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("country")).crossJoin(years).crossJoin(F.broadcast(plan))
    known = spark.createDataFrame([("F",), ("O",), ("P",)], "source_id string")
    return evidence.missing_indicators(expected, obs, known, ["country", "year"]).select("country", "year", "variable_name", "source_id", "role", "reason", "severity")


@query(
    f"""WITH {CUSTOMER_SQL} SELECT y.year, CAST(count(*) FILTER (c_mktsegment <> 'BUILDING') AS BIGINT) AS n_existing, CAST(count(value) FILTER (c_mktsegment <> 'BUILDING') AS BIGINT) AS n_with_value, CAST(count(*) FILTER (c_mktsegment = 'BUILDING') AS BIGINT) AS n_excluded,
    round(count(value) FILTER (c_mktsegment <> 'BUILDING') / count(*) FILTER (c_mktsegment <> 'BUILDING'), 6) AS coverage FROM customer CROSS JOIN (SELECT DISTINCT year FROM g) y LEFT JOIN g ON g.key = c_custkey AND g.year = y.year GROUP BY y.year"""
)
def coverage_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = facts.customer_years(spark, sf_dir)
    customers = facts.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.when(F.col("c_mktsegment") == "BUILDING", "not_formed").otherwise("exists").alias("status"))
    cells = customers.crossJoin(F.broadcast(g.select("year").distinct())).join(g, ["key", "year"], "left")
    return scoring.coverage(cells, ["year"], "status", "value").withColumn("coverage", _r("coverage", 6))


_EVENTS_SQL = "SELECT event_id, user_id, event_type FROM events WHERE "


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations of countries (by code or by name alone) and leaders; clicks have no year."""
    events = facts.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.when(F.col("event_type") != "click", F.year("ts")).alias("year"), F.col("event_type").alias("source_id"), F.lit("stream").alias("family"), F.col("event_type").alias("indicator_code"))
    user = (F.col("user_id") % 7).cast("string")
    return events.withColumns({"country_code": F.when(F.col("user_id") % 2 == 0, user), "country_name": F.concat(F.lit("Land "), user), "leader_id": user, "leader_name": user})


_IDS = ("event_id", "user_id", "event_type")


@query(_EVENTS_SQL + "event_type IN ('click', 'view') AND ((user_id % 2 = 0 AND user_id % 7 = 3) OR user_id % 7 = 4)")
def evidence_filter_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.matching(_events(spark, sf_dir), {"source": ("click", "view"), "country": ("3", "Land 4")}).select(*_IDS)


@query(_EVENTS_SQL + "user_id % 7 IN (2, 5)")
def country_match_any_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.matching(_events(spark, sf_dir), {"country": (" LAND 2", "land 5 ")}).select(*_IDS)


@query("SELECT event_id, event_type = 'view' AS by_source, false AS by_nothing FROM events")
def evidence_filter_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No values match nothing, unlike a dimension that is not named."""
    return _events(spark, sf_dir).select("event_id", evidence.matches({"source": ("view",)}).alias("by_source"), evidence.matches({"source": ("view",), "indicator": ()}).alias("by_nothing"))


@query(_EVENTS_SQL + "event_type <> 'click' AND year(ts) IN (SELECT year(min(ts)) FROM events)")
def evidence_filter_null_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null year matches no year, though clicks are of the same days."""
    first = facts.table(spark, sf_dir, "events").agg(F.year(F.min("ts"))).first()[0]
    return evidence.matching(_events(spark, sf_dir), {"year": (first,)}).select(*_IDS)


_PLAN = [("1-URGENT", "required", "F", "a"), ("2-HIGH", "preferred", "F", "a"), ("3-MEDIUM", "preferred", "O", "b"), ("5-LOW", "fallback", "O", "b")]
_SCORE_SQL = f"""WITH {_OBS_SQL}, n AS (SELECT country, year, variable_name, source_id, least(value / 500000, 1) AS v, CASE variable_name WHEN '1-URGENT' THEN 'a' WHEN '2-HIGH' THEN 'a' ELSE 'b' END AS grp FROM obs WHERE variable_name <> '4-NOT SPECIFIED'),
    m AS (SELECT country, year, grp, avg(v) AS m FROM n GROUP BY ALL), s AS (SELECT country, year, sum(CASE grp WHEN 'a' THEN 0.7 ELSE 0.3 END * m) AS score FROM m GROUP BY ALL),
    k AS (SELECT country, year, count(DISTINCT source_id) AS n_sources, count(DISTINCT variable_name) AS n_observed, count(DISTINCT CASE WHEN variable_name = '1-URGENT' THEN 1 END) AS n_required FROM n GROUP BY ALL),
    j AS (SELECT c_custkey AS country, y.year, coalesce(n_sources, 0) AS n_sources, coalesce(n_observed, 0) AS n_observed, coalesce(n_required, 0) AS n_required, CASE WHEN n_sources >= 2 THEN least(greatest(score, 0), 1) END AS v
          FROM customer CROSS JOIN (SELECT DISTINCT year FROM obs) y LEFT JOIN k ON k.country = c_custkey AND k.year = y.year LEFT JOIN s ON s.country = c_custkey AND s.year = y.year)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = _observations(spark, sf_dir).withColumns({"category": F.lit("demo"), "normalized_value": F.least(F.col("value") / 500000, F.lit(1.0)), "temporal_kind": F.lit("direct"), "country_iso3": F.col("country")})
    plan = spark.createDataFrame([("demo", *p) for p in _PLAN], "category string, variable_name string, role string, owning_source string, rubric_group string")
    weights = spark.createDataFrame([("demo", "a", 0.7), ("demo", "b", 0.3)], "category string, rubric_group string, weight double")
    categories = spark.createDataFrame([("demo", 2, False, False)], "category string, min_sources int, fixed_flags boolean, owner_only boolean")
    years = F.broadcast(facts.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct())
    entities = facts.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("country_iso3")).crossJoin(years)
    return scoring.scored(obs, plan, weights, categories, entities, ("country_iso3", "year"))


@query(
    _SCORE_SQL
    + """ SELECT country AS country_iso3, year, round(v, 6) AS normalized_score, CAST(n_observed AS BIGINT) AS n_observed, CAST(n_sources AS BIGINT) AS n_sources, CASE WHEN n_sources >= 2 THEN 'scored' ELSE 'insufficient_data' END AS status,
    array_to_string(list_filter([CASE WHEN n_sources < 2 THEN 'insufficient_data' END, CASE WHEN n_required < 1 THEN 'missing_primary_source' END, CASE WHEN n_observed / 4 < 0.5 THEN 'sparse_data' END], lambda x: x IS NOT NULL), '|') AS flags FROM j"""
)
def weighted_group_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("country_iso3", "year", _r("normalized_score", 6).alias("normalized_score"), "n_observed", "n_sources", "status", "flags")


@query(_SCORE_SQL + " SELECT country AS country_iso3, year, CAST(floor(1 + 9 * v + 0.5) AS INT) AS score_1_10 FROM j")
def score_1_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("country_iso3", "year", "score_1_10")


@query(
    """WITH s AS (SELECT p_partkey, p_size, CAST(least(100, greatest(0, round_even(round(0.35 * (p_size * 2) + 0.25 * 70 + 0.25 * 80 + 0.15 * (p_partkey % 101), 9), 0))) AS INT) AS confidence FROM part)
    SELECT p_partkey, confidence, CASE WHEN confidence >= 85 THEN 'very_high' WHEN confidence >= 70 THEN 'high' WHEN confidence >= 50 THEN 'medium' WHEN confidence >= 30 THEN 'low' ELSE 'very_low' END AS band FROM s"""
)
def confidence_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = facts.table(spark, sf_dir, "part")
    score = S.confidence(F.col("p_size") * 2, F.lit(70), F.lit(80), F.col("p_partkey") % 101)
    return part.select("p_partkey", score.alias("confidence")).withColumn("band", S.band(F.col("confidence")))


@query(
    """WITH t AS (SELECT p_partkey, CAST(p_size % 11 AS INT) AS ours, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_partkey % 11 AS INT) END AS theirs, CAST(p_partkey % 101 AS INT) AS conf FROM part)
    SELECT p_partkey, CASE WHEN theirs IS NULL THEN 'missing' WHEN abs(ours - theirs) <= 1 THEN 'match' WHEN abs(ours - theirs) > 2 THEN 'high_delta' ELSE 'conflict' END AS status,
    ours IS NULL OR coalesce(abs(ours - theirs) > 2, false) OR conf < 60 AS review FROM t"""
)
def validation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = facts.table(spark, sf_dir, "part")
    ours, theirs = (F.col("p_size") % 11).cast("int"), F.when(F.col("p_partkey") % 9 != 0, (F.col("p_partkey") % 11).cast("int"))
    return part.select("p_partkey", S.match_status(ours, theirs).alias("status"), S.needs_review(ours, theirs, F.col("p_partkey") % 101, F.lit(False)).alias("review"))


def _concept_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as observations: the first's quantity, the second's discount and others by order, with gaps, doubles and zeros as they come."""
    lines = facts.table(spark, sf_dir, "lineitem")
    code = F.when(F.col("l_linenumber") == 1, "rgdpo").when(F.col("l_linenumber") == 2, "pop").otherwise("other")
    return lines.select(F.lit("pwt").alias("source_id"), F.col("l_orderkey").alias("country_code"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("observation_id"), code.alias("indicator_code"), F.when(F.col("l_linenumber") == 1, F.col("l_quantity")).otherwise(F.col("l_discount")).alias("value"))


_LINES_SQL = "l AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN l_quantity ELSE l_discount END AS value FROM lineitem WHERE l_linenumber <= 2)"
_DERIVED_SQL = f"""WITH {_LINES_SQL}, s AS (SELECT l_orderkey, count(*) FILTER (l_linenumber = 1) AS nt, count(*) FILTER (l_linenumber = 2) AS nb, min(value) FILTER (l_linenumber = 1) AS t, min(value) FILTER (l_linenumber = 2) AS b FROM l GROUP BY ALL),
    d AS (SELECT l_orderkey AS country_code, CASE WHEN nt = 0 THEN 'missing_numerator' WHEN nb = 0 THEN 'missing_denominator' WHEN nt > 1 OR nb > 1 THEN 'ambiguous' WHEN b = 0 THEN 'zero_denominator' END AS reason, t, b FROM s)"""


@query(f"WITH {_LINES_SQL} SELECT l_orderkey AS country_code, 'gdp' AS concept, value, 'numeric' AS value_type FROM l WHERE l_linenumber = 1")
def concept_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = spark.createDataFrame([("gdp", "pwt", "rgdpo")], "concept string, source_id string, indicator_code string")
    return concepts.direct(_concept_observations(spark, sf_dir), mapping).select("country_code", "concept", "value", "value_type")


@query(f"{_DERIVED_SQL} SELECT country_code, round(t / b, 6) AS value FROM d WHERE reason IS NULL")
def concept_derived_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = concepts.rows_and_warnings(concepts.ratio(_concept_observations(spark, sf_dir), "rgdpo", "pop", ("source_id", "country_code")))
    return rows.select("country_code", _r("value", 6).alias("value"))


@query(f"{_DERIVED_SQL} SELECT country_code, reason FROM d WHERE reason IS NOT NULL")
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, gone = concepts.rows_and_warnings(concepts.ratio(_concept_observations(spark, sf_dir), "rgdpo", "pop", ("source_id", "country_code")))
    return gone.select("country_code", "reason")


# Scalars


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT page_id, CAST(len(regexp_extract_all(html, '<li>')) AS INT) AS n_items, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def regex_html_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.size(F.regexp_extract_all("html", F.lit("<li>"), F.lit(0)))
    return facts.table(spark, sf_dir, "pages").select("page_id", items.alias("n_items"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9'']+', ' ', 'g')) AS name, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')) AS match_key FROM documents")
def name_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.table(spark, sf_dir, "documents").select("doc_id", S.plain_name(F.col("text")).alias("name"), S.plain_name(F.col("text"), False).alias("match_key"))


@query("SELECT o_orderkey, round(o_totalprice, 2) AS price, CAST(year(o_orderdate) // 10 * 10 AS INT) AS decade, round(year(o_orderdate) + (dayofyear(o_orderdate) - 1) / 365.0, 6) AS decimal_year FROM orders")
def comma_decimal_and_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.regexp_replace(F.format_string("%.2f", "o_totalprice"), r"\.", ",")
    return facts.table(spark, sf_dir, "orders").select("o_orderkey", _r(S.comma_decimal(text), 2).alias("price"), S.decade(F.year("o_orderdate")).alias("decade"), _r(S.decimal_year(F.to_date("o_orderdate")), 6).alias("decimal_year"))


@query("SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size > 40 THEN 'large' END, CASE WHEN p_retailprice > 1500 THEN 'dear' END, CASE WHEN p_size % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL), '|') AS flags FROM part")
def ordered_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = S.flags((F.col("p_size") > 40, "large"), (F.col("p_retailprice") > 1500, "dear"), (F.col("p_size") % 2 == 0, "even"), (F.col("p_size") > 40, "large"))
    return facts.table(spark, sf_dir, "part").select("p_partkey", text.alias("flags"))


@query("SELECT s_suppkey, substr(sha256(s_name), 1, 10) AS short_hash, round_even((7 - (s_suppkey % 7 + 1)) / 6.0, 6) AS rating FROM supplier")
def hashes_and_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.table(spark, sf_dir, "supplier").select("s_suppkey", S.short_hash(F.col("s_name")).alias("short_hash"), S.freedom_rating(F.col("s_suppkey") % 7 + 1).alias("rating"))


@query("SELECT o_custkey, o_orderkey, o_totalprice, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 4) AS running FROM orders")
def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return facts.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", _r(F.sum("o_totalprice").over(w)).alias("running"))


# Chronicle: nations as countries, order years moved to 2019..2025, order status as the source


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = facts.table(spark, sf_dir, "orders").join(facts.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    by = orders.groupBy("c_nationkey", (F.year("o_orderdate") + 24).alias("year"), "o_orderstatus").agg(F.count("*").cast("double").alias("n"), F.sum(facts.money()).cast("double").alias("total"))
    # a map by status: all sources read the same aggregate, so orders are scanned and exchanged once for them
    by = by.groupBy("c_nationkey", "year").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", F.struct("n", "total")))).alias("cells"))
    nations = F.broadcast(facts.table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("iso3")))
    by = by.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).drop("c_nationkey")
    some = lambda c, k: F.when((F.col("n_nationkey") + F.col("year")) % k != 0, c)
    m, w, v = (by.withColumn("_c", F.col("cells")[x]).where("_c is not null").select("n_nationkey", "iso3", "year", "_c.n", "_c.total") for x in "FOP")
    scope = nations.select("iso3", F.initcap("iso3").alias("name"), (F.lit(2019) + F.col("n_nationkey") % 3).alias("start_year"), (F.lit(2023) + F.col("n_nationkey") % 3).alias("end_year"))
    return {
        "scope": scope,
        "maddison": m.where("year <= 2022").select("iso3", "year", some(F.col("n") / 1000, 5).alias("pop"), (F.col("total") / F.col("n")).alias("gdppc")),
        "wdi": w.select("iso3", "year", some(F.col("n"), 3).alias("population"), some(F.col("total"), 4).alias("gdp_constant"), some(F.col("total") * 2, 7).alias("gdp_current"), some(F.col("total") / F.col("n"), 2).alias("gdp_per_capita")),
        "vdem": v.select("iso3", "year", F.lit(None).cast("double").alias("e_wb_pop"), some(F.col("n"), 2).alias("e_mipopula"), F.lit(None).cast("double").alias("e_pop"), F.col("total").alias("e_gdp"), (F.col("total") / F.col("n")).alias("e_gdppc"), (F.col("n_nationkey") % 5).alias("v2x_regime"), (F.col("n") % 10 / 10).alias("v2x_polyarchy"), (F.col("n_nationkey") % 4 != 0).cast("double").alias("v2svindep")),
        "sipri": w.where("n > 1").select("iso3", "year", (F.col("total") / 100).alias("military_spend")),
        "area": scope.select("iso3", F.lit(2019).alias("gwsyear"), F.lit(2023).alias("gweyear"), F.length("name").cast("double").alias("area")),
        "leaders": orders.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("iso3", "n_nationkey", (F.year("o_orderdate") + 24).alias("year"), F.month("o_orderdate").alias("month"), F.col("o_orderpriority").alias("leader"), F.add_months(F.to_date("o_orderdate"), 288).alias("startdate"), F.add_months(F.to_date("o_orderdate"), 290).alias("enddate")),
    }


_LADDER_SQL = """WITH b AS (SELECT n_nationkey AS k, n_name AS iso3, CAST(year(o_orderdate) + 24 AS INT) AS year, o_orderstatus AS st, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
    g AS (SELECT n_name AS iso3, y.year FROM nation CROSS JOIN (SELECT CAST(unnest(range(2019, 2026)) AS INT) AS year) y),
    m AS (SELECT iso3, year, CASE WHEN (k + year) % 5 <> 0 THEN n / 1000 END AS pop, total / n AS head FROM b WHERE st = 'F' AND year <= 2022),
    w AS (SELECT iso3, year, CASE WHEN (k + year) % 3 <> 0 THEN n END AS pop, CASE WHEN (k + year) % 4 <> 0 THEN total END AS gc, CASE WHEN (k + year) % 7 <> 0 THEN total * 2 END AS gn, CASE WHEN (k + year) % 2 <> 0 THEN total / n END AS head FROM b WHERE st = 'O'),
    v AS (SELECT iso3, year, total AS gdp, total / n AS head FROM b WHERE st = 'P'),
    j AS (SELECT g.iso3, g.year, m.pop * 1000 AS mp, m.head * m.pop * 1000 AS mg, m.head AS mh, w.pop AS wp, w.gc, w.gn, w.head AS wh, v.gdp AS vg, v.head AS vh
          FROM g LEFT JOIN m ON m.iso3 = g.iso3 AND m.year = least(g.year, 2022) LEFT JOIN w ON w.iso3 = g.iso3 AND w.year = g.year LEFT JOIN v ON v.iso3 = g.iso3 AND v.year = g.year),
    s AS (SELECT *, CASE WHEN year <= 2022 AND mg IS NOT NULL THEN 'maddison_project' WHEN coalesce(gc, gn) IS NOT NULL THEN 'wdi' WHEN year = 2023 AND mg IS NOT NULL THEN 'maddison_project' WHEN vg IS NOT NULL THEN 'vdem' END AS gs,
          CASE WHEN year <= 2022 AND mp IS NOT NULL THEN 'maddison_project' WHEN wp IS NOT NULL THEN 'wdi' WHEN year = 2023 AND mp IS NOT NULL THEN 'maddison_project' END AS ps FROM j)
    SELECT iso3, year, CASE gs WHEN 'maddison_project' THEN round(mg + 0.0011, 2) WHEN 'wdi' THEN round(coalesce(gc, gn) + 0.0011, 2) WHEN 'vdem' THEN round(vg + 0.0011, 2) END AS gdp, gs AS gdp_source,
    CASE gs WHEN 'maddison_project' THEN '2011_intl_dollars' WHEN 'wdi' THEN CASE WHEN gc IS NOT NULL THEN 'constant_2015_usd' ELSE 'current_usd' END WHEN 'vdem' THEN 'vdem_latent_gdp_units' END AS gdp_unit,
    CASE WHEN year <= 2022 AND mp IS NOT NULL THEN 'maddison_direct' WHEN year = 2023 AND mp IS NOT NULL AND wh IS NULL AND gs = 'maddison_project' AND ps = 'maddison_project' THEN 'maddison_direct_proxy' WHEN wh IS NOT NULL THEN 'wdi_direct' WHEN gs = 'vdem' THEN 'vdem_latent_direct' WHEN gs = ps AND gs IN ('maddison_project', 'wdi') THEN 'derived_gdp_over_population' END AS method FROM s"""


@query(_LADDER_SQL)
def economy_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _sources(spark, sf_dir)
    out = chronicle.with_economy(chronicle.grid(x["scope"].select("iso3"), 2019, 2025), x["maddison"], x["wdi"], x["vdem"])
    return out.select("iso3", "year", _r(F.col("gdp.value") + 0.0011, 2).alias("gdp"), F.col("gdp.source").alias("gdp_source"), F.col("gdp.unit").alias("gdp_unit"), F.col("gdp_per_capita.method").alias("method"))


def _chronicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _sources(spark, sf_dir)
    leaders = x["leaders"]
    archigos = leaders.where("n_nationkey >= 20 and year < 2021").select("iso3", "leader", "startdate", "enddate")
    curated = leaders.where("n_nationkey < 3").select("iso3", "leader", "startdate", "enddate")
    reign = leaders.where("n_nationkey between 3 and 12").select("iso3", "year", "month", "leader")
    wikidata = leaders.where("n_nationkey >= 8").select("iso3", "year", "leader")
    ruled = chronicle.rulers(archigos, reign, curated, wikidata, 2019, 2025)
    return chronicle.build(x["scope"], x["vdem"], x["wdi"], x["maddison"], x["sipri"], x["area"], ruled, 2019, 2025)


#: The chronicle of the sources above, field by field. Spells of archigos count up to 2015, so none does in these years.
_CHRONICLE_SQL = """WITH b AS (SELECT n_nationkey AS k, n_name AS iso3, CAST(year(o_orderdate) + 24 AS INT) AS year, o_orderstatus AS st, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
    le AS (SELECT n_nationkey AS k, n_name AS iso3, CAST(year(o_orderdate) + 24 AS INT) AS year, month(o_orderdate) AS month, o_orderpriority AS leader, CAST(CAST(o_orderdate AS DATE) + INTERVAL 288 MONTH AS DATE) AS s, CAST(CAST(o_orderdate AS DATE) + INTERVAL 290 MONTH AS DATE) AS e FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    g AS (SELECT n_nationkey AS k, n_name AS iso3, upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS name, 2019 + n_nationkey % 3 AS start_year, 2023 + n_nationkey % 3 AS end_year, CAST(y.year AS INT) AS year FROM nation CROSS JOIN (SELECT unnest(range(2019, 2026)) AS year) y),
    m AS (SELECT iso3, year, CASE WHEN (k + year) % 5 <> 0 THEN n / 1000 END * 1000 AS mp, total / n AS mh, (total / n) * CASE WHEN (k + year) % 5 <> 0 THEN n / 1000 END * 1000 AS mg FROM b WHERE st = 'F' AND year <= 2022),
    w AS (SELECT iso3, year, CASE WHEN (k + year) % 3 <> 0 THEN n END AS wp, CASE WHEN (k + year) % 4 <> 0 THEN total END AS gc, CASE WHEN (k + year) % 7 <> 0 THEN total * 2 END AS gn, CASE WHEN (k + year) % 2 <> 0 THEN total / n END AS wh, CASE WHEN n > 1 THEN total / 100 END AS mil FROM b WHERE st = 'O'),
    v AS (SELECT k, iso3, year, total AS vg, total / n AS vh, k % 5 AS regime, (n % 10) / 10 AS poly, CASE WHEN (k + year) % 2 <> 0 THEN n END * 1000 AS vp FROM b WHERE st = 'P'),
    vy AS (SELECT iso3, CAST(unnest(range(min(year), max(year) + 2)) AS INT) AS year FROM v GROUP BY iso3), vj AS (SELECT vy.iso3, vy.year, vp FROM vy LEFT JOIN v USING (iso3, year)),
    vk AS (SELECT *, last_value(CASE WHEN vp IS NOT NULL THEN year END IGNORE NULLS) OVER p AS py, last_value(vp IGNORE NULLS) OVER p AS pv, first_value(CASE WHEN vp IS NOT NULL THEN year END IGNORE NULLS) OVER f AS ny, first_value(vp IGNORE NULLS) OVER f AS nv FROM vj
          WINDOW p AS (PARTITION BY iso3 ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f AS (PARTITION BY iso3 ORDER BY year ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    vf AS (SELECT iso3, year, coalesce(vp, pv + (nv - pv) * (year - py) / (ny - py), CASE WHEN year - py <= 1 THEN pv END) AS vpop, CASE WHEN vp IS NOT NULL THEN 'exact' WHEN ny > py THEN 'interpolated' ELSE 'proxy' END AS vmethod FROM vk),
    dep AS (SELECT iso3, CAST(unnest(range(min(year), max(year) + 1)) AS INT) AS year, min(k) % 4 = 0 AS dependent FROM v GROUP BY iso3),
    rc AS (SELECT iso3, year, leader, count(*) AS n FROM le WHERE k BETWEEN 3 AND 12 AND year <= 2021 GROUP BY iso3, year, leader), r AS (SELECT *, count(*) OVER (PARTITION BY iso3, year) > 1 AS many FROM rc QUALIFY row_number() OVER (PARTITION BY iso3, year ORDER BY n DESC, leader) = 1),
    sx AS (SELECT iso3, CAST(y AS INT) AS year, leader, s, date_diff('day', greatest(s, make_date(y, 1, 1)), least(e, make_date(y, 12, 31))) + 1 AS days FROM (SELECT *, unnest(range(year(s), year(e) + 1)) AS y FROM le WHERE k < 3) WHERE y BETWEEN 2019 AND 2025),
    sp AS (SELECT iso3, year, leader, count(*) OVER (PARTITION BY iso3, year) > 1 AS many FROM sx WHERE days > 0 QUALIFY row_number() OVER (PARTITION BY iso3, year ORDER BY days DESC, s, leader) = 1),
    wk AS (SELECT iso3, year, min(leader) AS leader FROM le WHERE k >= 8 AND year > 2021 GROUP BY ALL),
    j AS (SELECT g.*, mp, mh, mg, wp, coalesce(gc, gn) AS wg, gc IS NOT NULL AS constant, wh, mil, vg, vh, regime, poly, vpop, vmethod, coalesce(dependent, false) AS dependent,
          CASE WHEN g.k < 3 THEN sp.leader ELSE coalesce(r.leader, wk.leader) END AS leader, CASE WHEN g.k < 3 THEN coalesce(sp.many, false) ELSE coalesce(r.many, false) END AS many, CASE WHEN g.k < 3 THEN 'curated' WHEN r.leader IS NOT NULL THEN 'reign' ELSE 'wikidata' END AS leader_source
          FROM g LEFT JOIN m ON m.iso3 = g.iso3 AND m.year = least(g.year, 2022) LEFT JOIN w ON w.iso3 = g.iso3 AND w.year = g.year LEFT JOIN v ON v.iso3 = g.iso3 AND v.year = g.year LEFT JOIN vf ON vf.iso3 = g.iso3 AND vf.year = g.year LEFT JOIN dep ON dep.iso3 = g.iso3 AND dep.year = g.year
          LEFT JOIN r ON r.iso3 = g.iso3 AND r.year = g.year LEFT JOIN sp ON sp.iso3 = g.iso3 AND sp.year = g.year LEFT JOIN wk ON wk.iso3 = g.iso3 AND wk.year = g.year),
    s AS (SELECT *, CASE WHEN year < start_year THEN 'not_formed' WHEN year > end_year THEN 'split_or_dissolved' ELSE 'exists' END AS existence_status,
          CASE WHEN year <= 2022 AND mg IS NOT NULL THEN 'maddison_project' WHEN wg IS NOT NULL THEN 'wdi' WHEN year = 2023 AND mg IS NOT NULL THEN 'maddison_project' WHEN vg IS NOT NULL THEN 'vdem' END AS gs,
          CASE WHEN year <= 2022 AND mp IS NOT NULL THEN 'maddison_project' WHEN wp IS NOT NULL THEN 'wdi' WHEN year = 2023 AND mp IS NOT NULL THEN 'maddison_project' WHEN vpop IS NOT NULL THEN 'vdem' END AS ps,
          CASE regime WHEN 0 THEN 'Authoritarian' WHEN 1 THEN 'Hybrid regime' WHEN 2 THEN 'Flawed democracy' WHEN 3 THEN 'Full democracy' ELSE CASE WHEN poly >= 0.7 THEN 'Full democracy' WHEN poly >= 0.5 THEN 'Flawed democracy' WHEN poly >= 0.3 THEN 'Hybrid regime' WHEN poly IS NOT NULL THEN 'Authoritarian' ELSE 'Unknown' END END AS political_regime,
          CAST(CASE WHEN regime < 4 THEN 80 WHEN poly IS NOT NULL THEN 70 ELSE 50 END AS INT) AS regime_confidence, leader IS NULL AND dependent AS colonial FROM j),
    t AS (SELECT *, CASE gs WHEN 'maddison_project' THEN mg WHEN 'wdi' THEN wg WHEN 'vdem' THEN vg END AS gdp, CASE ps WHEN 'maddison_project' THEN mp WHEN 'wdi' THEN wp WHEN 'vdem' THEN vpop END AS population,
          CASE gs WHEN 'maddison_project' THEN '2011_intl_dollars' WHEN 'wdi' THEN CASE WHEN constant THEN 'constant_2015_usd' ELSE 'current_usd' END WHEN 'vdem' THEN 'vdem_latent_gdp_units' END AS gdp_unit,
          CASE WHEN year <= 2022 AND mp IS NOT NULL THEN 'maddison_direct' WHEN year = 2023 AND mp IS NOT NULL AND wh IS NULL AND gs = 'maddison_project' AND ps = 'maddison_project' THEN 'maddison_direct_proxy' WHEN wh IS NOT NULL THEN 'wdi_direct' WHEN gs = 'vdem' THEN 'vdem_latent_direct' WHEN gs = ps AND gs IN ('maddison_project', 'wdi') THEN 'derived_gdp_over_population' END AS method,
          CASE WHEN political_regime IN ('Full democracy', 'Flawed democracy') THEN 'Liberal capitalist democracy' WHEN political_regime = 'Unknown' THEN 'Unknown' ELSE 'Mixed / unclear' END AS system_type,
          CASE WHEN existence_status = 'exists' THEN CAST(length(name) AS DOUBLE) END AS area, CASE WHEN colonial THEN 'colonial-rule' ELSE leader END AS ruler_name, CASE WHEN colonial THEN 'colonial_rule_placeholder' WHEN leader IS NOT NULL THEN leader_source END AS ruler_source,
          coalesce(gs = 'wdi' OR ps = 'wdi', false) AS has_wdi, coalesce(gs = 'maddison_project' OR ps = 'maddison_project', false) AS has_m, leader IS NOT NULL OR colonial AS has_ruler FROM s),
    u AS (SELECT *, CASE method WHEN 'maddison_direct' THEN mh WHEN 'maddison_direct_proxy' THEN mh WHEN 'wdi_direct' THEN wh WHEN 'vdem_latent_direct' THEN vh WHEN 'derived_gdp_over_population' THEN gdp / population END AS gdp_per_capita,
          CAST(greatest(0, least(100, round_even(round(0.35 * regime_confidence + 0.25 * CASE WHEN system_type = 'Unknown' THEN 30 ELSE 40 END + CASE WHEN has_wdi THEN 0.13 * 80 ELSE 0 END + CASE WHEN mil IS NOT NULL THEN 0.10 * 80 ELSE 0 END + CASE WHEN has_m THEN 0.10 * 80 ELSE 0 END + CASE WHEN has_ruler THEN 0.07 * 80 ELSE 0 END, 9), 0))) AS INT) AS row_confidence,
          array_to_string(list_filter([CASE WHEN year < start_year THEN 'pre_existence_gap' END, CASE WHEN year > end_year THEN 'post_existence_gap' END, CASE WHEN year > 2023 AND area IS NOT NULL THEN 'area_proxy_year_used' END, CASE WHEN coalesce(regime >= 4, true) THEN 'regime_source_gap' END, CASE WHEN system_type = 'Unknown' THEN 'system_type_low_confidence' END,
            CASE WHEN population IS NULL THEN 'missing_population' END, CASE WHEN gdp IS NULL THEN 'missing_gdp' END, CASE WHEN mil IS NULL THEN 'missing_military_spend' END, CASE WHEN area IS NULL THEN 'missing_area' END, CASE WHEN ruler_name IS NULL THEN 'missing_ruler' END, 'controlled_area_not_modeled', CASE WHEN area IS NOT NULL THEN 'controlled_area_country_only' END,
            CASE WHEN ps = 'vdem' AND vmethod = 'interpolated' THEN 'population_interpolated' END, CASE WHEN ps = 'vdem' AND vmethod = 'proxy' THEN 'population_proxy_year_used' END, CASE WHEN many THEN 'multiple_rulers' END, CASE WHEN colonial THEN 'colonial_rule_placeholder' END,
            CASE WHEN year = 2023 AND has_m THEN 'proxy_year_used' END], lambda x: x IS NOT NULL), '|') AS flags FROM t)
    """
_ROUNDED = ("population", "gdp", "gdp_per_capita", "military_spend")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: _r(F.col(c) + 0.0011, 2) for c in _ROUNDED if c in df.columns})


@query(
    _CHRONICLE_SQL
    + """SELECT iso3, year, name, existence_status, political_regime, CASE WHEN regime < 4 THEN CAST(regime AS VARCHAR) WHEN poly IS NOT NULL THEN printf('%.4f', poly) ELSE '' END AS regime_raw_score, regime_confidence, system_type, 'vdem' AS system_source, CAST(CASE WHEN system_type = 'Unknown' THEN 30 ELSE 40 END AS INT) AS system_confidence,
    round(population + 0.0011, 2) AS population, ps AS population_source, CAST(CASE WHEN ps = 'maddison_project' THEN least(year, 2022) WHEN ps IS NOT NULL THEN year END AS INT) AS population_year_used, round(gdp + 0.0011, 2) AS gdp, gdp_unit, gs AS gdp_source, CAST(CASE WHEN gs = 'maddison_project' THEN least(year, 2022) WHEN gs IS NOT NULL THEN year END AS INT) AS gdp_year_used,
    round(gdp_per_capita + 0.0011, 2) AS gdp_per_capita, CASE WHEN method LIKE 'maddison%' THEN '2011_intl_dollars' WHEN method = 'wdi_direct' THEN 'current_usd' WHEN method = 'vdem_latent_direct' THEN 'vdem_latent_gdppc_units' WHEN method IS NOT NULL THEN gdp_unit END AS gdp_per_capita_unit, method AS gdp_per_capita_method, round(mil + 0.0011, 2) AS military_spend, area AS country_area, area AS controlled_area,
    ruler_name, ruler_source, CAST(CASE WHEN leader IS NULL THEN 0 WHEN many THEN 50 WHEN leader_source = 'curated' THEN 70 WHEN leader_source = 'reign' THEN 65 ELSE 60 END AS INT) AS ruler_confidence, many AS multiple_rulers, row_confidence, flags AS data_quality_flags,
    'regime=vdem|wdi=' || CASE WHEN has_wdi THEN 'yes' ELSE 'no' END || '|sipri=' || CASE WHEN mil IS NOT NULL THEN 'yes' ELSE 'no' END || '|maddison=' || CASE WHEN has_m THEN 'yes' ELSE 'no' END || '|ruler=' || coalesce(ruler_source, 'none') || '|flags=' || replace(flags, '|', ',') AS provenance_summary FROM u"""
)
def chronicle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_chronicle(spark, sf_dir))


@query(
    _CHRONICLE_SQL
    + "SELECT iso3, year, name, existence_status, "
    + ", ".join(f"CASE WHEN existence_status = 'exists' THEN {x} END AS {n}" for x, n in [("political_regime", "political_regime"), ("system_type", "system_type"), *((f"round({c} + 0.0011, 2)", c) for c in _ROUNDED[:3]), ("area", "country_area"), ("ruler_name", "ruler_name"), ("row_confidence", "row_confidence")])
    + " FROM u"
)
def chronicle_condensed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(chronicle.condensed(_chronicle(spark, sf_dir)))


@query(
    _CHRONICLE_SQL
    + ", f AS (SELECT *, CASE WHEN political_regime IN ('Full democracy', 'Flawed democracy') THEN 'democracy' WHEN political_regime = 'Unknown' THEN 'unknown' ELSE 'authoritarian' END AS bucket FROM u)"
    + " UNION ALL ".join(f" SELECT 'chronicle.{c}' AS metric_id, year, strftime(make_date(year, 1, 1), '%Y-%m-%d') AS year_date, iso3 AS country_iso3, name AS country_name, political_regime, bucket AS political_regime_bucket, existence_status, round({c} + 0.0011, 2) AS value FROM f WHERE {c} IS NOT NULL" for c in _ROUNDED[:3])
)
def chronicle_metric_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chronicle.metric_fact(_chronicle(spark, sf_dir)).withColumns({"value": _r(F.col("value") + 0.0011, 2), "year_date": F.date_format("year_date", "yyyy-MM-dd")})


_LEADERS_SQL = "le AS (SELECT n_name AS iso3, n_nationkey, CAST(year(o_orderdate) + 24 AS INT) AS year, o_orderpriority AS leader FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"


@query(
    f"""WITH {_LEADERS_SQL}, rc AS (SELECT iso3, year, leader, count(*) AS n FROM le WHERE n_nationkey BETWEEN 3 AND 12 AND year <= 2021 GROUP BY iso3, year, leader), r AS (SELECT *, count(*) OVER (PARTITION BY iso3, year) AS k FROM rc QUALIFY row_number() OVER (PARTITION BY iso3, year ORDER BY n DESC, leader) = 1),
    w AS (SELECT iso3, year, min(leader) AS leader FROM le WHERE n_nationkey BETWEEN 3 AND 24 AND n_nationkey >= 8 AND year > 2021 GROUP BY ALL)
    SELECT iso3, year, coalesce(r.leader, w.leader) AS ruler_name, CASE WHEN r.leader IS NOT NULL THEN 'reign' ELSE 'wikidata' END AS ruler_source, CAST(CASE WHEN r.k > 1 THEN 50 WHEN r.leader IS NOT NULL THEN 65 ELSE 60 END AS INT) AS ruler_confidence, coalesce(r.k > 1, false) AS multiple_rulers FROM r FULL JOIN w USING (iso3, year)"""
)
def ruler_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaders = _sources(spark, sf_dir)["leaders"]
    none = leaders.where("false").select("iso3", "leader", "startdate", "enddate")
    return chronicle.rulers(none, leaders.where("n_nationkey between 3 and 12"), none, leaders.where("n_nationkey >= 8"), 2019, 2025)


@query(
    """SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value) + 0.000011, 4) AS total FROM events GROUP BY ALL"""
)
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ingest.event_windows(facts.table(spark, sf_dir, "events"))
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", _r(F.col("total") + 0.000011).alias("total"))


# Smaller operators


@query("SELECT event_type AS source_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users, array_to_string(list_sort(list(DISTINCT CAST(user_id % 5 AS VARCHAR))), '|') AS used FROM events GROUP BY event_type")
def rows_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = facts.table(spark, sf_dir, "events")
    used = F.array_join(F.array_sort(F.collect_set((F.col("user_id") % 5).cast("string"))), "|")
    return events.groupBy(F.col("event_type").alias("source_id")).agg(F.count("*").alias("n_rows"), F.count_distinct("user_id").alias("n_users"), used.alias("used"))


@query("SELECT o_custkey AS iso3, CAST(min(year(o_orderdate)) AS INT) AS start_year, CAST(max(year(o_orderdate)) AS INT) AS end_year, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS name FROM orders GROUP BY o_custkey")
def coverage_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = facts.table(spark, sf_dir, "orders")
    first = F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey"))
    return orders.groupBy(F.col("o_custkey").alias("iso3")).agg(F.min(F.year("o_orderdate")).alias("start_year"), F.max(F.year("o_orderdate")).alias("end_year"), first.alias("name"))


@query("WITH n AS (SELECT l_orderkey, max(l_returnflag) AS name FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey) SELECT l_orderkey, l_linenumber, name FROM lineitem LEFT JOIN n USING (l_orderkey)")
def self_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = facts.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    names = lines.where("l_returnflag <> 'N'").groupBy("l_orderkey").agg(F.max("l_returnflag").alias("name"))
    return lines.join(names, "l_orderkey", "left").select("l_orderkey", "l_linenumber", "name")


@query("SELECT c_custkey, CASE c_nationkey WHEN 2 THEN 'USA' WHEN 5 THEN 'FRA' WHEN 7 THEN 'IND' END AS iso3 FROM customer WHERE c_nationkey IN (2, 5, 7)")
def code_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = facts.table(spark, sf_dir, "customer").select("c_custkey", S.mapped(F.col("c_nationkey"), {2: "USA", 5: "FRA", 7: "IND"}).alias("iso3"))
    return mapped.where("iso3 is not null")


@query(
    """WITH p AS (SELECT o_custkey AS code, CAST(min(year(o_orderdate)) AS INT) AS a, CAST(max(year(o_orderdate)) AS INT) AS b FROM orders GROUP BY ALL), m(code, target, f, l) AS (SELECT c_custkey, 'old', 1900, 1997 FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'new', 1997, NULL FROM customer WHERE c_custkey % 3 = 0)
    SELECT code, a, b, target, greatest(a, f) AS from_year, CASE WHEN l IS NULL THEN b ELSE least(b, l) END AS to_year FROM p JOIN m USING (code) WHERE a <= coalesce(l, 9999) AND b >= f"""
)
def split_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = facts.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("code")).agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"))
    customers = facts.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"))
    old = customers.where("code % 2 = 0").select("code", F.lit("old").alias("target"), F.lit(1900).alias("first_year"), F.lit(1997).alias("last_year"))
    new = customers.where("code % 3 = 0").select("code", F.lit("new").alias("target"), F.lit(1997).alias("first_year"), F.lit(None).cast("int").alias("last_year"))
    return intervals.split_by_period(periods, old.unionByName(new), "code", "a", "b")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN substr(c_mktsegment, 1, 3) END AS iso3 FROM customer")
def reference_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.when(F.col("c_custkey") % 3 != 0, "wdi").otherwise("other")
    rows = facts.table(spark, sf_dir, "customer").select("c_custkey", F.concat_ws(":", prefix, F.lower(F.substring("c_mktsegment", 1, 3)), F.lit("2020")).alias("source_row_reference"))
    return adapters.link_by_reference(rows, ["wdi"]).select("c_custkey", "iso3")


_REGIME_SQL = """r AS (SELECT p_partkey, CAST(2020 + p_partkey % 8 AS INT) AS year, CASE WHEN p_size % 6 < 4 THEN p_size % 6 END AS g, CASE WHEN p_partkey % 7 <> 0 THEN p_size / 50.0 END AS s, p_partkey % 3 AS c FROM part),
    b AS (SELECT *, CASE g WHEN 0 THEN 'Authoritarian' WHEN 1 THEN 'Hybrid regime' WHEN 2 THEN 'Flawed democracy' WHEN 3 THEN 'Full democracy' ELSE CASE WHEN s >= 0.7 THEN 'Full democracy' WHEN s >= 0.5 THEN 'Flawed democracy' WHEN s >= 0.3 THEN 'Hybrid regime' WHEN s IS NOT NULL THEN 'Authoritarian' ELSE 'Unknown' END END AS bucket FROM r)"""


def _regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = facts.table(spark, sf_dir, "part")
    rows = part.select("p_partkey", F.col("p_partkey").cast("string").alias("iso3"), (F.lit(2020) + F.col("p_partkey") % 8).cast("int").alias("year"))
    size = F.col("p_size") % 6
    source = part.select(F.col("p_partkey").cast("string").alias("iso3"), F.least(F.lit(2020) + F.col("p_partkey") % 8, F.lit(2025)).cast("int").alias("year"), F.when(size < 4, size).cast("double").alias("v2x_regime"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_size") / 50.0).alias("v2x_polyarchy"))
    return chronicle.with_regime(rows, source)


@query(f"WITH {_REGIME_SQL} SELECT p_partkey, bucket AS political_regime, CAST(CASE WHEN year > 2025 THEN 60 WHEN g IS NOT NULL THEN 80 WHEN s IS NOT NULL THEN 70 ELSE 50 END AS INT) AS regime_confidence FROM b")
def regime_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regimes(spark, sf_dir).select("p_partkey", "political_regime", "regime_confidence")


@query(
    f"""WITH {_REGIME_SQL} SELECT p_partkey, CASE WHEN c = 0 AND year BETWEEN 2020 AND 2023 THEN 'Curated' WHEN bucket IN ('Full democracy', 'Flawed democracy') THEN 'Liberal capitalist democracy' WHEN bucket = 'Unknown' THEN 'Unknown' ELSE 'Mixed / unclear' END AS system_type,
    CAST(CASE WHEN c = 0 AND year BETWEEN 2020 AND 2023 THEN 70 WHEN bucket = 'Unknown' THEN 30 ELSE 40 END AS INT) AS system_confidence FROM b"""
)
def system_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _regimes(spark, sf_dir).withColumn("iso3", F.when(F.col("p_partkey") % 3 == 0, "AAA").otherwise("BBB"))
    return chronicle.with_system(rows, (("AAA", 2020, 2023, "Curated"),)).select("p_partkey", "system_type", "system_confidence")


@query("WITH s AS (SELECT n_nationkey, CASE WHEN n_nationkey % 5 <> 0 THEN 1995 + n_nationkey % 4 END AS a, 1999 + n_nationkey % 3 AS b FROM nation), y AS (SELECT CAST(unnest(range(1995, 2002)) AS INT) AS year) SELECT n_nationkey, year, CASE WHEN a IS NULL THEN 'unknown' WHEN year < a THEN 'not_formed' WHEN year > b THEN 'split_or_dissolved' ELSE 'exists' END AS status FROM s CROSS JOIN y")
def existence_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    rows = chronicle.grid(facts.table(spark, sf_dir, "nation").select("n_nationkey"), 1995, 2001)
    return rows.select("n_nationkey", "year", chronicle.existence_status(F.when(key % 5 != 0, 1995 + key % 4), 1999 + key % 3, F.col("year")).alias("status"))


@query("WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY k) AS evidence FROM o WHERE k <= 3 GROUP BY o_custkey")
def capped_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    top = facts.table(spark, sf_dir, "orders").withColumn("_k", F.row_number().over(w)).where("_k <= 3")
    items = F.array_sort(F.collect_list(F.struct("_k", F.col("o_orderkey").cast("string").alias("v"))))
    return top.groupBy("o_custkey").agg(F.array_join(F.transform(items, lambda x: x["v"]), "|").alias("evidence"))


@query(
    """WITH e AS (SELECT CAST(user_id % 40 AS DOUBLE) AS country_id, CAST(year(ts) * 100 + month(ts) AS DOUBLE) AS year, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 END AS k, CASE WHEN event_id % 4 <> 0 THEN CAST(value AS DECIMAL(18, 2)) END AS best, CASE WHEN event_id % 3 = 0 THEN 1 END AS g FROM events),
    a AS (SELECT country_id, year, count(*) FILTER (k = 1) AS n1, sum(best) FILTER (k = 1) AS f1, count(*) FILTER (k = 1 AND g IS NOT NULL) AS n2, sum(best) FILTER (k = 1 AND g IS NOT NULL) AS f2, count(*) FILTER (k = 3) AS n3, sum(best) FILTER (k = 3) AS f3 FROM e GROUP BY ALL)
    SELECT c.country_id, y.year, CAST(coalesce(n1, 0) AS BIGINT) AS state_events, round(CAST(coalesce(f1, 0) AS DOUBLE), 2) AS state_fatalities, CAST(coalesce(n2, 0) AS BIGINT) AS intl_events, round(CAST(coalesce(f2, 0) AS DOUBLE), 2) AS intl_fatalities, CAST(coalesce(n3, 0) AS BIGINT) AS onesided_events, round(CAST(coalesce(f3, 0) AS DOUBLE), 2) AS onesided_fatalities
    FROM (SELECT DISTINCT country_id FROM a) c CROSS JOIN (SELECT DISTINCT year FROM a) y LEFT JOIN a ON a.country_id = c.country_id AND a.year = y.year"""
)
def conflict_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", 1.0).when(F.col("event_type") == "view", 2.0).when(F.col("event_type") == "purchase", 3.0)
    events = facts.table(spark, sf_dir, "events").select((F.col("user_id") % 40).cast("double").alias("country_id"), (F.year("ts") * 100 + F.month("ts")).cast("double").alias("year"), kind.alias("type_of_violence"), F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("best"), F.when(F.col("event_id") % 3 == 0, F.lit(1.0)).alias("gwnob"))
    out = adapters.aggregate_conflict_events(events)
    named = {f"ucdp_{a}_{m}": f"{b}_{m}" for a, b in (("state_based", "state"), ("intl", "intl"), ("onesided", "onesided")) for m in ("events", "fatalities")}
    return out.select("country_id", "year", *((_r(k, 2) if k.endswith("fatalities") else F.col(k)).alias(v) for k, v in named.items()))


@query(
    """WITH r AS (SELECT n_nationkey, (n_nationkey * 37 % 101) / 100.0 AS hdi, (n_nationkey * 53 % 61) / 10.0 - 3 AS z, CAST(n_nationkey % 11 AS INT) AS client FROM nation),
    s AS (SELECT n_nationkey, 'social' AS category, CASE WHEN n_nationkey % 4 <> 0 THEN CAST(round_even(least(1, greatest(0, hdi)) * 10, 0) AS INT) END AS score, n_nationkey % 3 = 0 AS proxy, client FROM r
          UNION ALL SELECT n_nationkey, 'integrity', CASE WHEN n_nationkey % 5 <> 0 THEN CAST(round_even(round(least(1, greatest(0, (z + 2.5) / 5)) * 10, 9), 0) AS INT) END, false, client FROM r),
    c AS (SELECT *, score IS NOT NULL AND proxy AS is_proxy, CASE WHEN score IS NULL THEN 0 WHEN proxy THEN 84 ELSE 88 END AS confidence FROM s)
    SELECT n_nationkey, category, score, is_proxy, CAST(confidence AS INT) AS confidence, CASE WHEN score IS NULL THEN 'missing' WHEN abs(score - client) <= 1 THEN 'match' WHEN abs(score - client) > 2 THEN 'high_delta' ELSE 'conflict' END AS status FROM c"""
)
def vertical_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    nations = facts.table(spark, sf_dir, "nation").select("n_nationkey", key.alias("iso3"))
    hdi = nations.where(key % 4 != 0).select("iso3", F.when(key % 3 == 0, 2022).otherwise(2023).alias("year"), F.lit("hdi").alias("variable_name"), (key * 37 % 101 / 100.0).alias("value"))
    z = nations.where(key % 5 != 0).select("iso3", F.lit(2023).alias("year"), F.lit("control_of_corruption").alias("variable_name"), (key * 53 % 61 / 10.0 - 3).alias("value"))
    client = nations.select("iso3", F.explode(F.array(F.lit("social"), F.lit("integrity"))).alias("category"), (key % 11).cast("int").alias("client_score"))
    out = slices.comparison(slices.scores(nations, hdi.unionByName(z), 2023, 2022), client)
    return out.select(F.col("iso3").alias("n_nationkey"), "category", "score", "is_proxy", "confidence", "status")


_PLAN_VALUES = ", ".join("(" + ", ".join(f"'{x}'" for x in line.split()) + ")" for line in categories.PLAN.splitlines())
_WEIGHT_VALUES = ", ".join(f"('{c}', '{g}', {w})" for c, (_, _, groups) in categories.CATEGORIES.items() for g, w in groups.items())
_LEAST_VALUES = ", ".join(f"('{c}', {k}, {max(years)})" for c, (k, years, _) in categories.CATEGORIES.items())


@query(
    f"""WITH p(category, v, role, direction, src, grp) AS (VALUES {_PLAN_VALUES}), wt(category, grp, w) AS (VALUES {_WEIGHT_VALUES}), k(category, least_n, reach) AS (VALUES {_LEAST_VALUES}),
    u AS (SELECT DISTINCT v, src FROM p), o AS (SELECT c_custkey AS id, v, src, CAST(2020 + (c_custkey * 7 + length(v)) % 5 AS INT) AS year, ((c_custkey * 13 + length(v) * 29) % 101) / 100.0 AS x FROM customer CROSS JOIN u WHERE (c_custkey + length(v) * 3 + ascii(v)) % 3 <> 0),
    b AS (SELECT o.id, p.category, p.v, p.role, p.src, p.grp, o.x, o.year FROM o JOIN p ON p.v = o.v AND p.src = o.src JOIN k ON k.category = p.category WHERE abs(o.year - 2023) <= reach),
    g AS (SELECT id, category, grp, avg(x) AS m FROM b GROUP BY ALL), t AS (SELECT id, category, sum(w * m) AS score FROM g JOIN wt USING (category, grp) GROUP BY ALL), n AS (SELECT id, category, count(DISTINCT src) AS n_sources, count(DISTINCT v) AS n_observed FROM b GROUP BY ALL)
    SELECT c_custkey AS country_iso3, k.category, round(CASE WHEN n_sources >= least_n THEN least(1, greatest(0, score)) END, 6) AS normalized_score, CASE WHEN n_sources >= least_n THEN 'scored' ELSE 'insufficient_data' END AS status, CAST(coalesce(n_observed, 0) AS BIGINT) AS n_observed
    FROM customer CROSS JOIN k LEFT JOIN n ON n.id = c_custkey AND n.category = k.category LEFT JOIN t ON t.id = c_custkey AND t.category = k.category"""
)
def category_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = facts.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("country_iso3"))
    variables = categories.plan(spark).select("variable_name", F.col("owning_source").alias("source_id")).distinct()
    size, key = F.length("variable_name"), F.col("country_iso3")
    obs = customers.crossJoin(F.broadcast(variables)).where((key + size * 3 + F.ascii("variable_name")) % 3 != 0)
    obs = obs.select("country_iso3", (2020 + (key * 7 + size) % 5).cast("int").alias("year"), "source_id", F.lit(0).alias("observation_id"), "variable_name", ((key * 13 + size * 29) % 101 / 100.0).alias("normalized_value"))
    return categories.score_all(obs, customers, 2023).select("country_iso3", "category", _r("normalized_score", 6).alias("normalized_score"), "status", "n_observed")
