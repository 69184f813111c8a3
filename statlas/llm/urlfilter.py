"""URL rules whose block decisions spread over redirects and canonical links.

A rule names a host (its subdomains included) and a path prefix. Pages that redirect to each
other, or name a canonical address, are one group: connected components over those edges. A
block of any address in a group blocks the others, unless an address has a rule of its own;
so an explicit allow takes precedence on the page that it names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlas.llm._util import cut, fresh, prepare
from statlas.llm.components import connected_components

#: Up to this number rules are compiled into one expression; more are joined by host and path prefix, with the same results.
COMPILED_RULES = 200


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _fixed(col: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(col, pattern, group)


def _after_scheme(url: Column) -> Column:
    """What follows the first ://; empty for null or where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(_fixed(_after_scheme(url), r"^([^/?#]*+)", 1), upper, lower)


def path_of(url: Column) -> Column:
    return _fixed(_after_scheme(url), r"^[^/?#]*+([^?#]*+)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(verdict, name) of the longest rule that fits, or null; of equal lengths the one with the longer host, then an allow."""
    out = F.lit(None).cast("struct<verdict:string,name:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.verdict == "allow")):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.name).alias("name"))).otherwise(out)
    return out


def _rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """(rhost, rpath, verdict, name), one row for each host and path; of rules alike but for the verdict the allow."""
    best: dict[tuple[str, str], str] = {}
    for r in rules:
        if best.get((r.host, r.path)) != "allow":
            best[r.host, r.path] = r.verdict
    rows = [(host, path, verdict, host + path) for (host, path), verdict in best.items()]
    return spark.createDataFrame(rows, "rhost string, rpath string, verdict string, name string")


def ruled(urls: DataFrame, host: str, path: str, out: str, rules: list[Rule]) -> DataFrame:
    """urls with a column out: rule_of() its host and path.

    Many rules are found by equality: each different host gives its suffixes, each of those that has rules the prefixes of
    the path as long as one of its rules' paths, and the longest of the rules so met is the one.
    """
    if len(rules) <= COMPILED_RULES:
        return urls.withColumn(out, rule_of(F.col(host), F.col(path), rules))
    table = _rule_table(urls.sparkSession, rules)
    lengths = table.groupBy("rhost").agg(F.collect_set(F.length("rpath")).alias("lengths"))
    places = urls.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct()
    labels = F.split("h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = places.select("h", "p", F.explode(suffixes).alias("rhost")).join(lengths, "rhost")
    met = met.select("h", "p", "rhost", F.explode(F.filter("lengths", lambda n: n <= F.length("p"))).alias("n"))
    met = met.withColumn("rpath", F.substring(F.col("p"), F.lit(1), F.col("n"))).join(table, ["rhost", "rpath"])
    longest = F.max_by(F.struct("verdict", "name"), F.struct(F.length("name"), F.length("rhost")))
    of_place = met.groupBy("h", "p").agg(longest.alias("found"))
    h, p, found = fresh(urls, "_h", "_p", out)
    of_place = of_place.withColumnsRenamed({"h": h, "p": p, "found": found})
    return urls.join(of_place, (F.col(host) == F.col(h)) & (F.col(path) == F.col(p)), "left").drop(h, p)


def _attribute(tag: Column, name: str) -> Column:
    found = F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", 0)
    value = F.regexp_replace(found, rf"(?is)^.{name}\s*=\s*", "")
    return F.trim(F.regexp_replace(F.regexp_replace(value, "^[\"']|[\"']$", ""), "&amp;", "&"))


def targets_of(html: Column) -> Column:
    """The addresses that a page's canonical links and refresh redirects name, in no comment, script or style."""
    may = F.contains(F.lower(html), F.lit("canonical")) | F.contains(F.lower(html), F.lit("http-equiv"))
    shown = F.regexp_replace(html, r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|noscript|template)(?=[\s/>]).*?(?:</\1\s*>|\z)", " ")
    tags = F.regexp_extract_all(shown, F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), F.lit(0))

    def target(tag: Column) -> Column:
        canonical = tag.rlike(r"(?is)^<link") & F.lower(_attribute(tag, "rel")).rlike(r"(?:^|\s)canonical(?:\s|$)")
        refresh = tag.rlike(r"(?is)^<meta") & (F.lower(_attribute(tag, "http-equiv")) == "refresh")
        moved = F.regexp_replace(F.regexp_extract(_attribute(tag, "content"), r"(?is)url\s*=\s*(.*)$", 1), "^[\"']|[\"']$", "")
        return F.when(canonical, _attribute(tag, "href")).when(refresh, moved)

    found = F.filter(F.transform(tags, target), lambda t: t.isNotNull() & (t != ""))
    return F.when(may, found).otherwise(F.array().cast("array<string>"))


def _without_dots(path: Column) -> Column:
    """path (from its slash to a query or fragment) without . and .. segments."""

    def step(acc: Column, part: Column) -> Column:
        up = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", acc).otherwise(F.concat(acc, F.array(part)))

    parts = F.split(F.substr(path, F.lit(2)), "/", -1)
    kept = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    ends = F.when(F.element_at(parts, -1).isin(".", "..") & (kept != ""), F.lit("/")).otherwise(F.lit(""))
    return F.when(path.rlike(r"/\.{1,2}(?:/|$)"), F.concat(F.lit("/"), kept, ends)).otherwise(path)


def resolved(target: Column, url: Column) -> Column:
    """An absolute form of target, as the page at url names it."""
    scheme = F.regexp_extract(url, r"^(.*?)://", 1)
    host = _fixed(_after_scheme(url), r"^([^/?#]*+)", 1)
    folder = F.regexp_extract(path_of(url), r"^(.*/)", 1)
    site = F.concat(scheme, F.lit("://"), host)
    below = F.concat(F.when(folder == "", "/").otherwise(folder), target)
    path = F.when(F.startswith(target, F.lit("/")), target).otherwise(below)
    clean = F.concat(_without_dots(F.regexp_extract(path, r"^([^?#]*+)", 1)), F.regexp_extract(path, r"^[^?#]*+(.*)$", 1))
    return (
        F.when(F.instr(target, "://") > 0, target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("?")), F.concat(site, path_of(url), target))
        .when(F.startswith(target, F.lit("#")), url)
        .otherwise(F.concat(site, clean))
    )


def address(url: Column) -> Column:
    """What names a page in the graph: host, path (/ if empty) and query, without scheme and fragment."""
    path = path_of(url)
    return F.concat(host_of(url), F.when(path == "", "/").otherwise(path), F.regexp_extract(_after_scheme(url), r"^[^?#]*+(\?[^#]*+)", 1))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, alias_blocked) per row of pages (page_id, url, html; other columns are not looked at).

    verdict is the page's own rule's, else block if an address of its group is blocked, else allow. A null url or
    one without :// has empty host and path, no rule and no group. A null html names no address. Of rules of equal
    length that fit, the one with the longer host counts, then an allow. Repeated rows are judged alike; an empty table
    gives an empty result. In the graph addresses are numbered by a 64-bit hash; a page belongs to a group only if its
    whole address is one of the group's.
    """
    prepare(pages.sparkSession)
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path"), F.when(host != "", address(url)).alias("address"))
    named = pages.where(F.instr(url, "://") > 0).select("url", F.explode(targets_of(F.coalesce(F.col("html"), F.lit("")))).alias("target"))
    links = named.select("url", resolved(F.col("target"), url).alias("to"))
    links = cut(links.where((host_of(F.col("to")) != "") & (address(F.col("to")) != address(url))).distinct())
    groups = connected_components(links.select(F.xxhash64(address(url)).alias("a"), F.xxhash64(address(F.col("to"))).alias("b")))
    ends = links.select("url").union(links.select("to")).select(address(url).alias("address"), host.alias("host"), path.alias("path")).distinct()
    ends = ruled(ends, "host", "path", "own", rules).select("address", F.xxhash64("address").alias("node"), (F.col("own.verdict") == "block").alias("blocked"))
    of = cut(ends.join(groups, "node").groupBy("address", "component").agg(F.max("blocked").alias("blocked")))
    bad = of.where("blocked").select("component").distinct()
    spread = of.join(bad, "component").select("address", F.lit(True).alias("hit")).distinct()
    out = ruled(judged, "host", "path", "r", rules).join(spread, "address", "left").withColumn("alias_blocked", F.coalesce("hit", F.lit(False)))
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("alias_blocked"), "block").otherwise("allow"))
    return out.select("page_id", "url", "host", "path", F.col("r.name").alias("rule"), verdict.alias("verdict"), "alias_blocked")
