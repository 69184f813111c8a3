"""Mixing sources to target weights, by budgets over a tree of domains, languages and sources.

The token budget goes down the tree. At each node it is dealt to the children by weight; a child
that cannot use its share (its capacity is its tokens times max_epochs) takes what it has, and the
rest is dealt among its siblings before anything is left over for the node's own siblings. A
leaf's budget buys whole epochs first; the rest buys a prefix, in tokens, of the next epoch's order,
which a hash of seed, epoch and doc_id gives; the document at its end is in if at least half of it fits.

The prefix ends are found with aggregates: tokens by leaf and range of turns, running sums over a
few ranges, again within the one in which the prefix ends, and at last over that range's documents
(about one in 2**18 of a leaf). Choosing documents is then a comparison with the leaf's cut,
without moving any text; a leaf that holds a third of all documents is no larger task than others.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlas.llm._util import cut, fresh, prepare

#: Leaves up to this number are broadcast (about 100 bytes each); more are joined by an exchange.
BROADCAST_LEAVES = 50_000
HASH_BITS = 60
#: A prefix's end is narrowed down in LEVELS steps, each over 2**LEVEL_BITS sums a leaf.
LEVELS, LEVEL_BITS = 3, 6
LEAF = ["domain", "language", "origin"]


@dataclass(frozen=True)
class Mix:
    """Weights by name (1 where not named), the share of all tokens to take, epochs at most, and a seed."""

    domains: Mapping[str, float] = field(default_factory=dict)
    languages: Mapping[str, float] = field(default_factory=dict)
    sources: Mapping[str, float] = field(default_factory=dict)
    share: float = 0.5
    max_epochs: int = 3
    seed: int = 42


def domain_of(source: Column) -> Column:
    """The domain of a source, by its last character."""
    return F.concat(F.lit("d"), (F.ascii(F.right(source, F.lit(1))) % 3).cast("string"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def turn(doc_id: Column, seed: int, epoch: Column) -> Column:
    """Where a document comes in an epoch: a number of HASH_BITS bits."""
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _weight(name: Column, weights: Mapping[str, float]) -> Column:
    out = F.lit(1.0)
    for k, w in weights.items():
        out = F.when(name == k, F.lit(float(w))).otherwise(out)
    return out


def deal(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """children (parent columns, child, weight, capacity, budget of the parent) with a column dealt.

    Water-filling: children in order of capacity by weight; those that the level of the water covers take
    their capacity, the others their weight times the level.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.col("capacity") / F.col("weight"), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))) / F.sum("weight").over(rest)
    out = children.withColumn("_level", level)
    open_ = F.col("capacity") > F.col("_level") * F.col("weight")
    final = F.min(F.when(open_, F.struct(F.col("capacity") / F.col("weight"), F.col(child), F.col("_level").alias("level")))).over(by)["level"]
    full = F.col("capacity").cast("double")
    share = F.when(final.isNull(), full).otherwise(F.least(full, F.greatest(final * F.col("weight"), F.lit(0.0))))
    return out.withColumn("dealt", share).drop("_level")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """leaves (domain, language, origin, tokens) with budget: the tokens that each leaf gives."""
    held = leaves.withColumn("capacity", F.col("tokens") * mix.max_epochs)
    total = held.agg(F.floor(F.sum("tokens") * mix.share).alias("budget"))
    tops = held.groupBy("domain").agg(F.sum("capacity").alias("capacity")).crossJoin(F.broadcast(total)).withColumn("weight", _weight(F.col("domain"), mix.domains))
    tops = deal(tops, [], "domain").select("domain", F.col("dealt").alias("budget"))
    mids = held.groupBy("domain", "language").agg(F.sum("capacity").alias("capacity")).join(tops, "domain").withColumn("weight", _weight(F.col("language"), mix.languages))
    mids = deal(mids, ["domain"], "language").select("domain", "language", F.col("dealt").alias("budget"))
    ends = held.join(mids, ["domain", "language"]).withColumn("weight", _weight(F.col("origin"), mix.sources))
    return deal(ends, ["domain", "language"], "origin").select(*LEAF, "tokens", F.floor(F.col("dealt") + 1e-6).alias("budget"))


def cuts(narrow: DataFrame, mix: Mix) -> DataFrame:
    """(domain, language, origin, epochs, cut): whole epochs of each leaf, and the last turn taken of the next one."""
    leaves = budgets(narrow.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), mix)
    epochs = F.floor(F.col("budget") / F.col("tokens"))
    rest = F.col("budget") - epochs * F.col("tokens")
    # low: where the range of turns starts in which the prefix ends; before: the tokens below it
    leaves = cut(leaves.select(*LEAF, epochs.alias("epochs"), rest.alias("rest"), F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("before")))
    width = HASH_BITS
    for _ in range(LEVELS):
        leaves, width = cut(_narrowed(narrow, leaves, mix, width)), width - LEVEL_BITS
    last = _in_range(narrow, leaves, mix, width)
    peers = last.groupBy(*LEAF, "rest", "before", "turn").agg(F.sum("n_tokens").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*LEAF).orderBy("turn"))
    inside = peers.withColumn("upto", upto).where("2 * upto - n <= 2 * rest").groupBy(*LEAF).agg(F.max("turn").alias("last"))
    return leaves.join(inside, LEAF, "left").select(*LEAF, "epochs", F.coalesce("last", F.col("low") - 1).alias("cut"))


def _in_range(narrow: DataFrame, leaves: DataFrame, mix: Mix, width: int) -> DataFrame:
    """The documents whose turn is in their leaf's range of 2**width turns."""
    docs = narrow.join(_sent(leaves), LEAF).withColumn("turn", turn(F.col("doc_id"), mix.seed, F.col("epochs")))
    return docs.where(F.shiftright("turn", width) == F.shiftright("low", width))


def _narrowed(narrow: DataFrame, leaves: DataFrame, mix: Mix, width: int) -> DataFrame:
    """leaves with the part of their range, one of 2**LEVEL_BITS, in which the running sum of tokens passes rest."""
    shift = width - LEVEL_BITS
    sums = _in_range(narrow, leaves, mix, width).groupBy(*LEAF, "rest", "before", F.shiftright("turn", shift).alias("part")).agg(F.sum("n_tokens").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*LEAF).orderBy("part"))
    ends = sums.withColumn("upto", upto).where("upto > rest").groupBy(*LEAF).agg(F.min("part").alias("part"), F.min(F.col("upto") - F.col("n")).alias("sum"))
    found = leaves.drop("low", "before").join(ends, LEAF)
    return found.select(*LEAF, "epochs", "rest", F.shiftleft("part", shift).alias("low"), F.col("sum").alias("before"))


def _sent(leaves: DataFrame) -> DataFrame:
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def narrow_of(docs: DataFrame, domain: Column | None = None, tokens: Column | None = None) -> DataFrame:
    source = F.coalesce(F.col("source"), F.lit("unknown"))
    return docs.withColumns({"domain": domain_of(source) if domain is None else domain, "language": F.coalesce(F.col("lang"), F.lit("und")), "origin": source, "n_tokens": n_words(F.col("text")) if tokens is None else tokens})


def mixed(docs: DataFrame, mix: Mix, domain: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """The chosen rows of docs (doc_id, text, lang, source, and what else there is) with domain, language, origin, n_tokens and copies.

    copies counts the epochs in which a document is taken; documents that are in none are left out. A null source
    is unknown, a null language und; null texts have no tokens and are never taken. Rows of one doc_id in one leaf are
    taken together. Columns of the added names are replaced. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    wide = narrow_of(docs.drop("domain", "language", "origin", "n_tokens", "copies"), domain, tokens)
    epochs, last = fresh(wide, "epochs", "cut")
    ends = cut(cuts(cut(wide.select("doc_id", *LEAF, "n_tokens")), mix)).withColumnsRenamed({"epochs": epochs, "cut": last})
    taken = (turn(F.col("doc_id"), mix.seed, F.col(epochs)) <= F.col(last)).cast("long")
    out = wide.join(_sent(ends), LEAF).withColumn("copies", F.col(epochs) + taken).where("copies > 0 and n_tokens > 0")
    return out.select(*wide.columns, "copies")
