"""Mixing sources to target weights in a tree of domain, language and source.

Budgets go down the tree: a node shares its budget among its children by weight, no child gets more than its capacity
(its tokens times the allowed epochs), and what a child cannot use goes to its siblings by weight; only what a whole
node cannot use goes to the siblings of the node.  A leaf repeats its documents for every whole epoch in its budget and
takes, for what is left, the prefix of one more epoch, whose order is a seeded hash of epoch and id.

The prefix of a leaf of any size is found by counting: token sums over 4,096 ranges of the order key, then over the
ranges of the one range in which the budget ends, and once more; only the rows of the last such range are sorted.
Budgets are whole numbers in decimals.

Defined cases: a null text has no tokens; null languages and sources, and values without a listed weight, take the
default weight, null as ``unknown``; a node of weight 0 gets nothing, not even its empty documents; a document without tokens in an open leaf is
taken like the tokens it stands among, at most once an epoch; rows that repeat a ``doc_id`` are each selected
alike and count each; rows without ``doc_id`` sort by an empty id; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import stored, texts

UNKNOWN = "unknown"
TREE = ("domain", "lang", "source")
RANGE_BITS, LEVELS, KEY_BITS = 12, 3, 60
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights of a mix; ``domains`` names the domain of a source, ``share`` sets the budget in tokens of the corpus."""

    domains: dict[str, str] = field(default_factory=dict)
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    default_domain: str = "reference"
    default_weight: int = 1
    epochs: int = 4
    share: tuple[int, int] = (1, 1)
    seed: str = "mix-1"


# The mix of the registered query.
PRODUCTION = Mix(
    domains={"src0": "web", **{f"src{n}": "news" for n in range(1, 7)}, **{f"src{n}": "books" for n in range(7, 14)}},
    weights={"domain": {"web": 4, "news": 2, "books": 3, "reference": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}, "source": {}})


def _looked_up(key: Column, values: dict, default) -> Column:
    found = F.lit(default)
    for name, value in values.items():
        found = F.when(key == name, F.lit(value)).otherwise(found)
    return found


def leaves_of(docs: DataFrame, mix: Mix) -> DataFrame:
    """Narrow rows: id, tree path and tokens (words between white space)."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
    rows = texts(docs, named("lang").alias("lang"), named("source").alias("source"))
    return rows.select(
        "doc_id", _looked_up(F.col("source"), mix.domains, mix.default_domain).alias("domain"), "lang", "source",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("tokens"))


def fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Add ``budget``: the share of ``parent_budget`` by ``weight`` under ``capacity``, shortages among siblings first."""
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    group = Window.partitionBy(*parent)
    order = group.orderBy((F.col("capacity") / F.col("weight")).asc(), F.col(name).asc())
    ranked = children.withColumns({
        "before": F.coalesce(F.sum(whole("capacity")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("decimal(29,0)")),
        "rest_weight": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))})
    full = ranked.withColumn("full", F.expr(
        "cast(capacity as decimal(19,0)) * cast(rest_weight as decimal(18,0))"
        " <= cast(cast(parent_budget as decimal(19,0)) - before as decimal(19,0)) * cast(weight as decimal(18,0))"))
    left = full.withColumns({
        "left_budget": (whole("parent_budget") - F.coalesce(F.sum(F.when(F.col("full"), whole("capacity"))).over(group), F.lit(0))).cast("decimal(19,0)"),
        "left_weight": F.sum(F.when(~F.col("full"), F.col("weight"))).over(group)})
    share = F.expr("cast((left_budget * cast(weight as decimal(18,0))) div cast(left_weight as decimal(18,0)) as bigint)")
    return left.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(share)).drop(
        "before", "rest_weight", "full", "left_budget", "left_weight", "parent_budget")


def budgets(rows: DataFrame, mix: Mix) -> DataFrame:
    """One row per leaf: its tokens, capacity, budget, and 0 for ``open`` where a weight of 0 closes it."""
    leaves = rows.groupBy(*TREE).agg(F.sum("tokens").alias("tokens"))
    weigh = lambda level: _looked_up(F.col(level), mix.weights.get(level, {}), mix.default_weight).cast("long")
    leaves = leaves.withColumn("open", F.least(*[F.when(weigh(level) > 0, 1).otherwise(0) for level in TREE]))
    leaves = leaves.withColumn("capacity", F.col("tokens") * mix.epochs * F.col("open"))
    nodes = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    nodes = nodes.withColumn("weight", F.greatest(weigh("domain"), F.lit(1))).withColumn("root", F.lit(0)).withColumn(
        "corpus", F.sum("tokens").over(Window.partitionBy("root")))
    total = F.expr(f"cast((cast(corpus as decimal(19,0)) * {mix.share[0]}) div {mix.share[1]} as bigint)")
    nodes = fill(nodes.withColumn("parent_budget", total).drop("corpus"), ["root"], "domain")
    for depth in (1, 2):
        above, level = list(TREE[:depth]), TREE[depth]
        parents = nodes.select(*above, F.col("budget").alias("parent_budget"))
        below = leaves.groupBy(*TREE[:depth + 1]).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"), F.max("open").alias("open"))
        below = below.withColumn("weight", F.greatest(weigh(level), F.lit(1))).join(parents, above)
        nodes = fill(below, above, level)
    return nodes.select(*TREE, "tokens", "capacity", "budget", "open")


def order_key(mix: Mix, epoch: Column, doc_id: Column) -> Column:
    """60 bits of a seeded hash of epoch and id."""
    text = F.concat_ws(":", F.lit(mix.seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def cuts(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """Per leaf, the range of the order key in which the rest of the budget ends, and the tokens before it."""
    found = leaves.select(*TREE, "rest", F.lit(0).cast("long").alias("range"), F.lit(0).cast("long").alias("before"))
    for level in range(LEVELS):
        shift = KEY_BITS - RANGE_BITS * (level + 1)
        inside = rows.join(found, list(TREE)).where(F.shiftright("key", shift + RANGE_BITS) == F.col("range"))
        sums = inside.groupBy(*TREE, "rest", "before", F.shiftright("key", shift).alias("range")).agg(F.sum("tokens").alias("tokens"))
        running = F.sum("tokens").over(Window.partitionBy(*TREE).orderBy("range"))
        ends = sums.withColumn("until", F.col("before") + running).where("until > rest")
        found = ends.groupBy(*TREE, "rest").agg(F.min(F.struct("range", (F.col("until") - F.col("tokens")).alias("before"))).alias("cut"))
        found = stored(found.select(*TREE, "rest", "cut.range", "cut.before"), "mix-cuts")
    return found


def mix_sources(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """``doc_id, domain, lang, source, tokens, copies`` of every document; ``copies`` 0 leaves it out."""
    rows = stored(leaves_of(docs, mix), "mix-documents")
    plan = stored(budgets(rows, mix), "mix-budgets")
    leaves = plan.select(
        *TREE, F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).alias("whole"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(F.lit(0)).alias("rest"),
        (F.col("open") == 0).alias("closed"))
    keyed = stored(rows.join(leaves.select(*TREE, "whole"), list(TREE)).withColumn(
        "key", order_key(mix, F.col("whole"), F.col("doc_id"))), "mix-keyed")
    ends = cuts(keyed.drop("whole"), leaves).select(*TREE, "range", "before")
    last = KEY_BITS - RANGE_BITS * LEVELS
    placed = (keyed.drop("whole").join(leaves, list(TREE)).join(ends, list(TREE), "left")
              .withColumn("at", F.shiftright("key", last)))
    sorted_ = Window.partitionBy(*TREE, "at").orderBy("key", F.coalesce("doc_id", F.lit(-(1 << 63)))).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    edge = placed.where("at = range").withColumn("taken", (F.col("before") + F.sum("tokens").over(sorted_) <= F.col("rest")))
    others = placed.where("range is null or at <> range").withColumn("taken", F.col("range").isNull() | (F.col("at") < F.col("range")))
    chosen = others.unionByName(edge)
    copies = F.when(F.col("closed"), F.lit(0)).otherwise(F.least(F.col("whole") + F.col("taken").cast("int"), F.lit(mix.epochs)))
    return chosen.select("doc_id", *TREE, "tokens", copies.cast("long").alias("copies"))
