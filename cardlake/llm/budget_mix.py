"""Hierarchical token budgeting over a tree of domain, language and source, in DataFrame
operations only.

A node's capacity is its tokens times the allowed epochs. From the root down, a node's
budget is shared among its children by weight; a child that cannot use its share is
filled, and what it leaves goes to its siblings by weight. Only what no child can use
is missing at the node itself, and as a node's capacity is the sum of its children's,
the level above has already given it to the node's siblings.

A leaf reads its documents in seeded epochs: the order of an epoch is that of
``md5(seed:epoch:id:md5(text))``. The leaf takes whole epochs and then the longest prefix of the
next one that fits what is left. The prefix is found by sums over 4,096 ranges of the
order and then over the keys of the one range in which it ends, so a source with a
third of all rows is never sorted in one task.

Defined results: null names are the name ``(null)``. Documents without words (null, empty or
blank texts) carry no tokens and are not selected. Rows with equal order keys (repeated rows) are
taken or left together. Null ids take part. Weights that are zero or less give nothing. Shares
are whole tokens, rounded down, so up to one token a node stays unused. Other columns are
carried through. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.tables import written

LEVELS = ("mix_domain", "mix_lang", "mix_source")
NULL_NAME = "(null)"
WORD = r"[^\x20\x09-\x0D]+"
RANGE_DIGITS = 3


def _weight(path: Column, weights: dict[str, float]) -> Column:
    """The weight of a node by its path (names joined by ``/``); 1 where none is given."""
    if not weights:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(x) for k, v in sorted(weights.items()) for x in (k, float(v))])
    return F.coalesce(F.element_at(table, path), F.lit(1.0))


def share_out(nodes: DataFrame, parents: DataFrame | None, depth: int, weights: dict[str, float],
              total: Column) -> DataFrame:
    """Budgets of the nodes of one level from their parents' budgets (the root's is ``total``).

    In ascending order of capacity per weight, a child is full if its capacity is at most its
    share of what the full children before it have left; the others share the rest."""
    keys, above = list(LEVELS[:depth]), list(LEVELS[:depth - 1])
    level = nodes.groupBy(*keys).agg(F.sum("capacity").alias("capacity"))
    level = level.withColumn("weight", _weight(F.concat_ws("/", *keys), weights)).where("weight > 0")
    if parents is None:
        level = level.withColumn("given", total)
    else:
        level = level.join(parents.select(*above, F.col("budget").alias("given")), above)
    rising = Window.partitionBy(*above).orderBy(F.col("capacity") / F.col("weight"), *keys)
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*above)
    left = F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    level = level.withColumn(
        "full", F.col("capacity") * F.sum("weight").over(after) <= F.col("weight") * left)
    rest = F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole), F.lit(0))
    others = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    return level.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(
        F.floor(F.col("weight") * rest / others))).select(*keys, "budget")


def plan(sized: DataFrame, share: float, epochs: int, weights: dict[str, float]) -> DataFrame:
    """Leaves with ``tokens``, ``budget``, ``whole`` (epochs taken whole) and ``rest`` (tokens from
    the next epoch)."""
    leaves = sized.groupBy(*LEVELS).agg(F.sum("mix_tokens").alias("tokens")).withColumn(
        "capacity", F.col("tokens") * F.lit(epochs))
    leaves = written(leaves, "mix-leaves")
    available = leaves.agg(F.sum("tokens")).first()[0] or 0
    live = leaves  # a node that gets nothing lends no capacity to those above it
    for depth in range(1, len(LEVELS) + 1):
        live = live.where(_weight(F.concat_ws("/", *LEVELS[:depth]), weights) > 0)
    total = F.lit(int(available * share)).cast("long")
    budgets = None
    for depth in range(1, len(LEVELS) + 1):
        budgets = share_out(live, budgets, depth, weights, total)
    whole = F.floor(F.col("budget") / F.col("tokens"))
    return leaves.join(budgets, list(LEVELS)).select(
        *LEVELS, "tokens", "budget", whole.alias("whole"),
        (F.col("budget") - whole * F.col("tokens")).alias("rest"))


def mix(docs: DataFrame, domain: Column, share: float, epochs: int = 1, weights: dict[str, float] | None = None,
        seed: int = 42, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        source_col: str = "source") -> DataFrame:
    """The selected rows as ``doc`` (a struct of the input's columns) with ``domain, lang, source,
    n_tokens, budget, epoch, order_key``; a row taken in several epochs appears once for each."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def name(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(NULL_NAME))

    sized = docs.select(
        F.struct("*").alias("doc"), name(domain).alias(LEVELS[0]), name(F.col(lang_col)).alias(LEVELS[1]),
        name(F.col(source_col)).alias(LEVELS[2]), F.regexp_count(text, F.lit(WORD)).cast("long").alias("mix_tokens"),
        F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(text)).alias("mix_name"),
    ).where("mix_tokens > 0")
    leaves = written(plan(sized.drop("doc", "mix_name"), share, epochs, weights or {}), "mix-budgets")

    def key(frame: DataFrame) -> DataFrame:
        return frame.withColumn("mix_key", F.md5(F.concat(
            F.lit(f"{seed}:"), F.col("whole").cast("string"), F.lit(":"), F.col("mix_name"))))

    # the leaves' table is a written one: the planner knows its bytes and broadcasts it only if small
    keyed = key(sized.drop("doc").join(leaves, list(LEVELS)))
    by_range = keyed.groupBy(*LEVELS, "rest", F.substring("mix_key", 1, RANGE_DIGITS).alias("part")).agg(
        F.sum("mix_tokens").alias("n"))
    upto = Window.partitionBy(*LEVELS).orderBy("part")
    last = by_range.withColumn("upto", F.sum("n").over(upto)).where(
        (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest"))).select(
        *LEVELS, "part", (F.col("rest") - (F.col("upto") - F.col("n"))).alias("room"))
    last = written(last, "mix-ranges")
    inside = keyed.select(*LEVELS, "mix_key", "mix_tokens", F.substring("mix_key", 1, RANGE_DIGITS).alias("part")).join(
        last, [*LEVELS, "part"]).groupBy(*LEVELS, "part", "room", "mix_key").agg(F.sum("mix_tokens").alias("n"))
    fits = inside.withColumn("upto", F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("mix_key"))).where(
        "upto <= room").groupBy(*LEVELS).agg(F.max("mix_key").alias("cut"))
    # keys up to ``cut`` are taken; without a fitting key in the last range, all keys before that range
    cuts = last.join(fits, list(LEVELS), "left").select(*LEVELS, F.coalesce("cut", "part").alias("cut"))
    cuts = written(leaves.join(cuts, list(LEVELS), "left"), "mix-cuts")
    chosen = key(sized.join(cuts, list(LEVELS))).withColumn(
        "times", F.col("whole") + F.when(F.col("mix_key") <= F.col("cut"), 1).otherwise(0)).where("times > 0")
    return chosen.select(
        "doc", F.col(LEVELS[0]).alias("domain"), F.col(LEVELS[1]).alias("lang"), F.col(LEVELS[2]).alias("source"),
        F.col("mix_tokens").alias("n_tokens"), "budget", F.col("mix_key").alias("order_key"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("epoch"))
