"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power of an exponent, normalised: 1 keeps the
shares, 0 makes all equal. The exponent is bisected until the weights meet a target entropy
or keep the repetition of the most repeated source within a limit. The weights are then
realised: with a budget of tokens, a source is passed over once for each whole epoch, and a
last epoch takes documents in the order of a block permutation until the rest is used up.

A source's blocks number about the square root of its documents. A hash of id, epoch and
seed gives a document its block and its place there, so a permutation costs no sort. Where
an epoch is cut follows from the blocks' totals and from the documents of one block: both
are of the order of the root, also for a source with a third of all rows. Texts are never
shuffled; a row decides for itself from its source's row. All DataFrame functions.

Defined cases: a null source is a source of its own. A source without tokens is taken once.
Rows that share an id are taken together. A null id or text is an ordinary value; a null
text has no token. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldgauge.llm.frames import own, stored

#: Halvings in one pass over the sources, and passes: 2**-30 is left of the interval.
HALVINGS, PASSES = 5, 6
REPEAT_LIMIT = 2.0
#: Sources that are sent to every task; more are joined by a shuffle.
BROADCAST_SOURCES = 10_000
SEED = 7


def n_words(text: Column) -> Column:
    """Words between ASCII blanks: places where a blank or the start meets another sign."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(trimmed) == 0, 0).otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("long")


def measure(sources: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """For each exponent: the entropy of the weights, and the epochs of the most repeated
    source when the least repeated has one."""
    rows = sources.where("tokens > 0").select(F.log(F.col("tokens").cast("double")).alias("l"))
    a = F.col("a")
    powered = rows.withColumn("a", F.explode(F.array(*[F.lit(x) for x in exponents])))
    p = F.exp(a * F.col("l"))
    found = (
        powered.groupBy("a")
        .agg(
            F.sum(p).alias("z"),
            F.sum(p * a * F.col("l")).alias("s"),
            F.max(F.exp((a - 1) * F.col("l"))).alias("most"),
            F.min(F.exp((a - 1) * F.col("l"))).alias("least"),
        )
        .collect()
    )
    return {r.a: (math.log(r.z) - r.s / r.z, r.most / r.least) for r in found}


def exponent(sources: DataFrame, target_entropy: float | None, repeat_limit: float | None) -> float:
    """The smallest exponent in [0, 1] that keeps the limit; if there is a target entropy
    (nats), not below the largest exponent that reaches it. Both fall as it grows."""

    def solve(good) -> float:
        """The border of a test that holds at 1 and may fail at 0."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            parts = 1 << HALVINGS
            points = [low + (high - low) * k / parts for k in range(parts + 1)]
            found = measure(sources, points)
            if not found or good(*found[points[0]]):
                return points[0]
            a, b = 0, parts
            while b - a > 1:  # the halvings of this pass
                middle = (a + b) // 2
                a, b = (a, middle) if good(*found[points[middle]]) else (middle, b)
            low, high = points[a], points[b]
        return high

    least = 0.0 if repeat_limit is None else solve(lambda _, repeats: repeats <= repeat_limit * (1 + 1e-12))
    if target_entropy is not None:
        least = max(least, solve(lambda entropy, _: entropy <= target_entropy))
    return least


def _block(id: Column, epoch: Column, seed: int, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), epoch, id), blocks)


def _place(id: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(id, F.lit(seed + 1), epoch)


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    target_entropy: float | None = None,
    repeat_limit: float | None = REPEAT_LIMIT,
    budget: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """A row of ``docs`` for each epoch that takes it, and: n_tokens, epoch (from 1), block,
    place (long), weight (double; its source's). Ordering by (epoch, block, place) within a
    source gives the permuted order. Columns of ``docs`` with these names go.

    ``budget``: tokens to take; by default as many as let every source be seen once whole,
    so that no document is lost and small sources repeat up to the limit.
    """
    added = ["n_tokens", "epoch", "block", "place", "weight"]
    rest = docs.drop(*[c for c in added if c not in (id, source, text)])
    spark = docs.sparkSession
    slim = stored(
        spark,
        rest.select(F.col(id).alias("id"), F.col(source).alias("source"), n_words(F.col(text)).alias("n")),
        "mix-tokens",
    )
    sources = stored(
        spark,
        slim.groupBy("source").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs")),
        "mix-sources",
    )
    power = exponent(sources, target_entropy, repeat_limit)
    raw = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(power))).otherwise(0.0)
    powered = sources.withColumn("raw", raw)
    sums = powered.agg(
        F.sum("raw").alias("z"),
        F.max(F.when(F.col("raw") > 0, F.col("tokens") / F.col("raw"))).alias("slowest"),
        F.count("*").alias("n"),
    ).first()
    z = sums.z or 1.0
    whole = float(budget) if budget is not None else (sums.slowest or 0.0) * z
    epochs = F.when(F.col("tokens") > 0, F.lit(whole) * F.col("weight") / F.col("tokens")).otherwise(1.0)
    plan = (
        powered.withColumn("weight", F.col("raw") / F.lit(z))
        .withColumn("epochs", epochs)
        # an epoch that lacks a rounding error only is whole
        .withColumn("full", F.floor(F.col("epochs") + 1e-9).cast("long"))
        .withColumn("room", F.greatest(F.lit(0.0), F.col("epochs") - F.col("full")) * F.col("tokens"))
        .withColumn("blocks", F.ceil(F.sqrt(F.col("docs").cast("double"))).cast("long"))
        .select("source", "weight", "full", "room", "blocks")
    )
    plan = stored(spark, plan.join(_cuts(slim, plan, seed, sums.n), F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source"), "mix-plan")

    names = {c: own(c) for c in (*plan.columns, "times", "n")}
    plan_of = {c: F.col(name) for c, name in names.items()}
    small = F.broadcast if sums.n <= BROADCAST_SOURCES else (lambda x: x)
    settled = plan.withColumnsRenamed({c: names[c] for c in plan.columns})
    joined = rest.join(small(settled), F.col(f"`{source}`").eqNullSafe(plan_of["source"]))
    key = F.col(f"`{id}`")
    last = plan_of["full"] + 1
    block, place = _block(key, last, seed, plan_of["blocks"]), _place(key, last, seed)
    cut_block, cut_place = plan_of["cut_block"], plan_of["cut_place"]
    taken = (block < cut_block) | ((block == cut_block) & (place <= cut_place))
    times = plan_of["full"] + F.when(F.coalesce(taken, F.lit(False)), 1).otherwise(0)
    return (
        joined.withColumn(names["times"], times)
        .where(plan_of["times"] > 0)
        .withColumn(names["n"], n_words(F.col(f"`{text}`")))
        .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), plan_of["times"])))
        .select(
            *[F.col(f"`{c}`") for c in rest.columns],
            plan_of["n"].alias("n_tokens"),
            "epoch",
            _block(key, F.col("epoch"), seed, plan_of["blocks"]).alias("block"),
            _place(key, F.col("epoch"), seed).alias("place"),
            plan_of["weight"].alias("weight"),
        )
    )


def _cuts(slim: DataFrame, plan: DataFrame, seed: int, n_sources: int) -> DataFrame:
    """(cut_source, cut_block, cut_place): the last epoch takes the blocks before cut_block,
    and of that block the documents up to cut_place."""
    small = F.broadcast if n_sources <= BROADCAST_SOURCES else (lambda x: x)
    part = plan.where("room > 0").withColumnRenamed("source", "s")
    last = F.col("full") + 1
    rows = (
        slim.join(small(part), F.col("source").eqNullSafe(F.col("s")))
        .select(
            "source", "room", "n",
            _block(F.col("id"), last, seed, F.col("blocks")).alias("block"),
            _place(F.col("id"), last, seed).alias("place"),
        )
    )
    blocks = rows.groupBy("source", "block").agg(F.sum("n").alias("n"), F.first("room").alias("room"))
    run = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    # the first block whose end lies beyond the room; it holds about a root of the documents
    cut = (
        blocks.withColumn("upto", F.sum("n").over(run))
        .where(F.col("upto") > F.col("room"))
        .groupBy("source")
        .agg(F.min_by(F.struct("block", (F.col("room") - F.col("upto") + F.col("n")).alias("left")), "block").alias("cut"))
        .select(F.col("source").alias("c"), "cut.block", "cut.left")
        .withColumnRenamed("block", "cut_block")
    )
    inner = rows.join(small(cut), F.col("source").eqNullSafe(F.col("c")) & (F.col("block") == F.col("cut_block")))
    # documents with one place are taken together
    places = inner.groupBy("source", "cut_block", "left", "place").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    fits = (
        places.withColumn("upto", F.sum("n").over(upto))
        .where(F.col("upto") <= F.col("left"))
        .groupBy("source")
        .agg(F.max("place").alias("cut_place"))
    )
    keyed = fits.withColumnRenamed("source", "f")
    return cut.join(keyed, F.col("c").eqNullSafe(F.col("f")), "left").select(
        F.col("c").alias("cut_source"), "cut_block", "cut_place"
    )
