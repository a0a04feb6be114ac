"""Exact Jaccard join of documents on word shingles, in the metric space of shingle sets.

Distance is 1 - Jaccard; documents link within radius r = 1 - threshold. Unrelated texts
are all at distance near 1 from any document taken as a pivot, so Voronoi regions of whole
documents would be replicated to every region by windows of 2 r. The regions are therefore
laid out in projections, where distances differ:

- The pivots are single shingles, and a set lies with some of its own. Shingles have one
  order everywhere, rare ones first. Two sets within r have at least ceil(threshold * n) of
  their n shingles in common, so one of the first n - ceil(threshold * n) + 1 of each is
  shared: a set is replicated to the regions of those, the window that r asks for.
- Common passages come last in that order, so sharing one brings no one together unless
  it makes up most of the texts. A text whose own changes exceed r has only these in its
  window, so a large group of texts that are near, but not within r, mostly falls apart.
- How common shingles are is counted over all texts in a table of fixed size, where several
  share a counter. It only sets the order: whatever it says, no pair is missed.
- Sizes are a projection, too: regions are cut into bands of sizes, with the window that
  the radius asks for.

Regions join recursively. The region's smallest set is its pivot; all others are compared
with it, and components of the links are formed. A region is done when the rest lies in one
component. Otherwise more pivots are drawn, eight times as many each round, or all if the region
is small; a pivot is compared with those of other components only, and only if the triangle
inequality allows it: their distances to the first pivot differ by r at most. Sets are read
for a pair only if their sketches, of fixed size, leave it possible that they are within r;
for others the sketches' lower bound of the distance is kept, and 1 as the upper. Nor is a
pair compared where too few shingles follow the region's own in either set: the first
region that two sets share stands before all else they have in common. A pair that was
together in a region shortly before, or in the lower of two bands, is left to that one:
chains of this end in the first region and band that the pair shares. A pivot that has met
all others leaves the region. The result is exact. Texts that share most of a window,
but are not within r, still take a number of comparisons near the square of theirs.

Equal sets are one node, so copies cost nothing. Nothing is capped; large regions are
spread by joins, never gathered in a task. Set hashes are 64 bits; a second hash proves
them, and on a clash all is done anew with other hashes.

Defined cases: without words a document has no shingles and is its own component. With
fewer words than a shingle, the sequence is the one shingle. A null id belongs to a
component but can't name it. Rows that repeat an id are rows of their own, each in its own
text's component; ``keep_one`` says which of them stay. An empty table gives no rows. A very
long text is hashed whole, in memory of about 60 bytes for each of its bytes.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm import words as W
from fieldgauge.llm.frames import freed, own, stored
from fieldgauge.llm.graph import components

SHINGLE, PERCENT = 3, 90
#: Regions with as many members or fewer compare all pairs of components at once.
SMALL_REGION = 64
#: Pivots drawn in a region's second round, and how many times more in each that follows.
FIRST_PIVOTS, MORE_PIVOTS = 8, 8
#: Places before a region's own where a pair that meets there is left to the earlier region.
#: More save repeated pairs and cost 8 bytes a row each; the result is the same.
LOOK_BACK = 4
#: Parities of a set's shingles that tell most pairs beyond the radius apart without their sets.
SKETCH_BITS = 1024
#: As many pairs, of 16 bytes, are sent to all tasks; more are joined by a shuffle.
SENT_PAIRS = 1 << 20
#: Bits of a shingle's hash that name its counter: a table of 4 MB, whatever the input.
COUNTER_BITS = 22
_BLOCK = 1 << 14  # counters that are summed together
#: Bits of the filter that says which sets are compared at all; 2 MB, whatever the input.
FILTER_BITS = 1 << 24
_BITMAP = 32768  # bits of one bitmap of the bitmap functions: fixed value


def sets(texts: pa.Array, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in order, and each text's bounds."""
    w = W.split(texts, lower=True)
    hashes = W.mix(w.hashes() + np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64)))
    grams, at = W.shingles(hashes, w.bounds, size)
    owner = w.text_of_word()[at]
    n_words = np.diff(w.bounds)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        single = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            more = n_words[short] > k
            single[more] = W.mix(single[more] * np.uint64(0x9E3779B97F4A7C15) + hashes[w.bounds[short[more]] + k] + np.uint64(k + 101))
        grams, owner = np.concatenate([grams, single]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(texts) + 1))


def _prefix(x: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, ... values, modulo 2**64."""
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=sums[1:])
    return sums


def _commonness(rows: DataFrame, shingle: int, seed: int) -> np.ndarray:
    """How many sets hold the shingles of each counter, as a rounded logarithm."""

    def count(batches):
        counts = np.zeros(1 << COUNTER_BITS, np.int32)
        for batch in batches:
            for a, b in W.chunks(batch.column(0)):
                grams, _ = sets(batch.column(0).slice(a, b - a), shingle, seed)
                np.add.at(counts, (grams >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), 1)
        blocks = counts.reshape(-1, _BLOCK)
        full = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([zlib.compress(blocks[k].tobytes(), 1) for k in full], pa.binary())],
            names=["block", "counts"],
        )

    def total(batches):
        sums = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(zlib.decompress(counts), np.int32)
                sums[block] = sums.get(block, np.int64(0)) + counts
        # a quarter of a power of two is one step
        steps = [np.round(4 * np.log2(1 + s)).astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(steps, pa.binary())], names=["block", "counts"]
        )

    schema = "block int, counts binary"
    counted = rows.select("text").mapInArrow(count, schema).repartition("block").mapInArrow(total, schema)
    table = np.zeros((1 << COUNTER_BITS) // _BLOCK * _BLOCK, np.uint8).reshape(-1, _BLOCK)
    for row in counted.collect():  # at most 4 MB
        table[row.block] = np.frombuffer(row.counts, np.uint8)
    return table.reshape(-1)


def regions(grams: np.ndarray, bounds: np.ndarray, percent: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, region) of each shingle in the window of each text."""
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    grams = grams[np.lexsort((grams, common[(grams >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)], owner))]
    first = np.where(n > 0, n - -(percent * n // -100) + 1, 0)
    text = np.repeat(np.arange(len(n)), first)
    place = np.arange(len(text)) - np.repeat(np.cumsum(first) - first, first)
    return text, grams[bounds[:-1][text] + place]


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), _as_long(values))


def _sums(grams: np.ndarray, bounds: np.ndarray, salt: int) -> np.ndarray:
    sums = _prefix(W.mix(grams * np.uint64(2 * salt + 1) + np.uint64(salt)))
    return W.mix(sums[bounds[1:]] - sums[bounds[:-1]] + (bounds[1:] - bounds[:-1]).astype(np.uint64))


def _sketches(grams: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """For each set, ``SKETCH_BITS`` parities: whether an odd number of shingles fall on a bit.

    The parities in which two sketches differ are those of the sets' symmetric difference, so
    there are no more of them than shingles in that difference.
    """
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = owner * SKETCH_BITS + (grams % np.uint64(SKETCH_BITS)).astype(np.int64)
    place, count = np.unique(place, return_counts=True)
    place = place[count % 2 == 1]
    longs = np.zeros((len(bounds) - 1) * SKETCH_BITS // 64, np.uint64)
    np.bitwise_or.at(longs, place // 64, np.uint64(1) << (place % 64).astype(np.uint64))
    return _lists(longs, np.full(len(bounds) - 1, SKETCH_BITS // 64))


def _placed(rows: DataFrame, common: np.ndarray, shingle: int, percent: int, seed: int) -> DataFrame:
    """(id, n, node, proof, regions, sketch): node and proof are null for an empty set."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b in W.chunks(batch.column(1)):
                grams, bounds = sets(batch.column(1).slice(a, b - a), shingle, seed)
                n = np.diff(bounds)
                text, region = regions(grams, bounds, percent, common)
                empty = n == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(n.astype(np.int64)),
                        pa.array(_sums(grams, bounds, 1).view(np.int64), mask=empty),
                        pa.array(_sums(grams, bounds, 2).view(np.int64), mask=empty),
                        _lists(region, np.bincount(text, minlength=b - a)),
                        _sketches(grams, bounds),
                    ],
                    names=["id", "n", "node", "proof", "regions", "sketch"],
                )

    return rows.mapInArrow(run, f"id {kind}, n long, node long, proof long, regions array<long>, sketch array<long>")


def _compared(rows: DataFrame, nodes: DataFrame, shingle: int, seed: int) -> DataFrame:
    """(node, grams) of at least the wanted nodes: a filter of fixed size lets them pass,
    and some others if they are many; those find no partner in the joins that follow."""
    bit = F.pmod(F.col("node"), F.lit(FILTER_BITS))
    maps = (
        nodes.select(bit.alias("bit"))
        .groupBy((F.col("bit") / _BITMAP).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg(F.col("bit") % _BITMAP).alias("bits"))
        .collect()
    )  # at most FILTER_BITS / _BITMAP rows of 4 kB
    filter = np.zeros(FILTER_BITS // 8, np.uint8)
    for m in maps:
        filter[m.part * _BITMAP // 8 : (m.part + 1) * _BITMAP // 8] = np.frombuffer(m.bits, np.uint8)

    def run(batches):
        for batch in batches:
            for a, b in W.chunks(batch.column(0)):
                grams, bounds = sets(batch.column(0).slice(a, b - a), shingle, seed)
                n = np.diff(bounds)
                node = _sums(grams, bounds, 1)
                at = (node.view(np.int64) % FILTER_BITS).astype(np.int64)
                keep = (n > 0) & (filter[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                mine = np.repeat(keep, n)
                yield pa.RecordBatch.from_arrays(
                    [_as_long(node[keep]), _lists(grams[mine], n[keep])], names=["node", "grams"]
                )

    found = rows.select("text").mapInArrow(run, "node long, grams array<long>")
    return found.groupBy("node").agg(F.any_value("grams").alias("grams"))


def _judged(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b, lo, possible) of distinct pairs: a lower bound of the distance by the sketches
    (node, n, sketch), and whether it lies within the radius."""
    first = sketches.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("x"))
    second = sketches.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("y"))
    differ = F.aggregate(
        F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, k: total + k
    )
    apart = pairs.join(first, "a").join(second, "b").select(
        "a", "b", differ.cast("long").alias("apart"), (F.col("n_a") + F.col("n_b")).alias("sum")
    )
    return apart.select(
        "a",
        "b",
        (2 * F.col("apart") / (F.col("sum") + F.col("apart"))).alias("lo"),
        (100 * (F.col("sum") - F.col("apart")) >= percent * (F.col("sum") + F.col("apart"))).alias("possible"),
    )


def _distances(pairs: DataFrame, rows: DataFrame, shingle: int, percent: int, seed: int) -> DataFrame:
    """(a, b, distance, links) of distinct pairs (a, b), stored; the sets are read for them."""
    # few pairs are sent to the sets, which then stay where they are; of the second sides
    # only those wanted move
    spark = pairs.sparkSession
    pairs = stored(spark, pairs, "jaccard-wanted")
    seconds = stored(spark, pairs.select(F.col("b").alias("node")).distinct(), "jaccard-seconds")
    nodes = seconds.union(pairs.select(F.col("a").alias("node")))
    grams = stored(spark, _compared(rows, nodes, shingle, seed), "jaccard-sets")
    sent = pairs, seconds
    if pairs.count() <= SENT_PAIRS:
        sent = F.broadcast(pairs), F.broadcast(seconds)
    found = _overlaps(sent[0], sent[1], grams, percent)
    found = stored(spark, found, "jaccard-pairs")
    freed(spark, pairs, seconds, grams)
    return found


def _overlaps(pairs: DataFrame, seconds: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    left = grams.select(F.col("node").alias("a"), F.col("grams").alias("x"))
    right = grams.join(seconds, "node", "left_semi").select(F.col("node").alias("b"), F.col("grams").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("sum"))
        .select(
            "a",
            "b",
            (1 - F.col("common") / (F.col("sum") - F.col("common"))).alias("distance"),
            (100 * F.col("common") >= percent * (F.col("sum") - F.col("common"))).alias("links"),
        )
    )


def join(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    small: int = SMALL_REGION,
) -> DataFrame:
    """(id, n_shingles, component_id): documents link if the sets of their shingles have a
    Jaccard likeness of ``percent`` or more; component_id is the smallest id reached."""
    found, _ = _joined(docs, id, text, shingle, percent, small)
    return found.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.coalesce("first.id", "id").alias("component_id"),
    )


def _joined(docs: DataFrame, id: str, text: str, shingle: int, percent: int, small: int) -> tuple[DataFrame, int]:
    """The hashes' seed, and (id, n, node, first) of each row, stored: its set, and the first (id, node) of its
    component by id and set. All other scratch tables are deleted."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    for seed in range(1, 9):
        common = _commonness(rows, shingle, seed)
        placed = stored(spark, _placed(rows, common, shingle, percent, seed), "jaccard-placed")
        clash = placed.groupBy("node").agg(F.min("proof").alias("p"), F.max("proof").alias("q"))
        if not clash.where("p <> q").limit(1).count():
            break
        freed(spark, placed)
    else:
        raise RuntimeError("64-bit hashes clash for every seed")
    label = _labels(spark, rows, placed, shingle, percent, small, seed)
    comp = F.coalesce(F.col("comp"), F.col("node"))
    named = placed.select("id", "n", "node").join(label, "node", "left").select("id", "n", "node", comp.alias("comp"))
    # a row without an id can't name its component
    candidate = F.when(F.col("id").isNotNull(), F.struct("id", "node"))
    least = named.where("comp IS NOT NULL").groupBy("comp").agg(F.min(candidate).alias("first"))
    found = named.join(least, "comp", "left").select("id", "n", "node", "first")
    found = stored(spark, found, "jaccard-components")
    freed(spark, placed, label)
    return found, seed


def _several(lying: DataFrame) -> DataFrame:
    """(region, pivot) of the regions with several sets."""
    return (
        lying.groupBy("region")
        .agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
        .where("pivot <> last")
        .select("region", "pivot")
    )


def _earlier(places: DataFrame, placed: DataFrame) -> DataFrame:
    """``places`` (node, place, ...) with the few regions of the set just before that place.

    Added to those rows only that are still to be compared: beside every row of every region,
    these lists would be most of what is shuffled.
    """
    wanted = places.select("node").distinct()
    windows = placed.select("node", "regions").join(wanted, "node", "left_semi")
    windows = windows.groupBy("node").agg(F.any_value("regions").alias("regions"))
    start = F.greatest(F.col("place") - LOOK_BACK + 1, F.lit(1))
    before = F.slice("regions", start, F.least("place", F.lit(LOOK_BACK)))
    return places.join(windows, "node").withColumn("earlier", before).drop("regions")


def _labels(spark, rows, placed, shingle, percent, small, seed) -> DataFrame:
    """(node, comp) of the nodes that link to another."""
    lying = placed.where("size(regions) > 0")
    several = _several(lying.select("node", F.explode("regions").alias("region")))
    member = ["node", "n", "place"]
    placing = lying.select("node", "n", F.posexplode("regions").alias("place", "region"))
    shared = stored(spark, placing.join(several, "region").select("region", *member).distinct(), "jaccard-shared")
    # sizes of sets within r differ by a factor of 100 / percent at most: a set belongs to
    # its band of sizes and to the next, so that each pair within r has a band in common
    if percent < 100:
        band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9)
        banded = shared.select("*", F.posexplode(F.array(band, band + 1)).alias("upper", "band"))
    else:
        banded = shared.select("*", F.lit(0).alias("upper"), F.col("n").alias("band"))
    member = [*member, "upper"]
    banded = banded.select(F.xxhash64("region", "band").alias("region"), *member)
    members = stored(spark, banded.join(_several(banded), "region").distinct(), "jaccard-members")
    freed(spark, shared)
    wanted = members.select("node").distinct()
    sketches = placed.join(wanted, "node", "left_semi").groupBy("node").agg(
        F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch")
    )
    sketches = stored(spark, sketches, "jaccard-sketches")

    def near_pairs(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        judged = stored(spark, _judged(pairs, sketches, percent), "jaccard-judged")
        return judged, _distances(judged.where("possible").select("a", "b"), rows, shingle, percent, seed)

    pairs = members.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    judged, measured = near_pairs(pairs)
    links = measured.where("links").select("a", "b")
    # the pivot has met all others and leaves; the rest keep the bounds of their distance to it
    kept = [*member, "earlier", "lo", "hi"]
    first = judged.join(measured, ["a", "b"], "left").select(
        F.col("a").alias("node"),
        F.col("b").alias("pivot"),
        F.coalesce("distance", "lo").alias("lo"),
        F.coalesce("distance", F.lit(1.0)).alias("hi"),
    )
    label = components(spark, links)
    # regions whose rest lies in one component are done, and need no more of their rows
    rest = members.where("node <> pivot").join(first, ["node", "pivot"]).join(label, "node", "left")
    rest = stored(spark, rest.select("region", *member, "lo", "hi", F.coalesce("comp", "node").alias("comp")), "jaccard-rest")
    undone = rest.groupBy("region").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    state = rest.join(undone.select("region"), "region", "left_semi").select("region", *member, "lo", "hi")
    state = stored(spark, _earlier(state, placed).select("region", *kept), "jaccard-regions")
    freed(spark, members, judged, measured, rest)
    radius = (100 - percent) / 100 + 1e-9
    pivots = FIRST_PIVOTS
    while True:
        labelled = state.join(label, "node", "left").select(
            "region", *kept, F.coalesce("comp", "node").alias("comp")
        )
        open_regions = (
            labelled.groupBy("region")
            .agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size"), F.min(F.xxhash64("node", F.lit(pivots))).alias("least"))
            .where("low <> high")
            .select("region", "size", "least")
        )
        live = stored(spark, labelled.join(open_regions, "region"), "jaccard-open")
        if not live.limit(1).count():
            freed(spark, sketches, state, live)
            return label
        draw = F.xxhash64("node", F.lit(pivots))
        share = F.pmod(draw, F.lit(1 << 30)) / float(1 << 30)
        is_pivot = (F.col("size") <= small) | (draw == F.col("least")) | (share * F.col("size") < pivots)
        live = live.withColumn("pivot", is_pivot)
        drawn = live.where("pivot").select(
            "region",
            F.col("node").alias("b"),
            F.col("comp").alias("other"),
            F.col("lo").alias("lo_b"),
            F.col("hi").alias("hi_b"),
            F.col("n").alias("m"),
            F.col("place").alias("place_b"),
            F.col("earlier").alias("earlier_b"),
            F.col("upper").alias("upper_b"),
        )
        near = (F.col("lo") - F.col("hi_b") <= radius) & (F.col("lo_b") - F.col("hi") <= radius)
        # in the first region that two sets share, all they have in common is yet to come
        enough = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("place_b")) * (100 + percent) >= percent * (
            F.col("n") + F.col("m")
        )
        # the pair is also in an earlier region of this band, or in the band below
        elsewhere = ((F.col("upper") == 1) & (F.col("upper_b") == 1)) | F.arrays_overlap("earlier", "earlier_b")
        # two pivots of a region meet once
        once = ~F.col("pivot") | (F.col("node") < F.col("b"))
        pairs = (
            live.join(drawn, "region")
            .where((F.col("comp") != F.col("other")) & near & enough & once & ~elsewhere)
            .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
            .distinct()
        )
        judged, measured = near_pairs(pairs)
        more = measured.where("links").select("a", "b")
        if more.limit(1).count():
            label = stored(spark, _merged(spark, label, more), "jaccard-labels")
        seen = state
        state = stored(spark, live.where("NOT pivot").select("region", *kept), "jaccard-regions")
        freed(spark, seen, live, judged, measured)
        pivots *= MORE_PIVOTS


def _merged(spark, label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` after further links: only these are followed, between components."""
    own_a = label.select(F.col("node").alias("a"), F.col("comp").alias("comp_a"))
    own_b = label.select(F.col("node").alias("b"), F.col("comp").alias("comp_b"))
    between = links.join(own_a, "a", "left").join(own_b, "b", "left")
    between = between.select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))
    joined = components(spark, between.distinct())
    names = joined.select(F.col("node").alias("comp"), F.col("comp").alias("new"))
    old = label.join(names, "comp", "left").select("node", F.coalesce("new", "comp").alias("comp"))
    # sets that had no link before
    return old.unionByName(joined.join(label.select("node"), "node", "left_anti"))


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
    small: int = SMALL_REGION,
) -> DataFrame:
    """One row of each component, the first by id and set, in the columns of ``docs``.

    Rows without an id stay. Where an id repeats, its rows are told apart by their sets: each
    stays or goes for its own text, and of rows with one id and one set one stays.
    """
    spark = docs.sparkSession
    found, seed = _joined(docs, id, text, shingle, percent, small)
    key, node = own("id"), own("node")
    named = found.where("id IS NOT NULL").withColumnsRenamed({"id": key, "node": node})
    twice = named.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(key)
    twice = stored(spark, twice, "jaccard-repeated")
    goes = F.col(node).isNotNull() & (F.struct(F.col(key).alias("id"), F.col(node).alias("node")) != F.col("first"))
    gone = named.where(goes).select(key, node).distinct()
    same_id = F.col(f"`{id}`") == F.col(key)
    # one plan at every size: few ids would be sent to the texts, many are met by a shuffle of them
    going = gone.select(key).hint("merge")
    if twice.isEmpty():
        return docs.join(going, same_id, "left_anti")
    single = docs.join(twice, same_id, "left_anti").join(going, same_id, "left_anti")
    several = _with_node(docs.join(twice, same_id, "left_semi"), text, own("set"), shingle, seed)
    its_set = F.col(several.columns[-1])
    left = several.join(gone, same_id & (its_set == F.col(node)), "left_anti")
    one = left.where(its_set.isNotNull()).dropDuplicates([id, several.columns[-1]])
    return single.unionByName(one.unionByName(left.where(its_set.isNull())).drop(several.columns[-1]))


def _with_node(rows: DataFrame, text: str, name: str, shingle: int, seed: int) -> DataFrame:
    """``rows`` with the hash of their set as a last column, null for an empty set."""
    at = rows.columns.index(text)

    def run(batches):
        for batch in batches:
            for a, b in W.chunks(batch.column(at)):
                part = batch.slice(a, b - a)
                grams, bounds = sets(part.column(at), shingle, seed)
                empty = np.diff(bounds) == 0
                yield part.append_column(name, pa.array(_sums(grams, bounds, 1).view(np.int64), mask=empty))

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())]))
