"""Document fingerprints: one-permutation MinHash with optimal densification and b bits.

A text's shingles are hashed once. The top bits of a hash name its bin, and a bin keeps
its smallest hash. An empty bin takes the value of the filled bin that comes first in that
bin's own random order of bins: the bin that trying one random bin after another would
reach. The low BITS bits of each bin are packed as hexadecimal. Likeness is the share of
equal bins, corrected for bins that are equal by chance. All DataFrame functions, row by
row: sorting a row's hashes puts the smallest of each bin first.

Words are runs of other than ASCII blanks, A-Z in lower case. A shingle is five words; a
text of fewer words is one shingle. A null, empty or blank text has the empty fingerprint,
which is like itself (1.0) and unlike all others (0.0). Equal texts have equal fingerprints.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.llm.frames import ascii_lower, own

SHINGLE, BINS, BITS = 5, 128, 8
_BLANK = "[\\x20\\x09-\\x0D]+"


def word_hashes(text: Column) -> Column:
    """Hashes of the words; one hash, of the empty word, if there is none."""
    words = F.split(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), f"^{_BLANK}|{_BLANK}$", ""), _BLANK)
    return F.transform(words, lambda w: F.xxhash64(w))


def with_fingerprint(frame: DataFrame, text: Column, name: str, shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``frame`` and the column ``name``: ``bins`` packed values of ``bits`` (4 or 8) bits.

    The steps are columns of their own, as each is used several times by the next."""
    if bits not in (4, 8) or bins & (bins - 1):
        raise ValueError("bits must be 4 or 8, bins a power of two")
    shift, low = 64 - int(math.log2(bins)), (1 << bits) - 1
    blank, hashes, grams, filled, values = (own(c) for c in ("blank", "words", "grams", "filled", "values"))
    text = F.coalesce(text, F.lit(""))
    n = F.size(hashes)
    several = F.transform(
        F.sequence(F.lit(0), n - shingle),
        lambda i: F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(shingle)]),
    )
    single = F.array(F.xxhash64(F.lit("short"), F.array_join(F.transform(hashes, lambda h: h.cast("string")), " ")))
    bin_of = lambda h: F.shiftrightunsigned(h, shift)
    first = lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(F.col(grams), i - 1)))
    # a filled bin as one number: its place above its value
    packed = F.transform(F.filter(F.col(grams), first), lambda h: F.shiftleft(bin_of(h), bits).bitwiseOR(h.bitwiseAND(low)))
    high = F.lit(~low)

    places = own("places")
    # for an empty bin: the filled bin with the least hash of (empty bin, filled bin); the
    # value rides in the low bits
    nearest = lambda b: F.array_min(
        F.transform(
            F.col(filled),
            lambda x: F.xxhash64(b, F.shiftright(x, bits)).bitwiseAND(high).bitwiseOR(x.bitwiseAND(low)),
        )
    ).bitwiseAND(low)

    def dense(b: Column) -> Column:
        at = F.array_position(F.col(places), b)
        return F.when(at > 0, F.get(F.col(filled), (at - 1).cast("int")).bitwiseAND(low)).otherwise(nearest(b))

    width = bits // 4
    text_of = F.array_join(F.transform(F.col(values), lambda v: F.lpad(F.hex(v), width, "0")), "")
    return (
        frame.withColumn(blank, F.length(F.btrim(text, F.lit(" \t\n\x0b\f\r"))) == 0)
        .withColumn(hashes, word_hashes(text))
        # signed order is as good as any, as long as a bin's hashes lie together
        .withColumn(grams, F.sort_array(F.when(n >= shingle, several).otherwise(single)))
        .withColumn(filled, packed)
        .withColumn(places, F.transform(F.col(filled), lambda x: F.shiftright(x, bits)))
        .withColumn(values, F.transform(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")), dense))
        .withColumn(name, F.when(F.col(blank), F.lit("")).otherwise(text_of))
        .drop(blank, hashes, grams, filled, places, values)
    )


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The estimated Jaccard likeness of two fingerprints, 0 to 1."""
    width = bits // 4
    equal = F.aggregate(
        F.sequence(F.lit(0), F.lit(bins - 1)),
        F.lit(0),
        lambda n, i: n + F.when(F.substr(a, i * width + 1, F.lit(width)) == F.substr(b, i * width + 1, F.lit(width)), 1).otherwise(0),
    )
    chance = 1.0 / (1 << bits)
    estimate = (equal / F.lit(float(bins)) - F.lit(chance)) / F.lit(1 - chance)
    return (
        F.when((a == "") & (b == ""), 1.0)
        .when((a == "") | (b == ""), 0.0)
        .when(a == b, 1.0)
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate)))
    )


#: Ids are taken in groups of 2**GROUP_BITS neighbouring ids, and groups likewise.
GROUP_BITS = 10


def _group(id: Column) -> Column:
    return F.shiftright(id, GROUP_BITS)


def next_rows(rows: DataFrame, id: str, columns: list[str]) -> DataFrame:
    """``rows`` and a struct ``next`` of ``columns`` of the row with the next smaller id;
    after the smallest, of the row with the largest. Ids are whole numbers, each once.

    No window spans the table: rows are put in order within groups of neighbouring ids,
    and each group's largest row is found by doing the same with the groups.
    """
    group, head, after_group, found = own("group"), own("head"), own("after"), own("found")
    grouped = rows.withColumn(group, _group(F.col(id).cast("long")))
    order = Window.partitionBy(group).orderBy(F.col(id).desc())
    inside = grouped.withColumn("next", F.lead(F.struct(*columns)).over(order)).withColumn(
        head, F.row_number().over(order) == 1
    )
    heads = inside.where(F.col(head)).select(group, F.struct(*columns).alias(head))
    spread = rows.agg(F.max(F.abs(F.col(id).cast("double")))).first()[0] or 0.0
    levels = max(1, math.ceil(math.log2(spread + 2) / GROUP_BITS))
    ids = heads.select(group)
    follows = _next_keys(ids, group, levels)
    after = (
        follows.join(heads.select(F.col(group).alias("key"), F.col(head).alias(found)), F.col("to") == F.col("key"))
        .select(F.col("from").alias(after_group), found)
    )
    return (
        inside.join(after, F.col(group) == F.col(after_group), "left")
        .withColumn("next", F.coalesce("next", found))
        .drop(group, head, after_group, found)
    )


def _next_keys(keys: DataFrame, key: str, levels: int) -> DataFrame:
    """(from, to): each key and the next smaller one; the largest follows the smallest."""
    keys = keys.select(F.col(key).alias("from")).distinct()
    if levels <= 1:
        # at most a few keys are left: one group holds them all
        order = Window.partitionBy(F.lit(0)).orderBy(F.col("from").desc())
        whole = Window.partitionBy(F.lit(0))
        return keys.select("from", F.coalesce(F.lead("from").over(order), F.max("from").over(whole)).alias("to"))
    order = Window.partitionBy("g").orderBy(F.col("from").desc())
    inside = keys.withColumn("g", _group(F.col("from"))).withColumn("to", F.lead("from").over(order))
    heads = inside.groupBy("g").agg(F.max("from").alias("top"))
    follows = _next_keys(heads, "g", levels - 1)
    after = follows.join(heads.withColumnRenamed("g", "to"), "to").select(F.col("from").alias("g"), "top")
    return inside.join(after, "g", "left").select("from", F.coalesce("to", "top").alias("to"))
