"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches, those with the largest ids first. A run is a stored table of
(h1, h2, keeper, n_docs), sorted by hash. A batch is anti-joined with all runs: a key that
no run has gets its keeper here, the largest id that holds it. The batch's own rows become
a run of level 0; when a level is full, its runs are merged into one of the next level. So
every key is rewritten once a level, and the runs together hold one keeper for each key.

Keys are two 64-bit hashes of the line, stripped of ASCII blanks and with A-Z lowered.
Everything is DataFrame functions. Line texts are never shuffled by key, only hashes.

Defined cases: a null or empty text is one empty line. A row without an id keeps all its
lines and counts for no key. Rows with the same id are one document: lines go from all of
them or from none. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm.frames import BLANKS, ascii_lower, freed, own, stored

MIN_CHARS, MIN_DOCS = 40, 5
#: Batches of one pass over a table; runs of a level before they are merged.
BATCHES, FANOUT = 4, 2
#: Parts into which the rows of one key are spread when they meet the keepers.
SALT = 16


def _stripped(line: Column) -> Column:
    # TRIM with a set of characters has no Column form that takes escapes
    return F.btrim(line, F.expr(f"'{BLANKS}'"))


def _hashes(stripped: Column) -> tuple[Column, Column]:
    key = ascii_lower(stripped)
    return F.xxhash64(key), F.xxhash64(F.lit("line"), key)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keys(docs: DataFrame, id: str, text: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row (id, h1, h2) for each long line of each document."""
    lines = docs.where(F.col(id).isNotNull()).select(
        F.col(id).alias("id"), F.explode(split_lines(F.col(text))).alias("line")
    )
    stripped = lines.select("id", _stripped(F.col("line")).alias("line"))
    h1, h2 = _hashes(F.col("line"))
    return stripped.where(F.length("line") >= min_chars).select("id", h1.alias("h1"), h2.alias("h2"))


def _steps(values: Column) -> Column:
    """Powers of two up to an array's size, the largest first: the steps of a search in it."""
    return F.filter(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]), lambda s: s <= F.size(values))


def _in_sorted(values: Column, steps: Column, key: Column) -> Column:
    """Whether a sorted array has the key, by binary search: a text of very many dropped
    lines takes time in proportion to its lines."""
    below = F.aggregate(
        steps,
        F.lit(0),
        lambda at, s: F.when(F.get(values, at + s - 1) < key, at + s).otherwise(at),
    )
    return F.coalesce(F.get(values, below) == key, F.lit(False))


class LineRuns:
    """Runs of line hashes in levels. ``add`` takes batches in falling order of ids."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def all(self) -> DataFrame | None:
        runs = [run for level in self.levels for run in level]
        if not runs:
            return None
        whole = runs[0]
        for run in runs[1:]:
            whole = whole.unionByName(run)
        return whole

    def add(self, batch: DataFrame) -> None:
        """Merge-anti-join a batch of distinct (id, h1, h2) with the runs and add its run."""
        own_keys = batch.groupBy("h1", "h2").agg(
            F.max("id").alias("last"), F.count("*").alias("n_docs")
        )
        known = self.all()
        if known is None:
            run = own_keys.withColumnRenamed("last", "keeper")
        else:
            owned = known.where("keeper IS NOT NULL").select("h1", "h2")
            fresh = own_keys.join(owned, ["h1", "h2"], "left_anti").select(
                "h1", "h2", F.col("last").alias("keeper"), F.lit(0).cast("long").alias("n_docs")
            )
            counts = own_keys.select(
                "h1", "h2", F.lit(None).cast(own_keys.schema["last"].dataType).alias("keeper"), "n_docs"
            )
            run = _merged(fresh.unionByName(counts))
        self._put(0, run)

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        # sorted by hash, so that a file's statistics bound its keys
        run = stored(self.spark, run.sortWithinPartitions("h1", "h2"), f"line-run-{level}")
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            whole = full[0]
            for other in full[1:]:
                whole = whole.unionByName(other)
            self._put(level + 1, _merged(whole))
            freed(self.spark, *full)

    def merged(self) -> DataFrame:
        """One row for each key: its keeper and the number of documents with it."""
        return _merged(self.all())


def _merged(runs: DataFrame) -> DataFrame:
    return runs.groupBy("h1", "h2").agg(
        F.max("keeper").alias("keeper"), F.sum("n_docs").alias("n_docs")
    )


def _batched(lines: DataFrame, batches: int) -> list[DataFrame]:
    """The stored keys cut into ranges of ids, the largest ids first."""
    if batches < 2:
        return [lines]
    if dict(lines.dtypes)["id"] in ("string", "binary"):  # no quantiles: one batch
        return [lines]
    cuts = lines.approxQuantile("id", [k / batches for k in range(1, batches)], 0.01)
    if not cuts:
        return [lines]
    edges = [None, *sorted(set(cuts)), None]
    parts = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        test = F.lit(True)
        if low is not None:
            test = test & (F.col("id") > F.lit(low))
        if high is not None:
            test = test & (F.col("id") <= F.lit(high))
        parts.append(lines.where(test))
    return parts[::-1]


def dedup(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """All columns of ``docs`` with the kept lines as text, and n_lines, n_dropped (long).

    A line of at least ``min_chars`` code points found in at least ``min_docs`` documents
    stays only in the one with the largest id. Columns n_lines and n_dropped of ``docs`` go.
    """
    spark = docs.sparkSession
    lines = stored(spark, keys(docs, id, text, min_chars).distinct(), "line-keys")
    runs = LineRuns(spark, fanout)
    for batch in _batched(lines, batches):
        runs.add(batch)
    common = runs.merged().where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")
    # a line of a third of all documents meets its keeper in SALT tasks
    common = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int"))
    gone, dropped = own("id"), own("dropped")
    decisions = (
        salted.join(common, ["h1", "h2", "salt"])
        .where(F.col("id") != F.col("keeper"))
        .groupBy(F.col("id").alias(gone))
        .agg(F.sort_array(F.collect_set(F.struct("h1", "h2"))).alias(dropped))
    )
    # what is dropped is little beside the keys of all lines, which can go
    decisions = stored(spark, decisions, "line-decisions")
    freed(spark, lines, *(run for level in runs.levels for run in level))
    rest = docs.drop("n_lines", "n_dropped")
    # one plan at every size: few decisions would be sent to the texts, many are met by a shuffle
    # of them, so what small tables take of disk would say nothing of large ones
    joined = rest.join(decisions.hint("merge"), rest[id] == decisions[gone], "left")

    def stays(line: Column) -> Column:
        stripped = _stripped(line)
        h1, h2 = _hashes(stripped)
        found = _in_sorted(F.col(dropped), F.col(steps), F.struct(h1.alias("h1"), h2.alias("h2")))
        return ~((F.length(stripped) >= min_chars) & found)

    every, some, steps = own("every"), own("some"), own("steps")
    every_line = split_lines(F.col(text))
    cut = joined.withColumns({every: F.size(every_line).cast("long"), steps: _steps(F.col(dropped))}).withColumn(
        some, F.when(F.col(dropped).isNotNull(), F.filter(every_line, stays))
    )
    kept = F.when(F.col(some).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(some, "\n")
    )
    return cut.select(
        *[kept.alias(text) if c == text else F.col(f"`{c}`") for c in rest.columns],
        F.col(every).alias("n_lines"),
        F.when(F.col(some).isNull(), F.lit(0)).otherwise(F.col(every) - F.size(some)).cast("long").alias("n_dropped"),
    )
