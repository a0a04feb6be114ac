"""Spelling variants: words one edit from a more frequent word.

The pairs come from a composition of finite-state machines: the minimised acceptor of the
vocabulary, a transducer that makes exactly one edit (one code point replaced, deleted or
inserted), and the acceptor again. A path of the composition is a pair of states and the
edits spent; before the edit both states are one, after it they read equal symbols, and where
they meet in one minimised state, all that follows is accepted by both at once.

The whole acceptor would be one machine, so the composition starts from many initial states,
each in a partition of its own. For words of ``e`` and ``e - 1`` code points, the edit lies
after the first ``h = ceil((e - 1) / 2)`` code points or before the last ``e - h``:

* ``forward``: the state after reading a word's first ``h`` code points, paired with itself;
* ``backward``: the same from the end, over reversed words, for the edits before ``h``.

So a pair is accepted from exactly one initial state, and a state's acceptor holds only the
words that share half of their code points. A state with more words than ``MOST`` is
expanded: its edit is made one place at a time, and the two continuations are joined as rows
(``_expanded``), where no group is larger than the alphabet.

Defined cases: a null text has no runs; a null id counts as an empty one; repeated rows count
as often as they occur; a table without words gives no rows; other columns of the input are
ignored, whatever their names. Of equally frequent near words the smallest in code-point order
is the form. Forms at least double the count, so following them ends.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm.frames import stored

#: Letters of a run once A-Z is folded: fixed value.
RUN = re.compile("[a-zÀ-ÿ]+")

#: Words that a task counts before it sends them on, and their code points.
HELD, HELD_CHARS = 300_000, 1 << 23

#: Words of one initial state that are compiled into one acceptor.
MOST = 20_000

_COUNTS = "word string, n long"
_PAIRS = "word string, near string, near_n long"


def variants(docs: DataFrame, damage: int = 97, shortest: int = 5, least: int = 3, times: int = 2, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word.

    Of each run whose crc32 with its document's id divides by ``damage``, one code point is
    deleted (0: of none). Words have ``shortest`` code points and occur ``least`` times, at
    least; a form is ``times`` as frequent as the word, at least.
    """
    spark = docs.sparkSession
    parts = docs.select("doc_id", "text").mapInArrow(_counter(damage, shortest), _COUNTS)
    words = stored(
        spark, parts.groupBy("word").agg(F.sum("n").alias("n")).where(f"n >= {least}"), "words"
    )
    best = near_pairs(words, most).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    enough = F.expr(f"-best.less >= {times} * n")
    formed = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(spark, formed, "forms")
    roots = _roots(spark, formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, near, near_n) for every ordered pair of words (word, n) one edit apart.

    Words are distinct and not empty.
    """
    spark = words.sparkSession
    starts = words.select("word", "n", F.explode(_initial_states()).alias("state"))
    sizes = starts.groupBy("state").agg(F.count(F.lit(1)).alias("size"))
    large = stored(spark, sizes.where(F.col("size") > most).select("state"), "large-states")
    if large.isEmpty():
        return _composed(starts)
    usual = starts.join(large, "state", "left_anti")
    return _composed(usual).unionByName(_expanded(starts.join(large, "state", "left_semi")))


def _initial_states():
    """For a word of L code points, the states it belongs to as one of L and of L + 1."""
    states = []
    for longer in (0, 1):
        e = f"(char_length(word) + {longer})"
        h = f"int(ceil(({e} - 1) / 2))"
        states.append(f"concat('f', {e}, ':', left(word, {h}))")
        states.append(f"concat('b', {e}, ':', right(word, {e} - {h}))")
    return F.expr(f"array({', '.join(states)})")


def _half(e: int) -> int:
    return e // 2  # the same as ceil((e - 1) / 2)


def _composed(starts: DataFrame) -> DataFrame:
    cut = starts.repartition("state").sortWithinPartitions("state")
    return cut.select("state", "word", "n").mapInArrow(_compose_groups, _PAIRS)


def _expanded(starts: DataFrame) -> DataFrame:
    """The same pairs for states with many words, one row for each place of the edit.

    Before a replacement at place i the words agree, and after it again, so both share the
    word without its symbol i. For a deletion, that is the shorter word itself; of a run of
    equal symbols only the last is deleted.
    """
    e = F.expr("int(substring(split_part(state, ':', 1), 2))")
    half = F.expr("int(ceil((e - 1) / 2))")
    forward = F.expr("startswith(state, 'f')")
    rows = starts.withColumn("e", e).withColumn("half", half).withColumn("forward", forward)
    first = F.when(F.col("forward"), F.col("half")).otherwise(0)
    last = F.when(F.col("forward"), F.char_length("word") - 1).otherwise(F.col("half") - 1)
    at = rows.where(F.char_length("word") == F.col("e")).where("forward OR half > 0").select(
        "state", "word", "n", F.explode(F.sequence(first, last)).alias("place")
    )
    rest = F.expr("concat(left(word, place), substring(word, place + 2))")
    symbol = F.expr("substring(word, place + 1, 1)")
    holes = at.select("state", "word", "n", "place", rest.alias("rest"), symbol.alias("symbol"))
    a, b = holes.alias("a"), holes.alias("b")
    same = (F.col("a.state") == F.col("b.state")) & (F.col("a.place") == F.col("b.place"))
    replaced = a.join(b, same & (F.col("a.rest") == F.col("b.rest")) & (F.col("a.symbol") != F.col("b.symbol")))
    replaced = replaced.select(F.col("a.word").alias("word"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))
    last_of_run = F.expr("substring(word, place + 2, 1) <> symbol OR place = char_length(word) - 1")
    shorter = rows.where(F.char_length("word") == F.col("e") - 1).select(
        "state", F.col("word").alias("rest"), F.col("n").alias("short_n")
    )
    deleted = holes.where(last_of_run).join(shorter, ["state", "rest"])
    return (
        replaced.unionByName(deleted.select("word", F.col("rest").alias("near"), F.col("short_n").alias("near_n")))
        .unionByName(deleted.select(F.col("rest").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    )


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, twice as far in each round."""
    links = stored(spark, forms.withColumnRenamed("form", "root"), "roots")
    while True:
        far = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = stored(spark, links.join(far, "root", "left"), "roots")
        moved = not found.where("further IS NOT NULL").isEmpty()
        links = found.select("word", F.coalesce("further", "root").alias("root"))
        if not moved:
            return links


# -- reading texts, an Arrow batch at a time ----------------------------------


def _counter(damage: int, shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        chars = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                # bytes fold A-Z and nothing else
                runs = Counter(RUN.findall(text.encode().lower().decode()))
                head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in runs.items():
                    if damage:
                        h = zlib.crc32(word.encode(), head)
                        if not h % damage:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= shortest:
                        if word not in counts:
                            chars += len(word)
                        counts[word] += n
                if len(counts) > HELD or chars > HELD_CHARS:
                    yield _counted(counts)
                    counts.clear()
                    chars = 0
        yield _counted(counts)

    return run


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
    )


# -- one initial state's machines ----------------------------------------------


def _compose_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each state's words; the rows of a state follow one another."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)

    out: tuple[list, list, list] = ([], [], [])

    def batch():
        made = pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
            ["word", "near", "near_n"],
        )
        for column in out:
            column.clear()
        return made

    for state, group in groupby(rows(), key=lambda row: row[0]):
        known = {word: n for _, word, n in group}
        if len(known) < 2:
            continue
        for x, y in compose(state, known):
            out[0].extend((x, y))
            out[1].extend((y, x))
            out[2].extend((known[y], known[x]))
            if len(out[0]) > 50_000:
                yield batch()
    yield batch()


def compose(state: str, words) -> Iterator[tuple[str, str]]:
    """Unordered pairs that acceptor, one-edit transducer and acceptor take from a state."""
    name, _, shared = state.partition(":")
    e, backward = int(name[1:]), name[0] == "b"
    if not any(len(w) == e for w in words):
        return
    half, cut = _half(e), len(shared)
    if backward:
        tails = sorted(w[::-1][cut:] for w in words)
    else:
        tails = sorted(w[cut:] for w in words)
    for x, y in pairs(minimised(tails)):
        if max(len(x), len(y)) + cut != e:
            continue
        if backward:
            x, y = x[::-1] + shared, y[::-1] + shared
            if x[:half] != y[:half]:
                yield x, y
        else:
            yield shared + x, shared + y


def minimised(tails: list[str]) -> tuple[list[tuple[bool, dict[str, int]]], int]:
    """States (final, arcs) of the minimal acyclic acceptor of sorted strings, and the first.

    Built a string at a time: what the next string no longer shares is final, and is replaced
    by an equal state if there is one.
    """
    states: list[tuple[bool, dict[str, int]]] = []
    known: dict[tuple, int] = {}
    path: list[list] = [[False, {}]]  # open states along the last string
    last = ""

    def close(down_to: int):
        while len(path) > down_to + 1:
            final, arcs = path.pop()
            key = (final, *arcs.items())
            number = known.get(key)
            if number is None:
                number = known[key] = len(states)
                states.append((final, arcs))
            path[-1][1][last[len(path) - 1]] = number

    for tail in tails:
        shared = 0
        for a, b in zip(tail, last, strict=False):
            if a != b:
                break
            shared += 1
        close(shared)
        for _ in range(len(tail) - shared):
            path.append([False, {}])
        path[-1][0] = True
        last = tail
    close(0)
    states.append((path[0][0], path[0][1]))
    return states, len(states) - 1


def pairs(machine) -> Iterator[tuple[str, str]]:
    """Strings accepted on both sides of exactly one edit, each pair once, a longer one first."""
    states, start = machine

    def text(node) -> str:
        symbols = []
        while node is not None:
            node, symbol = node
            symbols.append(symbol)
        return "".join(reversed(symbols))

    before = [(start, None)]  # no edit yet: one state, what was read
    while before:
        state, read = before.pop()
        _, arcs = states[state]
        items = list(arcs.items())
        after = []  # edited: both states, what each has read, a symbol barred from the shorter
        for k, (symbol, to) in enumerate(items):
            before.append((to, (read, symbol)))
            after.append((to, state, (read, symbol), read, symbol))
            for other, goal in items[k + 1 :]:
                after.append((to, goal, (read, symbol), (read, other), None))
        while after:
            a, b, left, right, barred = after.pop()
            if a != b or barred is not None:
                (end_a, arcs_a), (end_b, arcs_b) = states[a], states[b]
                if end_a and end_b:
                    yield text(left), text(right)
                if len(arcs_b) < len(arcs_a):
                    common = [s for s in arcs_b if s in arcs_a]
                else:
                    common = [s for s in arcs_a if s in arcs_b]
                for s in common:
                    if s != barred:
                        after.append((arcs_a[s], arcs_b[s], (left, s), (right, s), None))
                continue
            # both sides are in one state: all that it accepts
            x, y = text(left), text(right)
            rest = [(a, None)]
            while rest:
                state_r, tail = rest.pop()
                end, arcs_r = states[state_r]
                if end:
                    z = text(tail)
                    yield x + z, y + z
                rest.extend((to, (tail, s)) for s, to in arcs_r.items())
