"""Phrases whose words belong together, from count streams in prefix and suffix order.

A text is cut into pieces at ``[.,;:!?`` and line ends ``]`` and those into words at blanks;
A-Z is folded. Everything is counted per language. As language-model builders do that
estimate from sorted streams, the corpus is read into one stream of counted triples: each
word with the two after it, or with nothing where the piece ends. A task adds up what it has
seen in sorted runs before anything is shuffled.

* In *prefix order* (first word, second, third) a pair's triples lie side by side: its count
  is their sum, its likeliest longer phrase to the right their largest.
* In *suffix order* (last two words first) frequent triples meet the pair that ends them, and
  the pair learns its likeliest longer phrase to the left.

Both are sort-merge joins of sorted streams, so no table of counts is held in memory. The
parts of a phrase are at least as frequent as the phrase, so streams are cut at the least
count once they are added up, and nothing that a result needs is lost.

Words are carried as 64-bit hashes of language and word (see ``words.py`` for what that
assumes) and get their text back at the end. One triple's occurrences are one row for each
run of ``RUN`` words, and pairs are dealt out by both words, so neither a frequent word nor a
frequent passage makes a long task.

Defined cases: a null text is empty, a null language is ``und``; repeated rows count as often
as they occur; a table without words gives no rows; other columns of the input are ignored,
whatever their names. A text is hashed whole, at about 50 bytes of memory for each of its
bytes. Equal scores are ordered by count, then by the phrase's bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.llm import words
from fieldgauge.llm.frames import stored

#: The bytes that end a piece, and those that end a word as well: fixed values.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"

#: Words of a task that are added up before they leave it, and rows sent on at once.
RUN = 3_000_000
SENT = 1 << 18

_SOLID = np.ones(256, bool)
_SOLID[list(PIECE_ENDS + BLANKS)] = False
_ENDS = np.zeros(256, bool)
_ENDS[list(PIECE_ENDS)] = True


def collocations(docs: DataFrame, least: int = 10, absorb_percent: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of two or three words of each language.

    lang, rank, phrase, a (its count), l and r (the counts of the two parts of its weakest
    cut), n (words of the language) and score. A pair goes if a triple around it has at least
    ``absorb_percent`` of its count; both have to occur ``least`` times.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counted = _dictionary(texts)
    vocabulary = stored(
        spark, counted.where(f"word IS NULL OR n >= {least}"), "phrase-words"
    )
    totals = vocabulary.where("word IS NULL").select("lang", F.col("n").alias("total"))
    known = vocabulary.where("word IS NOT NULL").select("w", "lang", "word", "n")
    stream = stored(spark, _prefix_order(texts, least), "phrase-counts")
    pairs = stream.where("head AND w2 <> 0").select("w1", "w2", F.col("pair").alias("a"), "to_right")
    triples = stream.where(f"w3 <> 0 AND a >= {least}").select("w1", "w2", "w3", "a", "pair")
    scored = _pairs(pairs, triples, known, least, absorb_percent).unionByName(
        _triples(pairs, triples, known)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals.hint("merge"), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )


def _dictionary(texts: DataFrame) -> DataFrame:
    """(w, lang, word, n) of every word, and each language's total where ``word`` is null."""
    parts = texts.mapInArrow(_word_counts, "w long, lang string, word string, n long")
    return parts.groupBy("w", "lang", "word").agg(F.sum("n").alias("n"))


def _prefix_order(texts: DataFrame, least: int) -> DataFrame:
    """Frequent triples and pairs. ``a`` is the triple's count and ``pair`` that of its first
    two words; a pair that is frequent has one row, at least, and one of its rows is its head."""
    stream = texts.mapInArrow(_triple_counts, "w1 long, w2 long, w3 long, c long")
    triples = (
        stream.repartition("w1", "w2").groupBy("w1", "w2", "w3").agg(F.sum("c").alias("a"))
    )
    same = Window.partitionBy("w1", "w2")
    return triples.select(
        "*",
        F.sum("a").over(same).alias("pair"),
        F.max(F.when(F.col("w3") != 0, F.col("a"))).over(same).alias("to_right"),
        (F.col("w3") == F.min("w3").over(same)).alias("head"),
    ).where((F.col("pair") >= least) & (F.col("head") | (F.col("a") >= least)))


def _pairs(pairs, triples, known, least: int, absorb_percent: int) -> DataFrame:
    """Scored pairs that no longer phrase takes in."""
    before = triples.groupBy(F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("to_left"))
    longer = F.greatest(F.coalesce("to_left", F.lit(0)), F.coalesce("to_right", F.lit(0)))
    kept = pairs.join(before.hint("merge"), ["w1", "w2"], "left").where(
        (longer < least) | (100 * longer < absorb_percent * F.col("a"))
    )
    first = known.select(F.col("w").alias("w1"), "lang", F.col("word").alias("x1"), F.col("n").alias("l"))
    last = known.select(F.col("w").alias("w2"), F.col("word").alias("x2"), F.col("n").alias("r"))
    found = kept.join(first.hint("merge"), "w1").join(last.hint("merge"), "w2")
    return found.select(
        "lang", F.concat_ws(" ", "x1", "x2").alias("phrase"), "a", "l", "r", _score("l", "r")
    )


def _triples(pairs, triples, known) -> DataFrame:
    """Scored triples: after the first word, or after the second if that scores lower."""
    ends = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"))
    first = known.select(F.col("w").alias("w1"), "lang", F.col("word").alias("x1"), F.col("n").alias("l1"))
    middle = known.select(F.col("w").alias("w2"), F.col("word").alias("x2"))
    last = known.select(F.col("w").alias("w3"), F.col("word").alias("x3"), F.col("n").alias("r2"))
    found = (
        triples.join(ends.hint("merge"), ["w2", "w3"])
        .join(first.hint("merge"), "w1")
        .join(middle.hint("merge"), "w2")
        .join(last.hint("merge"), "w3")
        .select("*", _score("l1", "r1").alias("s1"), _score("pair", "r2").alias("s2"))
    )
    second = F.col("s2") < F.col("s1")
    return found.select(
        "lang",
        F.concat_ws(" ", "x1", "x2", "x3").alias("phrase"),
        "a",
        F.when(second, F.col("pair")).otherwise(F.col("l1")).alias("l"),
        F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )


def _score(left: str, right: str):
    """floor(1000000 a a / (l r)), exact while counts are below 10**15."""
    big = "decimal(15, 0)"
    return F.expr(
        f"(CAST(a AS {big}) * CAST(a AS {big}) * CAST(1000000 AS decimal(7, 0)))"
        f" div (CAST({left} AS {big}) * CAST({right} AS {big}))"
    ).alias("score")


# -- reading texts, an Arrow batch at a time ----------------------------------


def _language(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _read(batches: Iterator[pa.RecordBatch]):
    """(words, hashes, language, the languages' numbers) of some texts at a time."""
    for batch in batches:
        texts, langs = batch.column(1), batch.column(0).dictionary_encode()
        seeds = np.array([_language(x) for x in langs.dictionary.to_pylist()], np.uint64)
        numbers = langs.indices.to_numpy(zero_copy_only=False)
        names = langs.dictionary.to_pylist()
        for at, to in words.chunks(texts):
            split = words.split(texts.slice(at, to - at), True, _SOLID)
            if len(split.start):
                of_word = numbers[at:to][split.text_of_word()]
                hashed = words.mix(split.hashes() + seeds[of_word])
                hashed[hashed == 0] = 1  # zero stands for no word
                yield split, hashed, of_word, names


def _word_counts(batches):
    counts: dict[int, list] = {}
    totals: dict[str, int] = {}

    def rows():
        out = [(w, lang, word, n) for w, (lang, word, n) in counts.items()]
        out += [(0, lang, None, n) for lang, n in totals.items()]
        counts.clear(), totals.clear()
        for at in range(0, len(out), SENT):
            w, lang, word, n = zip(*out[at : at + SENT], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(w, np.uint64).view(np.int64)), pa.array(lang, pa.string()),
                 pa.array(word, pa.string()), pa.array(n, pa.int64())], ["w", "lang", "word", "n"],
            )

    for split, hashed, of_word, names in _read(batches):
        for k, n in enumerate(np.bincount(of_word, minlength=len(names)).tolist()):
            if n:
                totals[names[k]] = totals.get(names[k], 0) + n
        distinct, first, n = np.unique(hashed, return_index=True, return_counts=True)
        data = split.buf.tobytes()
        for w, at, count in zip(distinct.tolist(), first.tolist(), n.tolist(), strict=True):
            known = counts.get(w)
            if known:
                known[2] += count
            else:
                word = data[split.start[at] : split.end[at]].lower().decode("utf-8", "replace")
                counts[w] = [names[of_word[at]], word, count]
        if len(counts) > SENT:
            yield from rows()
    yield from rows()


def _triple_counts(batches):
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def rows():
        first, second, third = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        # leading bits of the three words: equal triples lie together, in prefix order
        order = np.argsort(
            (first >> np.uint64(40) << np.uint64(40)) | (second >> np.uint64(44) << np.uint64(20)) | third >> np.uint64(44)
        )
        first, second, third = first[order], second[order], third[order]
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (third[1:] != third[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(first)))
        columns = [x[at].view(np.int64) for x in (first, second, third)] + [count.astype(np.int64)]
        for k in range(0, len(at), SENT):
            yield pa.RecordBatch.from_arrays([pa.array(x[k : k + SENT]) for x in columns], ["w1", "w2", "w3", "c"])

    for split, hashed, _, _ in _read(batches):
        n = len(hashed)
        ends = np.concatenate([[0], np.cumsum(_ENDS[split.buf])])
        text = split.text_of_word()
        # the word after stands in the same piece
        near = np.zeros(n, bool)
        near[:-1] = (ends[split.end[:-1]] == ends[split.start[1:]]) & (text[1:] == text[:-1])
        second, third = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        second[:-1] = np.where(near[:-1], hashed[1:], 0)
        third[:-2] = np.where(near[:-2] & near[1:-1], hashed[2:], 0)
        held.append((hashed, second, third))
        size += n
        if size >= RUN:
            yield from rows()
            size = 0
    if held:
        yield from rows()
