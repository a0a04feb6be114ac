"""Quality rules as a short-circuit cascade.

Each rule's cost and rejection rate are measured on a bounded sample. Rules then run by
rejection per cost, and each sees only the texts that all rules before it let through. A
text is kept if no rule rejects it, so the order changes the work and never the verdict.

Null or empty text: no words, rejected. Rows that repeat get the same verdict each.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm import words as W

#: Texts on which costs and rejection rates are measured. More change only the order.
SAMPLE = 2000
#: The least count of words, and the largest share, in per cent, of words in repeated windows.
LEAST_WORDS, REPEATED_PERCENT, WINDOW = 10, 20, 5
#: A header that returns as a footer is no junk: fewer equal lines are let through.
LEAST_REPEATS = 3
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True  # fixed value


class Texts:
    """Features of a batch of texts; a feature takes the texts it is wanted for."""

    def __init__(self, texts: pa.Array):
        self.words = W.split(texts)
        self.hashes = self.words.hashes()

    def base(self) -> dict[str, np.ndarray]:
        w, n = self.words, len(self.words)
        solid = W.SOLID[w.buf]
        n_words = np.diff(w.bounds)
        grams, at = W.shingles(self.hashes, w.bounds, WINDOW)
        owner = w.text_of_word()
        key = W.mix(grams + owner[at].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        cover = np.zeros(len(owner) + 1, np.int64)
        again = at[repeated(key)]
        np.add.at(cover, again, 1)
        np.add.at(cover, np.minimum(again + WINDOW, len(owner)), -1)
        covered = np.cumsum(cover[:-1]) > 0
        return {
            "n_words": n_words,
            "word_chars": w.total(solid & ((w.buf & 0xC0) != 0x80)),
            "n_symbols": w.total(_SYMBOLS[w.buf]),
            "n_dup_lines": self._dup_lines(solid),
            "n_repeat_words": np.bincount(owner[covered], minlength=n).astype(np.int64),
        }

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, start and end of each line between line feeds."""
        w, n = self.words, len(self.words)
        feeds = np.flatnonzero(w.buf == 10)
        text = np.searchsorted(w.offsets, feeds, "right") - 1
        owner = np.concatenate([np.arange(n), text])
        start = np.concatenate([w.offsets[:-1], feeds + 1])
        order = np.lexsort((start, owner))
        owner, start = owner[order], start[order]
        end = np.empty_like(start)
        end[:-1] = start[1:] - 1
        last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
        end[last] = w.offsets[1:][owner[last]]
        return owner, start, end

    def _dup_lines(self, solid: np.ndarray) -> np.ndarray:
        owner, start, end = self.lines()
        some = np.concatenate([[0], np.cumsum(solid)])
        has_word = some[end] > some[start]
        owner, start, end = owner[has_word], start[has_word], end[has_word]
        key = W.mix(self.words.spans(start, end) + owner.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        _, first = np.unique(key, return_index=True)
        n = len(self.words)
        return np.bincount(owner, minlength=n) - np.bincount(owner[first], minlength=n)

    def per_text(self, of_word: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """The sum over the words of each wanted text."""
        sums = np.concatenate([[0], np.cumsum(of_word, dtype=np.int64)])
        bounds = self.words.bounds
        return sums[bounds[texts + 1]] - sums[bounds[texts]]

    def _wanted(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of the wanted texts, and where each text's words begin among them."""
        bounds = self.words.bounds
        sizes = bounds[texts + 1] - bounds[texts]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(starts[-1]) - np.repeat(starts[:-1] - bounds[texts], sizes)
        return at, starts

    def stutters(self, texts: np.ndarray) -> np.ndarray:
        """How many words of each wanted text equal the word before."""
        same = np.zeros(len(self.hashes), bool)
        same[1:] = self.hashes[1:] == self.hashes[:-1]
        first = self.words.bounds[:-1]
        same[first[first < len(same)]] = False
        return self.per_text(same, texts)

    def count_words(self, test: Callable, texts: np.ndarray) -> np.ndarray:
        """How many words of each wanted text pass ``test(buf, start, end)``."""
        at, starts = self._wanted(texts)
        hit = test(self.words.buf, self.words.start[at], self.words.end[at])
        sums = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
        return sums[starts[1:]] - sums[starts[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    both = np.zeros(len(keys), bool)
    both[1:] |= same
    both[:-1] |= same
    found = np.zeros(len(keys), bool)
    found[order] = both
    return found


def _share(table: np.ndarray):
    sums_of = table.astype(np.int64)

    def count(buf, start, end):
        sums = np.concatenate([[0], np.cumsum(sums_of[buf])])
        return sums[end] - sums[start]

    return count


_letters, _upper = np.zeros(256, bool), np.zeros(256, bool)
_letters[ord("a") : ord("z") + 1] = _letters[ord("A") : ord("Z") + 1] = _letters[128:] = True
_upper[ord("A") : ord("Z") + 1] = True
_ascii_letters = _letters.copy()
_ascii_letters[128:] = False
_in_letters, _in_upper, _in_ascii = _share(_letters), _share(_upper), _share(_ascii_letters)


def _no_letter(buf, start, end):
    return _in_letters(buf, start, end) == 0


def _shouted(buf, start, end):
    """At least two ASCII letters and none of them small."""
    upper = _in_upper(buf, start, end)
    return (upper >= 2) & (upper == _in_ascii(buf, start, end))


def _doubled_end(buf, start, end):
    """Ends in two equal marks of emphasis or markup."""
    long = end - start >= 2
    last = buf[end - 1]
    marks = np.isin(last, np.frombuffer(b"!#$%&*?", np.uint8))
    return long & marks & (buf[np.maximum(end - 2, 0)] == last)


@dataclass(frozen=True)
class Rule:
    """``rejects(texts, base, at)``: which of the texts at the places ``at`` it rejects."""

    name: str
    rejects: Callable[[Texts, dict, np.ndarray], np.ndarray]


def _over(count: np.ndarray, of: np.ndarray, percent: int) -> np.ndarray:
    return 100 * count > percent * of


#: Shares are in per cent of the words, or of the lines.
RULES = (
    Rule("symbols", lambda t, b, at: _over(b["n_symbols"][at], b["n_words"][at], 20)),
    Rule(
        "word_length",
        lambda t, b, at: (b["word_chars"][at] < 2 * b["n_words"][at])
        | (b["word_chars"][at] > 20 * b["n_words"][at]),
    ),
    Rule(
        "repeated_lines",
        lambda t, b, at: (b["n_dup_lines"][at] >= LEAST_REPEATS)
        & _over(b["n_dup_lines"][at], 1 + t.words.total(t.words.buf == 10)[at], 30),
    ),
    Rule("no_letters", lambda t, b, at: _over(t.count_words(_no_letter, at), b["n_words"][at], 40)),
    Rule("shouting", lambda t, b, at: _over(t.count_words(_shouted, at), b["n_words"][at], 30)),
    Rule("emphasis", lambda t, b, at: _over(t.count_words(_doubled_end, at), b["n_words"][at], 20)),
    Rule("stutter", lambda t, b, at: _over(t.stutters(at), b["n_words"][at], 30)),
)


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    few = base["n_words"] < LEAST_WORDS
    return few | _over(base["n_repeat_words"], base["n_words"], REPEATED_PERCENT)


def order(docs: DataFrame, text: str = "text", rules=RULES, sample: int = SAMPLE) -> list[str]:
    """Names of the rules by rejection per cost, measured on up to ``sample`` texts.

    The sample only orders the rules. One task reads it and returns a row per rule.
    """

    def measure(batches):
        took = np.zeros(len(rules))
        hits = np.zeros(len(rules))
        seen = 0
        for batch in batches:
            column = batch.column(0)
            for a, b in W.chunks(column):
                texts = Texts(column.slice(a, b - a))
                base = texts.base()
                at = np.flatnonzero(~base_failed(base))
                seen += len(at)
                for k, rule in enumerate(rules):
                    began = time.perf_counter()
                    hits[k] += rule.rejects(texts, base, at).sum()
                    took[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict(
            {"name": [r.name for r in rules], "gain": (hits + 0.5) / (seen + 1) / (took + 1e-9)}
        )

    found = docs.select(text).limit(sample).coalesce(1).mapInArrow(measure, "name string, gain double")
    gain = {r.name: r.gain for r in found.groupBy("name").agg(F.sum("gain").alias("gain")).collect()}
    return sorted((r.name for r in rules), key=lambda n: (-gain.get(n, 0), n))


def apply(docs: DataFrame, text: str = "text", rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """All columns of ``docs`` and: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long), base_failed, kept (boolean), rejected_by (string; ``base``, or
    the first rule of the order that rejects). Columns of ``docs`` with these names go.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    added = [*made, "base_failed", "kept", "rejected_by"]
    by_name = {r.name: r for r in rules}
    ranked = [by_name[n] for n in order(docs, text, rules, sample)]
    kept_columns = [c for c in docs.columns if c not in added or c == text]
    place = kept_columns.index(text)

    def run(batches):
        for batch in batches:
            column = batch.column(place)
            for a, b in W.chunks(column):
                texts = Texts(column.slice(a, b - a))
                base = texts.base()
                failed = base_failed(base)
                reason = np.where(failed, "base", None).astype(object)
                alive = np.flatnonzero(~failed)
                for rule in ranked:
                    if not len(alive):
                        break
                    hit = rule.rejects(texts, base, alive)
                    reason[alive[hit]] = rule.name
                    alive = alive[~hit]
                kept = np.zeros(len(texts.words), bool)
                kept[alive] = True
                new = [pa.array(base[c].astype(np.int64)) for c in made]
                new += [pa.array(failed), pa.array(kept), pa.array(reason, pa.string())]
                piece = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, *new], names=[*piece.schema.names, *added]
                )

    old = docs.select(*[F.col(f"`{c}`") for c in kept_columns])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in old.schema]
    fields += [f"{c} bigint" for c in made] + ["base_failed boolean", "kept boolean", "rejected_by string"]
    return old.mapInArrow(run, ", ".join(fields))
