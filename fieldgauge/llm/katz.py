"""Katz backoff scoring with an n-gram model learned from the corpus itself.

Good-Turing discounts apply to counts up to CUTOFF, for each order on its own. An n-gram
that was seen has its discounted count over its history's; one that was not has the
history's backoff weight times the probability after the history without its first word, and
so on down to the word alone. The weight is exactly what makes the probabilities after a
history sum to one. Unknown words share the words' reserved mass.

The work goes through Spark by packed arrays. A *block* is 750,000 tokens or so of one
task; a *bucket* is a share of all words or histories.

1. Each block sends its distinct words (64-bit hash, training count) to their buckets. The
   bucket sums them, stores its part of the word table, and answers with ids and counts.
2. For each order from 2: each block sends its distinct n-grams by history, which is the id
   of the n-1 words before. The bucket sums them, stores its part of the order's table with
   what the backoff weights need, and answers with the n-grams' counts and ids, which are
   the next order's histories.
3. Each block scores its texts from the answers: the recursion runs upwards, and at each
   order a token takes its seen n-gram, or the weight times what it had from the order below.

An answer has a number for each history instead of all that the weights need of it, and a
table of what the numbers mean, as most histories share it with others. Blocks and buckets
keep words and n-grams in order of id, so that ids are sent as small steps.

After each order its table goes, and the answers are stored with their block, a share of the
blocks at a time. So disk holds the blocks and all answers once, and either the n-grams of one
order on their way to the buckets or one share on its way to the blocks, never both.

A follower that was seen after a history was seen after the shorter one. So the mass that a
weight divides by is a sum of discounted counts of the order below, over the shorter
history's denominator: the buckets get counts, never probabilities, and the sum is exact.

A history with over 1 / HOT of all tokens is split over all buckets by the second word, and
its sums are added up: at most HOT such histories exist, so their list and sums are small.
A word or n-gram reaches a bucket once for each block, never once for each occurrence.

Texts are cut into blocks and hashed once, and the blocks stored. A block's name has its
place and a digest of its contents; an answer that finds no block fails the job. Words are told apart by 64-bit hashes, n-grams by the ids of history and word.

Defined cases: a null or empty text is the end token alone. Rows that repeat count each.
The first words of a text have a start mark before them and no longer history. A very long
text is one block. Without training texts N is 0; only the end and unknown words remain, all
by the reserved mass. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm import words as W
from fieldgauge.llm.frames import freed, stored

ORDER, CUTOFF = 3, 5
BLOCK_TOKENS = 750_000
#: Bytes of text for each bucket.
BUCKET_BYTES = 10_000_000
HOT = 512
#: Shares of the blocks, which meet their answers one after another: a share is in a shuffle
#: at a time, and goes from where it was stored when it is stored anew.
SHARES = 4
UNKNOWN, START = 0, 1
_END = np.uint64(0x5851F42D4C957F2D)
_PACKED = "kind string, bucket int, block string, a binary, b binary, c binary, d binary, e binary"


def put(x: np.ndarray) -> bytes:
    """An array by byte planes, compressed; signed numbers, none below 0, in the
    smallest type that fits. Unsigned ones are hashes and stay as they are. Fractions, most
    of which recur, are their distinct values and each one's number."""
    if x.dtype.kind == "f":
        values, _, number = _distinct(x)
        coded = zstandard.compress(values.tobytes(), 3)
        return b"dict" + len(coded).to_bytes(8, "little") + coded + put(number)
    if x.dtype.kind == "i" and (top := int(x.max(initial=0))) < 1 << 32:
        x = x.astype(np.min_scalar_type(top))
    # planes by shifts: a strided copy of bytes takes several times as long
    planes = b"".join((x >> x.dtype.type(8 * i)).astype(np.uint8).tobytes() for i in range(x.dtype.itemsize))
    return x.dtype.str.encode().ljust(4) + zstandard.compress(planes, 3)


def get(data: bytes) -> np.ndarray:
    if data[:4] == b"dict":
        end = 12 + int.from_bytes(data[4:12], "little")
        return np.frombuffer(zstandard.decompress(data[12:end]), np.float64)[get(data[end:])]
    kind = np.dtype(data[:4].decode().strip())
    planes = np.frombuffer(zstandard.decompress(data[4:]), np.uint8).reshape(kind.itemsize, -1)
    x = planes[0].astype(kind if kind.itemsize == 8 else np.int64)
    for i in range(1, kind.itemsize):
        x |= planes[i].astype(x.dtype) << x.dtype.type(8 * i)
    return x


def steps(x: np.ndarray) -> np.ndarray:
    """Whole numbers, mostly rising, as their differences; even ones are steps up."""
    d = np.diff(x, prepend=0)
    return (d << 1) ^ (d >> 63)


def walked(x: np.ndarray) -> np.ndarray:
    """The numbers of which these are the steps."""
    return np.cumsum((x >> 1) ^ -(x & 1))


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in _PACKED.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.string()] + [pa.binary()] * 5
    columns = list(zip(*[r + (None,) * (8 - len(r)) for r in rows], strict=True)) or [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def discounts(counts_of_counts: list[int], cutoff: int = CUTOFF) -> np.ndarray:
    """d[r] for r up to the cutoff, d[0] unused; 1 where the estimate is out of (0, 1)."""
    n = [0, *counts_of_counts]
    d = np.ones(cutoff + 1)
    if n[1] == 0:
        return d
    tail = (cutoff + 1) * n[cutoff + 1] / n[1]
    for r in range(1, cutoff + 1):
        if n[r] and tail < 1:
            found = ((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail)
            d[r] = found if 0 < found < 1 else 1.0
    return d


@dataclass(frozen=True)
class Unigrams:
    """The words' totals: N, V, discounts, and the mass reserved for unknown words."""

    total: int
    distinct: int
    discount: np.ndarray
    reserved: float
    scale: float

    @staticmethod
    def of(total: int, distinct: int, counts_of_counts: list[int], cutoff: int = CUTOFF) -> Unigrams:
        d = discounts(counts_of_counts, cutoff)
        lost = sum((1 - d[r]) * r * counts_of_counts[r - 1] for r in range(1, cutoff + 1))
        if not total:
            return Unigrams(0, 0, d, 1.0, 1.0)
        if lost > 0:
            return Unigrams(total, distinct, d, lost / total, 1.0)
        return Unigrams(total, distinct, d, 1 / (total + 1), total / (total + 1))

    def probability(self, count: np.ndarray) -> np.ndarray:
        known = discounted(count, self.discount) * (self.scale / max(1, self.total))
        return np.where(count > 0, known, self.reserved)


def discounted(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(count < len(d), d[np.minimum(count, len(d) - 1)], 1.0) * count


@dataclass
class Block:
    """Texts of a task: their distinct words in order of hash, and each token's place."""

    name: str
    ids: pa.Array
    held: np.ndarray
    sizes: np.ndarray  # tokens of each text, the end included
    hashes: np.ndarray
    local: np.ndarray

    @staticmethod
    def blocks(batches, most: int = BLOCK_TOKENS):
        """Cut batches of (id, text, held) into blocks."""
        ids, held, sizes, hashes, n = [], [], [], [], 0
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in W.chunks(batch.column(1)):
                w = W.split(batch.column(1).slice(a, b - a), lower=True)
                count = np.diff(w.bounds) + 1
                tokens = np.insert(w.hashes(), w.bounds[1:], _END)
                ids.append(batch.column(0).slice(a, b - a))
                held.append(batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False))
                sizes.append(count)
                hashes.append(tokens)
                n += len(tokens)
                if n >= most:
                    yield Block.of(f"{task}-{made}", ids, held, sizes, hashes)
                    made += 1
                    ids, held, sizes, hashes, n = [], [], [], [], 0
        if ids:
            yield Block.of(f"{task}-{made}", ids, held, sizes, hashes)

    @staticmethod
    def of(place: str, ids, held, sizes, hashes) -> Block:
        keys, tokens, n = pa.concat_arrays(ids), np.concatenate(hashes), np.concatenate(sizes)
        distinct, _, local = _distinct(tokens)
        named = hashlib.blake2b(tokens, digest_size=16)
        named.update(repr(keys.to_pylist()).encode())
        return Block(f"{place}-{named.hexdigest()}", keys, np.concatenate(held).astype(bool), n, distinct, local)

    def train(self) -> np.ndarray:
        """Whether each token's text is for training."""
        return np.repeat(~self.held, self.sizes)

    def row(self) -> tuple:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("id", self.ids.type)])) as out:
            out.write_batch(pa.RecordBatch.from_arrays([self.ids], names=["id"]))
        # tokens by how frequent their words are: most take a byte
        frequent = np.argsort(-np.bincount(self.local, minlength=len(self.hashes)), kind="stable")
        rank = np.empty_like(frequent)
        rank[frequent] = np.arange(len(frequent))
        texts = self.sizes.astype(np.int64) * 2 + self.held
        return ("text", 0, self.name, sink.getvalue().to_pybytes(), put(texts), put(frequent), put(rank[self.local]), put(self.hashes))

    @staticmethod
    def from_row(row: dict) -> Block:
        ids = pa.ipc.open_stream(row["a"]).read_all().column(0).combine_chunks()
        # without hashes once the words are answered: then answers are there, or nothing
        hashes = get(row["e"]) if row["kind"] == "text" and row["e"] else np.zeros(0, np.uint64)
        texts = get(row["b"])
        return Block(row["block"], ids, texts % 2 == 1, texts // 2, hashes, get(row["c"])[get(row["d"])])


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (W.mix(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _cuts(place: np.ndarray):
    """(place, start, end) of each run in sorted places."""
    edges = np.flatnonzero(np.diff(place)) + 1
    starts, ends = np.append(0, edges), np.append(edges, len(place))
    return [(int(place[s]), int(s), int(e)) for s, e in zip(starts, ends, strict=True) if e > s]


@dataclass
class Level:
    """What all blocks need of one order: its discounts, and the sums of split histories."""

    order: int
    hot: np.ndarray  # ids of the split histories, sorted
    below: np.ndarray  # the discounts of the order below
    discount: np.ndarray | None = None
    count: np.ndarray | None = None  # of the split histories, with START before the others
    mass: np.ndarray | None = None
    low: np.ndarray | None = None

    @property
    def split(self) -> np.ndarray:
        return np.append(START, self.hot) if self.order == 2 else self.hot


@dataclass
class Grams:
    """A block's distinct n-grams of known histories, in order of bucket and history."""

    place: np.ndarray  # bucket
    history: np.ndarray  # ids
    word: np.ndarray
    times: np.ndarray  # in the block's training texts
    lower: np.ndarray  # without the first word, in all training texts
    count: np.ndarray  # of the history, in all training texts; of a split one elsewhere
    size: np.ndarray  # the denominator of the history without its first word
    head: np.ndarray  # the number of the run of equal histories in a bucket
    of_token: np.ndarray  # which n-gram each token closes, or -1

    @staticmethod
    def of(block: Block, words: np.ndarray, below: Chain, level: Level, buckets: int) -> Grams:
        n, mark = len(words), len(below.ids)
        before = np.empty(len(block.local), np.int64)
        before[1:] = below.local[:-1]
        before[np.cumsum(block.sizes) - block.sizes] = mark  # a text's start
        before[before < 0] = mark + 1
        own = np.append(below.ids, [START if level.order == 2 else UNKNOWN, UNKNOWN])
        has = np.flatnonzero((own != UNKNOWN)[before])
        before, mine = before[has], below.local[has]
        # what was not seen after the shorter history was not seen after this one
        word = block.local[has] if level.order > 2 else mine
        word = np.where(np.append(below.counts > 0, False)[mine], word, n)
        pairs, first, inverse = _distinct(before * (n + 1) + word)
        times = np.bincount(inverse[block.train()[has]], minlength=len(pairs))
        head = pairs // (n + 1)
        history, word = own[head], np.append(words, UNKNOWN)[pairs - head * (n + 1)]
        place = _bucket(own, buckets)[head]
        split = np.flatnonzero(_among(own, level.split)[head])
        place[split] = _bucket(word[split] + 0x1000003 * history[split], buckets)
        # small numbers are sorted by radix; the runs of a history stay together
        order = np.argsort(place.astype(np.min_scalar_type(buckets)), kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        of_token = np.full(len(block.local), -1)
        of_token[has] = rank[inverse]
        place, history, first = place[order], history[order], first[order]
        new = np.append(True, (place[1:] != place[:-1]) | (history[1:] != history[:-1]))[: len(place)]
        count = np.append(below.counts, [0, 0])[head]
        return Grams(
            place, history, word[order], times[order], np.append(below.counts, 0)[mine[first]], count[order],
            below.size[has[first]], np.cumsum(new) - 1, of_token,
        )


@dataclass
class Chain:
    """What a block knows of its tokens by the answers of the orders up to one."""

    local: np.ndarray  # the n-gram that ends at each token, or -1
    ids: np.ndarray  # of each n-gram, UNKNOWN without training text
    counts: np.ndarray  # of each n-gram in all training texts
    size: np.ndarray  # the denominator of each token's history
    chance: np.ndarray  # each token's probability
    backed: np.ndarray  # whether it is the word's own, weighted

    @staticmethod
    def words(block: Block, ids: np.ndarray, counts: np.ndarray, unigrams: Unigrams) -> Chain:
        n = len(block.local)
        size = np.full(n, max(1, unigrams.total) / unigrams.scale)
        return Chain(block.local, ids, counts, size, unigrams.probability(counts)[block.local], np.ones(n, bool))

    def after(self, grams: Grams, replies: list[dict], level: Level, buckets: int) -> Chain:
        """The next order, by the answers to its n-grams."""
        replies = sorted(replies, key=lambda r: r["bucket"])
        d, cutoff = level.discount, len(level.discount) - 1
        times = [get(r["a"]) for r in replies]
        seen = np.concatenate(times or [np.zeros(0, np.int64)])
        if len(seen) != len(grams.word):
            raise ValueError("the answers don't fit the block: the scan has changed")
        ids = np.full(len(seen), UNKNOWN)
        if any(r["b"] for r in replies):  # the last order's have none
            ranks, known = np.concatenate([walked(get(r["b"])) for r in replies]), seen > 0
            ids[known] = START + (ranks - 1) * buckets + 1 + grams.place[known]
        kinds = [(get(r["c"]), get(r["d"]).reshape(2 * cutoff + 1, -1)) for r in replies]
        mass, lost = (
            np.concatenate([np.zeros(0), *(of(kind)[number] for number, kind in kinds)])
            for of in (lambda x: _mass(x[: cutoff + 1], level.below), lambda x: _lost(x[cutoff + 1 :], d))
        )
        at = np.flatnonzero(np.append(True, grams.head[1:] != grams.head[:-1])[: len(grams.head)])
        heads, count = grams.history[at], grams.count[at]
        if len(level.split) and len(heads):
            where = np.minimum(np.searchsorted(level.split, heads), len(level.split) - 1)
            here = level.split[where] == heads
            where = where[here]
            count[here], mass[here], lost[here] = level.count[where], level.mass[where], _lost(level.low, d)[where]
        size, weight = _weights(count, mass / grams.size[at], lost)
        # by n-gram first, as tokens repeat them: what those that were seen get, and the weights
        own = discounted(seen, d) / np.maximum(size, 1)[grams.head]
        has = np.flatnonzero(grams.of_token >= 0)
        mine = grams.of_token[has]
        head, found = grams.head[mine], (seen > 0)[mine]
        chance, sizes, backed = self.chance.copy(), np.ones(len(self.chance)), self.backed.copy()
        chance[has] = np.where(found, own[mine], weight[head] * chance[has])
        sizes[has] = size[head]
        backed[has[found]] = False
        return Chain(grams.of_token, ids, seen, sizes, chance, backed)


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values in order, a place of each, and each value's number. Unlike
    ``np.unique`` it needs no stable sort: any place will do."""
    order = np.argsort(x)
    ordered = x[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(x)]
    inverse = np.empty_like(order)
    inverse[order] = np.cumsum(new) - 1
    return ordered[new], order[new], inverse


def _among(x: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which values are in a short sorted array."""
    if not len(few):
        return np.zeros(len(x), bool)
    return few[np.minimum(np.searchsorted(few, x), len(few) - 1)] == x


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the runs of equal neighbours, and where each begins."""
    first = np.append(True, x[1:] != x[:-1]) if len(x) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    return x[at], at


def _sum_words(buckets: int, cutoff: int):
    """A bucket of words: its part of the table, its totals, an answer to each block."""

    def work(key, table):
        bucket = key[0].as_py()
        rows = table.sort_by("block").to_pylist()
        hashes = [get(r["a"]) for r in rows]
        distinct, _, inverse = _distinct(np.concatenate(hashes))
        counts = np.bincount(inverse, weights=np.concatenate([get(r["b"]) for r in rows])).astype(np.int64)
        known = counts > 0
        # frequent words get small ids, which take fewer bytes wherever they go
        ids = np.full(len(counts), UNKNOWN)
        ids[np.argsort(-counts, kind="stable")[: known.sum()]] = START + 1 + np.arange(known.sum()) * buckets + bucket
        of = np.bincount(np.minimum(counts, cutoff + 2), minlength=cutoff + 3)[1 : cutoff + 2]
        hot = np.array([counts.sum(), known.sum(), *of], np.int64)
        out = [("word", bucket, "", put(distinct[known]), put(ids[known]), put(counts[known])), ("total", bucket, "", put(hot))]
        at = 0
        for r, own in zip(rows, hashes, strict=True):
            mine = inverse[at : at + len(own)]
            at += len(own)
            out.append(("answer1", bucket, r["block"], put(ids[mine]), put(counts[mine])))
        return pa.Table.from_batches([_packed(out)])

    return work


def _pairs(history: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (history, word) in order: where each is first, and each one's number."""
    if len(history) and max(history.max(), word.max()) >= 1 << 32:
        order = np.lexsort((word, history))
        h, w = history[order], word[order]
        new = np.append(True, (h[1:] != h[:-1]) | (w[1:] != w[:-1]))
        inverse = np.empty_like(order)
        inverse[order] = np.cumsum(new) - 1
        return order[new], inverse
    _, first, inverse = _distinct(history.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64))
    return first, inverse


def _mass(lower: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The discounted counts of histories' followers in the order below, from how many of them
    have each low count, and the sum of the other counts. Small whole numbers take less room
    than fractions."""
    return (d[1:] * np.arange(1, len(d))) @ lower[:-1] + lower[-1]


def _sum_grams(level: Level, cutoff: int, buckets: int, last: bool):
    """A bucket of histories: its part of the table, its totals, an answer to each block.

    The n-gram of rank r in the table has the id START + 1 + r * buckets + bucket."""

    def work(key, table):
        bucket = key[0].as_py()
        rows = table.sort_by("block").to_pylist()
        heads = [get(r["a"]) for r in rows]
        sizes = [get(r["b"]) for r in rows]
        history = np.concatenate([np.repeat(walked(h), n) for h, n in zip(heads, sizes, strict=True)])
        word = np.concatenate([get(r["c"]) for r in rows])
        first, inverse = _pairs(history, word)
        times = np.bincount(inverse, weights=np.concatenate([get(r["d"]) for r in rows])).astype(np.int64)
        lower = np.concatenate([get(r["e"]) for r in rows])[first]
        h, w = history[first], word[first]
        heads_all, begin = _runs(h)
        head = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(h))))
        seen = times > 0
        rest = np.bincount(head, weights=np.where(seen & (lower > cutoff), lower, 0)).astype(np.int64)
        mass = np.vstack([_how_many(head, np.where(seen, lower, 0), cutoff), rest])
        low = _how_many(head, times, cutoff)
        number, kinds = _kinds(np.vstack([mass, low]))
        of = np.bincount(np.minimum(times, cutoff + 2), minlength=cutoff + 3)[1 : cutoff + 2]
        followers = np.add.reduceat(seen.astype(np.int64), begin)
        out = [("total", bucket, "", put(of))]
        if not last or level.order == 2:  # the next order's histories, and the number of texts
            out.append((f"gram{level.order}", bucket, "", put(heads_all), put(followers), put(w[seen]), put(times[seen])))
        here = _among(heads_all, level.split)
        if here.any():
            out.append(("split", bucket, "", put(heads_all[here]), put(mass[:, here].ravel()), put(low[:, here].ravel())))
        ranks = np.where(seen, np.cumsum(seen), 0)
        at = 0
        for r, n in zip(rows, sizes, strict=True):
            mine = inverse[at : at + int(n.sum())]
            at += len(mine)
            known = None if last else put(steps(ranks[mine[seen[mine]]]))
            own = number[head[mine[np.cumsum(n) - n]]]
            used = np.bincount(own, minlength=kinds.shape[1]) > 0
            answer = put(times[mine]), known, put((np.cumsum(used) - 1)[own]), put(kinds[:, used].ravel())
            out.append((f"answer{level.order}", bucket, r["block"], *answer))
        return pa.Table.from_batches([_packed(out)])

    return work


def _how_many(head: np.ndarray, counts: np.ndarray, cutoff: int) -> np.ndarray:
    """How many of each head's counts are 1, 2 and so on up to the cutoff: a row for each."""
    heads, few = int(head[-1]) + 1, np.flatnonzero((counts > 0) & (counts <= cutoff))
    return np.bincount((counts[few] - 1) * heads + head[few], minlength=cutoff * heads).reshape(cutoff, heads)


def _kinds(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each column's number, and the distinct columns by it, frequent ones first: few
    histories differ in all they have, so a number takes much less room."""
    factor = W.mix(np.arange(1, len(columns) + 1).astype(np.uint64))
    hashes = np.zeros(columns.shape[1], np.uint64)
    for row, by in zip(columns, factor, strict=True):
        hashes += row.astype(np.uint64) * by
    _, first, number = _distinct(hashes)
    kinds = columns[:, first]
    if not all(np.array_equal(kind[number], row) for kind, row in zip(kinds, columns, strict=True)):
        kinds, number = np.unique(columns, axis=1, return_inverse=True)  # two had one hash
    frequent = np.lexsort((*kinds, -np.bincount(number)))
    rank = np.empty_like(frequent)
    rank[frequent] = np.arange(len(frequent))
    return rank[number], kinds[:, frequent]


def _lost(low: np.ndarray, d: np.ndarray) -> np.ndarray:
    """What discounts take from histories, by how many followers have each low count."""
    return ((1 - d[1:]) * np.arange(1, len(d))) @ low


def _weights(count: np.ndarray, mass: np.ndarray, lost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each history's denominator and backoff weight, from its count, the mass that its
    followers have by the order below, and what the discounts take."""
    none = lost <= 0  # nothing was discounted: make room for one more event
    size = count + none
    weight = np.where(none, 1.0, lost) / np.maximum(size, 1) / np.maximum(1 - mass, 1e-300)
    return size, np.where(count > 0, weight, 1.0)


def _total(table: DataFrame, n: int) -> list[int]:
    """The sum of the buckets' totals."""

    def run(batches):
        sums = np.zeros(n, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                sums += get(data)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(sums)], names=["k", "n"])

    parts = table.where("kind = 'total'").select("a").mapInArrow(run, "k long, n long")
    found = {r.k: r.n for r in parts.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    return [int(found.get(k, 0)) for k in range(n)]


def score(
    docs: DataFrame,
    held_out: Column,
    id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    cutoff: int = CUTOFF,
    block_tokens: int = BLOCK_TOKENS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """A model of n-grams of up to ``order`` words. Learn from the rows for which ``held_out`` is false and score all rows: the id,
    held_out (boolean), n_tokens, n_known, train_tokens (long), base_score, score, and
    backoffs: how many tokens fell back to the word's own probability (long)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, math.ceil(size / bucket_bytes))
    id_kind = docs.schema[id].dataType.simpleString()

    def texts(batches):
        for block in Block.blocks(batches, block_tokens):
            yield _packed([block.row()])

    def ask_words(batches):
        for row in (row for batch in batches for i in range(len(batch)) for row in batch.slice(i, 1).to_pylist()):
            block = Block.from_row(row)
            times = np.bincount(block.local, weights=block.train(), minlength=len(block.hashes)).astype(np.int64)
            place = (block.hashes >> np.uint64(40)).astype(np.int64) * buckets >> 24  # by range
            yield _packed([("ask", p, block.name, put(block.hashes[s:e]), put(times[s:e])) for p, s, e in _cuts(place)])

    scanned = stored(spark, rows.mapInArrow(texts, _PACKED), "katz-blocks")
    asked = scanned.mapInArrow(ask_words, _PACKED)
    word_table = _table(asked.groupBy("bucket").applyInArrow(_sum_words(buckets, cutoff), _PACKED), "katz-words")
    total, distinct, *of = _total(word_table, cutoff + 3)
    unigrams = Unigrams.of(total, distinct, of, cutoff)
    bare = scanned.withColumn("e", F.lit(None).cast("binary"))  # hashes are for the words alone
    blocks = [bare.where(_share() == share) for share in range(SHARES)]

    def ask(level: Level, levels: list[Level]):
        def work(batches):
            for row in (row for batch in batches for i in range(len(batch)) for row in batch.slice(i, 1).to_pylist()):
                block, ids, _, below = _replayed(row, _kept(row), unigrams, levels, buckets)
                grams = Grams.of(block, ids, below, level, buckets)
                out = []
                for p, s, e in _cuts(grams.place):
                    heads, at = _runs(grams.history[s:e])
                    sizes = np.diff(np.append(at, e - s))
                    out.append(("ask", p, block.name, put(steps(heads)), put(sizes), put(grams.word[s:e]), put(grams.times[s:e]), put(grams.lower[s:e])))
                yield _packed(out)

        return work

    levels: list[Level] = []
    table, below = word_table, unigrams.discount
    for k in range(2, order + 1):
        hot = _hot(table, k - 1, total, buckets)
        level = Level(k, np.array(sorted(hot), np.int64), below)
        freed(spark, table, only=f"share={SHARES}")
        blocks = _by_block(blocks, table, _with_answers, _PACKED, f"katz-{k - 1}-blocks", k > 2)
        if k == 2:
            freed(spark, scanned)
        asked = _union(blocks).mapInArrow(ask(level, list(levels)), _PACKED)
        summed = asked.groupBy("bucket").applyInArrow(_sum_grams(level, cutoff, buckets, k == order), _PACKED)
        table = _table(summed, f"katz-{k}-grams")
        level.discount = below = discounts(_total(table, cutoff + 1), cutoff)
        _add_split(table, level, hot, cutoff)
        levels.append(level)

    def finish(key, left, right):
        row = _row(left)
        block, _, counts, chain = _replayed(row, _kept(row) + right.to_pylist(), unigrams, levels, buckets)
        token, fell = np.log10(chain.chance), chain.backed
        base = np.log10((counts + 0.5) / (unigrams.total + 0.5 * (unigrams.distinct + 1)))[block.local]
        starts = np.cumsum(block.sizes) - block.sizes
        n = len(starts)
        columns = [
            block.ids,
            pa.array(block.held),
            pa.array(block.sizes.astype(np.int64)),
            pa.array(np.add.reduceat((counts > 0)[block.local].astype(np.int64), starts)),
            pa.array(np.full(n, unigrams.total, np.int64)),
            pa.array(np.add.reduceat(base, starts)),
            pa.array(np.add.reduceat(token, starts)),
            pa.array(np.add.reduceat(fell.astype(np.int64), starts)),
        ]
        return pa.Table.from_arrays(columns, names=[f.split()[0] for f in fields])

    fields = ["id " + id_kind, "held_out boolean", "n_tokens long", "n_known long", "train_tokens long", "base_score double", "score double", "backoffs long"]
    freed(spark, table, only=f"share={SHARES}")
    found = _by_block(blocks, table, finish, ", ".join(fields), "katz-scores", order > 1)
    if order < 2:
        freed(spark, scanned)
    return _union(found).withColumnRenamed("id", id)


def _share() -> Column:
    return F.pmod(F.xxhash64("block"), F.lit(SHARES)).cast("int")


def _table(rows: DataFrame, name: str) -> DataFrame:
    """A table stored by share: the answers by that of their block, the rest beside them."""
    share = F.when(F.col("kind").startswith("answer"), _share()).otherwise(F.lit(SHARES))
    return stored(rows.sparkSession, rows.withColumn("share", share), name, ("share",))


def _by_block(blocks: list[DataFrame], table: DataFrame, work, schema: str, name: str, free: bool) -> list[DataFrame]:
    """``work`` over each block with its answers, stored by share; a share's answers go then,
    and its blocks if they are not in one folder with others."""
    made = []
    for share, mine in enumerate(blocks):
        answers = table.where(F.col("share") == share).drop("share")
        pairs = mine.groupBy("block").cogroup(answers.groupBy("block"))
        made.append(stored(mine.sparkSession, pairs.applyInArrow(work, schema), name))
        freed(mine.sparkSession, table, only=f"share={share}")
        if free:
            freed(mine.sparkSession, mine)
    return made


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _row(left: pa.Table) -> dict:
    """The block of some answers. One that repeats is the same: the scan is stored."""
    rows = left.to_pylist()
    if len({r["block"] for r in rows}) != 1:
        raise ValueError("an answer without its block: the scan has changed")
    return rows[0]


def _with_answers(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's row with one order's answers, after those that it has."""
    row = _row(left)
    sink = pa.BufferOutputStream()
    answers = _packed([tuple(r.values()) for r in _kept(row) + right.to_pylist()])
    with pa.ipc.new_stream(sink, answers.schema) as out:
        out.write_batch(answers)
    return pa.Table.from_batches([_packed([("answered", 0, row["block"], row["a"], row["b"], row["c"], row["d"], sink.getvalue().to_pybytes())])])


def _kept(row: dict) -> list[dict]:
    """The answers in a block's row."""
    return pa.ipc.open_stream(row["e"]).read_all().to_pylist() if row["e"] else []


def _replayed(row: dict, answers: list[dict], unigrams: Unigrams, levels: list[Level], buckets: int):
    """A block, the ids and counts of its words in order of hash, and what the answers of
    all levels say of its tokens."""
    if not answers:
        raise ValueError("an answer without its block: the scan has changed")
    by_order: dict[str, list[dict]] = {}
    for r in answers:
        by_order.setdefault(r["kind"], []).append(r)
    block = Block.from_row(row)
    words = sorted(by_order["answer1"], key=lambda r: r["bucket"])
    ids = np.concatenate([get(r["a"]) for r in words])
    counts = np.concatenate([get(r["b"]) for r in words])
    # from here on words are in order of id, as in the buckets: ids and ranks rise
    order = np.argsort(ids)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    block.local, ids, counts = rank[block.local], ids[order], counts[order]
    chain = Chain.words(block, ids, counts, unigrams)
    for level in levels:
        grams = Grams.of(block, ids, chain, level, buckets)
        chain = chain.after(grams, by_order.get(f"answer{level.order}", []), level, buckets)
    return block, ids, counts, chain


def _hot(table: DataFrame, order: int, total: int, buckets: int) -> dict[int, int]:
    """Ids and counts of the words or n-grams with over 1 / HOT of all tokens."""
    kind, times = ("word", "c") if order == 1 else (f"gram{order}", "d")
    words = order == 1  # their ids are in the table, those of n-grams follow from the place

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts = get(row[times])
                big = np.flatnonzero(counts * HOT > total)
                ids = get(row["b"])[big] if words else START + 1 + big * buckets + row["bucket"]
                yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(counts[big].astype(np.int64))], names=["id", "n"])

    found = table.where(F.col("kind") == kind).select("bucket", "b", times).mapInArrow(run, "id long, n long")
    return {r.id: r.n for r in found.collect()}


def _add_split(table: DataFrame, level: Level, hot: dict[int, int], cutoff: int) -> None:
    """Counts, mass and low counts of the histories whose n-grams lie in many buckets."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                columns = [pa.array(get(row["a"]).astype(np.int64))]
                for kind, rows in (("b", cutoff + 1), ("c", cutoff)):
                    columns += [pa.array(x) for x in get(row[kind]).reshape(rows, -1).astype(np.int64)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", *[f"m{r}" for r in range(1, cutoff + 2)], *[f"r{r}" for r in range(1, cutoff + 1)]]
    parts = table.where("kind = 'split'").select("a", "b", "c").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    sums = {r.id: r for r in parts.groupBy("id").agg(*[F.sum(c).alias(c) for c in names[1:]]).collect()}
    counts = {**hot, START: _started(table)} if level.order == 2 else hot
    split = [int(h) for h in level.split]
    level.count = np.array([counts[h] for h in split], np.int64)
    found = np.array([[sums[h][1 + r] if h in sums else 0 for h in split] for r in range(2 * cutoff + 1)], np.int64).reshape(2 * cutoff + 1, -1)
    level.mass, level.low = _mass(found[: cutoff + 1], level.below), found[cutoff + 1 :]


def _started(table: DataFrame) -> int:
    """How often START is a history: the number of training texts."""

    def run(batches):
        n = 0
        for batch in batches:
            for row in batch.to_pylist():
                history = np.repeat(get(row["a"]), get(row["b"]))
                n += int(get(row["d"])[history == START].sum())
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    parts = table.where("kind = 'gram2'").select("a", "b", "d").mapInArrow(run, "n long")
    return int(parts.agg(F.sum("n")).first()[0] or 0)
