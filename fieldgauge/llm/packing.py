"""Packing tokenized documents into sequences by minimum bin slack.

A document's ids, and one end id, are cut into full sequences and a remainder. Remainders
collect in a window of bounded size in each task. For each bin the longest remainder left
is taken, and a subset-sum over a bitset (bit k: some multiset of the lengths left sums to
k) finds the multiset of other lengths that fills the bin best; it is read back from the
bitsets and used as often as the counts allow. Nothing is shuffled and nothing is dropped.

Tokenizing is by the given tokenizer, on units of blanks plus the word behind them. Its
pattern never joins a word to what follows, so a unit's ids do not depend on its
neighbours; a unit seen before by the worker is looked up. Texts with other white space
than ASCII blanks, or with a special token's name, are encoded whole.

Defined cases: a null or empty text is the end id alone. Rows that repeat are packed each.
An empty table gives no piece.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE, END_ID = 1024, 0
#: Remainders that wait in a task, and units that a worker remembers from task to task.
WINDOW, REMEMBERED = 16384, 1_000_000
#: Bytes of text that are encoded together.
TEXT_BYTES = 4 << 20
#: Units a task checks against the tokenizer itself.
CHECKED_UNITS = 2000

_UNIT = re.compile(r"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+")
#: A space that is followed by a blank or by nothing.
_RUN = re.compile(r" (?:[ \t\n\x0b\x0c\r]|$)")
#: White space of Unicode besides the ASCII blanks: fixed values.
_OTHER_SPACE = re.compile("[\x85\xa0  -     　]")


class Encoder:
    """Ids as little-endian 32-bit bytes, by the tokenizer in a file.

    If the file is a plain byte-level BPE whose merges stand in the order of their ids,
    units are encoded by the same ranks in the quicker of the two libraries; the first
    units of every task are checked against the file's own tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.quick = _ranked(path)
        self.unproven = CHECKED_UNITS
        self.units = _Known(self._unit)
        #: Words behind one space, without the space.
        self.spaced = _Known(lambda word: self._unit(" " + word))

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _unit(self, unit: str) -> bytes:
        if self.quick is None:
            return self._ids([unit])[0]
        found = array("I", self.quick.encode_ordinary(unit)).tobytes()
        if self.unproven > 0:
            self.unproven -= 1
            if self._ids([unit])[0] != found:
                raise ValueError("the ranks don't give the tokenizer's ids")
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        for known in (self.units, self.spaced):
            if len(known) > REMEMBERED:
                known.clear()
        return [self._text(t) for t in texts]

    def _text(self, text: str) -> bytes:
        if _OTHER_SPACE.search(text) or any(s in text for s in self.special):
            return self._ids([text])[0]
        if _RUN.search(text):
            return b"".join(map(self.units.__getitem__, _UNIT.findall(text)))
        # each space stands alone before a word: cut there
        first, *rest = text.split(" ")
        return (self.units[first] if first else b"") + b"".join(map(self.spaced.__getitem__, rest))


class _Known(dict):
    """Remembers what a function gave."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        found = self[key] = self.make(key)
        return found


@cache
def _encoder(path: str) -> Encoder:
    """One encoder for a worker's life: its tasks share what it remembers."""
    return Encoder(path)


def _ranked(path: str):
    """The tokenizer of a file by ranks, or None if the file isn't of that plain kind."""
    import public_tokenizers
    import tiktoken
    from tokenizers.pre_tokenizers import ByteLevel

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and not spec.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    )
    if not plain:
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    pairs = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if [vocab[p] for p in pairs] != sorted(vocab.values())[len(vocab) - len(pairs) :]:
        return None
    printable = [c for r in ((33, 127), (161, 173), (174, 256)) for c in range(*r)]
    rest = [c for c in range(256) if c not in set(printable)]
    byte_of = {chr(c): c for c in printable} | {chr(256 + k): c for k, c in enumerate(rest)}
    assert set(byte_of) == set(ByteLevel.alphabet())
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def best_fill(counts: np.ndarray, lengths: list[int], room: int) -> list[tuple[int, int]]:
    """(length, times): the multiset of ``lengths``, each at most ``counts`` times, that
    sums to the most that is at most ``room``; longer lengths are tried first."""
    if room <= 0:
        return []
    mask = (1 << (room + 1)) - 1
    reach = [1]
    used = []
    for length in lengths:
        if length > room:
            continue
        sums = reach[-1]
        left, step = min(int(counts[length]), room // length), 1
        while left > 0:  # take 1, 2, 4, ... copies: all counts up to the bound
            take = min(step, left)
            sums |= (sums << (take * length)) & mask
            left -= take
            step *= 2
        used.append(length)
        reach.append(sums)
        if sums >> room & 1:
            break
    at = reach[-1].bit_length() - 1
    chosen = []
    for k in range(len(used) - 1, -1, -1):
        times = 0
        while not reach[k] >> at & 1:
            at -= used[k]
            times += 1
        if times:
            chosen.append((used[k], times))
    return chosen


def fill(counts: np.ndarray, size: int) -> Iterator[list[int]]:
    """Bins, as lists of lengths, that use up ``counts`` (count of each length)."""
    left = [int(x) for x in np.flatnonzero(counts)[::-1]]
    while left:
        first = left[0]
        counts[first] -= 1
        chosen = best_fill(counts, left, size - first)
        counts[first] += 1
        need = dict(chosen)
        need[first] = need.get(first, 0) + 1
        times = min(int(counts[length]) // n for length, n in need.items())
        content = [length for length, n in sorted(need.items(), reverse=True) for _ in range(n)]
        for _ in range(times):
            yield content
        for length, n in need.items():
            counts[length] -= times * n
        left = [length for length in left if counts[length]]


class _Packer:
    """The open window of one task. Sequences are numbered within the task."""

    def __init__(self, size: int, window: int, first: int):
        self.size, self.window, self.next = size, window, first
        self.waiting: dict[int, list] = {}
        self.held = 0

    def add(self, key, ids: bytes) -> Iterator[tuple]:
        total, size = len(ids) // 4, self.size
        full = total // size
        for k in range(full):
            yield key, k * size, ids[4 * k * size : 4 * (k + 1) * size], total, self.next, 0
            self.next += 1
        rest = total - full * size
        if rest:
            self.waiting.setdefault(rest, []).append((key, full * size, ids[4 * full * size :], total))
            self.held += 1
            if self.held >= self.window:
                yield from self.flush(final=False)

    def flush(self, final: bool) -> Iterator[tuple]:
        """Pack what waits. Unless final, a bin that isn't full goes on waiting."""
        counts = np.zeros(self.size + 1, np.int64)
        for length, items in self.waiting.items():
            counts[length] = len(items)
        for content in list(fill(counts, self.size)):
            if not final and sum(content) < self.size:
                continue
            offset = 0
            for length in content:
                key, start, ids, total = self.waiting[length].pop()
                yield key, start, ids, total, self.next, offset
                offset += length
                self.held -= 1
            self.next += 1
        if not final and self.held >= self.window // 2:  # only slack bins are left over
            yield from self.flush(final=True)


def _groups(column: pa.Array, most: int) -> Iterable[tuple[int, int]]:
    from fieldgauge.llm.words import chunks

    return chunks(column, most)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id: str = "doc_id",
    text: str = "text",
    size: int = SEQUENCE,
    end_id: int = END_ID,
    window: int = WINDOW,
    with_ids: bool = True,
) -> DataFrame:
    """One row a piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (long), and ids (little-endian 32-bit, binary) if asked for.

    ``tokenizer`` is the path of the tokenizer's file, or its name in ``public_tokenizers``.
    Sequence ids are unique: the task's number above 2**40, then a counter.
    """
    kind = docs.schema[id].dataType.simpleString()
    fields = [f"`{id}` {kind}"] + [f"{c} bigint" for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    fields += ["ids binary"] * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def rows(pieces: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        keys, starts, ids, totals, sequences, offsets = zip(*pieces, strict=True)
        columns = [
            pa.array(keys, key_type),
            pa.array(starts, pa.int64()),
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([zlib.crc32(x) for x in ids], pa.int64()),
            pa.array(totals, pa.int64()),
            pa.array(sequences, pa.int64()),
            pa.array(offsets, pa.int64()),
        ] + [pa.array(ids, pa.binary())] * with_ids
        return pa.RecordBatch.from_arrays(columns, names=[f.split()[0].strip("`") for f in fields])

    def run(batches):
        encoder = None
        packer = _Packer(size, window, TaskContext.get().partitionId() << 40)
        key_type = None
        for batch in batches:
            encoder = encoder or _encoder(_path(tokenizer))
            key_type = batch.column(0).type
            for a, b in _groups(batch.column(1), TEXT_BYTES):
                keys = batch.column(0).slice(a, b - a).to_pylist()
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                out = []
                for key, ids in zip(keys, encoder.encode(texts), strict=True):
                    out += packer.add(key, ids + end)
                if out:
                    yield rows(out, key_type)
        out = list(packer.flush(final=True))
        if out:
            yield rows(out, key_type)

    return docs.select(F.col(id), F.col(text)).mapInArrow(run, ", ".join(fields))


def _path(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
