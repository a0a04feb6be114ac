"""Quality by weak labels: expectation-maximisation over heuristic labellers, then a scorer.

Labellers vote good, bad or nothing on a text. Their votes over all texts are counted by
pattern. Expectation-maximisation on those counts estimates how often each labeller votes
what when a text is good or bad, without any true label, and gives each pattern the
probability of being good. These posteriors train a linear scorer on hashed features.
The scorer then scores every text, also where few labellers vote.

A second pair of classes, insulting or not, is estimated and trained in the same way. One
of its labellers knows ten English insults. The others know none: each learns from labelled
texts which beginnings of words, BEGINNINGS bytes long, stand for toxic ones, in any
language, and from which count or share of the words on. Each learns from labelled texts
of its own, so their errors are not the same.

Votes are counted over all texts: there are at most 3 ** labellers patterns. The scorer is
fitted on SAMPLE texts at most on average, picked by a hash of the id: a documented bound.
The labellers learn from LABELLED labelled texts at most on average, and from half of them
at most, picked in the same way: the other half can show how well they do.

Defined cases: without labels, or where a beginning stands out in none, these labellers
abstain. a null, empty or blank text is scored by the bias of a text without words,
and not kept. Rows that repeat get equal scores. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm import words as W
from fieldgauge.llm.cascade import Texts, _doubled_end, _no_letter, _shouted
from fieldgauge.llm.frames import stored

#: Texts on which the scorer is fitted, and width of its weights.
SAMPLE, WIDTH = 6000, 1 << 16
ROUNDS, STEPS, RATE, SHRINK = 50, 60, 0.5, 1e-6
#: Labelled texts to learn from, and the bytes of a beginning for each labeller.
LABELLED, BEGINNINGS = 6000, (4, 5)
#: How often a text has a beginning: once, more, or in over these shares of its words besides once.
SHARES = np.array([0, 0.003, 0.006, 0.01])
#: A beginning is learnt from so many toxic texts, with so large a G statistic at least.
LEAST_TEXTS, LEAST_G = 5, 25
NOTHING, BAD, GOOD = 0, 1, 2

#: Frequent words of four languages, and insults: fixed values.
STOP_WORDS = "the of and to in is that it for on was with as be by are this a or at de la le les des et un une en que qui dans est pour el los las y del por con una para der die das und ist nicht von mit den sich auf".split()
INSULTS = "trash pathetic idiot worthless disgusting stupid clown loser scum moron".split()


def _hash_of(words: list[str]) -> np.ndarray:
    return np.unique(W.split(pa.array(words), lower=True).hashes())


_STOP, _INSULT = _hash_of(STOP_WORDS), _hash_of(INSULTS)


@dataclass(frozen=True)
class Learnt:
    """Beginnings of words of a size, in order, that stand for toxic texts from a level on,
    and the share of toxic ones among the texts that have them so often."""

    size: int
    key: np.ndarray
    level: np.ndarray
    share: np.ndarray


def learn(size: int, toxic: np.ndarray, text: np.ndarray, key: np.ndarray, level: np.ndarray) -> Learnt:
    """From labelled texts and their beginnings: for each that stands out, its best level."""
    bad, good = toxic.sum(), (~toxic).sum()

    def term(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-9)), 0.0)

    best: dict[int, tuple[float, int, float]] = {}
    for k in range(len(SHARES) + 1):
        here = level >= k
        keys, inverse = np.unique(key[here], return_inverse=True)
        n = np.bincount(inverse, minlength=len(keys)).astype(float)
        a = np.bincount(inverse, weights=toxic[text[here]], minlength=len(keys))
        share, rest = bad / max(1, bad + good), bad + good - n
        g = 2 * (term(a, n * share) + term(n - a, n * (1 - share)) + term(bad - a, rest * share) + term(good - n + a, rest * (1 - share)))
        for i in np.flatnonzero((a >= LEAST_TEXTS) & (g >= LEAST_G) & (a > n * share)):
            if (found := int(keys[i])) not in best or g[i] > best[found][0]:
                best[found] = (g[i], k, a[i] / (n[i] + 1))
    order = sorted(best)
    return Learnt(size, np.array(order, np.int64), np.array([best[x][1] for x in order], np.int64), np.array([best[x][2] for x in order], float))


class Features:
    """What the labellers look at, for a batch of texts, as shares of the words."""

    def __init__(self, texts: pa.Array, learnt: list[Learnt] = ()):
        self.texts = Texts(texts)
        every = np.arange(len(texts))
        base = self.texts.base()
        self.n = base["n_words"]
        some = np.maximum(self.n, 1)
        self.lower = W.split(texts, lower=True)
        self.hashes = self.lower.hashes()
        self.symbols = base["n_symbols"] / some
        self.repeats = base["n_repeat_words"] / some
        self.mean = base["word_chars"] / some
        self.lines = base["n_dup_lines"] / (1 + self.texts.words.total(self.texts.words.buf == 10))
        self.flags = []
        for test in (_no_letter, _shouted, _doubled_end):
            w = self.texts.words
            self.flags.append(test(w.buf, w.start, w.end))
        self.no_letter, self.shouted, self.marked = (self.texts.per_text(f, every) / some for f in self.flags)
        self.stutter = self.texts.stutters(every) / some
        self.stops = self.texts.per_text(np.isin(self.hashes, _STOP), every) / some
        plain = self._bare()
        self.insult_word = np.isin(plain, _INSULT)
        self.insults = self.texts.per_text(self.insult_word, every)
        self.learnt = [self._judged(x) for x in learnt]

    def beginnings(self, size: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, beginning, level) for each text's distinct beginnings, or the wanted ones."""
        w = self.lower
        key = (w.spans(w.start, np.minimum(w.start + size, w.end)) >> np.uint64(32)).astype(np.int64)
        here = w.end - w.start >= size
        if wanted is not None:
            here &= np.isin(key, wanted)
        pairs, times = np.unique(w.text_of_word()[here] << 32 | key[here], return_counts=True)
        text = pairs >> 32
        level = np.where(times > 1, np.searchsorted(SHARES, (times - 1) / np.maximum(self.n, 1)[text]), 0)
        return text, pairs & 0xFFFFFFFF, level

    def _judged(self, learnt: Learnt) -> np.ndarray:
        """A vote for each text."""
        if not len(learnt.key):
            return np.full(len(self.n), NOTHING)
        text, key, level = self.beginnings(learnt.size, learnt.key)
        at = np.searchsorted(learnt.key, key)
        toxic = np.zeros(len(self.n))
        np.maximum.at(toxic, text, np.where(level >= learnt.level[at], learnt.share[at], 0.0))
        return np.where(toxic >= 0.5, BAD, np.where(toxic == 0, GOOD, NOTHING))

    def _bare(self) -> np.ndarray:
        """Hashes of the words without marks of ASCII punctuation at their end."""
        w = self.lower
        end = w.end.copy()
        mark = np.isin(w.buf, np.frombuffer(b".,;:!?\"')", np.uint8))
        for _ in range(3):
            cut = (end - w.start > 1) & mark[end - 1]
            end = end - cut
        return w.spans(w.start, end)


def _band(x: np.ndarray, good_below: float, bad_above: float) -> np.ndarray:
    return np.where(x > bad_above, BAD, np.where(x < good_below, GOOD, NOTHING))


def quality_votes(f: Features) -> np.ndarray:
    """A column for each labeller."""
    return np.stack(
        [
            _band(f.symbols, 0.02, 0.15),
            _band(f.no_letter, 0.05, 0.25),
            _band(f.shouted, 0.05, 0.25),
            _band(f.marked, 0.02, 0.15),
            _band(f.repeats, 0.08, 0.25),
            _band(np.maximum(f.stutter, np.where(f.lines > 0.3, 1.0, 0.0)), 0.05, 0.2),
            np.where(f.n < 10, BAD, np.where(f.n >= 30, GOOD, NOTHING)),
            np.where((f.stops < 0.02) | (f.mean > 15), BAD, np.where(f.stops > 0.1, GOOD, NOTHING)),
        ],
        axis=1,
    )


def insult_votes(f: Features) -> np.ndarray:
    """Votes of whether a text is free of insults."""
    return np.stack([np.where(f.insults >= 1, BAD, GOOD), *f.learnt], axis=1)


TASKS = {"quality": quality_votes, "clean": insult_votes}


def _pattern(votes: np.ndarray) -> np.ndarray:
    return votes @ (3 ** np.arange(votes.shape[1]))


def estimate(patterns: np.ndarray, counts: np.ndarray, labellers: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The probability that a text with each pattern is good, and each labeller's accuracy:
    how often its vote, if it votes, is right. Starts from the majority of votes."""
    if not len(patterns):
        return np.zeros(0), np.zeros(labellers)
    votes = patterns[:, None] // 3 ** np.arange(labellers) % 3
    ups, downs = (votes == GOOD).sum(1), (votes == BAD).sum(1)
    # one bad vote weighs as much as several good ones: most labellers see one kind of flaw
    good = np.clip((ups + 1.0) / (ups + 4.0 * downs + 2.0), 0.05, 0.95)
    n = counts.astype(float)
    one_hot = np.stack([votes == v for v in range(3)], axis=2).astype(float)
    for _ in range(rounds):
        prior = np.clip((n * good).sum() / n.sum(), 0.02, 0.98)
        table = []
        for weight in (n * good, n * (1 - good)):
            seen = np.einsum("p,plv->lv", weight, one_hot) + 0.1
            table.append(np.log(seen / seen.sum(1, keepdims=True)))
        up = np.log(prior) + np.einsum("plv,lv->p", one_hot, table[0])
        down = np.log(1 - prior) + np.einsum("plv,lv->p", one_hot, table[1])
        good = 1 / (1 + np.exp(np.clip(down - up, -50, 50)))
    right = (n * good) @ (votes == GOOD) + (n * (1 - good)) @ (votes == BAD)
    return good, right / np.maximum(n @ (votes != NOTHING), 1e-9)


def _hashed(f: Features, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of the hashed features: presence of words, shares of shapes."""
    owner = f.lower.text_of_word()
    n = len(f.n)
    slot = (W.mix(f._bare()) % np.uint64(width - 64)).astype(np.int64)
    pairs = np.unique(owner * width + slot)
    text, feature = pairs // width, pairs % width
    value = 1 / np.sqrt(np.maximum(np.bincount(text, minlength=n), 1))[text]
    shapes = [f.symbols, f.no_letter, f.shouted, f.marked, f.repeats, f.stutter, f.lines, f.stops, f.n < 10, f.insults > 0, f.insults > 1]
    shapes += [votes == BAD for votes in f.learnt]
    at = np.arange(n)
    text = np.concatenate([text, *[at] * (len(shapes) + 1)])
    feature = np.concatenate([feature, *[np.full(n, width - 64 + k) for k in range(len(shapes) + 1)]])
    value = np.concatenate([value, *[3 * np.minimum(np.asarray(s, float), 1.0) for s in shapes], np.ones(n)])
    return text, feature, value


def _fit(rows: list[tuple[np.ndarray, np.ndarray, float]], width: int) -> np.ndarray:
    """Logistic regression by full-batch Adagrad."""
    weights = np.zeros(width)
    if not rows:
        return weights
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    feature = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    target = np.array([r[2] for r in rows])
    # both classes weigh the same
    share = np.clip(target.mean(), 0.02, 0.98)
    weight = target / share + (1 - target) / (1 - share)
    squares = np.full(width, 1e-8)
    for _ in range(STEPS):
        margin = np.bincount(owner, weights=weights[feature] * value, minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target) * weight / len(rows)
        slope = np.bincount(feature, weights=error[owner] * value, minlength=width) + SHRINK * weights
        squares += slope * slope
        weights -= RATE * slope / np.sqrt(squares)
    return weights


def _picked(id: str, name: str, share: float):
    """Whether the id is in a share of all ids."""
    return F.pmod(F.xxhash64(F.col(id), F.lit(name)), F.lit(1_000_000)) < int(1_000_000 * share)


def learn_all(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic", most: int = LABELLED) -> list[Learnt]:
    """A labeller for each size of beginnings, from its own part of the sampled labels."""
    known = labels.where(F.col(id).isNotNull() & F.col(toxic).isNotNull())
    total = known.count()
    if not total:
        return [learn(size, *[np.zeros(0, np.int64).astype(k) for k in (bool, int, int, int)]) for size in BEGINNINGS]
    mine = known.where(_picked(id, "labelled", min(0.5, most / total)))
    mine = mine.groupBy(id).agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    part = F.pmod(F.xxhash64(F.col(id), F.lit("part")), F.lit(len(BEGINNINGS))).cast("int")
    rows = docs.select(F.col(id), F.col(text).alias("text")).join(F.broadcast(mine.withColumn("part", part)), id)

    def look(batches):
        for batch in batches:
            for a, b in W.chunks(batch.column(0)):
                here = batch.slice(a, b - a)
                f, parts = Features(here.column(0)), here.column(2).to_numpy()
                for k, size in enumerate(BEGINNINGS):
                    owner, key, level = f.beginnings(size)
                    at = np.flatnonzero(parts == k)
                    spans = list(zip(np.searchsorted(owner, at), np.searchsorted(owner, at, "right"), strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            here.column(1).take(pa.array(at)),
                            pa.array(np.full(len(at), k), pa.int32()),
                            pa.array([key[s:e].astype(np.uint32).tobytes() for s, e in spans], pa.binary()),
                            pa.array([level[s:e].astype(np.int8).tobytes() for s, e in spans], pa.binary()),
                        ],
                        names=["toxic", "part", "key", "level"],
                    )

    looked = rows.select("text", "toxic", "part").mapInArrow(look, "toxic int, part int, key binary, level binary")

    def conclude(batches):
        found = [r for batch in batches for r in batch.to_pylist()]
        for k, size in enumerate(BEGINNINGS):
            own = [r for r in found if r["part"] == k]
            keys = [np.frombuffer(r["key"], np.uint32).astype(np.int64) for r in own]
            levels = [np.frombuffer(r["level"], np.int8).astype(np.int64) for r in own]
            none = [np.zeros(0, np.int64)]
            text = np.repeat(np.arange(len(own)), [len(x) for x in keys])
            x = learn(size, np.array([r["toxic"] > 0 for r in own], bool), text, np.concatenate(keys or none), np.concatenate(levels or none))
            yield pa.RecordBatch.from_pydict({"size": [size], "key": [x.key.tobytes()], "level": [x.level.tobytes()], "share": [x.share.tobytes()]})

    # the bounded sample goes to one task; a few beginnings come back
    schema = "size long, key binary, level binary, share binary"
    done = looked.repartition(1).mapInArrow(conclude, schema).collect()
    found = {r["size"]: Learnt(r["size"], np.frombuffer(r.key, np.int64), np.frombuffer(r.level, np.int64), np.frombuffer(r.share)) for r in done}
    return [found.get(size, Learnt(size, *[np.zeros(0, np.int64)] * 2, np.zeros(0))) for size in BEGINNINGS]


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE, width: int = WIDTH, labels: DataFrame | None = None) -> dict:
    """For each task: weights (array of ``width``), accuracy of each labeller; and what the
    labellers have learnt from ``labels`` (id, toxic), if there are any."""
    spark = docs.sparkSession
    learnt = [] if labels is None else learn_all(docs, labels, id, text)

    def count(batches):
        sums: dict[tuple[int, int], int] = {}
        n = 0
        for batch in batches:
            for a, b in W.chunks(batch.column(0)):
                f = Features(batch.column(0).slice(a, b - a), learnt)
                n += b - a
                for k, votes in enumerate(TASKS.values()):
                    for p, c in zip(*np.unique(_pattern(votes(f)), return_counts=True), strict=True):
                        sums[k, int(p)] = sums.get((k, int(p)), 0) + int(c)
        rows = [(k, p, c) for (k, p), c in sums.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["task", "pattern", "n"])

    parts = docs.select(F.col(text)).mapInArrow(count, "task long, pattern long, n long")
    found = parts.groupBy("task", "pattern").agg(F.sum("n").alias("n")).collect()
    total = sum(r.n for r in found if r.task == 0)
    labels, models = [], {}
    for k, (name, votes) in enumerate(TASKS.items()):
        mine = sorted((r.pattern, r.n) for r in found if r.task == k)
        patterns = np.array([p for p, _ in mine], np.int64)
        width_of = votes(Features(pa.array([""]), learnt)).shape[1]
        good, accuracy = estimate(patterns, np.array([n for _, n in mine], np.int64), width_of)
        labels.append(dict(zip(patterns.tolist(), good.tolist(), strict=True)))
        models[name] = {"accuracy": accuracy, "learnt": learnt}
    if not total:
        return {name: m | {"weights": np.zeros(width)} for name, m in models.items()}

    def examples(batches):
        for batch in batches:
            for a, b in W.chunks(batch.column(0)):
                f = Features(batch.column(0).slice(a, b - a), learnt)
                owner, feature, value = _hashed(f, width)
                order = np.argsort(owner, kind="stable")
                bounds = np.searchsorted(owner[order], np.arange(b - a + 1))
                feature, value = feature[order].astype(np.int32), value[order].astype(np.float32)
                label = [
                    [labels[k][int(p)] for p in _pattern(votes(f))] for k, votes in enumerate(TASKS.values())
                ]
                spans = list(zip(bounds[:-1], bounds[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([feature[s:e].tobytes() for s, e in spans], pa.binary()),
                        pa.array([value[s:e].tobytes() for s, e in spans], pa.binary()),
                        *[pa.array(x, pa.float64()) for x in label],
                    ],
                    names=["feature", "value", *TASKS],
                )

    schema = "feature binary, value binary, " + ", ".join(f"{t} double" for t in TASKS)
    picked = _picked(id, "sample", min(1.0, sample / total))
    chosen = stored(spark, docs.where(picked).select(F.col(text)).mapInArrow(examples, schema), "weak-sample")

    def train(batches):
        rows = [r for batch in batches for r in batch.to_pylist()]
        for name in TASKS:
            ready = [(np.frombuffer(r["feature"], np.int32), np.frombuffer(r["value"], np.float32), r[name]) for r in rows]
            yield pa.RecordBatch.from_pydict({"task": [name], "weights": [_fit(ready, width).tobytes()]})

    # the bounded sample is fitted in one task; a fixed number of weights comes back
    fitted = chosen.repartition(1).mapInArrow(train, "task string, weights binary").collect()
    for r in fitted:
        models[r.task]["weights"] = np.frombuffer(r.weights)
    return {name: {"weights": np.zeros(width)} | m for name, m in models.items()}


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", models: dict | None = None, width: int = WIDTH, labels: DataFrame | None = None) -> DataFrame:
    """(id, n_votes (long), score, clean_score (double, 0 to 1), kept (boolean)): a text is
    kept if it has a word and both scores are at least one half."""
    models = models or fit(docs, id, text, width=width, labels=labels)
    learnt = models["clean"]["learnt"]
    weights = {name: m["weights"] for name, m in models.items()}
    kind = docs.schema[id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b in W.chunks(batch.column(1)):
                f = Features(batch.column(1).slice(a, b - a), learnt)
                owner, feature, value = _hashed(f, width)
                found = {}
                for name, w in weights.items():
                    margin = np.bincount(owner, weights=w[feature] * value, minlength=b - a)
                    found[name] = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
                votes = (quality_votes(f) != NOTHING).sum(1).astype(np.int64)
                kept = (f.n > 0) & (found["quality"] >= 0.5) & (found["clean"] >= 0.5)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(votes), pa.array(found["quality"]), pa.array(found["clean"]), pa.array(kept)],
                    names=["id", "n_votes", "score", "clean_score", "kept"],
                )

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {kind}, n_votes long, score double, clean_score double, kept boolean"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)
