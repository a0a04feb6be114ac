"""Spelling variants, collocations and nearest vectors: plain versions and odd inputs."""

import random

import brute
import harness
import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import catalog, nearest, phrases, spelling

SMALL = str(harness.TESTDATA / "sf0.001")
MIDDLE = str(harness.TESTDATA / "sf0.01")

ODD = [
    (1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (None, "lost words here. lost words here", "en"),
    (4, "Same text Again; same text again", None), (4, "Same text Again; same text again", None),
    (5, "x" * 2_000 + " éè " + "y z " * 30_000, "fr"), (6, ".,;:!?\r\n", "und"),
]
SCHEMA = "doc_id long, text string, lang string"


def clashing(frame):
    """The frame with columns named as the operators name theirs."""
    names = ["w", "w1", "a", "n", "word", "state", "rank", "row", "cell", "score", "point", "query", "root", "form"]
    return frame.select("*", *(F.lit("other").alias(x) for x in names))


# -- spelling variants ---------------------------------------------------------


def found_words(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_op11(spark):
    docs = harness.duck(MIDDLE).execute("SELECT doc_id, text FROM documents").fetchall()
    expected = brute.spelling(docs)
    assert found_words(catalog.op11_spelling_variants(spark, MIDDLE)) == expected
    assert sum(form is not None for form, *_ in expected.values()) > 100
    assert any(root != form for form, root, *_ in expected.values() if form)


def test_states_that_are_expanded(spark):
    docs = harness.duck(SMALL).execute("SELECT doc_id, text FROM documents").fetchall()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert found_words(spelling.variants(frame, most=2)) == brute.spelling(docs)


@pytest.mark.parametrize("most", [1, 7, spelling.MOST])
def test_every_pair_once(spark, most):
    draw = random.Random(5)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(1, 7))) for _ in range(250)}
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    found = [(r.word, r.near) for r in spelling.near_pairs(frame, most).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(x, y) for x in words for y in words if brute.one_edit(x, y)}


def test_acceptor_is_minimal():
    machine = spelling.minimised(sorted(["ax", "ay", "bx", "by"]))
    assert len(machine[0]) == 3
    assert len(list(spelling.pairs(machine))) == 4


def test_spelling_odd(spark):
    docs = spark.createDataFrame(ODD * 3, SCHEMA)
    expected = brute.spelling([(k, t) for k, t, _ in ODD * 3])
    assert found_words(spelling.variants(clashing(docs))) == expected
    assert spelling.variants(clashing(docs.limit(0))).collect() == []


def test_spelling_ties(spark):
    """Two near words of one count: the smaller is the form; equal counts have none."""
    text = " ".join(["zebra"] * 3 + ["zebro"] * 6 + ["zebri"] * 6)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = found_words(spelling.variants(docs, damage=0))
    assert found["zebra"] == ("zebri", "zebri", 3, 2, 6)
    assert found["zebri"] == (None, "zebri", 6, 2, None)


# -- collocations ----------------------------------------------------------------


def test_phrases_small_least(spark):
    """Ties, languages and absorbed pairs at other settings, by the registered SQL."""
    docs = spark.createDataFrame(
        [(k, t, lang) for k, (t, lang) in enumerate([("New York City. new york", "en"), ("new york city", None), ("a b a b a", "en")] * 12)],
        SCHEMA,
    )
    con = harness.duck(SMALL)
    con.execute("DROP VIEW IF EXISTS documents")
    rows = docs.collect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [tuple(r) for r in rows])
    assert harness.differences(phrases.collocations(docs), con, catalog.SQL["op12_collocations"]) == ""
    found = {(r.lang, r.phrase): r for r in phrases.collocations(docs).collect()}
    # city follows in half of the cases, which takes the pair in
    assert ("en", "new york") not in found and ("und", "new york") not in found
    assert found["en", "new york city"].score == 500000
    assert found["und", "new york city"].n == 36


def test_phrases_odd(spark):
    docs = spark.createDataFrame(ODD * 12, SCHEMA)
    found = {(r.lang, r.phrase): r for r in phrases.collocations(clashing(docs.drop("n"))).collect()}
    assert found["en", "lost words here"].a == 24
    assert found["und", "same text again"].a == 48
    assert found["fr", "y z y"].a == 12 * 29_999
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_phrases_top(spark):
    docs = spark.createDataFrame([(k, "b c. a b. c d", "x") for k in range(10)], SCHEMA)
    found = [(r["rank"], r.phrase) for r in phrases.collocations(docs, top=2).orderBy("rank").collect()]
    assert found == [(1, "a b"), (2, "c d")]


# -- nearest vectors ---------------------------------------------------------------


def vectors_of(sf):
    return harness.duck(sf).execute("SELECT vec_id, embedding FROM embeddings ORDER BY 1").fetchall()


def lists(frame):
    found = {}
    for r in frame.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(found[r.query_id]) == r["rank"]
    return found


@pytest.mark.parametrize("block", [nearest.BLOCK, 60])
def test_op13(spark, block):
    vectors = vectors_of(MIDDLE)
    frame = spark.read.parquet(f"{MIDDLE}/embeddings.parquet")
    found = lists(nearest.search(frame, F.col("vec_id") % 20 == 0, block=block))
    expected = {vectors[at][0]: near for at, near in brute.nearest(vectors).items()}
    assert set(found) == set(expected)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * 20 * len(expected)
    by_id = {i: np.array(v, float) for i, v in vectors}
    for q, near in found.items():
        assert all(s == pytest.approx(by_id[q] @ by_id[i], rel=1e-12) for i, s in near)
        assert near == sorted(near, key=lambda x: (-x[1], x[0])) and q not in {i for i, _ in near}


def test_stopping_test_finds_all_in_the_limit(spark):
    """With full confidence every list is the exact one, whatever the vectors' norms."""
    draw = np.random.default_rng(3)
    rows = [(k, (draw.standard_normal(6) * 10 ** draw.uniform(-2, 2)).tolist()) for k in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = lists(nearest.search(frame, F.col("vec_id") % 20 == 0, k=5, confidence=1 - 1e-12, block=32))
    expected = {rows[at][0]: near for at, near in brute.nearest(rows, 5).items()}
    assert {q: [i for i, _ in near] for q, near in found.items()} == {q: [i for i, _ in near] for q, near in expected.items()}


def test_chi_square():
    assert nearest.chi_square_quantile(0.95, 8) == pytest.approx(15.507313, abs=1e-5)
    assert nearest.chi_square_quantile(0.5, 1) == pytest.approx(0.454936, abs=1e-5)


def test_nearest_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]),
        (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (40, [2.0]), (7, [2.0, 0.0, 0.0]),
    ]
    frame = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = nearest.search(frame, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found if r.query_id == 20) == [
        (20, 1, 0, 0.0), (20, 2, 0, 0.0), (20, 3, 7, 0.0), (20, 4, 40, 0.0),
    ]
    twice = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == 0)
    assert twice == sorted([(1, 7, 2.0), (2, 40, 2.0), (3, 0, 1.0), (4, 20, 0.0)] * 2)
    for few in (frame.limit(0), frame.where("vec_id = 20")):
        assert nearest.search(few, F.col("vec_id") % 20 == 0).collect() == []


def test_one_vector_many_times(spark):
    """Half of all rows equal: one cell of many blocks, and the smallest ids win the ties."""
    draw = np.random.default_rng(4)
    rows = [(k, [1.0, 2.0, 3.0] if k % 2 else draw.standard_normal(3).tolist()) for k in range(1, 601)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = lists(nearest.search(frame, F.col("vec_id") == 1, k=4, block=16))
    more = [k for k, v in rows if np.dot(v, [1, 2, 3]) > 14]
    assert [i for i, _ in found[1]] == (more + [3, 5, 7, 9])[:4] if len(more) < 4 else True


# -- the Jaccard join's sketches ---------------------------------------------------


def test_sketches_never_exceed_the_difference():
    import pyarrow as pa

    from fieldgauge.llm import jaccard

    draw = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 300))) for _ in range(40)]
    texts += [t.replace("w1 ", "x ") for t in texts]
    grams, bounds = jaccard.sets(pa.array(texts), 3, 1)
    sets = [set(grams[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    bits = [np.array(s, np.int64).view(np.uint8) for s in jaccard._sketches(grams, bounds).to_pylist()]
    for a in range(0, 80, 3):
        for b in range(a, 80, 5):
            apart = int(np.unpackbits(bits[a] ^ bits[b]).sum())
            assert apart <= len(sets[a] ^ sets[b]) and (apart - len(sets[a] ^ sets[b])) % 2 == 0
