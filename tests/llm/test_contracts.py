"""The registered queries against plain versions, over whole tables."""

import hashlib
import zlib
from collections import defaultdict

import brute
import harness
import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import catalog, jaccard, katz

SMALL = str(harness.TESTDATA / "sf0.001")
MIDDLE = str(harness.TESTDATA / "sf0.01")


@pytest.fixture(scope="module")
def small():
    con = harness.duck(SMALL)
    return {
        "docs": con.execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall(),
        "pages": con.execute("SELECT page_id, html FROM pages ORDER BY 1").fetchall(),
        "source": dict(con.execute("SELECT doc_id, source FROM documents").fetchall()),
    }


def rows(frame, key):
    found = {r[key]: r for r in frame.collect()}
    return found


def test_op1(spark, small):
    docs = [(k, t, brute.crc(k) == 1) for k, t in small["docs"]]
    expected, sums = brute.katz(docs)
    found = rows(catalog.op1_katz(spark, SMALL), "doc_id")
    assert len(found) == len(docs)
    for k, _, held in docs:
        r = found[k]
        n, known, total, base, score = expected[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=1e-9)
    assert all(s == pytest.approx(1, abs=1e-9) for s in sums.values())
    held = [found[k] for k, _, h in docs if h]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("order", [1, 2, 4])
def test_katz_orders(spark, small, order):
    """Other orders, over blocks and buckets so small that texts and histories are split."""
    docs = [(k, t, k % 7 == 3) for k, t in small["docs"] if k % 4 == 0]
    docs += [(-1, "the the the the the the end", False), (-2, "the the the the", True), (-3, None, True)]
    expected, sums = brute.katz(docs, order=order)
    frame = spark.createDataFrame(docs, "doc_id long, text string, held boolean")
    found = rows(katz.score(frame, F.col("held"), order=order, block_tokens=500, bucket_bytes=2000), "doc_id")
    for k, _, _ in docs:
        assert found[k].score == pytest.approx(expected[k][4], rel=1e-9)
        assert order > 1 or found[k].backoffs == found[k].n_tokens
    assert all(s == pytest.approx(1, abs=1e-9) for s in sums.values())


def test_op2(spark):
    found = rows(catalog.op2_weak_quality(spark, MIDDLE), "doc_id")
    labels = harness.duck(MIDDLE).execute("SELECT doc_id, quality, toxic FROM labels").fetchall()
    kept = np.array([found[k].kept for k, _, _ in labels])
    good = np.array([q == 1 and t == 0 for _, q, t in labels])
    assert len(found) == 1000
    assert kept[good].mean() > 0.95
    assert kept[~good].mean() < 0.2


def test_op3(spark, small):
    found = rows(catalog.op3_quality_rules(spark, SMALL), "doc_id")
    assert len(found) == len(small["docs"])
    for k, text in small["docs"]:
        b = brute.base(text)
        r = found[k]
        assert {c: r[c] for c in b} == b
        failed = b["n_words"] < 10 or 100 * b["n_repeat_words"] > 20 * b["n_words"]
        assert r.base_failed == failed
        assert not (failed and r.kept)


def test_op4(spark, small):
    expected = brute.joined(small["docs"], 3, 90)
    found = rows(catalog.op4_jaccard_join(spark, SMALL), "doc_id")
    assert {k: (r.n_shingles, r.component_id) for k, r in found.items()} == expected


@pytest.mark.parametrize(("size", "percent"), [(5, 80), (3, 100)])
def test_jaccard_settings(spark, small, size, percent):
    expected = brute.joined(small["docs"], size, percent)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = rows(jaccard.join(docs, shingle=size, percent=percent), "doc_id")
    assert {k: (r.n_shingles, r.component_id) for k, r in found.items()} == expected


def test_jaccard_near_group(spark):
    """Copies with few edits and with many, so that links, chains and near misses meet."""
    base = [f"w{k}" for k in range(120)]
    docs = []
    for k in range(90):
        text = list(base)
        for at in range(k % 6):
            text[(k * 17 + at * 23) % 120] = f"x{k}_{at}"
        docs.append((k, " ".join(text)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = rows(jaccard.join(frame, shingle=3, percent=90, small=4), "doc_id")
    assert {k: (r.n_shingles, r.component_id) for k, r in found.items()} == brute.joined(docs, 3, 90)


def test_op5(spark, small):
    known = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    con = harness.duck(MIDDLE)
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    found = rows(catalog.op5_licences(spark, MIDDLE), "doc_id")
    for k, text in docs:
        names = sorted({known[x.strip()] for x in text.split("\n") if x.strip() in known})
        assert found[k].licences == ",".join(names), text[:200]


def test_op6(spark, small):
    found = rows(catalog.op6_fingerprints(spark, SMALL), "doc_id")
    docs = sorted(small["docs"], reverse=True)
    errors = []
    for i, (k, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1] or ""
        text = text or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        r = found[k]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, r.near_edited), (after, r.near_next)):
            a, b = brute.shingles(text, 5), brute.shingles(other, 5)
            errors.append(near - (len(a & b) / len(a | b) if a | b else 1.0))
    assert abs(np.mean(errors)) < 0.02 and np.sqrt(np.mean(np.square(errors))) < 0.06
    by_text = defaultdict(set)
    for k, text in docs:
        by_text[text].add(found[k].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())


def test_op7(spark, small):
    found = catalog.op7_mixing(spark, SMALL).collect()
    tokens = defaultdict(int)
    taken = defaultdict(int)
    sizes = {k: len(brute.words(t)) for k, t in small["docs"]}
    for k, s in small["source"].items():
        tokens[s] += sizes[k]
    for r in found:
        assert r.n_tokens == sizes[r.doc_id]
        taken[r.source] += r.n_tokens
    assert {r.doc_id for r in found} == set(sizes)
    weights = {r.source: r.weight for r in found}
    assert sum(weights.values()) == pytest.approx(1)
    budget = max(tokens[s] / w for s, w in weights.items())
    for s, w in weights.items():
        largest = max(sizes[k] for k in sizes if small["source"][k] == s)
        assert w * budget - largest < taken[s] <= w * budget + 1e-6
        assert taken[s] <= 2 * tokens[s] * (1 + 1e-6)


def test_op8(spark, small):
    found = rows(catalog.op8_warc(spark, SMALL), "page_id")
    expected = brute.warc(small["pages"])
    assert {k: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for k, r in found.items()} == expected


def test_op9(spark, small):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(catalog.TOKENIZER))
    ids = {k: [*t.encode(x or "", add_special_tokens=False).ids, 0] for k, x in small["docs"]}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in catalog.op9_packing(spark, SMALL).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for k, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            data = np.array(ids[k][r.start : r.start + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids[k]), zlib.crc32(data))
            at += r.length
        assert at == len(ids[k])
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding += 1024 - at if at & (at - 1) else 0
    assert padding < 0.03 * sum(map(len, ids.values()))


def test_op10(spark, small):
    found = rows(catalog.op10_line_dedup(spark, SMALL), "doc_id")
    expected = {k: (n, d, hashlib.sha256(t.encode()).hexdigest()) for k, (n, d, t) in brute.dedup(small["docs"]).items()}
    assert {k: (r.n_lines, r.n_dropped, r.kept_sha256) for k, r in found.items()} == expected


@pytest.mark.parametrize("name", catalog.SQL)
def test_sql(spark, name):
    assert harness.differences(catalog.QUERIES[name](spark, MIDDLE), harness.duck(MIDDLE), catalog.SQL[name]) == ""
