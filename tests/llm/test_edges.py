"""Nulls, empty and odd texts, rows that repeat, empty tables, clashing names."""

import brute
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import cascade, jaccard, katz, licenses, lines, minhash, mixing, packing, weak

ODD = [
    (1, None, None, 9), (2, "", "a", 9), (3, " \n\t ", "a", 9), (4, "one", "a", 9), (5, "One", "b", 9),
    (6, "x" * 5000 + " y" * 3000, "b", 9), (7, "a b c d e f", None, 9), (7, "a b c d e f", None, 9), (None, "lost row", "a", 9),
]
SCHEMA = "doc_id long, text string, source string, n_words long"


@pytest.fixture(scope="module", params=["odd", "empty"])
def docs(request, spark):
    return spark.createDataFrame(ODD if request.param == "odd" else [], SCHEMA).repartition(2).persist()


@pytest.mark.parametrize(
    "work",
    [
        lambda d: cascade.apply(d),
        lambda d: licenses.scan(d),
        lambda d: lines.dedup(d),
        lambda d: jaccard.join(d),
        lambda d: katz.score(d, F.lit(False)),
        lambda d: weak.score(d),
        lambda d: minhash.with_fingerprint(d, F.col("text"), "print"),
    ],
    ids=["cascade", "licenses", "lines", "jaccard", "katz", "weak", "minhash"],
)
def test_one_row_each(docs, work):
    assert work(docs).count() == docs.count()


def test_mixing_and_packing(docs):
    n = docs.count()
    assert mixing.mix(docs).count() >= n
    packed = packing.pack(docs, "byte_bpe_50k.json")
    assert packed.where("start = 0").count() == n


def test_values(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    found = {r.doc_id: r for r in jaccard.join(docs).collect()}
    assert (found[1].n_shingles, found[1].component_id) == (0, 1)
    assert found[5].component_id == 4 == found[4].component_id
    rows = cascade.apply(docs).collect()
    assert {r.n_words for r in rows if r.doc_id == 7} == {brute.base("a b c d e f")["n_words"]}


def test_names_that_the_operators_use_themselves(spark):
    """Columns of the input may have the names of columns that are made on the way."""
    names = ["full", "room", "blocks", "cut_block", "cut_place", "group", "found", "key", "head", "upto", "raw"]
    docs = spark.createDataFrame([r for r in ODD if r[0] is not None][:5], SCHEMA)
    odd = docs.select("*", *(F.lit("other").alias(c) for c in names))
    mixed = mixing.mix(odd)
    assert {*names} <= {*mixed.columns} and mixed.select("doc_id").distinct().count() == 5
    after = minhash.next_rows(odd, "doc_id", ["doc_id"]).select("doc_id", "next.doc_id", *names).collect()
    assert sorted(r[:2] for r in after) == [(1, 5), (2, 1), (3, 2), (4, 3), (5, 4)]


def test_pages_without_an_id(spark, tmp_path):
    from fieldgauge.llm import catalog

    rows = [(1, "u", "<p>a</p>"), (None, "u", "<p>a</p>"), (2, "u", None), (3, "u", "<p>a</p>"), (3, "u", "<p>a</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    found = catalog.op8_warc(spark, str(tmp_path)).collect()
    assert sorted((r.page_id or 0, r.payload_bytes) for r in found) == [(0, 8), (1, 8), (2, 0), (3, 8), (3, 8)]


def test_lines_of_very_long_texts(spark):
    """Thousands of dropped lines in a text; lines of its own between them stay, repeats go too."""
    shared = [f"line {i} of a passage that many documents hold in common" for i in range(3000)]
    docs = [(k, "\n".join([*shared, f"the own line of document {k}, which is long enough too", *shared])) for k in range(6)]
    found = {r.doc_id: r for r in lines.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k, text in docs[:-1]:
        assert (found[k].n_lines, found[k].n_dropped) == (6001, 6000)
        assert found[k].text == text.split("\n")[3000]
    assert (found[5].text, found[5].n_dropped) == (docs[5][1], 0)
