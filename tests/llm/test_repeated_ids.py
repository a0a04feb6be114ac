"""Page ids that repeat, through archives and back."""

import pytest

from fieldgauge.llm import warc


@pytest.mark.parametrize(
    ("pages", "sizes"),
    [
        ([(1, "A" * 9), (1, "A" * 9), (2, "A" * 9)], [(1, 9), (1, 9), (2, 9)]),
        ([(1, "A" * 9), (1, "B" * 5), (2, "A" * 9)], [(1, 5), (1, 9), (2, 9)]),
        ([(1, "A" * 9), (1, "B" * 5), (2, "A" * 9), (3, "B" * 5), (3, "B" * 5)], [(1, 5), (1, 9), (2, 9), (3, 5), (3, 5)]),
        ([(None, "A" * 9), (2, "A" * 9), (3, None)], [(2, 9), (3, 0), (None, 9)]),
        ([], []),
    ],
)
def test_every_page_is_read_back_once(spark, tmp_path, pages, sizes):
    rows = spark.createDataFrame([(k, f"u{k}", t) for k, t in pages], "page_id long, url string, html string")
    warc.write(rows, str(tmp_path / "w"))
    found = warc.original_bytes(warc.read(spark, str(tmp_path / "w"), with_payload=False)).collect()
    by_id = [(int(k) if (k := r.record_id.rsplit(":", 1)[-1].rstrip(">")).isdigit() else None, r.payload_bytes) for r in found]
    assert sorted(by_id, key=str) == sorted(sizes, key=str)


def test_keep_one_decides_by_row(spark):
    """An id that repeats on a copy and on a clean text, and rows that repeat whole."""
    from fieldgauge.llm import jaccard

    a, b, c = "one two three four five six seven", "all other words stand in this text", "and a third that is like none"
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "y"), (3, c, "z"), (3, c, "z"), (4, "", "e"), (4, "", "e"), (None, a, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    found = jaccard.join(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in found if r.doc_id) == [
        (1, 1), (2, 1), (2, 2), (3, 3), (3, 3), (4, 4), (4, 4),
    ]
    kept = sorted((tuple(r) for r in jaccard.keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, a, "x"), (2, b, "y"), (3, c, "z"), (4, "", "e"), (4, "", "e"), (None, a, "n")], key=str)
    once = docs.where("text <> '' AND doc_id <> 3 AND NOT (doc_id = 2 AND node = 'x')")
    assert jaccard.keep_one(once).count() == 2
