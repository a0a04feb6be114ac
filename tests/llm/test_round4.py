"""Plans that are the same at every size, and scratch tables that go when they are read."""

from pyspark.sql import functions as F

from fieldgauge.llm import jaccard, katz, lines

LINE = "a line that many documents share, long enough to count"
DOCS = [(k, f"{LINE}\nits own words are number {k}" if k % 2 else "one two three four five six") for k in range(12)]


def _docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_line_dedup_joins_small_decisions_as_it_does_large_ones(spark):
    cut = lines.dedup(_docs(spark))
    assert "SortMergeJoin" in _plan(cut) and "BroadcastHashJoin" not in _plan(cut)
    assert {r.doc_id: r.n_dropped for r in cut.collect()} == {k: int(k % 2 and k < 11) for k, _ in DOCS}


def test_keep_one_drops_few_documents_as_it_does_many(spark):
    left = jaccard.keep_one(_docs(spark))
    assert "SortMergeJoin" in _plan(left) and "BroadcastHashJoin" not in _plan(left)
    assert sorted(r.doc_id for r in left.collect()) == [0, *range(1, 12, 2)]


def test_katz_keeps_one_copy_of_blocks_and_answers(spark, monkeypatch):
    made, gone = [], []
    keep, free = katz.stored, katz.freed

    def stored(spark, frame, name, *by):
        found = keep(spark, frame, name, *by)
        made.append((name, {f.rsplit("/", 1)[0] for f in found.inputFiles()}))
        return found

    def freed(spark, *frames, only=""):
        folders = {f.rsplit("/", 1)[0] for frame in frames for f in frame.inputFiles()}
        gone.extend(f for f in folders if f.endswith(only))
        free(spark, *frames, only=only)

    monkeypatch.setattr(katz, "stored", stored)
    monkeypatch.setattr(katz, "freed", freed)
    found = katz.score(_docs(spark), F.col("doc_id") % 5 == 1, block_tokens=20)
    assert found.count() == len(DOCS)
    assert all(name == "katz-scores" for name, folders in made if folders - set(gone))
