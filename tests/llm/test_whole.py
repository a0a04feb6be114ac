"""Whole jobs: what the operators do beyond the cases that the tables' SQL and labels show."""

import re
import textwrap

import harness
import numpy as np

from fieldgauge.llm import catalog, licenses, weak

SF01 = str(harness.TESTDATA / "sf0.1")


def test_toxic_texts_are_found_in_every_language(spark):
    kept = {r.doc_id: r.kept for r in catalog.op2_weak_quality(spark, SF01).select("doc_id", "kept").collect()}
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    # only labels that the labellers have not seen
    unseen = labels.where(~weak._picked("doc_id", "labelled", 0.5))
    rows = unseen.join(spark.read.parquet(f"{SF01}/documents.parquet"), "doc_id").select("doc_id", "lang", "quality", "toxic").collect()
    for lang in ("en", "de", "fr", "es"):
        dropped = [not kept[r.doc_id] for r in rows if r.lang == lang and r.toxic == 1]
        stayed = [kept[r.doc_id] for r in rows if r.lang == lang and (r.toxic, r.quality) == (0, 1)]
        print(lang, "toxic", sum(dropped), len(dropped), "good kept", sum(stayed), len(stayed))
        assert np.mean(dropped) > 0.85, lang
        assert np.mean(stayed) > 0.93, lang


MIT = licenses.TEMPLATES["MIT-permission"]
LICENSED = {
    "inside a line": ("Some tool. Released under the MIT License. Have fun with it.", ["MIT"]),
    "without marks": ("we hope that it helps you it is released under the mit license and so on and on", ["MIT"]),
    "in a comment block": (
        "# Copyright (c) 2020 Some Body\n#\n# " + "\n# ".join(textwrap.wrap(MIT, 60)) + "\n#\n# The above copyright notice and this\n# permission notice shall be included.\nint x;",
        ["MIT-permission"],
    ),
    "in a starred block": ("/*\n * Some tool\n *\n * " + "\n * ".join(textwrap.wrap(MIT, 50)) + "\n *\n * More words follow here.\n */", ["MIT-permission"]),
    "in one paragraph": ("Here is a program that I wrote. " * 9 + MIT + " And more is said here, at length." * 9, ["MIT-permission"]),
    "over paragraphs": (MIT.replace(", to deal", ",\n\nto deal"), ["MIT-permission"]),
    "two in a line": ("Code: released under the MIT License. Text: Licensed under CC BY-NC 4.0. Enjoy.", ["CC-BY-NC-4.0", "MIT"]),
    "of two alike, the one": (" Hello. " + licenses.TEMPLATES["AGPL-3.0"] + " Bye.", ["AGPL-3.0"]),
    "a sentence with words more": ("Hello there. Released publicly under the MIT License. Bye now.", []),
    "none": ("Permission is hereby asked to release it under any license, free of charge.", []),
}


def test_notices_inside_longer_units(spark):
    rows = [(k, t) for k, (t, _) in LICENSED.items()]
    found = {r.k: r for r in licenses.scan(spark.createDataFrame(rows, "k string, text string")).collect()}
    assert {k: r.licences for k, r in found.items()} == {k: names for k, (_, names) in LICENSED.items()}
    assert {k: r.n_matches for k, r in found.items()} == {k: len(names) for k, (_, names) in LICENSED.items()}
    assert found["inside a line"].dice == 1.0 == found["in a comment block"].dice


def test_the_bounds_lose_nothing(spark):
    """Against a plain version that compares every unit and window with every template."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{harness.TESTDATA}/sf0.001/documents.parquet").collect()]
    docs += [(10**9 + i, t) for i, (t, _) in enumerate(LICENSED.values())]
    found = {r.doc_id: r.licences for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k, text in docs:
        words = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
        grams = list(zip(words, words[1:], strict=False))
        names = set()
        for name, template in licenses.TEMPLATES.items():
            own = re.sub(r"[\W_]+", " ", template.lower()).split()
            wanted = set(zip(own, own[1:], strict=False))
            for i in range(len(grams)):
                part = set(grams[i : i + len(own) - 1])
                if 2 * len(part & wanted) >= 0.8 * (len(part) + len(wanted)):
                    names.add(name)
        # a place that is like two templates counts for one of them
        assert bool(names) <= bool(found[k]), (k, names, found[k])
        if len(names) == 1:
            assert names <= set(found[k])
