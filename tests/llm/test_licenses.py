"""License scans against a brute-force scan of the words."""

from __future__ import annotations

import re

from gridcast.llm import licenses
from gridcast.llm.licenses import TEMPLATES

TEXTS = [
    None, "", "   ", "CC BY", "cc-by cc by cc by 4.0", "x All Rights Reserved. all rights reserved, ALL RIGHTS",
    "This work is licensed under the GNU General Public License, version 3.", "general public", "license public general",
    "Licensed under the Apache License, Version 2.0.", "the apache license", "Released under the MIT License.",
    "é all rights reserved é", "all rightsé reserved", "ccby", "by cc by", "cc cc by by", "0" * 5000 + " cc by",
    "public license " * 3000 + "general public license", "redistribution and use in source and binary forms",
    "general  public\n\nlicense", "Creative Commons Attribution",
]


def brute(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for t in TEMPLATES:
        if t.base:
            n = len(t.key_words)
            found = [i for i in range(len(words) - n + 1) if words[i:i + n] == t.key_words]
            places += found
            labels |= {t.label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_columns(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, w string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text), text
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert (r["score"] > 0) == (r["labels"] != "")
    assert "mit" in got[11]["labels"] and "apache-2.0" in got[9]["labels"]
    assert {"gpl", "gpl-3.0"} <= set(got[6]["labels"].split(","))


def test_empty_table_and_repeats(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan_licenses(empty).count() == 0
    twice = spark.createDataFrame([(None, "cc by")] * 2, "doc_id long, text string")
    assert [r["n_base"] for r in licenses.scan_licenses(twice).collect()] == [1, 1]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = licenses.scan_licenses(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert all((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(r["text"]) for r in got)


def test_notices_that_begin_before_the_text(spark):
    texts = ["MIT License Copyright", "Apache License Version 2.0", "Mozilla Public License Version 2.0 text", "License MIT", "x"]
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r["doc_id"]: r["labels"] for r in rows}
    assert "mit" in got[0] and "apache-2.0" in got[1] and "mpl-2.0" in got[2] and got[3] == got[4] == ""
