"""Each stage of the pipeline against brute force on the smallest tables, and odd tables through all stages."""

from __future__ import annotations

import re
import shutil
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from gridcast.llm import records
from tests.llm.test_minhash import brute_classes
from tests.llm.test_mixing import stepwise
from tests.llm.test_records import plain

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    out, docs = [], spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        result = stage(spark, docs, FOLDER)
        assert name == "records" or result.columns == columns
        result.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        out.append((before.collect(), docs.collect()))
    return dict(zip([n for n, _ in corpus_pipeline.STAGES], out))


def test_language(steps):
    before, after = steps["language"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if r["text"] and any(c.isalpha() for c in r["text"])}


def test_near_duplicates(steps):
    before, after = steps["near_duplicates"]
    classes = brute_classes([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(set(classes.values()))


def test_decontamination(spark, steps):
    before, after = steps["decontamination"]
    flat = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [flat(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = [r["doc_id"] for r in before if not any(i in flat(r["text"]) for i in items)]
    assert len(clean) < len(before)
    assert sorted(r["doc_id"] for r in after) == sorted(clean)


def test_mixing(steps):
    before, after = steps["mixing"]
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in before:
        sizes[r["source"]] += size(r)
        largest[r["source"]] = max(largest[r["source"]], size(r))
    for r in after:
        taken[r["source"]] += size(r)
    assert all(abs(taken[s] - t) <= largest[s] for s, t in stepwise(dict(sizes)).items())
    assert max(Counter(r["doc_id"] for r in after).values()) <= 2
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}


def test_records(steps):
    before, after = steps["records"]
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before)
    texts, start = {r["doc_id"]: r["text"] for r in before}, 0
    for r in sorted(after, key=lambda r: r["start"]):
        ids = np.array([*plain(texts[r["doc_id"]]), records.END_ID], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


TEXT = "the cat of the house and that other one went over to the river by night"
ODD = [
    (None, TEXT, None, "a"), (None, TEXT, None, "a"), (3, TEXT, "en", "a"), (3, TEXT, "en", "a"), (4, None, "en", None), (5, "", "de", "b"),
    (6, "the thing was here and there", "en", None), (6, "der die das und nicht", "de", "b"), (None, None, None, None), (7, "w " * 50000, "en", "a"),
]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_tables(spark, tmp_path, rows):
    for name in ("benchmark", "labels"):
        shutil.copy(f"{FOLDER}/{name}.parquet", tmp_path)
    extra = ", ".join(f"{c} int" for c in ("_key", "_lang_pred", "_copies", "key", "size", "class", "epochs"))
    docs = spark.createDataFrame([(*r, *range(7)) for r in rows], f"doc_id long, text string, lang string, source string, {extra}")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, str(tmp_path))
        assert name == "records" or result.columns == docs.columns
        got = result.collect()
        if name == "language":
            assert Counter(r["doc_id"] for r in got) == ({None: 2, 3: 2, 6: 2, 7: 1} if rows else {})
        if name == "near_duplicates":
            assert Counter(r["doc_id"] for r in got) == ({3: 1, 4: 1, 5: 1, 6: 2, 7: 1, None: 1} if rows else {})
        if name in ("decontamination", "records"):
            assert len(got) == len(rows)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0 or rows
