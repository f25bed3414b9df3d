"""Fill-in-the-middle against a transformation by regular expression, on texts of every alignment."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from gridcast.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    t = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    units = UNIT.findall(t)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if t == "" or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, t
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    draw = random.Random(11)
    yield from [None, "", " ", "\t\n", "a", " a", "a ", "a b", "<P> x", "x <S>", "a<M>b", "<P", "<S <P a <", "é ü  x", "\x85 \x1f a", "a" * 9000, "x y " * 40000, "🙂 🙂🙂 "]
    for _ in range(600):
        yield "".join(draw.choice(" \t\x0b\x0e\x08aé🙂<>PSM\x80\x00z") for _ in range(draw.randrange(40)))


def test_against_brute_force(spark):
    rows = [(i * 37 - 5 if i % 17 else None, t, "x", 1.5) for i, t in enumerate(texts())]
    rows += rows[:40]  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, _text double").repartition(3)
    got = fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("fim_text"), F.col("form"))).collect()
    seen = sorted(((r["doc_id"], r["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["fim_text"]) for r in got), key=repr)
    want = sorted(((i, t, *brute(i, t)) for i, t, *_ in rows), key=repr)
    assert seen == want
    assert all(r["back"] == (r["text"] or "") for r in got)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}


def test_digests(spark):
    docs = spark.createDataFrame([(7, "one two  three\n"), (None, None)], "doc_id long, text string")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in fim.digests(docs).collect():
        text = "one two  three\n" if r["doc_id"] == 7 else ""
        n, form, p, m, out = brute(r["doc_id"], text)
        assert tuple(r) == (r["doc_id"], n, form, p, m, sha(out), sha(text))
    assert fim.digests(docs.where("false")).collect() == []


def test_parameters(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "'a b c d' as text")
    forms = lambda **k: {r["form"] for r in fim.fill_in_middle(docs, **k).collect()}
    assert forms(fim_percent=0) == {"plain"} and forms(fim_percent=100, spm_percent=0) == {"psm"}
    assert forms(fim_percent=100, spm_percent=100) == {"spm"}


def test_select_inside_words():
    draw = np.random.default_rng(3)
    for _ in range(50):
        data = draw.integers(0, 256, draw.integers(0, 200)).astype(np.uint8)
        marks = fim.Marks(fim.char_starts(fim.words_of(data)))
        want = np.flatnonzero((data & 0xC0) != 0x80)
        assert (marks.place(np.arange(1, len(want) + 1)) == want).all()
        assert (marks.before(np.arange(len(data) + 1)) == [np.count_nonzero(want < i) for i in range(len(data) + 1)]).all()
