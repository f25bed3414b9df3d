"""Substring dedup against a table of all windows."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.llm import rolling, substrings
from gridcast.llm.common import written
from gridcast.llm.substrings import LENGTH, remove_repeats


def brute(rows):
    """Each window's first place, an id and a start; then the bytes of all windows at a later one."""
    first, found = {}, []
    for doc_id, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - LENGTH + 1):
            window = data[p:p + LENGTH]
            first[window] = min(first.get(window, (doc_id, p)), (doc_id, p))
    for doc_id, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - LENGTH + 1):
            if first[data[p:p + LENGTH]] < (doc_id, p):
                gone[p:p + LENGTH] = b"\1" * LENGTH
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def corpus(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé ") for _ in range(draw.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(60), prose(25)
    texts = [prose(draw.randint(0, 200)) for _ in range(12)]
    for _ in range(10):
        base = list(draw.choice(texts))
        for _ in range(draw.choice([0, 1, 3, 8])):
            if base:
                base[draw.randrange(len(base))] = draw.choice("xyz")
        texts.append("".join(base))
    texts += [prose(20) + passage + prose(draw.randint(0, 30)) for _ in range(12)]
    texts += [passage[draw.randint(0, 40):draw.randint(90, 300)] for _ in range(10)]
    texts += ["a" * 99, "a" * 100, "a" * 350, "ab" * 300, "abc" * 120 + "ab" * 90, line * 12, (line + "\n") * 7, "", None, "é" * 80, "é" * 49 + "ab", "é" * 50]
    draw.shuffle(texts)
    return [(i * 2 + 3, t) for i, t in enumerate(texts)]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, low int").repartition(5)


@pytest.mark.parametrize("seed, chunk", [(1, 1 << 21), (2, 300), (3, 150)])
def test_all_windows(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(rolling.pieces, "__defaults__", (chunk,))
    monkeypatch.setattr(substrings, "CHUNK_BYTES", chunk)
    rows = corpus(seed)
    got = sorted(map(tuple, remove_repeats(docs_of(spark, rows)).collect()))
    assert got == brute(rows)


def test_repeated_ids(spark, monkeypatch):
    """Rows that repeat an id, with equal texts, with others, and many of them; nothing is lost that occurs nowhere earlier."""
    draw = random.Random(6)
    rows = corpus(7)
    rows += [(draw.choice(rows)[0], t) for _, t in rows[:25]] + rows[:15] + [(11, t) for _, t in rows[30:45]]
    got = sorted(map(tuple, remove_repeats(docs_of(spark, rows)).collect()))
    assert got == sorted(brute(rows))


def test_odd_rows(spark):
    text = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    n = len(text)
    sizes = lambda rows: sorted(map(tuple, remove_repeats(docs_of(spark, rows)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans").collect()), key=repr)
    rows = [(None, text), (4, text), (4, text), (2, "x" + text), (None, None)]
    assert sizes(rows) == sorted([(None, n, n, 1), (4, n, n, 1), (4, n, n, 1), (2, n + 1, 0, 0), (None, 0, 0, 0)], key=repr)
    # content that occurs nowhere earlier stays, in each of the rows
    assert sizes([(4, text), (4, text)]) == [(4, n, 0, 0)] * 2
    assert sizes([(None, text), (None, text)]) == [(None, n, 0, 0)] * 2
    other = "".join(str(i * 7) + "q" for i in range(60))
    assert sizes([(3, text), (5, other + text), (5, "short")]) == sorted([(3, n, 0, 0), (5, n + len(other), n, 1), (5, 5, 0, 0)], key=repr)
    assert remove_repeats(docs_of(spark, [(1, "a")]).where("doc_id > 1")).count() == 0


def test_windows_by_the_bytes_around_their_anchor():
    """Two windows have one name if and only if their bytes are equal, wherever their stretches begin and end."""
    draw = random.Random(8)
    base = "".join(draw.choice("ab ") for _ in range(700))
    copies = [base, base[:300] + "x" + base[301:], "y" + base[13:500], base[5:], base[:340] + "zz" + base[300:]]
    data = np.frombuffer("".join(copies).encode(), np.uint8)
    bounds = np.cumsum([0, *map(len, copies)])
    text, low, high, anchor, short, _ = substrings.anchor_rows(data, bounds, rolling.Hasher(lower=False), substrings.LONG)
    low, high, anchor = (c + bounds[text] for c in (low, high, anchor))
    edges = substrings.around(data, low, high, anchor)
    count = high - low + 1
    row = np.repeat(np.arange(len(low)), count)
    skip = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    names = substrings.window_names(short[row], (anchor - low)[row], edges[row], skip)
    windows = [data[p:p + LENGTH].tobytes() for p in low[row] + skip]
    assert len(windows) == sum(max(0, len(c) - LENGTH + 1) for c in copies)
    assert len(set(zip(windows, names.tolist()))) == len(set(windows)) == len(set(names.tolist())) < len(windows)


def test_ranges_joined():
    of, low, high = (np.array(c) for c in ([0, 0, 0, 2, 2], [3, 8, 20, 0, 1], [7, 9, 20, 0, 30]))
    got = [c.tolist() for c in substrings.joined_ranges(of, low, high, 12)]
    assert got == [[0, 0, 2, 2, 2], [3, 20, 0, 12, 24], [9, 20, 11, 23, 30]]


def texts_with_edits(copies, edits):
    """Copies of a text, each with letters of its own changed at places of its own."""
    draw = random.Random(9)
    base = "".join(chr(draw.randint(97, 122)) for _ in range(4000))
    rows = []
    for i in range(copies):
        text = list(base)
        for p in draw.sample(range(len(text)), edits):
            text[p] = chr(0x400 + i)
        rows.append((i, "".join(text)))
    return rows


def test_windows_are_not_shuffled_one_by_one(spark, monkeypatch):
    """Of copies with edits, few windows need a row of their own; the results are those of all windows."""
    sizes, ranked = [], substrings._ranked

    def ranked_counted(rows, *kept):
        sizes.append(rows.count())
        return ranked(rows, *kept)

    monkeypatch.setattr(substrings, "_ranked", ranked_counted)
    rows = texts_with_edits(40, 12)
    got = sorted(map(tuple, remove_repeats(docs_of(spark, rows)).collect()))
    assert got == brute(rows)
    # an edit of two bytes is in 101 windows
    edited = 40 * 12 * 101
    assert sum(sizes[1:]) < edited / 2


def test_shuffle_files_go_when_a_step_is_written(spark, tmp_path):
    """The files of a step's shuffles are gone when the next one begins, though its frame is still held."""
    store = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = lambda: sum(1 for f in store.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f)
    rows = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").agg(F.sum("id").alias("n"))
    before, name = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    out = written(rows, "step")
    until = time.time() + 20
    while files() > before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before
    assert out.count() == 7 and spark.conf.get(name) == setting
