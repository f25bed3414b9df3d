"""Hard negatives against all scores; bounds against the scores that they hold."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from gridcast.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, tree string, score int"


def brute(rows):
    usable = []
    for r, (i, v, label, *_) in enumerate(rows):
        if label is None or v is None or any(e is None or not math.isfinite(e) for e in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        usable.append((r, i, [math.floor(256 * float(np.float32(e))) for e in v], label))
    late = lambda i: (1 << 63) if i is None else i
    out = []
    for r, a, v, label in usable:
        if a is None or a % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), late(i), i, other) for q, i, w, other in usable if q != r), key=lambda s: s[:2])
        for p in [s for s in scored if s[3] == label][:5]:
            inside = [n for n in scored if n[3] != label and 80 * -p[0] <= 100 * -n[0] <= 100 * -p[0]]
            out += [(a, p[2], k + 1, n[2], -p[0], -n[0]) for k, n in enumerate(inside[:5])]
    return sorted(out, key=repr)


def vectors(n, d, labels, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, d))
    rows = []
    for i in range(n):
        v = (centres[draw.integers(12)] + 0.3 * draw.normal(size=d)).astype(np.float32)
        rows.append((i * 5 - 200, (v * draw.choice([0.1, 1.0, 3.0])).tolist(), int(draw.integers(labels)), "x", 1))
    return rows


def odd_rows(d):
    zero = [0.0] * d
    return [
        (None, [1.0] * d, 1, "", 0), (300, None, 1, "", 0), (400, [1.0] * d, None, "", 0), (500, [None] + [1.0] * (d - 1), 2, "", 0),
        (600, [float("nan")] * d, 2, "", 0), (700, [float("inf")] * d, 2, "", 0), (800, zero, 3, "", 0), (900, zero, 3, "", 0),
        (1001, zero, 4, "", 0), (1100, [1.0] * d, 1, "", 0), (1100, [1.0] * d, 1, "", 0), (1100, [2.0] * d, 5, "", 0), (100, [], 3, "", 0),
        (1200, [-1.0] * d, 4, "", 0), (1300, [0.5], 6, "", 0), (1302, [0.5] * d, 6, "", 0),
    ]


@pytest.mark.parametrize("n,d,labels,least_bin,group", [(700, 8, 4, 100, 3), (300, 3, 1, 64, 2), (400, 40, 300, 4096, 4096), (500, 2, 10, 50, 100)])
def test_against_brute_force(spark, n, d, labels, least_bin, group):
    rows = vectors(n, d, labels, n) + odd_rows(d)
    rows += rows[60:90]  # repeats, anchors among them
    random.Random(1).shuffle(rows)
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), least_bin, group).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_equal_vectors_and_empty_tables(spark):
    rows = [(i, [0.25, 0.5], i % 3, "", 0) for i in range(400)]
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), 50, 2).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    for few in (rows[:0], rows[1:3], rows[:1]):
        assert negatives.hard_negatives(spark.createDataFrame(few, SCHEMA)).collect() == []


def test_huge_components(spark):
    rows = [(0, [1e30, 1.0], 1, "", 0), (1, [1e30, -1.0], 1, "", 0), (2, [3.0, 2.0], 1, "", 0), (3, [1e30, 5.0], 2, "", 0), (5, [1e9, 1.0], 3, "", 0)]
    rows[0] = (100, *rows[0][1:])
    top = (1 << 63) - 1
    got = sorted(tuple(r) for r in negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(100, 1, 1, 3, top, top), (100, 1, 2, 5, top, top), (100, 2, 1, 3, top, top), (100, 2, 2, 5, top, top)]


def test_bounds_hold_and_spare_rows():
    draw = np.random.default_rng(5)
    anchors = np.floor(256 * (draw.normal(size=(40, 16)) * 0.02 + draw.normal(size=16)))
    rows = negatives.Rows(np.floor(256 * draw.normal(size=(3000, 16))))
    order, parent, edge = negatives.spanning_tree(anchors, np.zeros(40, int))
    assert sorted(order) == list(range(40)) and parent[order[0]] == -1
    place = np.empty(40, int)
    place[order] = np.arange(40)
    up = np.where(parent[order] >= 0, place[parent[order]], -1)
    scored = 0
    truth = rows.x @ anchors[order].T

    def wanted(i, low, high):
        assert (low <= truth[:, i]).all() and (truth[:, i] <= high).all()
        return np.flatnonzero(high >= np.partition(low, -5)[-5])

    for i, picked, scores in negatives.walk(rows, anchors[order], up, edge[order], wanted):
        scored += len(picked)
        assert (scores == truth[picked, i]).all() and np.isin(np.argsort(-truth[:, i])[:5], picked).all()
    assert scored < 0.2 * 40 * 3000  # anchors that are close spare nearly all rows
