"""Components against a search from every node; chains must not take a round per node."""

from __future__ import annotations

import random

import pytest

from gridcast.llm import common


def brute(edges):
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    found = {}
    for start in sorted(near):
        if start not in found:
            todo = [start]
            while todo:
                x = todo.pop()
                if x not in found:
                    found[x] = start
                    todo += near[x]
    return found


def graphs():
    draw = random.Random(4)
    yield [(i, i + 1) for i in range(1500)]
    yield [(i + 1, i) for i in range(0, 1500, 2)] + [(7, i) for i in range(2000, 3000)]
    yield [(draw.randrange(400), draw.randrange(400)) for _ in range(230)] + [(None, 1), (1, None), (5, 5), (1 << 62, -3), (-3, -9)]
    yield []


@pytest.mark.parametrize("edges", list(graphs()))
def test_components(spark, monkeypatch, edges):
    steps = []
    plain = common.written
    monkeypatch.setattr(common, "written", lambda df, label: (steps.append(label), plain(df, label))[1])
    got = common.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == brute(edges)
    assert got.count() == len(brute(edges)) and steps.count("hook") <= 10
