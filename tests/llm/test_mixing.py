"""Mixing: targets by resharing step by step, budgets, repeats and odd rows."""

from __future__ import annotations

import random
import re

import pytest

from gridcast.llm.mixing import mix, source_targets


def stepwise(sizes):
    """Give weights 5, 2, 1 their share of 150 %, stop at twice the size, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, budget = {}, set(names), 1.5 * sum(sizes.values())
    while left:
        share = {s: budget * weight[s] / sum(weight[x] for x in left) for s in left}
        full = {s for s in left if share[s] >= 2 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
        left -= full
    return target


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


@pytest.fixture(scope="module")
def rows():
    sources = ["a"] * 60 + ["b"] * 20 + ["c"] * 10 + [None] * 8 + ["é"] * 30 + ["big"] * 70
    return [(i, " ".join(["w"] * (1 + i * 7 % 40)), s, "x") for i, s in enumerate(sources)]


def test_targets_and_budgets(spark, rows):
    got = mix(docs_of(spark, rows)).collect()
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text))
    want = stepwise(sizes)
    assert len(got) == len(rows)
    for source, size in sizes.items():
        own = [r for r in got if r["source"] == source]
        assert all(r["source_size"] == size for r in own)
        assert own[0]["target"] == pytest.approx(want[source])
        assert abs(sum(r["taken"] for r in own) - want[source]) <= 40
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in own)
        least, most = min(r["epochs"] for r in own), max(r["epochs"] for r in own)
        assert most - least <= 1  # whole passes first
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix(docs_of(spark, rows)).collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_targets_of_many_sources(spark, seed):
    draw = random.Random(seed)
    sizes = {f"s{i}": draw.choice([1, 30, 1000, 10**6]) * draw.randint(1, 9) for i in range(draw.randint(1, 25))} | {None: 50}
    got = source_targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")).collect()
    want = stepwise(sizes)
    assert {r["source"]: r["target"] for r in got} == pytest.approx(want)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_quality_is_preferred(spark):
    rows = [(i, "w w w w", s, "x") for i, s in enumerate(["a", "b", "c"] * 400)]
    labels = spark.createDataFrame([(i, (i // 3) % 2) for i in range(1200)] + [(None, 1), (5, 1)], "doc_id long, quality int")
    got = [r for r in mix(docs_of(spark, rows), labels).collect() if r["source"] == "c"]
    good = sum(r["epochs"] for r in got if (r["doc_id"] // 3) % 2 == 1)
    assert good > 1.3 * sum(r["epochs"] for r in got if (r["doc_id"] // 3) % 2 == 0)


def test_odd_rows(spark):
    rows = [(None, "a b", None, ""), (None, "a b", None, ""), (1, None, "s", ""), (2, "", "s", ""), (3, "x " * 20000, "s", ""), (3, "x", "t", "")]
    got = mix(docs_of(spark, rows)).collect()
    assert len(got) == 6
    assert {r["taken"] for r in got if r["size"] == 0} == {0}
    assert mix(docs_of(spark, [])).count() == 0
    only_empty = mix(docs_of(spark, [(1, None, "s", ""), (2, "", None, "")])).collect()
    assert [(r["target"], r["taken"]) for r in only_empty] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_id_spread_and_rerun_alike(spark, doc_id):
    rows = [(doc_id, f"w{i} " * (1 + i % 30), "a", "x") for i in range(300)] + [(1000 + i, "v " * 5, "b", "x") for i in range(300)]
    docs = docs_of(spark, rows).selectExpr("*", "text as note")
    chosen = [sorted((r["note"], r["epochs"]) for r in mix(d, also=("note",)).where("source = 'a'").collect())
              for d in (docs, docs.repartition(7, "note"), docs.orderBy("note", ascending=False))]
    assert chosen[0] == chosen[1] == chosen[2]
    # part of the source is taken once more
    assert {e for _, e in chosen[0]} == {1, 2}
