"""Near-duplicates against all pairs by exact weighted Jaccard similarity; signatures against theory."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from gridcast.llm import minhash


def multiset(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return Counter([("short", *words)]) if words else Counter()
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_classes(rows):
    """Smallest id of each component over all pairs."""
    label = {i: i for i, _ in rows}
    bags = {i: multiset(t) for i, t in rows}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in combinations(bags, 2):
        both, either = sum((bags[a] & bags[b]).values()), sum((bags[a] | bags[b]).values())
        if both and both / either >= 0.8:
            low, high = sorted((root(a), root(b)))
            label[high] = low
    return {i: root(i) for i in label}


def corpus(seed):
    """Chains of edited copies, exact copies, shared passages, repeated lines, odd texts."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(6):
        base = [word() for _ in range(draw.randint(30, 200))]
        for _ in range(8):
            texts.append(" ".join(base))
            for _ in range(draw.choice([1, 1, 2, 4])):
                base[draw.randrange(len(base))] = word()
    texts += [" ".join(passage + [word() for _ in range(draw.randint(10, 60))]) for _ in range(20)]
    line = "same line of words again "
    texts += [line * n for n in (3, 4, 30, 33, 40, 400)] + [line * 30] * 3
    texts += ["", None, "  .. ", "one two", "One, two!", "one two three", "x", texts[0].upper(), "w " * 20000]
    draw.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, key int, class string")


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs(spark, seed):
    rows = corpus(seed)
    got = minhash.near_duplicates(docs_of(spark, rows)).collect()
    want = brute_classes(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    sizes = Counter(want.values())
    assert all(r["n_class"] == sizes[r["class_id"]] and r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_odd_rows(spark):
    text = "a b c d e f g h i j"
    rows = [(None, text), (None, text), (4, text), (4, text), (9, None), (9, None), (None, "k l m n o p"), (None, None)]
    got = sorted(map(tuple, minhash.near_duplicates(docs_of(spark, rows)).select("doc_id", "class_id", "n_class", "kept").collect()), key=repr)
    assert got == sorted([
        (None, 4, 4, False), (None, 4, 4, False), (4, 4, 4, True), (4, 4, 4, True), (9, 9, 2, True), (9, 9, 2, True),
        (None, None, 1, True), (None, None, 1, True),
    ], key=repr)
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_one_id_with_several_texts(spark):
    x, y, z = "a b c d e f g h i j", "k l m n o p q r", "s t u v w x y z"
    rows = [(5, x), (3, y), (5, y), (9, x), (5, x), (2, None), (2, z), (None, z), (7, z + " "), (7, z)]
    got = sorted(map(tuple, minhash.near_duplicates(docs_of(spark, rows)).collect()), key=repr)
    assert Counter((a, b, n) for a, b, n, _ in got) == Counter({
        (5, 5, 3): 2, (9, 5, 3): 1, (3, 3, 2): 1, (5, 3, 2): 1, (2, 2, 1): 1, (2, 2, 4): 1, (None, 2, 4): 1, (7, 2, 4): 2})
    assert sum(kept for *_, kept in got) == 5  # the text of id 5 twice, since its rows are equal
    kept = minhash.keep_one(docs_of(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == sorted([(5, x), (3, y), (2, ""), (2, z)])
    assert all(set(r.asDict()) == {"doc_id", "text", "key", "class"} for r in kept)


def test_rows_of_one_id_and_nothing_in_common_all_stay(spark):
    rows = [(6, "a b c d e f"), (6, "u v w x y z"), (6, ""), (6, None)]
    assert sorted(r["text"] or "" for r in minhash.keep_one(docs_of(spark, rows)).collect()) == ["", "a b c d e f", "u v w x y z"]


def test_a_large_class(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LARGE_CLASS", 5)
    rows = [(i, "a b c d e f g") for i in range(30)] + [(i, f"{i} one two three four five") for i in range(30, 40)]
    got = minhash.near_duplicates(docs_of(spark, rows)).collect()
    assert {(r["doc_id"], r["class_id"], r["n_class"]) for r in got} == {(i, 0, 30) for i in range(30)} | {(i, i, 1) for i in range(30, 40)}


def test_signatures_estimate_weighted_similarity():
    shared = np.arange(1, 61, dtype=np.uint64) * np.uint64(7919)
    own = lambda k: np.arange(1, 21, dtype=np.uint64) * np.uint64(104729 + k)
    bags = [np.concatenate([shared, own(1)]), np.concatenate([shared, own(2)])]
    weights = [np.append(np.full(60, 7), np.full(20, 3)), np.append(np.full(60, 5), np.full(20, 1))]
    text = np.repeat([0, 1], 80)
    signed = minhash.bag_signatures(text, minhash.mix(np.concatenate(bags)), np.concatenate(weights), 2, 20000)
    truth = 60 * 5 / (60 * 7 + 20 * 3 + 20)
    assert abs((signed[0] == signed[1]).mean() - truth) < 0.015


def test_only_buckets_of_several_components_are_compared_again(spark):
    buckets = {1: [1, 2, 3], 2: [1, 4, 5], 3: [1, 4, 5], 4: [4, 5], 5: [*range(100, 100 + minhash.LARGE_CLASS), 9]}
    shared = spark.createDataFrame([(band, node) for band, nodes in buckets.items() for node in nodes], "band long, node long")
    joined = [(node, 1) for node in (1, 2, 3)] + [(node, 100) for node in buckets[5][:-1]]
    found = spark.createDataFrame(joined, "node long, component long")
    got = {}
    for row in minhash.mixed_buckets(shared, found).collect():
        got.setdefault(row["family"], []).append((row["node"], row["component"]))
    component = dict(joined)
    assert {family: sorted(nodes) for family, nodes in got.items()} == {
        band: sorted((node, component.get(node, node)) for node in buckets[band]) for band in (2, 5)}
