"""Language-model scores against a context tree written out step by step."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridcast.llm import lm

TRAIN = ["the cat sat on the mat. the cat", "The dog  sat\non the log", None, "", "été à la mer", "the cat sat on the mat. the cat", "aaaa" * 60]
OTHER = ["the bat sat", None, "", "zzz été", " \t ", "the " * 3000, "日本"]


def paths(text):
    """(context of DEPTH bytes, bits before in the byte, bit) of each decision."""
    data = bytes(lm.DEPTH) + (text or "").encode()
    for i in range(lm.DEPTH, len(data)):
        bits = f"{data[i]:08b}"
        for k in range(8):
            yield data[i - lm.DEPTH:i], bits[:k], int(bits[k])


class Tree:
    def __init__(self, texts):
        self.n = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for text in texts:
            for context, before, bit in paths(text):
                for d in range(lm.DEPTH + 1):
                    self.n[context[lm.DEPTH - d:], before][bit] += 1
                    if d:
                        self.children[context[lm.DEPTH - d + 1:], before].add(context[lm.DEPTH - d:])
        self.memo = {}

    def own(self, context, before):
        a, b = self.n[context, before]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, context, before):
        key = context, before
        if key not in self.memo:
            own = self.own(*key)
            if len(context) == lm.DEPTH:
                self.memo[key] = own
            else:
                below = sum(self.weighted(child, before) for child in self.children[key])
                self.memo[key] = np.logaddexp(own, below) + math.log(0.5)
        return self.memo[key]

    def chance(self, context, before, bit, d=0):
        at = context[lm.DEPTH - d:], before
        if at not in self.n:
            return 0.5
        counts = self.n[at]
        here = (counts[bit] + 0.5) / (sum(counts) + 1)
        if d == lm.DEPTH:
            return here
        stop = math.exp(math.log(0.5) + self.own(*at) - self.weighted(*at))
        return stop * here + (1 - stop) * self.chance(context, before, bit, d + 1)


def split(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), ""]


@pytest.mark.parametrize("head", [1 << 20, 40, 0])
def test_against_the_tree_and_the_formula(spark, head):
    rows = [(i, t, True, "x") for i, t in enumerate(TRAIN)] + [(100 + i, t, False, "x") for i, t in enumerate(OTHER)] + [(None, "the cat", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean, score string")
    got = lm.score_texts(docs, head).collect()
    assert len(got) == len(rows)
    tree = Tree(TRAIN)
    counts = Counter(w for t in TRAIN for w in split(t))
    total, distinct = sum(counts.values()), len(counts)
    texts = {i: t for i, t, _, _ in rows}
    for r in got:
        text = texts[r["doc_id"]]
        tokens = split(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        model = sum(math.log10(tree.chance(*p)) for p in paths(text))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(model, rel=1e-9, abs=1e-9)
        size = len((text or "").encode())
        assert (r["bits_per_byte"] is None) if not size else r["bits_per_byte"] == pytest.approx(-model * math.log2(10) / size)
        assert r["held_out"] == (r["doc_id"] is None or r["doc_id"] >= 100)


def test_without_training(spark):
    docs = spark.createDataFrame([(1, "ab c", False)], "doc_id long, text string, train boolean")
    (r,) = lm.score_texts(docs).collect()
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)
    assert r["score"] == pytest.approx(-32 * math.log10(2))
    assert lm.score_texts(docs.limit(0)).count() == 0


def test_probabilities_of_a_byte_sum_to_one(spark):
    docs = spark.createDataFrame([(1, t, True) for t in TRAIN], "doc_id long, text string, train boolean")
    tree = lm.fit_tree(lm.gather(docs).where("kind = 0").select("key", "n"))
    for context in (int.from_bytes(b"the "), int.from_bytes(b"\0\0\0\0"), int.from_bytes(b"qqqq")):
        every = spark.range(256).selectExpr(f"{context}L * 256L + id as key", "0L as n")
        assert sum(10 ** r["value"] for r in lm.gram_scores(every, tree).collect()) == pytest.approx(1)


def test_held_out_texts_are_compressed(spark):
    got = lm.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("n_tokens > 50").collect()
    rate = lambda held: np.mean([r["bits_per_byte"] for r in got if r["held_out"] == held])
    assert 1 < rate(False) <= rate(True) < 3.2
