"""Decontamination: planted passages whole, with substitutions, cut, repeated; clean texts stay."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from gridcast.llm import decontaminate
from gridcast.llm.decontaminate import Seeds, find_overlaps

draw = random.Random(3)
WORDS = ["".join(draw.choice("abcdefghijkl") for _ in range(5)) for _ in range(5000)]
prose = lambda n: [draw.choice(WORDS) for _ in range(n)]
ITEMS = {i: prose(n) for i, n in enumerate([40, 25, 15, 12, 6, 3, 60])}
ITEM_ROWS = [(i, " ".join(w).capitalize() + ".", "x") for i, w in ITEMS.items()] + [(None, "a b c d e f g", "x"), (77, None, "x"), (78, "", "x")]


def around(words):
    return " ".join(prose(30) + words + prose(30))


def changed(words, every):
    return [w if i % every != every // 2 else "zzz" for i, w in enumerate(words)]


CASES = [
    (around(ITEMS[0]), {0}), (around(ITEMS[0]).upper(), {0}), (around(changed(ITEMS[0], 8)), {0}),
    (around(changed(ITEMS[6], 6)), {6}), (around(ITEMS[6][10:30]), {6}), (around(ITEMS[1] + ITEMS[2]), {1, 2}),
    (" ".join(ITEMS[3]), {3}), (around(ITEMS[4]), {4}), (around(ITEMS[5]), {5}), (around(ITEMS[5][:2]), set()), (around([ITEMS[5][0], 'zzz', ITEMS[5][2]]), set()), (around(ITEMS[0][:7]), set()),
    (around(changed(ITEMS[0], 2)), set()), (around([]), set()), (None, set()), ("", set()), (" ".join(ITEMS[2] * 50), {2}),
    ("\n".join(ITEMS[1]).replace("\n", ", "), {1}), (" ".join(prose(40000) + ITEMS[1]), {1}),
]


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_planted(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    docs = spark.createDataFrame([(i, t, 0) for i, (t, _) in enumerate(CASES)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame(ITEM_ROWS, "item_id long, text string, doc_id string")
    got = find_overlaps(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, k) for i, (_, want) in enumerate(CASES) for k in want}
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got})
    whole = next(r for r in got if r["doc_id"] == 0)
    assert (whole["n_equal"], whole["n_words"], whole["doc_word"], whole["item_word"]) == (40, 40, 30, 0)


def test_empty_sides(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    items = spark.createDataFrame(ITEM_ROWS, "item_id long, text string, doc_id string")
    assert find_overlaps(docs.limit(0), items).count() == 0
    assert find_overlaps(docs, items.limit(0)).count() == 0


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(None, around(ITEMS[1]))] * 2, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(ITEMS[1]))], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in find_overlaps(docs, items).collect()] == [(None, 1)] * 2


def test_substitutions_at_every_place():
    """Items of 5 to 25 words with every choice of a fifth of their words changed (400 choices drawn of
    more), found as the rule says: also one word too many for the whole, where a part may still do."""
    for n in range(5, 26):
        item = prose(n)
        block = Seeds([(1, " ".join(item).encode())])
        for k in (n // 5, n // 5 + 1):
            choices = list(combinations(range(n), k))
            for places in choices if len(choices) <= 400 else draw.sample(choices, 400):
                same = np.array([i not in places for i in range(n)])
                need = min(13, n)
                want = max((int(same[a:b].sum()) for a in range(n) for b in range(a + need, n + 1) if 5 * (~same[a:b]).sum() <= b - a), default=None)
                text = " ".join(["yyy"] * 3 + [w if s else "zzz" for w, s in zip(item, same)] + ["yyy"] * 3).encode()
                hashes, upto = decontaminate.words(
                    np.frombuffer(text, np.uint8), np.array([0, len(text)]), decontaminate.ALNUM, decontaminate.Hasher(lower=True))
                got = block.overlaps(hashes, upto)
                assert (got[0, 0][0] if got else None) == want, (n, places)


def test_long_stretches_hold_a_window_of_a_mask():
    """Every stretch of 13 to 25 words of which a fifth differ holds a mask, so none is missed."""
    for n, k in ((13, 2), (15, 3), (20, 4), (25, 5)):  # the lengths between them hold one of these
        same = np.ones((len(places := list(combinations(range(n), k))), n), bool)
        np.put_along_axis(same, np.array(places), False, 1)
        seen = np.zeros(len(same), bool)
        for mask in decontaminate.MASKS:
            used = [i for i, c in enumerate(mask) if c == "1"]
            for at in range(n - len(mask) + 1):
                seen |= same[:, [at + i for i in used]].all(1)
        # what no mask finds at once must hold a shorter stretch that counts, which is found
        for row in same[~seen]:
            assert any(5 * (~row[a:b]).sum() <= b - a and any(
                row[[at + i for i, c in enumerate(m) if c == "1"]].all() for m in decontaminate.MASKS for at in range(a, b - len(m) + 1))
                for a in range(n) for b in range(a + 13, n + 1))
