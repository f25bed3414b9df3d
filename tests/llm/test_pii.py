"""Personal data against plain regular expressions and a graph scored in Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
import regex

from gridcast.llm import pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def stands(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    return [(k, kind, m.start(), m.end(), m.group()) for k, kind in enumerate(pii.KINDS)
            for m in re.finditer(RULES[kind], text or "") if stands(kind, m.group())]


def patterns(gap, rest):
    words = lambda t: [w for w in regex.split(r"[^\p{L}]+", t.lower()) if w]
    left, right = (["^", "^"] + words(gap[-pii.BEFORE:]))[-2:], (words(rest[:pii.AFTER]) + ["$"])[0]
    return [] if left[1] == "^" else [f"l:{left[0]} {left[1]}", f"f:{left[1]}_{right}"]


def brute(texts, rounds=3, support=3, confidence=0.8):
    seeds, unseen, marks = defaultdict(set), defaultdict(set), []
    for row, text in enumerate(texts):
        text = text or ""
        base = base_spans(text)
        marks += [(row, *b[:4], True, b[4].lower()) for b in base]
        for k, kind in enumerate(pii.KINDS):
            for rule, is_base in ((RULES[kind], True), (pii.LOOSE[kind], False)):
                hits, at = list((re if is_base else regex).finditer(rule, text)), 0
                for j, m in enumerate(hits):
                    rest = text[m.end():hits[j + 1].start() if j + 1 < len(hits) else len(text)]
                    around = patterns(text[at:m.start()], rest)
                    at, value = m.end(), m.group().lower()
                    if is_base and stands(kind, m.group()):
                        for p in around:
                            seeds[k, p].add(value)
                    elif not is_base and not any(b[2] < m.end() and m.start() < b[3] for b in base):
                        marks.append((row, k, kind, m.start(), m.end(), False, value))
                        for p in around:
                            unseen[k, p].add(value)
    score = {(k, v): 0 for (k, _), vs in unseen.items() for v in vs}
    for _ in range(rounds):
        mean = {}
        for (k, p), vs in unseen.items():
            weight = 10**6 * len(seeds[k, p]) + sum(score[k, v] for v in vs)
            mean[k, p] = weight // (len(seeds[k, p]) + len(vs)) if weight >= support * 10**6 else 0
        score = {key: max(mean[k, p] for (k, p), vs in unseen.items() if k == key[0] and key[1] in vs) for key in score}
    out = []
    for row in range(len(texts)):
        own = sorted((k, s, e, b, kind) for r, k, kind, s, e, b, v in marks if r == row and (b or score.get((k, v), 0) >= confidence * 10**6))
        out.append([(kind, s, e, b) for k, s, e, b, kind in own])
    return out


ODD = [
    None, "", " ", "a@b.c", "a@b", "a@b@c.d", "a@b.c%x@y.z", "a@b.com_x@y.z", "é@b.c josé@x.org", "..@-.-", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 0000.00255.1.1",
    "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 1", "4111111111111112", "0000000000000", "+1 (743) 555-3824", "+1-2", "+12345678", "+1 2 3 4 5 6 7 8 9 ",
    "+1 4111 1111 1111 1111", "🙂 a@b.cc 🙂 +1 (743) 555-3824.", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1", "x" * 20000, "1" * 20000, "a@" + "b." * 20000 + "c", "1.2.3.4 " * 3000,
]


def taught():
    draw = random.Random(13)
    rows = [f"Please write to user{i}@host{i}.org today" for i in range(12)]
    rows += ["please write to root@localhost today", "Or write to: root@localhost, today!", "we saw root@localhost once"]
    rows += [f"call me on +1 (743) 555-{1000 + i} now" for i in range(8)] + ["call me on 743 555 1999 now", "the number 743 555 2888 is", "dial quickly 743 555 1999 x"]
    rows += [f"dial quickly 743 555 {i} x" for i in range(3000, 3003)] + [f"count the 10.0.0.{i} of" for i in range(2)] + ["count the 1-2-3-4 of"]
    rows += [f"pay with {draw.randrange(10**15, 10**16)} then" for _ in range(30)]
    return rows


def expected(doc_id, spans):
    text = lambda some: ",".join(f"{k}:{s}:{e}" for k, s, e, _ in some)
    base = [s for s in spans if s[3]]
    return (doc_id, *[sum(s[0] == kind for s in base) for kind in pii.KINDS], hashlib.sha256(text(base).encode()).hexdigest(), text(spans))


def check(spark, texts, **how):
    rows = [(i // 2 if i % 9 else None, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, row int").repartition(3)
    want = sorted((expected(r[0], s) for r, s in zip(rows, brute(texts))), key=repr)
    assert sorted((tuple(r) for r in pii.digests(docs).collect()), key=repr) == want
    return want


def test_against_brute_force(spark):
    texts = ODD + taught() + ODD[:20] + taught()[:5]
    want = check(spark, texts)
    spans = brute(texts)
    found = {texts[i][s:e] for i, some in enumerate(spans) for _, s, e, b in some if not b}
    assert {"root@localhost", "743 555 1999"} <= found and "743 555 2888" not in found and "1-2-3-4" not in found
    assert len(want) == len(texts)


def test_random_texts(spark):
    draw = random.Random(5)
    pool = ["a@b.c", "@", ".", "+", "1", "22", "333", "4111", "-", " ", "é", "call", "me", " (", ")", "x@y", "%", "_", "🙂", "1.2.3.4", "to ", "+1 743"]
    check(spark, ["".join(draw.choice(pool) for _ in range(draw.randrange(30))) for _ in range(800)])


def test_empty_table(spark):
    assert pii.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_in_the_plan(spark):
    plan = pii.digests(spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.split("Physical Plan")[1])


@pytest.mark.parametrize("support,confidence,some", [(3, 0.8, True), (100, 0.8, False), (3, 1.0, False)])
def test_thresholds(spark, support, confidence, some):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(taught())], "doc_id long, text string")
    spans = pii.find_pii(docs, support=support, confidence=confidence).selectExpr("inline(spans)")
    assert (spans.where("not base").count() > 0) == some
