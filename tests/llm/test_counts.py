"""Token rollups: signed changes, replays, failed attempts, and brute-force totals."""

from __future__ import annotations

import re
from collections import Counter

from tokenizers import Tokenizer

from gridcast.llm.counts import BPE, WORDS, TokenRollup, revised, roll_up, signed
from gridcast.llm.queries import tokenizer_path

ROWS = [
    ("a", "en", "one two  three"), ("a", "en", None), ("a", "en", ""), ("b", None, "x\ty\n"), (None, "en", "é " * 500),
    ("a", "en", "one two  three"), ("z", "en", None), ("b", "de", "   "), ("b", "de", "w" * 100000),
]
COUNTS = "source string, lang string, version string, n_tokens long"


def test_against_counts_of_each_text(spark, tmp_path):
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], "source string, lang string, text string, sign string")
    plain, want = Tokenizer.from_file(tokenizer_path()), Counter()
    for source, lang, text in ROWS:
        if text:
            for version, n in ((WORDS, len(re.findall(r"[^\x20\x09-\x0D]+", text))), (BPE, len(plain.encode(text, add_special_tokens=False).ids))):
                want[source, lang, version, "docs"] += 1
                want[source, lang, version, "tokens"] += n
    got = roll_up(docs, tokenizer_path(), str(tmp_path / "r")).collect()
    assert {(r["source"], r["lang"], r["version"]): (r["n_docs"], r["n_tokens"]) for r in got} == {
        k[:3]: (v, want[(*k[:3], "tokens")]) for k, v in want.items() if k[3] == "docs"
    }
    assert roll_up(docs.limit(0), tokenizer_path(), str(tmp_path / "empty")).count() == 0


def test_batches(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, COUNTS)
    first, second = frame([("a", "en", "v", 10), ("a", "en", "v", 5), (None, None, "v", None)]), frame([("a", "en", "v", 7), ("b", "en", "v", 1)])
    rollup = TokenRollup(spark, str(tmp_path / "r"))
    assert rollup.totals().count() == 0
    assert rollup.commit("one/1", signed(first, 1)) and not rollup.commit("one/1", signed(first, 1))
    assert rollup.commit("two", revised(first, second))
    assert sorted(map(tuple, rollup.totals().collect())) == [("a", "en", "v", 1, 7), ("b", "en", "v", 1, 1)]
    # a failed attempt leaves a folder without a success mark: it counts for nothing and is written again
    frame([("a", "en", "v", 100)]).withColumnRenamed("n_tokens", "x").write.parquet(rollup._folder("three"))
    (tmp_path / "r" / "batch-three" / "_SUCCESS").unlink()
    assert rollup.totals().count() == 2
    assert rollup.commit("three", signed(second, -1))
    assert rollup.totals().count() == 0
    assert sorted(map(tuple, TokenRollup(spark, rollup.path).totals().collect())) == []
