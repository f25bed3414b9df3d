"""Binary records: exact round trip against the tokenizer itself, damage, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridcast.llm import records, tokens
from gridcast.llm.queries import tokenizer_path
from gridcast.llm.tokens import PieceEncoder

PATH = tokenizer_path()
PLAIN, PIECES = Tokenizer.from_file(PATH), PieceEncoder(PATH)
ROWS = [
    (5, "Hello  world,\n\n it's 42   x"), (2, None), (9, ""), (7, " a  b"), (-3, "<|endoftext|> x <|endoftext|>y"),
    (None, "no id"), (5, "Hello  world,\n\n it's 42   x"), (11, "word " * 30000), (12, "日本 語 é à la"), (13, "a b \t c  d' s 's"),
]


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


MARKS = st.lists(st.sampled_from(["<|endoftext|>", " ", "\n", "a", ".", " b", "  ", "<", "|>"]), max_size=8).map("".join)


@settings(max_examples=100, deadline=None)
@given(st.lists(MARKS, min_size=1, max_size=4))
def test_added_tokens(texts):
    ids, counts = PIECES.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in plain(t)]
    assert counts.tolist() == [len(plain(t)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB '\n\t1.,-é×à  日🙂s\u00a0\x0b\x1c")), max_size=40), min_size=1, max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    ids, counts = PIECES.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in plain(t)]
    assert counts.tolist() == [len(plain(t)) for t in texts]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, offset string")


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "r")
    records.write_records(docs_of(spark, ROWS), path, PATH)
    index = sorted(records.read_index(spark, path).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in index]
    assert ids == [None, *sorted(r[0] for r in ROWS if r[0] is not None)]
    texts = {i: t for i, t in ROWS}
    start = 0
    for r in index:
        want = np.array([*plain(texts[r["doc_id"]]), records.END_ID], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)
    got = {r["doc_id"]: r["ids"] for r in records.read_records(spark, path).collect()}
    assert all(got[i] == [*plain(t), records.END_ID] for i, t in texts.items())
    some = records.read_index(spark, path).where("doc_id in (7, 12)").select("shard", "part", "offset")
    assert sorted(r["doc_id"] for r in records.read_records(spark, path, some).collect()) == [7, 12]


def test_many_shards_keep_the_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "SHARD_BYTES", 2000)
    rows = [(i * 7919 % 1009, f"text {i} " * (i % 9)) for i in range(300)]
    path = str(tmp_path / "r")
    records.write_records(docs_of(spark, rows), path, PATH)
    index = sorted(records.read_index(spark, path).collect(), key=lambda r: r["start"])
    assert len({r["shard"] for r in index}) > 3
    assert [r["doc_id"] for r in index] == sorted(i for i, _ in rows)
    assert [r["start"] for r in index] == np.cumsum([0, *(r["n_tokens"] for r in index)])[:-1].tolist()


@pytest.mark.parametrize("stretch", [1, 7, 1000, 1 << 20])
def test_files_are_walked_in_stretches(spark, tmp_path, monkeypatch, stretch):
    path = str(tmp_path / "r")
    rows = [r for r in ROWS if r[0] != 11] + [(11, "word " * 300)]
    records.write_records(docs_of(spark, rows), path, PATH)
    want = sorted(map(tuple, spark.read.parquet(f"{path}/index").collect()), key=str)
    monkeypatch.setattr(records, "_STRETCH", stretch)
    walked = records.walk_shards(spark, path)
    assert sorted(map(tuple, walked.collect()), key=str) == want and len(want) == len(rows)


def test_no_file_goes_to_python_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "_STRETCH", 1000)
    path = str(tmp_path / "r")
    records.write_records(docs_of(spark, ROWS), path, PATH)
    folder = tmp_path / "r" / "shards"
    whole = max(f.stat().st_size for f in folder.glob("part-*"))
    sizes = records.stretches(spark, path).selectExpr("length(content) as n").collect()
    assert whole > 10_000 and max(r.n for r in sizes) == 1000 and sum(r.n for r in sizes) == sum(
        f.stat().st_size for f in folder.glob("part-*"))


def test_a_file_cut_off_is_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    records.write_records(docs_of(spark, ROWS), path, PATH)
    file = max((tmp_path / "r" / "shards").glob("part-*"), key=lambda f: f.stat().st_size)
    damaged = tmp_path / "d" / "shards"
    damaged.mkdir(parents=True)
    (damaged / file.name).write_bytes(file.read_bytes()[:-3])
    monkeypatch.setattr(records, "_STRETCH", 1000)
    with pytest.raises(Exception, match="cut off"):
        records.walk_shards(spark, str(tmp_path / "d")).collect()


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "r")
    records.write_records(docs_of(spark, []), path, PATH)
    assert records.read_index(spark, path).count() == 0


def test_damage_is_seen():
    good = records.frame(3, np.array([1, 2, 70], np.uint32), 2) + b"\n"
    assert records.unframe(memoryview(good), 0)[0] == 3
    for i in range(len(good)):
        bad = bytearray(good)
        bad[i] ^= 4
        with pytest.raises(ValueError):
            records.unframe(memoryview(bytes(bad)), 0)
    with pytest.raises(ValueError):
        records.unframe(memoryview(good[:-1]), 0)


class Counting(PieceEncoder):
    """Notes every piece that is encoded."""

    def __init__(self, path):
        super().__init__(path)
        self.made = []

    def _new(self, pieces):
        self.made += pieces.to_pylist()
        return super()._new(pieces)


def encoded(encoder, texts):
    ids, counts = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in plain(t)]
    assert counts.tolist() == [len(plain(t)) for t in texts]


def test_pieces_that_come_again_stay_known(monkeypatch):
    monkeypatch.setattr(tokens, "_KNOWN_PIECES", 100)
    encoder = Counting(PATH)
    for i in range(40):
        encoded(encoder, ["ever über again " + " ".join(f"w{chr(97 + i % 26)}{'x' * j}" for j in range(i % 20, i % 20 + 12)) + " ñu"])
    assert len(encoder.known) < 200
    for piece in ("ever", " über", " again", " ñu"):
        assert encoder.made.count(piece) == 1


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(tokens, "_hashed", lambda known: np.zeros(len(known), np.uint64))
    encoder = PieceEncoder(PATH)
    for _ in range(3):
        encoded(encoder, ["one two three\0 three", "two  one", "×one ñoño " + "long" * 20 + " " + "y" * 22 + " " + "y" * 23])
