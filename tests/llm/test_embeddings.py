"""Embedding near-duplicates against all pairs."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from gridcast.llm import embeddings
from gridcast.llm.embeddings import near_vectors


def brute(rows, least=0.9):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = sorted(good)
    x = np.stack([good[i] / np.linalg.norm(good[i]) for i in ids])
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    label = np.arange(len(ids))
    for _ in ids:
        low = np.minimum(label, np.where(linked, label[None, :], len(ids)).min(1))
        if (low == label).all():
            break
        label = low
    found = {i: (0, i, True) for i, _ in rows}
    found.update({i: (int(linked[k].sum()), ids[label[k]], label[k] == k) for k, i in enumerate(ids)})
    return found


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, i, "x") for i, v in rows], "vec_id long, embedding array<float>, label long, node string")


def clusters(seed, d, n):
    draw = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        base = draw.normal(size=d)
        rows += [base + draw.normal(size=d) * s for s in draw.choice([0, 0.1, 0.3, 0.45], draw.integers(1, 9))]
    rows += [rows[0]] * 40 + [rows[0] * 3.5] * 3
    order = draw.permutation(len(rows))
    return [(int(i) * 2 + 1, [float(np.float32(e)) for e in rows[k]]) for i, k in enumerate(order)]


def got_of(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.mark.parametrize("seed, d, block", [(1, 64, 1024), (2, 8, 16), (3, 3, 8)])
def test_all_pairs(spark, monkeypatch, seed, d, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = clusters(seed, d, 60)
    want = brute(rows)
    assert got_of(near_vectors(vectors_of(spark, rows), spread=None)) == want
    links = sum(n for n, _, _ in want.values())
    got = got_of(near_vectors(vectors_of(spark, rows)))
    assert sum(n for n, _, _ in got.values()) >= 0.99 * links
    assert all(got[i][0] <= want[i][0] for i in want)


def test_few_directions(spark):
    """768 columns whose variance lies in 8 directions, pairs planted close to the least cosine."""
    draw = np.random.default_rng(7)
    axes = np.linalg.qr(draw.normal(size=(768, 8)))[0].T
    bases = draw.normal(size=(400, 8))
    other = draw.normal(size=bases.shape)
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    bases, other = unit(bases), unit(other - (other * unit(bases)).sum(1)[:, None] * unit(bases))
    close = draw.uniform(0.9, 0.93, (400, 1))
    x = np.concatenate([bases, close * bases + np.sqrt(1 - close ** 2) * other]) @ axes
    rows = [(i, [float(np.float32(e)) for e in v]) for i, v in enumerate(x)]
    assert got_of(near_vectors(vectors_of(spark, rows))) == brute(rows)


def test_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert got_of(near_vectors(vectors)) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0]),
            (9, [1e-30, 2e-30]), (10, [1e30, 2e30]), (11, [-1.0, -2.0]), (12, [1.0, 2.0, 0.0]), (13, [-0.0, 1.0]), (14, [0.0, 1.0])]
    got = got_of(near_vectors(vectors_of(spark, rows)))
    assert {i: got[i] for i in (2, 3, 4, 5, 6, 7, 11, 12)} == {i: (0, i, True) for i in (2, 3, 4, 5, 6, 7, 11, 12)}
    near = {1, 8, 9, 10}
    assert all(got[i] == (3, 1, i == 1) for i in near)
    assert got[13] == (1, 13, True) and got[14] == (1, 13, False)
    assert near_vectors(vectors_of(spark, [])).count() == 0
    twice = near_vectors(vectors_of(spark, [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 0.0])])).collect()
    assert sorted(map(tuple, twice), key=repr) == [(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True)]


DISK = """
import sys
sys.path.insert(0, sys.argv[1])
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from gridcast.llm.embeddings import near_vectors
spark = SparkSession.builder.master("local[4]").config(map={
    "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": sys.argv[2] + "/shared",
    "spark.local.dir": sys.argv[2] + "/local", "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + sys.argv[2] + "/events",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}).getOrCreate()
x = np.random.default_rng(11).normal(size=(8000, 64)).astype(np.float32)
x[7000:] = x[:1000] * 2 + np.float32(0.01)
ids = pa.array(np.arange(8000))
vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, 8001 * 64, 64, dtype=np.int32)), pa.array(x.ravel()))
pq.write_table(pa.table({"vec_id": ids, "embedding": vectors}), sys.argv[2] + "/in.parquet")
print("links", near_vectors(spark.read.parquet(sys.argv[2] + "/in.parquet")).groupBy().sum("n_links").first()[0])
spark.stop()
"""


def test_disk(tmp_path):
    """Vectors without clusters: what all steps write and shuffle is a few times the input, not a copy for each cell that is compared."""
    (tmp_path / "events").mkdir()
    repo = str(Path(__file__).resolve().parents[2])
    ran = subprocess.run([sys.executable, "-c", DISK, repo, str(tmp_path)], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert "links 2000" in ran.stdout
    ends = [e for p in (tmp_path / "events").iterdir() for e in map(json.loads, p.open()) if e["Event"] == "SparkListenerTaskEnd"]
    moved = sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] + e["Task Metrics"]["Disk Bytes Spilled"] for e in ends)
    stored = sum(p.stat().st_size for p in (tmp_path / "shared").rglob("*.parquet"))
    assert moved + stored < 6 * (tmp_path / "in.parquet").stat().st_size


@pytest.mark.parametrize("d, wide", [(64, False), (64, True), (5, False)])
def test_blocks(spark, monkeypatch, d, wide):
    """Cells dealt over several blocks, blocks of several cells, crowded and sparse tiles, doubles as they are."""
    monkeypatch.setattr(embeddings, "BLOCK", 48)
    monkeypatch.setattr(embeddings, "TILE", (8, 16))
    monkeypatch.setattr(embeddings, "BLOCK_CELLS", 3)
    draw = np.random.default_rng(d)
    centre, rows = draw.normal(size=d), clusters(5, d, 40)
    top = max(i for i, _ in rows)
    rows += [(top + 1 + i, [float(np.float32(e)) for e in centre + draw.normal(size=d) * 0.12]) for i in range(250)]
    kind = "double" if wide else "float"
    vectors = spark.createDataFrame([(i, [e * (1 + 1e-12) for e in v] if wide else v) for i, v in rows], f"vec_id long, embedding array<{kind}>")
    assert got_of(near_vectors(vectors)) == brute(rows)


def test_layout():
    first, parts = embeddings._layout(np.array([3, 4, 0, 25, 9, 1, 1]), 10)
    assert first.tolist() == [0, 0, 0, 1, 4, 4, 5] and parts.tolist() == [1, 1, 1, 3, 1, 1, 1]
    first, _ = embeddings._layout(np.zeros(130, int), 10)
    assert np.bincount(first).tolist() == [64, 64, 2]


def test_front():
    """Products of the leading components are never below the cosine."""
    draw = np.random.default_rng(3)
    x = embeddings.unit(draw.normal(size=(600, 200)) * np.geomspace(1, 0.02, 200))
    cells = embeddings.Cells(x[:4], embeddings._leading(x, 0.9), 0.9, None)
    assert cells.leading.shape[1] < 200
    front = cells.front(x.astype(np.float32))
    assert (front @ front.T >= x @ x.T - cells.slack).all()
