"""Embedding near-duplicates: spherical k-means cells, stored blocks of vectors, pairs of blocks compared.

Equal vectors are one node. Every node has a home cell, the one of the nearest
centre. Two vectors of cosine >= t lie at most 2 sin(arccos(t) / 2) apart, so along the
line between the centres of their homes their distances from the border add up to
at most that. Of two cells only the rows are compared whose distances can do so, which
loses no link; that is the default. Where the differences of linked vectors are known to
spread over all d axes alike, `spread` cuts the sum to that many standard deviations
of a random direction; on vectors of fewer directions such a cut loses links.

Rows are first compared by their components along the leading directions of a sample
and the lengths of what is left over, which bound the cosine from above; what may
be linked is compared in full, and near the least cosine in double precision.

The vectors are stored once, in blocks of neighbouring cells. A pair of blocks is a pair of
rows of a cross join that reads the stored blocks again instead of shuffling copies of
them, so the disk holds each vector a fixed number of times, however many cells it is compared
with. A task gives, for each row, the number of its links and one edge to a
representative of its linked group inside the task, never its pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import Sent, arrow_batches, components, setting, written

COSINE = 0.9
SAMPLE = 1 << 15  # distinct vectors that the centres are fitted on, about
SAMPLE_NUMBERS = 1 << 22  # numbers in these, at most
MOST_CELLS = 4096
ROUNDS = 8
BLOCK = 1024  # rows of a stored block, at least
BLOCK_BYTES = 1 << 22  # of the numbers in a stored block, about
BLOCK_CELLS = 64  # cells of a stored block, at most
BLOCKS = 24  # stored blocks, about, before they grow beyond BLOCK rows
TOGETHER = 16  # stored blocks that a task reads from each side, at most
LEADING = (16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768)  # numbers of a row that are compared first
TILE = (128, 2048)  # rows of either side that are compared at once
HELD = 1 << 18  # pairs that wait for their comparison in full, about


def widths(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column in one array, and how many of them each row has; a null row has none."""
    return column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths().fill_null(0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; components that are tiny or huge are scaled, so that squares stay finite."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1)[:, None] + 0.0
    return x / np.sqrt((x * x).sum(1))[:, None]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = max(1, (1 << 21) // len(centres))
    return np.concatenate([(x[a:a + step] @ centres.T).argmax(1) for a in range(0, len(x), step)])


def spherical_centres(x: np.ndarray, cells: int) -> np.ndarray:
    """Unit centres of k-means by cosine, from fixed rows spread over the sample."""
    centres = x[np.linspace(0, len(x) - 1, cells).astype(int)]
    for _ in range(ROUNDS):
        home = _nearest(x.astype(np.float32), centres.astype(np.float32))
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        norm = np.sqrt((sums * sums).sum(1))
        centres = np.where(norm[:, None] > 0, sums / np.maximum(norm, 1e-300)[:, None], centres)
    return centres


class Cells:
    """Centres, leading directions, the greatest sum of two distances from a border, and what single precision may lose."""

    def __init__(self, centres: np.ndarray, leading: np.ndarray, least: float, spread: float | None):
        d = centres.shape[1]
        self.centres, self.leading, self.least = centres.astype(np.float32), leading.astype(np.float32), least
        half = math.sin(math.acos(least) / 2)
        self.reach = 2 * (half if spread is None else min(half, spread * half / math.sqrt(d)))
        self.slack = 4 * (d + 8) * 2.0 ** -24

    def front(self, x: np.ndarray) -> np.ndarray:
        """Rows whose products are no smaller than those of `x`, but for `slack`."""
        if self.leading.shape[1] == x.shape[1]:
            return x
        first = x @ self.leading
        rest = np.sqrt(np.maximum(1 - (first * first).sum(1), 0) + np.float32(self.slack))
        return np.concatenate([first, rest[:, None]], axis=1)


def _leading(x: np.ndarray, least: float) -> np.ndarray:
    """As many leading directions of the sample as make the comparison cheapest, going by pairs of its rows; all: none is left over."""
    d = x.shape[1]
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    some = x[np.linspace(0, len(x) - 1, min(len(x), 1024)).astype(int)] @ axes
    best, cost = d, 0.026 * d
    for k in (n - 1 for n in LEADING if n < d):
        rest = np.sqrt(np.maximum(1 - (some[:, :k] ** 2).sum(1), 0))
        share = (some[:, :k] @ some[:, :k].T + rest[:, None] * rest[None, :] >= least).mean() - 1 / len(some)
        if 0.026 * (k + 1) + share * (100 + d) < cost:  # nanoseconds a pair, as measured
            best, cost = k, 0.026 * (k + 1) + share * (100 + d)
    return axes[:, :best] if best < d else np.eye(d)


def _fit(nodes: DataFrame, count: int, numbers: np.dtype, d: int, least: float, spread: float | None) -> Cells:
    share = min(1.0, min(SAMPLE, max(64, SAMPLE_NUMBERS // d)) / count)
    drawn = nodes.where(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    got = drawn.select("node", "v").toArrow().combine_chunks()
    x = unit(_rows(got.column("v").combine_chunks(), numbers))[np.argsort(got.column("node").to_numpy(), kind="stable")]
    cells = int(min(MOST_CELLS, max(1, math.isqrt(count)), len(x)))
    return Cells(spherical_centres(x, cells), _leading(x, least), least, spread)


def _rows(column: pa.Array, numbers: np.dtype) -> np.ndarray:
    """Vectors of one length that came as bytes."""
    joined = column.buffers()[2]
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(joined, np.uint8)[offsets[0]:offsets[-1]].view(numbers).reshape(len(column), -1)


class Block:
    """A stored block: its rows by cell, as stored and in single precision, and the distances from borders."""

    def __init__(self, row: dict, numbers: np.dtype, cells: Cells):
        self.node, self.copies = (np.frombuffer(row[k], np.int64) for k in ("node", "copies"))
        cell = np.frombuffer(row["cell"], np.int32)
        self.raw = np.frombuffer(row["v"], numbers).reshape(len(self.node), -1)
        self.cells, start = np.unique(cell, return_index=True)
        self.ends = np.append(start, len(cell))
        self.x = np.concatenate([unit(self.raw[a:a + 4096]).astype(np.float32) for a in range(0, len(cell), 4096)])
        self.front = cells.front(self.x)
        self.own = np.einsum("ij,ij->i", self.x, cells.centres[cell])

    def beyond(self, cells: Cells, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By other cell and row: distance from the border times that of the centres; by other cell and own cell: the least."""
        far = self.own[None, :] - cells.centres[others] @ self.x.T
        return far, np.minimum.reduceat(far, self.ends[:-1], axis=1)


class Found:
    """Links of the blocks that a task has met: numbers of linked rows and linked groups."""

    def __init__(self):
        self.at: dict[int, int] = {}
        self.node, self.copies, self.count, self.label = (np.zeros(0, np.int64) for _ in range(4))

    def place(self, number: int, block: Block) -> int:
        if number not in self.at:
            self.at[number] = start = len(self.node)
            self.node, self.copies = np.append(self.node, block.node), np.append(self.copies, block.copies)
            self.count = np.append(self.count, np.zeros(len(block.node), np.int64))
            self.label = np.append(self.label, np.arange(start, len(self.node)))
        return self.at[number]

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs of linked rows, each given once."""
        np.add.at(self.count, a, self.copies[b])
        np.add.at(self.count, b, self.copies[a])
        self.join(a, b)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            while ((up := self.label[self.label]) != self.label).any():
                self.label = up

    def table(self) -> pa.RecordBatch:
        rows = np.flatnonzero(self.count)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (self.node[rows], self.count[rows], self.node[self.label[rows]])], ["node", "n", "other"])


class Comparison:
    """All links between two blocks, or inside one."""

    def __init__(self, cells: Cells, left: Block, right: Block, at: tuple[int, int], found: Found):
        self.cells, self.left, self.right, self.at, self.found = cells, left, right, at, found
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def run(self) -> None:
        cells, left, right, same = self.cells, self.left, self.right, self.left is self.right
        far, least_far = left.beyond(cells, right.cells)
        back, least_back = (far, least_far) if same else right.beyond(cells, left.cells)
        one, other = (cells.centres[side.cells].astype(np.float64) for side in (left, right))
        gap = np.sqrt(np.maximum((one * one).sum(1)[:, None] + (other * other).sum(1) - 2 * one @ other.T, 0))
        most = (cells.reach + 1e-9) * gap + cells.slack
        near = least_far.T + least_back <= most
        shared = left.cells[:, None] == right.cells[None, :]
        near |= shared
        if same:
            near &= left.cells[:, None] <= right.cells[None, :]
        for i, j in np.argwhere(near):
            a, b = left.ends[i:i + 2], right.ends[j:j + 2]
            if shared[i, j]:
                self.tiles(np.arange(*a), np.arange(*b), within=same)
                continue
            mine, other = far[j, a[0]:a[1]], back[i, b[0]:b[1]]
            rows = np.flatnonzero(mine <= most[i, j] - least_back[i, j])
            cols = np.flatnonzero(other <= most[i, j] - least_far[j, i])
            if len(rows) > TILE[0]:  # rows far from the border meet those alone that are close to it
                rows, cols = rows[np.argsort(mine[rows])], cols[np.argsort(other[cols])]
                reached = np.searchsorted(other[cols], most[i, j] - mine[rows[::TILE[0]]], side="right")
                self.tiles(a[0] + rows, b[0] + cols, reached)
            elif len(rows) and len(cols):
                self.tiles(a[0] + rows, b[0] + cols)
        self.settle()

    def tiles(self, rows: np.ndarray, cols: np.ndarray, reached: np.ndarray | None = None, within: bool = False) -> None:
        """Compare rows with columns; the k-th TILE[0] rows with the first reached[k] columns; within: each pair once, no row with itself."""
        x, y = self.left.front[rows], self.right.front[cols].T
        bound = np.float32(self.cells.least - self.cells.slack)
        for k, a in enumerate(range(0, len(rows), TILE[0])):
            part = x[a:a + TILE[0]]
            for b in range(a // TILE[1] * TILE[1] if within else 0, len(cols) if reached is None else reached[k], TILE[1]):
                end = min(b + TILE[1], len(cols) if reached is None else reached[k])
                hits = part @ y[:, b:end] >= bound
                if within and b < a + TILE[0]:
                    hits &= np.arange(a, a + len(part))[:, None] < np.arange(b, end)[None, :]
                at = np.flatnonzero(hits)
                if not len(at):
                    continue
                if len(at) * 16 > hits.size:
                    self.crowded(rows[a:a + TILE[0]], cols[b:end], hits)
                else:
                    u, v = np.divmod(at, end - b)
                    self.held.append((rows[a + u], cols[b + v]))
                    self.waiting += len(at)
                    if self.waiting > HELD:
                        self.settle()

    def exact(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", unit(self.left.raw[u]), unit(self.right.raw[v])) >= self.cells.least

    def crowded(self, rows: np.ndarray, cols: np.ndarray, hits: np.ndarray) -> None:
        """Many of these may be linked."""
        cosine = self.left.x[rows] @ self.right.x[cols].T
        linked = hits & (cosine >= np.float32(self.cells.least - self.cells.slack))
        u, v = np.nonzero(linked & (cosine < np.float32(self.cells.least + self.cells.slack)))
        step = max(1, (1 << 20) // self.left.raw.shape[1])
        for a in range(0, len(u), step):
            p, q = u[a:a + step], v[a:a + step]
            linked[p, q] = self.exact(rows[p], cols[q])
        if not linked.any():
            return
        found, r, c = self.found, self.at[0] + rows, self.at[1] + cols
        for one, other, links in ((r, c, linked), (c, r, linked.T)):
            weight = found.copies[other]
            np.add.at(found.count, one, links.sum(1) if (weight == 1).all() else (links * weight[None, :]).sum(1))
        u, v = np.nonzero(linked & (found.label[r][:, None] != found.label[c][None, :]))
        found.join(r[u], c[v])

    def settle(self) -> None:
        """Compare in full what waits for it."""
        if not self.held:
            return
        u, v = (np.concatenate(side) for side in zip(*self.held))
        self.held, self.waiting = [], 0
        step = max(1, (1 << 20) // self.left.raw.shape[1])
        for a in range(0, len(u), step):
            p, q = u[a:a + step], v[a:a + step]
            cosine = np.einsum("ij,ij->i", self.left.x[p], self.right.x[q])
            linked = cosine >= np.float32(self.cells.least - self.cells.slack)
            near = np.flatnonzero(linked & (cosine < np.float32(self.cells.least + self.cells.slack)))
            linked[near] = self.exact(p[near], q[near])
            if linked.any():
                self.found.link(self.at[0] + p[linked], self.at[1] + q[linked])


def _block_rows(count: int, numbers: np.dtype, d: int) -> int:
    return max(BLOCK, min(-(-count // BLOCKS), BLOCK_BYTES // (numbers.itemsize * d)))


def _layout(sizes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block of each cell, and over how many it is dealt: neighbours share a block of at most `rows` rows, a larger cell has its own."""
    first, parts = np.zeros(len(sizes), np.int32), np.ones(len(sizes), np.int32)
    block, filled, held = 0, 0, 0
    for cell, size in enumerate(sizes):
        if held and (filled + size > rows or held == BLOCK_CELLS):
            block, filled, held = block + 1, 0, 0
        first[cell], parts[cell] = block, max(1, -(-size // rows))
        filled, held = filled + size, held + 1
        if parts[cell] > 1:
            block, filled, held = block + int(parts[cell]), 0, 0
    return first, parts


def blocks_of(nodes: DataFrame, cells: Cells, count: int, numbers: np.dtype, d: int) -> tuple[DataFrame, int]:
    """`nodes(node long, copies long, v binary)` written as one row per block, a file each, and how many there may be."""
    spark = nodes.sparkSession
    shared = Sent(spark, cells)  # at most MOST_CELLS centres

    def homes(batch: pa.RecordBatch, name: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        known = shared.value
        for a in range(0, batch.num_rows, 2048):
            part = batch.slice(a, 2048)
            yield part, _nearest(unit(_rows(part.column(name), numbers)).astype(np.float32), known.centres)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value.centres), np.int64)
        for batch in batches:
            for _, home in homes(batch, "v"):
                total += np.bincount(home, minlength=len(total))
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total[cell])], ["cell", "n"])

    sizes = np.zeros(len(cells.centres), np.int64)
    for cell, n in nodes.select("v").mapInArrow(tally, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():
        sizes[cell] = n
    first, parts = _layout(sizes, _block_rows(count, numbers, d))
    placing = Sent(spark, (first, parts))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, over = placing.value
        for batch in batches:
            for part, home in homes(batch, "v"):
                node = part.column("node").to_numpy()
                mixed = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                block = start[home] + (mixed % over[home].astype(np.uint64)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(block), part.column("node"), part.column("copies"), pa.array(home.astype(np.int32)), part.column("v")],
                                                 ["block", "node", "copies", "cell", "v"])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        cell = table.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        v = np.concatenate([_rows(c, numbers) for c in table.column("v").chunks if len(c)])
        held = [cell[order], *(table.column(k).to_numpy()[order] for k in ("node", "copies")), v[order]]
        return pa.table([pa.array([key[0].as_py()], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in held)], ["block", "cell", "node", "copies", "v"])

    placed = nodes.select("node", "copies", "v").mapInArrow(place, "block int, node long, copies long, cell int, v binary")
    with setting(spark, "spark.sql.files.maxRecordsPerFile", "1"):  # Parquet fills a page with many rows before it looks at its size
        packed = placed.groupBy("block").applyInArrow(pack, "block int, cell binary, node binary, copies binary, v binary")
        return written(packed, "blocks"), int((first + parts).max())


def link_rows(nodes: DataFrame, count: int, numbers: np.dtype, d: int, least: float = COSINE, spread: float | None = None) -> DataFrame:
    """(node, n, other) for `nodes(node long, copies long, v binary)`: partial numbers of linked
    rows and edges to a representative of the linked group; a node may have several rows or none.

    Each pair of blocks meets once, in the order that deals the pairs evenly.
    """
    spark = nodes.sparkSession
    cells = _fit(nodes, count, numbers, d, least, spread)
    blocks, many = blocks_of(nodes, cells, count, numbers, d)
    shared = Sent(spark, cells)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = shared.value, Found()
        held: dict[int, Block] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                pair = {}
                for side in ("a", "b"):
                    row = {k: batch.column(f"{side}_{k}")[i] for k in ("block", "cell", "node", "copies", "v")}
                    number = row.pop("block").as_py()
                    pair[number] = held.get(number) or pair.get(number) or Block({k: c.as_buffer() for k, c in row.items()}, numbers, known)
                    if side == "a":
                        one, held = number, {number: pair[number]}  # it comes again with others
                at = found.place(one, pair[one]), found.place(number, pair[number])
                Comparison(known, pair[one], pair[number], at, found).run()
        yield found.table()

    together = max(1, min(TOGETHER, many // 12))
    # Spark counts 4 MB for the opening of a file; a file of a block is not to be cut
    size = together * ((1 << 22) + _block_rows(count, numbers, d) * (numbers.itemsize * d + 20))
    sides = [blocks.select(*(F.col(c).alias(f"{side}_{c}") for c in blocks.columns)) for side in ("a", "b")]
    turn = F.when(F.pmod(F.col("a_block") + F.col("b_block"), F.lit(2)) == 1, F.col("a_block") < F.col("b_block")).otherwise(F.col("a_block") >= F.col("b_block"))
    with setting(spark, "spark.sql.files.maxPartitionBytes", str(size)), setting(spark, "spark.sql.files.minPartitionNum", "1"), arrow_batches(spark, 1):
        pairs = sides[0].join(sides[1].hint("shuffle_replicate_nl"), turn)
        return written(pairs.mapInArrow(compare, "node long, n long, other long"), "links")


def _keys(batches: Iterator[pa.RecordBatch], vectors: bool) -> Iterator[pa.RecordBatch]:
    """(vec_id, key, v) of `(vec_id, v)` rows: a key that rows share only if their scaled vectors are equal, null if they link with nothing."""
    for batch in batches:
        values, sizes = widths(batch.column(1))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        some = np.flatnonzero(sizes)
        top = np.zeros(len(sizes))
        if len(some):  # a null component comes as NaN
            top[some] = np.maximum.reduceat(np.abs(values).astype(np.float64), ends[some])
        usable = np.isfinite(top) & (top > 0) & np.asarray(batch.column(0).is_valid())
        scale = np.repeat(np.where(usable, top, 1.0), sizes)
        scaled = memoryview((values.astype(np.float64) / scale + 0.0).tobytes())
        keys = [hashlib.sha256(scaled[8 * a:8 * b]).digest() if ok else None for a, b, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), usable.tolist())]
        columns = [batch.column(0), pa.array(keys, pa.binary())]
        if vectors:
            raw, width = memoryview(values.tobytes()), values.itemsize
            columns.append(pa.array([raw[width * a:width * b] if ok else None for a, b, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), usable.tolist())], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "key", "v"][:len(columns)])


def near_vectors(vectors: DataFrame, least: float = COSINE, spread: float | None = None) -> DataFrame:
    """One row per row of `vectors(vec_id, embedding)`: vec_id, n_links, component_id, kept.

    n_links counts the other rows linked directly (cosine >= `least` in double
    precision), component_id is the smallest vec_id reached by links, kept says
    that the row is that one. A vector that is null, empty, zero, or holds a null or
    non-finite component links with nothing, and so does a row without an id
    (component_id null, kept). Rows of equal vectors are linked, also when they
    repeat an id. Vectors of different lengths never link. Other columns are
    ignored; an empty table gives no rows.
    """
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    numbers = np.dtype(np.float32 if single else np.float64)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("v"))
    keyed = rows.mapInArrow(lambda batches: _keys(batches, False), "vec_id long, key binary")
    good = rows.mapInArrow(lambda batches: _keys(batches, True), "vec_id long, key binary, v binary").where("key is not null")
    merged = written(
        good.groupBy("key").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.any_value("v").alias("v")), "vectors"
    )
    links = None
    for size, count in merged.groupBy(F.octet_length("v")).count().collect():  # vectors of one table have one length, or few
        found = link_rows(merged.where(F.octet_length("v") == size), count, numbers, size // numbers.itemsize, least, spread)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = vectors.sparkSession.createDataFrame([], "node long, n long, other long")
    found = written(components(links.select(F.col("node").alias("a"), F.col("other").alias("b"))), "components")
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    classes = merged.select("key", "node", "copies").join(counts, "node", "left").join(found, "node", "left").select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    linked = keyed.where("key is not null").join(classes, "key").select("vec_id", "n_links", "component_id")
    alone = keyed.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
