"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, banding, exact verification.

A document is the multiset of its runs of SHINGLE words. Each shingle owns Poisson
processes of points on a time axis, one for each dyadic block of weights ([0,1),
[1,2), [2,4), ...), with a rate as large as the block. A point names a component of
the signature and a place inside its block, and counts where that place lies below
the shingle's weight. A component keeps the time of its first point. Two documents
agree in a component with probability equal to their weighted Jaccard similarity,
and a point later than all first points seen needs no look, so a signature costs
little more than one number per shingle.

Documents of equal words are one node. Nodes that share a band meet in a bucket;
each is verified, on its words, against the smallest node of the bucket. Where a
bucket then still holds several components, the nodes outside its largest one are
compared with all others of the bucket, block by block, so that no link between nodes
that share a band is lost, though no bucket gives out pairs. Texts that only hang
together by a chain of buckets are never compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import components, fresh, linked_rows, with_text_key, written
from gridcast.llm.rolling import ALNUM, Hasher, mix, numbers, pieces, runs, words
from gridcast.llm.tokens import text_bytes
from gridcast.operators.groups import join_small_groups

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 5  # a pair of similarity 0.8 shares no band with probability 3e-6
BLOCK = 256  # nodes of a bucket that are compared with as many others at a time
SALT_ROWS = 256  # members that are verified against one copy of their centre
LARGE_CLASS = 1000  # rows of a class, or nodes of a bucket, that is brought to its rows
BROADCAST_IDS = 4_000_000  # ids of 8 bytes that may be sent to every task
_COLUMNS = 4096
_HASH_BITS = 52
_MASK = np.uint64((1 << _HASH_BITS) - 1)
_TEXTS = 1 << (64 - _HASH_BITS)


def chunks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts short enough for one pass, at most _TEXTS of them."""
    for a, b in pieces(offsets):
        yield from ((i, min(b, i + _TEXTS)) for i in range(a, b, _TEXTS))


def shingles(hashes: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multisets of a run of texts: text, shingle (52 bits) and count, sorted by text and shingle.

    A text of fewer than SHINGLE words has one shingle, all its words.
    """
    sizes = np.diff(upto)
    ends = np.repeat(upto[1:], sizes)
    text = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    full = runs(hashes, SHINGLE)
    inside = np.arange(len(full)) + SHINGLE <= ends[:len(full)]
    keys = [text[:len(full)][inside] << np.uint64(_HASH_BITS) | full[inside] & _MASK]
    for n in range(1, SHINGLE):
        short = np.flatnonzero(sizes == n)
        if len(short):
            whole = runs(hashes, n)[upto[:-1][short]]
            keys.append(short.astype(np.uint64) << np.uint64(_HASH_BITS) | mix(whole + np.uint64(n)) & _MASK)
    every = np.sort(np.concatenate(keys))
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(every)))
    return (every[first] >> np.uint64(_HASH_BITS)).astype(np.int64), every[first] & _MASK, counts


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def bag_signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, size: int) -> np.ndarray:
    """n signatures of `size` first times each; rows of texts without shingles stay infinite."""
    weight = np.bincount(text, count, n)
    # one row per shingle and dyadic block of weights below its count
    levels = 1 + np.frexp(count - 1.0)[1]  # 1 -> 1, 2 -> 2, 3..4 -> 3, 5..8 -> 4
    block = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    text, shingle, count = (np.repeat(x, levels) for x in (text, shingle, count))
    low = np.where(block == 0, 0, 1 << np.maximum(block - 1, 0))
    width = np.maximum(low, 1).astype(np.float64)
    seed = mix(shingle + block.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    share = (count - low) / width  # places of the block below the count, all of it if 1 or more
    result = np.full((n, size), np.inf)
    with np.errstate(divide="ignore"):
        limit = (np.log(size) + 3) / weight
    todo = np.arange(n)[weight > 0]
    while len(todo):
        wanted = np.zeros(n, bool)
        wanted[todo] = True
        live = np.flatnonzero(wanted[text])
        when, step = np.zeros(len(live)), 0
        flat = result.reshape(-1)
        while len(live):
            step += 1
            drawn = mix(seed[live] + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            when = when - np.log(_uniform(drawn)) / (width[live] * size)
            early = when < limit[text[live]]
            live, when, drawn = live[early], when[early], drawn[early]
            other = mix(drawn ^ np.uint64(0xA0761D6478BD642F))
            component = (other >> np.uint64(32)) % np.uint64(size)
            counted = (other & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 < share[live]
            np.minimum.at(flat, text[live][counted] * size + component[counted].astype(np.int64), when[counted])
        todo = todo[np.isinf(result[todo]).any(1)]
        limit[todo] *= 2
    return result


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One number per signature and band; the number of the band is part of it."""
    bits = np.ascontiguousarray(signatures).view(np.uint64).reshape(len(signatures), BANDS, ROWS)
    total = np.tile(numbers(BANDS, 31), (len(signatures), 1))
    for i in range(ROWS):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return total


def signatures(rows: DataFrame) -> DataFrame:
    """(key, digest, bands) for `rows(key, text)`; digest and bands are null for a text without words."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(data, offsets):
                hashes, upto = words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], ALNUM, hasher)
                bands = band_keys(bag_signatures(*shingles(hashes, upto), b - a, BANDS * ROWS)).astype(np.int64)
                full = (np.diff(upto) > 0).tolist()
                digests = [hashlib.blake2b(hashes[i:j].tobytes(), digest_size=16).digest() if i < j else None
                           for i, j in zip(upto[:-1].tolist(), upto[1:].tolist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(digests, pa.binary()),
                    pa.array([row if some else None for row, some in zip(bands, full)], pa.list_(pa.int64())),
                ], ["key", "digest", "bands"])

    return rows.mapInArrow(sign, "key long, digest binary, bands array<long>")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted shingles, counts)."""
    place = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][place] == a[0]
    both = np.minimum(a[1][same], b[1][place[same]]).sum()
    return both / (a[1].sum() + b[1].sum() - both)


def _sendable(asked: DataFrame) -> DataFrame:
    """The distinct keys of `asked`, for a semi join; sent to every task if few enough."""
    ids = asked.select("key").distinct()
    return F.broadcast(ids) if asked.count() <= BROADCAST_IDS else ids


def verified(pairs: DataFrame, rows: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Those of `pairs(a, b)` whose texts in `rows(key, text)` are similar enough.

    The members b of a centre a are dealt out in groups of about SALT_ROWS; each
    group gets the centre's text once and is read in order, the centre first.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("parts"))
    salted = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("salt"), F.col("b").alias("key"), F.lit(1).alias("rank"))
    centres = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.col("a").alias("key"), F.lit(0).alias("rank"))
    asked = written(salted.unionByName(centres), "asked")
    texts = rows.join(_sendable(asked), "key", "left_semi")
    dealt = asked.join(texts, "key").repartition("a", "salt").sortWithinPartitions("a", "salt", "rank").select("a", "rank", "key", "text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, centre, name = Hasher(lower=True), None, None
        for batch in batches:
            data, offsets = text_bytes(batch.column(3))
            near: list[tuple[int, int]] = []
            a_of, rank_of, key_of = (batch.column(i).to_pylist() for i in range(3))
            for i, j in chunks(data, offsets):
                hashes, upto = words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], ALNUM, hasher)
                text, shingle, count = shingles(hashes, upto)
                bounds = np.searchsorted(text, np.arange(j - i + 1)).tolist()
                for k in range(i, j):
                    own = slice(bounds[k - i], bounds[k - i + 1])
                    if rank_of[k] == 0:
                        name, centre = a_of[k], (shingle[own], count[own])
                    elif name == a_of[k] and similarity(centre, (shingle[own], count[own])) >= least:
                        near.append((name, key_of[k]))
            columns = list(zip(*near)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return dealt.mapInArrow(check, "a long, b long")


def element_sets(text: np.ndarray, shingle: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The multisets as sets: the k-th copy of a shingle is an element of its own. Text and element, by text."""
    copy = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(text, count), mix(np.repeat(shingle, count) + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def block_links(left: list[np.ndarray], right: list[np.ndarray], least: float) -> np.ndarray:
    """Which sets of one block are similar to which of the other. Only elements of both blocks
    are looked at, a bounded number of them at a time."""
    sizes = [np.array([len(s) for s in side], np.float64) for side in (left, right)]
    of = [np.repeat(np.arange(len(side)), n.astype(int)) for side, n in zip((left, right), sizes)]
    elements = [np.concatenate(side) for side in (left, right)]
    common = np.intersect1d(*elements)
    both = np.zeros((len(left), len(right)), np.float32)
    place = [np.minimum(np.searchsorted(common, e), max(0, len(common) - 1)) for e in elements]
    kept = [np.flatnonzero(common[p] == e) if len(common) else np.zeros(0, int) for p, e in zip(place, elements)]
    for start in range(0, len(common), _COLUMNS):
        sides = []
        for side, (p, k, o) in enumerate(zip(place, kept, of)):
            mine = k[(p[k] >= start) & (p[k] < start + _COLUMNS)]
            dense = np.zeros((len(sizes[side]), min(_COLUMNS, len(common) - start)), np.float32)
            dense[o[mine], p[mine] - start] = 1
            sides.append(dense)
        both += sides[0] @ sides[1].T
    return both >= least * (sizes[0][:, None] + sizes[1][None, :] - both)


def mixed_buckets(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(family, node, component) for the buckets of `shared(band, node)` that hold several components.

    Buckets of the same nodes are one family. A bucket of two is left out: its one pair has been verified.
    """
    placed = shared.join(found, "node", "left").select(
        F.col("band").alias("family"), "node", F.coalesce("component", "node").alias("component"))
    several = placed.groupBy("family").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("name"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("other_name"),
    ).where("low != high and n > 2")
    single = several.groupBy("n", "name", "other_name").agg(F.min("family").alias("family")).select("family", "n")
    return _by_size(placed, written(single, "mixed"), "family").drop("n")


def _by_size(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """`rows` with `groups(key, n, ...)`: groups of more than LARGE_CLASS rows go to the rows, rows of the others are joined."""
    large = F.col("n") > LARGE_CLASS
    return rows.join(groups.where(~large), key).unionByName(join_small_groups(rows, groups.where(large), [key]))


def family_links(placed: DataFrame, rows: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Links across the components of each family of `placed(family, node, component)`, as edges (a, b).

    The nodes outside a family's largest component are compared with all the others,
    in blocks of about BLOCK nodes: a pair of blocks is one piece of work, which reads
    the texts of both and gives each linked node one edge to a representative.
    """
    sizes = placed.groupBy("family", "component").agg(F.count("*").alias("n"))
    families = sizes.groupBy("family").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n")).where("n > top.n").select(
        "family", "n", F.col("top.component").alias("main"), F.ceil(F.col("top.n") / BLOCK).cast("int").alias("mains"),
        F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("others"))
    dealt = _by_size(placed, written(families, "families"), "family").withColumn("outside", F.col("component") != F.col("main"))
    at = lambda count: F.pmod(F.xxhash64("node"), count).cast("int")
    dealt = dealt.withColumn("own", F.when(F.col("outside"), at(F.col("others"))).otherwise(F.col("others") + at(F.col("mains"))))
    every = F.sequence(F.lit(0), F.when(F.col("outside"), F.col("others") + F.col("mains")).otherwise(F.col("others")) - 1)
    asked = written(dealt.select(
        "family", "own", F.col("node").alias("key"), F.explode(every).alias("with")
    ).select("family", F.least("own", "with").alias("block"), F.greatest("own", "with").alias("other"),
             (F.col("own") >= F.col("with")).alias("second"), "key"), "asked")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, group, held = Hasher(lower=True), None, []

        def edges() -> Iterator[pa.RecordBatch]:
            if group is None:
                return
            same = group[1] == group[2]
            left = [(node, s) for second, node, s in held if same or not second]
            right = left if same else [(node, s) for second, node, s in held if second]
            if not left or not right:
                return
            linked = block_links([s for _, s in left], [s for _, s in right], least)
            nodes = np.array([node for node, _ in (left if same else left + right)])
            if not same:
                whole = np.zeros((len(nodes), len(nodes)), bool)
                whole[:len(left), len(left):] = linked
                whole[len(left):, :len(left)] = linked.T
                linked = whole
            top = linked_rows(linked)
            moved = np.flatnonzero(top != np.arange(len(top)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved], pa.int64()), pa.array(nodes[top[moved]], pa.int64())], ["a", "b"])

        for batch in batches:
            data, offsets = text_bytes(batch.column(5))
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(5))))
            for i, j in chunks(data, offsets):
                hashes, upto = words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], ALNUM, hasher)
                text, element = element_sets(*shingles(hashes, upto))
                bounds = np.searchsorted(text, np.arange(j - i + 1)).tolist()
                for k in range(i, j):
                    if keys[k][:3] != group:
                        yield from edges()
                        group, held = keys[k][:3], []
                    held.append((*keys[k][3:], element[bounds[k - i]:bounds[k - i + 1]]))
        yield from edges()

    columns = ["family", "block", "other", "second", "key"]
    texts = rows.join(_sendable(asked), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    dealt_out = asked.join(texts, "key").repartition("family", "block", "other").sortWithinPartitions(*columns)
    return dealt_out.select(*columns, "text").mapInArrow(compare, "a long, b long")


def near_classes(rows: DataFrame) -> DataFrame:
    """(key, class) for every row of `rows(key, text)`; class is the smallest key of its component."""
    signed = written(signatures(rows), "signatures")
    nodes = written(signed.where("digest is not null").groupBy("digest").agg(F.min("key").alias("node")), "nodes")
    first = signed.join(nodes, "digest").where("key = node").dropDuplicates(["digest"])
    banded = written(first.select("node", F.explode("bands").alias("band")), "bands")
    buckets = banded.groupBy("band").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    shared = written(_by_size(banded, written(buckets, "buckets"), "band").drop("n"), "shared")
    tried = written(shared.where("node != a").select("a", F.col("node").alias("b")).distinct(), "pairs")
    links = written(verified(tried, rows), "links")
    found = written(components(links), "components")

    placed = written(mixed_buckets(shared.select("band", "node"), found), "placed")
    links = links.unionByName(written(family_links(placed, rows), "links"))
    found = written(components(links), "components")
    classes = nodes.join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("class"))
    return signed.select("key", "digest").join(classes, "digest", "left").select("key", F.coalesce("class", "key").alias("class"))


def _classes(docs: DataFrame) -> DataFrame:
    """(key, doc_id, copies, class) for each different (id, text) of `docs(doc_id, text)`, and the keys of its rows."""
    keyed = with_text_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "key")
    found = near_classes(keyed.select("key", "text")).distinct()
    counted = keyed.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    return written(counted.join(found, "key"), "classes")


def _stand_ins(classes: DataFrame) -> DataFrame:
    """Per class its rows, its smallest id, and the key that stands for it: of that id, then the smallest."""
    return written(classes.groupBy("class").agg(
        F.sum("copies").alias("n_class"), F.min("doc_id").alias("class_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key"))["key"].alias("stands")), "sizes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of `docs(doc_id, text)`: doc_id, class_id, n_class (rows of the class), kept.

    class_id is the smallest doc_id that the row reaches by links of weighted
    Jaccard similarity >= 0.8; kept says that the row is that document. Texts of
    equal words (A-Z lowered, punctuation left out) are always linked. A null
    text, an empty one and one without words link with nothing. Texts of one to
    four words link with texts of the same words. A class is one of texts: rows that
    repeat an id and its text are all kept or not, rows of one id with different texts each have the class of
    their own text, and of several such rows that could stand for a class one text does. A row without an id links
    like any other but is never named: its class_id is the smallest id of its
    class, or null, and it is kept only in the latter case. Other columns of
    `docs` are ignored; an empty table gives no rows.
    """
    classes = _classes(docs)
    sizes = _stand_ins(classes)
    # a class of many texts is brought to them where they are; the others are joined
    large = F.col("n_class") > LARGE_CLASS
    small = classes.join(sizes.where(~large), "class")
    whole = small.unionByName(join_small_groups(classes, sizes.where(large), ["class"]))
    return whole.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "doc_id", "class_id", "n_class", (F.col("key") == F.col("stands")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stand for their class, one each; its columns stay as they are.

    A class is one of texts, as in `near_duplicates`. Of its rows the one of the smallest id stays, a null id
    coming last, and of several of that id one text by its hash; of rows equal in id and text the one whose
    other columns come first as JSON text, so that reruns agree.
    """
    key, rest = fresh(docs, "_key"), fresh(docs, "_rest")
    keyed = with_text_key(docs, key)
    single = written(_stand_ins(_classes(docs)).select(F.col("stands").alias(key)), "kept")
    # one id for each class; as in the comparisons, texts stay where they are while the ids are few enough to send
    kept = keyed.join(F.broadcast(single) if single.count() <= BROADCAST_IDS else single, key, "left_semi")
    repeated = keyed.groupBy(key).count().where("count > 1").join(single, key, "left_semi").select(key)
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    # rows that repeat an id and its text
    row = F.struct(*[F.col(c) for c in docs.columns])
    first = keyed.join(repeated, key, "left_semi").groupBy(key).agg(F.min_by(row, F.to_json(row)).alias(rest)).select(f"{rest}.*")
    return kept.join(repeated, key, "left_anti").select(*docs.columns).unionByName(first)
