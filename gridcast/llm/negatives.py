"""Hard-negative mining with score bounds along spanning trees of anchors.

Anchors are a stated query set, scored against all rows in blocks: rows are dealt
over bins, anchors over groups, and each (bin, group) is one task of bounded size.
The anchors of a group form a spanning tree of short edges. The score of a child
differs from its parent's by the inner product of the edge with the candidate, so
it lies within the parent's score (or the parent's bounds, where the parent did not
score the candidate) plus or minus edge length times candidate norm. A child
scores only the candidates whose bounds overlap what it looks for: first the best
scores among rows of its label, then the score windows below each of its positives.
A task returns a fixed number of rows for each anchor and window.

Edges prefer anchors of one label, since a row that one of them looks for is of use to the
others. Trees are at most `DEEPEST` edges deep, which bounds the bounds held at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import written

# fixed values: which rows are anchors or change their label, how many rows are wanted, and the lowest share of a window
ANCHORS_EVERY, RELABELLED_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES, LOWEST_PERCENT = 5, 5, 80
SCALE = 256.0  # components are whole numbers of 1/256
LEAST_BIN, LARGEST_BIN, GROUP = 1024, 16384, 2048
DEEPEST = 16

_EXACT = float(1 << 53)
_LARGEST = (1 << 63) - 1
_ENDS = float(1 << 63)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(column), width).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def spanning_tree(x: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors in the order they join (Prim), the parent of each (-1: the root) and the length of its edge."""
    n = len(x)
    with np.errstate(over="ignore", invalid="ignore"):
        length = np.sqrt(np.maximum(((x - x[0]) ** 2).sum(1), 0))
        cost = np.where(label == label[0], 0.0, 1e300) + np.nan_to_num(length, posinf=1e299)
    parent, depth, open_ = np.zeros(n, np.int64), np.ones(n, np.int64), np.ones(n, bool)
    order = np.zeros(n, np.int64)
    parent[0], depth[0], open_[0] = -1, 0, False
    length[0] = 0.0
    for step in range(1, n):
        i = int(np.where(open_, cost, np.inf).argmin()) if open_.any() else 0
        order[step], open_[i] = i, False
        if depth[i] < DEEPEST:
            with np.errstate(over="ignore", invalid="ignore"):
                far = np.sqrt(((x - x[i]) ** 2).sum(1))
                own = np.where(label == label[i], 0.0, 1e300) + np.nan_to_num(far, posinf=1e299)
            near = open_ & (own < cost)
            cost[near], length[near], parent[near], depth[near] = own[near], far[near], i, depth[i] + 1
    return order, parent, length


class Rows:
    """Candidates of one bin: exact scores, and bounds on them from a parent's."""

    def __init__(self, x: np.ndarray):
        self.x = x
        with np.errstate(over="ignore"):
            self.norm = np.sqrt((x * x).sum(1))
        self.top = np.abs(x).max(initial=0.0)

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products of whole numbers, by doubles where all sums are exact in them."""
        picked = self.x if len(rows) == len(self.x) else self.x[rows]
        if self.top * np.abs(anchor).max(initial=0.0) * max(1, len(anchor)) < _EXACT:
            return (picked @ anchor).astype(np.int64)
        whole = [int(v) for v in anchor]
        sums = (sum(int(a) * b for a, b in zip(row, whole)) for row in picked)
        return np.array([max(-_LARGEST - 1, min(_LARGEST, s)) for s in sums], np.int64)

    def around(self, low: np.ndarray, high: np.ndarray, edge: float) -> tuple[np.ndarray, np.ndarray]:
        """The bounds, wider by the longest difference that an edge can make and by what doubles round."""
        with np.errstate(over="ignore", invalid="ignore"):
            reach = edge * self.norm * (1 + 1e-9) + 1e-6 + 1e-12 * np.maximum(np.abs(low), np.abs(high))
            ends = np.clip(low - reach, -_ENDS, _ENDS), np.clip(high + reach, -_ENDS, _ENDS)
        return np.nan_to_num(ends[0], nan=-_ENDS), np.nan_to_num(ends[1], nan=_ENDS)


def walk(rows: Rows, x: np.ndarray, parent: np.ndarray, edge: np.ndarray, wanted: Callable) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows scored, their scores) for each anchor of a tree, given in the order of joining.

    `wanted(anchor, low, high)` names the rows whose bounds overlap what the anchor looks for.
    Bounds are held along one path from the root, which is at most DEEPEST long.
    """
    children: dict[int, list[int]] = {}
    for i, p in enumerate(parent):
        children.setdefault(int(p), []).append(i)
    everything = np.arange(len(rows.x))
    todo = [(i, None, None) for i in children.get(-1, [])]
    while todo:
        i, low, high = todo.pop()
        if low is None:
            low, high, picked = np.empty(len(rows.x)), np.empty(len(rows.x)), everything
        else:
            low, high = rows.around(low, high, float(edge[i]))
            picked = wanted(i, low, high)
        scores = rows.scores(x[i], picked)
        low[picked] = high[picked] = scores
        yield i, picked, scores
        todo += [(child, low, high) for child in reversed(children.get(i, []))]


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Places of the `count` highest scores, ties by smaller id, then by row."""
    if len(scores) > 4 * count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((rows[near], ids[near], ~scores[near]))[:count]]  # ~ turns the order round without overflow


NO_ID = _LARGEST  # a null id comes after all others


def _side(table: pa.Table, width: int) -> dict[str, np.ndarray]:
    table = table.combine_chunks()
    column = lambda name: table.column(name).combine_chunks()
    return {"row": column("row").to_numpy(), "label": column("label").to_numpy(), "x": matrix(column("v"), width),
            "id": column("vec_id").fill_null(NO_ID).to_numpy() if table.num_rows else np.zeros(0, np.int64)}


def prepared(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, label, v) of the rows that take part, written once so that `row` stays with its row."""
    scaled = F.transform(F.col("embedding"), lambda e: e.cast("double") * F.lit(SCALE))
    odd = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf")))
    label = F.col("label").cast("long")
    relabelled = F.when(F.col("vec_id") % RELABELLED_EVERY == 0, (label % LABELS + 1) % LABELS).otherwise(label)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), relabelled.alias("label"), scaled.alias("v"))
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(F.exists("v", odd), F.lit(True))
    # larger doubles are whole numbers already, and floor() ends at the range of longs
    whole = F.transform("v", lambda e: F.when(F.abs(e) < F.lit(_EXACT), F.floor(e).cast("double")).otherwise(e))
    return written(rows.where(usable).select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", whole.alias("v")), "vectors")


def hard_negatives(vectors: DataFrame, least_bin: int = LEAST_BIN, group: int = GROUP) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for `vectors(vec_id, embedding, label)`.

    Rows with a null label, a null vector, or a null or non-finite component take no
    part, nor do rows a component of which is not finite when scaled. Where vec_id is divisible by
    7 the label becomes (label + 1) % 10. Components are floor(256 x). Anchors are the rows whose vec_id is
    divisible by 100; positives are the 5 best other rows of the label; negatives the 5 best rows of another label
    with 80 positive_score <= 100 negative_score <= 100 positive_score. Higher scores come first, ties by
    smaller vec_id, null ids last. Rows without an id are no anchors, but can be positives and negatives. A row that
    repeats another one is a row of its own, as anchor too. Shorter vectors count as filled with zeros, an empty one
    scores 0. Scores beyond the range of a long count as its end. Other columns are
    ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors)
    is_anchor = F.coalesce(F.col("vec_id") % ANCHORS_EVERY == 0, F.lit(False))
    count, anchors, width = rows.agg(F.count("*"), F.count_if(is_anchor), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    size = min(LARGEST_BIN, max(least_bin, count // (4 * max(1, spark.sparkContext.defaultParallelism))))
    bins, groups = max(1, -(-count // size)), max(1, -(-anchors // group))
    dealt = lambda name, parts: F.pmod(F.xxhash64("row", F.lit(name)), F.lit(parts)).cast("int")

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        one = _side(table, width)
        order, parent, edge = spanning_tree(one["x"], one["label"])
        joined = np.empty(len(order), np.int64)
        joined[order] = np.arange(len(order))
        table = table.combine_chunks().take(pa.array(order))
        up = parent[order]
        return table.append_column("place", pa.array(np.arange(len(order)))).append_column(
            "parent", pa.array(np.where(up >= 0, joined[up], -1))).append_column("edge", pa.array(edge[order]))

    trees = written(
        rows.where(is_anchor).withColumn("tree", dealt("tree", groups)).groupBy("tree").applyInArrow(
            grow, "row long, vec_id long, label long, v array<double>, tree int, place long, parent long, edge double"), "trees")

    candidates = rows.withColumn("bin", dealt("bin", bins)).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    in_bins = lambda side: side.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))

    def tree_of(table: pa.Table) -> tuple[dict, np.ndarray, np.ndarray, pa.Table]:
        table = table.sort_by("place")
        return _side(table, width), table.column("parent").to_numpy(), table.column("edge").to_numpy(), table

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            cand, (tree, parent, edge, _) = _side(left, width), tree_of(right)
            held = Rows(cand["x"])
            of_label = {v: np.flatnonzero(cand["label"] == v) for v in np.unique(tree["label"])}

            def wanted(i, low, high):
                same = of_label[tree["label"][i]]
                if len(same) <= POSITIVES + 1:
                    return same
                # one of the best may be the anchor itself
                floor = np.partition(low[same], len(same) - POSITIVES - 1)[len(same) - POSITIVES - 1]
                return same[high[same] >= floor]

            for i, picked, scores in walk(held, tree["x"], parent, edge, wanted):
                own = (cand["label"][picked] == tree["label"][i]) & (cand["row"][picked] != tree["row"][i])
                picked, scores = picked[own], scores[own]
                for k in _best(scores, cand["id"][picked], cand["row"][picked], POSITIVES):
                    out.append((int(tree["row"][i]), int(cand["row"][picked[k]]), int(cand["id"][picked[k]]), int(scores[k])))
        columns = list(zip(*out)) or [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor", "other", "id", "score"])

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "other")
    near = candidates.groupBy("bin", "tree").cogroup(in_bins(trees).groupBy("bin", "tree")).applyInArrow(
        positives, "anchor long, other long, id long, score long")
    chosen = written(near.withColumn("k", F.row_number().over(best)).where(F.col("k") <= POSITIVES), "positives")
    # an anchor without a positive stays: others hang on it
    looking = written(trees.join(chosen.groupBy(F.col("anchor").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("k", "score"))).alias("positives")), "row", "left"), "looking")

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            cand, (tree, parent, edge, table) = _side(left, width), tree_of(right)
            held = Rows(cand["x"])
            marks = [[(p["k"], p["score"]) for p in ps] for ps in (x or [] for x in table.column("positives").to_pylist())]
            others = {v: cand["label"] != v for v in np.unique(tree["label"])}
            # a window is empty for a negative score; whole scores from ceil(0.8 s) to s
            windows = [[(k, -(-LOWEST_PERCENT * s // 100), s) for k, s in one if s >= 0] for one in marks]

            def wanted(i, low, high):
                use = np.zeros(len(low), bool)
                for _, least, most in windows[i]:
                    use |= (high >= float(least) * (1 - 1e-12)) & (low <= float(most) * (1 + 1e-12))
                return np.flatnonzero(use & others[tree["label"][i]])

            for i, picked, scores in walk(held, tree["x"], parent, edge, wanted):
                own = others[tree["label"][i]][picked]
                picked, scores = picked[own], scores[own]
                for k, least, most in windows[i]:
                    inside = (scores >= least) & (scores <= most)
                    at, values = picked[inside.astype(bool)], scores[inside.astype(bool)]
                    for j in _best(values, cand["id"][at], cand["row"][at], NEGATIVES):
                        out.append((int(tree["row"][i]), k, int(cand["row"][at[j]]), int(cand["id"][at[j]]), int(values[j])))
        columns = list(zip(*out)) or [[]] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor", "k", "other", "id", "score"])

    below = candidates.groupBy("bin", "tree").cogroup(in_bins(looking).groupBy("bin", "tree")).applyInArrow(
        negatives, "anchor long, k long, other long, id long, score long")
    first = Window.partitionBy("anchor", "k").orderBy(F.desc("score"), "id", "other")
    ranked = below.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES)
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return ranked.alias("n").join(chosen.alias("p"), ["anchor", "k"]).join(
        trees.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor_id", named("p.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), named("n.id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"))


# DuckDB SQL of the rows, for components whose products stay within doubles
ORACLE = f"""
with rows as (
  select row_number() over () as r, vec_id, case when vec_id % {RELABELLED_EVERY} = 0 then (label + 1) % {LABELS} else label end as label,
    [floor(cast(e as double) * {SCALE}) for e in embedding] as v
  from embeddings where label is not null and embedding is not null
), usable as (
  select * from rows where len([e for e in v if e is null or not isfinite(e)]) = 0
), scored as (
  select a.r as ar, a.vec_id as anchor_id, c.r as cr, c.vec_id as id, a.label = c.label as same,
    cast(list_dot_product(a.v, c.v) as bigint) as score
  from usable a join usable c on a.r <> c.r where a.vec_id % {ANCHORS_EVERY} = 0
), positives as (
  select *, row_number() over (partition by ar order by score desc, id, cr) as k from scored where same qualify k <= {POSITIVES}
)
select p.anchor_id, p.id as positive_id, cast(row_number() over (partition by p.ar, p.k order by n.score desc, n.id, n.cr) as integer) as rank,
  n.id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scored n on n.ar = p.ar and not n.same
where {LOWEST_PERCENT} * p.score <= 100 * n.score and n.score <= p.score
qualify rank <= {NEGATIVES}"""
