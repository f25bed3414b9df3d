"""Boosted-tree forecasts: one model per horizon, or per horizon and backtest window.

Models are data: a fit gives rows of tree nodes, which are saved as a table, scored by
column expressions, and summed up as importances. All fits of a call run in one job.
The rows of a fit meet in one task: they are hours of one horizon, one row each,
so a century of history is at most 876,600 rows, kept as one byte per feature. What grows
without such a bound (horizons, windows, models, rows to score) is spread over tasks.

Trees minimise squared error by histograms of gradients. Features are binned by exact quantiles
of the fit's own rows, unknown values are a bin of their own and go to the side that
gains more, and rows and columns of a tree are drawn by hash, so refits agree to the last bit.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.contracts import FEATURES, BacktestRules
from gridcast.plans.backtests import _in_window, backtest_windows, evaluate_windows
from gridcast.plans.forecasting import model_id
from gridcast.plans.governance import registry_rows
from gridcast.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

MODEL_NAME = "gbt_regressor"
MODEL_TYPE = "gbt"
SHRINK = 1.0  # added to the row count of a leaf or a side
BINS = 63  # of known values
UNKNOWN, WIDTH = 63, 64
CHUNK = 1 << 16  # rows whose histogram keys are held at a time
MOST_TASKS = 4096
FEW_MODELS = 200  # fits whose trees are sent to every task; some 10,000 nodes each
NODES = ("model_id string, window_id string, tree int, node int, level int, feature string, threshold double, unknown_right boolean,"
         " left int, right int, value double, gain double, row_count bigint")
_H = "horizon_hours"


@dataclass(frozen=True)
class TreeSettings:
    """Size and learning parameters; the defaults are fixed values."""

    rounds: int = 300
    depth: int = 4
    step: float = 0.05
    row_share: float = 0.9
    column_share: float = 0.9
    seed: int = 42
    features: list[str] = field(default_factory=lambda: list(FEATURES))

    def parameters(self) -> dict:
        return {"n_estimators": self.rounds, "max_depth": self.depth, "learning_rate": self.step,
                "subsample": self.row_share, "colsample_bytree": self.column_share, "random_state": self.seed}

    @staticmethod
    def registered(feature_names: str | None, parameters: str | None) -> TreeSettings:
        """Settings from the JSON texts of a registry row; what they leave out has its default."""
        names = {"n_estimators": "rounds", "max_depth": "depth", "learning_rate": "step", "subsample": "row_share",
                 "colsample_bytree": "column_share", "random_state": "seed"}
        kinds = {"rounds": int, "depth": int, "seed": int}
        given = {names[k]: v for k, v in json.loads(parameters or "{}").items() if k in names and v is not None}
        features = json.loads(feature_names or "[]") or list(FEATURES)
        return TreeSettings(**{k: kinds.get(k, float)(v) for k, v in given.items()}, features=features)


def _scrambled(x: np.ndarray) -> np.ndarray:
    """A number in [0, 1) from each whole number: the finishing steps of splitmix64."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def binned(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """A byte for each value, and each column's upper bounds of its bins: its values, or as many exact quantiles."""
    bins, bounds = np.full(x.shape, UNKNOWN, np.uint8), []
    for j in range(x.shape[1]):
        known = np.isfinite(x[:, j])
        values = np.unique(x[known, j])
        if len(values) > BINS:
            ordered = np.sort(x[known, j])
            values = np.unique(ordered[np.arange(1, BINS + 1) * len(ordered) // BINS - 1])
        bounds.append(values[:-1])
        bins[known, j] = np.searchsorted(values[:-1], x[known, j])
    return bins, bounds


def _histograms(bins: np.ndarray, columns: np.ndarray, slot: np.ndarray, rows: np.ndarray, gradient: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradients and row counts per (slot, column, bin)."""
    width = len(columns) * WIDTH
    sums, counts = np.zeros(slots * width), np.zeros(slots * width, np.int64)
    offsets = np.arange(len(columns), dtype=np.int64) * WIDTH
    for start in range(0, len(rows), CHUNK):
        part = rows[start:start + CHUNK]
        keys = (slot[part].astype(np.int64)[:, None] * width + offsets + bins[part][:, columns]).ravel()
        sums += np.bincount(keys, np.repeat(gradient[part], len(columns)), slots * width)
        counts += np.bincount(keys, minlength=slots * width)
    shape = slots, len(columns), WIDTH
    return sums.reshape(shape), counts.reshape(shape)


def _best_splits(sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each slot the gain, column, bin and side of unknown values (1: right) of its best split; the first of equals."""
    total, rows = sums[:, :1].sum(2, keepdims=True), counts[:, :1].sum(2, keepdims=True)
    left, left_rows = sums[:, :, :UNKNOWN].cumsum(2), counts[:, :, :UNKNOWN].cumsum(2)
    gains = np.empty((len(sums), 2, sums.shape[1], UNKNOWN))
    for side, (g, n) in enumerate(((left, left_rows), (left + sums[:, :, UNKNOWN:], left_rows + counts[:, :, UNKNOWN:]))):
        gain = g * g / (n + SHRINK) + (total - g) ** 2 / (rows - n + SHRINK) - total * total / (rows + SHRINK)
        gains[:, side] = np.where((n > 0) & (n < rows), gain, -np.inf)
    flat = gains.reshape(len(sums), -1)
    best = flat.argmax(1)
    side, place = np.divmod(best, sums.shape[1] * UNKNOWN)
    return flat[np.arange(len(sums)), best], place // UNKNOWN, place % UNKNOWN, 1 - side


def boost(x: np.ndarray, y: np.ndarray, at: np.ndarray, own: TreeSettings) -> list[tuple]:
    """Nodes (tree, node, level, column, threshold, unknown_right, left, right, value, gain, row_count) of a fit.

    Tree 0 is the mean of `y`; the forecast is the sum of one leaf of every tree. A value at most the threshold
    goes left. `at` tells rows apart: they are taken in its order, and drawn by it.
    """
    order = np.argsort(at, kind="stable")
    x, y, at = x[order], y[order], at[order]
    bins, bounds = binned(x)
    forecast = np.full(len(y), y.mean())
    out = [(0, 0, 0, None, None, None, None, None, float(y.mean()), None, len(y))]
    most = max(1, int(own.column_share * x.shape[1]))
    for tree in range(1, own.rounds + 1):
        gradient = forecast - y
        salt = np.uint64(own.seed * 1_000_003 + tree)
        drawn = _scrambled(at.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + salt) < own.row_share
        columns = np.sort(np.argsort(_scrambled(np.arange(1, x.shape[1] + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D) + salt), kind="stable")[:most])
        node = np.zeros(len(y), np.int64)
        nodes, level = [[0] + [None] * 6], [0]
        for deep in range(1, own.depth + 1):
            if not level or not len(columns):
                break
            slots = np.full(len(nodes), -1)
            slots[level] = np.arange(len(level))
            slot = slots[node]
            rows = np.flatnonzero(drawn & (slot >= 0))
            gain, column, cut, unknown = _best_splits(*_histograms(bins, columns, slot, rows, gradient, len(level)))
            below = []
            for i, parent in enumerate(level):
                if not gain[i] > 1e-9:
                    continue
                j, left = int(columns[column[i]]), len(nodes)
                # a cut after the last known bin parts known from unknown values
                threshold = float(bounds[j][cut[i]]) if cut[i] < len(bounds[j]) else float("inf")
                nodes[parent][1:] = j, threshold, bool(unknown[i]), left, left + 1, float(gain[i])
                nodes += [[deep] + [None] * 6 for _ in range(2)]
                below += [left, left + 1]
                inside = np.flatnonzero(node == parent)
                mine = bins[inside, j]
                right = np.where(mine == UNKNOWN, bool(unknown[i]), mine > cut[i])
                node[inside] = left + right
            level = below
        counts = np.bincount(node[drawn], minlength=len(nodes))
        leaves = -own.step * np.bincount(node[drawn], gradient[drawn], len(nodes)) / (counts + SHRINK)
        forecast += leaves[node]
        for number in reversed(range(len(nodes))):  # sides have higher numbers than what they split
            if nodes[number][-1] is not None:
                counts[number] = counts[nodes[number][4]] + counts[nodes[number][5]]
        for number, (*split, gain_of) in enumerate(nodes):
            value = float(leaves[number]) if gain_of is None else None
            out.append((tree, number, *split, value, gain_of, int(counts[number])))
    return out


def feature_vector(frame: DataFrame, names: list[str]) -> Column:
    """The features as doubles, unknown ones NaN."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in names])


def known_features(frame: DataFrame) -> list[str]:
    """The columns of `frame` that can be features: numbers and flags."""
    return [name for name, kind in frame.dtypes if kind in ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")]


def fit_models(rows: DataFrame, names: list[str], fits: int) -> DataFrame:
    """Tree nodes of every (model_id, window_id) of `rows`, `fits` in number.

    The rows are dealt by fit over a stated number of tasks, so that small fits are not merged into one. `rows` has a row for each hour that a fit learns from: its keys, the JSON texts feature_names and
    parameters, `_at` (long, distinct in a fit), `_x` (the values of `names`) and `_y`.
    """
    def fit(key: tuple, table: pa.Table) -> pa.Table:
        model, window, feature_names, parameters = (k.as_py() for k in key)
        own = TreeSettings.registered(feature_names, parameters)
        table = table.combine_chunks()
        x = table.column("_x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, len(names))
        picked = [names.index(name) for name in own.features]
        found = boost(x[:, picked], table.column("_y").to_numpy(), table.column("_at").to_numpy(), own)
        tree, node, level, column, *rest = zip(*found)
        kinds = pa.float64(), pa.bool_(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()
        return pa.table([
            pa.array([model] * len(found), pa.string()), pa.array([window] * len(found), pa.string()), pa.array(tree, pa.int32()),
            pa.array(node, pa.int32()), pa.array(level, pa.int32()), pa.array([None if j is None else own.features[j] for j in column], pa.string()),
            *[pa.array(c, kind) for c, kind in zip(rest, kinds)],
        ], [f.split()[0] for f in NODES.split(", ")])

    dealt = rows.select("model_id", "window_id", "feature_names", "parameters", "_at", "_x", "_y").repartition(
        min(MOST_TASKS, 4 * max(1, fits)), "model_id", "window_id")
    return dealt.groupBy("model_id", "window_id", "feature_names", "parameters").applyInArrow(fit, NODES)


def score(rows: DataFrame, nodes: DataFrame, names: list[str]) -> DataFrame:
    """`rows` (model_id, window_id and the columns `names`) with predicted_load_mw, from tables of tree nodes.

    A value that a tree asks for and the rows lack is unknown. Up to FEW_MODELS fits are sent to every task;
    more are joined on their keys. Rows whose model has no nodes are left out.
    """
    place = F.array_position(F.array(*map(F.lit, names)), F.col("feature")).cast("int") - 1
    packed = settle(
        nodes.withColumn("place", F.coalesce(place, F.lit(-1))).groupBy("model_id", "window_id", "tree").agg(
            F.array_sort(F.collect_list(F.struct("node", "place", "threshold", "unknown_right", "left", "right", "value"))).alias("nodes"),
            F.max("level").alias("levels"))
        .groupBy("model_id", "window_id").agg(
            F.array_sort(F.collect_list(F.struct("tree", "nodes"))).alias("_trees"), F.greatest(F.max("levels"), F.lit(1)).alias("_levels")))
    joined = rows.withColumn("_x", feature_vector(rows, names)).join(
        F.broadcast(packed) if packed.count() <= FEW_MODELS else packed, ["model_id", "window_id"])
    at = "get(t.nodes, n)"
    value = f"get(_x, {at}.place)"
    right = f"if(coalesce(isnan({value}) or abs({value}) = double('Infinity'), true), {at}.unknown_right, {value} > {at}.threshold)"
    leaf = f"aggregate(sequence(1, _levels), 0, (n, i) -> coalesce(if({right}, {at}.right, {at}.left), n))"  # a leaf has no sides and stays
    return joined.withColumn(
        "predicted_load_mw", F.expr(f"aggregate(_trees, 0D, (s, t) -> s + get(t.nodes, {leaf}).value)")).drop("_trees", "_levels", "_x")


def tree_models(horizons: DataFrame, run_id: str, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """(horizon_hours, model_id, model_name, feature_names, parameters) of one model for each distinct horizon."""
    return horizons.select(_H).distinct().withColumn("model_name", F.lit(MODEL_NAME)).select(
        _H, F.expr(model_id(run_id)).alias("model_id"), "model_name",
        F.lit(json.dumps(settings.features)).alias("feature_names"), F.lit(json.dumps(settings.parameters())).alias("parameters"))


def _fitted(train: DataFrame, models: DataFrame, names: list[str], fits: int) -> DataFrame:
    """Nodes of `models` on the rows `train` (horizon_hours, window_id and the frame's columns) of their horizon."""
    # one row per model: as many as horizons and registered models
    rows = train.where("target_load_mw is not null").join(F.broadcast(models), _H)
    return settle(fit_models(rows.select(
        "model_id", "window_id", "feature_names", "parameters", F.unix_micros(F.col("target_timestamp_utc").cast("timestamp")).alias("_at"),
        feature_vector(rows, names).alias("_x"), F.col("target_load_mw").cast("double").alias("_y")), names, fits))


def tree_forecasts(split: DataFrame, run_id: str, settings: TreeSettings = TreeSettings()) -> tuple[DataFrame, DataFrame]:
    """Validation and test predictions of one model per horizon, and the tree nodes of the models."""
    split, names = settle(split), list(settings.features)
    models = settle(tree_models(split, run_id, settings))
    train = split.where("evaluation_split = 'train'").withColumn("window_id", F.lit(""))
    nodes = _fitted(train, models, names, models.count())
    return predict(split.where("evaluation_split in ('validation', 'test')"), models, nodes, names), nodes


def predict(rows: DataFrame, models: DataFrame, nodes: DataFrame, names: list[str]) -> DataFrame:
    """Forecast rows of `models` (horizon_hours, model_id, model_name) whose nodes were fitted without windows, or saved."""
    keyed = rows.join(F.broadcast(models.select(_H, "model_id", "model_name")), _H).withColumn("window_id", F.lit(""))
    return score(keyed, nodes, names).drop("window_id")


def importance_table(nodes: DataFrame, models: DataFrame, created_at: Column, features: list[str] = FEATURES) -> DataFrame:
    """(model_id, model_name, horizon_hours, feature_name, importance, created_at) for every feature.

    The importance of a feature is the gain of its splits over all trees, as a share of the model's gain; 0
    for one that is never split on, and for all of a model without splits.
    """
    gains = nodes.where("feature is not null").groupBy("model_id", F.col("feature").alias("feature_name")).agg(F.sum("gain").alias("_gain"))
    totals = gains.groupBy("model_id").agg(F.sum("_gain").alias("_total"))
    listed = models.select("model_id", "model_name", _H, F.explode(F.array(*map(F.lit, features))).alias("feature_name"))
    return listed.join(gains, ["model_id", "feature_name"], "left").join(totals, "model_id", "left").select(
        "model_id", "model_name", _H, "feature_name", F.coalesce(F.expr("_gain / _total"), F.lit(0.0)).alias("importance"),
        created_at.alias("created_at"))


def save_trees(nodes: DataFrame, folder: str, run_id: str) -> str:
    """Write the nodes under `folder`, which driver and executors share, a part for each model; a retried run replaces its own."""
    path = f"{folder}/{run_id}"
    nodes.withColumn("artifact", F.col("model_id")).write.partitionBy("artifact").option(
        "partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    return path


def saved_trees(spark: SparkSession, registry: DataFrame) -> DataFrame:
    """The nodes of the registered models with an artifact, by the paths of the registry: one for each model asked for."""
    found = registry.where("artifact_path is not null").select("artifact_path").distinct().collect()
    if not found:
        return spark.createDataFrame([], NODES)
    return spark.read.schema(NODES).parquet(*sorted(row.artifact_path for row in found))


def register_trees(
    split: DataFrame, nodes: DataFrame, run_id: str, trained_at: Column, folder: str, settings: TreeSettings = TreeSettings(),
) -> DataFrame:
    """Save the nodes under `folder` and return the registry rows of their models, with the paths of their parts."""
    path = save_trees(nodes, folder, run_id)
    spec = {"type": MODEL_TYPE, "features": settings.features, "parameters": settings.parameters()}
    rows = registry_rows(split, {MODEL_NAME: spec}, run_id, trained_at)
    return rows.withColumn("artifact_path", F.concat(F.lit(f"{path}/artifact="), F.col("model_id")))


def backtest_trees(
    frame: DataFrame, rules: BacktestRules, run_id: str, evaluated_at: Column, settings: TreeSettings = TreeSettings(),
    registry: DataFrame | None = None,
) -> DataFrame:
    """Refit and score the trees on every window, all in one job: those of `registry` on the windows of their
    horizon, each with its own features and parameters, or without a registry one model of `settings`
    per horizon. A registered model that asks for a feature which the frame lacks is left out."""
    frame = settle(frame)
    windows = settle(backtest_windows(frame, rules))
    names = [c for c in known_features(frame) if c not in (_H, "target_load_mw")]
    if registry is None:
        models = tree_models(windows, run_id, settings)
    else:
        own = F.from_json(F.col("feature_names"), "array<string>")
        listed = F.when(F.size(own) > 0, own).otherwise(F.array(*map(F.lit, FEATURES)))
        models = registry.where((F.col("model_type") == MODEL_TYPE) & (F.size(F.array_except(listed, F.array(*map(F.lit, names)))) == 0)).select(
            _H, "model_id", "model_name", "feature_names", "parameters").distinct()
    models = settle(models)
    nodes = _fitted(_in_window(frame, windows, "train"), models, names, windows.join(models, _H).count())
    tested = _in_window(frame, windows, "test").join(F.broadcast(models.select(_H, "model_id", "model_name")), _H)
    named = score(tested, nodes, names).select(
        _H, "window_id", "target_load_mw", "predicted_load_mw", "model_name", "model_id", F.lit(MODEL_TYPE).alias("model_type"))
    return evaluate_windows(frame, settle(named), windows, run_id, evaluated_at)
