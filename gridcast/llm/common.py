"""Helpers shared by the operators: tables, written steps, folds, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import reduce

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.groups import join_small_groups
from gridcast.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """While it lasts, the session has this setting: for actions that run inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once in the shared folder and go on from the copy; it outlives lost executors.

    The shuffle files of the job go when it ends, not when the driver happens to collect its garbage.
    """
    path = scratch(df.sparkSession, label)
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_batches(spark: SparkSession, rows: int) -> AbstractContextManager[None]:
    """While it lasts, jobs hand at most `rows` rows to Python at a time: for actions that run inside."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


class Sent:
    """An object sent to every task once, of a size that its maker bounds; `value` is the object.

    It travels as bytes that hold its class too, so executors need no copy of the package.
    """

    def __init__(self, spark: SparkSession, value: object):
        self.bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self.found: list = []

    def __getstate__(self) -> dict:
        return {"bytes": self.bytes, "found": []}

    @property
    def value(self) -> object:
        if not self.found:
            self.found.append(cloudpickle.loads(self.bytes.value))
        return self.found[0]


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


NO_ID = 1 << 62  # keys from here on stand for rows without an id


def row_key(doc_id: Column, text: Column) -> Column:
    """The id; a row without one takes a number made from its text, above all ids."""
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 2))


def with_text_key(docs: DataFrame, name: str) -> DataFrame:
    """`docs(doc_id, text, ...)` with a key that rows share only if they are equal in id and text: as `row_key`,
    but a number made from both where an id has several texts."""
    key, hashed = row_key(F.col("doc_id"), F.col("text")), F.xxhash64(F.coalesce("text", F.lit("")))
    several = docs.select(key.alias(name), hashed.alias("h")).groupBy(name).agg(
        F.min("h").alias("a"), F.max("h").alias("b")).where("a != b").select(name)
    keyed = docs.withColumn(name, key)
    if several.isEmpty():
        return keyed
    mark = fresh(keyed, "_several")
    own = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))), 2)
    marked = join_small_groups(keyed, several.withColumn(mark, F.lit(True)), [name], how="left")
    return marked.withColumn(name, F.when(F.col(mark), own).otherwise(F.col(name))).select(*docs.columns, name)


def _scrambled(c: Column) -> Column:
    """A one-to-one map of longs that breaks up the order of ids."""
    for _ in range(3):
        c = c.bitwiseXOR(F.shiftleft(c, 13))
        c = c.bitwiseXOR(F.shiftrightunsigned(c, 7))
        c = c.bitwiseXOR(F.shiftleft(c, 17))
    return c


def components(edges: DataFrame) -> DataFrame:
    """Connected components of `edges(a long, b long)`: one row (node, component) for each
    node of an edge, component being the smallest node.

    Each round sends every node to the first of itself and its neighbours in a
    scrambled order, twice, and contracts the edges; in that order stars need two rounds and
    even a chain of ascending ids loses a good part of its nodes in each. Hubs are
    combined before the shuffle. Loops, repeated edges and nulls are harmless. The
    steps are written to the shared folder, so a lost executor costs no earlier round.
    """
    real = edges.where("a is not null and b is not null and a != b")
    named = real.select(F.col("a").alias("node")).union(real.select("b")).distinct()
    live = written(
        real.select(_scrambled(F.col("a")).alias("a"), _scrambled(F.col("b")).alias("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges",
    )
    maps = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("via"))
        onward = hook.select(F.col("node").alias("via"), F.col("via").alias("to"))
        step = written(hook.join(onward, "via").select("node", "to"), "hook")  # two steps at once
        maps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = live.join(left, "a").join(right, "b").where("ta != tb")
        live = written(
            moved.select(F.greatest("ta", "tb").alias("a"), F.least("ta", "tb").alias("b")).distinct(), "edges"
        )
    if not maps:
        return named.select("node", F.col("node").alias("component"))

    def follow(done: DataFrame, step: DataFrame) -> DataFrame:
        # `to` of an earlier round is the node of the next one, or has no edge left
        later = step.select(F.col("node").alias("at"), F.col("to").alias("next"))
        return done.join(later, "at", "left").select("key", F.coalesce("next", "at").alias("at"))

    first = maps[0].select(F.col("node").alias("key"), F.col("to").alias("at"))
    placed = written(named.withColumn("key", _scrambled(F.col("node"))).join(reduce(follow, maps[1:], first), "key").select("node", "at"), "placed")
    smallest = placed.groupBy("at").agg(F.min("node").alias("component"))
    return placed.join(smallest, "at").select("node", "component")


def linked_rows(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the smallest row it reaches."""
    label, n = np.arange(len(linked)), len(linked)
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], n).min(1))
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low
