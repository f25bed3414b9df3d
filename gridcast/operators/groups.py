"""Values per group brought to the rows of the group without moving the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.session import settle

FEW_GROUPS = 50_000


def join_small_groups(rows: DataFrame, groups: DataFrame, keys: list[str], few: int = FEW_GROUPS, how: str = "inner") -> DataFrame:
    """`rows` with the columns of `groups`, one row per key at most.

    `groups` is settled and counted. Up to `few` groups are sent to every task,
    so rows of few keys, each with a large share of them, stay where they are;
    more groups than that spread the rows well enough for an ordinary join.
    """
    groups = settle(groups)
    return rows.join(F.broadcast(groups) if groups.count() <= few else groups, list(keys), how)
