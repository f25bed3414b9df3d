"""Keep one copy of each key: the newest, or the first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


_FIXED = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp")


def dedup_crowded(df: DataFrame, keys: list[str], order_by: str, tiebreak: list[str] = ()) -> DataFrame:
    """As `dedup_latest`, for keys with many copies of one `order_by`: these are first brought down by hash aggregation, not
    sorted. That needs a single `tiebreak` of whole numbers; columns without a fixed width are grouped by."""
    kinds = dict(df.dtypes)
    if len(tiebreak) == 1 and kinds[tiebreak[0]] in ("tinyint", "smallint", "int", "bigint"):
        place = F.coalesce(F.col(tiebreak[0]).cast("long"), F.lit(-(1 << 63)))
        carried = [c for c in df.columns if c not in (*keys, order_by) and (kinds[c] in _FIXED or kinds[c].startswith("decimal"))]
        grouped = [c for c in df.columns if c not in carried]
        # all columns are taken by one order, so they come from one row
        df = df.groupBy(*grouped).agg(*[F.max_by(c, place).alias(c) for c in carried]).select(*df.columns)
    return dedup_latest(df, keys, order_by, tiebreak)


def dedup_latest(df: DataFrame, keys: list[str], order_by: str, tiebreak: list[str] = ()) -> DataFrame:
    """One row per `keys`: greatest `order_by`, nulls last, then greatest `tiebreak`.

    The `= 1` filter lets Spark put a per-partition group limit in front of the
    shuffle, so a key with very many copies sends one row per input partition.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [order_by, *tiebreak]])
    return df.withColumn("_copy", F.row_number().over(newest)).where("_copy = 1").drop("_copy")


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per `keys`: the first by `order`, nulls last. One row per key and input partition is shuffled."""
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")
