"""Registers each query with its output columns and, where SQL can say it, its oracle.

`columns` is one text such as "timestamp_utc:ts load_mw:num". Both sides are
selected through it, so names, order and types agree by construction.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.parts import compose
from gridcast.session import utc_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_SPARK = {
    "ts": "cast({} as timestamp_ntz)",
    "day": "date_format({}, 'yyyy-MM-dd')",
    "num": "round(cast({} as double), 6)",
    "int": "cast({} as bigint)",
    "bool": "cast({} as boolean)",
    "text": "cast({} as string)",
}
_SQL = {
    "ts": "cast({} as timestamp)",
    "day": "strftime({}, '%Y-%m-%d')",
    "num": "round(cast({} as double), 6)",
    "int": "cast({} as bigint)",
    "bool": "cast({} as boolean)",
    "text": "cast({} as varchar)",
}


def _fields(columns: str) -> list[tuple[str, str]]:
    return [tuple(entry.split(":")) for entry in columns.split()]


def query(name: str, columns: str, sql: str | None = None):
    """Register `build(spark, folder)` under `name`."""
    fields = _fields(columns)

    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = build(utc_session(spark), folder)
            return df.selectExpr(*[f"{_SPARK[kind].format(column)} as {column}" for column, kind in fields])

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            body = sql.strip()
            inner = body if body.lower().startswith("select") else f"select * from {body}"
            picked = ", ".join(f"{_SQL[kind].format(column)} as {column}" for column, kind in fields)
            ORACLES[name] = compose(f"select {picked} from ({inner}) as result")
        return build

    return register
