"""Time-based horizon frames: one row per observed hour and horizon, lags by clock time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.contracts import FEATURES, OPTIONAL_FEATURES, require_columns
from gridcast.operators.dedup import dedup_first, dedup_latest
from gridcast.operators.series import lags_and_means, shifted_lookup
from gridcast.plans.calendar import add_calendar, time_bounds

_TS, _LOAD, _PRICE = "target_timestamp_utc", "target_load_mw", "actual_pool_price_cad_mwh"
_ROLLING = {"load_rolling_24h_avg": (_LOAD, 24), "load_rolling_168h_avg": (_LOAD, 168), "price_rolling_24h_avg": (_PRICE, 24)}
_LAGS = {"load_lag_1h": (_LOAD, 1), "load_lag_24h": (_LOAD, 24), "load_lag_168h": (_LOAD, 168), "price_lag_24h": (_PRICE, 24)}


def _one_per_hour(rows: DataFrame, ts: str, own: list[str], order: list[str]) -> DataFrame:
    """The first row of each hour by `order`; without an order the one of greatest values."""
    known = rows.where(F.col(ts).isNotNull())
    return dedup_first(known, [ts], order).drop(*order) if order else dedup_latest(known, [ts], own[0], own[1:])


def time_lags(hourly: DataFrame, ts: str, lags: dict[str, tuple[str, int]], order: list[str] = ()) -> DataFrame:
    """Values the same series had a number of hours earlier, null where that hour is absent.

    Of rows that repeat an hour the first by the columns `order` counts, such as the place in
    their file, or without an order the one of greatest values.
    """
    order = list(order)
    own = [c for c in hourly.columns if c != ts and c not in order]
    return shifted_lookup(_one_per_hour(hourly, ts, own, order), ts, own, lags)


def horizon_frame(
    hourly: DataFrame,
    horizons: int | list[int],
    ts: str = "timestamp_utc",
    load: str = "load_mw",
    price: str = "pool_price_cad_mwh",
    order: list[str] = (),
) -> DataFrame:
    """Features known `horizon` hours before each observed hour.

    Lags look up clock hours, unlike the training set's row lags; trailing means
    are those of the issue hour, null when that hour was not observed. The
    snapshot features are present and null. Of rows that repeat an hour the first by the columns
    `order` is kept, or without an order the one of greatest load.
    """
    horizons = [horizons] if isinstance(horizons, int) else list(horizons)
    if not horizons or min(horizons) < 1:
        raise ValueError("horizon_hours must be positive")
    require_columns(hourly, [ts, load, price], "Hourly")

    typed = hourly.selectExpr(f"cast({ts} as timestamp) as {_TS}", f"{load} as {_LOAD}", f"{price} as {_PRICE}", *order)
    base = _one_per_hour(typed, _TS, [_LOAD, _PRICE], list(order))
    rolled = lags_and_means(base, _TS, lags={}, means=_ROLLING)
    known = shifted_lookup(
        rolled, _TS, [_LOAD, _PRICE],
        _LAGS | {f"{name}@{h}": (name, h) for h in horizons for name in _ROLLING},
    )
    per_horizon = [
        "struct(" + ", ".join([
            f"{h} as horizon_hours",
            *[f"{name if n >= h else f'if(true, null, {name})'} as {name}" for name, (_, n) in _LAGS.items()],
            *[f"`{name}@{h}` as {name}" for name in _ROLLING],
        ]) + ")"
        for h in horizons
    ]
    rows = known.selectExpr(_TS, _LOAD, _PRICE, f"inline(array({', '.join(per_horizon)}))")
    dated = add_calendar(rows, _TS, time_bounds(hourly.selectExpr(f"cast({ts} as timestamp) as {_TS}"), _TS))
    as_of = f"{_TS} - make_dt_interval(0, horizon_hours)"
    return dated.selectExpr(
        "horizon_hours",
        f"{as_of} as feature_as_of_timestamp_utc",
        f"{as_of} as feature_max_source_timestamp_utc",
        _TS, _LOAD, _PRICE,
        *[f"cast(null as double) as {c}" if c in OPTIONAL_FEATURES else c for c in FEATURES],
    )
