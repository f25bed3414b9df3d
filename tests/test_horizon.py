from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridcast.contracts import FEATURES, OPTIONAL_FEATURES
from gridcast.plans.horizon import horizon_frame, time_lags
from gridcast.sources import tables
from tests.conftest import same


def ramp(spark, hours=240):
    return spark.range(hours).selectExpr(
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) as timestamp_utc",
        "id as load_mw", "id + 100 as pool_price_cad_mwh")


def at(df):
    found = df.where("target_timestamp_utc = timestamp'2024-01-09 12:00:00'").collect()
    assert len(found) == 1
    return found[0]


def test_one_hour_horizon(spark):
    row = at(horizon_frame(ramp(spark), 1))
    assert str(row.feature_as_of_timestamp_utc) == "2024-01-09 11:00:00"
    assert (row.load_lag_1h, row.load_lag_24h, row.load_lag_168h, row.price_lag_24h) == (203, 180, 36, 280)
    assert row.load_rolling_24h_avg == sum(range(180, 204)) / 24


def test_day_ahead_horizon_hides_the_hour_before(spark):
    row = at(horizon_frame(ramp(spark), 24))
    assert row.load_lag_1h is None
    assert (row.load_lag_24h, row.load_lag_168h) == (180, 36)
    assert row.load_rolling_24h_avg == sum(range(157, 181)) / 24


def test_long_horizon_hides_every_shorter_lag(spark):
    row = at(horizon_frame(ramp(spark), 48))
    assert (row.load_lag_1h, row.load_lag_24h, row.price_lag_24h, row.load_lag_168h) == (None, None, None, 36)


def test_several_horizons_stack_without_leakage(spark):
    both = horizon_frame(ramp(spark), [1, 24])
    assert both.count() == 480
    assert both.where("feature_max_source_timestamp_utc > feature_as_of_timestamp_utc").count() == 0
    assert both.columns[6:] == FEATURES
    assert both.where(" or ".join(f"{c} is not null" for c in OPTIONAL_FEATURES)).count() == 0


def test_missing_hours_give_nulls_not_shifted_values(spark):
    holes = ramp(spark, 48).where("load_mw not in (23, 24)")
    row = horizon_frame(holes, 1).where("target_load_mw = 25").first()
    assert (row.load_lag_1h, row.load_lag_24h, row.load_rolling_24h_avg) == (None, 1, None)
    assert holes.count() == horizon_frame(holes, 1).count()


def test_bad_arguments(spark):
    with pytest.raises(ValueError, match="positive"):
        horizon_frame(ramp(spark), 0)
    with pytest.raises(ValueError, match="load_mw"):
        horizon_frame(ramp(spark).drop("load_mw"), 1)


def test_the_first_row_of_an_hour_is_kept(spark, tmp_path):
    """Rows repeat their hours with other loads; the place in the file decides, not the value."""
    first = ramp(spark).withColumn("copy", F.lit(0))
    later = ramp(spark).selectExpr("timestamp_utc", "load_mw + if(load_mw % 2 = 0, 1000, -1000) as load_mw", "pool_price_cad_mwh", "1 as copy")
    first.unionByName(later).orderBy("copy", "timestamp_utc").coalesce(1).write.parquet(str(tmp_path / "hours"))
    hours = tables.in_file_order(spark, str(tmp_path / "hours")).drop("copy")
    both = horizon_frame(hours, [1, 24], order=tables.FILE_ORDER)
    same(both, horizon_frame(ramp(spark), [1, 24]))
    lags = time_lags(hours.drop("pool_price_cad_mwh"), "timestamp_utc", {"lag": ("load_mw", 5)}, order=tables.FILE_ORDER)
    assert {r.load_mw - r.lag for r in lags.where("lag is not null").collect()} == {5} and lags.count() == 240
