from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcast.operators import dedup
from gridcast.operators.asof import Feed, asof_latest
from gridcast.operators.dedup import dedup_latest
from gridcast.operators.ranks import exact_quantile, running_counts, top_share, values_at
from gridcast.operators.series import lags_and_means, row_index, shifted_lookup
from tests.conftest import rows, same


def gappy(spark, hours=3000):
    """An hourly series over several months with about a tenth of its hours missing."""
    return spark.range(hours).where("pmod(hash(id), 10) > 0").selectExpr(
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) as ts",
        "cast(pmod(hash(id, 7), 100000) / 100 as decimal(12,2)) as v",
    )


def test_dedup_keeps_newest_then_tiebreak_and_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 3, 1), ("a", 3, 2), ("a", None, 9), ("b", None, 1)], "k string, at int, tie int")
    assert rows(dedup_latest(df, ["k"], "at", ["tie"])) == [("a", 3, 2), ("b", None, 1)]


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = dedup_latest(spark.range(10).selectExpr("id % 2 as k", "id as at"), ["k"], "at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("bucket_rows", [200, 1000, 10_000])
def test_bucketed_lags_and_means_equal_the_plain_window(spark, bucket_rows):
    df = gappy(spark)
    order = Window.orderBy("ts")
    mean = lambda n: F.expr(f"cast(sum(v) over (order by ts rows between {n - 1} preceding and current row) as double)"
                            f" / count(v) over (order by ts rows between {n - 1} preceding and current row)")
    plain = df.select("ts", "v", F.lag("v", 1).over(order).alias("l1"), F.lag("v", 168).over(order).alias("l168"),
                      mean(24).alias("m24"), mean(168).alias("m168"))
    ours = lags_and_means(df, "ts", {"l1": ("v", 1), "l168": ("v", 168)}, {"m24": ("v", 24), "m168": ("v", 168)},
                          bucket_rows=bucket_rows)
    same(ours, plain)


def test_means_skip_nulls_and_series_stay_apart(spark):
    df = spark.createDataFrame(
        [("x", 0, 1.0), ("x", 1, None), ("x", 2, 3.0), ("y", 0, 10.0), ("y", 1, None), ("z", 0, None)], "k string, h int, v double"
    ).selectExpr("k", "timestamp'2024-01-31 23:00:00' + make_dt_interval(0, h) as ts", "v", "h")
    got = lags_and_means(df, "ts", {"before": ("v", 1)}, {"mean": ("v", 2)}, keys=["k"], bucket_rows=3)
    assert rows(got, "k", "h", "before", "mean") == [
        ("x", 0, None, 1.0), ("x", 1, 1.0, 1.0), ("x", 2, None, 3.0), ("y", 0, None, 10.0), ("y", 1, 10.0, 10.0), ("z", 0, None, None)]


def test_bucket_must_exceed_reach(spark):
    with pytest.raises(ValueError):
        lags_and_means(gappy(spark, 10), "ts", {"l": ("v", 5)}, {}, bucket_rows=5)


def test_row_index_counts_across_months(spark):
    df = gappy(spark)
    same(row_index(df, "ts"), df.withColumn("row_index", F.row_number().over(Window.orderBy("ts")).cast("bigint") - 1))


def test_shifted_lookup_reads_by_clock_hour(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (3, 4.0)], "h int, v double").selectExpr(
        "h", "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, h) as ts", "v")
    got = shifted_lookup(df, "ts", ["h", "v"], {"one": ("v", 1), "two": ("v", 2)})
    assert rows(got, "h", "v", "one", "two") == [(0, 1.0, None, None), (1, 2.0, 1.0, None), (3, 4.0, None, 2.0)]


def _sides(spark):
    """Left and right rows; key 0 holds a third of them, times spread over a year."""
    left = spark.range(600).selectExpr(
        "id", "if(id % 3 = 0, 0, id % 20) as k",
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(pmod(hash(id), 365) as int)) as at")
    right = spark.range(300).selectExpr(
        "if(id % 3 = 0, 0, id % 23) as k",
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(pmod(hash(id, 1), 365) as int)) as at", "id as v")
    return left, dedup_latest(right, ["k", "at"], "v")


@pytest.mark.parametrize("span", [None, "month", "week"])
def test_asof_equals_brute_force(spark, span):
    left, right = _sides(spark)
    got = asof_latest(left, [Feed("r", right, "at")], ["k"], F.col("at"), span=span).selectExpr("id", "k", "r.at as found", "r.v")
    pairs = left.alias("l").join(right.alias("r"), F.expr("l.k = r.k and r.at <= l.at"), "left")
    brute = pairs.groupBy("l.id", "l.k").agg(F.max("r.at").alias("found"), F.max_by("r.v", "r.at").alias("v"))
    same(got, brute)


def test_asof_takes_several_feeds_at_once_and_ignores_null_keys(spark):
    left = spark.createDataFrame([(1, 10), (1, 20), (2, 5), (None, 9)], "k int, t int").selectExpr(
        "k", "timestamp'2024-01-01' + make_dt_interval(0, t) as at", "t")
    a = spark.createDataFrame([(1, 10, "a10"), (1, 11, "a11"), (None, 1, "a1")], "k int, t int, v string")
    b = spark.createDataFrame([(1, 19, "b19"), (2, 6, "b6")], "k int, t int, v string")
    timed = lambda df: df.selectExpr("k", "timestamp'2024-01-01' + make_dt_interval(0, t) as at", "v")
    got = asof_latest(left, [Feed("a", timed(a), "at"), Feed("b", timed(b), "at")], ["k"], F.col("at"))
    assert rows(got, "k", "t", "a.v", "b.v") == [(1, 10, "a10", None), (1, 20, "a11", "b19"), (2, 5, None, None), (None, 9, None, None)]


@pytest.mark.parametrize("hot_rows", [7, 60, 10_000])
def test_asof_with_chosen_cuts(spark, hot_rows):
    """Key 0 holds a third of the rows, most of its left rows at one moment; tasks stay near the wanted size."""
    left, right = _sides(spark)
    left = left.withColumn("at", F.expr("if(k = 0 and id % 4 > 0, timestamp'2024-05-05 05:00:00', at)"))
    lost = left.where("id < 9").withColumn("k", F.lit(None).cast("long")).unionByName(left.where("id < 5").withColumn("at", F.lit(None).cast("timestamp")))
    got = asof_latest(left.unionByName(lost), [Feed("r", right, "at"), Feed("none", right.where("false"), "at")], ["k"], F.col("at"), hot_rows=hot_rows)
    pairs = left.alias("l").join(right.alias("r"), F.expr("l.k = r.k and r.at <= l.at"), "left")
    brute = pairs.groupBy("l.id", "l.k").agg(F.max("r.at").alias("found"), F.max_by("r.v", "r.at").alias("v"))
    alone = lost.selectExpr("id", "k", "cast(null as timestamp) as found", "cast(null as long) as v")
    same(got.selectExpr("id", "k", "r.at as found", "r.v"), brute.unionByName(alone))
    assert got.where("none is not null").count() == 0


def values(spark):
    """A third of all rows share one value; the rest are spread over many magnitudes, both signs."""
    return spark.range(5000).selectExpr(
        "id", "id % 3 as g",
        "case when id % 3 = 0 then 42.5 when id % 3 = 1 then pmod(hash(id), 1000000) / 997D "
        "else (pmod(hash(id), 2000000) - 1000000) * pow(10D, id % 7) end as v")


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_exact_quantile_equals_percentile(spark, share):
    df = values(spark)
    ours = {r.g: r.quantile for r in exact_quantile(df, "v", share, ["g"]).collect()}
    for r in df.groupBy("g").agg(F.percentile("v", share).alias("p")).collect():
        assert ours[r.g] == pytest.approx(r.p, rel=1e-12)


def test_running_counts_equal_the_plain_window(spark):
    df = values(spark)
    plain = df.select("v", F.rank().over(Window.orderBy("v")).alias("r")).groupBy("v").agg(
        F.count(F.lit(1)).alias("rows"), (F.max("r") - 1 + F.count(F.lit(1))).alias("rows_upto"), F.lit(5000).alias("rows_total"))
    same(running_counts(df, "v").selectExpr("v", "rows", "rows_upto", "rows_total"), plain)


@pytest.mark.parametrize("at_least", [0.0, 0.3, 0.6, 0.95])
def test_top_share_equals_cume_dist(spark, at_least):
    """A third of the rows share one value, which is among the kept ones for the lower shares."""
    df = values(spark).selectExpr("v", "timestamp'2024-01-01' + make_dt_interval(0, cast(id as int)) as ts")
    plain = df.select("ts", "v", F.cume_dist().over(Window.orderBy("v")).alias("cume_dist"),
                      F.row_number().over(Window.orderBy(F.desc("v"), F.desc("ts"))).cast("bigint").alias("rank")).where(f"cume_dist >= {at_least}")
    same(top_share(df, "v", at_least, "ts").select("ts", "v", "cume_dist", "rank"), plain)


def test_values_at_positions(spark):
    df = spark.createDataFrame([("a", v) for v in (5, 1, 3, 3)] + [("b", -7)], "k string, v int")
    got = values_at(df, "v", {"first": "0", "third": "2"}, ["k"])
    assert rows(got, "k", "rows_total", "first", "third") == [("a", 4, 1, 3), ("b", 1, -7, None)]


def test_running_counts_share_one_scan(spark):
    df = running_counts(values(spark), "v")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_means_of_doubles_keep_small_and_large_values(spark):
    values = [2e-7, 4e-7, 1e17, 3e17, float("nan"), 5e17]
    df = spark.createDataFrame([(h, v, 10**17 + h) for h, v in enumerate(values)], "h int, v double, n long").selectExpr(
        "timestamp'2024-01-01' + make_dt_interval(0, h) as ts", "v", "n", "h")
    got = lags_and_means(df, "ts", {}, {"mean": ("v", 2), "whole": ("n", 2)}).orderBy("h").collect()
    assert [r["mean"] for r in got] == [2e-7, (2e-7 + 4e-7) / 2, (4e-7 + 1e17) / 2, 2e17, 3e17, 5e17]
    assert got[1]["whole"] == 1e17


@pytest.mark.parametrize("bucket_rows", [200, 10_000])
def test_means_of_doubles_are_exact_sums_in_one_pass(spark, bucket_rows):
    draw = random.Random(5)
    values = [draw.choice([1.0, -1.0]) * draw.random() * 10.0 ** draw.randint(-6, 12) for _ in range(700)]
    for at in range(0, 700, 50):
        values[at] = None
    values[25] = float("nan")
    df = spark.createDataFrame(list(enumerate(values)), "h int, v double").selectExpr(
        "timestamp'2024-01-01' + make_dt_interval(0, h) as ts", "v", "h")
    means = {f"m{n}": ("v", n) for n in (1, 2, 3, 7, 24, 168)}
    result = lags_and_means(df, "ts", {}, means, bucket_rows=bucket_rows)
    got = result.orderBy("h").collect()
    for name, (_, n) in means.items():
        for at, row in enumerate(got):
            frame = [v for v in values[max(0, at - n + 1):at + 1] if v is not None and v == v]
            assert row[name] == (math.fsum(frame) / len(frame) if frame else None), (name, at)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe(RowFrame, -167" not in plan and "specifiedwindowframe(RowFrame, -23," not in plan


def test_means_of_doubles_keep_infinity_inside_its_frame(spark):
    inf = float("inf")
    values = [1.0, inf, 2.0, 3.0, -inf, inf, 4.0, 5.0]
    df = spark.createDataFrame(list(enumerate(values)), "h int, v double").selectExpr(
        "timestamp'2024-01-01' + make_dt_interval(0, h) as ts", "v", "h")
    got = [r["m"] for r in lags_and_means(df, "ts", {}, {"m": ("v", 2)}).orderBy("h").collect()]
    assert got[:5] == [1.0, inf, inf, 2.5, -inf] and math.isnan(got[5]) and got[6:] == [inf, 4.5]


def test_close_values_spread_over_many_spans(spark):
    from gridcast.operators import ranks

    close = spark.range(100_000).selectExpr("100000 + id / 10000 as v")
    small = spark.range(100_000).selectExpr("(id + 1) / 1e8 as v")
    for df in (close, small, close.unionAll(small).selectExpr("-v as v")):
        spanned = df.select("v", ranks.value_span("v").alias("coarse"), ranks.value_span("v", ranks.FINE_DIGITS).alias("fine"))
        assert spanned.select("fine").distinct().count() > 50
        # fine spans lie inside their coarse one, and both follow the order of the values
        assert spanned.groupBy("fine").agg(F.count_distinct("coarse").alias("n")).where("n > 1").count() == 0
        for span in ("coarse", "fine"):
            steps = spanned.groupBy(span).agg(F.min("v").alias("low"), F.max("v").alias("high"))
            ends = [(r["low"], r["high"]) for r in steps.orderBy(span).collect()]
            assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
        values = sorted(r["v"] for r in df.collect())
        got = ranks.exact_quantile(df, "v", 0.9).first()[0]
        at = 0.9 * (len(values) - 1)
        low = int(at)
        assert got == values[low] + (values[low + 1] - values[low]) * (at - low)


def test_spans_of_zero_signs_and_extremes(spark):
    from gridcast.operators.ranks import value_span

    values = [-1e300, -5.0, -0.25, -1e-310, 0.0, 1e-310, 1e-9, 0.25, 0.5, 9.999999999999999, 10.0, 12345.0, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (4, 8):
        spans = [r["s"] for r in df.select("v", value_span("v", digits).alias("s")).orderBy("v").collect()]
        assert spans == sorted(spans) and len(set(spans)) >= 10


@pytest.mark.parametrize("value", ["1000000 + id / 1e7"])
def test_no_task_adds_up_more_than_one_level(spark, value):
    """Of 24 million rows, the spans that meet in one window."""
    from gridcast.operators import ranks

    spanned = spark.range(24_000_000).selectExpr(f"cast({value} as double) as v").select(
        ranks.value_span("v").alias("coarse"), ranks.value_span("v", ranks.FINE_DIGITS).alias("fine")).distinct()
    per_coarse = spanned.groupBy("coarse").agg(F.count("*").alias("n")).agg(F.count("*").alias("coarse"), F.max("n").alias("fine")).first()
    assert per_coarse["coarse"] < 100_000 and per_coarse["fine"] <= 10_000


def test_quantiles_leave_the_rows_in_place(spark):
    """The spans wanted are sent to the rows."""
    df = spark.range(50_000).selectExpr("id % 3 as k", "cast(hash(id) as double) as v")
    got = exact_quantile(df, "v", 0.5, ["k"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [k" in plan
    want = {k: sorted(r["v"] for r in df.where(f"k = {k}").collect()) for k in range(3)}
    for r in got.collect():
        values = want[r["k"]]
        at = 0.5 * (len(values) - 1)
        assert r["quantile"] == values[int(at)] + (values[min(int(at) + 1, len(values) - 1)] - values[int(at)]) * (at - int(at))


def test_crowded_keys_are_not_sorted(spark):
    rows = [("k", 1, 5, 1.5, "a"), ("k", 1, 7, None, "b"), ("k", 1, None, 9.0, "a"), ("k", 0, 99, 3.0, "a"),
            (None, None, 2, 4.0, None), (None, None, 1, 6.0, None), ("n", 1, None, 8.0, "c")]
    df = spark.createDataFrame(rows, "k string, at int, id long, v double, s string")
    got = dedup.dedup_crowded(df, ["k"], "at", ["id"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, dedup.dedup_latest(df, ["k"], "at", ["id"]).collect()), key=str)
    assert ("k", 1, 7, None, "b") in map(tuple, got.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
