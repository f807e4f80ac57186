import datetime as dt
import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import cleaning, daily, features

SCHEMA = "d double, f double, flag string, ts string"
NAN = float("nan")
DIRTY = [
    (1.0, 1.0, "Y", "2024-01-01 10:00:00"),
    (2.0, 1.0, "y", "2024-01-01 11:00:00"),
    (3.0, 1.0, "N", "nonsense"),
    (4.0, 1.0, None, None),
    (0.0, 1.0, "Y", "2024-01-02 00:00:00"),
    (1.0, -1.0, "Y", "2024-01-02 00:00:00"),
    (None, 1.0, "Y", "2024-01-02 00:00:00"),
    (NAN, 1.0, "Y", "2024-01-03 00:00:00"),
]


@pytest.fixture()
def dirty(spark):
    return spark.createDataFrame(DIRTY, SCHEMA)


def test_filter_is_strict_drops_null_and_keeps_nan(dirty):
    kept = [r.d for r in cleaning.positive_rows(dirty, ("d", "f")).collect()]
    assert kept[:4] == [1.0, 2.0, 3.0, 4.0] and math.isnan(kept[4]) and len(kept) == 5
    assert cleaning.positive_rows(dirty, ("d", "f"), drop_nan=True).count() == 4


def test_flag_is_true_for_the_exact_value_only(dirty):
    flags = [r.flag for r in cleaning.flag_to_boolean(dirty, "flag").collect()]
    assert flags[:4] == [True, False, False, False]


def test_bad_text_becomes_null_and_is_counted(dirty):
    rows = cleaning.clean(dirty, ("d", "f"), ("ts",), "flag").collect()
    assert [r.ts for r in rows[:4]] == [
        dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11), None, None,
    ]
    report = cleaning.quality_report(dirty, ("d", "f"), ("ts",)).first()
    assert (report.initial_rows, report.clean_rows, report.removed_rows) == (8, 5, 3)
    assert report.removed_pct == pytest.approx(37.5) and report.bad_timestamps == 1


def test_report_of_an_empty_table_has_a_null_share(spark):
    report = cleaning.quality_report(spark.createDataFrame([], SCHEMA), ("d", "f"), ("ts",)).first()
    assert report.initial_rows == 0 and report.removed_pct is None


def test_observation_gives_the_report_of_the_same_pass(spark, dirty, tmp_path):
    seen = Observation()
    cleaning.clean(dirty, ("d", "f"), ("ts",), "flag", observation=seen).write.parquet(str(tmp_path / "c"))
    assert seen.get == {"initial_rows": 8, "clean_rows": 5, "bad_timestamps": 1}


def test_other_columns_pass_through(dirty):
    cleaned = cleaning.clean(dirty.withColumn("extra", F.lit(7)), ("d",), ("ts",), "flag")
    assert cleaned.columns == ["d", "f", "flag", "ts", "extra"]


def test_filter_reaches_the_scan(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    days = daily.daily_features(
        cleaning.positive_rows(lines, ("l_discount", "l_tax")), "l_shipdate", {"p": "l_extendedprice"}
    )
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_discount,0.0)" in plan and "GreaterThan(l_tax,0.0)" in plan
    read = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "l_orderkey" not in read and "l_extendedprice" in read
    assert "partial_avg" in plan


def test_null_dates_form_a_row_that_modelling_leaves_out(dirty):
    days = daily.daily_features(cleaning.clean(dirty, ("d", "f"), ("ts",)), "ts", {"v": "d"}, "n")
    found = {r.date: (r.v, r.n) for r in days.collect()}
    assert found[None] == (3.5, 2) and found[dt.date(2024, 1, 1)] == (1.5, 2)
    assert math.isnan(found[dt.date(2024, 1, 3)][0])
    assert daily.series_rows(days, (), "date", "v").first().n_obs == 1


def _days(spark, lengths, gap_in=None):
    rows = []
    for key, n in lengths.items():
        for i in range(n):
            day = dt.date(2024, 1, 1) + dt.timedelta(days=i + (5 if key == gap_in and i > 3 else 0))
            rows.append((key, day, float(i * i % 7), float(i), float(i % 3)))
    return spark.createDataFrame(rows, "k string, date date, y double, x1 double, x2 double")


def test_period_index_ignores_gaps(spark):
    days = daily.period_index(_days(spark, {"a": 8}, gap_in="a"), ["k"])
    assert sorted(r.t for r in days.collect()) == list(range(1, 9))


def test_last_rows_are_as_many_as_there_are(spark):
    tail = daily.last_rows(_days(spark, {"a": 3, "b": 9}), 5, ["k"]).collect()
    steps = {k: sorted((r.horizon_step, r.x1) for r in tail if r.k == k) for k in "ab"}
    assert steps["a"] == [(1, 0.0), (2, 1.0), (3, 2.0)]
    assert steps["b"] == [(i + 1, i + 4.0) for i in range(5)]


def test_length_status_at_the_boundary(spark):
    got = {r.k: r.status for r in daily.series_lengths(_days(spark, {"a": 9, "b": 10}), ["k"]).collect()}
    assert got == {"a": "too_short", "b": "ok"}


def test_complete_cases_drop_null_and_nan(spark):
    frame = spark.createDataFrame(
        [(1.0, 1.0), (None, 1.0), (NAN, 1.0), (1.0, NAN), (2.0, 2.0)], "y double, x double"
    )
    assert daily.complete_cases(frame, ["y", "x"]).count() == 2


@pytest.mark.parametrize("n, held", [(1, 1), (4, 1), (9, 1), (10, 2), (34, 6), (35, 7), (60, 7)])
def test_holdout_length(spark, n, held):
    split = features.train_test_split_ts(_days(spark, {"a": n}), ["k"])
    assert split.filter("split = 'test'").count() == held


def test_split_by_size_and_bad_arguments(spark):
    days = _days(spark, {"a": 10})
    assert features.train_test_split_ts(days, ["k"], test_size=3).filter("split = 'test'").count() == 3
    with pytest.raises(ValueError):
        features.train_test_split_ts(days, ["k"], test_size=3, train_fraction=0.5)


def test_parse_drops_what_is_no_date_and_refuses_doubles(spark):
    text = spark.createDataFrame([("a", "2024-01-01"), ("a", "never"), ("a", None)], "k string, day string")
    parsed = features.parse_datetime_index(text, "day", ["k"])
    assert [r.day for r in parsed.collect()] == [dt.date(2024, 1, 1)]
    with pytest.raises(Exception, match="more than one row per series and day"):
        features.parse_datetime_index(text.union(text), "day", ["k"]).collect()


def test_rolling_windows_do_not_see_today(spark):
    rolled = features.add_rolling_features(_days(spark, {"a": 5}), "x1", [3], ["k"]).orderBy("date").collect()
    assert rolled[0].x1_mean_3 is None and rolled[1].x1_mean_3 == 0.0
    assert rolled[4].x1_mean_3 == 2.0 and rolled[4].x1_max_3 == 3.0


def test_hour_only_for_timestamps(spark):
    days = _days(spark, {"a": 1})
    assert "hour" not in features.add_calendar_features(days).columns
    assert "hour" in features.add_calendar_features(days.select(F.col("date").cast("timestamp").alias("date"))).columns


def test_series_arrays_are_in_order_of_date_whatever_the_input_order(spark):
    days = _days(spark, {"a": 20}).orderBy(F.rand(1))
    row = daily.series_rows(days, ["k"], "date", "x1", ["x2"]).first()
    assert row.y == [float(i) for i in range(20)] and row.x == [[float(i % 3) for i in range(20)]]


def test_one_series_is_numbered_and_lagged_in_blocks(spark):
    import random
    from datetime import date, timedelta

    from tidemark.operators import daily

    random.seed(5)
    days = sorted(random.sample(range(4000), 700))
    rows = [(date(1995, 1, 1) + timedelta(d), float(d)) for d in days]
    frame = spark.createDataFrame(random.sample(rows, len(rows)), "date date, v double")
    found = daily.with_lags(
        daily.numbered(frame, block_days=50), {"l1": ("v", 1), "l9": ("v", 9)}, block_rows=10
    )
    got = [tuple(r) for r in found.orderBy("t").select("t", "n_obs", "v", "l1", "l9").collect()]
    v = [float(d) for d in days]
    assert got == [(i + 1, 700, v[i], v[i - 1] if i else None, v[i - 9] if i >= 9 else None) for i in range(700)]
    assert daily.numbered(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        daily.with_lags(daily.numbered(frame), {"l": ("v", 11)}, block_rows=10)


def test_no_task_holds_all_days_of_one_series(spark):
    """Rows gather in one place only as counts of blocks or as sums."""
    from tidemark.operators import diagnostics, models

    days = spark.range(1000).select(F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")).alias("date"), (F.col("id") % 7).cast("double").alias("v"))
    for frame in (diagnostics.acf(days, "v"), models.ar1_baseline(days, (), "date", "v"), diagnostics.check_stationarity(days, "v")):
        lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = lines[i + 1].split("- ", 1)[-1]
                assert below.lstrip("*(0123456789) ").startswith(("HashAggregate", "ObjectHashAggregate", "SortAggregate")), below
