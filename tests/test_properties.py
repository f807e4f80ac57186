"""Operators against plain Python on drawn tables."""
import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import cleaning, daily, diagnostics, features

SETTINGS = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
NUMBER = st.one_of(st.none(), st.just(math.nan), st.integers(-2, 5).map(float))
DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
TRIP = st.tuples(
    st.sampled_from(["a", "b", None]), NUMBER, NUMBER, st.sampled_from(["Y", "y", "N", None]),
    st.one_of(st.none(), st.just("later"), st.sampled_from([f"{d} 12:00:00" for d in DAYS[:4]])),
)
SERIES = st.lists(st.integers(-50, 50).map(float), min_size=3, max_size=40)


def positive(v):
    return v is not None and (math.isnan(v) or v > 0)  # NaN counts as greater than any number


@SETTINGS
@given(st.lists(TRIP, max_size=40))
def test_cleaning_and_daily_rows(spark, trips):
    frame = spark.createDataFrame(trips, "k string, d double, f double, flag string, ts string")
    wanted = [t for t in trips if positive(t[1]) and positive(t[2])]
    report = cleaning.quality_report(frame, ("d", "f"), ("ts",)).first()
    assert (report.initial_rows, report.clean_rows) == (len(trips), len(wanted))
    assert report.bad_timestamps == sum(t[4] == "later" for t in wanted)

    clean = cleaning.clean(frame, ("d", "f"), ("ts",), "flag")
    assert sorted(r.flag for r in clean.collect()) == sorted(t[3] == "Y" for t in wanted)

    groups = {}
    for k, d, _, _, ts in wanted:
        day = None if ts in (None, "later") else dt.date.fromisoformat(ts[:10])
        groups.setdefault((k, day), []).append(d)
    days = daily.daily_features(clean, "ts", {"v": "d"}, "n", ["k"]).collect()
    assert {(r.k, r.date): r.n for r in days} == {g: len(v) for g, v in groups.items()}
    for r in days:
        mean = sum(groups[(r.k, r.date)]) / r.n
        assert (math.isnan(r.v) and math.isnan(mean)) or abs(r.v - mean) < 1e-9


@SETTINGS
@given(SERIES)
def test_correlations_and_features_of_one_series(spark, values):
    n = len(values)
    frame = spark.createDataFrame(list(zip(DAYS, values)), "date date, y double")
    mean = sum(values) / n
    c = [v - mean for v in values]
    power = sum(v * v for v in c)
    found = [r.acf for r in diagnostics.acf(frame, "y").orderBy("lag").collect()]
    assert len(found) == min(20, n - 1) + 1
    for k, r in enumerate(found):
        if power > 1e-9:
            assert abs(r - sum(a * b for a, b in zip(c, c[k:])) / power) < 1e-9
    if power > 1e-9:
        rows = diagnostics.ljung_box_test(frame, "y").collect()
        for row in rows:
            q = n * (n + 2) * sum(found[k] ** 2 / (n - k) for k in range(1, row.lag + 1))
            assert abs(row.q - q) < 1e-6 and 0 <= row.p_value <= 1

    rolled = features.add_rolling_features(features.add_lag_features(frame, "y", [2]), "y", [3])
    for i, row in enumerate(rolled.orderBy("date").collect()):
        before = values[max(0, i - 3) : i]
        assert row.y_lag_2 == (values[i - 2] if i >= 2 else None)
        assert row.y_max_3 == (max(before) if before else None)
        assert row.y_mean_3 is None if not before else abs(row.y_mean_3 - sum(before) / len(before)) < 1e-9
