"""Daily states: merged parts equal the whole, and files count once whatever happens between them."""
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import JobConfig, TableStore
from tidemark.operators.daily import daily_features
from tidemark.operators.states import daily_states, features_of_states
from tidemark.plans.job import ForecastJob
from tidemark.sources import append_new_files
from tidemark.sources.increments import BATCH

AVERAGES = {"mean": "v", "price": "d", "whole": "i"}
SCHEMA = "k string, ts timestamp, v double, d decimal(12,2), i bigint"
ROWS = [
    ("a", datetime(2024, 1, 1, 5), 1.5, Decimal("2.25"), 2**62),
    ("a", datetime(2024, 1, 1, 6), None, Decimal("1.00"), 2**62),
    ("a", datetime(2024, 1, 2), None, None, None),
    (None, datetime(2024, 1, 1), 4.0, Decimal("0.01"), 7),
    ("b", None, 2.0, Decimal("-3.10"), 1),
    ("b", datetime(2024, 1, 1), 2.0, Decimal("1.00"), 1),
    ("b", datetime(2024, 1, 1), 2.0, Decimal("1.00"), 1),
]


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("keys", [(), ("k",)])
@pytest.mark.parametrize("cut", range(len(ROWS) + 1))
def test_merged_parts_equal_the_whole(spark, keys, cut):
    args = ("ts", AVERAGES, "n", keys, "day")
    parts = [daily_states(spark.createDataFrame(rows, SCHEMA), *args) for rows in (ROWS[:cut], ROWS[cut:])]
    merged = features_of_states(parts[0].unionByName(parts[1]), AVERAGES, "n", keys, "day")
    whole = daily_features(spark.createDataFrame(ROWS, SCHEMA), *args)
    assert _sorted(merged) == _sorted(whole)
    assert merged.dtypes == whole.dtypes


def test_no_rows_give_no_states(spark):
    states = daily_states(spark.createDataFrame([], SCHEMA), "ts", AVERAGES)
    assert features_of_states(states, AVERAGES).isEmpty()


def _write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def _take(store, folder, name, log=None):
    def change(rows):
        if log is not None:
            log.append({r[0].split("/")[-2] for r in rows.select(F.input_file_name()).collect()})
        return daily_states(rows, "ts", AVERAGES, "n", ("k",), "day")

    return append_new_files(store, f"{folder}/*", name, change)


def test_only_new_files_are_read_and_each_counts_once(spark, tmp_path):
    store = TableStore(spark)
    _write(spark, tmp_path, "one", ROWS[:3])
    assert _take(store, tmp_path, "s_new") == 1
    first = store.read("s_new").inputFiles()
    assert _take(store, tmp_path, "s_new") == 0
    assert store.read("s_new").inputFiles() == first
    _write(spark, tmp_path, "two", ROWS[3:])
    read = []
    assert _take(store, tmp_path, "s_new", read) == 1
    assert read == [{"two"}]
    found = features_of_states(store.read("s_new").drop(BATCH), AVERAGES, "n", ("k",), "day")
    whole = daily_features(spark.createDataFrame(ROWS, SCHEMA), "ts", AVERAGES, "n", ("k",), "day")
    assert _sorted(found) == _sorted(whole)
    assert set(first) < set(store.read("s_new").inputFiles())


@pytest.mark.parametrize("after", [False, True], ids=["before the write", "after the write"])
def test_a_batch_that_died_is_repeated_without_doubling(spark, tmp_path, monkeypatch, after):
    name = f"s_died_{after}".lower()
    store = TableStore(spark)
    _write(spark, tmp_path, "one", ROWS[:3])
    _take(store, tmp_path, name)
    _write(spark, tmp_path, "two", ROWS[3:])
    append = TableStore.append

    def dying(self, *args, **more):
        if after:
            append(self, *args, **more)
        raise RuntimeError("the writer died")

    with monkeypatch.context() as patched, pytest.raises(Exception, match="the writer died"):
        patched.setattr(TableStore, "append", dying)
        _take(store, tmp_path, name)
    assert _take(store, tmp_path, name) == 1
    assert store.read(name).agg(F.sum("n")).first()[0] == len(ROWS)
    assert store.read(name).select(BATCH).distinct().count() == 2


def test_old_files_that_come_late_count(spark, tmp_path):
    import os

    store = TableStore(spark)
    _write(spark, tmp_path, "one", ROWS[:3])
    _take(store, tmp_path, "s_late")
    _write(spark, tmp_path, "two", ROWS[3:])
    for file in (tmp_path / "two").glob("*.parquet"):
        os.utime(file, (10**9, 10**9))
    assert _take(store, tmp_path, "s_late") == 1
    assert store.read("s_late").agg(F.sum("n")).first()[0] == len(ROWS)


def test_a_dropped_table_starts_anew(spark, tmp_path):
    store = TableStore(spark)
    _write(spark, tmp_path, "one", ROWS)
    for drop in (lambda: store.drop("s_anew"), lambda: spark.sql("DROP TABLE s_anew"), lambda: None):
        assert _take(store, tmp_path, "s_anew") == 1
        assert store.read("s_anew").agg(F.sum("n")).first()[0] == len(ROWS)
        drop()


def test_job_that_merges_equals_the_job_that_rebuilds(spark, sf, tmp_path):
    folder, all_events = tmp_path / "in", spark.read.parquet(f"{sf}/events.parquet")
    last = all_events.agg(F.max(F.to_date("ts"))).first()[0]
    roles = dict(
        raw_parquet_path=str(folder), lookup_csv_path=None, series_keys=("event_type",), ts_col="ts", other_ts_cols=(),
        positive_cols=("value",), flag_col=None, target_col="avg_value", averages=(("avg_value", "value"),),
        count_col="n_rows", exog_cols=("n_rows",), min_aic_improvement=-1000.0,
    )
    tables = [f for f in JobConfig.__dataclass_fields__ if f.endswith("_table") or f.endswith("table_name")]
    merge, rebuild = (
        JobConfig.from_args(**roles, **{t: f"{tag}_{t}" for t in tables}, feature_mode=tag) for tag in ("merge", "rebuild")
    )
    all_events.where(F.to_date("ts") < last).write.parquet(str(folder))
    ForecastJob(spark, merge).run()
    all_events.where(F.to_date("ts") == last).write.mode("append").parquet(str(folder))
    job = ForecastJob(spark, merge)
    job.run()
    assert job.counts["initial_rows"] == all_events.where(F.to_date("ts") == last).count()
    ForecastJob(spark, rebuild).run()
    days = [_sorted(spark.table(c.daily_features_table)) for c in (merge, rebuild)]
    assert [(*d[:2], d[3]) for d in days[0]] == [(*d[:2], d[3]) for d in days[1]]
    assert [d[2] for d in days[0]] == pytest.approx([d[2] for d in days[1]])
    assert spark.table(merge.predictions_table).count() == spark.table(rebuild.predictions_table).count() > 0
    assert not spark.catalog.tableExists(merge.raw_table_name)


def test_delta_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="Delta"):
        append_new_files(TableStore(spark, "delta"), str(tmp_path), "s_delta", lambda rows: rows)
