"""Tables bucketed by series: the same results, and no exchange between them."""
import pytest
from pyspark.sql import functions as F

from tidemark import JobConfig, TableStore
from tidemark.operators import daily, models, registry
from tidemark.plans.job import ForecastJob
from tidemark.sources import Buckets

BY_K = Buckets(("k",), 4)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _config(tag, sf, **more):
    tables = [f for f in JobConfig.__dataclass_fields__ if f.endswith("_table") or f.endswith("table_name")]
    return JobConfig.from_args(
        **{t: f"{tag}_{t}" for t in tables}, raw_parquet_path=f"{sf}/events.parquet", raw_mode="link", clean_mode="view",
        lookup_csv_path=None, series_keys=("event_type",), ts_col="ts", other_ts_cols=(), positive_cols=("value",),
        flag_col=None, target_col="avg_value", averages=(("avg_value", "value"),), count_col="n_rows",
        exog_cols=("n_rows",), min_aic_improvement=-1000.0, **more,
    )


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")
    before = [spark.conf.get(key) for key in keys]
    spark.conf.set(keys[0], "-1")
    yield
    for key, value in zip(keys, before):
        spark.conf.set(key, value)


def test_buckets_survive_overwrites_appends_and_changes(spark, no_broadcast):
    store = TableStore(spark)
    rows = spark.range(100).select((F.col("id") % 7).cast("string").alias("k"), "id")
    for df in (rows, rows.limit(50), rows.withColumn("more", F.lit(1)), rows):
        store.overwrite(df, "b_over", replace_schema=True, buckets=BY_K)
        assert store.read("b_over").count() == df.count()
        assert store._buckets("b_over") == BY_K
    for run in ("x", "y", "x"):
        store.append(rows.withColumn("run", F.lit(run)), "b_app", ["run"], replace_partitions=True, buckets=BY_K)
    assert store.read("b_app").count() == 200
    store.append(rows.withColumns({"new": F.lit(2), "run": F.lit("z")}), "b_app", ["run"], replace_partitions=True, buckets=BY_K)
    assert store.read("b_app").agg(F.sum("new"), F.count("*")).first()[:] == (200, 300)
    both = store.read("b_over").join(store.read("b_app").select("k", "new"), "k")
    assert "Exchange" not in _plan(both)
    assert both.count() == rows.join(rows.select("k"), "k").count() * 3
    names = {t.name for t in spark.catalog.listTables()}
    assert not {n for n in names if n.startswith("b_over_")}
    store.overwrite(rows, "b_over", replace_schema=True)
    assert store._buckets("b_over") is None and store.read("b_over").count() == 100


def test_a_bucketed_job_equals_the_plain_one_and_exchanges_nothing(spark, sf, no_broadcast):
    plain, bucketed = _config("flat", sf), _config("dealt", sf, series_buckets=4)
    jobs = [ForecastJob(spark, c) for c in (plain, bucketed)]
    for job in jobs:
        job.run()
    steps = [
        {(r.event_type, r.horizon_step): r.forecast_avg_value for r in spark.table(c.predictions_table).collect()}
        for c in (plain, bucketed)
    ]
    assert steps[0] == pytest.approx(steps[1]) and len(steps[0]) == 25
    assert daily.SERIES not in spark.table(bucketed.predictions_table).columns
    jobs[1].run()
    assert spark.table(bucketed.model_store_table).select("run_id").distinct().count() == 2
    assert spark.table(bucketed.predictions_table).count() == 25

    fits = models.train(
        spark.table(bucketed.daily_features_table), jobs[1].keys, bucketed.date_col, bucketed.target_col, bucketed.exog_cols,
        spread=False,
    )
    newest = registry.latest_models(spark.table(bucketed.registry_table), jobs[1].keys, columns=["run_id", "model_id", "model_version"])
    ready = jobs[1]._models_with_regressors(newest)
    assert "Exchange" not in _plan(fits)
    assert "Exchange" not in _plan(ready)
    assert ready.count() == 5


def test_a_null_key_is_a_series(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    path = str(tmp_path / "events.parquet")
    least = events.agg(F.min("event_type")).first()[0]
    events.withColumn("event_type", F.when(F.col("event_type") != least, F.col("event_type"))).write.parquet(path)
    cfg = JobConfig.from_args(**{**_config("nulls", sf, series_buckets=3).to_dict(), "raw_parquet_path": path})
    ForecastJob(spark, cfg).run()
    assert spark.table(cfg.predictions_table).where("event_type IS NULL").count() == 5


def test_buckets_need_series_and_parquet(spark):
    for more in (dict(series_buckets=4), dict(series_buckets=0, series_keys=("a",))):
        with pytest.raises(ValueError, match="series_buckets"):
            JobConfig(**more)
    with pytest.raises(ValueError, match="Delta"):
        TableStore(spark, "delta").overwrite(spark.range(1), "b_delta", buckets=Buckets(("id",), 2))
