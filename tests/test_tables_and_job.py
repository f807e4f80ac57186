from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark import JobConfig, TableStore, read_csv_from_files, read_delta, write_delta
from tidemark.plans import cli
from tidemark.plans.job import ForecastJob
from tidemark.sources.tables import SchemaMismatch

ROLES = dict(
    lookup_csv_path=None, ts_col="l_shipdate", other_ts_cols=(), positive_cols=("l_discount", "l_tax"),
    flag_col="l_returnflag", flag_true="R", target_col="avg_price", count_col="n_rows",
    averages=(("avg_price", "l_extendedprice"), ("avg_quantity", "l_quantity")),
    exog_cols=("avg_quantity", "n_rows"),
)
TABLES = (
    "raw_table_name", "clean_table_name", "daily_features_table", "registry_table", "predictions_table",
    "scoring_log_table", "model_store_table", "run_log_table", "holdout_table", "holdout_metrics_table",
)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Three months of the smallest lineitem, so that one series has 90 days."""
    path = str(tmp_path_factory.mktemp("in") / "lineitem.parquet")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lines.filter("l_shipdate < '1995-09-01'").coalesce(1).write.parquet(path)
    return path


def _config(tag, path, **more):
    names = {t: f"{tag}_{t}" for t in TABLES}
    return JobConfig.from_args(**{**ROLES, **names, "raw_parquet_path": path, **more})


def test_fixed_and_replaceable_schemas(spark):
    store = TableStore(spark)
    one = spark.range(3).withColumn("a", F.lit("x"))
    store.overwrite(one, "t_fixed")
    store.overwrite(one.limit(1), "t_fixed")
    assert store.read("t_fixed").count() == 1
    with pytest.raises(SchemaMismatch):
        store.overwrite(one.withColumn("b", F.lit(1)), "t_fixed")
    assert store.read("t_fixed").count() == 1
    store.overwrite(one.withColumn("b", F.lit(1)), "t_fixed", replace_schema=True)
    assert store.read("t_fixed").columns == ["id", "a", "b"]


def test_append_adds_columns_and_fills_missing_ones(spark):
    store = TableStore(spark)
    store.append(spark.range(2), "t_grow")
    store.append(spark.range(1).withColumn("note", F.lit("n")), "t_grow")
    store.append(spark.range(1), "t_grow")
    rows = store.read("t_grow")
    assert rows.columns == ["id", "note"] and rows.count() == 4
    assert rows.filter("note is null").count() == 3
    with pytest.raises(SchemaMismatch):
        store.append(spark.range(1).select(F.col("id").cast("string")), "t_grow")


def test_append_to_a_partitioned_table(spark):
    store = TableStore(spark)
    for run in ("r1", "r2"):
        store.append(spark.range(2).withColumn("run_id", F.lit(run)), "t_parts", ["run_id"])
    plan = store.read("t_parts").filter("run_id = 'r2'")
    assert plan.count() == 2
    assert "PartitionFilters: [isnotnull(run_id" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partition_by", [(), ("a",)])
def test_a_writer_that_dies_leaves_old_or_new_rows(spark, monkeypatch, partition_by):
    """Stop an overwrite before each of its statements in turn; a fresh store then finds whole rows."""
    old = spark.range(3).withColumn("a", F.lit("x"))
    new = spark.range(5).select((F.col("id") + 10).alias("id"), F.lit("y").alias("a"), F.lit(1.5).alias("more"))
    new = new.select("id", "more", "a") if partition_by else new
    calls = ("sql", "_intend", "_forget")
    real_sql = type(spark).sql

    class Dead(Exception):
        pass

    for stop in range(1, 9):
        store, name = TableStore(spark), f"t_dies_{len(partition_by)}_{stop}"
        store.overwrite(old, name)
        left = [stop]

        def counted(fn):
            def run(*args, **kwargs):
                left[0] -= 1
                if left[0] == 0:
                    raise Dead
                return fn(*args, **kwargs)

            return run

        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", counted(real_sql))
            for call in calls[1:]:
                patch.setattr(TableStore, call, counted(getattr(TableStore, call)))
            try:
                store.overwrite(new, name, replace_schema=True, partition_by=partition_by)
            except Dead:
                pass
        ids = sorted(r.id for r in TableStore(spark).read(name).collect())
        assert ids in ([0, 1, 2], [10, 11, 12, 13, 14])
        TableStore(spark).overwrite(old, name, replace_schema=True)
        assert TableStore(spark).read(name).count() == 3
        store.drop(name)
        assert not store.exists(name)


def test_a_record_cut_short_is_no_record(spark):
    store = TableStore(spark)
    store.overwrite(spark.range(2), "t_cut")
    record = store._path(f"{store._root('t_cut')}/_intent")
    stream = store._files(record).create(record, False)
    stream.write(bytearray(b'{"folder": "'))
    stream.close()
    assert store.read("t_cut").count() == 2 and not store._files(record).exists(record)


def test_readers_keep_the_snapshot_they_began_with(spark):
    store = TableStore(spark)
    store.overwrite(spark.range(2), "t_snap")
    begun = store.read("t_snap")
    store.overwrite(spark.range(7), "t_snap")
    assert begun.count() == 2 and store.read("t_snap").count() == 7
    with pytest.raises(ValueError):
        store.link("/tmp", "t_snap")
    for n in range(3):
        store.overwrite(spark.range(n), "t_snap")
    root = store._path(store._root("t_snap"))
    assert len(store._files(root).listStatus(root)) == 2


def test_a_repeated_append_replaces_its_own_rows(spark):
    store = TableStore(spark)
    for run, n in (("r1", 2), ("r2", 3), ("r1", 4)):
        store.append(spark.range(n).withColumn("run_id", F.lit(run)), "t_again", ["run_id"], replace_partitions=True)
    store.append(spark.range(1).selectExpr("id", "'n' AS note", "'r3' AS run_id"), "t_again", ["run_id"], replace_partitions=True)
    assert {r.run_id: r.n for r in store.read("t_again").groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {"r1": 4, "r2": 3, "r3": 1}
    store.drop_partition("t_again", "run_id", "r2")
    assert store.read("t_again").count() == 5


def test_every_step_twice_with_one_run_id_leaves_single_rows(spark, small):
    cfg = _config("again", small, min_aic_improvement=-1e9)
    job = ForecastJob(spark, cfg)
    for step in (job.ingest_data, job.clean_data, job.engineer_features):
        step()
        step()
    for _ in range(2):
        job.train_models("run-1")
        job.register_model()
        job.run_batch_inference("scoring-1")
    for table in (cfg.model_store_table, cfg.registry_table, cfg.scoring_log_table):
        assert spark.table(table).count() == 1
    keys = spark.table(cfg.run_log_table).groupBy("run_id", "kind", "key").count()
    assert keys.filter("count > 1").count() == 0


def test_a_run_that_raises_leaves_no_models(spark, small):
    cfg = _config("debris", small, min_observations=10_000)
    job = ForecastJob(spark, cfg)
    for step in (job.ingest_data, job.clean_data, job.engineer_features):
        step()
    with pytest.raises(ValueError):
        job.train_models()
    assert spark.table(cfg.model_store_table).count() == 0


def test_read_and_write_by_mode(spark):
    frame = spark.range(2)
    write_delta(frame, "t_modes", format="parquet")
    write_delta(frame, "t_modes", mode="append", format="parquet")
    assert read_delta(spark, "t_modes").count() == 4
    with pytest.raises(ValueError):
        write_delta(frame, "t_modes", mode="merge", format="parquet")


def test_csv_columns_are_text(spark, sf, tmp_path):
    path = str(tmp_path / "zones")
    spark.read.parquet(f"{sf}/nation.parquet").write.option("header", "true").csv(path)
    read = read_csv_from_files(spark, path)
    assert {t for _, t in read.dtypes} == {"string"} and read.count() == 25
    named = read_csv_from_files(spark, path, read.columns)
    assert sorted(map(tuple, named.collect())) == sorted(map(tuple, read.collect()))


def test_whole_job_twice(spark, small):
    cfg = _config("twice", small)
    for run in (1, 2):
        job = ForecastJob(spark, cfg)
        job.run()
        assert job.counts["raw_rows"] == job.counts["initial_rows"] == spark.read.parquet(small).count()
        assert job.counts["clean_rows"] == spark.table(cfg.clean_table_name).count()
        assert spark.table(cfg.registry_table).count() == run
        assert spark.table(cfg.model_store_table).count() == run
        assert spark.table(cfg.scoring_log_table).count() == run
        assert spark.table(cfg.predictions_table).count() == 5
    assert spark.table(cfg.raw_table_name).count() == spark.read.parquet(small).count()
    newest = spark.table(cfg.registry_table).orderBy(F.desc("created_utc")).first()
    used = {r.model_id for r in spark.table(cfg.predictions_table).collect()}
    assert used == {newest.model_id} and newest.run_id == job.run_id
    assert dict(spark.table(cfg.predictions_table).dtypes)["forecast_avg_price"] == "double"
    keys = {r.key for r in spark.table(cfg.run_log_table).collect()}
    assert {"order", "seasonal_order", "exog_columns", "n_obs", "train_aic_baseline", "train_aic_sarimax"} <= keys
    assert job.evaluate_holdout().filter("status = 'ok'").count() == 7
    found = {name: frame.count() for name, frame in job.diagnose().items()}
    assert found["acf"] == 21 and found["ljung_box"] == 2


def test_job_over_many_series_with_linked_input(spark, sf):
    cfg = _config(
        "many", f"{sf}/events.parquet", raw_mode="link", series_keys=("event_type",), ts_col="ts",
        positive_cols=("value",), flag_col=None, averages=(("avg_price", "value"),),
        exog_cols=("n_rows",), min_aic_improvement=-1000.0,
    )
    ForecastJob(spark, cfg).run()
    assert spark.table(cfg.raw_table_name).count() == spark.read.parquet(f"{sf}/events.parquet").count()
    steps = spark.table(cfg.predictions_table)
    assert steps.count() == 25 and steps.select("event_type").distinct().count() == 5
    assert spark.table(cfg.scoring_log_table).first().n_series == 5


def test_one_pass_over_the_input_gives_the_same_days(spark, small):
    lean = _config("lean", small, raw_mode="link", clean_mode="view")
    full = _config("full", small)
    jobs = [ForecastJob(spark, cfg) for cfg in (lean, full)]
    for job in jobs:
        job.run()
    counts = [{k: j.counts[k] for k in ("initial_rows", "clean_rows", "bad_timestamps")} for j in jobs]
    assert counts[0] == counts[1]
    days = [sorted(map(tuple, spark.table(c.daily_features_table).collect())) for c in (lean, full)]
    assert [d[0] for d in days[0]] == [d[0] for d in days[1]]
    assert [v for d in days[0] for v in d[1:]] == pytest.approx([v for d in days[1] for v in d[1:]])


def test_one_pass_reads_only_the_columns_it_needs(spark, small):
    from tidemark.operators.daily import daily_features

    cfg = _config("narrow", small, raw_mode="link", clean_mode="view")
    job = ForecastJob(spark, cfg)
    job.ingest_data()
    days = daily_features(job.clean_data(), cfg.ts_col, dict(cfg.averages), cfg.count_col)
    plan = days._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "l_extendedprice" in read and "l_orderkey" not in read and "l_linestatus" not in read


def test_gate_leaves_the_registry_alone_and_inference_is_skipped(spark, small):
    cfg = _config("gated", small, min_aic_improvement=1e12)
    job = ForecastJob(spark, cfg)
    job.run()
    assert not spark.catalog.tableExists(cfg.registry_table)
    assert not spark.catalog.tableExists(cfg.predictions_table)
    assert spark.table(cfg.model_store_table).count() == 1
    assert job.run_batch_inference() is None


def test_steps_out_of_order_and_too_little_data(spark, small, tmp_path):
    with pytest.raises(RuntimeError):
        ForecastJob(spark, _config("early", small)).register_model()
    path = str(tmp_path / "few.parquet")
    spark.read.parquet(small).limit(5).write.parquet(path)
    with pytest.raises(ValueError, match="not enough data"):
        ForecastJob(spark, _config("few", path)).run()


def test_config_rules():
    with pytest.raises(ValueError):
        JobConfig(forecast_horizon=0)
    with pytest.raises(ValueError):
        JobConfig(min_observations=1)
    with pytest.raises(TypeError):
        JobConfig.from_args(horizon=3)
    assert JobConfig(series_keys=["a"]).series_keys == ("a",)
    shown = JobConfig().to_dict()
    assert shown["forecast_horizon"] == 5 and shown["exog_cols"] == ("avg_trip_distance", "trip_count")


def test_command_line(spark, monkeypatch):
    given = cli.parse_arguments(["--forecast-horizon", "7", "--series-keys", "a", "b", "--skip-inference"])
    assert given.forecast_horizon == 7 and given.series_keys == ["a", "b"] and given.skip_inference
    assert given.raw_table_name == JobConfig().raw_table_name
    ran = []
    monkeypatch.setattr(cli.ForecastJob, "run", lambda self, skip_inference, evaluate: ran.append(skip_inference))
    assert cli.main(["--dry-run"]) == 0 and ran == []
    assert cli.main(["--skip-inference"]) == 0 and ran == [True]
    assert cli.main(["--forecast-horizon", "0"]) == 1


def test_command_line_sets_the_model(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(cli, "ForecastJob", lambda spark, config: seen.append(config) or SimpleNamespace(run=lambda **_: None))
    numbers = ["--min-observations", "20", "--seasonal-from", "40", "--fit-partitions", "3"]
    orders = ["--sarimax-order", "2", "0", "1", "--sarimax-seasonal-order", "1", "0", "0", "5"]
    assert cli.main([*numbers, *orders, "--feature-mode", "merge", "--daily-states-table", "s"]) == cli.main([]) == 0
    given, default = seen
    assert (given.min_observations, given.seasonal_from, given.fit_partitions) == (20, 40, 3)
    assert (given.sarimax_order, given.sarimax_seasonal_order) == ((2, 0, 1), (1, 0, 0, 5))
    assert (given.feature_mode, given.daily_states_table) == ("merge", "s")
    assert default == JobConfig()
    assert cli.main(["--feature-mode", "other"]) == 1


def test_command_line_reports_failure(spark):
    assert cli.main(["--raw-parquet-path", "/nowhere/none.parquet"]) == 1


def test_skip_inference_stops_after_registration(spark, small):
    cfg = _config("skip", small)
    ForecastJob(spark, cfg).run(skip_inference=True)
    assert spark.catalog.tableExists(cfg.registry_table)
    assert not spark.catalog.tableExists(cfg.predictions_table)


def test_linking_never_deletes_rows_that_were_copied(spark, small):
    copied = _config("kept", small)
    ForecastJob(spark, copied).ingest_data()
    linked = _config("kept", small, raw_mode="link")
    with pytest.raises(ValueError, match="rows of its own"):
        ForecastJob(spark, linked).ingest_data()
    assert spark.table(copied.raw_table_name).count() == spark.read.parquet(small).count()


def test_linking_a_relative_path(spark, small):
    import os

    TableStore(spark).link(os.path.relpath(small), "t_relative")
    TableStore(spark).link(os.path.relpath(small), "t_relative")
    assert spark.table("t_relative").count() == spark.read.parquet(small).count()


def test_a_failed_overwrite_leaves_the_old_rows(spark):
    store = TableStore(spark)
    store.overwrite(spark.range(5), "t_safe")
    bad = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        store.overwrite(bad, "t_safe")
    assert store.read("t_safe").count() == 5
    store.overwrite(store.read("t_safe").filter("id > 2"), "t_safe")
    assert store.read("t_safe").count() == 2
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("t_safe_")]


def test_registering_twice_adds_nothing_and_is_counted_once(spark, sf):
    cfg = _config(
        "once", f"{sf}/events.parquet", series_keys=("event_type",), ts_col="ts",
        positive_cols=("value",), flag_col=None, averages=(("avg_price", "value"),),
        exog_cols=("n_rows",), min_aic_improvement=-1000.0,
    )
    job = ForecastJob(spark, cfg)
    for step in (job.ingest_data, job.clean_data, job.engineer_features, job.train_models):
        step()
    first = job.register_model().count()
    assert job.register_model().count() == first == spark.table(cfg.registry_table).count()
    job.run_batch_inference()
    steps = spark.table(cfg.predictions_table).select("event_type").distinct().count()
    assert [r.n_series for r in spark.table(cfg.scoring_log_table).collect()] == [steps]


def test_every_model_of_a_series_is_continued(spark):
    import datetime as dt

    from tidemark.operators.inference import recent_regressors

    days = spark.createDataFrame([("a", dt.date(2024, 1, d), float(d)) for d in range(1, 9)], "k string, date date, x double")
    models = spark.createDataFrame(
        [("a", "one", dt.date(2024, 1, 8)), ("a", "two", dt.date(2024, 1, 5)), ("b", "one", dt.date(2024, 1, 8))],
        "k string, model_name string, train_end date",
    )
    got = {(r.k, r.model_name): r.future for r in recent_regressors(days, models, ["k"], "date", ["x"], 3).collect()}
    assert got == {("a", "one"): [[6.0, 7.0, 8.0]], ("a", "two"): [[3.0, 4.0, 5.0]], ("b", "one"): [[]]}


def test_a_search_that_has_not_converged_is_failed(spark, monkeypatch):
    import datetime as dt

    from tidemark.operators import models

    fit = models.fit_series

    def never(*args):
        return fit(*args).withColumn("_fit", F.col("_fit").withField("converged", F.lit(False)))

    monkeypatch.setattr(models, "fit_series", never)
    days = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1) + dt.timedelta(d), float(d % 5 + d % 3)) for d in range(25)], "k string, date date, y double"
    )
    row = models.train(days, ["k"], "date", "y", []).first()
    assert row.status == "failed" and row.converged is False


def test_command_line_names_columns_and_evaluates(spark, sf):
    tables = [x for t in TABLES for x in ("--" + t.replace("_", "-"), f"cli_{t}")]
    code = cli.main([
        "--raw-parquet-path", f"{sf}/events.parquet", "--lookup-csv-path", "", "--series-keys", "event_type",
        "--ts-col", "ts", "--other-ts-cols", "--positive-cols", "value", "--flag-col", "", "--date-col", "day",
        "--target-col", "mean_value", "--averages", "mean_value=value", "--count-col", "n", "--exog-cols", "n",
        "--evaluate", *tables,
    ])
    assert code == 0
    days, errors = spark.table("cli_holdout_table"), spark.table("cli_holdout_metrics_table")
    assert {"event_type", "date", "actual_mean_value", "forecast_mean_value", "status"} == set(days.columns)
    assert errors.count() == 5 and errors.filter("n > 0 and mae > 0 and rmse >= mae").count() == 5
    with pytest.raises(SystemExit):
        cli.parse_arguments(["--averages", "nothing"])
