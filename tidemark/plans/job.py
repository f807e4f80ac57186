"""The six-step job: ingest, clean, daily features, train, register, forecast.

Steps meet in tables, so each can run alone.  Every step writes its table in one pass and
takes its numbers from that pass; a fit happens once, on its way into the model store.

With ``raw_mode="link"`` and ``clean_mode="view"`` the input is read once, and only in the
columns the daily features need; nothing as large as the input is written.
"""
from __future__ import annotations

import logging
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..operators import cleaning, daily, diagnostics, evaluation, inference, models, registry, states
from ..session import ship_package
from ..sources import Buckets, TableStore, append_new_files, read_csv_from_files, read_parquet

log = logging.getLogger(__name__)


def _now() -> datetime:
    return datetime.now(timezone.utc)


class ForecastJob:
    def __init__(self, spark: SparkSession, config: JobConfig):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        if config.series_buckets:
            # a join on series and model may rest on buckets by series alone
            spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        ship_package(spark)
        self.spark = spark
        self.config = config
        self.tables = TableStore(spark, config.table_format)
        self.run_id: str | None = None
        self.buckets = Buckets((daily.SERIES,), config.series_buckets) if config.series_buckets else None
        self.keys = (daily.SERIES, *config.series_keys) if self.buckets else config.series_keys
        self.counts: dict[str, int] = {}
        self._unread: Observation | None = None

    # step 1
    def ingest_data(self) -> tuple[DataFrame, DataFrame | None]:
        """Raw table (a copy, or in ``link`` mode the files themselves) and lookup frame."""
        cfg = self.config
        if cfg.raw_mode == "link":
            self.tables.link(cfg.raw_parquet_path, cfg.raw_table_name)
        else:
            seen = Observation("ingest")
            raw = read_parquet(self.spark, cfg.raw_parquet_path)
            self.tables.overwrite(
                raw.observe(seen, F.count(F.lit(1)).alias("raw_rows")), cfg.raw_table_name
            )
            self.counts |= seen.get
        lookup = self._lookup()
        log.info("ingested %s", self.counts)
        return self.tables.read(cfg.raw_table_name), lookup

    def _lookup(self) -> DataFrame | None:
        if self.config.lookup_csv_path is None:
            return None
        lookup = read_csv_from_files(self.spark, self.config.lookup_csv_path)
        self.counts["lookup_rows"] = lookup.count()
        return lookup

    # step 2
    def clean_data(self) -> DataFrame:
        cfg = self.config
        seen = Observation("clean")
        rows = cleaning.clean(
            self.tables.read(cfg.raw_table_name),
            cfg.positive_cols,
            (cfg.ts_col, *cfg.other_ts_cols),
            cfg.flag_col,
            cfg.flag_true,
            observation=seen,
        )
        if cfg.clean_mode == "view":
            # its numbers come with the pass that builds the daily features
            rows.createOrReplaceTempView(cfg.clean_table_name)
            self._unread = seen
        else:
            self.tables.overwrite(rows, cfg.clean_table_name, replace_schema=True)
            self.counts |= seen.get
            log.info("cleaned %s", self.counts)
        return self.tables.read(cfg.clean_table_name)

    # step 3
    def engineer_features(self) -> DataFrame:
        cfg = self.config
        features = daily.daily_features(
            self.tables.read(cfg.clean_table_name),
            cfg.ts_col,
            dict(cfg.averages),
            cfg.count_col,
            cfg.series_keys,
            cfg.date_col,
        )
        self._store_days(features)
        if self._unread is not None:
            self.counts |= self._unread.get
            self._unread = None
            log.info("cleaned %s", self.counts)
        return self.tables.read(cfg.daily_features_table)

    # steps 1 to 3 at once
    def merge_new_files(self) -> DataFrame:
        """Clean and aggregate the files that no earlier run has read, and renew the daily table from all states.

        Counts are those of the new files.  The states and the daily table have a row per series and day, so
        nothing but the new files is of the input's size.
        """
        cfg = self.config
        seen: list[Observation] = []

        times = (cfg.ts_col, *cfg.other_ts_cols)

        def watched(rows: DataFrame) -> DataFrame:
            seen.append(Observation())
            return cleaning.observed(rows, seen[-1], cfg.positive_cols, times)

        def day_states(rows: DataFrame) -> DataFrame:
            kept = cleaning.clean(rows, cfg.positive_cols, times, cfg.flag_col, cfg.flag_true)
            return states.daily_states(kept, cfg.ts_col, dict(cfg.averages), cfg.count_col, cfg.series_keys, cfg.date_col)

        self._lookup()
        batches = append_new_files(self.tables, cfg.raw_parquet_path, cfg.daily_states_table, day_states, watched)
        numbers = [one.get for one in seen]
        self.counts |= {name: sum(one[name] for one in numbers) for name in numbers[0]} if numbers else {}
        log.info("%s batches of new files, %s", batches, self.counts)
        names = [name for name, _ in cfg.averages]
        days = states.features_of_states(
            self.tables.read(cfg.daily_states_table), names, cfg.count_col, cfg.series_keys, cfg.date_col
        )
        self._store_days(days)
        return self.tables.read(cfg.daily_features_table)

    def _store_days(self, days: DataFrame) -> None:
        if self.buckets:
            days = days.withColumn(daily.SERIES, registry.series_id(self.config.series_keys))
        self.tables.overwrite(days, self.config.daily_features_table, replace_schema=True, buckets=self.buckets)

    # step 4
    def train_models(self, run_id: str | None = None) -> DataFrame:
        """Fit every series once, into the model store; raises, and leaves no rows, if no series is long enough.

        A run id that was used before replaces what it left in the store and the run log.
        """
        cfg = self.config
        run_id = run_id or str(uuid.uuid4())
        fitted = models.train(
            self.tables.read(cfg.daily_features_table),
            self.keys,
            cfg.date_col,
            cfg.target_col,
            cfg.exog_cols,
            cfg.sarimax_order,
            cfg.sarimax_seasonal_order,
            cfg.min_observations,
            cfg.aic_basis,
            cfg.fit_partitions,
            cfg.seasonal_from,
            spread=not self.buckets,
        )
        stored = registry.serialize_model(fitted, cfg.series_keys, run_id)
        seen = Observation("train")
        stored = stored.observe(
            seen,
            F.count(F.lit(1)).alias("series"),
            F.count_if(F.col("status") != "too_short").alias("long_enough"),
            F.max("n_obs").alias("longest"),
        )
        self.tables.append(stored, cfg.model_store_table, ["run_id"], replace_partitions=True, buckets=self.buckets)
        self.counts |= seen.get
        if not self.counts["long_enough"]:
            self.tables.drop_partition(cfg.model_store_table, "run_id", run_id)
            raise ValueError(
                f"not enough data points for modelling (longest series {self.counts['longest'] or 0}, "
                f"needed {cfg.min_observations})"
            )
        self.run_id = run_id
        fits = self.trained_models()
        params = {
            "order": cfg.sarimax_order,
            "seasonal_order": cfg.sarimax_seasonal_order,
            "exog_columns": ",".join(cfg.exog_cols),
        }
        self.tables.append(
            registry.run_log_rows(fits, run_id, cfg.experiment_name, params, _now()),
            cfg.run_log_table, ["run_id"], replace_partitions=True,
        )
        return fits

    def trained_models(self) -> DataFrame:
        """Model-store rows of this job's training run."""
        if self.run_id is None:
            raise RuntimeError("no models trained yet: call train_models() first")
        return self.tables.read(self.config.model_store_table).filter(F.col("run_id") == self.run_id)

    # step 5
    def register_model(self) -> DataFrame | None:
        """Append the fits that beat their baseline by enough; None if none does. A second call registers nothing twice."""
        cfg = self.config
        rows = registry.registry_rows(
            self.trained_models(),
            self.keys,
            model_name=cfg.model_name,
            model_version=cfg.model_version,
            target_series=cfg.daily_features_table,
            store_table=cfg.model_store_table,
            created=_now(),
            min_aic_improvement=cfg.min_aic_improvement,
        )
        if rows.isEmpty():
            log.warning("no AIC improvement of %s or more; registry unchanged", cfg.min_aic_improvement)
            return None
        self.tables.append(rows, cfg.registry_table, ["run_id"], replace_partitions=True, buckets=self.buckets)
        return self.tables.read(cfg.registry_table).filter(F.col("run_id") == self.run_id)

    # step 6
    def run_batch_inference(self, scoring_run_id: str | None = None) -> DataFrame | None:
        """Forecast every series with its newest registered model; None if there is no model.

        A scoring run id that was used before replaces its rows in the scoring log.
        """
        cfg = self.config
        if not self.tables.exists(cfg.registry_table):
            log.warning("no model registry; nothing to forecast")
            return None
        newest = registry.latest_models(
            self.tables.read(cfg.registry_table),
            self.keys,
            model_name=cfg.model_name,
            target_series=cfg.daily_features_table,
            columns=["run_id", "model_id", "model_version", "order", "seasonal_order"],
        )
        if newest.isEmpty():
            log.warning("no model in the registry; nothing to forecast")
            return None
        ready = self._models_with_regressors(newest)
        scoring_run_id = scoring_run_id or str(uuid.uuid4())
        steps = inference.forecast(
            ready.withColumn("scoring_run_id", F.lit(scoring_run_id)),
            cfg.series_keys,
            cfg.target_col,
            ["scoring_run_id", "model_id", "model_name", "model_version"],
        )
        self.tables.overwrite(steps, cfg.predictions_table, replace_schema=True)
        self.tables.append(
            inference.scoring_log_rows(
                self.tables.read(cfg.predictions_table).filter(F.col("horizon_step") == 1),
                scoring_run_id=scoring_run_id,
                registry_table=cfg.registry_table,
                predictions_table=cfg.predictions_table,
                scoring_time=_now(),
                horizon=cfg.forecast_horizon,
            ),
            cfg.scoring_log_table, ["scoring_run_id"], replace_partitions=True,
        )
        return self.tables.read(cfg.predictions_table)

    def _models_with_regressors(self, newest: DataFrame) -> DataFrame:
        cfg = self.config
        known = registry.deserialize_model(self.tables.read(cfg.model_store_table), newest)
        return inference.recent_regressors(
            self.tables.read(cfg.daily_features_table),
            known,
            self.keys,
            cfg.date_col,
            cfg.exog_cols,
            cfg.forecast_horizon,
        )

    # evaluation and diagnostics
    def evaluate_holdout(self) -> DataFrame:
        """Store the held-out days beside their forecasts, and the errors per series; returns the days."""
        cfg = self.config
        days = evaluation.holdout_forecasts(
            self.tables.read(cfg.daily_features_table),
            cfg.series_keys,
            cfg.date_col,
            cfg.target_col,
            cfg.exog_cols,
            cfg.sarimax_order,
            cfg.sarimax_seasonal_order,
            cfg.min_observations,
            partitions=cfg.fit_partitions,
            seasonal_from=cfg.seasonal_from,
        )
        self.tables.overwrite(days, cfg.holdout_table, replace_schema=True)
        stored = self.tables.read(cfg.holdout_table)
        errors = evaluation.compute_metrics(
            stored, f"actual_{cfg.target_col}", f"forecast_{cfg.target_col}", cfg.series_keys
        )
        self.tables.overwrite(errors, cfg.holdout_metrics_table, replace_schema=True)
        return stored

    def diagnose(self) -> dict[str, DataFrame]:
        """Correlations of the series and of the residuals of this job's training run."""
        cfg = self.config
        days = daily.complete_cases(
            self.tables.read(cfg.daily_features_table), [cfg.target_col, *cfg.exog_cols]
        )
        series = (days, cfg.target_col, cfg.series_keys, cfg.date_col)
        errors = (models.residuals(self.trained_models(), cfg.series_keys), "residual", cfg.series_keys)
        return {
            "acf": diagnostics.acf(*series),
            "pacf": diagnostics.pacf(*series),
            "residual_acf": diagnostics.acf(*errors),
            "residual_pacf": diagnostics.pacf(*errors),
            "ljung_box": diagnostics.ljung_box_test(*errors),
        }

    def run(self, skip_inference: bool = False, evaluate: bool = False) -> None:
        rebuild = [self.ingest_data, self.clean_data, self.engineer_features]
        features = [self.merge_new_files] if self.config.feature_mode == "merge" else rebuild
        steps = [*features, self.train_models, self.register_model]
        if not skip_inference:
            steps.append(self.run_batch_inference)
        if evaluate:
            steps.append(self.evaluate_holdout)
        log.info("parameters %s", self.config.to_dict())
        try:
            for step in steps:
                log.info("step %s", step.__name__)
                step()
        except Exception:
            log.exception("job failed")
            raise

    def run_full_pipeline(self) -> None:
        self.run()
