"""Command line for ``spark-submit``; exit code 0 on success, 1 on failure."""
from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from ..config import DEFAULT_CONFIG, JobConfig
from ..session import get_or_create_spark
from .job import ForecastJob

log = logging.getLogger(__name__)

# option, type, help; the default of each is the configuration's own
_VALUES = (
    ("model_version", str, "version recorded with the registered models"),
    ("forecast_horizon", int, "steps to forecast"),
    ("raw_parquet_path", str, "Parquet input"),
    ("min_aic_improvement", float, "least AIC gain over the baseline to register a model"),
    ("raw_table_name", str, "table of ingested rows"),
    ("clean_table_name", str, "table of cleansed rows"),
    ("daily_features_table", str, "table of daily features"),
    ("registry_table", str, "table of registered models"),
    ("predictions_table", str, "table of forecasts"),
    ("scoring_log_table", str, "table of scoring runs"),
    ("lookup_csv_path", str, "lookup CSV; an empty value skips it"),
    ("model_name", str, "name recorded with the registered models"),
    ("table_format", str, "parquet, or delta where its jar is present"),
    ("raw_mode", str, "copy the input into the raw table, or link it in place"),
    ("clean_mode", str, "write cleansed rows to a table, or keep them as a view"),
    ("feature_mode", str, "rebuild daily features from all rows, or merge those of new files"),
    ("daily_states_table", str, "table of sums and counts per day (with --feature-mode merge)"),
    ("holdout_table", str, "table of held-out days and their forecasts (with --evaluate)"),
    ("holdout_metrics_table", str, "table of errors on held-out days (with --evaluate)"),
    ("model_store_table", str, "table of all fits"),
    ("run_log_table", str, "table of parameters and metrics of runs"),
    ("aic_basis", str, "score both models on common days, or each on its own"),
    ("min_observations", int, "least number of days to fit a series"),
    ("seasonal_from", int, "least number of days for a model with a season"),
    ("fit_partitions", int, "number of partitions to fit in"),
    ("series_buckets", int, "number of buckets by series of the daily table, the model store and the registry"),
    ("ts_col", str, "column with the time of a row"),
    ("flag_col", str, "text column to turn into a boolean; an empty value skips it"),
    ("flag_true", str, "text of that column that means true"),
    ("date_col", str, "name of the date column of daily tables"),
    ("target_col", str, "daily column to forecast"),
    ("count_col", str, "name of the daily number of rows"),
)
# options that take any number of values
_LISTS = (
    ("series_keys", "one series per key"),
    ("positive_cols", "columns that must be above zero"),
    ("other_ts_cols", "further columns to read as times"),
    ("exog_cols", "daily columns that serve as regressors"),
)
# the orders, of three and four numbers
_ORDERS = (
    ("sarimax_order", 3, "p d q of the model"),
    ("sarimax_seasonal_order", 4, "P D Q of its season, and the days of a season"),
)


def _pair(text: str) -> tuple[str, str]:
    name, found, source = text.partition("=")
    if not (name and found and source):
        raise argparse.ArgumentTypeError(f"{text} is not new=source")
    return name, source


def parse_arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Daily-series forecasting job")
    for name, kind, text in _VALUES:
        parser.add_argument(
            "--" + name.replace("_", "-"), type=kind, default=getattr(DEFAULT_CONFIG, name), help=text
        )
    for name, text in _LISTS:
        parser.add_argument(
            "--" + name.replace("_", "-"), nargs="*", default=list(getattr(DEFAULT_CONFIG, name)), help=text
        )
    for name, count, text in _ORDERS:
        parser.add_argument(
            "--" + name.replace("_", "-"), nargs=count, type=int, default=list(getattr(DEFAULT_CONFIG, name)), help=text
        )
    parser.add_argument(
        "--averages", nargs="*", type=_pair, default=list(DEFAULT_CONFIG.averages),
        help="daily averages, each as new=source",
    )
    parser.add_argument("--evaluate", action="store_true", help="forecast held-out days and store the errors")
    parser.add_argument("--skip-inference", action="store_true", help="stop after registration")
    parser.add_argument("--dry-run", action="store_true", help="check parameters and session only")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    args = parse_arguments(argv)
    try:
        given = {name: getattr(args, name) for name, _, _ in _VALUES}
        given |= {name: tuple(getattr(args, name)) for name, _ in _LISTS}
        given |= {name: tuple(getattr(args, name)) for name, _, _ in _ORDERS}
        given |= {name: given[name] or None for name in ("lookup_csv_path", "flag_col")}
        config = JobConfig.from_args(**given, averages=tuple(args.averages))
        spark = get_or_create_spark()
        log.info("Spark %s", spark.version)
        if args.dry_run:
            log.info("dry run: parameters are valid")
            return 0
        ForecastJob(spark, config).run(skip_inference=args.skip_inference, evaluate=args.evaluate)
        return 0
    except Exception:
        log.exception("failed")
        return 1


if __name__ == "__main__":
    sys.exit(main())
