"""Daily-series forecasting on Spark."""
from .config import DEFAULT_CONFIG, JobConfig
from .operators.cleaning import clean, positive_rows, quality_report
from .operators.daily import complete_cases, daily_features, last_rows, period_index, series_rows
from .operators.diagnostics import acf, check_stationarity, ljung_box_test, pacf
from .operators.evaluation import compute_metrics, holdout_forecasts
from .operators.features import (
    add_calendar_features,
    add_lag_features,
    add_rolling_features,
    parse_datetime_index,
    train_test_split_ts,
)
from .operators.inference import forecast
from .operators.models import ar1_baseline, fit_auto_arima, residuals, train
from .operators.registry import deserialize_model, latest_models, serialize_model
from .plans.job import ForecastJob
from .session import ship_package
from .sources import TableStore, read_csv_from_files, read_delta, read_parquet, write_delta

__all__ = [
    "DEFAULT_CONFIG",
    "ForecastJob",
    "JobConfig",
    "TableStore",
    "acf",
    "add_calendar_features",
    "add_lag_features",
    "add_rolling_features",
    "ar1_baseline",
    "check_stationarity",
    "clean",
    "complete_cases",
    "compute_metrics",
    "daily_features",
    "deserialize_model",
    "fit_auto_arima",
    "forecast",
    "holdout_forecasts",
    "last_rows",
    "latest_models",
    "ljung_box_test",
    "pacf",
    "parse_datetime_index",
    "period_index",
    "positive_rows",
    "quality_report",
    "read_csv_from_files",
    "read_delta",
    "read_parquet",
    "residuals",
    "serialize_model",
    "series_rows",
    "ship_package",
    "train",
    "train_test_split_ts",
    "write_delta",
]
