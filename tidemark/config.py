"""Job parameters: one frozen dataclass is the single source of every default."""
from __future__ import annotations

from dataclasses import asdict, dataclass, fields

Order = tuple[int, int, int]
SeasonalOrder = tuple[int, int, int, int]


@dataclass(frozen=True)
class JobConfig:
    """Everything one forecasting job needs to know.

    The first block names inputs and tables, the second the model, the third maps the
    columns of the input onto the roles they play.  With ``series_keys`` empty the whole
    input is one daily series; with keys there is one series per distinct key.

    ``aic_basis="common"`` compares baseline and candidate on the same days, ``"own"`` each on
    the days it can score.  ``feature_mode="merge"`` reads only files of the input (a folder or a pattern) that no
    earlier run has read, and keeps sums and counts per day instead of raw and clean tables.
    ``series_buckets`` keeps the daily table, the model store and the registry in so many buckets by series, so that
    training and forecasting exchange no rows; tables made without do not change by it.  Series of fewer than ``seasonal_from`` days get a model without season.
    """

    # inputs
    raw_parquet_path: str = "data/green_tripdata_2022-08.parquet"
    lookup_csv_path: str | None = "data/taxi_zone_lookup.csv"

    # tables
    raw_table_name: str = "trips_raw"
    clean_table_name: str = "trips_clean"
    daily_features_table: str = "average_fare_per_day"
    daily_states_table: str = "daily_states"
    registry_table: str = "time_series_model_registry"
    predictions_table: str = "average_fare_forecast"
    scoring_log_table: str = "scoring_runs"
    model_store_table: str = "time_series_models"
    run_log_table: str = "model_runs"
    holdout_table: str = "holdout_comparison"
    holdout_metrics_table: str = "holdout_metrics"
    table_format: str = "parquet"
    raw_mode: str = "copy"
    clean_mode: str = "table"
    feature_mode: str = "rebuild"

    # model
    model_name: str = "sarimax_average_fare_per_day_with_exog"
    model_version: str = "v1"
    forecast_horizon: int = 5
    baseline_order: Order = (1, 0, 0)
    baseline_seasonal_order: SeasonalOrder = (0, 0, 0, 0)
    sarimax_order: Order = (1, 1, 1)
    sarimax_seasonal_order: SeasonalOrder = (1, 1, 1, 7)
    exog_cols: tuple[str, ...] = ("avg_trip_distance", "trip_count")
    min_observations: int = 10
    min_aic_improvement: float = 1.0
    aic_basis: str = "common"
    seasonal_from: int = 30
    experiment_name: str = "average_fare_per_day_sarimax"
    fit_partitions: int | None = None
    series_buckets: int | None = None

    # boosted trees
    gbt_max_depth: int = 5
    gbt_max_iter: int = 50
    gbt_step_size: float = 0.1
    gbt_train_split: float = 0.8

    # column roles
    series_keys: tuple[str, ...] = ()
    ts_col: str = "lpep_pickup_datetime"
    other_ts_cols: tuple[str, ...] = ("lpep_dropoff_datetime",)
    positive_cols: tuple[str, ...] = ("trip_distance", "fare_amount")
    flag_col: str | None = "store_and_fwd_flag"
    flag_true: str = "Y"
    date_col: str = "pickup_date"
    target_col: str = "average_fare"
    averages: tuple[tuple[str, str], ...] = (
        ("average_fare", "fare_amount"),
        ("avg_trip_distance", "trip_distance"),
    )
    count_col: str = "trip_count"

    def __post_init__(self) -> None:
        if self.forecast_horizon <= 0:
            raise ValueError(f"cannot forecast {self.forecast_horizon} steps; ask for one or more")
        if self.min_observations < 2:
            raise ValueError("a model needs two days at the very least (min_observations)")
        if self.raw_mode not in ("copy", "link"):
            raise ValueError("raw_mode must be 'copy' or 'link'")
        if self.clean_mode not in ("table", "view"):
            raise ValueError("clean_mode must be 'table' or 'view'")
        if self.feature_mode not in ("rebuild", "merge"):
            raise ValueError("feature_mode must be 'rebuild' or 'merge'")
        if self.series_buckets is not None and (self.series_buckets < 1 or not self.series_keys):
            raise ValueError("series_buckets needs series keys, and one bucket or more")
        if self.aic_basis not in ("own", "common"):
            raise ValueError("aic_basis must be 'own' or 'common'")
        if (self.baseline_order, self.baseline_seasonal_order) != ((1, 0, 0), (0, 0, 0, 0)):
            raise ValueError("the baseline is the closed-form (1,0,0)(0,0,0,0) model")
        # lists are accepted wherever a tuple is declared
        for name in ("exog_cols", "series_keys", "other_ts_cols", "positive_cols",
                     "sarimax_order", "sarimax_seasonal_order"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        object.__setattr__(self, "averages", tuple((a, b) for a, b in self.averages))

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_args(cls, **kwargs) -> JobConfig:
        unknown = set(kwargs) - {f.name for f in fields(cls)}
        if unknown:
            raise TypeError(f"unknown parameters: {sorted(unknown)}")
        return cls(**kwargs)


DEFAULT_CONFIG = JobConfig()
