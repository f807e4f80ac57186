"""One pooled boosted-tree model over all series, on lag, calendar and regressor columns."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, JobConfig
from ..session import ensure_checkpoint_dir
from .features import add_calendar_features, add_lag_features, train_test_split_ts

LAGS = (1, 7)
CALENDAR = ("day_of_week", "day_of_month", "month")


def feature_vectors(
    daily: DataFrame,
    series_keys: Sequence[str],
    date_col: str,
    target: str,
    exog: Sequence[str] = (),
    lags: Sequence[int] = LAGS,
) -> DataFrame:
    """Rows (keys, date, label, features); days without a full set of lags are skipped."""
    lagged = add_lag_features(daily, target, lags, series_keys, date_col)
    dated = add_calendar_features(lagged, date_col)
    inputs = [*(f"{target}_lag_{k}" for k in lags), *CALENDAR, *exog]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip")
    return assembler.transform(dated.filter(F.col(target).isNotNull())).select(
        *series_keys, date_col, F.col(target).cast("double").alias("label"), "features"
    )


def split_vectors(
    vectors: DataFrame, series_keys: Sequence[str], date_col: str, fraction: float
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by time within each series."""
    marked = train_test_split_ts(vectors, series_keys, date_col, train_fraction=fraction)
    columns = vectors.columns
    return tuple(marked.filter(F.col("split") == part).select(*columns) for part in ("train", "test"))


def fit_gbt(train: DataFrame, config: JobConfig = DEFAULT_CONFIG, seed: int = 7) -> GBTRegressionModel:
    """Boosting rebuilds its residuals every round; checkpoints keep that lineage short."""
    ensure_checkpoint_dir(train.sparkSession)
    return GBTRegressor(
        maxDepth=config.gbt_max_depth,
        maxIter=config.gbt_max_iter,
        stepSize=config.gbt_step_size,
        checkpointInterval=10,
        seed=seed,
    ).fit(train)


def gbt_metrics(predictions: DataFrame) -> dict[str, float]:
    return {
        name: RegressionEvaluator(metricName=name).evaluate(predictions) for name in ("mae", "rmse")
    }
