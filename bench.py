"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line."""
from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.inputs import clean_lines, daily_events, daily_lines  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from tidemark import JobConfig, ship_package  # noqa: E402
from tidemark.operators import features  # noqa: E402
from tidemark.plans.job import ForecastJob  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS if CPUS.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def lag_and_rolling(spark, sf_dir):
    days = daily_events(spark, sf_dir, "user_id")
    lagged = features.add_lag_features(days, "avg_value", [1, 2, 7], ["user_id"])
    return features.add_rolling_features(lagged, "avg_value", [3, 7], ["user_id"])


def full_job(spark, sf_dir, **modes):
    """All six steps over one series, tables included."""
    tag = uuid.uuid4().hex
    ForecastJob(
        spark,
        JobConfig(
            raw_parquet_path=f"{sf_dir}/lineitem.parquet", lookup_csv_path=None,
            raw_table_name=f"raw_{tag}", clean_table_name=f"clean_{tag}",
            daily_features_table=f"daily_{tag}", registry_table=f"registry_{tag}",
            predictions_table=f"predictions_{tag}", scoring_log_table=f"scores_{tag}",
            model_store_table=f"models_{tag}", run_log_table=f"runs_{tag}",
            ts_col="l_shipdate", other_ts_cols=(), positive_cols=("l_discount", "l_tax"),
            flag_col="l_returnflag", flag_true="R", target_col="avg_price", count_col="n_rows",
            averages=(("avg_price", "l_extendedprice"), ("avg_quantity", "l_quantity")),
            exog_cols=("avg_quantity", "n_rows"), min_aic_improvement=-1e9,
            **modes,
        ),
    ).run()


BENCHES = {
    "clean_rows": lambda s, d: consume(clean_lines(s, d)),
    "quality_report": lambda s, d: consume(QUERIES["quality_report"](s, d)),
    "daily_features": lambda s, d: (daily_lines(s, d).orderBy("date").collect()),
    "daily_features_by_supplier": lambda s, d: consume(daily_lines(s, d, "l_suppkey")),
    "lag_and_rolling_by_user": lambda s, d: consume(lag_and_rolling(s, d)),
    "latest_row_by_key": lambda s, d: consume(QUERIES["latest_row_by_key"](s, d)),
    "ar1_baseline_by_user": lambda s, d: consume(QUERIES["ar1_baseline"](s, d)),
    "acf_by_user": lambda s, d: consume(QUERIES["acf"](s, d)),
    "pacf_by_user": lambda s, d: consume(QUERIES["pacf"](s, d)),
    "ljung_box_by_user": lambda s, d: consume(QUERIES["ljung_box"](s, d)),
    "stationarity_by_user": lambda s, d: consume(QUERIES["stationarity"](s, d)),
    "sarimax_fit_by_user": lambda s, d: consume(QUERIES["sarimax_models"](s, d)),
    "sarimax_holdout_by_user": lambda s, d: consume(QUERIES["sarimax_holdout_metrics"](s, d)),
    "full_job": full_job,
    "full_job_one_pass": lambda s, d: full_job(s, d, raw_mode="link", clean_mode="view"),
}


def main() -> None:
    spark = session()
    chosen = sys.argv[1:] or list(BENCHES)
    timings = {}
    for name in chosen:
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            BENCHES[name](spark, SF_DIR)
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs), 4)
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").agg(F.count(F.lit(1))).first()[0]
    print(
        json.dumps(
            {
                "metric": "total_seconds_best_of_runs",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "lineitem_rows": lines,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
