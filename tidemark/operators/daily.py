"""From clean rows to daily series, and from daily series to one row per series.

Only ``daily_features`` sees raw rows.  Its aggregate is combined on the map side, so that
a key holding a third of the input sends no more than one row per day and task through the
shuffle.  Everything later works on one row per series and day: a series is never longer
than the calendar, which bounds windows, arrays and Python batches alike.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def daily_features(
    df: DataFrame,
    ts_col: str,
    averages: Mapping[str, str],
    count_col: str = "row_count",
    series_keys: Sequence[str] = (),
    date_col: str = "date",
) -> DataFrame:
    """One row per series and day: averages (nulls skipped) and the number of rows.

    ``averages`` maps the new column to the column averaged.  Rows without a timestamp
    form a null-date row.
    """
    return df.groupBy(*series_keys, F.to_date(ts_col).alias(date_col)).agg(
        *(F.avg(source).alias(name) for name, source in averages.items()),
        F.count(F.lit(1)).alias(count_col),
    )


def complete_cases(df: DataFrame, columns: Sequence[str], date_col: str | None = None) -> DataFrame:
    """Rows where no column is null or NaN (and the date, if named, is known)."""
    kept = df.dropna(subset=list(columns))
    return kept if date_col is None else kept.filter(F.col(date_col).isNotNull())


def by_date(series_keys: Sequence[str], date_col: str = "date", descending: bool = False) -> WindowSpec:
    order = F.col(date_col).desc() if descending else F.col(date_col).asc()
    return Window.partitionBy(*series_keys).orderBy(order)


#: Column that names a series where tables are bucketed by it; never null, and it tells all series keys.
SERIES = "_series"


#: Days of the calendar, and later rows of a series, that one block holds.
BLOCK_DAYS = 4096


def numbered(df: DataFrame, date_col: str = "date", t: str = "t", n: str = "n_obs", block_days: int = BLOCK_DAYS) -> DataFrame:
    """One series without keys: number its days in ``t`` and count them in ``n``, in many tasks.

    Rows meet by blocks of the calendar. Only the blocks' counts, one row each, are summed up in one place; a
    row's number is the count before its block plus its place in it. Rows without a date come first, as in a sort.
    """
    block = F.coalesce(F.floor(F.unix_date(F.to_date(date_col)) / block_days), F.lit(-(1 << 40))).alias("_block")
    rows = df.select("*", block)
    counts = rows.groupBy("_block").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"), F.sum("_rows").over(Window.partitionBy(F.lit(0))).alias(n)
    )
    place = F.row_number().over(Window.partitionBy("_block").orderBy(date_col))
    return rows.join(offsets, "_block").withColumn(t, (F.col("_offset") + place).cast("int")).drop("_block", "_offset")


def with_lags(df: DataFrame, lagged: Mapping[str, tuple[str, int]], t: str = "t", block_rows: int = BLOCK_DAYS) -> DataFrame:
    """Columns of earlier rows of one numbered series: ``lagged`` maps a new column to (column, rows back).

    Rows are dealt into blocks by number. The last rows of a block go to the next one, too, so that lags reach
    across the border without a window over the whole series.
    """
    reach = max((k for _, k in lagged.values()), default=0)
    if reach > block_rows:
        raise ValueError("a lag reaches over more than a block")
    own = F.floor((F.col(t) - 1) / block_rows)
    next_one = F.when((F.col(t) - 1) % block_rows >= block_rows - reach, own + 1)
    both = F.array_compact(F.array(own, next_one))
    dealt = df.select("*", F.posexplode(both).alias("_guest", "_block"))
    window = Window.partitionBy("_block").orderBy(t)
    found = dealt.withColumns({name: F.lag(column, k).over(window) for name, (column, k) in lagged.items()})
    return found.where("_guest = 0").drop("_guest", "_block")


def period_index(
    df: DataFrame, series_keys: Sequence[str] = (), date_col: str = "date", name: str = "t"
) -> DataFrame:
    """Number the days of a series from 1; a missing day leaves no gap in the numbers."""
    if not series_keys:
        return numbered(df, date_col, name, "_n").drop("_n")
    return df.withColumn(name, F.row_number().over(by_date(series_keys, date_col)))


def last_rows(
    df: DataFrame, n: int, series_keys: Sequence[str] = (), date_col: str = "date", step: str = "horizon_step"
) -> DataFrame:
    """The last ``n`` days of every series, numbered 1.. in order of time."""
    if not series_keys:
        # the newest rows of each part, then of all; no sort of the whole
        newest_rows = df.orderBy(F.col(date_col).desc()).limit(n)
        return newest_rows.withColumn(step, F.row_number().over(Window.orderBy(date_col)))
    newest = F.row_number().over(by_date(series_keys, date_col, descending=True))
    tail = df.withColumn("_age", newest).filter(F.col("_age") <= n)
    kept = F.count(F.lit(1)).over(Window.partitionBy(*series_keys))
    return tail.withColumn(step, (kept - F.col("_age") + 1).cast("int")).drop("_age")


def series_lengths(
    df: DataFrame, series_keys: Sequence[str] = (), min_observations: int = 10
) -> DataFrame:
    return (
        df.groupBy(*series_keys)
        .agg(F.count(F.lit(1)).alias("n_obs"))
        .withColumn("status", length_status(F.col("n_obs"), min_observations))
    )


def length_status(n_obs: Column, min_observations: int) -> Column:
    return F.when(n_obs < min_observations, "too_short").otherwise("ok")


def spread_by_series(df: DataFrame, series_keys: Sequence[str], partitions: int | None) -> DataFrame:
    """Hash rows by series into a stated number of partitions.

    Fitting is bound by processor time, not by bytes; without a stated number, adaptive
    execution would merge a small shuffle into one task and fit every series there.  The
    aggregate that follows needs no further exchange.
    """
    if not series_keys:
        return df
    if partitions is None:
        session = df.sparkSession
        partitions = max(
            int(session.conf.get("spark.sql.shuffle.partitions")),
            session.sparkContext.defaultParallelism,
        )
    return df.repartition(partitions, *series_keys)


def series_rows(
    df: DataFrame,
    series_keys: Sequence[str],
    date_col: str,
    target: str,
    exog: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """One row per series: ``dates``, ``y`` and ``x`` (one array per regressor) by date.

    Takes complete cases only.  The arrays are bounded by the number of days in the series.
    """
    day = F.struct(
        F.col(date_col).alias("date"),
        F.col(target).cast("double").alias("y"),
        *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(exog)),
    )
    ready = complete_cases(df, [target, *exog], date_col)
    gathered = spread_by_series(ready, series_keys, partitions).groupBy(*series_keys).agg(
        F.sort_array(F.collect_list(day)).alias("days")
    )
    x = F.array(*(F.col(f"days.x{i}") for i in range(len(exog)))) if exog else F.array().cast(
        "array<array<double>>"
    )
    return gathered.select(
        *series_keys,
        F.size("days").cast("bigint").alias("n_obs"),
        F.col("days.date").alias("dates"),
        F.col("days.y").alias("y"),
        x.alias("x", metadata={"count": len(exog)}),
    )
