"""SQL that gives the same results as ``checks.queries`` on the same tables."""
from __future__ import annotations

from tidemark.functions.arma import Shape
from tidemark.operators.models import SEARCH_ORDERS

from .inputs import sql_round as r
from .regressions import ahead, best_of, trained, with_

LINES = "SELECT * FROM lineitem WHERE l_discount > 0 AND l_tax > 0"


def daily_lines(*keys: str) -> str:
    k = "".join(f"{key}, " for key in keys)
    group = "".join(f", {i + 2}" for i in range(len(keys)))
    return (
        f"SELECT {k}CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS avg_price, "
        f"avg(l_quantity) AS avg_quantity, count(*) AS n_rows FROM ({LINES}) GROUP BY 1{group}"
    )


def daily_events(key: str) -> str:
    return (
        f"SELECT {key}, CAST(ts AS DATE) AS date, avg(value) AS avg_value, count(*) AS n_events "
        "FROM events GROUP BY 1, 2"
    )


BY_USER = daily_events("user_id")
BY_TYPE = daily_events("event_type")
DAY = "CAST(date AS VARCHAR) AS date"
DAILY = f"{DAY}, {r('avg_value')} AS avg_value, n_events"


def lagged(source: str, key: str, y: str, k: int = 1) -> str:
    """CTEs: d(key, date, y, t, n), p with the pairs (y, prev) and f with their regression."""
    part = f"PARTITION BY {key}"
    return f"""
    d AS (SELECT {key}, date, {y} AS y, row_number() OVER ({part} ORDER BY date) AS t,
                 count(*) OVER ({part}) AS n FROM ({source})),
    p AS (SELECT *, lag(y, {k}) OVER ({part} ORDER BY date) AS prev FROM d),
    f AS (SELECT {key}, sum(y * prev) / sum(prev * prev) AS phi FROM p GROUP BY 1),
    e AS (SELECT p.*, f.phi, y - phi * prev AS miss FROM p JOIN f USING ({key})),
    m AS (SELECT {key}, count(*) AS n_obs, count(prev) AS n_eff, max(phi) AS phi,
                 sum(miss * miss) / count(prev) AS sigma2, max_by(y, date) AS last_value
          FROM e GROUP BY 1)"""


AIC_AR1 = "n_eff * (ln(2 * pi() * sigma2) + 1) + 4"


def one_order(steps: str, key: str = "user_id") -> str:
    """Closed-form fit of y on x without constant, given pairs (key, y, x)."""
    return f"""
    WITH z AS ({steps}),
    b AS (SELECT {key}, sum(x * y) / sum(x * x) AS c FROM z GROUP BY 1),
    s AS (SELECT {key}, max(c) AS coefficient, count(*) AS n_eff,
                 sum((y - c * x) * (y - c * x)) / count(*) AS sigma2
          FROM z JOIN b USING ({key}) GROUP BY 1)
    SELECT {key}, {r('coefficient', 5)} AS coefficient, {r('sigma2', 5)} AS sigma2,
           {r(AIC_AR1, 5)} AS aic, n_eff FROM s"""


USER = "OVER (PARTITION BY user_id ORDER BY date)"
DIFFERENCES = f"""SELECT user_id, date, avg_value - lag(avg_value) {USER} AS dy,
    n_events - lag(n_events) {USER} AS dx, row_number() {USER} AS t FROM ({BY_USER})"""


def correlations(source: str, key: str, y: str, max_lag: int = 20) -> str:
    """CTE ending in acf(key, n_obs, lag, acf)."""
    return f"""
    s0 AS (SELECT {key}, date, {y} AS y FROM ({source})),
    c0 AS (SELECT {key}, y - avg(y) OVER (PARTITION BY {key}) AS c,
                  row_number() OVER (PARTITION BY {key} ORDER BY date) AS t,
                  count(*) OVER (PARTITION BY {key}) AS n_obs FROM s0),
    prod AS (SELECT a.{key}, a.n_obs, k.lag, sum(a.c * b.c) AS s
             FROM c0 a CROSS JOIN range(0, {max_lag + 1}) k(lag)
             JOIN c0 b ON a.{key} = b.{key} AND b.t = a.t - k.lag
             WHERE k.lag <= a.n_obs - 1 GROUP BY 1, 2, 3),
    acf AS (SELECT {key}, n_obs, CAST(lag AS INTEGER) AS lag,
                   s / first_value(s) OVER (PARTITION BY {key} ORDER BY lag) AS acf FROM prod)"""


def acf(source: str, key: str, y: str, shown: str) -> str:
    return f"""
    WITH {correlations(source, key, y)},
    b AS (SELECT *, coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END) OVER (
              PARTITION BY {key} ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM acf)
    SELECT {shown}n_obs, lag, {r('acf')} AS acf,
           {r('CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054 * sqrt((1 + 2 * before) / n_obs) END')} AS band
    FROM b"""


def ljung_box(source: str, key: str, y: str, digits: int = 6, odd: bool = False) -> str:
    """The chi-square tail is the finite sum for an even number of lags, or with ``odd`` the series of its complement."""
    tail = "exp(-q / 2) * list_sum([pow(q / 2, i) / factorial(CAST(i AS INTEGER)) for i in range(0, top // 2)])"
    if odd:
        tail = "1 - list_sum([exp((top / 2 + i) * ln(q / 2) - q / 2 - lgamma(top / 2 + i + 1)) for i in range(0, 300)])"
    return f"""
    WITH {correlations(source, key, y)},
    l AS (SELECT DISTINCT {key}, n_obs, unnest([least(10, greatest(1, least(20, n_obs - 1))),
                 greatest(1, least(20, n_obs - 1))]) AS top FROM acf),
    q AS (SELECT {key}, l.n_obs, top, l.n_obs * (l.n_obs + 2) * sum(acf * acf / (l.n_obs - lag)) AS q
          FROM l JOIN acf USING ({key}) WHERE lag BETWEEN 1 AND top GROUP BY 1, 2, 3)
    SELECT {key}, n_obs, CAST(top AS INTEGER) AS lag, {r('q', digits)} AS q, {r(tail, digits)} AS p_value FROM q"""


HOLDOUT = f"""
    d AS (SELECT user_id, date, avg_value AS y, row_number() {USER} AS t,
                 count(*) OVER (PARTITION BY user_id) AS n FROM ({BY_USER})),
    h AS (SELECT *, n - least(7, greatest(1, n // 5)) AS kept FROM d),
    p AS (SELECT *, lag(y) {USER} AS prev FROM h),
    f AS (SELECT user_id, sum(y * prev) / sum(prev * prev) AS phi, max_by(y, t) AS last_y
          FROM p WHERE t <= kept GROUP BY 1),
    o AS (SELECT user_id, date, y AS actual,
                 CASE WHEN kept >= 10 THEN pow(phi, t - kept) * last_y END AS forecast,
                 CASE WHEN kept < 10 THEN 'too_short' ELSE 'ok' END AS status
          FROM p JOIN f USING (user_id) WHERE t > kept)"""

ORDERS = "o_orderkey, o_custkey, o_orderstatus, {price} AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority".format(
    price=r("o_totalprice")
)
LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, "
    + "".join(f"{r(c)} AS {c}, " for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    + "{flag} AS l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate"
)


def rolling(k: int) -> str:
    w = f"OVER (PARTITION BY user_id ORDER BY date ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    parts = (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
    return ", ".join(f"{r(f'{fn}(avg_value) {w}', 4)} AS avg_value_{name}_{k}" for name, fn in parts)


TYPE = "OVER (PARTITION BY event_type ORDER BY date)"
CLOSED_FORM = f"""{lagged(BY_TYPE, 'event_type', 'avg_value')},
    w1 AS (SELECT event_type, date, avg_value AS y, n_events AS x, row_number() {TYPE} AS t,
                  avg_value - lag(avg_value) {TYPE} AS dy, n_events - lag(n_events) {TYPE} AS dx FROM ({BY_TYPE})),
    w2 AS (SELECT *, dy - lag(dy, 7) {TYPE} AS ddy, dx - lag(dx, 7) {TYPE} AS ddx FROM w1),
    w3 AS (SELECT event_type, sum(ddx * ddy) / sum(ddx * ddx) AS b FROM w2 WHERE t > 9 GROUP BY 1),
    w4 AS (SELECT w2.*, b, y - b * x AS z, ddy - b * ddx AS residual FROM w2 JOIN w3 USING (event_type)),
    w5 AS (SELECT event_type, count(*) AS n_eff, max(b) AS b, sum(residual * residual) / count(*) AS sigma2
           FROM w4 WHERE t > 9 GROUP BY 1)"""


FLAG = "OVER (PARTITION BY l_returnflag ORDER BY date)"
FLAG_DAYS = daily_lines("l_returnflag").replace(
    "SELECT * FROM lineitem", "SELECT * REPLACE (l_returnflag = 'R' AS l_returnflag) FROM lineitem"
)

ORACLES: dict[str, str] = {
    "order_search": f"""
        WITH z AS (SELECT user_id, t, avg_value AS y, lag(avg_value) {USER} AS y1, dy, lag(dy) {USER} AS dy1
                   FROM (SELECT d.*, v.avg_value FROM ({DIFFERENCES}) d
                         JOIN ({BY_USER}) v ON v.user_id = d.user_id AND v.date = d.date)),
        o AS (SELECT user_id, '1,0,0' AS o, 2 AS k, y, y1 AS x FROM z WHERE t > 2
              UNION ALL SELECT user_id, '1,1,0', 2, dy, dy1 FROM z WHERE t > 2
              UNION ALL SELECT user_id, '0,1,0', 1, dy, 0 FROM z WHERE t > 2),
        c AS (SELECT user_id, o, coalesce(sum(x * y) / nullif(sum(x * x), 0), 0) AS c FROM o GROUP BY 1, 2),
        a AS (SELECT user_id, o, count(*) AS n,
                     count(*) * (ln(2 * pi() * sum((y - c * x) * (y - c * x)) / count(*)) + 1) + 2 * max(k) AS aic
              FROM o JOIN c USING (user_id, o) GROUP BY 1, 2)
        SELECT user_id, min(n) + 2 AS n_obs, count(*) AS n_fitted, min(n) AS n_eff,
               min_by(o, aic) AS "order", {r('min(aic)', 5)} AS aic
        FROM a GROUP BY 1""",
    "closed_form_holdout": f"""
        WITH d AS (SELECT l_returnflag, date, avg_quantity AS y, n_rows AS x, row_number() {FLAG} AS t,
                          count(*) OVER (PARTITION BY l_returnflag) AS n,
                          avg_quantity - lag(avg_quantity) {FLAG} AS dy, n_rows - lag(n_rows) {FLAG} AS dx
                   FROM ({FLAG_DAYS})),
        w AS (SELECT *, n - least(7, greatest(1, n // 5)) AS kept, dy - lag(dy, 7) {FLAG} AS ddy,
                     dx - lag(dx, 7) {FLAG} AS ddx FROM d),
        b AS (SELECT l_returnflag, sum(ddx * ddy) / sum(ddx * ddx) AS b FROM w WHERE t > 9 AND t <= kept GROUP BY 1),
        z AS (SELECT w.*, b, y - b * x AS z FROM w JOIN b USING (l_returnflag))
        SELECT f.l_returnflag, CAST(f.date AS VARCHAR) AS date, {r('f.y', 5)} AS actual_avg_quantity,
               {r('f.b * f.x + week.z + last.z - before.z', 5)} AS forecast_avg_quantity, 'ok' AS status
        FROM z f JOIN z week ON week.l_returnflag = f.l_returnflag AND week.t = f.t - 7
        JOIN z last ON last.l_returnflag = f.l_returnflag AND last.t = f.kept
        JOIN z before ON before.l_returnflag = f.l_returnflag AND before.t = f.kept - 7
        WHERE f.t > f.kept""",
    "aic_gain_and_gate": f"""
        WITH {CLOSED_FORM},
        a AS (SELECT event_type, m.n_obs, w5.n_eff, b, m.n_eff * (ln(2 * pi() * m.sigma2) + 1) + 4 AS base,
                     w5.n_eff * (ln(2 * pi() * w5.sigma2) + 1) + 4 AS cand FROM m JOIN w5 USING (event_type)),
        s AS (SELECT event_type, min(date) AS first_day, max(date) AS last_day FROM d GROUP BY 1)
        SELECT event_type, n_obs, n_eff, {r('b')} AS coefficient, {r('base')} AS train_aic_baseline,
               {r('cand')} AS train_aic_sarimax, {r('base - cand')} AS aic_gain, 'fitted' AS status,
               base - cand >= 1 AS registered, CAST(first_day AS VARCHAR) AS train_start,
               CAST(last_day AS VARCHAR) AS train_end
        FROM a JOIN s USING (event_type)""",
    "aic_gain_on_common_days": f"""
        WITH {CLOSED_FORM},
        q AS (SELECT event_type, y, CASE WHEN t > 9 THEN prev END AS x FROM p),
        g AS (SELECT event_type, sum(x * y) / sum(x * x) AS c FROM q GROUP BY 1),
        a AS (SELECT event_type, count(x) AS n, max(c) AS phi,
                     count(x) * (ln(2 * pi() * sum((y - c * x) * (y - c * x)) / count(x)) + 1) + 4 AS base
              FROM q JOIN g USING (event_type) GROUP BY 1)
        SELECT event_type, n AS n_eff_baseline, w5.n_eff, {r('a.phi')} AS phi, {r('base')} AS train_aic_baseline,
               {r('base - (w5.n_eff * (ln(2 * pi() * w5.sigma2) + 1) + 4)')} AS aic_gain
        FROM a JOIN w5 USING (event_type)""",
    "closed_form_residuals": f"""
        WITH {CLOSED_FORM} SELECT event_type, {DAY}, {r('residual')} AS residual FROM w4 WHERE t > 9""",
    "closed_form_forecast": f"""
        WITH {CLOSED_FORM},
        n AS (SELECT event_type, max(t) AS n FROM w4 GROUP BY 1),
        h AS (SELECT event_type, n, h FROM n CROSS JOIN range(1, 6) s(h))
        SELECT h.event_type, h AS horizon_step,
               {r('week.z + last.z - before.z + future.b * future.x')} AS forecast_avg_value
        FROM h JOIN w4 week ON week.event_type = h.event_type AND week.t = n + h - 7
        JOIN w4 last ON last.event_type = h.event_type AND last.t = n
        JOIN w4 before ON before.event_type = h.event_type AND before.t = n - 7
        JOIN w4 future ON future.event_type = h.event_type AND future.t = n - 5 + h""",
    "feature_vectors": f"""
        WITH d AS (SELECT *, lag(avg_value) {USER} AS l1, lag(avg_value, 7) {USER} AS l7 FROM ({BY_USER}))
        SELECT user_id, {DAY}, {r('avg_value')} AS label, {r('l1')} AS avg_value_lag_1, {r('l7')} AS avg_value_lag_7,
               {r('CAST(dayofweek(d.date) + 1 AS DOUBLE)')} AS day_of_week,
               {r('CAST(dayofmonth(d.date) AS DOUBLE)')} AS day_of_month,
               {r('CAST(month(d.date) AS DOUBLE)')} AS month, {r('CAST(n_events AS DOUBLE)')} AS n_events
        FROM d WHERE l7 IS NOT NULL""",
    "boosted_split": f"""
        WITH d AS (SELECT *, lag(avg_value) {USER} AS l1, lag(avg_value, 7) {USER} AS l7 FROM ({BY_USER})),
        v AS (SELECT user_id, d.date, avg_value AS label, row_number() {USER} AS t, count(*) OVER (PARTITION BY user_id) AS n
              FROM d WHERE l7 IS NOT NULL),
        s AS (SELECT *, t > floor(n * 0.8) AS test FROM v)
        SELECT user_id, count(*) FILTER (NOT test) AS n_train, {r('sum(label) FILTER (NOT test)')} AS train_labels,
               count(*) FILTER (test) AS n_test, {r('sum(label) FILTER (test)')} AS test_labels,
               count(*) FILTER (test) AS n_finite FROM s GROUP BY user_id""",
    "scoring_log": f"""
        WITH d AS (SELECT DISTINCT event_type FROM ({BY_TYPE}))
        SELECT m AS model_name, 'v1' AS model_version, 5 AS forecast_horizon, count(*) AS n_series
        FROM d, (VALUES ('even'), ('odd')) t(m) GROUP BY m""",
    "parquet_scan": f"SELECT {ORDERS} FROM orders",
    "csv_lookup_scan": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
               CAST(p_size AS VARCHAR) AS p_size FROM part""",
    "table_overwrite_and_append": f"""
        WITH d AS ({BY_TYPE})
        SELECT event_type, {DAILY}, NULL AS day_of_week, NULL AS day_of_month, NULL AS week_of_year,
               NULL AS month, NULL AS quarter, NULL AS is_weekend FROM d
        UNION ALL
        SELECT event_type, {DAY}, NULL, n_events, CAST(dayofweek(d.date) + 1 AS DOUBLE),
               CAST(dayofmonth(d.date) AS DOUBLE), CAST(weekofyear(d.date) AS DOUBLE), CAST(month(d.date) AS DOUBLE),
               CAST(quarter(d.date) AS DOUBLE), CAST(dayofweek(d.date) IN (0, 6) AS DOUBLE) FROM d""",
    "positive_rows": f"SELECT {LINE_COLUMNS.format(flag='l_returnflag')} FROM ({LINES})",
    "clean_rows": f"SELECT {LINE_COLUMNS.format(flag='coalesce(l_returnflag = chr(82), FALSE)')} FROM ({LINES})",
    "timestamp_casts": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS VARCHAR) END AS ts,
               o_orderstatus = 'P' AS bad FROM orders""",
    "stage_filter": f"SELECT {ORDERS} FROM orders WHERE o_orderstatus = 'F'",
    "complete_exog_cases": f"""
        WITH d AS (SELECT *, lag(avg_value) {USER} AS l1, lag(avg_value, 2) {USER} AS l2 FROM ({BY_USER}))
        SELECT user_id, {DAY}, {r('avg_value')} AS avg_value, {r('l1')} AS avg_value_lag_1,
               {r('l2')} AS avg_value_lag_2, {r('CAST(n_events AS DOUBLE)')} AS n_events
        FROM d WHERE l1 IS NOT NULL AND l2 IS NOT NULL""",
    "row_counts": "SELECT count(*) AS n_rows FROM lineitem",
    "quality_report": f"""
        WITH c AS (SELECT count(*) AS initial_rows,
                          count(*) FILTER (WHERE l_discount > 0 AND l_tax > 0) AS clean_rows FROM lineitem)
        SELECT initial_rows, clean_rows, initial_rows - clean_rows AS removed_rows,
               {r('(initial_rows - clean_rows) * 100.0 / nullif(initial_rows, 0)')} AS removed_pct,
               CAST(0 AS BIGINT) AS bad_timestamps FROM c""",
    "daily_features": f"""
        SELECT {DAY}, {r('avg_price')} AS avg_price, {r('avg_quantity')} AS avg_quantity, n_rows
        FROM ({daily_lines()}) d ORDER BY d.date""",
    "daily_features_by_type": f"SELECT event_type, {DAILY} FROM ({BY_TYPE})",
    "daily_features_by_supplier": f"""
        SELECT l_suppkey, {DAY}, {r('avg_price')} AS avg_price, {r('avg_quantity')} AS avg_quantity, n_rows
        FROM ({daily_lines('l_suppkey')})""",
    **dict.fromkeys(("merged_daily_states", "daily_features_from_new_files"), f"""
        SELECT l_suppkey, {DAY}, {r('avg_price')} AS avg_price, {r('avg_quantity')} AS avg_quantity, n_rows
        FROM ({daily_lines('l_suppkey')})"""),
    "series_lengths": f"""
        SELECT l_partkey, count(*) AS n_obs, CASE WHEN count(*) < 10 THEN 'too_short' ELSE 'ok' END AS status
        FROM ({daily_lines('l_partkey')}) GROUP BY 1""",
    "period_index": f"SELECT user_id, {DAILY}, CAST(row_number() {USER} AS INTEGER) AS t FROM ({BY_USER})",
    "last_rows": f"""
        WITH d AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS age FROM ({BY_USER})),
        k AS (SELECT *, row_number() {USER} AS step FROM d WHERE age <= 5)
        SELECT user_id, {DAILY}, CAST(step AS INTEGER) AS horizon_step FROM k""",
    "holdout_split": f"""
        WITH d AS (SELECT *, row_number() {USER} AS t, count(*) OVER (PARTITION BY user_id) AS n_obs FROM ({BY_USER}))
        SELECT user_id, {DAILY}, CAST(t AS INTEGER) AS t, n_obs,
               CASE WHEN t > n_obs - least(7, greatest(1, n_obs // 5)) THEN 'test' ELSE 'train' END AS split
        FROM d""",
    "fraction_split": f"""
        WITH d AS (SELECT *, row_number() {USER} AS t, count(*) OVER (PARTITION BY user_id) AS n_obs FROM ({BY_USER}))
        SELECT user_id, {DAILY}, CAST(t AS INTEGER) AS t, n_obs,
               CASE WHEN t > floor(n_obs * CAST(0.8 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
        FROM d""",
    "latest_row_by_key": f"""
        SELECT {ORDERS} FROM orders WHERE o_orderstatus = 'F'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY orders.o_orderdate DESC, o_orderkey DESC) = 1""",
    "latest_row": f"""
        SELECT {ORDERS} FROM orders WHERE o_orderstatus = 'F'
        ORDER BY orders.o_orderdate DESC, o_orderkey DESC LIMIT 1""",
    "preview": f"""
        SELECT {DAY}, {r('avg_price')} AS avg_price, {r('avg_quantity')} AS avg_quantity, n_rows
        FROM ({daily_lines()}) d ORDER BY d.date LIMIT 10""",
    "calendar_features": """
        SELECT event_id, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(dayofmonth(ts) AS INTEGER) AS day_of_month,
               CAST(weekofyear(ts) AS INTEGER) AS week_of_year, CAST(month(ts) AS INTEGER) AS month,
               CAST(quarter(ts) AS INTEGER) AS quarter, dayofweek(ts) IN (0, 6) AS is_weekend,
               CAST(hour(ts) AS INTEGER) AS hour FROM events""",
    "lag_features": f"""
        SELECT user_id, {DAILY}, {", ".join(f"{r(f'lag(avg_value, {k}) {USER}')} AS avg_value_lag_{k}" for k in (1, 2, 7))}
        FROM ({BY_USER})""",
    "rolling_features": f"""
        SELECT user_id, {DAY}, {r('avg_value', 4)} AS avg_value, n_events, {rolling(3)}, {rolling(7)}
        FROM ({BY_USER})""",
    "parsed_dates": f"SELECT user_id, {DAILY} FROM ({BY_USER}) WHERE n_events < 5",
    "ar1_baseline": f"""
        WITH {lagged(BY_USER, 'user_id', 'avg_value')}
        SELECT user_id, n_obs, n_eff, {r('phi')} AS phi, {r('last_value')} AS last_value,
               {r('sigma2')} AS sigma2, {r(AIC_AR1)} AS aic FROM m""",
    "ar1_baseline_one_series": f"""
        WITH {lagged(f"SELECT 1 AS k, * FROM ({daily_lines()})", 'k', 'avg_price')}
        SELECT n_obs, n_eff, {r('phi')} AS phi, {r('last_value')} AS last_value, {r(AIC_AR1)} AS aic FROM m""",
    "ar1_residuals": f"""
        WITH {lagged(BY_USER, 'user_id', 'avg_value')}
        SELECT user_id, {DAY}, {r('coalesce(miss, y)')} AS residual, prev IS NULL AS burn_in FROM e""",
    "ar1_forecast": f"""
        WITH {lagged(BY_USER, 'user_id', 'avg_value')}
        SELECT user_id, CAST(h AS INTEGER) AS horizon_step, {r('pow(phi, h) * last_value')} AS forecast_avg_value
        FROM m CROSS JOIN range(1, 6) s(h)""",
    "order_choice": f"""
        SELECT user_id, count(*) AS n_obs, '1,1,1' AS "order",
               CASE WHEN count(*) >= 30 THEN '1,1,1,7' ELSE '0,0,0,0' END AS seasonal_order
        FROM ({BY_USER}) GROUP BY 1""",
    "sarimax_fit_ar1": one_order(
        f"SELECT * FROM (SELECT user_id, avg_value AS y, lag(avg_value) {USER} AS x FROM ({BY_USER})) WHERE x IS NOT NULL"
    ),
    "sarimax_fit_differenced_ar1": one_order(
        f"SELECT * FROM (SELECT user_id, dy AS y, lag(dy) {USER} AS x FROM ({DIFFERENCES})) WHERE x IS NOT NULL"
    ),
    "sarimax_fit_seasonal_ar": one_order(
        f"SELECT * FROM (SELECT user_id, avg_value AS y, lag(avg_value, 7) {USER} AS x FROM ({BY_USER})) WHERE x IS NOT NULL"
    ),
    "sarimax_fit_differenced_regression": one_order(
        f"SELECT user_id, dy AS y, dx AS x FROM ({DIFFERENCES}) WHERE t > 2"
    ),
    "sarimax_fit_seasonally_differenced_regression": one_order(
        f"SELECT * FROM (SELECT user_id, dy - lag(dy, 7) {USER} AS y, dx - lag(dx, 7) {USER} AS x, t "
        f"FROM ({DIFFERENCES})) WHERE t > 9"
    ),
    "model_regressor_join": f"""
        WITH {lagged(BY_USER, 'user_id', 'avg_value')},
        a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS age FROM ({BY_USER})),
        x AS (SELECT user_id, n_events, CAST(row_number() {USER} AS INTEGER) AS horizon_step FROM a WHERE age <= 5)
        SELECT user_id, horizon_step, n_events, n_obs, {r('phi')} AS phi, {r('last_value')} AS last_value
        FROM x JOIN m USING (user_id)""",
    "ar1_holdout": f"""
        WITH {HOLDOUT}
        SELECT user_id, {DAY}, {r('actual')} AS actual_avg_value, {r('forecast')} AS forecast_avg_value, status FROM o""",
    "ar1_holdout_metrics": f"""
        WITH {HOLDOUT}
        SELECT user_id, count(forecast) AS n, {r('avg(abs(actual - forecast))')} AS mae,
               {r('sqrt(avg((actual - forecast) * (actual - forecast)))')} AS rmse FROM o GROUP BY 1""",
    "acf": acf(BY_USER, "user_id", "avg_value", "user_id, "),
    "acf_one_series": acf(f"SELECT 1 AS k, * FROM ({daily_lines()})", "k", "avg_price", ""),
    "pacf": f"""
        WITH RECURSIVE {correlations(BY_USER, 'user_id', 'avg_value')},
        a AS (SELECT user_id, n_obs, greatest(1, least(20, n_obs // 2 - 1)) AS top,
                     list(acf ORDER BY lag) AS r FROM acf GROUP BY 1, 2),
        rec AS (
            SELECT user_id, n_obs, top, r, 1 AS k, [r[2]] AS phi, r[2] AS pk FROM a
            UNION ALL
            SELECT user_id, n_obs, top, r, k + 1,
                   list_append([phi[j] - nk * phi[k + 1 - j] for j in range(1, k + 1)], nk), nk
            FROM (SELECT *, (r[k + 2] - list_sum([phi[j] * r[k + 2 - j] for j in range(1, k + 1)]))
                            / (1 - list_sum([phi[j] * r[j + 1] for j in range(1, k + 1)])) AS nk
                  FROM rec WHERE k < top))
        SELECT user_id, n_obs, CAST(k AS INTEGER) AS lag, {r('pk')} AS pacf,
               {r('1.959963984540054 / sqrt(n_obs)')} AS band FROM rec""",
    "ljung_box": ljung_box(BY_USER, "user_id", "avg_value"),
    "ljung_box_of_residuals": ljung_box(
        f"WITH {lagged(BY_USER, 'user_id', 'avg_value')} SELECT user_id, date, coalesce(miss, y) AS residual FROM e",
        "user_id", "residual",
    ),
    "stationarity": f"""
        WITH p AS (SELECT *, lag(avg_value) {USER} AS prev FROM ({BY_USER})),
        s AS (SELECT user_id, regr_count(avg_value - prev, prev) AS n, regr_slope(avg_value - prev, prev) AS g,
                     regr_sxx(avg_value - prev, prev) AS sxx, regr_sxy(avg_value - prev, prev) AS sxy,
                     regr_syy(avg_value - prev, prev) AS syy FROM p GROUP BY 1),
        t AS (SELECT *, g / sqrt((syy - g * sxy) / (n - 2) / sxx) AS t_stat FROM s)
        SELECT user_id, CAST(n AS BIGINT) AS n_pairs, {r('g')} AS gamma, {r('t_stat')} AS t_stat, t_stat < -2.86 AS stationary
        FROM t""",
}


def _fits(source: str, key: str, **options: str) -> list[str]:
    return trained(source, key, "avg_value", "n_events", **options)


_by_user, _by_type = _fits(BY_USER, "user_id"), _fits(BY_TYPE, "event_type")
_seasonal = "CASE WHEN weekly THEN '{0}1{1}1{1}1{1}7{2}' ELSE '{0}0{1}0{1}0{1}0{2}' END"
_model_id = """'run-' || sha256('{"user_id":' || user_id || '}')"""
_residuals = f"{with_(_by_type)} SELECT event_type, date, e AS residual, t <= 17 AS burn_in FROM steps JOIN fits USING (event_type) WHERE t > 0 AND status = 'fitted'"

ORACLES |= {
    "sarimax_models": f"""{with_(_by_user)}
        SELECT user_id, n_obs, coalesce(n_eff, greatest(n_obs - CASE WHEN weekly THEN 17 ELSE 3 END, 0)) AS n_eff, {r('aic', 4)} AS aic, {r('gain', 4)} AS aic_gain,
               converged, status, {r('sigma2', 4)} AS sigma2, '1,1,1' AS "order", {_seasonal.format('', ',', '')} AS seasonal_order,
               {r('b', 4)} AS coefficient, {r('ar', 4)} AS ar, {r('ma', 4)} AS ma FROM fits""",
    "aic_gate": f"""{with_(_fits(BY_TYPE, "event_type", basis="common"))}
        SELECT event_type, {r('gain', 4)} AS aic_gain, status, coalesce(status = 'fitted' AND gain >= 1, false) AS registered FROM fits""",
    "sarimax_residuals": f"SELECT event_type, {DAY}, {r('residual', 4)} AS residual, burn_in FROM ({_residuals}) days_of_fits",
    "sarimax_residual_whiteness": ljung_box(f"SELECT * FROM ({_residuals}) x WHERE residual IS NOT NULL", "event_type", "residual", 4, True),
    "auto_arima": f"""{with_(best_of(BY_TYPE, "event_type", "avg_value", "n_events", [Shape.of(*c) for c in SEARCH_ORDERS]))}
        SELECT event_type, n_obs, n_fitted, "order", {r('aic', 4)} AS aic FROM best""",
    "model_registry": f"""{with_(_by_user)}
        SELECT user_id, 'value_per_day' AS model_name, 'v1' AS model_version, 'models#' || {_model_id} AS model_path, '' AS mlflow_model_uri, 'daily_events' AS target_series,
               '2024-01-01T00:00:00.000000+00:00' AS created_utc, '(1, 1, 1)' AS "order", {_seasonal.format('(', ', ', ')')} AS seasonal_order, n_obs, 'n_events' AS exog_columns,
               'Staging' AS stage, 'active' AS status, {r('round(base_aic, 3)', 2)} AS train_aic_baseline, {r('round(aic, 3)', 2)} AS train_aic_sarimax, {r('round(gain, 3)', 2)} AS aic_gain
        FROM fits WHERE status = 'fitted' AND gain >= 1""",
    "sarimax_forecast": f"""{with_(_by_user + ahead("user_id", "5"))}
        SELECT user_id, {_model_id} AS model_id, h AS horizon_step, {r('zs[1] + b * days.x', 4)} AS forecast_avg_value
        FROM ahead JOIN fits USING (user_id) JOIN days USING (user_id) WHERE h > 0 AND status = 'fitted' AND gain >= 1 AND days.t = n - 5 + h""",
    "sarimax_holdout_metrics": f"""{with_(_fits(BY_USER, "user_id", kept="n - least(7, greatest(1, n // 5))") + ahead("user_id", "7"))},
        o AS (SELECT days.user_id, y AS actual, CASE WHEN status = 'fitted' THEN zs[1] + b * x END AS forecast
              FROM days JOIN fits USING (user_id) LEFT JOIN ahead ON ahead.user_id = days.user_id AND h = t - kept WHERE t > kept)
        SELECT user_id, count(forecast) AS n, {r('avg(abs(actual - forecast))', 4)} AS mae, {r('sqrt(avg((actual - forecast) ** 2))', 4)} AS rmse FROM o GROUP BY user_id""",
}
