import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import arma
from tidemark.functions.arma import Shape
from tidemark.functions.columns import chi2_tail
from tidemark.operators import diagnostics, models

SHORT = ((1, 1, 1), (0, 0, 0, 0))
WEEKLY = ((1, 1, 1), (1, 1, 1, 7))


def products(shape, theta):
    """Coefficients by lag of both sides' products, as they stand on the right-hand side."""
    ar, ma, sar, sma = np.split(np.asarray(theta, dtype=float), np.cumsum([shape.p, shape.q, shape.P]))

    def multiply(plain, seasonal, sign):
        one, other = np.r_[1.0, sign * plain], np.zeros(len(seasonal) * shape.s + 1)
        other[0] = 1.0
        other[shape.s * np.arange(1, len(seasonal) + 1)] = sign * seasonal
        return {k: sign * c for k, c in enumerate(np.convolve(one, other)) if k and c}

    return multiply(ar, sar, -1.0), multiply(ma, sma, 1.0)


def simulate(order, seasonal, theta, n, seed, beta=()):
    """A series of the model with unit shocks, by its recursion, and its regressors."""
    shape = Shape.of(order, seasonal)
    rng = np.random.default_rng(seed)
    ar, ma = products(shape, theta)
    e, u = rng.normal(size=n + 300), np.zeros(n + 300)
    for t in range(20, n + 300):
        u[t] = e[t] + sum(c * u[t - k] for k, c in ar.items()) + sum(c * e[t - k] for k, c in ma.items())
    z = u[300:].copy()
    for t in range(n):
        z[t] -= sum(c * z[t - k] for k, c in shape.delta.items() if k and t >= k)
    x = rng.normal(size=(len(beta), n))
    return 15 + z + np.asarray(beta) @ x if len(beta) else 15 + z, list(x)


def shifted(v, k):
    return np.r_[np.full(k, np.nan), v[: len(v) - k]] if k else v


def regress(y, columns, rows):
    return np.linalg.lstsq(np.array(columns)[:, rows].T, y[rows], rcond=None)[0] if columns else np.zeros(0)


def by_hand(y, x, order, seasonal):
    """The same regressions with numpy, row by row: b, ARMA coefficients, sse, residuals."""
    shape, n = Shape.of(order, seasonal), len(y)
    t = np.arange(n)

    def diff(v):
        return sum(c * shifted(v, k) for k, c in shape.delta.items())

    scored = t >= shape.k_states
    b = regress(diff(y), [diff(v) for v in x], scored)
    u = diff(y) - sum((c * diff(v) for c, v in zip(b, x)), np.zeros(n))
    e = np.zeros(n)
    if shape.long_lags:
        reached = t >= shape.k_diff + max(shape.long_lags)
        lags = [shifted(u, k) for k in shape.long_lags]
        e[reached] = (u - sum(c * v for c, v in zip(regress(u, lags, reached), lags)))[reached]
    theta = np.zeros(shape.n_arma)
    for _ in range(1 + arma.STEPS):
        step = 1e-6
        base = mean(u, e, shape, theta)
        slopes = [(mean(u, e, shape, theta + step * unit) - base) / step for unit in np.eye(shape.n_arma)]
        theta = regress(u - base + sum((c * s for c, s in zip(theta, slopes)), np.zeros(n)), slopes, scored)
    ar, ma, sar, sma = np.split(theta, np.cumsum([shape.p, shape.q, shape.P]))
    ma, sma = (v * min(1.0, arma.LARGEST / max(np.abs(v).sum(), 1e-300)) for v in (ma, sma))
    theta = np.r_[ar, ma, sar, sma]
    miss = u - mean(u, e, shape, theta)
    return b, theta, (miss[scored] ** 2).sum(), residuals_by_hand(u, shape, theta)


def mean(u, e, shape, theta):
    ar, ma = products(shape, theta)
    return sum((c * shifted(u, k) for k, c in ar.items()), np.zeros(len(u))) + sum((c * shifted(e, k) for k, c in ma.items()), np.zeros(len(u)))


def residuals_by_hand(u, shape, theta):
    ar, ma = products(shape, theta)
    out = np.full(len(u), np.nan)
    for t in range(len(u)):
        value = u[t] - sum(c * (u[t - k] if t >= k else np.nan) for k, c in ar.items())
        out[t] = value - sum(c * np.nan_to_num(out[t - k] if t >= k else 0.0) for k, c in ma.items())
    return out


def fits(spark, series, order, seasonal, deep=0):
    """Fits of (y, [x, ...]) in one shape, in order."""
    count = len(series[0][1])
    rows = [(i, [float(v) for v in y], [[float(v) for v in c] for c in x]) for i, (y, x) in enumerate(series)]
    frame = spark.createDataFrame(rows, "i int, y array<double>, x array<array<double>>")
    done = arma.fit(frame, "y", "x", count, [(F.lit(True), Shape.of(order, seasonal, deep))])
    return [r["_fit"] for r in done.orderBy("i").collect()]


@pytest.mark.parametrize("order, seasonal, theta", [
    (*SHORT, [0.5, -0.4]), (*WEEKLY, [0.5, -0.4, 0.2, -0.6]), ((2, 0, 1), (0, 0, 0, 0), [0.5, 0.2, 0.3]), ((0, 1, 1), (0, 1, 1, 4), [-0.4, 0.3]),
    ((1, 0, 0), (2, 0, 0, 3), [0.3, 0.2, 0.1]), ((0, 0, 0), (0, 0, 0, 0), []),
])
def test_fit_equals_the_regressions_by_hand(spark, order, seasonal, theta):
    series = [simulate(order, seasonal, theta, n, n, (1.0, -2.0)) for n in (90, 200)]
    for (y, x), fit in zip(series, fits(spark, series, order, seasonal)):
        shape = Shape.of(order, seasonal)
        b, arma_part, sse, resid = by_hand(y, x, order, seasonal)
        n_eff = len(y) - shape.k_states
        assert fit.n_eff == n_eff and fit.burn_in == shape.k_states
        assert fit.params == pytest.approx([*b, *arma_part, sse / n_eff], rel=1e-4, abs=1e-5)
        assert fit.aic == pytest.approx(n_eff * (np.log(2 * np.pi * sse / n_eff) + 1) + 2 * (3 + shape.n_arma), abs=1e-3)
        assert [v is None for v in fit.resid] == np.isnan(resid).tolist()
        assert [v for v in fit.resid if v is not None] == pytest.approx(resid[~np.isnan(resid)].tolist(), rel=1e-4, abs=1e-3)


@pytest.mark.parametrize(
    "order, seasonal, theta, n",
    [
        ((1, 0, 0), (0, 0, 0, 0), [0.7], 3000),
        (*SHORT, [0.6, -0.3], 3000),
        (*WEEKLY, [0.6, -0.3, 0.5, 0.3], 3000),
    ],
)
def test_known_parameters_come_back(spark, order, seasonal, theta, n):
    beta = (1.5, -2.0)
    y, x = simulate(order, seasonal, theta, n, 5, beta)
    if order[1] == 0:
        y = y - 15
    fit = fits(spark, [(y, x)], order, seasonal, models.DEEP)[0]
    assert fit.converged
    assert fit.params == pytest.approx([*beta, *theta, 1.0], abs=0.2)
    assert fit.sigma2 == pytest.approx(1.0, abs=0.1)


def test_scale_of_the_data_does_not_matter(spark):
    y, x = simulate(*SHORT, [0.6, -0.3], 80, 9, (1.0,))
    plain, large = fits(spark, [(y, x), (y * 1e4, [x[0] * 1e-3])], *SHORT)
    assert large.aic - plain.aic == pytest.approx(2 * plain.n_eff * np.log(1e4), abs=1e-4)
    assert large.params[1:3] == pytest.approx(plain.params[1:3], abs=1e-4)


def test_regression_without_arma_is_least_squares(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2, 40))
    y = 2 * x[0] - x[1] + rng.normal(size=40)
    fit = fits(spark, [(y, list(x))], (0, 0, 0), (0, 0, 0, 0))[0]
    wanted = np.linalg.lstsq(x[:, 1:].T, y[1:], rcond=None)[0]
    assert fit.params[:2] == pytest.approx(wanted, abs=1e-6)


def test_short_constant_and_collinear_series_do_not_stop_a_batch(spark):
    flat, line = np.full(40, 3.0), np.arange(40.0)
    spiked, wild = np.sin(line), np.cos(line) * 1e300
    spiked[7] = np.inf
    good = np.sin(line) + np.random.default_rng(0).normal(size=40)
    ys = [np.zeros(0), np.arange(2.0), flat, np.sin(line), spiked, wild, good]
    series = list(zip(ys, [[y * 1.0, y * 1.0] for y in ys[:-1]] + [[line, flat]]))
    for order, seasonal in (SHORT, WEEKLY):
        found = fits(spark, series, order, seasonal)
        assert found[0] is None and found[1] is None and found[2] is None and found[4] is None
        assert found[-1].aic == pytest.approx(fits(spark, series[-1:], order, seasonal)[0].aic, abs=1e-4)


def test_no_row_leaves_the_jvm(lengths):
    for frame in (models.train(lengths, ["k"], "date", "y", ["x1"]), diagnostics.ljung_box_test(lengths, "y", ["k"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


# the same through Spark


def _frame(spark, series):
    rows = [
        (key, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(v), float(x[0][i]), float(x[1][i]))
        for key, (y, x) in series.items()
        for i, v in enumerate(y)
    ]
    return spark.createDataFrame(rows, "k string, date date, y double, x1 double, x2 double")


@pytest.fixture(scope="module")
def lengths(spark):
    series = {
        f"n{n}": simulate(*SHORT, [0.6, -0.3], n, n, (1.0, -1.0)) for n in (1, 9, 10, 29, 30, 60)
    }
    series["flat"] = (np.full(40, 2.0), np.random.default_rng(1).normal(size=(2, 40)))
    return _frame(spark, series)


def test_orders_and_status_by_length(lengths):
    got = {r.k: r for r in models.train(lengths, ["k"], "date", "y", ["x1", "x2"]).collect()}
    assert {k for k, r in got.items() if r.status == "too_short"} == {"n1", "n9"}
    assert got["n29"].seasonal_order == [0, 0, 0, 0] and got["n30"].seasonal_order == [1, 1, 1, 7]
    assert got["n60"].status == "fitted" and got["n60"].n_eff == 43
    assert got["flat"].status == "failed" and got["flat"].aic_gain is None
    assert got["n60"].aic_gain == pytest.approx(got["n60"].baseline.aic - got["n60"].aic)


def test_common_basis_scores_the_same_days(lengths):
    got = {
        r.k: r for r in models.train(lengths, ["k"], "date", "y", ["x1"], aic_basis="common").collect()
    }
    for k in ("n29", "n30", "n60"):
        assert got[k].baseline.n_eff == got[k].n_eff


def test_baseline_equals_the_searched_model(lengths):
    from tidemark.operators.daily import series_rows

    closed = {r.k: r for r in models.ar1_baseline(lengths, ["k"], "date", "y").collect()}
    fits = models.search_orders(
        series_rows(lengths, ["k"], "date", "y"), ["k"], [((1, 0, 0), (0, 0, 0, 0))]
    )
    for r in fits.filter("aic is not null and k != 'flat'").collect():
        assert r.params[0] == pytest.approx(closed[r.k].phi, abs=1e-6)
        assert r.aic == pytest.approx(closed[r.k].aic, abs=1e-6)


def test_gate():
    rows = [("fitted", 1.0), ("fitted", 0.99), ("fitted", None), ("failed", 5.0), ("too_short", None)]
    from pyspark.sql import SparkSession

    frame = SparkSession.getActiveSession().createDataFrame(rows, "status string, aic_gain double")
    assert [r.aic_gain for r in frame.filter(models.passes_gate(1.0)).collect()] == [1.0]


@pytest.mark.parametrize("order, seasonal", [SHORT, WEEKLY, ((2, 0, 1), (0, 0, 0, 0)), ((0, 1, 0), (0, 1, 0, 7))])
def test_forecasts_continue_the_recursion(spark, order, seasonal):
    shape, n, steps = Shape.of(order, seasonal), 60, 12
    y, x = simulate(order, seasonal, [0.5, 0.2, -0.4, -0.6][: shape.n_arma], n + steps, 8, (1.0, -1.0))
    fit = fits(spark, [(y[:n], [c[:n] for c in x])], order, seasonal)[0]
    frame = spark.createDataFrame(
        [(fit.params, fit.recursion, fit.recent, fit.shocks, [c[n:].tolist() for c in x])],
        "params array<double>, recursion array<double>, recent array<double>, shocks array<double>, future array<array<double>>",
    )
    found = frame.select(models.forecast_sarimax("", F.col("future"), F.lit(steps)).alias("f")).first().f
    beta, (ar, ma) = fit.params[:2], products(shape, fit.params[2 : 2 + shape.n_arma])
    z = [*(y[:n] - beta[0] * x[0][:n] - beta[1] * x[1][:n])]
    u = [*sum(c * shifted(np.array(z), k) for k, c in shape.delta.items())]
    e = [v or 0.0 for v in fit.resid]
    for t in range(n, n + steps):
        u.append(sum(c * u[t - k] for k, c in ar.items()) + sum(c * e[t - k] for k, c in ma.items()))
        e.append(0.0)
        z.append(u[t] - sum(c * z[t - k] for k, c in shape.delta.items() if k))
    assert found == pytest.approx(np.array(z[n:]) + beta[0] * x[0][n:] + beta[1] * x[1][n:], rel=1e-6, abs=1e-6)


def test_residual_rows_carry_the_burn_in(lengths):
    fits = models.train(lengths.filter("k = 'n60'"), ["k"], "date", "y", ["x1", "x2"])
    rows = models.residuals(fits, ["k"]).orderBy("date").collect()
    assert len(rows) == 60 and [r.burn_in for r in rows] == [True] * 17 + [False] * 43


def test_search_finds_the_best_of_all_candidates(spark):
    from tidemark.operators.daily import series_rows

    frame = _frame(spark, {k: simulate((2, 1, 0), (0, 0, 0, 0), [0.5, 0.3], 400, s, (1.0, 1.0)) for s, k in enumerate("ab")})
    series = series_rows(frame, ["k"], "date", "y", ["x1", "x2"])
    tried = models.search_orders(series, ["k"]).collect()
    assert len(tried) == 18 and len({r.n_eff for r in tried}) == 1
    for r in models.fit_auto_arima(series, ["k"]).collect():
        assert r.aic == pytest.approx(min(t.aic for t in tried if t.k == r.k and t.converged))


def test_search_keeps_series_that_no_candidate_fits(lengths):
    from tidemark.operators.daily import series_rows

    best = models.fit_auto_arima(series_rows(lengths, ["k"], "date", "y", ["x1"]), ["k"]).collect()
    assert len(best) == 7
    assert {r.k for r in best if r.aic is None} >= {"n1"} and {r.k for r in best if r.aic is not None} >= {"n60"}


def test_partial_autocorrelations_equal_yule_walker(spark, lengths):
    rows = diagnostics.pacf(lengths.filter("k = 'n60'"), "y", ["k"]).orderBy("lag").collect()
    acf = [r.acf for r in diagnostics.acf(lengths.filter("k = 'n60'"), "y", ["k"]).orderBy("lag").collect()]
    assert len(rows) == 20 and len(acf) == 21
    for r in rows:
        k = r.lag
        gram = np.array([[acf[abs(i - j)] for j in range(k)] for i in range(k)])
        assert r.pacf == pytest.approx(np.linalg.solve(gram, acf[1 : k + 1])[-1], abs=1e-9)


def test_correlations_of_short_and_flat_series(lengths):
    rows = diagnostics.acf(lengths, "y", ["k"]).collect()
    assert [r.acf for r in rows if r.k == "n1"] == [None]
    assert len([r for r in rows if r.k == "n9"]) == 9
    assert all(r.acf is None for r in rows if r.k == "flat")
    short = [r for r in diagnostics.pacf(lengths, "y", ["k"]).collect() if r.k == "n9"]
    assert [r.lag for r in sorted(short, key=lambda r: r.lag)] == [1, 2, 3]
    tests = [r for r in diagnostics.ljung_box_test(lengths, "y", ["k"]).collect() if r.k == "n9"]
    assert [r.lag for r in tests] == [8]


# Upper points of the chi-square distribution from published tables.
@pytest.mark.parametrize(
    "q, dof, p",
    [(3.841, 1, 0.05), (6.635, 1, 0.01), (5.991, 2, 0.05), (7.815, 3, 0.05), (15.086, 5, 0.01),
     (18.307, 10, 0.05), (30.144, 19, 0.05), (31.410, 20, 0.05), (37.566, 20, 0.01)],
)
def test_chi_square_tail(spark, q, dof, p):
    assert spark.range(1).select(chi2_tail(F.lit(q), F.lit(dof)).alias("p")).first().p == pytest.approx(p, rel=1e-3)


def test_chi_square_tail_of_odd_degrees_lies_between_the_even_ones(spark):
    rows = spark.createDataFrame([(q, d) for q in (0.01, 0.5, 3.0, 20.0, 90.0, 800.0) for d in range(1, 21)], "q double, d int")
    p = {(r.q, r.d): r.p for r in rows.select("q", "d", chi2_tail(F.col("q"), F.col("d")).alias("p")).collect()}
    for (q, d), v in p.items():
        assert 0 < v <= 1 and (d == 1 or p[q, d - 1] <= v)
        if d > 2:  # a step of two degrees adds one term
            import math
            assert v - p[q, d - 2] == pytest.approx(math.exp((d / 2 - 1) * math.log(q / 2) - q / 2 - math.lgamma(d / 2)), rel=1e-6, abs=1e-14)


def test_chi_square_tail_at_the_ends(spark):
    for dof in (19, 20):
        rows = spark.createDataFrame([(0.0,), (900.0,), (float("nan"),), (None,)], "q double")
        none, far, unknown, null = (r.p for r in rows.select(chi2_tail(F.col("q"), F.lit(dof)).alias("p")).collect())
        assert none == 1.0 and 0 < far < 1e-100 and np.isnan(unknown) and null is None


def test_fit_needs_one_exchange_by_series(lengths):
    plan = models.train(lengths, ["k"], "date", "y", ["x1", "x2"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_filter_on_the_outcome_does_not_fit_twice(lengths):
    trained = models.train(lengths, ["k"], "date", "y", ["x1", "x2"])
    for frame in (models.residuals(trained, ["k"]), trained.filter(models.passes_gate(1.0))):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("AS _fit_c#") <= 1


def test_diagnostics_need_one_exchange_by_series(lengths):
    plan = diagnostics.ljung_box_test(lengths, "y", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan
