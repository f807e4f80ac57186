"""Column expressions used by several operators.  All stay in the JVM."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the 97.5 % point of the standard normal distribution.
NORMAL_975 = 1.959963984540054


def let(value: Column, body) -> Column:
    """Compute ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def gaussian_aic(n: Column, sigma2: Column, n_params: int) -> Column:
    """AIC of a model with normal errors at its best variance; null if that is not positive."""
    return n * (F.ln(sigma2 * (2 * math.pi)) + 1) + 2 * n_params


def regression_part(params: Column, future: Column, steps: Column) -> Column:
    """Sum of regressors times their coefficients, the first entries of ``params``, per step."""
    weighted = F.zip_with(
        F.slice(params, F.lit(1), F.size(future)), future, lambda b, x: F.transform(x, lambda v: b * v)
    )
    return F.aggregate(
        weighted,
        F.array_repeat(F.lit(0.0), steps),
        lambda acc, column: F.zip_with(acc, column, lambda a, b: a + b),
    )


def continue_series(recursion: Column, recent: Column, shocks: Column, steps: Column) -> Column:
    """The next ``steps`` values of z_t = sum of recursion_i z_{t-i} + shock terms."""

    def next_value(known: Column, h: Column) -> Column:
        past = F.slice(known, F.lit(1), F.size(recursion))
        value = total(F.zip_with(recursion, past, lambda c, z: c * z))
        return F.concat(F.array(value + F.coalesce(F.get(shocks, h - 1), F.lit(0.0))), known)

    return F.aggregate(
        F.sequence(F.lit(1), steps), recent, next_value, lambda known: F.reverse(F.slice(known, F.lit(1), steps))
    )


def autocorrelation_bands(acf: Column, n_obs: Column) -> Column:
    """Half-width of the 95 % band at each lag, were all later correlations zero."""

    def band(k: Column) -> Column:
        before = F.slice(acf, F.lit(2), F.greatest(k - 1, F.lit(0)))
        spread = 1 + 2 * total(F.transform(before, lambda r: r * r))
        return F.when(k == 0, 0.0).otherwise(NORMAL_975 * F.sqrt(spread / n_obs))

    return F.transform(F.sequence(F.lit(0), F.size(acf) - 1), band)


def partial_autocorrelations(acf: Column, max_lag: Column) -> Column:
    """Durbin-Levinson recursion over the autocorrelations from lag 0: lags 1..max_lag."""
    empty = F.array().cast("array<double>")

    def next_order(acc: Column, k: Column) -> Column:
        phi = acc["phi"]
        inner = F.slice(acf, F.lit(2), k - 1)
        above = F.get(acf, k) - total(F.zip_with(phi, F.reverse(inner), lambda a, r: a * r))
        below = 1 - total(F.zip_with(phi, inner, lambda a, r: a * r))

        def extend(last: Column) -> Column:
            shrunk = F.zip_with(phi, F.reverse(phi), lambda a, b: a - last * b)
            return F.struct(
                F.concat(shrunk, F.array(last)).alias("phi"),
                F.concat(acc["out"], F.array(last)).alias("out"),
            )

        return let(F.try_divide(above, below), extend)

    return F.aggregate(
        F.sequence(F.lit(1), max_lag),
        F.struct(empty.alias("phi"), empty.alias("out")),
        next_order,
        lambda acc: acc["out"],
    )


def ljung_box(acf: Column, n_obs: Column, lag: Column) -> Column:
    """Q statistic over lags 1..lag of autocorrelations given from lag 0."""
    terms = F.transform(
        F.sequence(F.lit(1), lag),
        lambda k: F.try_divide(F.get(acf, k) * F.get(acf, k), n_obs - k),
    )
    return n_obs * (n_obs + 2) * total(terms)


#: Terms of the series and of the continued fraction below; both have settled long before.
TERMS = 200


def chi2_tail(q: Column, dof: Column) -> Column:
    """P(chi-square with ``dof`` degrees of freedom > q); null for null, 1 up to zero, NaN for NaN.

    A finite sum for even degrees. For odd ones the incomplete gamma function: its series below the
    mean, its continued fraction above, where the tail may be tiny.
    """

    def tail(v: Column) -> Column:
        x, a = v["x"], v["a"]

        def poisson(acc: Column, i: Column) -> Column:
            return F.struct((acc["t"] * x / i).alias("t"), (acc["s"] + acc["t"]).alias("s"))

        even = F.aggregate(F.sequence(F.lit(1), F.greatest(F.floor(a).cast("int"), F.lit(1))), F.struct(F.exp(-x).alias("t"), F.lit(0.0).alias("s")), poisson, lambda acc: acc["s"])
        # the gamma function at a, half of an odd number
        halves = F.sequence(F.lit(1), F.greatest(F.ceil(a).cast("int") - 1, F.lit(1)))
        log_gamma = 0.5 * math.log(math.pi) + F.aggregate(halves, F.lit(0.0), lambda s, j: s + F.when(j < a, F.ln(j - 0.5)).otherwise(0.0))
        front = let(log_gamma, lambda g: F.exp(a * F.ln(x) - x - g))

        def grow(acc: Column, n: Column) -> Column:
            return F.struct((acc["t"] * x / (a + n)).alias("t"), (acc["s"] + acc["t"]).alias("s"))

        steps = F.sequence(F.lit(1), F.lit(TERMS))
        series = let(front, lambda f: F.aggregate(steps, F.struct((f / a).alias("t"), F.lit(0.0).alias("s")), grow, lambda acc: 1 - acc["s"]))
        fraction = F.aggregate(F.reverse(steps), x + 2 * TERMS + 1 - a, lambda f, i: x + 2 * i - 1 - a - i * (i - a) / f)
        odd = F.when(x < a + 1, series).otherwise(front / fraction)
        return F.least(F.when(v["dof"] % 2 == 0, even).otherwise(odd), F.lit(1.0))

    value = F.struct((q / 2).alias("x"), (dof / 2).alias("a"), dof.cast("int").alias("dof"))
    return F.when(F.isnan(q), q).when(q <= 0, 1.0).when(q.isNotNull(), let(value, tail))
