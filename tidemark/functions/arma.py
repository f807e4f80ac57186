"""Regression with seasonal ARIMA errors as column expressions over the arrays of a series.

    y_t = x_t b + z_t,      phi(L) Phi(L^s) (1-L)^d (1-L^s)^D z_t = theta(L) Theta(L^s) e_t

A fit is a chain of linear regressions, each solved from a small matrix of cross-moments:

1. ``b`` by least squares of the differenced target on the differenced regressors, which leaves u;
2. the shocks of u by a long autoregression (as many lags as both sides of the model have, and one; more
   for long series); days before its reach have shock zero;
3. u on its own lags and those of the shocks. Where plain and seasonal terms multiply, the product is
   taken at its last value and the regression is repeated ``STEPS`` times (Gauss-Newton), always from the
   same moments.

All regressions but the long one use the days after the first ``k_states``. Moments are sums over days, so
candidates that share differences are sub-blocks of one matrix: none is fitted anew (``search``).
Nothing here leaves the JVM; a series is one row, its days bounded by the calendar.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import gaussian_aic, let, total

#: Repetitions where plain and seasonal terms multiply.
STEPS = 4
#: A pivot below this part of its column's sum of squares counts as none: the column is a mix of others.
LEAST_PIVOT = 1e-10
#: Bound on the sum of a moving average's coefficients, plain and seasonal apart.
LARGEST = 0.98
NUMBERS = "array<double>"


class Shape(NamedTuple):
    """What the orders say about the sizes of things."""

    p: int
    d: int
    q: int
    P: int
    D: int
    Q: int
    s: int
    #: Seasons that the long autoregression looks back on beyond the model's own; long series can afford some.
    deep: int = 0

    @classmethod
    def of(cls, order: Sequence[int], seasonal: Sequence[int], deep: int = 0) -> Shape:
        return cls(*map(int, order), *map(int, seasonal), deep)

    @property
    def n_arma(self) -> int:
        return self.p + self.q + self.P + self.Q

    @property
    def k_diff(self) -> int:
        return self.d + self.D * self.s

    @property
    def r(self) -> int:
        return max(self.p + self.P * self.s, self.q + self.Q * self.s + 1)

    @property
    def k_states(self) -> int:
        """Days before the first that is scored."""
        return self.k_diff + self.r

    @property
    def delta(self) -> dict[int, float]:
        """Coefficients of (1-L)^d (1-L^s)^D by lag."""
        out: dict[int, float] = {0: 1.0}
        for step in (1,) * self.d + (self.s,) * self.D:
            out = {k: out.get(k, 0.0) - out.get(k - step, 0.0) for k in {*out, *(k + step for k in out)}}
        return {k: c for k, c in out.items() if c}

    @staticmethod
    def lags(plain: int, seasonal: int, s: int) -> list[int]:
        """Lags of a product of a plain and a seasonal polynomial."""
        return sorted({i + j * s for i in range(plain + 1) for j in range(seasonal + 1)} - {0})

    @property
    def ar_lags(self) -> list[int]:
        return self.lags(self.p, self.P, self.s)

    @property
    def ma_lags(self) -> list[int]:
        return self.lags(self.q, self.Q, self.s)

    @property
    def long_lags(self) -> list[int]:
        """Lags of the long autoregression: one more than both sides have, and the seasonal ones."""
        if not self.q + self.Q:
            return []
        plain, seasons = self.p + self.q + 1, max(self.P, self.Q)
        if self.deep:
            return self.lags(plain + self.deep, (seasons + self.deep) * bool(seasons), self.s)
        return sorted({*range(1, plain + 1), *(j * self.s for j in range(1, seasons + 1))})


def lagged(values: Column, k: int) -> Column:
    """The array k days later, null where nothing came before."""
    if not k:
        return values
    return F.slice(F.concat(F.array_repeat(F.lit(None).cast("double"), k), values), F.lit(1), F.size(values))


def combined(parts: Sequence[tuple[Column | float, Column]]) -> Column:
    """Sum of arrays, each times its number, day by day."""
    (first, values), *rest = parts
    out = F.transform(values, lambda v: v * first)
    for c, values in rest:
        out = F.zip_with(out, values, _plus(c))
    return out


def _plus(c: Column | float) -> Callable[[Column, Column], Column]:
    return lambda a, b: a + b * c


def difference(values: Column, shape: Shape) -> Column:
    return combined([(c, lagged(values, k)) for k, c in sorted(shape.delta.items())])


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def gram(columns: Sequence[Column], after: Column | int) -> Column:
    """Cross-moments of arrays over the days after the first ``after``."""

    def used(values: Column) -> Column:
        return F.transform(values, lambda v, i: F.when(i >= after, v).otherwise(0.0))

    return let(F.array(*map(used, columns)), lambda c: F.transform(c, lambda a: F.transform(c, lambda b: dot(a, b))))


def eliminate(matrix: Column, size: int) -> Column:
    """Solve a symmetric system whose right-hand side is the last column; a column that mixes others gets zero."""

    def with_pivots(start: Column) -> Column:
        def step(rows: Column, k: Column) -> Column:
            pivot = rows[k][k]
            row = F.when(pivot > LEAST_PIVOT * start[k][k], F.transform(rows[k], lambda v: v / pivot)).otherwise(F.transform(rows[k], lambda _: F.lit(0.0)))
            return let(row, lambda p: F.transform(rows, lambda r, i: F.when(i == k, p).otherwise(F.zip_with(r, p, lambda a, b: a - r[k] * b))))

        return F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), start, step, lambda rows: F.transform(rows, lambda r: r[size]))

    return let(matrix, with_pivots)


def least_squares(moments: Column, size: int) -> Column:
    """Coefficients of the first column on the ``size`` others, from their moments."""
    if not size:
        return F.array().cast(NUMBERS)
    rows = [F.array(*(moments[i][j] for j in range(1, size + 1)), moments[i][0]) for i in range(1, size + 1)]
    return eliminate(F.array(*rows), size)


class Terms:
    """The model's equation over the columns u, lags of u, lags of shocks, at given coefficients.

    Coefficients come in the order ar, ma, seasonal ar, seasonal ma.
    """

    def __init__(self, shape: Shape):
        self.shape = shape
        self.columns = [("u", 0), *(("u", k) for k in shape.ar_lags), *(("e", k) for k in shape.ma_lags)]

    def split(self, c: Column) -> tuple[list[Column], ...]:
        at, out = 0, []
        for n in (self.shape.p, self.shape.q, self.shape.P, self.shape.Q):
            out.append([c[at + i] for i in range(n)])
            at += n
        return tuple(out)

    def row(self, entries: Sequence[tuple[str, int, Column | float]]) -> Column:
        places = []
        for column in self.columns:
            found = [v for kind, lag, v in entries if (kind, lag) == column]
            places.append(sum(found[1:], F.lit(found[0]) if isinstance(found[0], float) else found[0]) if found else F.lit(0.0))
        return F.array(*(v.cast("double") for v in places))

    def crossed(self, c: Column) -> list[tuple[str, int, Column]]:
        """Products of plain and seasonal coefficients, as they stand on the right-hand side."""
        ar, ma, sar, sma = self.split(c)
        s = self.shape.s
        out = [("u", i + j * s, -a * b) for i, a in enumerate(ar, 1) for j, b in enumerate(sar, 1)]
        return out + [("e", i + j * s, a * b) for i, a in enumerate(ma, 1) for j, b in enumerate(sma, 1)]

    def shock(self, c: Column) -> Column:
        """The row that gives the shock: u minus all terms."""
        ar, ma, sar, sma = self.split(c)
        s = self.shape.s
        entries = [("u", 0, 1.0), *(("u", i, -a) for i, a in enumerate(ar, 1)), *(("e", i, -a) for i, a in enumerate(ma, 1))]
        entries += [*(("u", j * s, -a) for j, a in enumerate(sar, 1)), *(("e", j * s, -a) for j, a in enumerate(sma, 1))]
        return self.row(entries + [(kind, k, -v) for kind, k, v in self.crossed(c)])

    def slopes(self, c: Column) -> tuple[Column, Column]:
        """What each coefficient multiplies, the products taken at ``c``; and what is left to explain."""
        ar, ma, sar, sma = self.split(c)
        s = self.shape.s
        rows = [[("u", i, 1.0), *(("u", i + j * s, -b) for j, b in enumerate(sar, 1))] for i in range(1, self.shape.p + 1)]
        rows += [[("e", i, 1.0), *(("e", i + j * s, b) for j, b in enumerate(sma, 1))] for i in range(1, self.shape.q + 1)]
        rows += [[("u", j * s, 1.0), *(("u", i + j * s, -a) for i, a in enumerate(ar, 1))] for j in range(1, self.shape.P + 1)]
        rows += [[("e", j * s, 1.0), *(("e", i + j * s, a) for i, a in enumerate(ma, 1))] for j in range(1, self.shape.Q + 1)]
        left = [("u", 0, 1.0), *((kind, k, v) for kind, k, v in self.crossed(c))]
        return F.array(*map(self.row, rows)), self.row(left)

    def solve(self, moments: Column) -> Column:
        m = self.shape.n_arma
        if not m:
            return F.array().cast(NUMBERS)

        def step(c: Column, _: Column) -> Column:
            rows, left = self.slopes(c)

            def system(rows: Column, reach: Column, rest: Column) -> Column:
                return F.transform(rows, lambda r: F.concat(F.transform(reach, lambda g: dot(r, g)), F.array(dot(r, rest))))

            def times(r: Column) -> Column:
                return F.transform(moments, lambda g: dot(g, r))

            return let(rows, lambda t: let(F.transform(t, times), lambda g: let(times(left), lambda rest: eliminate(system(t, g, rest), m))))

        multiplied = self.shape.p * self.shape.P + self.shape.q * self.shape.Q
        rounds = F.sequence(F.lit(1), F.lit(1 + STEPS * bool(multiplied)))
        return F.aggregate(rounds, F.array_repeat(F.lit(0.0), m), step, self.bounded)

    def bounded(self, c: Column) -> Column:
        """Moving-average coefficients of a kind shrunk to add up to ``LARGEST`` at most, so that old shocks fade."""

        def shrunk(part: list[Column]) -> list[Column]:
            reach = sum((F.abs(v) for v in part), F.lit(0.0))
            return [v * F.when(reach > LARGEST, LARGEST / reach).otherwise(1.0) for v in part]

        ar, ma, sar, sma = self.split(c)
        return F.array(*ar, *shrunk(ma), *sar, *shrunk(sma))

    def sse(self, moments: Column, c: Column) -> Column:
        return let(self.shock(c), lambda v: F.greatest(dot(F.transform(moments, lambda g: dot(g, v)), v), F.lit(0.0)))


def without_regressors(differences: Column, b: Column, count: int) -> Column:
    """u: the differenced target less the differenced regressors times ``b``."""
    return combined([(1.0, differences[0]), *((-b[i], differences[i + 1]) for i in range(count))])


def long_shocks(u: Column, lags: Sequence[int], k_diff: int) -> Column:
    """Errors of a long autoregression of u; zero on the days before its reach."""
    reach = k_diff + max(lags)

    def errors(g: Column) -> Column:
        pi = least_squares(g, len(lags))
        miss = let(pi, lambda p: combined([(1.0, u), *((-p[i], lagged(u, k)) for i, k in enumerate(lags))]))
        return F.transform(miss, lambda v, i: F.when(i >= reach, v).otherwise(0.0))

    return let(gram([u, *(lagged(u, k) for k in lags)], reach), errors)


def moments(u: Column, e: Column, columns: Sequence[tuple[str, int]], after: Column | int) -> Column:
    return gram([lagged(u if kind == "u" else e, k) for kind, k in columns], after)


def recursion(inputs: Column, coefficients: dict[int, Column]) -> Column:
    """e_t = input_t - sum of c_k e_{t-k}, null before the first input; in chunks, so that no long array is rebuilt daily."""
    if not coefficients:
        return inputs
    depth = max(coefficients)

    def one(acc: Column, a: Column) -> Column:
        e = a - sum((c * acc["last"][k - 1] for k, c in coefficients.items()), F.lit(0.0))

        def put(e: Column) -> Column:
            last = F.slice(F.concat(F.array(F.coalesce(e, F.lit(0.0))), acc["last"]), 1, depth)
            return F.struct(last.alias("last"), F.concat(acc["out"], F.array(e)).alias("out"))

        return let(e, put)

    def chunk(acc: Column, values: Column) -> Column:
        start = F.struct(acc["last"].alias("last"), F.array().cast(NUMBERS).alias("out"))
        return let(
            F.aggregate(values, start, one),
            lambda done: F.struct(done["last"].alias("last"), F.concat(acc["out"], F.array(done["out"])).alias("out")),
        )

    def run(a: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(a))).cast("int"), F.lit(1))
        parts = let(size, lambda b: F.transform(F.sequence(F.lit(0), F.ceil(F.size(a) / b).cast("int") - 1), lambda k: F.slice(a, k * b + 1, b)))
        start = F.struct(F.array_repeat(F.lit(0.0), depth).alias("last"), F.array().cast("array<array<double>>").alias("out"))
        return F.aggregate(parts, start, chunk, lambda acc: F.flatten(acc["out"]))

    return F.when(F.size(inputs) > 0, let(inputs, run)).otherwise(F.array().cast(NUMBERS))


def polynomial(shape: Shape, c: Column, kind: str) -> dict[int, Column]:
    """Coefficients by lag of one side's product, as they stand on the right-hand side: of u (``u``) or shocks (``e``)."""
    terms = Terms(shape)
    ar, ma, sar, sma = terms.split(c)
    plain, seasonal = (ar, sar) if kind == "u" else (ma, sma)
    out: dict[int, Column] = {}
    for k, v in [*enumerate(plain, 1), *((j * shape.s, v) for j, v in enumerate(seasonal, 1)), *((k, v) for t, k, v in terms.crossed(c) if t == kind)]:
        out[k] = out[k] + v if k in out else v
    return out


def scores(sse: Column, n_eff: Column, n_params: int) -> dict[str, Column]:
    """Shock variance and AIC; null where there are no more days than parameters."""
    sigma2 = F.when(n_eff > n_params, F.try_divide(sse, n_eff))
    return {"sigma2": sigma2, "aic": gaussian_aic(n_eff, sigma2, n_params)}


def kept_whole(value: Column) -> Column:
    """The same value; a filter on it is not moved below the columns it is made of, which would copy them all."""
    return F.when(F.spark_partition_id() >= 0, value)


@lru_cache(maxsize=64)
def fit_stages(jvm: object, shape: Shape, y: str, x: str, n_exog: int, name: str) -> dict[str, Column]:
    """The columns of a fit, each from those before it. Kept, since a session builds the same ones for every table."""
    w, b, u, e, g, c, resid = (F.col(name + k) for k in ("_w", "_b", "_u", "_e", "_g", "_c", "_resid"))
    target, given = F.col(y), [F.get(x, F.lit(i)) for i in range(n_exog)]
    burn, terms, n_params = shape.k_states, Terms(shape), n_exog + shape.n_arma + 1
    ar, ma = polynomial(shape, c, "u"), polynomial(shape, c, "e")
    n_eff = (F.size(y) - burn).cast("long")
    scored = scores(F.col(name + "_sse"), n_eff, n_params)
    joint: dict[int, Column] = {}
    for k, f in shape.delta.items():
        for j, v in {0: F.lit(-1.0), **ar}.items():
            joint[k + j] = joint[k + j] + v * f if k + j in joint else v * f
    z = combined([(1.0, target), *((-b[i], v) for i, v in enumerate(given))])
    newest = F.reverse(F.slice(z, F.size(y) - burn + 1, F.lit(burn)))
    back = F.transform(F.reverse(F.slice(resid, F.size(y) - burn + 1, F.lit(burn))), lambda v: F.coalesce(v, F.lit(0.0)))
    ahead = [sum((v * back[k - h] for k, v in ma.items() if k >= h), F.lit(0.0)) for h in range(1, shape.r + 1)]
    model = F.struct(
        F.concat(b, c, F.array(scored["sigma2"])).alias("params"), scored["sigma2"].alias("sigma2"),
        (n_params - scored["aic"] / 2).alias("llf"), scored["aic"].alias("aic"), n_eff.alias("n_eff"),
        F.lit(True).alias("converged"), F.array(*(joint.get(k, F.lit(0.0)) for k in range(1, burn + 1))).alias("recursion"),
        newest.alias("recent"), F.array(*ahead).alias("shocks"), resid.alias("resid"), F.lit(burn).alias("burn_in"),
    )
    return {
        "_w": F.array(*(difference(v, shape) for v in (target, *given))),
        "_b": least_squares_of(gram([w[i] for i in range(n_exog + 1)], burn), n_exog),
        "_u": without_regressors(w, b, n_exog),
        "_e": long_shocks(u, shape.long_lags, shape.k_diff) if shape.long_lags else u,
        "_g": moments(u, e, terms.columns, burn),
        "_c": terms.solve(g),
        "_sse": terms.sse(g, c),
        "_resid": recursion(combined([(1.0, u), *((-v, lagged(u, k)) for k, v in sorted(ar.items()))]), ma),
        "_model": model,
    }


def fit(df: DataFrame, y: str, x: str, n_exog: int, choices: Sequence[tuple[Column, Shape]], name: str = "_fit") -> DataFrame:
    """Add ``name``, one model of each row's series: coefficients, scores, residuals, and what continues it.

    The shape is that of the first condition in ``choices`` that holds; without one, or without more days to
    score than parameters, the struct is null. ``params`` are b, ar, ma, seasonal ar, seasonal ma, shock
    variance; ``recursion``, ``recent`` and ``shocks`` are what ``continue_series`` takes. ``x`` holds one array
    for each regressor. Stages are columns rather than one nested expression, so each is computed once.
    """
    shapes = [shape for _, shape in choices]
    stages = [fit_stages(df.sparkSession._jvm, shape, y, x, n_exog, name) for shape in shapes]
    holds = [condition & (F.size(y) > s.k_states + n_exog + s.n_arma + 1) for condition, s in choices]
    for stage in stages[0]:
        value = F.when(holds[0], stages[0][stage])
        for condition, own in zip(holds[1:], stages[1:]):
            value = value.when(condition, own[stage])
        df = df.withColumn(name + stage, value)
    aic = F.col(f"{name}_model.aic")
    usable = F.when(aic.isNotNull() & ~F.isnan(aic) & (F.abs(aic) < float("inf")), F.col(f"{name}_model"))
    return df.withColumn(name, kept_whole(usable)).drop(*(name + k for k in stages[0]))


def least_squares_of(moments: Column, size: int) -> Column:
    return let(moments, lambda g: least_squares(g, size)) if size else F.array().cast(NUMBERS)


@lru_cache(maxsize=64)
def search_stages(jvm: object, shapes: tuple[Shape, ...], y: str, x: str, n_exog: int, name: str) -> dict[str, Column]:
    """The columns of a search, each from those before it; the last one is the result."""
    burn = max(s.k_states for s in shapes)
    n_eff = F.greatest(F.size(y) - burn, F.lit(0)).cast("long")
    values = [F.col(y), *(F.get(x, F.lit(i)) for i in range(n_exog))]
    groups: dict[tuple, list[Shape]] = {}
    for shape in shapes:
        groups.setdefault((shape.d, shape.D, shape.s if shape.D else 0), []).append(shape)
    found: dict[Shape, Column] = {}
    stages: dict[str, Column] = {}
    for number, group in enumerate(groups.values()):
        columns = sorted({c for s in group for c in Terms(s).columns}, key=lambda c: (c[0] == "e", c[1]))
        long = sorted({k for s in group for k in s.long_lags})
        at = f"{name}{number}"
        w, b, u, e, g = (F.col(at + k) for k in ("_w", "_b", "_u", "_e", "_g"))
        stages |= {
            at + "_w": F.array(*(difference(v, group[0]) for v in values)),
            at + "_b": least_squares_of(gram([w[i] for i in range(n_exog + 1)], burn), n_exog),
            at + "_u": without_regressors(w, b, n_exog),
            at + "_e": long_shocks(u, long, group[0].k_diff) if long else u,
            at + "_g": moments(u, e, columns, burn),
        }
        for i, shape in enumerate(group):
            terms = Terms(shape)
            own = [columns.index(column) for column in terms.columns]
            block, c, score = (F.col(f"{at}{k}{i}") for k in ("_g", "_c", "_s"))
            n_params = n_exog + shape.n_arma + 1
            s = scores(terms.sse(block, c), n_eff, n_params)
            stages |= {
                f"{at}_g{i}": F.array(*(F.array(*(g[r][k] for k in own)) for r in own)),
                f"{at}_c{i}": terms.solve(block),
                f"{at}_s{i}": F.when(F.abs(s["aic"]) < float("inf"), F.struct(s["sigma2"].alias("sigma2"), s["aic"].alias("aic"))),
            }
            found[shape] = F.struct(
                n_eff.alias("n_eff"), score["aic"].alias("aic"), F.when(score.isNotNull(), F.concat(b, c, F.array(score["sigma2"]))).alias("params"),
                score["sigma2"].alias("sigma2"), score.isNotNull().alias("converged"),
            )
    return stages | {name: kept_whole(F.array(*(found[s] for s in shapes)))}


def search(df: DataFrame, y: str, x: str, n_exog: int, shapes: Sequence[Shape], name: str = "_tried") -> DataFrame:
    """Add ``name``, an array of (n_eff, aic, params, sigma2, converged), one for each shape, all scored on the same days.

    Shapes with the same differences share one matrix of moments, whose sub-blocks they solve.
    """
    stages = search_stages(df.sparkSession._jvm, tuple(shapes), y, x, n_exog, name)
    for stage, value in stages.items():
        df = df.withColumn(stage, value)
    return df.drop(*(stage for stage in stages if stage != name))
