"""Least squares of a topic's daily revenue.

Means come first; then the distances from them are multiplied and added up, so products lose
no digits however far the values lie from zero. Both are aggregates that combine before the
shuffle (the second merges centred moments pairwise), however many rows a topic has. The small
system of each topic is solved by elimination, as one expression; no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclens.functions import clock
from topiclens.operators.series import study_window

#: A variable that spreads less than this share of its mean is a constant, but for rounding.
SPREAD = 2.0**-50
#: A regressor of whose variance less than this share is its own depends on those before it.
OWN_SHARE = 1e-10


def _centred(rows: DataFrame, names: list[str]) -> DataFrame:
    """`topic`, each variable's distance from its topic's mean, and that mean, as `_v0, _m0, ...`."""
    values = [F.col(f"`{n}`").cast("double") for n in names]
    means = rows.groupBy("topic").agg(*[F.avg(v).alias(f"_m{i}") for i, v in enumerate(values)])
    own = rows.select("topic", *[v.alias(f"_v{i}") for i, v in enumerate(values)])
    places = range(len(names))
    return own.join(means, "topic").select(
        "topic",
        *[(F.col(f"_v{i}") - F.col(f"_m{i}")).alias(f"_v{i}") for i in places],
        *[f"_m{i}" for i in places],
    )


def _at(matrix: Column, width: int, row: Column, column: Column | int) -> Column:
    return F.get(matrix, row * width + column)


def _eliminated(matrix: Column, k: int) -> Column:
    """Gauss-Jordan elimination of a k x (k + 1) matrix whose diagonal is at most 1, row by row.

    A variable whose pivot is below OWN_SHARE is left as it is.
    """
    width = k + 1

    def step(state: Column, pivot: Column) -> Column:
        by = _at(state, width, pivot, pivot)

        def cell(place: Column) -> Column:
            row, column = F.floor(place / width), place % width
            own = _at(state, width, pivot, column) / by
            rest = F.get(state, place) - _at(state, width, row, pivot) * own
            return F.when(row == pivot, own).otherwise(rest)

        cells = F.transform(F.sequence(F.lit(0), F.lit(k * width - 1)), cell)
        return F.when(by < OWN_SHARE, state).otherwise(cells)

    return F.reduce(F.sequence(F.lit(0), F.lit(k - 1)), matrix, step)


def _fits(rows: DataFrame, regressors: list[str], target: str) -> DataFrame:
    """`topic, intercept, slopes, r2, days`: one row per topic.

    A regressor that is constant, or depends on those before it, has the slope 0. R² is NaN
    where the target is constant. All limits are shares of the variables' own spread, so units
    and origins are of no matter.
    """
    k = len(regressors)
    every = range(k + 1)
    centred = _centred(rows, [*regressors, target])
    pairs = [(i, j) for i in every for j in every if i <= j]
    moments = centred.groupBy("topic").agg(
        F.count(F.lit(1)).alias("days"),
        *[F.first(f"_m{i}").alias(f"_m{i}") for i in every],
        *[F.avg(f"_v{i}").alias(f"_a{i}") for i in every],
        *[F.covar_pop(f"_v{i}", f"_v{j}").alias(f"_c{i}_{j}") for i, j in pairs],
    )
    spread = [
        F.when(F.sqrt(f"_c{i}_{i}") > SPREAD * F.abs(f"_m{i}"), F.sqrt(f"_c{i}_{i}")) for i in every
    ]
    moments = moments.select(
        "topic", "days", *[f"_c{i}_{j}" for i, j in pairs],
        *[(F.col(f"_m{i}") + F.col(f"_a{i}")).alias(f"_m{i}") for i in every],
        *[s.alias(f"_s{i}") for i, s in enumerate(spread)],
    )

    def correlation(i: int, j: int) -> Column:
        c = F.col(f"_c{min(i, j)}_{max(i, j)}") / F.col(f"_s{i}") / F.col(f"_s{j}")
        return F.coalesce(c, F.lit(0.0))

    matrix = F.array(*[correlation(i, j) for i in range(k) for j in every])
    against = F.array(*[correlation(i, k) for i in range(k)])
    own = F.array(*[F.coalesce(F.col(f"_s{k}") / F.col(f"_s{i}"), F.lit(0.0)) for i in range(k)])
    means = F.array(*[f"_m{i}" for i in range(k)])
    solved = moments.select(
        "topic", "days", f"_m{k}", F.col(f"_s{k}").isNotNull().alias("_varies"),
        _eliminated(matrix, k).alias("_x"), against.alias("_y"), own.alias("_own"), means.alias("_means"),
    )
    # A variable that was eliminated has a 1 in its place on the diagonal.
    scaled = F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda i: F.when(_at(F.col("_x"), k + 1, i, i) > 0.5, _at(F.col("_x"), k + 1, i, k)).otherwise(0.0),
    )
    total = lambda a, b: F.reduce(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    solved = solved.withColumn("_b", scaled)
    solved = solved.withColumn("slopes", F.zip_with("_b", "_own", lambda b, s: b * s))
    return solved.select(
        "topic",
        (F.col(f"_m{k}") - total("slopes", "_means")).alias("intercept"),
        "slopes",
        F.when(F.col("_varies"), total("_b", "_y")).otherwise(F.lit(float("nan"))).alias("r2"),
        "days",
    )


def revenue_ols(
    df: DataFrame,
    regressors: list[str],
    target: str = "revenue",
    last_day: int = clock.LAST_DAY,
) -> DataFrame:
    """`topic, variable, coefficient, r2, days`: one fit per topic, with intercept."""
    fits = _fits(_window(df, regressors, target, last_day), regressors, target)
    values = F.concat(F.array("intercept"), "slopes")
    named = F.arrays_zip(
        F.array(*[F.lit(n) for n in ("intercept", *regressors)]).alias("variable"),
        values.alias("coefficient"),
    )
    return fits.select("topic", F.inline(named), "r2", "days")


def revenue_predicted(
    df: DataFrame,
    regressors: list[str],
    target: str = "revenue",
    last_day: int = clock.LAST_DAY,
) -> DataFrame:
    """`topic, day, actual, predicted, r2` of the fit above."""
    rows = _window(df, regressors, target, last_day)
    fitted = F.col("intercept")
    for i, name in enumerate(regressors):
        fitted = fitted + F.get("slopes", F.lit(i)) * F.col(name)
    return rows.join(_fits(rows, regressors, target), "topic").select(
        "topic", "day", F.col(target).alias("actual"), fitted.alias("predicted"), "r2"
    )


def _window(df: DataFrame, regressors: list[str], target: str, last_day: int) -> DataFrame:
    """Complete rows of the study window."""
    columns = dict.fromkeys(["topic", "day", *regressors, target])
    return study_window(df.select(*columns), last_day).dropna()


def revenue_regr(df: DataFrame, x: str, y: str = "revenue") -> DataFrame:
    """Slope, intercept and R² per topic for a single regressor."""
    return df.groupBy("topic").agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )
