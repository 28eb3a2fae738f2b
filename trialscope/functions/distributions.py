"""Normal tails and normal and Student-t quantiles for Columns.

Spark SQL has no error function.  The normal tail uses the Hart (1968) rational approximation
in the double-precision arrangement published by G. West, "Better approximations to cumulative
normal functions" (2005); its error is below 1e-15.  Quantiles are needed only at configured
levels, so they are computed once on the driver and enter the plan as literals.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Published coefficients of the approximation, highest power first.
TAIL_NUMERATOR = (
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
TAIL_DENOMINATOR = (
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)
# Switch to the continued fraction, and its scaling.
TAIL_SWITCH = 7.07106781186547
SQRT_TWO_PI = 2.506628274631
TAIL_CUTOFF = 37.0


def _horner(x: Column, coefficients: tuple[float, ...]) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + F.lit(c)
    return total


def with_upper_tails(df: DataFrame, **inputs: Column) -> DataFrame:
    """Append, per keyword, P(Z > z) for a standard normal Z and the given z.

    Every intermediate value becomes a column of its own stage.  The formulas use each of them
    many times; written as one expression they would be copied into generated methods that are
    too large to compile.
    """
    names = list(inputs)
    keep = df.columns

    def temp(kind: str, name: str) -> str:
        return f"_{kind}_{name}"

    def near_and_far(name: str) -> Column:
        x, density = F.col(temp("x", name)), F.col(temp("d", name))
        central = density * _horner(x, TAIL_NUMERATOR) / _horner(x, TAIL_DENOMINATOR)
        fraction = x + F.lit(0.65)
        for k in (4.0, 3.0, 2.0, 1.0):
            fraction = x + F.lit(k) / fraction
        far = density / fraction / F.lit(SQRT_TWO_PI)
        return F.when(x > TAIL_CUTOFF, F.lit(0.0)).when(x < TAIL_SWITCH, central).otherwise(far)

    def signed(name: str) -> Column:
        tail = F.col(temp("t", name))
        return F.when(F.col(temp("z", name)) >= 0, tail).otherwise(F.lit(1.0) - tail)

    def stage(frame: DataFrame, kind: str, build) -> DataFrame:
        return frame.withColumns({temp(kind, n): build(n) for n in names})

    df = stage(df, "z", lambda n: inputs[n])
    df = stage(df, "x", lambda n: F.abs(F.col(temp("z", n))))
    df = stage(df, "d", lambda n: F.exp(-F.col(temp("x", n)) * F.col(temp("x", n)) / 2.0))
    df = stage(df, "t", near_and_far)
    return df.select(*keep, *[signed(n).alias(n) for n in names])


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def _t_cdf(t: float, df: int) -> float:
    """Closed form of the Student-t CDF for an integer number of degrees of freedom."""
    theta = math.atan(t / math.sqrt(df))
    cos2 = math.cos(theta) ** 2
    if df % 2 == 1:
        series, term = 0.0, 1.0
        for j in range(1, (df - 1) // 2 + 1):
            if j > 1:
                term *= cos2 * (2 * j - 2) / (2 * j - 1)
            series += term
        inside = theta + math.sin(theta) * math.cos(theta) * series
        return 0.5 + inside / math.pi
    series, term = 1.0, 1.0
    for j in range(1, df // 2):
        term *= cos2 * (2 * j - 1) / (2 * j)
        series += term
    return 0.5 + 0.5 * math.sin(theta) * series


@lru_cache(maxsize=None)
def small_t_quantiles(p: float, upto: int = 60) -> tuple[float, ...]:
    """Quantiles for 1..upto degrees of freedom by bisection on the closed-form CDF."""
    found = []
    for df in range(1, upto + 1):
        lo, hi = 0.0, 1.0
        while _t_cdf(hi, df) < p:
            hi *= 2
        for _ in range(200):
            mid = (lo + hi) / 2
            if _t_cdf(mid, df) < p:
                lo = mid
            else:
                hi = mid
        found.append((lo + hi) / 2)
    return tuple(found)


def t_quantile(p: float, df: Column) -> Column:
    """Student-t quantile at a configured level p > 0.5 for a column of degrees of freedom.

    Exact literals up to 60 degrees of freedom, then the Cornish-Fisher series in 1/df
    (error below 1e-9 there).
    """
    table = small_t_quantiles(p)
    x = normal_quantile(p)
    terms = (
        (x**3 + x) / 4,
        (5 * x**5 + 16 * x**3 + 3 * x) / 96,
        (3 * x**7 + 19 * x**5 + 17 * x**3 - 15 * x) / 384,
        (79 * x**9 + 776 * x**7 + 1482 * x**5 - 1920 * x**3 - 945 * x) / 92160,
    )
    nu = df.cast("double")
    series = F.lit(x)
    power = F.lit(1.0)
    for term in terms:
        power = power * nu
        series = series + F.lit(term) / power
    literals = F.array(*[F.lit(v) for v in table])
    return F.when(df > len(table), series).otherwise(F.get(literals, df.cast("int") - 1))
