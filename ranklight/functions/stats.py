"""Normal distribution and two-sample expressions on aggregated rows."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the rational approximation 26.2.23 of the normal
# quantile (Abramowitz and Stegun).
QUANTILE_NUMERATOR = [2.515517, 0.802853, 0.010328]
QUANTILE_DENOMINATOR = [1.432788, 0.189269, 0.001308]

_SERIES_TERMS = 160


def chi_square_p(statistic: Column, degrees: Column) -> Column:
    """Upper tail of the chi-square distribution by Wilson and Hilferty's cube root; 1 without degrees."""
    spread = F.lit(2.0) / (9.0 * degrees)
    z = (F.pow(statistic / degrees, F.lit(1.0 / 3.0)) - (1.0 - spread)) / F.sqrt(spread)
    tail = 0.5 * (1.0 - erf(z / math.sqrt(2.0)))
    return F.when(degrees > 0, tail).otherwise(F.lit(1.0))


def finite(value: Column | str) -> Column:
    """The number, or null where it is NaN or infinite."""
    number = F.col(value) if isinstance(value, str) else value
    return F.when(F.abs(number.cast("double")) < float("inf"), number)


def erf(x: Column) -> Column:
    """Error function by its all-positive series; 1 beyond six."""
    size = F.least(F.abs(x), F.lit(6.0))
    start = F.struct(size.alias("term"), size.alias("total"))

    def grow(acc: Column, n: Column) -> Column:
        term = acc["term"] * 2.0 * size * size / (2.0 * n + 1.0)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_SERIES_TERMS)), start, grow, lambda acc: acc["total"]
    )
    value = F.least(F.lit(2.0 / math.sqrt(math.pi)) * F.exp(-size * size) * series, F.lit(1.0))
    return F.signum(x) * value


def normal_cdf(x: Column) -> Column:
    return 0.5 * (1.0 + erf(x / math.sqrt(2.0)))


def normal_quantile(p: Column) -> Column:
    """Rational approximation; outside (0, 1) it is infinite."""
    tail = F.when(p < 0.5, p).otherwise(1.0 - p)
    t = F.sqrt(-2.0 * F.log(tail))
    top = sum((c * t**i for i, c in enumerate(QUANTILE_NUMERATOR)), F.lit(0.0))
    bottom = sum((d * t ** (i + 1) for i, d in enumerate(QUANTILE_DENOMINATOR)), F.lit(1.0))
    z = t - top / bottom
    inside = F.when(p >= 0.5, z).otherwise(-z)
    return F.when((p <= 0) | (p >= 1), F.lit(float("inf"))).otherwise(inside)


def two_proportion_z(clicks_a: Column, n_a: Column, clicks_b: Column, n_b: Column) -> Column:
    """Pooled z of rate B minus rate A; 0 without data or spread.

    Null when the counts are no proportions (more clicks than observations in all).
    """
    pooled = F.try_divide((clicks_a + clicks_b).cast("double"), (n_a + n_b).cast("double"))
    sizes = F.try_divide(F.lit(1.0), n_a) + F.try_divide(F.lit(1.0), n_b)
    variance = pooled * (1.0 - pooled) * sizes
    gap = F.try_divide(clicks_b.cast("double"), n_b) - F.try_divide(clicks_a.cast("double"), n_a)
    z = F.coalesce(F.try_divide(gap, F.sqrt(variance)), F.lit(0.0))
    return F.when(variance < 0, F.lit(None)).otherwise(z)


def two_sided_p(z: Column) -> Column:
    return 2.0 * (1.0 - normal_cdf(F.abs(z)))


def sample_size(base: Column, effect: Column, alpha: float = 0.05, power: float = 0.80) -> Column:
    """Observations needed per variant for an absolute effect; 0 on invalid input."""
    z_alpha = normal_quantile(F.lit(1 - alpha / 2))
    z_beta = normal_quantile(F.lit(power))
    moved = F.least(base + effect, F.lit(0.9999))
    null_spread = F.sqrt(2.0 * base * (1.0 - base))
    moved_spread = F.sqrt(base * (1.0 - base) + moved * (1.0 - moved))
    needed = (z_alpha * null_spread + z_beta * moved_spread) ** 2 / effect**2
    valid = (base > 0) & (base < 1) & (effect > 0)
    return F.coalesce(F.when(valid, F.ceil(needed)), F.lit(0)).cast("bigint")
