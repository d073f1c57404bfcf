"""Distribution helpers: histogram bins, inverse normal CDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def histogram_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1-based equal-width bin with the last bin closed; lo == hi -> bin 1."""
    raw = F.floor((x - lo) / (hi - lo) * bins) + 1
    return F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")


# Rational approximation of the inverse standard normal CDF (Acklam, 2003):
# fixed coefficients of the published algorithm.
_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00]
_P_LOW = 0.02425


def _poly(coefs: list[float], x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal distribution for 0 < p < 1."""
    q_low = F.sqrt(-2 * F.log(p))
    low = _poly(_C, q_low) / (_poly(_D, q_low) * q_low + 1)
    q_high = F.sqrt(-2 * F.log(1 - p))
    high = -_poly(_C, q_high) / (_poly(_D, q_high) * q_high + 1)
    q = p - 0.5
    r = q * q
    central = _poly(_A, r) * q / (_poly(_B, r) * r + 1)
    return (
        F.when(p < _P_LOW, low)
        .when(p > 1 - _P_LOW, high)
        .otherwise(central)
    )
