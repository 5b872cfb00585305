"""Tail probabilities for the few result rows of a statistical test."""

from __future__ import annotations

import itertools
import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-300
EPS = 1e-15
NORMAL = 1e6


def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0:
        return 1.0
    log_front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1:  # power series for the lower part
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * EPS:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * math.exp(log_front))
    b = x + 1 - a  # continued fraction for the upper part, modified Lentz
    c, d = 1 / TINY, 1 / b
    value = d
    for i in itertools.count(1):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or TINY)
        c = b + step / c or TINY
        value *= d * c
        if abs(d * c - 1) < EPS:
            return math.exp(log_front) * value


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):  # the fraction converges fast only below the mean
        return 1.0 - incomplete_beta(b, a, 1 - x)
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    c, d = 1.0, 1.0 / (1 - (a + b) * x / (a + 1) or TINY)
    value = d
    for m in itertools.count(1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        change = 1.0
        for step in (even, odd):
            d = 1 / (1 + step * d or TINY)
            c = 1 + step / c or TINY
            change = d * c
            value *= change
        if abs(change - 1) < EPS:
            return math.exp(log_front) * value / a


def chi2_tail(statistic: float, dof: float) -> float:
    return upper_gamma(dof / 2, statistic / 2)


def t_two_sided(statistic: float, dof: float) -> float:
    """Above ``NORMAL`` degrees of freedom the log-gamma terms of the beta function cancel and cost
    digits, while the normal tail with its first two corrections in 1/dof is exact to rounding."""
    if dof <= NORMAL:
        return incomplete_beta(dof / 2, 0.5, dof / (dof + statistic * statistic))
    t = abs(statistic)
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    first = t * (t**2 + 1) / 4
    second = t * (3 * t**6 - 7 * t**4 - 5 * t**2 - 3) / 96
    return math.erfc(t / math.sqrt(2)) + 2 * density * (first / dof + second / dof**2)


def tail(kind: str, statistic: str, dof: str) -> Column:
    """p-value column for result rows; Arrow batches, one call per test result."""
    function = {"chi2": chi2_tail, "t": t_two_sided}[kind]

    @F.pandas_udf("double")
    def p_value(s: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) or pd.isna(y) else function(x, y) for x, y in zip(s, d, strict=True)])

    return p_value(F.col(statistic).cast("double"), F.col(dof).cast("double"))
