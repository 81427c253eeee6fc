"""Tail probabilities as column expressions.

Both are meant for the few rows of a test result. Their series are evaluated inside a
lambda over one value, so that the statistic they start from is computed once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_NORMAL_TERMS = 220
_FAR = 6.0 * math.sqrt(2.0)
_STEPS = 2000
_SHIFT = 20


def normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|) for a standard normal Z, by the all-positive erf series.

    With x = |z|/sqrt(2) and y = z*z the series is
    erf(x) = 2/sqrt(pi) * exp(-x*x) * x * (1 + y/3 * (1 + y/5 * (1 + y/7 * ...))),
    taken from the inside. Past x = 6 the result is below one double-precision unit of
    1 and is returned as zero.
    """

    def tail(size: Column) -> Column:
        y = size * size
        inner = F.aggregate(
            F.sequence(F.lit(_NORMAL_TERMS), F.lit(1), F.lit(-1)),
            F.lit(1.0),
            lambda total, n: 1 + y / (2 * n + 1) * total,
        )
        erf = F.lit(math.sqrt(2.0 / math.pi)) * F.exp(-y / 2) * size * inner
        inside = F.greatest(F.lit(1.0) - erf, F.lit(0.0))
        return F.when(size >= _FAR, F.lit(0.0)).when(size < _FAR, inside)

    return F.transform(F.array(F.abs(z)), tail)[0]


def student_two_sided(t: Column, freedom: Column) -> Column:
    """P(|T| >= |t|) for Student's t with v degrees of freedom.

    With theta = atan(|t|/sqrt(v)) the inner probability is
    2*c * integral of cos(x)^(v-1) from 0 to theta, taken by Simpson's rule, where
    c = Gamma((v+1)/2) / (sqrt(pi) * Gamma(v/2)). The quotient r(v) of the gamma functions
    comes from its expansion for large v, reached from small v by
    r(v) = r(v+2) * v/(v+1). Beyond forty deviations at many degrees of freedom the
    result is zero in doubles.
    """

    def tail(case: Column) -> Column:
        size, v = case["size"], case["v"]
        lifted = F.aggregate(
            F.sequence(F.lit(0), F.lit(_SHIFT - 1)),
            F.lit(1.0),
            lambda product, i: product * (v + 2 * i) / (v + 2 * i + 1),
        )
        w = v + 2 * _SHIFT
        expansion = 1 - 1 / (4 * w) + 1 / (32 * w**2) + 5 / (128 * w**3) - 21 / (2048 * w**4)
        quotient = lifted * F.sqrt(w / 2) * expansion
        width = F.atan(size / F.sqrt(v)) / _STEPS

        def weighted(total: Column, i: Column) -> Column:
            weight = F.when((i == 0) | (i == _STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
            # log(cos x) by its distance from zero, which stays exact for many degrees of freedom.
            log_cosine = F.log1p(-2 * F.pow(F.sin(width * i / 2), F.lit(2)))
            return total + weight * F.exp((v - 1) * log_cosine)

        steps = F.sequence(F.lit(0), F.lit(_STEPS))
        integral = F.aggregate(steps, F.lit(0.0), weighted) * width / 3
        inside = 2 / math.sqrt(math.pi) * quotient * integral
        outside = F.greatest(F.least(1 - inside, F.lit(1.0)), F.lit(0.0))
        known = size.isNotNull() & (v > 0)
        far = (size > 40) & (v >= 200)
        return F.when(known & far, F.lit(0.0)).when(known, outside)

    case = F.struct(F.abs(t).alias("size"), freedom.cast("double").alias("v"))
    return F.transform(F.array(case), tail)[0]
