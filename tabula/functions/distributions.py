"""Quantiles of the normal and of Student's t distribution as column expressions.

Student's t has a closed form for whole degrees of freedom: with
``theta = atan(t / sqrt(df))`` the central probability is a finite sum of powers
of ``cos(theta)`` (Abramowitz & Stegun 26.7.3 and 26.7.4).  The sum is folded
with ``aggregate`` and inverted by halving the interval of theta, which is
safe for one degree of freedom and for many.  Beyond ``EXPANDED`` degrees the
expansion in powers of ``1/df`` around the normal quantile (26.7.5) is exact to
double precision and costs nothing.  One row per group, so nothing here grows
with the data.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Degrees of freedom from which the expansion around the normal quantile is used.
EXPANDED = 1000
#: Halvings of an interval of length pi/2: below the spacing of doubles.
HALVINGS = 56


def _central(theta: Column, df: Column) -> Column:
    """P(|T| <= sqrt(df) · tan(theta)) for whole ``df`` of 1 or more."""
    odd = df % 2 == 1
    cos = F.cos(theta)
    # term k is term k-1 times cos² times (2k)/(2k+1) for odd, (2k-1)/(2k) for even df
    steps = F.floor(F.when(odd, (df - 3) / 2).otherwise((df - 2) / 2)).cast("int")
    start = F.when(odd, cos).otherwise(F.lit(1.0))
    zero = F.struct(start.alias("term"), start.alias("total"))

    def add(state: Column, k: Column) -> Column:
        share = F.when(odd, 2 * k / (2 * k + 1)).otherwise((2 * k - 1) / (2 * k))
        term = state["term"] * cos * cos * share
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    places = F.when(steps >= 1, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(places, zero, add, lambda s: s["total"])
    return (F.when(df == 1, theta * (2 / math.pi))
            .when(odd, (theta + F.sin(theta) * total) * (2 / math.pi))
            .otherwise(F.sin(theta) * total))


def _expanded(z: float, df: Column) -> Column:
    """Student's quantile around the normal one, in powers of 1/df."""
    terms = ((z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96,
             (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
             (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160)
    out = F.lit(z)
    for k, g in enumerate(terms, 1):
        out = out + F.lit(g) / F.pow(df, F.lit(float(k)))
    return out


def t_quantile(level: float, df: Column) -> Column:
    """The t with P(|T| <= t) = ``level`` for ``df`` degrees of freedom.

    ``df`` is a whole number; NULL where it is NULL or below 1.
    """
    if not 0 < level < 1:
        raise ValueError("level must lie between 0 and 1")
    whole = F.when(df >= 1, df.cast("double"))
    few = F.least(whole, F.lit(float(EXPANDED)))
    ends = F.struct(F.lit(0.0).alias("lo"), F.lit(math.pi / 2).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        middle = (s["lo"] + s["hi"]) / 2
        below = _central(middle, few) < level
        return F.struct(F.when(below, middle).otherwise(s["lo"]).alias("lo"),
                        F.when(below, s["hi"]).otherwise(middle).alias("hi"))

    theta = F.aggregate(F.array(*[F.lit(k) for k in range(HALVINGS)]), ends, halve,
                        lambda s: (s["lo"] + s["hi"]) / 2)
    z = NormalDist().inv_cdf((1 + level) / 2)
    return F.when(whole > EXPANDED, _expanded(z, whole)).when(whole >= 1, F.sqrt(few) * F.tan(theta))
