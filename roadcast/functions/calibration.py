"""Probability calibration and ensemble quantiles as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# --- Fixed value: probabilities are kept this far from 0 and 1
CLIP = 1e-6


def logit(probability: Column) -> Column:
    p = F.least(F.greatest(probability, F.lit(CLIP)), F.lit(1.0 - CLIP))
    return F.log(p / (1.0 - p))


def platt(probability: Column, slope: float, intercept: float) -> Column:
    """Sigmoid of a line over the clipped logit."""
    return 1.0 / (1.0 + F.exp(-(F.lit(slope) * logit(probability) + F.lit(intercept))))


def member_array(members: Sequence[str]) -> Column:
    return F.array(*[F.col(m) for m in members])


def array_mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return total / F.size(values)


def array_quantile(values: Column, q: float) -> Column:
    """Quantile of an array with linear interpolation between order statistics."""
    ordered = F.array_sort(values)
    position = F.lit(q) * (F.size(values) - 1)
    low = F.floor(position).cast("int")
    high = F.ceil(position).cast("int")
    below, above = F.get(ordered, low), F.get(ordered, high)
    return below + (above - below) * (position - low)
