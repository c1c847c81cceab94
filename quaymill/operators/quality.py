"""Ordered quality rules: each row gets the reason of the first rule it fails, or null."""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    reason: str
    fails: Column


@dataclass(frozen=True)
class Range:
    """Where values must lie, as data: ends are numbers or names of columns of the same row.

    A range without ends only says whether a value must be there. A null end limits nothing.
    """

    least: float | str | None = None
    above: float | str | None = None
    most: float | str | None = None
    required: bool = False


def any_outside(values: list[Column], limit: Range) -> Column:
    """Whether one of the values is outside; a missing one is only if it is required.

    NaN sorts above every number in Spark, so it is outside of a range with an upper end.
    """

    def end(given: float | str) -> Column:
        return F.col(given) if isinstance(given, str) else F.lit(given)

    def outside(value: Column) -> Column:
        # A filter computes the value anew wherever it is named, so it is named as seldom as possible.
        broken = F.lit(False)
        if limit.least is not None and limit.least == limit.most:
            broken = broken | (value != end(limit.least))
        else:
            if limit.least is not None:
                broken = broken | (value < end(limit.least))
            if limit.most is not None:
                broken = broken | (value > end(limit.most))
        if limit.above is not None:
            broken = broken | (value <= end(limit.above))
        broken = F.coalesce(broken, F.lit(False))
        return value.isNull() | broken if limit.required else broken

    return reduce(operator.or_, map(outside, values))


REASON = "reject_reason"


def classify(frame: DataFrame, rules: list[Rule], reason: str = REASON) -> DataFrame:
    """A rule whose condition is null counts as passed."""
    first = F.coalesce(*[F.when(rule.fails, F.lit(rule.reason)) for rule in rules])
    return frame.withColumn(reason, first)


def passed(classified: DataFrame, reason: str = REASON) -> DataFrame:
    return classified.where(F.col(reason).isNull()).drop(reason)


def rejected(classified: DataFrame, reason: str = REASON) -> DataFrame:
    """Failing rows with their reason and the time they were set aside."""
    failing = classified.where(F.col(reason).isNotNull())
    return failing.withColumn("quarantined_ts", F.current_timestamp())


def reason_histogram(quarantine: DataFrame, reason: str = REASON) -> DataFrame:
    counts = quarantine.groupBy(reason).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), reason)
