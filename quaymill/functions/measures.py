"""Additive measures: sums and counts that can be rolled up again, and the figures made from them.

A frame of measures may be row level (``additive``) or already summed to some grain; every mart
accepts either, so one pass over the fact table can feed several marts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Measure:
    """A numeric column; ``units`` is the whole number of smallest units in 1.0 of it."""

    name: str
    column: str
    units: int = 100


@dataclass(frozen=True)
class Floating:
    """Plain double sums. Their last digits depend on the order in which Spark adds."""

    def lift(self, measure: Measure) -> Column:
        return F.col(measure.column).cast("double")

    def total(self, sums: Column, measure: Measure) -> Column:
        return sums

    def mean(self, sums: Column, count: Column, measure: Measure) -> Column:
        return F.round(F.try_divide(sums, count), 2)

    def ratio(self, top: Column, bottom: Column) -> Column:
        return F.round(F.try_divide(top, bottom), 4)


@dataclass(frozen=True)
class Exact:
    """Whole-unit BIGINT sums, divided once at the end, so that every run gives the same bits.

    For values that are whole in the measure's smallest unit, such as cents. A value that no
    BIGINT holds (NaN, infinity, too large) raises: left out, it would falsify sums and means.
    """

    def lift(self, measure: Measure) -> Column:
        return F.round(F.col(measure.column) * F.lit(float(measure.units))).cast("bigint")

    def total(self, sums: Column, measure: Measure) -> Column:
        return sums / F.lit(float(measure.units))

    def mean(self, sums: Column, count: Column, measure: Measure) -> Column:
        hundredths = F.try_divide(sums * F.lit(100.0), count * F.lit(float(measure.units)))
        return F.round(hundredths) / F.lit(100.0)

    def ratio(self, top: Column, bottom: Column) -> Column:
        return F.round(F.try_divide(top * F.lit(10000.0), bottom)) / F.lit(10000.0)


Arithmetic = Floating | Exact

ROWS = "n_rows"


def _sum_name(measure: Measure) -> str:
    return f"sum_{measure.name}"


def _count_name(measure: Measure) -> str:
    return f"n_{measure.name}"


def additive(
    facts: DataFrame, keys: list[str], measures: list[Measure], arithmetic: Arithmetic
) -> DataFrame:
    """Row-level measure columns next to the keys; a narrow projection."""
    columns = [F.lit(1).cast("bigint").alias(ROWS)]
    for measure in measures:
        columns.append(arithmetic.lift(measure).alias(_sum_name(measure)))
        columns.append(F.col(measure.column).isNotNull().cast("bigint").alias(_count_name(measure)))
    return facts.select(*keys, *columns)


def summed(measures: list[Measure]) -> list[Column]:
    """Aggregates that keep the measure columns under their names, for a coarser grain."""
    names = [ROWS]
    for measure in measures:
        names += [_sum_name(measure), _count_name(measure)]
    return [F.sum(name).alias(name) for name in names]


@dataclass(frozen=True)
class Figures:
    """Report columns over a grouped frame of measures."""

    arithmetic: Arithmetic

    def rows(self) -> Column:
        return F.sum(ROWS)

    def total(self, measure: Measure) -> Column:
        return self.arithmetic.total(F.sum(_sum_name(measure)), measure)

    def mean(self, measure: Measure) -> Column:
        return self.arithmetic.mean(
            F.sum(_sum_name(measure)), F.sum(_count_name(measure)), measure
        )

    def ratio(self, top: Measure, bottom: Measure) -> Column:
        """Ratio of two sums of the same units, to four places; null when the lower sum is zero."""
        return self.arithmetic.ratio(F.sum(_sum_name(top)), F.sum(_sum_name(bottom)))
