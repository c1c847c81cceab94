"""The first N rows of an order, for any N: find where the N-th row lies, then order what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymill.operators.layout import range_number
from quaymill.sources.workspace import Scratch

SPLITS = 255


def _splits(frame: DataFrame, column: str, splits: int) -> list:
    """Distinct values of a column from rows drawn by hash, sorted; at most ``splits``."""
    drawn = frame.where(F.col(column).isNotNull()).orderBy(F.xxhash64(*frame.columns)).limit(splits)
    return [row[0] for row in drawn.select(column).distinct().orderBy(column).collect()]


def first_bound(frame: DataFrame, size: int, order_by: list[str], splits: int = SPLITS) -> Column:
    """A condition that the first ``size`` rows of the order meet, and few others.

    Two aggregates per order column: one draws split points, the other counts exactly the rows
    between and on them. If the place of the N-th row is a single value, rows below it are in, and among the
    rows of that value the next column decides; else it is a range of about one in ``splits`` rows.
    """
    found, open_rows, wanted = F.lit(False), F.lit(True), size
    for name in order_by:
        column, inside = F.col(name), frame.where(open_rows)
        points = _splits(inside, name, splits)
        place = range_number(column, points)
        on_point = F.coalesce(column.isin(points), F.lit(False)) if points else F.lit(False)
        counted = inside.groupBy(column.isNull().alias("none"), place.alias("place"), on_point.alias("on")).count()
        cells = {(row["none"], row["place"], row["on"]): row["count"] for row in counted.collect()}
        # Nulls first, then the rows below the first point, on it, above it, and so on.
        order = [(True, 0, False), (False, 0, False)]
        order += [(False, n, on) for n in range(1, len(points) + 1) for on in (True, False)]
        for none, at, on in order:
            if cells.get((none, at, on), 0) >= size:
                break
            size -= cells.get((none, at, on), 0)
        else:
            return found | open_rows
        if none:
            open_rows = open_rows & column.isNull()
        elif on:
            value = F.lit(points[at - 1])
            found = found | (open_rows & (column.isNull() | (column < value)))
            open_rows = open_rows & (column == value)
        if (none or on) and cells[none, at, on] <= wanted:
            break
        if not none and not on:
            up_to = column < F.lit(points[at]) if at < len(points) else F.lit(True)
            return found | (open_rows & (column.isNull() | up_to))
    return found | open_rows


def first_rows(frame: DataFrame, size: int, order_by: list[str]) -> DataFrame:
    """Exactly the rows of ``orderBy(...).limit(size)``, in no particular order.

    A plain limit sends ``size`` rows of every partition to one task. Here the rows up to the bound
    of the N-th are filtered out first, in the scan where they can be, and only these are range-
    partitioned and numbered where they lie; one count per partition is added up. The frame is read
    several times, so what is costly to compute should be written first.
    """
    if size <= 0:
        return frame.limit(0)
    near = frame.where(first_bound(frame, size, order_by))
    spread = near.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    # The id holds the partition in its upper bits and the row's place within it in the lower 33.
    scratch = Scratch(frame.sparkSession, "first-rows")
    numbered = scratch.keep(spread.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_id", 33)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    # One row per shuffle partition.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    located = numbered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return located.where(F.col("_start") + place < size).select(*frame.columns)
