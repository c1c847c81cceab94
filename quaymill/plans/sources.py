"""Fill the outside sources that bronze later reads: a JSON-lines feed and a database table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quaymill import trips
from quaymill.plans.bronze import month_sample
from quaymill.sources.files import write_json_lines
from quaymill.sources.jdbc import JdbcSource, load_once
from quaymill.sources.paths import path_exists


def export_json_sample(
    rows: DataFrame,
    path: str,
    month: str,
    size: int,
    order_by: list[str],
    files: int | None = None,
) -> bool:
    """Write a month's first rows as JSON lines unless the path exists; says whether it wrote."""
    if path_exists(rows.sparkSession, path):
        return False
    write_json_lines(trips.text_times(month_sample(rows, month, size, order_by)), path, files)
    return True


def load_jdbc_sample(
    rows: DataFrame,
    source: JdbcSource,
    table: str,
    month: str,
    size: int,
    order_by: list[str],
) -> bool:
    """Write a month's first rows to a database table unless it has rows; says whether it wrote."""
    return load_once(month_sample(rows, month, size, order_by), source, table)
