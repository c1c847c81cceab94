"""Landing offers the same trips twice but joins them once."""

from __future__ import annotations

from test_round_three import ROWS, counted  # noqa: F401
from workload import queries


def test_landed_trips_are_computed_once(spark, counted):  # noqa: F811
    got = queries.append_new_months(spark, "unused").collect()
    assert counted.value == ROWS
    assert sum(row[-1] for row in got) == ROWS
