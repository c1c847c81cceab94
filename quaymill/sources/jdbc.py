"""JDBC scans and writes. Connection settings are arguments; nothing is read from the environment."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH_ROWS = 10_000


@dataclass(frozen=True)
class JdbcSource:
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None

    def options(self, dbtable: str) -> dict[str, str]:
        given = {
            "url": self.url,
            "dbtable": dbtable,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }
        return {key: value for key, value in given.items() if value is not None}


@dataclass(frozen=True)
class Slices:
    """Split a JDBC scan into ranges of a numeric, date or timestamp column, one task each."""

    column: str
    lower: str
    upper: str
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.count),
        }


def read_options(source: JdbcSource, dbtable: str, slices: Slices | None = None) -> dict[str, str]:
    options = source.options(dbtable) | {"fetchsize": str(BATCH_ROWS)}
    return options if slices is None else options | slices.options()


def read_jdbc(
    spark: SparkSession,
    source: JdbcSource,
    dbtable: str,
    slices: Slices | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """Scan a table or a parenthesised query.

    ``slices`` are of equal width; where rows crowd into some of them, give ``predicates``
    instead: conditions that split the rows evenly, one task each.
    """
    options = read_options(source, dbtable, slices)
    if predicates is None:
        return spark.read.format("jdbc").options(**options).load()
    connection = {key: options[key] for key in options if key not in ("url", "dbtable")}
    return spark.read.jdbc(source.url, dbtable, predicates=predicates, properties=connection)


# Undefined table in PostgreSQL, the SQL standard's and ODBC's base table not found,
# and Derby's.
NO_SUCH_TABLE = frozenset({"42P01", "42S02", "42X05"})


def count_query(table: str) -> str:
    return f"(SELECT COUNT(*) AS row_count FROM {table}) AS counts"


def jdbc_row_count(spark: SparkSession, source: JdbcSource, table: str) -> DataFrame:
    """One row, counted inside the database."""
    counts = read_jdbc(spark, source, count_query(table))
    # Some databases fold the unquoted alias to upper case, so take it by position.
    return counts.toDF("row_count").select(F.col("row_count").cast("bigint"))


def jdbc_has_rows(spark: SparkSession, source: JdbcSource, table: str) -> bool:
    """False when the table is empty or absent; any other failure is raised.

    Absence is told by the database's SQLSTATE, never by the wording of a message.
    """
    try:
        counted = jdbc_row_count(spark, source, table).first()
    except Exception as error:
        if not NO_SUCH_TABLE.isdisjoint(sql_states(error)):
            return False
        raise
    return counted["row_count"] > 0


def sql_states(error: BaseException) -> set[str]:
    """The SQLSTATEs along the chain of Java causes of an error."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    states = set()
    while cause is not None:
        cause = getattr(cause, "java_exception", cause)
        if "SQLException" in {kind.getSimpleName() for kind in _java_classes(cause)}:
            states.add(cause.getSQLState())
        cause = cause.getCause()
    return states


def _java_classes(value) -> list:
    kinds, kind = [], value.getClass()
    while kind is not None:
        kinds.append(kind)
        kind = kind.getSuperclass()
    return kinds


def write_jdbc(frame: DataFrame, source: JdbcSource, table: str, mode: str = "overwrite") -> None:
    options = source.options(table) | {"batchsize": str(BATCH_ROWS)}
    frame.write.format("jdbc").options(**options).mode(mode).save()


def load_once(frame: DataFrame, source: JdbcSource, table: str) -> bool:
    """Fill the table unless it already has rows; says whether it wrote."""
    if jdbc_has_rows(frame.sparkSession, source, table):
        return False
    write_jdbc(frame, source, table)
    return True
