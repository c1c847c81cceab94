"""Bring drifting source schemas to one shape, and stamp where rows came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructField, StructType


def merge_spellings(frame: DataFrame, name: str, dtype: str) -> DataFrame:
    """One column ``name`` from every column equal to it but for case; null when there is none.

    The exact spelling wins over the others, row by row. Columns are taken by position, because
    a name that differs only in case is ambiguous to Spark.
    """
    original = frame.columns
    numbered = frame.toDF(*[f"_{i}" for i in range(len(original))])
    alike = [i for i, column in enumerate(original) if column.lower() == name.lower()]
    alike.sort(key=lambda i: original[i] != name)
    merged = F.coalesce(*[F.col(f"_{i}") for i in alike]) if alike else F.lit(None)
    merged = merged.try_cast(dtype).alias(name)

    columns: list[Column] = []
    for i, column in enumerate(original):
        if i not in alike:
            columns.append(F.col(f"_{i}").alias(column))
        elif i == min(alike):
            columns.append(merged)
    if not alike:
        columns.append(merged)
    return numbered.select(*columns)


def retype(frame: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit is null, so that the rules can see it."""
    return frame.withColumns({name: F.col(name).try_cast(dtype) for name, dtype in types.items()})


def fit_schema(frame: DataFrame, schema: StructType, skip: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the fields of ``schema``, in its order: missing ones null, unknown ones dropped."""
    wanted = StructType([field for field in schema.fields if field.name not in skip])
    shared = [field for field in wanted.fields if field.name in frame.columns]
    cast = frame.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in shared])
    return cast.to(StructType([StructField(f.name, f.dataType) for f in wanted.fields]))


def ensure_column(frame: DataFrame, name: str, dtype: str | DataType) -> DataFrame:
    if name in frame.columns:
        return frame
    return frame.withColumn(name, F.lit(None).cast(dtype))


def stamp(frame: DataFrame, constants: dict[str, str | Column]) -> DataFrame:
    """Add the load time and the given audit columns; plain text becomes a literal."""
    values = {
        name: value if isinstance(value, Column) else F.lit(value)
        for name, value in constants.items()
    }
    return frame.withColumns({"ingest_ts": F.current_timestamp(), **values})


def columns_first(frame: DataFrame, leading: list[str]) -> DataFrame:
    return frame.select(*leading, *[name for name in frame.columns if name not in leading])
