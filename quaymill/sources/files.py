"""Parquet, CSV and JSON-lines scans and sinks, and file statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_parquet(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header, every column a string; an empty field is null. Needs no inference pass."""
    schema = StructType([StructField(name, StringType()) for name in columns])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines in permissive mode: bad fields are null, a malformed line is all null."""
    return spark.read.schema(schema).json(path)


def write_json_lines(frame: DataFrame, path: str, files: int | None = None) -> None:
    """Export as gzipped JSON lines; fails if the path exists. One file per partition unless ``files`` is set.

    Every line repeats all names, so plain text is many times as large. A reader takes a file as one task.
    """
    if files is not None:
        frame = frame.repartition(files)
    frame.write.mode("errorifexists").json(path, compression="gzip")


def read_batches(
    spark: SparkSession,
    paths: Mapping[str, str],
    batch_column: str,
    prepare: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """One frame over many batch files whose schemas drift; ``paths`` maps batch to path.

    ``prepare`` brings files of one schema to the common types. The batch is a literal per scan,
    so a filter on it drops whole scans at planning time.
    """
    alike: dict[str, list[DataFrame]] = {}
    for batch in sorted(paths):
        scan = spark.read.parquet(paths[batch])
        labelled = scan.select(
            "*",
            F.col("_metadata.file_name").alias("source_file"),
            F.lit(batch).alias(batch_column),
        )
        alike.setdefault(scan.schema.simpleString(), []).append(labelled)
    prepared = [prepare(reduce(DataFrame.union, scans)) for scans in alike.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), prepared)


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """Every data file of a table with its size, from the listing alone: contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("length").alias("size_bytes"))
    )


def storage_stats(spark: SparkSession, path: str) -> DataFrame:
    return data_files(spark, path).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes")
    )
