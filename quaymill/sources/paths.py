"""Path checks and moves through the Hadoop FileSystem that Spark itself uses."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return bool(fs.exists(target))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system; parents of ``target`` are created."""
    fs, old = _open(spark, source)
    _, new = _open(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _open(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def partition_dirs(spark: SparkSession, table: str, column: str) -> dict[str | None, str]:
    """Map each value of the partition column to its directory name. Lists names only, no data."""
    fs, root = _open(spark, table)
    if not fs.exists(root):
        return {}
    found: dict[str | None, str] = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        key, separator, value = name.partition("=")
        if separator and key == column:
            found[None if value == NULL_PARTITION else unquote(value)] = name
    return found
