"""Partitioned Parquet tables under one root: append, replace, upsert and their history.

Every write that replaces rows is staged in full beside the tables and then moved into place by
renaming partition directories, so a failed job leaves the old rows as they were. One writer per
table is assumed; several tables do not commit together.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

from quaymill.operators.schema import ensure_column
from quaymill.sources.paths import (
    move_path,
    partition_dirs,
    path_exists,
    read_small,
    remove_path,
    write_small,
)
from quaymill.sources.workspace import Scratch

HISTORY = "write_history"
HISTORY_SCHEMA = (
    "table_name string, version bigint, operation string, written_at timestamp, "
    "rows_inserted bigint, rows_updated bigint"
)


@dataclass(frozen=True)
class Staged:
    """A finished write that no reader sees yet."""

    path: str
    rows: DataFrame
    count: int
    """How many rows it holds, counted by the writing job."""


def _counted(frame: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and what will know how many of its rows were written."""
    seen = Observation()
    return frame.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _one_of(column: str, values: Iterable[str | None]) -> Column:
    listed = [value for value in values if value is not None]
    chosen = F.col(column).isin(listed)
    return chosen | F.col(column).isNull() if None in values else chosen


def _null_safe(keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"t.{key}").eqNullSafe(F.col(f"s.{key}"))
    return condition


# Types of which a scan can skip row groups by their smallest and largest value, or none at all.
_UNORDERED = (ArrayType, BinaryType, MapType, StructType, VariantType)


def key_bounds(source: DataFrame, keys: list[str]) -> Column:
    """A condition that every row with a key of the source meets: bounds per key column.

    One aggregate over the source. The condition is never null and reaches a Parquet scan as
    comparisons, so row groups and files without such keys are not read.
    """
    ordered = [key for key in keys if not isinstance(source.schema[key].dataType, _UNORDERED)]
    if not ordered:
        return F.lit(True)
    edges = []
    for place, key in enumerate(ordered):
        edges += [F.min(key).alias(f"low{place}"), F.max(key).alias(f"high{place}"), F.count_if(F.col(key).isNull()).alias(f"none{place}")]
    found = source.agg(*edges).first()
    within = F.lit(True)
    for place, key in enumerate(ordered):
        column, kind = F.col(key), source.schema[key].dataType
        inside = F.lit(False)
        if found[f"low{place}"] is not None:
            low, high = (F.lit(found[f"{edge}{place}"]).cast(kind) for edge in ("low", "high"))
            inside = column.isNotNull() & (column >= low) & (column <= high)
        within = within & (inside | column.isNull() if found[f"none{place}"] else inside)
    return within


def _with_last(schema: StructType, partition_by: str) -> StructType:
    fields = [field for field in schema.fields if field.name != partition_by]
    return StructType(fields).add(partition_by, StringType())


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    def _holds_files(self, table: str, partition_by: str | None) -> bool:
        if not self.exists(table):
            return False
        return partition_by is None or bool(self.batches(table, partition_by))

    # --- reading ----------------------------------------------------------------------------

    def read(
        self, table: str, schema: StructType | None = None, partition_by: str | None = None
    ) -> DataFrame:
        """Scan a table; columns that older files lack are null.

        Writes keep the table's schema beside it, so no footer is read; only a table that something else
        wrote is asked for its footers. ``schema`` overrides both and lets a table that was
        emptied be read. ``partition_by`` keeps the partition values text.
        """
        path = self.path(table)
        if schema is None:
            schema = self.kept_schema(table)
            if schema is None:
                schema = self.spark.read.option("mergeSchema", True).parquet(path).schema
            if partition_by is not None:
                schema = _with_last(schema, partition_by)
        return self.spark.read.schema(schema).parquet(path)

    # --- kept schemas -----------------------------------------------------------------------

    def _schema_path(self, table: str) -> str:
        return f"{self.root}/_schemas/{table.replace('/', '.')}.json"

    def kept_schema(self, table: str) -> StructType | None:
        text = read_small(self.spark, self._schema_path(table))
        return None if text is None else StructType.fromJson(json.loads(text))

    def forget_schema(self, table: str) -> None:
        """Read footers again until the next write that starts the table afresh: for files that other programs added."""
        remove_path(self.spark, self._schema_path(table))

    def _keep_schema(self, table: str, schema: StructType, partition_by: str | None) -> None:
        if partition_by is not None:
            schema = _with_last(schema, partition_by)
        write_small(self.spark, self._schema_path(table), schema.json())

    def _widen_schema(self, table: str, schema: StructType, partition_by: str | None) -> None:
        """Add the new columns before rows that have them show: until then they are null.

        A table without a kept schema stays without, as older files may hold more.
        """
        known = self.kept_schema(table)
        if known is None:
            return
        new = [field for field in schema.fields if field.name not in known.names]
        if new:
            self._keep_schema(table, StructType([*known.fields, *new]), partition_by)

    def batches(self, table: str, column: str) -> list[str | None]:
        """Values of the partition column, sorted, from the directory names."""
        found = partition_dirs(self.spark, self.path(table), column)
        return sorted(found, key=lambda value: (value is not None, value or ""))

    # --- staging and publishing -------------------------------------------------------------

    def stage(self, table: str, frame: DataFrame, partition_by: str | None = None) -> Staged:
        if partition_by is not None and frame.schema[partition_by].dataType != StringType():
            raise TypeError(f"{table}: partition column {partition_by} must be text")
        path = f"{self.root}/_staging/{table.replace('/', '.')}-{uuid.uuid4().hex}"
        counted, seen = _counted(frame)
        writer = counted.write
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        try:
            writer.parquet(path)
        except BaseException:
            remove_path(self.spark, path)
            raise
        return Staged(path, self.spark.read.schema(frame.schema).parquet(path), seen.get.get("rows", 0))

    def publish(
        self,
        table: str,
        staged: Staged,
        partition_by: str | None = None,
        replaced: Iterable[str | None] = (),
    ) -> None:
        """Swap staged partitions in; a ``replaced`` batch with no staged rows is emptied.

        Old rows are moved aside before the new ones take their place and deleted only at the end.
        """
        target, aside = self.path(table), f"{staged.path}-replaced"
        live: dict[str | None, str] = {}
        new: dict[str | None, str] = {}
        if partition_by is not None:
            live = partition_dirs(self.spark, target, partition_by)
            new = partition_dirs(self.spark, staged.path, partition_by)

        schema = staged.rows.schema
        if live:
            self._widen_schema(table, schema, partition_by)
        else:
            # Without a kept schema footers are read, whatever happens in between.
            self.forget_schema(table)
        moves: list[tuple[str, str]] = []
        try:
            if not live:
                self._swap(staged.path, target, aside, moves)
            else:
                for name in new.values():
                    places = (f"{staged.path}/{name}", f"{target}/{name}", f"{aside}/{name}")
                    self._swap(*places, moves)
                for value in (set(replaced) - set(new)) & set(live):
                    self._move(f"{target}/{live[value]}", f"{aside}/{live[value]}", moves)
        except BaseException:
            # All partitions or none: undo what was moved, the last move first.
            for source, moved in reversed(moves):
                move_path(self.spark, moved, source)
            raise
        if not live:
            self._keep_schema(table, schema, partition_by)
        self.discard(staged)
        remove_path(self.spark, aside)
        self.spark.catalog.refreshByPath(target)

    def _move(self, source: str, target: str, moves: list[tuple[str, str]]) -> None:
        move_path(self.spark, source, target)
        moves.append((source, target))

    def _swap(self, new: str, target: str, aside: str, moves: list[tuple[str, str]]) -> None:
        """Put ``new`` at ``target``; what was there goes ``aside``."""
        if path_exists(self.spark, target):
            self._move(target, aside, moves)
        self._move(new, target, moves)

    def publish_recorded(
        self, table: str, staged: Staged, partition_by: str, batches: Iterable[str | None]
    ) -> None:
        """``publish`` as one replacement of the given batches in the table's history."""
        self._require_same_types(table, staged.rows, partition_by)
        self.publish(table, staged, partition_by, batches)
        self._record(table, "REPLACE", inserted=staged.count)

    def discard(self, staged: Staged) -> None:
        """Drop a staged write; harmless once it is published."""
        remove_path(self.spark, staged.path)

    # --- writes -----------------------------------------------------------------------------

    def append(self, table: str, frame: DataFrame, partition_by: str | None = None) -> None:
        """Add rows; new columns widen the table, but a column may not change type."""
        self._require_same_types(table, frame, partition_by)
        if self._holds_files(table, partition_by):
            self._widen_schema(table, frame.schema, partition_by)
        else:
            self._keep_schema(table, frame.schema, partition_by)
        counted, seen = _counted(frame)
        writer = counted.write.mode("append")
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(table))
        self.spark.catalog.refreshByPath(self.path(table))
        self._record(table, "APPEND", inserted=seen.get.get("rows", 0))

    def _require_same_types(self, table: str, frame: DataFrame, partition_by: str | None) -> None:
        if not self._holds_files(table, partition_by):
            return
        known = {f.name: f.dataType for f in self.read(table, partition_by=partition_by).schema}
        for field in frame.schema:
            if known.get(field.name, field.dataType) != field.dataType:
                raise TypeError(
                    f"{table}.{field.name} is {known[field.name].simpleString()}, "
                    f"not {field.dataType.simpleString()}"
                )

    def append_new(
        self, table: str, frame: DataFrame, partition_by: str, rebalance: bool = True
    ) -> None:
        """Add only batches the table does not have; each becomes visible whole or not at all.

        Rows are rebalanced by batch, so that many tasks do not each write a file of every batch;
        a frame that comes one scan per batch needs no such shuffle.
        """
        present = self.batches(table, partition_by)
        self._require_same_types(table, frame, partition_by)
        if present:
            frame = frame.where(~F.coalesce(_one_of(partition_by, present), F.lit(False)))
        if rebalance:
            frame = frame.hint("rebalance", partition_by)
        staged = self.stage(table, frame, partition_by)
        self.publish(table, staged, partition_by)
        self._record(table, "APPEND", inserted=staged.count)

    def overwrite(self, table: str, frame: DataFrame) -> None:
        """Replace rows and schema of an unpartitioned table."""
        staged = self.stage(table, frame)
        self.publish(table, staged)
        self._record(table, "OVERWRITE", inserted=staged.count)

    def replace_batches(
        self, table: str, frame: DataFrame, partition_by: str, batches: Iterable[str | None]
    ) -> None:
        """Make the named batches hold exactly the frame's rows for them; others stay untouched."""
        batches = list(batches)
        self._require_same_types(table, frame, partition_by)
        chosen = frame.where(_one_of(partition_by, batches))
        staged = self.stage(table, chosen.hint("rebalance", partition_by), partition_by)
        self.publish_recorded(table, staged, partition_by, batches)

    def replace_rows(self, table: str, frame: DataFrame, replaced: Column) -> None:
        """As ``replace_batches`` for an unpartitioned table: the frame for the rows that match."""
        new, seen = _counted(frame)
        if self.exists(table):
            self._require_same_types(table, frame, None)
            kept = self.read(table).where(~F.coalesce(replaced, F.lit(False)))
            new = kept.unionByName(new, allowMissingColumns=True)
        staged = self.stage(table, new)
        self.publish(table, staged)
        self._record(table, "REPLACE", inserted=seen.get.get("rows", 0))

    def fill_nulls(
        self, table: str, column: str, value: str, partition_by: str, dtype: str = "string"
    ) -> bool:
        """Set a column where it is null, adding it if absent; rewrites only batches that need it."""
        current = ensure_column(self.read(table, partition_by=partition_by), column, dtype)
        missing = current.where(F.col(column).isNull())
        affected = _rows_per(missing, partition_by)
        if not affected:
            return False
        filled = F.coalesce(F.col(column), F.lit(value).cast(dtype))
        chosen = current.where(_one_of(partition_by, affected)).withColumn(column, filled)
        self._require_same_types(table, chosen, partition_by)
        # A scan task holds more rows than a task should sort for a partitioned write.
        staged = self.stage(table, chosen.hint("rebalance", partition_by), partition_by)
        self.publish(table, staged, partition_by, affected)
        self._record(table, "UPDATE", updated=sum(affected.values()))
        return True

    def upsert(
        self, table: str, source: DataFrame, keys: list[str], partition_by: str | None = None
    ) -> Row:
        """Update rows with a matching key, insert the rest, delete none; null keys match.

        Source keys must be unique. Only partitions that hold a source row or a matched old row
        are rewritten, so a key may move between partitions. Returns the row counts.
        """
        with Scratch(self.spark, "upsert") as scratch:
            return self._upsert(table, scratch.keep(source, "source"), keys, partition_by, scratch)

    def _upsert(
        self, table: str, source: DataFrame, keys: list[str], partition_by: str | None, scratch: Scratch
    ) -> Row:
        group = F.col(partition_by) if partition_by else F.lit(None).cast("string")
        per_key = source.groupBy(*keys).agg(F.count("*").alias("n"), F.min(group).alias("_batch"))
        per_batch = per_key.groupBy("_batch").agg(F.count("*").alias("rows"), F.max("n").alias("n"))
        arriving = {row["_batch"]: row for row in per_batch.collect()}
        if any(row["n"] > 1 for row in arriving.values()):
            raise ValueError(f"upsert into {table}: source keys {keys} are not unique")

        self._require_same_types(table, source, partition_by)
        updated, merged, touched = 0, source, set(arriving)
        if self._holds_files(table, partition_by):
            target = self.read(table, partition_by=partition_by)
            source_keys = source.select(*keys).alias("s")
            # Only rows between the source's smallest and largest keys can match.
            within = key_bounds(source, keys)
            located = target.where(within).withColumn("_batch", group).select(*keys, "_batch").alias("t")
            hits = located.join(source_keys, _null_safe(keys), "left_semi")
            # A key may stand in several target rows; it is one updated row of the source.
            per_key = hits.groupBy(*keys).agg(F.collect_set(F.struct("_batch")).alias("batches"))
            # Written, it is read once for the partitions and once for the count.
            per_key = scratch.keep(per_key, "matched")
            matched = per_key.select(F.explode("batches._batch").alias("_batch"), F.lit(1))
            touched |= set(_rows_per(matched, "_batch"))
            updated = per_key.count()
            if partition_by:
                target = target.where(_one_of(partition_by, touched))
            kept = target.where(within).alias("t").join(source_keys, _null_safe(keys), "left_anti")
            kept = kept.unionByName(target.where(~within))
            merged = kept.unionByName(source, allowMissingColumns=True)
        if partition_by:
            merged = merged.hint("rebalance", partition_by)
        staged = self.stage(table, merged, partition_by)
        self.publish(table, staged, partition_by, touched)
        inserted = sum(row["rows"] for row in arriving.values()) - updated
        self._record(table, "MERGE", inserted=inserted, updated=updated)
        return Row(rows_inserted=inserted, rows_updated=updated)

    # --- history ----------------------------------------------------------------------------

    def history(self, table: str) -> DataFrame:
        """One row per write of the table."""
        if not self.exists(HISTORY):
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        schema = StructType.fromDDL(HISTORY_SCHEMA)
        log = self.spark.read.schema(schema).parquet(self.path(HISTORY))
        return log.where(F.col("table_name") == table)

    def latest_write(self, table: str) -> DataFrame:
        return self.history(table).orderBy(F.desc("version")).limit(1)

    def _record(
        self, table: str, operation: str, inserted: int | None = None, updated: int | None = None
    ) -> None:
        last = self.history(table).agg(F.max("version").alias("version"))
        entry = last.select(
            F.lit(table).alias("table_name"),
            (F.coalesce("version", F.lit(-1)) + 1).cast("bigint").alias("version"),
            F.lit(operation).alias("operation"),
            F.current_timestamp().alias("written_at"),
            F.lit(inserted).cast("bigint").alias("rows_inserted"),
            F.lit(updated).cast("bigint").alias("rows_updated"),
        )
        entry.write.mode("append").parquet(self.path(HISTORY))


def _rows_per(frame: DataFrame, column: str) -> dict[str | None, int]:
    """Rows per batch on the driver: one entry per partition directory, never per row."""
    counts = frame.groupBy(column).agg(F.count("*").alias("rows"))
    return {row[column]: row["rows"] for row in counts.collect()}
