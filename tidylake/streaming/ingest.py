"""Raw CSV files -> silver, incrementally.

New raw files (e.g. a monthly drop) are picked up by Spark's streaming file
source; the stream's checkpoint records which files were processed, so each
file is read once.  Row-wise rules (fills, labels) run in the stream; the
de-duplication must see earlier data, so each micro-batch is merged in
``foreachBatch``:

1. the batch is reduced to one row per key (``dedup.by_key``: deterministic
   survivor, partial aggregation before the shuffle);
2. keys already present in silver are removed: silver's key columns are
   semi-joined against the batch's keys (broadcast when measured small, so
   silver is scanned but not shuffled), then a null-safe anti join drops them
   from the batch (the first ingested row of a key stays; nulls are one key,
   as in the batch flow);
3. the remaining rows are appended, partitioned.

The write is append-only, so no partition is rewritten and no row moves
between partitions.  Re-running a micro-batch after a failure is idempotent:
a committed append makes all its keys "present", an uncommitted one left no
files (Spark's commit protocol).  The survivor per key is the batch flow's
(smallest row) within a drop; across drops the earlier drop's row stays.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidylake import sinks
from tidylake.operators import dedup, joins
from tidylake.operators.projection import ref, select_renamed
from tidylake.operators.union import union_by_name
from tidylake.schema import make_schema
from tidylake.session import checkpoint_root
from tidylake.sources.csv import CsvLayout, exclude_files


def read_layouts_stream(spark: SparkSession, layouts: Sequence[CsvLayout], sep: str = ",",
                        null_value: str | None = None, strict_header: bool = True,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming counterpart of ``sources.read_layouts`` (one file stream per
    layout folder, renamed, unioned by name)."""
    frames = []
    for lay in layouts:
        paths = [lay.paths] if isinstance(lay.paths, str) else list(lay.paths)
        for path in paths:
            reader = (spark.readStream.schema(make_schema(lay.schema))
                      .option("header", True).option("sep", sep)
                      .option("enforceSchema", not strict_header))
            if null_value is not None:
                reader = reader.option("nullValue", null_value)
            if lay.glob:
                reader = reader.option("pathGlobFilter", lay.glob)
            if lay.recursive:
                reader = reader.option("recursiveFileLookup", True)
            if max_files_per_trigger:
                reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
            df = reader.csv(path)
            if lay.include:
                df = df.where(F.col("_metadata.file_path").rlike(lay.include))
            df = exclude_files(df, lay.exclude)
            frames.append(select_renamed(df, lay.rename) if lay.rename else df)
    return union_by_name(frames)


def _null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]):
    cond = None
    for c in cols:
        term = left[c].eqNullSafe(right[c])
        cond = term if cond is None else cond & term
    return cond


def merge_batch(batch: DataFrame, out_path: str, partition_by: Sequence[str],
                dedup_keys: Sequence[str], dedup_order: Sequence[str] = ()) -> int:
    """Append one micro-batch's new keys to the partitioned silver table.

    The batch's keys are broadcast when measured small (a micro-batch is
    bounded by the files per trigger), so silver's key columns are only
    scanned, never shuffled, to find the keys already present.  That scan covers
    the keys of the whole table in every micro-batch, because a key may lie in any
    partition: the ingest suits tables whose key columns are cheap to read.
    """
    spark = batch.sparkSession
    fresh = dedup.by_key(batch, dedup_keys, dedup_order).persist()
    try:
        try:
            existing = spark.read.schema(fresh.schema).parquet(out_path)
            existing.limit(0).collect()  # fails here when the table does not exist yet
        except AnalysisException:
            existing = None
        new_rows = fresh
        if existing is not None:
            keys = fresh.select(*[ref(k) for k in dedup_keys])
            probe = F.broadcast(keys) if joins.checked_broadcast(keys) else keys
            seen = existing.select(*[ref(k) for k in dedup_keys])
            present = seen.join(probe, _null_safe(seen, probe, dedup_keys), "left_semi")
            new_rows = fresh.join(present, _null_safe(fresh, present, dedup_keys), "left_anti")
        return sinks.write_parquet(new_rows, out_path, partition_by, mode="append",
                                   rebalance=True, count=True)
    finally:
        fresh.unpersist()


def ingest_to_silver(spark: SparkSession, layouts: Sequence[CsvLayout],
                     refine: Callable[[DataFrame], DataFrame], out_path: str,
                     partition_by: Sequence[str], dedup_keys: Sequence[str],
                     dedup_order: Sequence[str] = (), sep: str = ",",
                     null_value: str | None = None, checkpoint: str | None = None,
                     available_now: bool = True,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental ingest; returns the running ``StreamingQuery``.

    ``refine`` holds the row-wise silver rules (``refine_fact`` without
    dedup).  ``checkpoint`` defaults to a stable folder below the session's
    shared checkpoint directory (``spark.checkpoint.dir``) derived from
    ``out_path``, so a restart resumes where the last run stopped.  ``available_now`` processes every
    file present and stops (scheduled runs); otherwise the query keeps
    running.
    """
    if checkpoint is None:
        name = re.sub(r"[^A-Za-z0-9]+", "_", out_path).strip("_")
        checkpoint = f"{checkpoint_root(spark)}/tidylake-streams/{name}"
    stream = refine(read_layouts_stream(spark, layouts, sep, null_value,
                                        max_files_per_trigger=max_files_per_trigger))

    def each(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, out_path, partition_by, dedup_keys, dedup_order)

    writer = (stream.writeStream.foreachBatch(each)
              .option("checkpointLocation", f"{checkpoint}/state"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


__all__ = ["ingest_to_silver", "merge_batch", "read_layouts_stream"]
