"""Incremental ingest whose duplicates are found in a keyed state store.

``streaming.ingest_to_silver`` looks a batch's keys up in the whole silver table.  Here the
keys seen so far live in the stream's own state (RocksDB, kept in the checkpoint folder
and split over the tasks by key), so a micro-batch reads its new files and the state of its
own keys only: its cost does not depend on how large silver is.

A micro-batch takes three steps, all inside one streaming plan:

1. rows are dealt by key and each task keeps the smallest row of a key in the batch (by the
   given order, then by the remaining columns, nulls first), so the survivor does not
   depend on arrival;
2. ``dropDuplicates`` on the keys, against the state, lets through the first of each key
   (nulls are equal to each other);
3. the file sink appends the rows, partitioned.

The sink's log (``_spark_metadata``) and the checkpoint make the output exactly-once over
failures and restarts: files of an attempt that did not commit are not in the log, and
readers of the path go by the log.  So the folder belongs to the stream; a table that the
batch flows rewrite must have a folder of its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidylake.operators.projection import ref
from tidylake.session import checkpoint_root
from tidylake.sources.csv import CsvLayout
from tidylake.streaming.ingest import read_layouts_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"


def _smallest(keys: Sequence[str], order: Sequence[str]) -> Callable:
    """Arrow batches of one partition -> its smallest row of each key.  Batches are reduced
    as they come, so a task holds one row per key and one batch."""
    def reduced(table: pa.Table) -> pa.Table:
        rest = [c for c in table.column_names if c not in keys and c not in order]
        by = [*keys, *order, *rest]
        place = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in by], null_placement="at_start")
        table = table.take(place)
        if len(table) < 2:
            return table
        new = None
        for c in keys:
            a, b = (x.combine_chunks() for x in (table[c].slice(1), table[c].slice(0, len(table) - 1)))
            differs = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
            new = differs if new is None else pc.or_(new, differs)
        return table.filter(pa.concat_arrays([pa.array([True]), new]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(map(len, waiting)) >= max(100_000, len(held) if held is not None else 0):
                parts = [pa.Table.from_batches(waiting), *([held] if held is not None else [])]
                held, waiting = reduced(pa.concat_tables(parts)), []
        if waiting:
            parts = [pa.Table.from_batches(waiting), *([held] if held is not None else [])]
            held = reduced(pa.concat_tables(parts))
        if held is not None:
            yield from held.to_batches()
    return run


def first_of_key(stream: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key over the whole life of a stream: of the first micro-batch that holds
    the key, its smallest row."""
    dealt = stream.repartition(*[ref(k) for k in keys])
    return dealt.mapInArrow(_smallest(list(keys), list(order)), stream.schema).dropDuplicates(list(keys))


def ingest_keyed(spark: SparkSession, layouts: Sequence[CsvLayout],
                 refine: Callable[[DataFrame], DataFrame], out_path: str,
                 partition_by: Sequence[str], dedup_keys: Sequence[str],
                 dedup_order: Sequence[str] = (), sep: str = ",", null_value: str | None = None,
                 checkpoint: str | None = None, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest; arguments as for ``ingest_to_silver``.

    The state store's provider is a session setting that a query takes when it starts; it
    is set for the start and put back.  The state is split into as many parts as
    ``spark.sql.shuffle.partitions`` says at the first start; the number then stays."""
    if checkpoint is None:
        name = re.sub(r"[^A-Za-z0-9]+", "_", out_path).strip("_")
        checkpoint = f"{checkpoint_root(spark)}/tidylake-streams/{name}-keyed"
    rows = refine(read_layouts_stream(spark, layouts, sep, null_value,
                                      max_files_per_trigger=max_files_per_trigger))
    writer = (first_of_key(rows, dedup_keys, dedup_order).writeStream.format("parquet")
              .option("path", out_path).option("checkpointLocation", f"{checkpoint}/keyed")
              .partitionBy(*partition_by).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
