"""Writers: CSV and Parquet, optionally partitioned, optionally counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidylake.sources.csv import split_rejects


def _counted(df: DataFrame, count: bool):
    if not count:
        return df, None
    obs = Observation()
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
              mode: str = "overwrite", null_value: str | None = None,
              count: bool = False) -> int | None:
    """Write CSV text (one file per task) replacing ``path`` by default.

    Returns the number of rows written when ``count`` (observed during the
    write itself, no second pass).
    """
    df, obs = _counted(df, count)
    writer = df.write.mode(mode).option("header", header).option("sep", sep)
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)
    return obs.get["rows"] if obs is not None else None


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  mode: str = "overwrite", dynamic: bool = False, rebalance: bool = False,
                  count: bool = False, max_records_per_file: int | None = None) -> int | None:
    """Write Parquet, optionally Hive-partitioned by ``partition_by``.

    * ``mode="overwrite"`` replaces the whole target (static overwrite);
      ``dynamic=True`` replaces only the partitions present in ``df`` (re-runs
      of one month leave the others alone).
    * ``rebalance`` adds an AQE ``REBALANCE`` on the partition columns before
      the write: rows of one partition value meet in few tasks (few, large
      files per folder) while AQE splits a hot value over several tasks, so a
      month holding a third of the data does not become one huge task.
    * ``count`` returns the row count observed during the write (no second
      execution of the plan).
    * ``max_records_per_file`` caps the rows per output file (a task that
      holds many rows of one partition value writes several files).
    """
    partition_by = list(partition_by)
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    df, obs = _counted(df, count)
    writer = df.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return obs.get["rows"] if obs is not None else None


def write_with_rejects(df: DataFrame, path: str, rejects_path: str, corrupt: str,
                       file: str | None = None, partition_by: Sequence[str] = (),
                       **options) -> tuple[int, int]:
    """Write the good rows of a scan as Parquet and its malformed rows, with their file and
    text, as a second Parquet table; the numbers of both.

    ``df`` comes from ``read_csv`` or ``read_mixed`` with ``corrupt`` (and ``file``).  Each
    output is one pass over the scan, so the rejects are written without holding rows."""
    good, rejects = split_rejects(df, corrupt, file)
    return (write_parquet(good, path, partition_by, count=True, **options),
            write_parquet(rejects, rejects_path, count=True))
