"""Parquet scans (flat or Hive-partitioned)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidylake.schema import make_schema


def read_parquet(spark: SparkSession, paths: str | Sequence[str], schema=None,
                 base_path: str | None = None, merge_schema: bool = False) -> DataFrame:
    """Read Parquet; partition folders ``k=v`` become columns.

    Pass ``schema`` (including the partition columns) to fix partition column
    types: otherwise Spark infers them from the folder names, so ``ano=2020``
    is read back as an integer while ``ano=unknown`` turns the column into a
    string.  With ``schema`` the columns come in its order.  Filters on partition columns prune folders (``PartitionFilters``)
    and filters on data columns are pushed to the reader (``PushedFilters``).
    """
    reader = spark.read
    if schema is not None:
        schema = make_schema(schema)
        reader = reader.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    df = reader.parquet(*([paths] if isinstance(paths, str) else list(paths)))
    if schema is not None:  # partition columns come last from the reader
        df = df.select(*[f"`{n}`" for n in schema.fieldNames()])
    return df


def row_count(spark: SparkSession, paths: str | Sequence[str], name: str = "n") -> DataFrame:
    """The number of rows as a one-row table, from the files' footers alone.

    The count is pushed into the version 2 Parquet source, which adds up the row counts of
    the footers: no column is read or decoded.  The two settings that this needs are made
    on a session of its own, so that the caller's scans stay as they are."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    v1 = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    files = own.read.parquet(*([paths] if isinstance(paths, str) else list(paths)))
    return files.agg(F.count(F.lit(1)).alias(name))
