"""A ledger of which source file feeds which partition of a table.

Partitions of a silver table are named by its rows, not by the files they come from, so a
re-run of some files has to know what else lies in the partitions they feed.  The ledger is
a Parquet table ``(file, <partition columns>, rows, source)``, in folders by ``source`` (the
unit of a re-run, e.g. a year folder), written next to each run of the table.  With it a
re-run reads only the files that feed a partition that it has to rewrite, and drops the
partitions that no file feeds any more.

The partition of a row must follow from its own file alone, and duplicates must lie in one
partition (their keys include or determine it): then a partition is a function of the files
that feed it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidylake import sinks
from tidylake.operators import dedup
from tidylake.operators.projection import ref
from tidylake.session import scratch_path
from tidylake.sources.csv import encode_path, literal_path

SOURCE, FILE, ROWS = "source", "file", "rows"


def feeds(rows: DataFrame, file: str, partition_by: Sequence[str], source) -> DataFrame:
    """``file, <partition columns>, rows, source`` of rows that hold their file's path;
    ``source`` is a Column over ``file``.  One aggregate with few groups."""
    own = rows.groupBy(ref(file).alias(FILE), *[ref(c) for c in partition_by]).agg(
        F.count(F.lit(1)).alias(ROWS))
    return own.withColumn(SOURCE, source)


def _schema(rows: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's entries; an error if there is none."""
    found = spark.read.parquet(path).schema
    # the source is the folder's name as it is, also where it looks like a number
    return spark.read.schema(T.StructType([
        T.StructField(f.name, T.StringType() if f.name == SOURCE else f.dataType) for f in found])).parquet(path)


def _same(columns: Sequence[str]):
    """Null-safe equality with the columns renamed by :func:`_named`; null is a partition, too."""
    return reduce(and_, [ref(c).eqNullSafe(F.col(f"__tl_{c}")) for c in columns])


def _named(partitions: DataFrame, columns: Sequence[str]) -> DataFrame:
    return F.broadcast(partitions.select(*[ref(c).alias(f"__tl_{c}") for c in columns]))


def within(rows: DataFrame, partitions: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows that lie in one of the partitions (a table with one row per folder)."""
    return rows.join(_named(partitions, partition_by), _same(partition_by), "left_semi")


def outside(rows: DataFrame, partitions: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows that lie in none of the partitions."""
    return rows.join(_named(partitions, partition_by), _same(partition_by), "left_anti")


def files_feeding(ledger: DataFrame, partitions: DataFrame, partition_by: Sequence[str]) -> list[str]:
    """Paths of the ledger's files that feed one of the partitions, as a reader takes them.

    They reach the driver as the list of paths that a scan is made of: as many as the
    re-run reads, whatever the ledger holds."""
    chosen = within(ledger, partitions, partition_by).select(FILE).distinct()
    return sorted(literal_path(r[FILE]) for r in chosen.collect())


def _filesystem(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The paths that there are."""
    return [p for p in paths if (lambda fs, at: fs.exists(at))(*_filesystem(spark, p))]


def partition_folder(spark: SparkSession, values: Iterable[tuple[str, object]]) -> str:
    """``a=1/b=2`` as Spark's writers name the folder."""
    spell = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(spell(c, None if v is None else str(v)) for c, v in values)


def drop_partitions(spark: SparkSession, table: str, partitions: DataFrame,
                    partition_by: Sequence[str]) -> int:
    """Remove the folders of the partitions (a dynamic overwrite leaves those alone that it
    has no rows for); their number."""
    gone = partitions.select(*[ref(c).cast("string").alias(c) for c in partition_by]).collect()
    for row in gone:
        fs, at = _filesystem(spark, f"{table.rstrip('/')}/{partition_folder(spark, row.asDict().items())}")
        fs.delete(at, True)
    return len(gone)


def record(spark: SparkSession, path: str, new: DataFrame, sources: Sequence[str] | None = None) -> None:
    """Replace the ledger's entries of ``sources`` (default: of all) by ``new``, which must
    not be read from the ledger itself."""
    sinks.write_parquet(new, path, [SOURCE], dynamic=sources is not None, rebalance=True)
    if sources is not None:
        gone = spark.createDataFrame([(s,) for s in sources], f"{SOURCE} string").join(
            new, SOURCE, "left_anti")
        drop_partitions(spark, path, gone, [SOURCE])


def _bare(path: str) -> str:
    return "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", path.rstrip("/")).strip("/")


def source_of(file: str, folders: Mapping[str, str]):
    """The source whose folder a file lies in, by the file's path."""
    bare = F.regexp_replace(ref(file), "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    found = F.lit(None).cast("string")
    for name, folder in folders.items():
        forms = {_bare(folder), encode_path(_bare(folder))}
        inside = reduce(or_, [bare.startswith(f + "/") for f in sorted(forms)])
        found = F.when(inside, F.lit(name)).otherwise(found)
    return found


class Run(NamedTuple):
    """Rows written, files read for them (all paths of a full run's folders) and
    ``changed``: the partitions rewritten or dropped, one row each."""
    rows: int
    files: list[str]
    changed: DataFrame


def run(spark: SparkSession, table: str, ledger: str, folders: Mapping[str, str],
        read: Callable[[Sequence[str]], DataFrame], partition_by: Sequence[str],
        dedup_keys: Sequence[str], dedup_order: Sequence[str] = (),
        only: Sequence[str] | None = None, file: str = "__tidylake_file") -> Run:
    """Write a silver table from raw files, or re-run the sources ``only``.

    ``folders`` names the sources' folders; ``read`` gives the cleaned rows, duplicates
    included, of the files at some paths with their path as column ``file``.  Duplicates are
    rows that agree in ``dedup_keys`` and lie in one partition.

    A re-run (1) reads the sources ``only`` for their partitions, (2) takes the partitions
    that they feed now or fed before, (3) reads the files that feed these, and no others,
    and overwrites just these partitions, (4) drops those that nothing feeds any more and
    (5) replaces the ledger's entries of ``only``.  The table is then the one that a full
    run over all folders gives.  Each step can be repeated: the ledger changes last, so a
    run that broke off is made good by the next one.
    """
    keys = [*dedup_keys, *(c for c in partition_by if c not in dedup_keys)]

    def entries_of(names: Sequence[str]) -> DataFrame:
        """What the sources feed now, stored."""
        paths = existing(spark, [folders[n] for n in names])
        if not paths:
            return entries(spark, ledger).where(F.lit(False))
        found = feeds(read(paths), file, partition_by, source_of(FILE, folders))
        path = scratch_path(spark, "ledger")
        found.write.parquet(path)
        return spark.read.schema(_schema(found)).parquet(path)

    def write(paths: Sequence[str], keep: DataFrame | None) -> int:
        rows = read(paths)
        if keep is not None:
            rows = within(rows, keep, partition_by)
        silver = dedup.by_key(rows.drop(file), keys, dedup_order)
        return sinks.write_parquet(silver, table, partition_by, rebalance=True, count=True,
                                   dynamic=keep is not None)

    if only is None:
        new = entries_of(list(folders))
        paths = existing(spark, folders.values())
        n = write(paths, None)
        record(spark, ledger, new)
        return Run(n, paths, new.select(*map(ref, partition_by)).distinct())
    new = entries_of(only)
    old = entries(spark, ledger).select(*map(ref, new.columns))
    others = old.where(~F.col(SOURCE).isin(list(only)))
    changed = new.unionByName(old.where(F.col(SOURCE).isin(list(only)))).select(
        *map(ref, partition_by)).distinct()
    path = scratch_path(spark, "changed-partitions")
    changed.write.parquet(path)
    changed = spark.read.schema(_schema(changed)).parquet(path)
    feeding = others.unionByName(new)
    files = files_feeding(feeding, changed, partition_by)
    n = write(files, changed) if files else 0
    drop_partitions(spark, table, outside(changed, feeding, partition_by), partition_by)
    record(spark, ledger, new, only)
    return Run(n, files, changed)


def log_changes(run: str, changed: DataFrame, path: str) -> None:
    """Append a run's changed partitions, under its name, to a table of changes."""
    changed.withColumn("run", F.lit(run)).write.mode("append").parquet(path)
