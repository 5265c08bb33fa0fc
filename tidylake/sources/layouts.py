"""Column layouts discovered from the files' own header lines.

Instead of a hand-kept list of files that use another column order, every
file's first line is read inside Spark tasks (one small read per file, via
``pyarrow.fs``, or Spark's own ``text`` source where Python cannot reach the
filesystem; the file listing itself is Spark's ``binaryFile`` source with the
content column pruned).  Files are grouped by header; each distinct
header is mapped onto the canonical schema by column name, giving one
``CsvLayout`` per header.  The most common header becomes the layout that
reads the whole folder minus the other layouts' files, so only the minority
files are ever named individually.
"""

from __future__ import annotations

import sys

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidylake.schema import make_schema, reorder
from tidylake.sources.csv import CsvLayout

# The functions below run inside Python workers.  Ship them with the task
# (by value) so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _open(path: str, options: Mapping[str, object]):
    import pyarrow.fs as pafs
    if path.startswith("file:"):
        local = "/" + path[len("file:"):].lstrip("/")
        return pafs.LocalFileSystem().open_input_stream(local)
    scheme, _, rest = path.partition("://")
    if scheme in ("s3", "s3a", "s3n") and options:
        return pafs.S3FileSystem(**options).open_input_stream(rest)
    uri = "s3://" + rest if scheme == "s3a" else path
    fs, inner = pafs.FileSystem.from_uri(uri)
    return fs.open_input_stream(inner)


def _first_line(path: str, encoding: str, options: Mapping[str, object] = {}) -> str:
    """The file's first line, however long; no more than a block beyond it is
    read."""
    chunks = []
    with _open(path, options) as fh:
        while block := fh.read(65536):
            chunks.append(block)
            if b"\n" in block:
                break
    raw = b"".join(chunks).split(b"\n", 1)[0].rstrip(b"\r")
    return raw.decode(encoding, errors="replace").lstrip("\ufeff")


def file_headers(spark: SparkSession, root: str | Sequence[str], glob: str = "*.csv",
                 recursive: bool = True, include: str | None = None, encoding: str = "utf-8",
                 filesystem: Mapping[str, object] | None = None, uri: bool = False) -> DataFrame:
    """``(path, header)`` for every matching file; with ``uri`` also ``file``, the
    path as ``_metadata.file_path`` spells it.

    Spark lists the files; tasks read the first line of each through
    ``pyarrow.fs`` (local, HDFS, S3, ...), so what is read does not grow with a
    file's length.  ``filesystem`` are the arguments of ``pyarrow.fs.S3FileSystem``
    (keys, endpoint, region) where the workers' environment does not hold them.
    A file that the workers cannot reach is an error.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    names = ["path", *(["file"] if uri else [])]
    files = reader.load(root if isinstance(root, str) else list(root)).select(
        "path", F.col("_metadata.file_path").alias("file")).select(*names)
    if include:
        files = files.where(F.col("path").rlike(include))
    options = dict(filesystem or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(header=[_first_line(p, encoding, options) for p in pdf["path"]])

    return files.mapInPandas(run, T.StructType([T.StructField(n, T.StringType())
                                                for n in [*names, "header"]]))


def _names(header: str, sep: str) -> list[str]:
    return [c.strip().strip('"').strip() for c in header.split(sep)]


def discover_layouts(spark: SparkSession, root: str, schema, rename: Mapping[str, str] | None,
                     sep: str = ",", glob: str = "*.csv", include: str | None = None,
                     encoding: str = "utf-8",
                     filesystem: Mapping[str, object] | None = None) -> list[CsvLayout]:
    """One ``CsvLayout`` per distinct header found under ``root``.

    Every header must name exactly the columns of ``schema`` (any order);
    otherwise ``ValueError`` names the header and a few of its files.  Only
    the distinct headers with their counts, and the paths of the files that
    are *not* in the most common layout, reach the driver.
    """
    schema = make_schema(schema)
    wanted = sorted(schema.fieldNames())
    headers = file_headers(spark, root, glob, True, include, encoding, filesystem).cache()
    try:
        counts = headers.groupBy("header").count().collect()
        if not counts:
            return [CsvLayout(root, schema, rename, glob=glob, recursive=True, include=include)]
        for row in counts:
            if sorted(_names(row["header"], sep)) != wanted:
                sample = [r.path for r in headers.where(F.col("header") == row["header"])
                          .select("path").limit(3).collect()]
                raise ValueError(f"header {row['header']!r} does not name the schema's "
                                 f"columns; files: {sample}")
        major = max(counts, key=lambda r: (r["count"], r["header"]))["header"]
        minority = headers.where(F.col("header") != major).select("header", "path").collect()
    finally:
        headers.unpersist()
    by_header: dict[str, list[str]] = {}
    for r in minority:
        by_header.setdefault(r.header, []).append(r.path)
    others = [p for ps in by_header.values() for p in ps]
    layouts = [CsvLayout(root, reorder(schema, _names(major, sep)), rename, glob=glob,
                         recursive=True, include=include, exclude=others)]
    for header, paths in sorted(by_header.items()):
        layouts.append(CsvLayout(sorted(paths), reorder(schema, _names(header, sep)), rename))
    return layouts
