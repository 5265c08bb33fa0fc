"""CSV scans.

Files are split by Spark into ``spark.sql.files.maxPartitionBytes`` chunks and
parsed in the executors; column pruning reaches the parser, so only selected
columns are converted.  Malformed cells follow Spark's default PERMISSIVE
mode: a bad number or timestamp becomes null, short rows are padded with
nulls, extra fields are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidylake.operators.projection import ref, select_renamed
from tidylake.operators.union import union_by_name
from tidylake.schema import make_schema


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema=None, sep: str = ",",
             header: bool = True, null_value: str | None = None,
             strict_header: bool = False, glob: str | None = None,
             recursive: bool = False, exclude: Iterable[str] = (),
             include: str | None = None, corrupt: str | None = None, file: str | None = None,
             **options) -> DataFrame:
    """Read CSV files (a path, a directory, a glob or a list of those).

    * ``schema`` - explicit schema (``StructType``, field tuples or DDL) in the
      files' column order; ``None`` takes names from the header and reads every
      column as a string (no inference pass).
    * ``strict_header`` - verify each file's header against the schema names
      (``enforceSchema=false``), so a file in another column order fails the
      job instead of being read positionally into the wrong columns.
    * ``null_value`` - text read as null (unquoted empty fields are null anyway).
    * ``glob`` / ``recursive`` - file-name filter and recursive listing.
    * ``exclude`` - file names or full paths to leave out.
    * ``include`` - regular expression a file's path must match (e.g. the
      wanted year folders).  Like ``exclude`` it is a filter on the hidden
      ``_metadata`` column, which Spark applies per file before reading.
    * ``corrupt`` - adds a column with the text of each malformed row (a bad number or
      time, missing or extra cells), null for good ones; every cell is then parsed,
      whatever columns are selected.  See :func:`split_rejects`.
    * ``file`` - adds a column with the path of the file that the row is from.
    """
    if corrupt is not None:
        if schema is None:
            raise ValueError("rows can be malformed only under a schema")
        fields = make_schema(schema).fields
        schema = T.StructType([*fields, T.StructField(corrupt, T.StringType())])
        options = {"columnNameOfCorruptRecord": corrupt, **options}
    reader = spark.read.option("header", header).option("sep", sep)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is not None:
        reader = reader.schema(make_schema(schema)).option("enforceSchema", not strict_header)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    if include:
        df = df.where(F.col("_metadata.file_path").rlike(include))
    df = exclude_files(df, exclude)
    if corrupt is not None:
        # the reader parses only columns that a query refers to: this refers to all, and is
        # always the column itself
        touched = F.xxhash64(*[ref(f.name) for f in fields])
        df = df.withColumn(corrupt, F.coalesce(ref(corrupt), F.when(touched == 0, ref(corrupt))))
    return df.withColumn(file, F.col("_metadata.file_path")) if file else df


def split_rejects(df: DataFrame, corrupt: str, file: str | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """The good rows, without the columns ``corrupt`` and ``file``, and the rejected ones:
    ``file`` (if given), ``text`` (the row as it is in the file) and ``parsed`` (what could
    be read of it)."""
    own = [c for c in df.columns if c not in (corrupt, file)]
    good = df.where(ref(corrupt).isNull()).select(*[ref(c) for c in own])
    rejects = df.where(ref(corrupt).isNotNull()).select(
        *([ref(file).alias("file")] if file else []), ref(corrupt).alias("text"),
        F.struct(*[ref(c) for c in own]).alias("parsed"))
    return good, rejects


def exclude_files(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    """Drop the rows read from some files.

    Entries: a bare file name (no ``/``) matches the file name; a full path
    with a scheme (``file:/...``, ``s3a://...``) matches that file exactly; any
    other entry with ``/`` is a path or folder fragment contained in the
    file's path.  Names and full paths are hash-set lookups (``isin``), so
    thousands of excluded files stay cheap; the filter is on the scan's hidden
    ``_metadata`` column, which Spark applies per file before reading.
    """
    exclude = list(exclude)
    if not exclude:
        return df
    names = [e for e in exclude if "/" not in e]
    full = [e for e in exclude if "/" in e and _has_scheme(e) and not e.endswith("/")]
    fragments = [e for e in exclude if "/" in e and e not in full]
    drop = F.lit(False)
    if names:
        forms = sorted({f for n in names for f in (n, encode_path(n))})
        drop = drop | F.col("_metadata.file_name").isin(forms)
    if full:
        forms = sorted({f for e in full for f in (e, _as_uri(e))})
        drop = drop | F.col("_metadata.file_path").isin(forms)
    for p in fragments:
        for form in _uri_forms(p):
            drop = drop | F.col("_metadata.file_path").contains(form)
    return df.where(~drop)


# ASCII characters a URI path keeps as they are (RFC 3986 unreserved + sub-delims + ":@/")
_URI_SAFE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
                "-._~!$&'()*+,;=:@/")


def encode_path(text: str) -> str:
    """A path as ``_metadata`` spells it: ASCII specials percent-encoded."""
    return "".join(c if c in _URI_SAFE or ord(c) > 127 else f"%{ord(c):02X}" for c in text)


def _has_scheme(path: str) -> bool:
    head = path.split("/", 1)[0]
    return head.endswith(":") and len(head) > 2


def _as_uri(path: str) -> str:
    """``file:/a b/c.csv`` -> ``file:/a%20b/c.csv``: how ``_metadata`` spells a
    path (ASCII specials percent-encoded, non-ASCII and the slashes kept)."""
    scheme, rest = path.split(":", 1)
    return f"{scheme}:{encode_path(rest)}"


def _uri_forms(fragment: str) -> set[str]:
    """A path fragment without scheme, raw and URI-encoded."""
    bare = fragment.split(":", 1)[1] if _has_scheme(fragment) else fragment
    bare = "/" + bare.lstrip("/") if bare.startswith("/") else bare
    return {bare, encode_path(bare)}


@dataclass
class CsvLayout:
    """A group of CSV files sharing one column layout.

    ``schema`` lists the columns in the files' order; ``rename`` selects and
    renames them to the common (silver) names.  ``exclude`` removes files that
    belong to another layout.
    """

    paths: str | Sequence[str]
    schema: object
    rename: Mapping[str, str] | None = None
    exclude: Sequence[str] = field(default_factory=tuple)
    glob: str | None = None
    recursive: bool = False
    include: str | None = None


def read_layouts(spark: SparkSession, layouts: Sequence[CsvLayout], sep: str = ",",
                 null_value: str | None = None, strict_header: bool = True,
                 **options) -> DataFrame:
    """Read every layout with its own schema and union the results by name.

    Each layout is an independent scan (its own splits and tasks); the union
    adds no shuffle.  With ``strict_header`` every file's header is checked
    against its layout in the executors, so a misfiled layout is an error
    instead of silently misread rows.
    """
    frames = []
    for lay in layouts:
        df = read_csv(spark, lay.paths, schema=lay.schema, sep=sep, null_value=null_value,
                      strict_header=strict_header, glob=lay.glob, recursive=lay.recursive,
                      exclude=lay.exclude, include=lay.include, **options)
        frames.append(select_renamed(df, lay.rename) if lay.rename else df)
    return union_by_name(frames)


def literal_path(file: str) -> str:
    """A path that reads exactly the file that ``_metadata.file_path`` spells so: decoded,
    and with the characters of path patterns escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(file))


def string_schema(names: Sequence[str]) -> T.StructType:
    """All-string schema for the given column names."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])
