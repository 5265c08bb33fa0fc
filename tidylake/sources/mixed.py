"""One CSV scan for files of many column layouts.

``sources.read_layouts`` plans one scan per layout and names the files of the rarer ones.
Where files are spread over many layouts, :func:`read_mixed` reads all of them in one scan
instead: lines come with their file's name, a *file -> layout* table (one row per file, from
the files' header lines) is joined onto them, and each line is split once and its cells are
put in the schema's order by the positions of its file's layout.  The plan does not grow
with layouts or files, and no path reaches the driver: the table is written by the tasks
that read the headers, and a broadcast holds a 96-bit fingerprint of the path instead of
the path itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidylake.operators import joins
from tidylake.operators.projection import ref
from tidylake.schema import make_schema
from tidylake.session import scratch_path
from tidylake.sources.csv import read_csv
from tidylake.sources.layouts import file_headers

# a separator that no text file holds: the CSV reader then hands over whole lines, without
# the header line of each file
_NO_SEPARATOR = "\x01\x02\x01"
_CELLS, _BAD, _LINE, _AT = "__tl_cells", "__tl_bad", "__tl_line", "__tl_at"


def file_layouts(spark: SparkSession, root: str | Sequence[str], schema, sep: str = ",",
                 glob: str = "*.csv", recursive: bool = True, include: str | None = None,
                 encoding: str = "utf-8", filesystem: Mapping[str, object] | None = None,
                 path: str | None = None) -> DataFrame:
    """The *file -> layout* table: ``file`` (as ``_metadata.file_path`` spells it) and
    ``positions`` (for each column of ``schema`` its place in the file, from 0), written
    below ``path`` (default: a fresh scratch folder) and read back.

    A header that does not name exactly the schema's columns, in any order, fails the job
    with the header and its file.
    """
    names = make_schema(schema).fieldNames()
    headers = file_headers(spark, root, glob, recursive, include, encoding, filesystem, uri=True)
    cells = F.split("header", "\\Q" + sep + "\\E", -1)
    found = F.transform(cells, lambda c: F.trim(F.regexp_replace(F.trim(c), '^"+|"+$', "")))
    wrong = F.raise_error(F.concat(F.lit("header "), F.col("header"), F.lit(
        " does not name the schema's columns; file: "), F.col("file")))
    positions = F.array(*[(F.array_position("names", n) - 1).cast("int") for n in names])
    fits = F.array_sort("names") == F.array(*[F.lit(n) for n in sorted(names)])
    table = headers.select("file", "header", found.alias("names")).select(
        "file", F.when(fits, positions).otherwise(wrong.cast("array<int>")).alias("positions"))
    path = path or scratch_path(spark, "file-layouts")
    table.write.mode("overwrite").parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def _fingerprint(file: Column) -> list[Column]:
    return [F.xxhash64(file).alias("f1"), F.hash(file).alias("f2")]


def _typed(cells: list[Column], fields: list[T.StructField], options: dict[str, str]) -> Column:
    """The cells of columns that are no strings, parsed as the CSV reader parses them, and
    in ``__tl_bad`` a text if one of them is malformed.  Cells that a quoted cell could hide
    something in can be no number or time, so they are malformed without being quoted."""
    odd = "[\"\\\\\\r\\n]"
    safe = [F.when(c.rlike(odd) | c.contains(options["sep"]), F.lit("?")).otherwise(c).alias(f.name)
            for c, f in zip(cells, fields)]
    text = F.to_csv(F.struct(*safe), {"sep": options["sep"], "ignoreLeadingWhiteSpace": "false",
                                      "ignoreTrailingWhiteSpace": "false"})
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in fields],
                           T.StructField(_BAD, T.StringType())])
    return F.from_csv(text, schema.toDDL(), {k: v for k, v in options.items() if k != "nullValue"}
                      | {"columnNameOfCorruptRecord": _BAD})


def read_mixed(spark: SparkSession, paths: str | Sequence[str], schema,
               rename: Mapping[str, str] | None = None, sep: str = ",",
               null_value: str | None = None, glob: str | None = "*.csv", recursive: bool = True,
               include: str | None = None, encoding: str = "utf-8",
               filesystem: Mapping[str, object] | None = None, layouts: DataFrame | None = None,
               file: str | None = None, corrupt: str | None = None, spread: int = 64,
               **options: str) -> DataFrame:
    """The rows of all CSV files under ``paths``, whatever the order of their columns.

    ``schema`` names and types the columns; every file's header must hold exactly these, in
    any order.  ``rename`` selects and renames them as in ``CsvLayout``.  Cells are parsed as
    ``sources.read_csv`` parses them: a bad number or time is null, short rows are padded,
    extra cells dropped.  ``corrupt`` adds a column with the line of such rows (null for good
    ones), ``file`` one with the file they come from.  ``layouts`` is the table of
    :func:`file_layouts`, made here if not given.  Further ``options`` (``dateFormat``,
    ``timestampFormat``, ``quote``, ...) go to the parser.

    The table of layouts is broadcast after its size was checked; beyond the bound both
    sides are shuffled by file, each file's lines over ``spread`` partitions.
    """
    schema = make_schema(schema)
    names = schema.fieldNames()
    if layouts is None:
        layouts = file_layouts(spark, paths, schema, sep, glob or "*", recursive, include, encoding,
                               filesystem)
    lines = read_csv(spark, paths, schema=f"{_LINE} string", sep=_NO_SEPARATOR, glob=glob,
                     recursive=recursive, include=include, quote="", encoding=encoding)
    at = F.col("_metadata.file_path")
    lines = lines.select(_LINE, *[c.alias(f"__tl_{i}") for i, c in enumerate(_fingerprint(at))],
                         *([at.alias(file)] if file else []))
    # two files with one fingerprint do no harm unless their layouts differ
    low, high = F.min("positions"), F.max("positions")
    known = layouts.groupBy(*_fingerprint(F.col("file"))).agg(F.when(low == high, low).otherwise(
        F.raise_error(F.lit("two files share a fingerprint")).cast("array<int>")).alias(_AT))
    placed = joins.lookup(lines, known, ["__tl_0", "__tl_1"], ["f1", "f2"], skew_salt=spread,
                          salt_by=[_LINE])
    placed = placed.select(_LINE, *([ref(file)] if file else []), F.coalesce(
        _AT, F.raise_error(F.lit("a file that is not in the table of layouts")).cast("array<int>"))
        .alias(_AT))

    parse = {"sep": sep, **options} | ({"nullValue": null_value} if null_value is not None else {})
    raw = ", ".join([*[f"c{i} string" for i in range(len(names))], f"{_BAD} string"])
    keep = [_LINE, *([file] if file else [])]
    split = placed.select(*map(ref, keep), _AT, F.from_csv(
        _LINE, raw, parse | {"columnNameOfCorruptRecord": _BAD}).alias(_CELLS))
    split = split.select(*map(ref, keep), _AT, F.col(f"{_CELLS}.{_BAD}").alias(_BAD), F.array(
        *[F.col(f"{_CELLS}.c{i}") for i in range(len(names))]).alias(_CELLS))
    ordered = split.select(*map(ref, keep), _BAD, *[
        F.get(_CELLS, F.get(_AT, F.lit(i))).alias(n) for i, n in enumerate(names)])
    other = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    typed = F.struct(F.lit(None).cast("string").alias(_BAD))
    if other:
        typed = _typed([ref(f.name) for f in other], other, parse)
    parsed = ordered.select(*map(ref, keep), _BAD, *[
        ref(f.name) for f in schema.fields if f not in other], typed.alias(_CELLS))
    out = {n: parsed[_CELLS][n] if schema[n] in other else ref(n) for n in names}
    bad = F.when(F.col(_BAD).isNotNull() | parsed[_CELLS][_BAD].isNotNull(), F.col(_LINE))
    return parsed.select(
        *[out[old].alias(new) for old, new in (rename or {n: n for n in names}).items()],
        *([ref(file)] if file else []), *([bad.alias(corrupt)] if corrupt else []))
