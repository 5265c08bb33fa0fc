"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a maximal run of characters outside this set.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"

#: Whether a query's shuffle files go when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Columns of the documents table, in order.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor and the
    driver reach.  Where it is unset a temporary folder is used, but only in
    local mode (one machine); a cluster without the setting is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and spark.sparkContext.master.split("[")[0] == "local":
        root = spark.sparkContext.getCheckpointDir()
        if not root:
            root = tempfile.mkdtemp(prefix="tidylake-llm-")
            spark.sparkContext.setCheckpointDir(root)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/tidylake-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back: its
    lineage ends there, so a lost executor costs nothing before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint (files in the shared folder that Spark
    removes once nothing refers to them)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """``checkpointed(df)``, but the shuffle files behind it go when it is done, and not
    only when the driver next collects its garbage (Spark 4.1 on; before, as ever).  The
    setting is the session's and stands while the checkpoint is written: a query that
    another thread begins meanwhile drops its own files too, and would make them anew."""
    conf = df.sparkSession.conf
    before = conf.get(DROP_SHUFFLES, None)
    conf.set(DROP_SHUFFLES, "true")
    try:
        return checkpointed(df.select("*"))  # planned under the setting
    finally:
        if before is None:
            conf.unset(DROP_SHUFFLES)
        else:
            conf.set(DROP_SHUFFLES, before)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with the broadcast hint if it holds at most ``max_rows`` rows of
    bounded width; otherwise unchanged (Spark then shuffles and splits hot
    partitions).  ``df`` should be stored: it is counted here."""
    return F.broadcast(df) if df.count() <= max_rows else df


def ref(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def hash_key(seed: int, *cols: Column) -> Column:
    """A 60-bit key from the MD5 of ``seed`` and ``cols`` (nulls count as a value
    of their own); the same in any SQL engine."""
    parts = [F.coalesce(c.cast("string"), F.lit("~")) for c in cols]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(c: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def distinct(data: bytes, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct ones of the runs of bytes that begin at ``starts``, and the place of
    each run in these."""
    offsets = np.append(starts, len(data)).astype(np.int64, copy=False)
    runs = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    found = runs.dictionary_encode()
    return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()
