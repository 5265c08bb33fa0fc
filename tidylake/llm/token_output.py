"""Token ids as Parquet list columns.

Texts are encoded with the tokenizers library and written with Spark's Parquet
writer: ids as a list column whose pages are dictionary-encoded (the vocabulary
bounds the dictionary) and, where a chunk outgrows its dictionary, delta-encoded
(format v2 pages); row groups and pages have set sizes, and column and offset
indexes are written, so a reader fetches single documents or only the numbers
beside them.  Documents lie in ascending id order: the rows are dealt by ranges
of the id, sorted within a range, and a range is one file.

Every row carries ``first``, the place of its first id within its file, so the
place in the whole output is the file's start plus ``first``; file starts come
from one sum per file.

The library encodes chunks: runs of letters (with the space before) and what
lies between.  In byte-level vocabularies no token spans the border of two
chunks, so a chunk has the same ids anywhere.  The chunks of a batch are found over
one array of its characters and told apart by Arrow's dictionary encoding; ids are
looked up once per distinct chunk, those of chunks met before are remembered, up to a
number of bytes in two generations (when the younger is full, the older goes, except for
what was met again meanwhile), and gathered by numpy.  Texts with characters outside the Latin range, and texts that
hold a special token, are encoded whole.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidylake.llm.common import distinct, ref

#: Bytes of chunks and their ids that a worker remembers.
REMEMBERED_BYTES = 160_000_000
BATCH_CHUNKS = 20_000
RUN_WORDS = 500
_SPACE = "\u0120"  # stands for a space in byte-level vocabularies
#: Texts encoded together, and so the rows of an Arrow batch, hold about this much.
BATCH_CHARS = 2_000_000
# Parquet writer settings: row groups, pages, dictionary, delta-capable v2 pages.
ROW_GROUP_BYTES = 32 * 1024 * 1024
WRITER = {
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(256 * 1024),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1024 * 1024),
    "parquet.writer.version": "v2",
    "compression": "zstd",
}

# Kinds of Latin characters; any other may be a letter that continues a run.
_OTHER, _LETTER, _SPACE_KIND, _APOSTROPHE, _WHITE = range(5)
_PLAIN = re.compile(r"[\x00-\x7F\xA1-\xA9\xAB-\xB1\xB4\xB6-\xB8\xBB\xBF-\u024F]*")
_KIND = np.array([_SPACE_KIND if c == " " else _APOSTROPHE if c == "'" else _WHITE if c.isspace()
                  else _LETTER if c.isalpha() else _OTHER for c in map(chr, range(0x250))], np.int8)


def _starts(kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where chunks begin; ``first`` marks the first characters of texts.

    A chunk begins at a space before a letter, at what follows a run of letters, and at a
    letter that follows neither a letter nor an apostrophe nor white space: what the
    library makes of the last two depends on the letter behind them."""
    before, after = np.roll(kind, 1), np.roll(kind, -1)
    after[np.roll(first, -1)] = _OTHER
    letter = kind == _LETTER
    start = first | ((kind == _SPACE_KIND) & (after == _LETTER))
    start |= (before == _LETTER) & ~letter & (kind != _APOSTROPHE)
    start |= letter & (before == _OTHER)
    return np.flatnonzero(start)


class Encoder:
    """The tokenizers library with a memory for chunks of text."""

    def __init__(self, spec: str, end_id: int):
        self.spec, self.end = spec, np.array([end_id], "<u4").tobytes()
        self.tokenizer = None

    def __getstate__(self):
        return {"spec": self.spec, "end": self.end, "tokenizer": None}

    def prepare(self) -> "Encoder":
        if self.tokenizer is None:
            # a task has one core: the library's own threads would only wait for each other
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.tokenizer = Tokenizer.from_str(self.spec)
            self.tokenizer.no_padding()
            self.tokenizer.no_truncation()
            added = self.tokenizer.get_added_tokens_decoder().values()
            self.specials = [str(t.content) for t in added]
            self.known: dict[bytes, bytes] = {}  # by the chunk's UTF-8
            self.older: dict[bytes, bytes] = {}
            self.held = 0  # bytes of the younger generation
            tokens = self.tokenizer.get_vocab(with_added_tokens=False)
            self.spaced = np.zeros(max(tokens.values()) + 1, bool)
            self.spaced[[i for t, i in tokens.items() if t.startswith(_SPACE)]] = True
        return self

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of chunks that are a space and letters.  They go through the
        library in runs: only a word's first token begins with a space, so the
        run's ids fall apart into the words'."""
        runs = [words[at:at + RUN_WORDS] for at in range(0, len(words), RUN_WORDS)]
        out = []
        for run, found in zip(runs, self.tokenizer.encode_batch_fast(
                ["".join(run) for run in runs], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            starts = (np.flatnonzero(self.spaced[ids]) * 4).tolist()
            if len(starts) != len(run):
                raise ValueError("the vocabulary does not mark the space before a word")
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]
        return out

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _chunks(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of the distinct chunks of plain texts, the chunks in order as places in
        these, and where each text's chunks end."""
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        text = "".join(texts)
        if not text:
            return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        data = text.encode()
        narrow = len(data) == len(text)
        # plain characters beyond ASCII take two bytes in UTF-8, as any do in UTF-16
        points = np.frombuffer(data, np.uint8) if narrow else np.frombuffer(
            text.encode("utf-16-le"), "<u2")
        first = np.zeros(len(points), bool)
        first[(ends - sizes)[sizes > 0]] = True
        starts = _starts(_KIND[points], first)
        at = starts
        if not narrow:
            wide = np.searchsorted(starts, np.flatnonzero(points >= 0x80), side="right")
            at = starts + np.cumsum(np.bincount(wide, minlength=len(starts) + 1))[:-1]
        keys, place = distinct(data, at)
        ids, known, older = list(map(self.known.get, keys)), self.known, self.older
        words, others, held = [], [], 0
        for i in [i for i, x in enumerate(ids) if x is None]:
            key = keys[i]
            found = older.get(key)
            if found is not None:
                ids[i] = known[key] = found
                held += 200 + len(key) + len(found)
            elif key[0] == 32 and key[1:].decode().isalpha():
                words.append(i)
            else:
                others.append(i)
        new = self._words([keys[i].decode() for i in words])
        for a in range(0, len(others), BATCH_CHUNKS):
            new += self._library([keys[i].decode() for i in others[a:a + BATCH_CHUNKS]])
        for i, found in zip(words + others, new):
            ids[i] = known[keys[i]] = found
            held += 200 + len(keys[i]) + len(found)
        self.held += held
        return ids, place, np.searchsorted(starts, ends)

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, the end id after each, in one array; how many each has."""
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.specials)
                 or not (t.isascii() or _PLAIN.fullmatch(t))]
        odd = set(whole)
        entries, place, ends = self._chunks([t for i, t in enumerate(texts) if i not in odd])
        end = len(entries)
        entries = [*entries, self.end, *self._library([texts[i] for i in whole])]
        # the texts' chunks one after the other, each followed by the end id
        parts, plain, at, n = [], 0, 0, end + 1
        for i in range(len(texts)):
            if i in odd:
                parts.append(np.array([n, end]))
                n += 1
            else:
                parts += [place[at:ends[plain]], np.array([end])]
                at, plain = ends[plain], plain + 1
        order = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        lengths = np.array([len(x) // 4 for x in entries], np.int64)
        blob, first = np.frombuffer(b"".join(entries), "<u4"), np.cumsum(lengths) - lengths
        own = lengths[order]
        upto = np.cumsum(own)
        places = np.repeat(first[order] - (upto - own), own)
        places += np.arange(len(places))
        values = blob[places]
        counts = np.diff(upto[order == end], prepend=0)
        if self.held > REMEMBERED_BYTES // 2:
            self.older, self.known, self.held = self.known, {}, 0
        return values, counts

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each whole text, the end id appended."""
        values, counts = self.flat(texts)
        return [x.tobytes() for x in np.split(values, np.cumsum(counts)[:-1])] if texts else []


def encode_rows(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``doc_id, first, n_tokens, ids`` of ``docs`` (``doc_id, text``) in the
    order of the rows; ``first`` counts ids from the start of the partition."""
    with open(path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(Encoder(f.read(), end_id))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place = shared.value.prepare(), 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at = 0
            while at < len(texts):
                piece, size = [], 0
                while at + len(piece) < len(texts) and size < BATCH_CHARS:
                    piece.append(texts[at + len(piece)].as_py() or "")
                    size += len(piece[-1])
                values, counts = encoder.flat(piece)
                ends = np.cumsum(counts)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(piece)), pa.array(place + ends - counts),
                     pa.array(counts),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view("<i4")))],
                    names=["doc_id", "first", "n_tokens", "ids"])
                place += int(ends[-1])
                at += len(piece)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, first long, n_tokens long, ids array<int>")


def write_tokens(df: DataFrame, out: str, tokenizer_path: str, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every whole text below ``out``, one file per id range.

    Files hold ``doc_id, first, n_tokens, ids`` in ascending id order (null ids
    first, equal ids in the order of a hash of the text); the files' names are in
    the same order.  A null or empty text has just the end id.  An empty table
    writes files without rows.
    """
    docs = df.select(ref(id_col).alias("doc_id"), ref(text_col).alias("text"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    dealt = docs.repartitionByRange(n, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    encode_rows(dealt, tokenizer_path, end_id).write.options(
        **WRITER, maxRecordsPerFile=0).parquet(out)


def read_tokens(spark: SparkSession, out: str,
                columns: Sequence[str] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """Columns of the written rows, and ``first`` and ``file``; no other column
    is read from the files."""
    return spark.read.parquet(out).select(
        *columns, "first", F.col("_metadata.file_name").alias("file"))


def part_number(file: Column) -> Column:
    """The number of a file in the order of the partitions that were written."""
    return F.regexp_extract(file, r"^part-(\d+)", 1).cast("long")


def placed(rows: DataFrame, out: str) -> DataFrame:
    """``rows`` of :func:`read_tokens` with ``start``, the ids of all documents
    before each, for ``first`` and ``file``."""
    totals = rows.sparkSession.read.parquet(out).groupBy(
        F.col("_metadata.file_name").alias("file")).agg(F.sum("n_tokens").alias("n"))
    # by the part's number: beyond 100,000 parts the names are not in its order
    before = Window.orderBy(part_number(F.col("file")), "file").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(starts, "file").withColumn(
        "start", (F.col("base") + F.col("first")).cast("long")).drop("base", "first", "file")


def id_crc32(rows: DataFrame) -> DataFrame:
    """``rows`` with ``ids`` replaced by ``ids_crc32``: the unsigned CRC-32 of
    each document's ids as little-endian unsigned 32-bit integers."""
    others = [c for c in rows.columns if c != "ids"]
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            ends = ids.offsets.to_numpy()
            values = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(crc, pa.int64()), *batch.columns[1:]],
                                             names=["ids_crc32", *others])

    return rows.select("ids", *others).mapInArrow(
        run, ", ".join(["ids_crc32 long", *(f"`{c}` {kinds[c]}" for c in others)]))
