"""Exact ranked lexical search with geometrically blocked posting lists.

The best documents of each query by the sum of its terms' weights times their impacts in
the document (see :func:`search` for the formulas), all in integers.

1. One pass over the texts counts terms and keeps, per document, the frequencies of the
   queries' terms.  Statistics (documents, terms, document frequencies) are aggregates.
2. Each task takes its documents in shards of a bounded size.  In a shard a term's
   posting list is cut into blocks by document similarity: documents go to the nearest
   of some representatives of the list, by the cosine of random projections of their
   weighted vectors.  A block stores its summary: the maximum of every coordinate over
   its documents.
3. A query's inner product with a summary bounds the score of every document of the
   block.  A block is skipped only if that bound is below the query's threshold, which
   is a k-th score that documents are known to reach; the documents of all other blocks
   are scored in full.  Lists are needed only as far as the largest impacts of the rest
   together could reach the threshold: a document in none of the needed lists is below.
4. Thresholds: first the documents with each query's rarest terms are scored, and the
   k-th of these scores over all shards is where the main pass begins; it rises in a
   task as shards are searched.
5. The shards' best rows are ranked per query.

Nothing is sampled: every block is either opened or bounded.  Queries are handled in
blocks of a bounded number of bytes, which are what is sent to the tasks; documents are
neither shuffled nor collected.
"""

from __future__ import annotations

import copy
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidylake.llm.common import checkpointed, ref, stored

#: Bytes and number of queries that are handled at once.
BLOCK_BYTES, BLOCK_QUERIES = 4_000_000, 1024
#: Documents of a shard; fewer where the queries hold many terms.
SHARD_DOCS, SHARD_CELLS = 4096, 16_000_000
#: Documents of a block of a posting list, about; coordinates of the projections.
BLOCK_DOCS, PROJECTED = 32, 16
#: A query's first threshold comes from its rarest terms that have so many times k postings.
SEED_TIMES = 20
_EXACT = 2**53

# A-Z in lower case; every ASCII character that is neither letter nor digit
# separates terms; all other bytes of UTF-8 stay.
_TABLE = bytes([ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)]
               + [*range(128, 256)])


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8: runs of letters, digits and non-ASCII characters, A-Z
    lower-cased."""
    return text.translate(_TABLE).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of terms that occur ``tf`` times in documents of ``n`` terms."""
    m = 25 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Queries:
    """A block of queries over their own vocabulary: per query its terms and the sum of
    the weights of each, one for every occurrence."""

    def __init__(self, ids: list, terms: list[list[bytes]]):
        self.ids = ids
        counts = [Counter(t) for t in terms]
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        self.terms = [np.array([self.vocabulary[t] for t in c], np.int64) for c in counts]
        self.times = [np.array([*c.values()], np.int64) for c in counts]

    def weigh(self, n_docs: int, n_terms: int, df: np.ndarray, k: int) -> None:
        self.n_docs, self.n_terms, self.k = n_docs, n_terms, k
        self.weight = np.array([weight(n_docs, d) for d in df.tolist()], np.int64)
        self.factors = [t * self.weight[i] for t, i in zip(self.times, self.terms)]
        most = max((int(f.sum()) for f in self.factors), default=0) * 1_000_000
        self.kind = np.float64 if most < _EXACT else np.int64  # both exact
        self.least = np.zeros(len(self.ids), np.int64)  # thresholds
        self.seeds = []
        for terms in self.terms:
            rare = terms[np.argsort(df[terms], kind="stable")]
            enough = np.searchsorted(np.cumsum(df[rare]), SEED_TIMES * k) + 1
            self.seeds.append(set(rare[:enough].tolist()))


class Shard:
    """Impacts of some documents, a row per term of the vocabulary."""

    def __init__(self, queries: Queries, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray,
                 tfs: np.ndarray):
        self.queries = queries
        doc = np.repeat(np.arange(len(n)), sizes)
        self.cells = np.zeros((len(queries.vocabulary), len(n)), np.int32)
        self.cells[terms, doc] = impacts(tfs.astype(np.int64), n[doc].astype(np.int64),
                                         queries.n_docs, queries.n_terms)
        self.projected: np.ndarray | None = None

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a posting list in the order of its blocks, and where each begins:
        a representative and the documents that are most similar to it."""
        docs = np.flatnonzero(self.cells[term])
        n = math.ceil(len(docs) / BLOCK_DOCS)
        if n <= 1:
            return docs, np.zeros(min(len(docs), 1), np.int64)
        if self.projected is None:
            signs = np.random.default_rng(11).choice([-1.0, 1.0], (len(self.cells), PROJECTED))
            signs = (signs * self.queries.weight[:, None]).astype(np.float32)
            made = self.cells.T.astype(np.float32) @ signs
            self.projected = made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)
        own = self.projected[docs]
        nearest = (own @ own[np.arange(n) * len(docs) // n].T).argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        return docs[order], np.flatnonzero(np.diff(nearest[order], prepend=-1))

    def needed(self, query: int) -> np.ndarray:
        """Terms of a query whose lists must be read: the largest impacts of all others
        together stay below its threshold."""
        queries = self.queries
        terms, factors = queries.terms[query], queries.factors[query]
        most = factors * self.most[terms]
        order = np.argsort(most, kind="stable")
        below = np.searchsorted(np.cumsum(most[order]), max(queries.least[query], 1), side="left")
        return terms[order[below:]]

    def score(self, seeds: bool) -> np.ndarray:
        """Scores per query and document; 0 where the document is below the query's
        threshold and was not looked at.  With ``seeds`` only the lists of the queries'
        seed terms are read.  Raises the thresholds."""
        queries = self.queries
        self.most = self.cells.max(axis=1, initial=0).astype(np.int64)
        asking: dict[int, list[int]] = {}
        for q in range(len(queries.ids)):
            for t in self.needed(q).tolist():
                if not seeds or t in queries.seeds[q]:
                    asking.setdefault(t, []).append(q)
        scores = np.zeros((len(queries.ids), self.cells.shape[1]), np.int64)
        self.opened = self.skipped = 0
        # lists of heavy terms first: they raise the thresholds
        for t in sorted(asking, key=lambda t: (-queries.weight[t], t)):
            docs, starts = self.blocks(t)
            if not len(docs):
                continue
            of = np.unique(np.concatenate([queries.terms[q] for q in asking[t]]))
            part = self.cells[np.ix_(of, docs)]
            summary = np.maximum.reduceat(part, starts, axis=1)
            lengths = np.diff(starts, append=len(docs))
            for q in asking[t]:
                at = np.searchsorted(of, queries.terms[q])
                factors = queries.factors[q].astype(queries.kind)
                good = factors @ summary[at] >= queries.least[q]
                self.opened += int(good.sum())
                self.skipped += int((~good).sum())
                if not good.any():
                    continue
                chosen = np.repeat(good, lengths)
                found = (factors @ part[np.ix_(at, chosen)]).astype(np.int64)
                scores[q, docs[chosen]] = found
                if (found > queries.least[q]).any() and scores.shape[1] >= queries.k:
                    kth = np.partition(scores[q], -queries.k)[-queries.k]
                    queries.least[q] = max(queries.least[q], kth)
        return scores


def _counted(docs: DataFrame, queries: Queries) -> DataFrame:
    """``doc_id, n, terms, tfs`` of the documents with a term: the number of terms, and
    the vocabulary's terms in the document with their frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(queries.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value.get
        for batch in batches:
            ids, sizes, terms, tfs = [], [], [], []
            ends = [0]
            texts = batch.column(1).cast(pa.binary())
            for i in range(len(batch)):
                own = terms_of(texts[i].as_py())
                if not own:
                    continue
                counts = Counter(map(place, own))
                counts.pop(None, None)
                ids.append(i)
                sizes.append(len(own))
                terms.extend(counts.keys())
                tfs.extend(counts.values())
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))],
                names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, len(batch), most):
            part = batch.slice(at, most)
            if sum(map(len, held)) + len(part) > most:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _searched(counted: DataFrame, queries: Queries, seeds: bool) -> DataFrame:
    """``query, doc_id, score``: each shard's best rows of each query (by place)."""
    shared = counted.sparkSession.sparkContext.broadcast(queries)
    most = max(1, min(SHARD_DOCS, SHARD_CELLS // max(len(queries.vocabulary), 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy.copy(shared.value)
        own.least = own.least.copy()  # rises while the task runs
        for table in _shards(batches, most):
            table = table.combine_chunks()
            ids, n, terms, tfs = (table.column(i).combine_chunks() for i in range(4))
            shard = Shard(own, n.to_numpy(), np.diff(terms.offsets.to_numpy()),
                          terms.flatten().to_numpy(), tfs.flatten().to_numpy())
            scores = shard.score(seeds)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            key = ids.fill_null(0).to_numpy()
            out = []
            for q, row in enumerate(scores):
                at = np.flatnonzero(row >= max(own.least[q], 1))
                out.append(at[np.lexsort((key[at], null[at], -row[at]))][:own.k])
            of, at = np.repeat(np.arange(len(out)), list(map(len, out))), np.concatenate(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(of, pa.int64()), ids.take(pa.array(at, pa.int64())),
                 pa.array(scores[of, at], pa.int64())],
                names=["query", "doc_id", "score"])

    return counted.where(F.size("terms") > 0).mapInArrow(run, "query long, doc_id long, score long")


def _ranked(rows: DataFrame) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(best))


def _block(docs: DataFrame, queries: Queries, k: int) -> DataFrame:
    """``query, rank, doc_id, score`` for one block of queries."""
    counted = stored(_counted(docs, queries), "terms")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(queries.vocabulary), np.int64)
    # one row per term of the bounded vocabulary
    often = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df[often["term"].to_numpy()] = often["count"].to_numpy()
    queries.weigh(n_docs, n_terms, df, k)
    ranked = _ranked(_searched(counted, queries, True))
    # one row per query of the bounded block
    for q, score in ranked.where(F.col("rank") == k).select("query", "score").collect():
        queries.least[q] = score
    return _ranked(_searched(counted, queries, False)).where(F.col("rank") <= k).select("query", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id",
           text_col: str = "text", query_id_col: str = "item_id", query_text_col: str = "text"
           ) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each query.

    N documents hold at least one term, L terms together, n of them in the document; a
    term is in df documents and occurs tf times in this one.  Its weight is
    ``floor(1000 ln((2 N + 2) / (2 df + 1)))``, its impact ``10**9 tf div (1000 tf + 8 m)``
    with ``m = 25 + (75 n N) div L``, and a document's score is the sum of weight times
    impact over the query's terms, repeats included.

    Only scores above 0 are returned; equal ones are ordered by id, null ids last.  Null,
    empty and termless texts of either side give no rows; repeated documents rank each,
    a repeated query id is one query (its texts' terms together).  Queries with a null id
    take no part.  An empty table gives no rows; other columns play no part.
    """
    spark = docs.sparkSession
    docs = docs.select(ref(id_col).cast("long").alias("doc_id"), ref(text_col).alias("text"))
    asked = checkpointed(queries.select(
        ref(query_id_col).cast("long").alias("item_id"), ref(query_text_col).alias("text")).where(
        "item_id is not null and text is not null"))
    n, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / BLOCK_QUERIES), math.ceil(size / BLOCK_BYTES))
    found = []
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        texts: dict[int, list[bytes]] = {}
        for item, text in part.collect():  # a block of bounded size
            texts.setdefault(item, []).extend(terms_of(text.encode()))
        ids = sorted(i for i, terms in texts.items() if terms)
        if ids:
            names = spark.createDataFrame(pa.table({
                "query": pa.array(range(len(ids)), pa.int64()), "item_id": pa.array(ids, pa.int64())}))
            rows = _block(docs, Queries(ids, [texts[i] for i in ids]), k)
            found.append(rows.join(F.broadcast(names), "query").select(
                "item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found)
