"""N-gram Jaccard join by a token-group matrix.

All pairs of documents whose sets of five-word shingles have a Jaccard similarity
of at least 0.75, exactly: the components that they connect and, per document, the
number of other documents that it is linked with.

1. Documents with equal sets are one.  A set can have a partner only if at least
   three quarters of its shingles occur in another set, so sets with too many
   shingles of their own are settled at once.  Shingles are first counted in a
   fixed part of the hash space; too many own shingles there are too many.
2. The rest is counted in full and filtered once more.
3. Similar sets are linked to pivots: under a few hash functions, sets with the
   same smallest shingle are compared with the one among them that has the
   fewest shingles of its own.  Large families of copies become one component in
   a number of comparisons linear in their size.
4. Token-group matrix: each component is a group, and other sets are grouped by
   their most common shingle.  Per group the union of its members' prefix
   shingles is stored (rarest first, a set's first quarter meets any partner's),
   with the sizes of the sets that hold each and the most shingles that follow it there,
   so the matrix names the queries that can have a link in another group at all: a
   shingle counts only if the sizes allow a link and enough shingles follow it on both
   sides; of two groups, the sets of the smaller are the queries.  Groups are opened in
   blocks of bounded size: a query is bounded by its overlap with the block's
   token union, and only where that suffices are the members counted.  Every group is
   opened to its own sets too, so that each pair that can be linked meets once;
   without counting, pairs inside one component are not looked at again.
5. Components of all links; sums of the counted links.

No pair of documents is ever a row: queries meet blocks inside a task and return
a spanning forest of their links and, per set, the number of documents met.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidylake.llm.common import WORD_PATTERN, ref, settled
from tidylake.llm.components import components
from tidylake.llm.shingles import shingle_set

WIDTH = 5
PERCENT = 75
#: The part of the hash space that is counted first; small sets are counted whole.
PART = 0.4
SMALL, SMALL_PARTNER = 96, 128  # a partner of a set of 96 has at most 128 shingles
PIVOT_ROUNDS = 3
BLOCK_SETS, PART_QUERIES = 256, 1024
MAX_BROADCAST_SETS = 2_000_000
_LIMIT = np.int64(-(2**63) + int(PART * 2**64))


class Join(NamedTuple):
    """``documents``: doc_id, text_key, set_id, n_shingles, component (a set
    id), n_links (other rows with a similarity of at least 0.75, equal sets
    included; null if not counted), one row per input row; ``links``: a, b, set ids of a
    linked pair - enough pairs to connect every component, not all."""
    documents: DataFrame
    links: DataFrame


def _set_id(tokens: np.ndarray) -> int:
    """63-bit id of a set by its sorted shingles (empty: -1)."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) >> 1 if len(tokens) else -1


def _text_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes = [], []
        for text in batch.column(1):
            tokens = shingle_set(text.as_py(), WIDTH)
            ids.append(_set_id(tokens))
            sizes.append(len(tokens))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
             batch.column(2)], names=["doc_id", "set_id", "n", "text_key"])


def _tokens_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``token, owner`` of the counted part; the owner's last bit tells whether
    the token counts against its set."""
    for batch in batches:
        tokens, owners, size = [], [], 0
        for text in batch.column(0):
            found = shingle_set(text.as_py(), WIDTH)
            n = len(found)
            if not n:
                continue
            low = found < _LIMIT
            owner = np.int64(_set_id(found) & ~1 & (2**63 - 1))
            if n > SMALL_PARTNER:
                found, count = found[low], np.ones(int(low.sum()), np.int64)
            else:
                count = low.astype(np.int64) | (n <= SMALL)
            tokens.append(found)
            owners.append(owner | count)
            size += len(found)
            if size > 500_000:
                yield _pairs(tokens, owners, "token", "owner")
                tokens, owners, size = [], [], 0
        if tokens:
            yield _pairs(tokens, owners, "token", "owner")


def _pairs(a: list, b: list, *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))],
                                      names=list(names))


def _needed(n: Column) -> Column:
    """Least overlap of a set of ``n`` with any partner."""
    return F.ceil(n * PERCENT / F.lit(100.0)).cast("long")


def _open_sets(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Sets (``set_id, n, copies, doc_id, text_key``) that may have a partner, by
    the first count."""
    counted = docs.select("text").mapInArrow(_tokens_first, "token long, owner long")
    owners = F.shiftright("owner", 1)
    own = counted.groupBy("token").agg(
        F.min(owners).alias("least"), F.max(owners).alias("most"),
        F.max(F.col("owner").bitwiseAND(F.lit(1))).alias("counts")).where(
        "least = most and counts = 1").groupBy("least").agg(F.count(F.lit(1)).alias("own"))
    joined = sets.withColumn("half", F.shiftright("set_id", 1)).join(
        own, F.col("half") == F.col("least"), "left")
    return joined.where(F.coalesce("own", F.lit(0)) <= F.col("n") - _needed(F.col("n"))).select(
        "set_id", "n", "copies", "doc_id", "text_key")


def _tokens_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``set_id, tokens``: the shingles of the chosen sets, from one text each."""
    if chosen.count() <= MAX_BROADCAST_SETS:
        chosen = F.broadcast(chosen)
    wanted = chosen.select("set_id", F.col("doc_id").alias("of"), F.col("text_key").alias("key"))
    texts = docs.join(wanted, (F.col("text_key") == F.col("key"))
                      & F.col("doc_id").eqNullSafe(F.col("of"))).select("set_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                found = [shingle_set(t.as_py(), WIDTH) for t in batch.column(1).slice(at, 200)]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 200),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))],
                    names=["set_id", "tokens"])

    found = texts.mapInArrow(run, "set_id long, tokens array<long>")
    return found.groupBy("set_id").agg(F.any_value("tokens").alias("tokens"))


def _shared(sets: DataFrame, tokens: DataFrame) -> DataFrame:
    """Sets that may have a partner, by the full count: ``set_id, n, copies, tokens``
    (shingles that other sets hold too, sorted), ``prefix`` (the rarest, rarest first) and
    ``common`` (the most common shingle)."""
    rows = tokens.select("set_id", F.explode("tokens").alias("token"))
    often = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    lists = rows.join(often, "token").groupBy("set_id").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("ordered"))
    kept = sets.select("set_id", "n", "copies").join(lists, "set_id").where(
        F.size("ordered") >= _needed(F.col("n")))
    spare = F.size("ordered") - _needed(F.col("n")) + 1
    return kept.select(
        "set_id", "n", "copies", F.array_sort(F.col("ordered.token")).alias("tokens"),
        F.slice(F.col("ordered.token"), F.lit(1), spare.cast("int")).alias("prefix"),
        F.element_at("ordered", -1)["token"].alias("common"))


def _linked(inter: Column, a: Column, b: Column) -> Column:
    return inter * 100 >= (a + b - inter) * PERCENT


def _pivot_links(sets: DataFrame) -> DataFrame:
    """``a, b``: sets linked to the pivot among those with their smallest hash."""
    keys = F.array(*[F.struct(F.lit(r).alias("round"), F.array_min(F.transform(
        "tokens", lambda t, r=r: F.xxhash64(t, F.lit(r)))).alias("low"))
        for r in range(PIVOT_ROUNDS)])
    keyed = sets.select("set_id", "n", F.size("tokens").alias("shared"), F.explode(keys).alias("key"))
    pivots = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"),
        F.min(F.struct(-F.col("shared") / F.col("n"), "set_id")).alias("best")).where("members > 1")
    meets = keyed.join(pivots, "key").select("set_id", F.col("best.set_id").alias("pivot")).where(
        "set_id <> pivot").distinct()
    left = sets.select("set_id", "n", "tokens")
    right = sets.select(F.col("set_id").alias("pivot"), F.col("n").alias("pivot_n"),
                        F.col("tokens").alias("pivot_tokens"))
    both = meets.join(left, "set_id").join(right, "pivot")
    inter = F.size(F.array_intersect("tokens", "pivot_tokens"))
    return both.where(_linked(inter, F.col("n"), F.col("pivot_n"))).select(
        F.col("set_id").alias("a"), F.col("pivot").alias("b"))


def opened(queries: pd.DataFrame, members: pd.DataFrame) -> list[tuple[int, int]]:
    """Links of queries with a block's members (columns ``set_id, n, tokens``),
    at most a spanning forest of them."""
    return met(queries.assign(copies=1, inside=True), members.assign(copies=1))[0]


def met(queries: pd.DataFrame, members: pd.DataFrame) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """A spanning forest of the links of queries with a block's members (columns
    ``set_id, n, tokens, copies``), and per set the copies of the sets that it is
    linked with.  Queries ``inside`` the block's group are asked both ways, so
    only their own side counts; others meet the members once, for both sides."""
    postings = np.concatenate(members["tokens"].to_numpy())
    owner = np.repeat(np.arange(len(members)), members["tokens"].map(len))
    order = np.argsort(postings, kind="stable")
    union, first = np.unique(postings[order], return_index=True)
    owner, first = owner[order], np.append(first, len(postings))
    sizes, names = members["n"].to_numpy(), members["set_id"].to_numpy()
    copies, reached = members["copies"].to_numpy(), np.zeros(len(members), np.int64)
    counts: Counter[int] = Counter()
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    links = []
    for name, n, tokens, weight, inside in zip(*[queries[c] for c in (
            "set_id", "n", "tokens", "copies", "inside")]):
        at = np.searchsorted(union, tokens)
        at[at == len(union)] = 0
        held = at[union[at] == tokens]
        if 100 * len(held) < PERCENT * n:
            continue  # the block's union bounds the overlap with every member
        lengths = first[held + 1] - first[held]
        ends = np.cumsum(lengths)
        place = np.repeat(first[held] - (ends - lengths), lengths) + np.arange(ends[-1])
        inter = np.bincount(owner[place], minlength=len(names))
        hits = np.flatnonzero((100 * inter >= PERCENT * (n + sizes - inter)) & (names != name))
        if not len(hits):
            continue
        counts[int(name)] += int(copies[hits].sum())
        if not inside:
            reached[hits] += weight
        for i in hits:
            a, b = find(int(name)), find(int(names[i]))
            if a != b:
                root[a] = b
                links.append((int(name), int(names[i])))
    for i in np.flatnonzero(reached):
        counts[int(names[i])] += int(reached[i])
    return links, counts


def _grouped(sets: DataFrame, found: DataFrame) -> DataFrame:
    """``sets`` with ``group`` and ``loose``: a component (``found``: node,
    component) is a group; other sets are grouped by their most common shingle, in
    groups of about a block, equal smallest hashes together."""
    known = sets.join(found.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "loose", F.col("component").isNull())
    many = known.where("loose").groupBy("common").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("long").alias("parts"))
    low = F.array_min(F.transform("tokens", lambda t: F.xxhash64(t, F.lit("part"))))
    part = F.when(F.col("loose"), F.pmod(low, F.coalesce("parts", F.lit(1).cast("long"))))
    return known.join(many, "common", "left").select(
        "set_id", "n", "copies", "tokens", "prefix", "loose",
        F.when(F.col("loose"), F.xxhash64("common", part)).otherwise(
            F.xxhash64("component", F.lit("whole"))).alias("group"))


def _band(size: str) -> Column:
    """Sizes that a link allows are in the same or a neighbouring band."""
    return F.floor(F.log(F.col(size).cast("double")) / math.log(100 / PERCENT + 0.01)).cast("int")


def _group_links(sets: DataFrame, found: DataFrame, counting: bool) -> DataFrame:
    """``a, b, met``: links (``met`` is 0) between sets of different
    components, by the token-group matrix; if ``counting``, of all sets, and rows
    with b -1 and in ``met`` documents that a is linked with, to be summed.  Sets
    of the smaller group are the queries of a pair of groups."""
    grouped = settled(_grouped(sets, found))
    counts = settled(grouped.groupBy("group").agg(
        F.count(F.lit(1)).alias("members"),
        (F.max("loose") | F.lit(counting)).alias("asks_itself")))
    # left: the set's shingles from this one on
    prefixes = grouped.select(
        "set_id", "group", F.col("n").cast("int").alias("n"), F.size("tokens").alias("shared"),
        F.posexplode("prefix").alias("place", "token")).select(
        "set_id", "group", "n", "token", (F.col("shared") - F.col("place")).alias("left"))
    matrix = prefixes.groupBy("token", "group").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("left").alias("left"))
    several = matrix.groupBy("token").agg(F.count(F.lit(1)).alias("groups")).where("groups > 1")
    # the matrix: only shingles that can join two groups, with the groups' sizes, the sizes
    # of their sets with the shingle and the most that can follow it in one of them
    matrix = settled(matrix.join(several.select("token"), "token").join(
        counts.select("group", "members"), "group"))
    other = matrix.select(
        "token", F.explode(F.sequence(_band("least") - 1, _band("most") + 1)).alias("band"),
        *[F.col(c).alias(f"other_{c}") for c in ("group", "members", "least", "most", "left")])
    askers = prefixes.join(matrix.select("token", "group", "members"), ["token", "group"])
    # of two linked sets with their first common shingle here, neither is too large for the
    # other, and what follows it suffices for their overlap
    queries = askers.withColumn("band", _band("n")).join(other, ["token", "band"]).where(
        "(members < other_members or (members = other_members and group < other_group))"
        f" and 100 * n >= {PERCENT} * other_least and 100 * other_most >= {PERCENT} * n"
        f" and {100 + PERCENT} * least(left, other_left) >= {PERCENT} * (n + other_least)").select(
        "set_id", F.col("other_group").alias("group")).distinct().withColumn("inside", F.lit(False))
    # a group that asks itself and is larger than a block
    large = counts.where(F.col("asks_itself") & (F.col("members") > BLOCK_SETS)).select("group")
    inside = grouped.join(large, "group").select("set_id", "group", F.lit(True).alias("inside"))
    queries = settled(queries.union(inside))
    asked = queries.groupBy("group").agg(F.count(F.lit(1)).alias("asked"))
    # a group is opened in blocks of members and parts of queries
    plan = settled(counts.join(asked, "group", "left").where(
        "asked is not null or (asks_itself and members > 1)").select(
        "group", "asks_itself", F.ceil(F.col("members") / BLOCK_SETS).cast("long").alias("blocks"),
        F.ceil(F.coalesce("asked", F.lit(1)) / PART_QUERIES).cast("long").alias("parts")))

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    def spread(n: str) -> Column:
        return F.pmod(F.xxhash64("set_id", F.lit(n)), F.col(n))

    shape = [F.col(c).alias(c) for c in ("set_id", "n", "copies", "tokens")]
    members = grouped.select("group", *shape).join(plan, "group").select(
        "group", spread("blocks").alias("block"), F.explode(upto("parts")).alias("part"),
        (F.col("asks_itself") & (F.col("blocks") == 1)).alias("own"), "set_id", "n", "copies", "tokens")
    asking = queries.join(plan.select("group", "blocks", "parts"), "group").select(
        "set_id", "group", "inside", F.explode(upto("blocks")).alias("block"),
        spread("parts").alias("part"))
    asking = asking.join(grouped.select(*shape), "set_id").select(
        "group", "block", "part", "inside", "set_id", "n", "copies", "tokens")

    def run(key: tuple, queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(members):
            # members of a group that asks itself in one block are queries too
            own = [members.assign(inside=True)] if members["own"].iloc[0] and key[2] == 0 else []
            if len(queries) or own:
                links, counts = met(pd.concat([queries, *own]), members)
                rows = [(a, b, 0) for a, b in links]
                if counting:
                    rows += [(a, -1, n) for a, n in counts.items()]
        return pd.DataFrame(rows, columns=["a", "b", "met"], dtype="int64")

    key = ["group", "block", "part"]
    return asking.groupBy(*key).cogroup(members.groupBy(*key)).applyInPandas(
        run, "a long, b long, met long")


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 counting: bool = True) -> Join:
    """Exact similarity join of the texts; see :class:`Join`.  Without
    ``counting`` only the components are found, with fewer comparisons.

    Words are runs of characters other than space and \\t to \\r, A-Z
    lower-cased.  A text with fewer than five words has its whole sequence as one
    shingle; a null or empty text has an empty set (``set_id`` -1), which is
    linked with nothing.  Repeated rows share a set; null ids are values like
    others.  An empty table gives no rows; other columns play no part.
    """
    docs = df.select(ref(id_col).alias("doc_id"), ref(text_col).alias("text"),
                     F.xxhash64(ref(text_col)).alias("text_key"))
    kind = dict(docs.dtypes)["doc_id"]
    documents = settled(docs.select("doc_id", "text", "text_key").mapInArrow(
        _text_sets, f"doc_id {kind}, set_id long, n long, text_key long"))
    sets = documents.where("n > 0").groupBy("set_id").agg(
        F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("doc_id", "text_key")).alias("from")).select(
        "set_id", "n", "copies", "from.doc_id", "from.text_key")
    chosen = settled(_open_sets(docs, sets))
    tokens = settled(_tokens_of(docs, chosen))
    candidates = settled(_shared(chosen, tokens))
    first = settled(_pivot_links(candidates))
    second = settled(_group_links(candidates, components(first), counting))
    links = first.union(second.where("b >= 0").select("a", "b"))
    found = settled(components(links)).select(
        F.col("node").alias("of"), "component", F.lit(None).cast("long").alias("met"))
    if counting:
        none = F.lit(None).cast("long").alias("component")
        twins = documents.where("n > 0").groupBy("set_id").agg((F.count(F.lit(1)) - 1).alias("met"))
        found = settled(found.union(second.where("b < 0").select("a", none, "met")).union(
            twins.where("met > 0").select("set_id", none, "met")).groupBy("of").agg(
            F.max("component").alias("component"), F.sum("met").alias("met")))
    n_links = F.coalesce("met", F.lit(0).cast("long")) if counting else F.lit(None).cast("long")
    members = documents.join(found, documents["set_id"] == found["of"], "left").select(
        "doc_id", "text_key", "set_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "set_id").alias("component"), n_links.alias("n_links"))
    return Join(members, links)


def clusters(join: Join) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` per document: the smallest id
    reachable by links (null where all are null) and the number of other documents
    that it is linked with; a document with an empty set is alone."""
    ids = join.documents.where("n_shingles > 0").groupBy("component").agg(
        F.min("doc_id").alias("smallest"))
    alone = join.documents.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "n_links")
    return join.documents.where("n_shingles > 0").join(ids, "component").select(
        "doc_id", "n_shingles", F.col("smallest").alias("component_id"), "n_links").union(alone)


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each component: that with the smallest id (nulls
    first).  Rows without words are all kept."""
    documents = jaccard_join(df, id_col, text_col, counting=False).documents
    alone = documents.where("n_shingles = 0").select("doc_id", "text_key")
    first = documents.where("n_shingles > 0").groupBy("component").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first")).select("first.*")
    chosen = settled(first.union(alone).distinct())
    wanted = chosen.select(F.col("doc_id").alias("__tl_id"), F.col("text_key").alias("__tl_key"))
    if chosen.count() <= MAX_BROADCAST_SETS:
        wanted = F.broadcast(wanted)
    key = F.xxhash64(ref(text_col))
    kept = df.join(wanted, ref(id_col).eqNullSafe(F.col("__tl_id")) & (key == F.col("__tl_key")),
                   "left_semi")
    repeated = documents.where("n_shingles > 0").groupBy("doc_id", "text_key").count().where(
        "count > 1").limit(1).count()
    if not repeated:
        return kept
    # rows that repeat both id and text: one of each stays
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = kept.select(F.struct(*[ref(c).alias(n) for c, n in zip(df.columns, names)]).alias("row"),
                       ref(id_col).alias("doc_id"), key.alias("text_key"),
                       F.regexp_like(F.coalesce(ref(text_col), F.lit("")), F.lit(WORD_PATTERN)).alias("words"))
    once = rows.where("words").groupBy("doc_id", "text_key").agg(F.any_value("row").alias("row"))
    return once.select("row").union(rows.where("not words").select("row")).select(
        *[F.col("row")[n].alias(c) for c, n in zip(df.columns, names)])
