import collections
import math
import random
import re

import numpy as np
import pytest

from tests.llm.helpers import LOWER, empty, odd_documents, prose
from tidylake.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    own = [(i, collections.Counter(t), len(t)) for i, t in ((i, terms(x)) for i, x in docs) if t]
    n_docs, n_terms = len(own), sum(n for _, _, n in own)
    df = collections.Counter(t for _, c, _ in own for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, collections.Counter()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for doc, counts, n in own:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                        for t, times in wanted.items() if t in counts)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if null else doc, -s)
                for r, (s, null, doc) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def searched(spark, docs, items, **more):
    got = L.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def random_texts(n, words, seed, vocabulary=60, first=0):
    rnd = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [(first + i, " ".join(rnd.choices(names, weights, k=rnd.randint(0, words)))) for i in range(n)]


@pytest.mark.parametrize("shard, block, blocks", [(4096, 32, 1024), (37, 4, 1024), (64, 1, 3)])
def test_equals_brute_force(spark, monkeypatch, shard, block, blocks):
    monkeypatch.setattr(L, "SHARD_DOCS", shard)
    monkeypatch.setattr(L, "BLOCK_DOCS", block)
    monkeypatch.setattr(L, "BLOCK_QUERIES", blocks)
    docs = random_texts(400, 30, 1) + [(i, "w1 w2 w3") for i in range(1000, 1040)]  # ties
    items = random_texts(12, 14, 2, first=50)
    assert searched(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    docs = [tuple(r) for r in odd_documents(spark).select("doc_id", "text").collect()]
    docs += [(20, "Ünïcode ünïcode ÉÉ\x00a_b-c7"), (-5, "tail TAIL tail"), (None, "tail"), (None, "tail")]
    items = [(1, "river river STREAM tail"), (2, None), (3, ""), (None, "river"), (4, "never seen"), (5, "a b C7 é"),
             (6, "naïve Ünïcode 中文"), (1, "one two"), (7, "x" * 200_000 + " tail"), (8, prose(200))]
    assert searched(spark, docs, items) == brute(docs, items)
    clash = L.search(odd_documents(spark), spark.createDataFrame(items, ITEMS))
    assert sorted(map(tuple, clash.collect()), key=repr) == brute(docs[:-4], items)


def test_empty_tables(spark):
    docs, items = empty(spark, DOCS), empty(spark, ITEMS)
    some = spark.createDataFrame([(1, "a b")], ITEMS)
    assert L.search(docs, some).collect() == [] and L.search(docs, items).collect() == []
    assert L.search(some.withColumnRenamed("item_id", "doc_id"), items).collect() == []
    assert L.search(spark.createDataFrame([(1, " -- "), (2, None)], DOCS), some).collect() == []


def test_terms():
    text = "AbÇ d_e\x85f g '" + chr(0xA0) + "  9É"
    assert [t.decode() for t in L.terms_of(text.encode())] == terms(text)


def shard_of(texts, items, k):
    queries = L.Queries([i for i, _ in items], [[t.encode() for t in terms(x)] for _, x in items])
    counts = [collections.Counter(t.encode() for t in terms(x)) for _, x in texts]
    df = np.array([sum(t in c for c in counts) for t in queries.vocabulary], np.int64)
    n = np.array([sum(c.values()) for c in counts])
    queries.weigh(len(texts), int(n.sum()), df, k)
    rows = [[(queries.vocabulary[t], f) for t, f in c.items() if t in queries.vocabulary] for c in counts]
    flat = np.array([x for r in rows for x in r], np.int64).reshape(-1, 2)
    return L.Shard(queries, n, np.array(list(map(len, rows))), flat[:, 0], flat[:, 1])


def test_blocks_are_similar_and_skipped_only_below_the_bound(monkeypatch):
    monkeypatch.setattr(L, "BLOCK_DOCS", 8)
    # two kinds of documents share one term; a query wants one kind
    rnd = random.Random(8)
    texts = [(i, "both " + " ".join(rnd.choices([f"{'ab'[i % 2]}{j}" for j in range(12)], k=9))) for i in range(400)]
    items = [(1, "both a0 a1 a2 a3 a4 a5")]
    shard = shard_of(texts, items, 5)
    whole = shard.score(False)[0].copy()
    term = shard.queries.vocabulary[b"both"]
    docs, starts = shard.blocks(term)
    assert sorted(docs.tolist()) == list(range(400)) and len(starts) > 10
    mixed = [len({d % 2 for d in part}) > 1 for part in np.split(docs, starts[1:])]
    assert sum(mixed) < len(mixed) / 2
    # with a threshold, blocks are skipped and the best rows stay
    kth = np.sort(whole)[-5]
    shard.queries.least[:] = kth
    shard.projected = None
    again = shard.score(False)[0]
    assert shard.skipped > 0
    assert sorted(again[again >= kth]) == sorted(whole[whole >= kth])


def test_first_thresholds_never_exceed_the_kth_score(monkeypatch):
    texts, items = random_texts(300, 25, 4), random_texts(6, 12, 5)
    shard = shard_of(texts, items, 10)
    seeds = shard.score(True)
    least = shard.queries.least.copy()
    shard.queries.least[:] = 0
    whole = shard.score(False)
    for q in range(len(items)):
        assert least[q] <= np.sort(whole[q])[-10]
        assert (seeds[q] <= whole[q]).all()
