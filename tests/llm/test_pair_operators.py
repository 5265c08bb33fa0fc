import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from tests.llm.helpers import LOWER, WORD, empty, odd_documents, prose
from tidylake.llm import components, shingles, token_groups, topk, url_filter
from tidylake.llm.common import DROP_SHUFFLES


def brute_sets(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute_components(rows):
    """doc_id -> smallest id reachable, over rows (doc_id, text) with distinct ids."""
    sets = {i: brute_sets(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def near_copies(seed):
    """Families of copies with few to many edits, shared passages, short texts."""
    rng, rows = random.Random(seed), []
    passage = "the quick brown fox jumps over the lazy dog near the old mill every day".split()
    for family in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 12, 40, 150]))]
        for _ in range(rng.choice([1, 5, 25])):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(words) // 20))):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10_000)}"
            if rng.random() < 0.3:
                words += passage
            rows.append(" ".join(words))
    rows += [" ".join(passage)] * 3 + ["one two", "One  TWO", "one two three", "", " "]
    rows += [prose(40, i) for i in range(15)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_word_hashes_split_like_the_pattern():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("aB é\t\n\x0b\x0c\r\x1f 中 ") for _ in range(40))
        words = WORD.findall(text.translate(LOWER))
        got = shingles.word_hashes(text.encode())
        assert len(got) == len(words)
        assert len(set(got.tolist())) == len(set(words))


def test_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(token_groups, "BLOCK_SETS", 4)
    for seed in (1, 2, 3):
        rows = near_copies(seed)
        want, sizes = brute_components(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = token_groups.clusters(token_groups.jaccard_join(df)).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want
        assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes


def test_join_without_pivots_finds_the_same(spark, monkeypatch):
    """The matrix alone finds every link; the first count settles sets early."""
    monkeypatch.setattr(token_groups, "_pivot_links", lambda sets: sets.sparkSession.createDataFrame(
        [], "a long, b long"))
    monkeypatch.setattr(token_groups, "SMALL", 8)
    monkeypatch.setattr(token_groups, "SMALL_PARTNER", 10)
    rows = near_copies(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_groups.clusters(token_groups.jaccard_join(df)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(rows)[0]


def brute_links(rows):
    """doc_id -> number of other rows with a similarity of at least 0.75."""
    sets = [(i, brute_sets(t)) for i, t in rows]
    return {i: sum(i != j and len(a & b) * 100 >= 75 * len(a | b) > 0 for j, b in sets)
            for i, a in sets}


def test_join_counts_every_link(spark, monkeypatch):
    """In families of copies, with and without pivots, in one and in many blocks."""
    rows = near_copies(2)
    want, df = brute_links(rows), spark.createDataFrame(rows, "doc_id long, text string")
    assert max(want.values()) > 5
    for block, part in ((256, 1024), (4, 3)):
        monkeypatch.setattr(token_groups, "BLOCK_SETS", block)
        monkeypatch.setattr(token_groups, "PART_QUERIES", part)
        got = token_groups.clusters(token_groups.jaccard_join(df)).collect()
        assert {r["doc_id"]: r["n_links"] for r in got} == want
    monkeypatch.setattr(token_groups, "_pivot_links", lambda sets: sets.sparkSession.createDataFrame(
        [], "a long, b long"))
    got = token_groups.clusters(token_groups.jaccard_join(df)).collect()
    assert {r["doc_id"]: r["n_links"] for r in got} == want


def shuffle_bytes(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(f.stat().st_size for d in disk.localDirsString() for f in Path(d).rglob("shuffle_*.data"))


def test_join_leaves_no_shuffle_files(spark):
    """What a step has dealt out is gone when its result is stored."""
    rows = [(i, prose(300, i % 150)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before, set_before = shuffle_bytes(spark), spark.conf.get(DROP_SHUFFLES, None)
    join = token_groups.jaccard_join(df)
    assert shuffle_bytes(spark) - before < 50_000
    assert spark.conf.get(DROP_SHUFFLES, None) == set_before
    assert {r["n_links"] for r in token_groups.clusters(join).collect()} == {1}
    assert {r["component_id"] for r in token_groups.clusters(join).collect()} == set(range(150))


def test_opened_returns_a_forest_of_exact_links():
    tokens = [np.arange(i, i + 20) for i in (0, 1, 2, 30)]
    block = pd.DataFrame({"set_id": [1, 2, 3, 4], "n": [20] * 4, "tokens": tokens})
    links = token_groups.opened(block, block)
    assert len(links) == 2 and {x for link in links for x in link} == {1, 2, 3}


def test_join_odd_rows(spark):
    df = odd_documents(spark)
    join = token_groups.jaccard_join(df)
    got = token_groups.clusters(join)
    assert got.count() == df.count()
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[2]["component_id"] == 1 and by_id[9]["n_shingles"] == 1
    assert by_id[3]["component_id"] == 3 and by_id[3]["n_shingles"] == 0
    kept = token_groups.deduplicated(df)
    assert kept.columns == df.columns
    texts = [r["text"] for r in kept.collect()]
    assert len([t for t in texts if t and t.startswith("the0")]) == 1
    assert sum(not (t or "").strip() for t in texts) == 4  # texts without words all stay
    assert token_groups.deduplicated(empty(spark, df.schema)).count() == 0


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 200)]
    links += [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(30)]
    got = {r["node"]: r["component"] for r in components.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[x] == 100 for x in range(100, 200))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_top(vectors, queries, k):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    out = []
    for q, a in queries:
        if q is None or not usable(a):
            continue
        scored = [(-sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b)), i)
                  for i, b in vectors if i is not None and i != q and usable(b) and len(a) == len(b)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BINS", 4)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 4)
    monkeypatch.setattr(topk, "SLICE", 7)
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 0.0, 0.0, 0.0]), (62, [float("nan")] * 5),
             (63, [float("inf")] + [0.0] * 4), (64, [1.0, 2.0]), (65, [3.0, -1.0]), (66, []),
             (None, [1.0] * 5), (7, rows[7][1]), (8, rows[9][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    queries = df.where("vec_id % 6 = 0")
    got = sorted(map(tuple, topk.top_k(df, queries, 3).collect()))
    assert got == brute_top(rows, [r for r in rows if r[0] is not None and r[0] % 6 == 0], 3)
    assert topk.top_k(df, queries, 500).count() == len(
        brute_top(rows, [r for r in rows if r[0] is not None and r[0] % 6 == 0], 500))
    assert topk.top_k(df.limit(0), queries.limit(0), 3).count() == 0


def test_top_k_large_values(spark):
    rows = [(0, [3e2, 1.0]), (1, [3e9, -2.0]), (2, [3e9, 5.0]), (3, [-1e3, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, df.where("vec_id = 0"), 2).collect()))
    assert got == brute_top(rows, rows[:1], 2)


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "com", "/de/")]


def test_url_verdicts(spark):
    urls = ["https://WWW.Spam.com/a/?utm_source=x&b=2&a=1#f", "http://spam.com:80/a?a=1&b=2",
            "http://example.org/es/1", "http://sub.example.org/en", "http://notexample.org.x/es/",
            "http://a.com/de/x", "http://a.com", None, "no scheme", "", "http://spam.com/a?a=1&b=3",
            "http://host?q=/x", "ftp://é.com/ÄB#x?y"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls + urls[:2])],
                                  "page_id long, url string, host string")
    listed = pages.where("page_id = 0").select(url_filter.canonical(pages["url"]).alias("url"))
    got = {r["page_id"]: r for r in url_filter.url_verdicts(pages, listed, RULES).collect()}
    assert len(got) == len(urls) + 2
    verdicts = [got[i]["verdict"] for i in range(len(urls))]
    assert verdicts == ["block", "block", "block", "allow", "allow", "block", "allow", "allow",
                        "allow", "allow", "allow", "allow", "allow"]
    assert got[0]["host"] == "www.spam.com" and got[0]["path"] == "/a/" and got[0]["listed"]
    assert got[2]["rule"] == "example.org/es/" and got[3]["rule"] == "org/" and got[6]["rule"] is None
    assert (got[7]["host"], got[7]["path"], got[8]["host"]) == ("", "", "")
    assert got[11]["host"] == "host" and got[11]["path"] == "" and got[12]["path"] == "/ÄB"
    nothing = url_filter.url_verdicts(empty(spark, pages.schema), listed, RULES)
    assert nothing.count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    from functools import reduce
    from operator import and_

    from pyspark.sql import functions as F
    urls = spark.range(20_000).select(F.concat(F.lit("h/"), "id").alias("url"))
    listed = urls.where("url like '%7'")
    blocks, n = url_filter.build_filter(listed, listed.count())
    passes = reduce(and_, [F.col(f"w{i}").bitwiseAND(w) == w
                           for i, w in enumerate(url_filter._words(F.col("url")))])
    possible = urls.withColumn("block", url_filter._block(F.col("url"), n)).join(
        blocks, "block").where(passes)
    hits = url_filter.listed_hits(urls, listed)
    assert hits.count() == listed.count() == possible.join(listed, "url", "left_semi").count()
    assert possible.count() < listed.count() + 0.02 * 20_000


@pytest.mark.parametrize("size", [2.0**18, 2.0**21, 2.0**22.4, 2.0**23])
def test_top_k_is_exact_up_to_64_bits_and_beyond(spark, size):
    """Components of 2**26 to 2**31: scores of up to 2**62, about 2**63, and more."""
    size = float(int(size))
    rows = [(0, [size, size])] + [(i, [size - i % 4, size - i // 4]) for i in range(1, 13)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    own = [256 * int(x) for x in rows[0][1]]
    exact = sorted(((-sum(a * 256 * int(x) for a, x in zip(own, v)), i) for i, v in rows[1:]))[:3]
    got = topk.top_k(df, df.where("vec_id = 0"), 3).orderBy("rank").collect()
    assert {r.vec_id for r in got} == {i for _, i in exact}
    assert [r.score for r in got] == [min(-s, 2**63 - 1) for s, _ in exact]
    if -exact[0][0] < 2**63:
        assert [r.vec_id for r in got] == [i for _, i in exact]
