import collections
import html
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import empty, odd_documents, prose
from tidylake.llm import html_text, mixing, sharding, toxicity
from tidylake.llm.common import word_count


def text(page, low=lambda p: False):
    return html_text.text_of(page, html_text.Paths(), low)


@pytest.mark.parametrize("page, want", [
    ("<p>Hello&nbsp;world &lt;x&gt;<!-- c --> a<b>b</b>c</p>", "Hello world <x> abc"),
    ("<ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table>", "one\n\ntwo\n\n1\n\n2\n\n3"),
    ('<div title="a>b">T</div><script>var x="</p>"</script><style>p{}</style>end', "T\n\nend"),
    ("<body class='has-sidebar'><div class='sidebar'>s</div><article><header><h1>T</h1></header><p>x"
     "</p><footer>f</footer><section class='comments'><p>c</p></section></article><div>out</div>",
     "T\n\nx"),
    ("<p><b>open<br><p>two", "open\n\ntwo"),
    ("<header>top</header><div id=cookieBanner>ok?</div><form>f</form><div>main</div><aside>s</aside>", "main"),
    ("<p>unclosed <a href=\"x>y</a> <p>two", "unclosed y\n\ntwo"),
    ("", ""), ("<", "<"), ("<!-- open <p>x", ""), ("plain &copy text", "plain © text"),
    ("<script>never closed <p>x", ""), ("a<br>b", "a b"), ("<div hidden>x</div><p style='display: none'>y</p>z", "z"),
])
def test_blocks(page, want):
    assert text(page) == want


@pytest.mark.parametrize("page, want", [
    ("<div class=content>" + "the body is here " * 5 + "</div><article class=card>teaser</article>",
     ("the body is here " * 5).strip() + "\n\nteaser"),
    ("<article><h2 id=related-work>Related work</h2><p>a b</p><h2 id=legal-status>Law</h2></article>",
     "Related work\n\na b\n\nLaw"),
    ("<article><section id=discussion><p>we find</p></section><section class=side-effects><p>pain</p>"
     "</section><section id=share-prices><p>up</p></section></article>", "we find\n\npain\n\nup"),
    ("<article><p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p><dialog open>d</dialog></article>",
     "let x=2 be\n\nd"),
    ("<article><p>a</p><div class=share-buttons>s</div><div id=comments>c</div></article>", "a"),
    ("<div>" * 300 + "deep<nav>menu<p>more</p></nav><div class=ad>buy</div>text" + "</div>" * 300,
     "deep\n\ntext"),
    ("<div>" * 300 + "out<main><p>one two</p><nav>m</nav></main>" + "</div>" * 300, "one two"),
])
def test_article_text_is_kept(page, want):
    assert text(page) == want


def test_doubtful_names_leave_it_to_the_tree():
    page = "<article><p>body text here</p><div class=related><p>more on this</p></div></article>"
    assert text(page) == "body text here\n\nmore on this"
    assert text(page, lambda p: True) == "body text here"


def test_hostile_pages_take_linear_time():
    for page in ('<a "' * 100_000, "<div>" * 20_000 + "x" + "</p>" * 20_000, "<p>" * 100_000,
                 "<!--" * 100_000, "<script>" * 50_000, "<b 'x>" * 50_000):
        text(page)


def site(n):
    """Pages of one host with an unmarked notice, changing menus, and no article."""
    rows = []
    for i in range(n):
        body = "".join(f"<p>{prose(12, 50 * i + j)}</p>" for j in range(1 + i % 3))
        rows.append((i, f"https://site.example/{i}",
                     f"<div class=x><span>All rights kept by us</span></div><nav>m{i}</nav>"
                     f"<div class=body>{body}</div>"))
    return rows


def test_style_tree_cuts_what_repeats(spark):
    pages = spark.createDataFrame(site(30), "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}
    for i, _, page in site(30):
        assert got[i] == "\n\n".join(re.findall(r"<p>(.*?)</p>", page))
    few = {r["page_id"]: r["text"] for r in html_text.main_text(pages.where("page_id < 5")).collect()}
    assert few[0].startswith("All rights kept by us\n\n")  # too few pages for a tree


def articles(n):
    """Pages of one host whose articles hold the same plea and the same heading."""
    plea = "<p class=x>Please subscribe to support us</p>"
    return [(i, f"https://paper.example/{i}",
             f"<article><h1>Story {i}</h1><p>{prose(12, 50 * i)}</p>{plea}<h2>Sources</h2>"
             f"<p>{prose(9, 50 * i + 7)}</p><p>{'Same on few pages' if i < 4 else prose(5, i)}</p></article>")
            for i in range(n)]


def test_repeated_texts_are_cut_inside_the_article(spark, monkeypatch):
    rows = articles(24)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: "\n\n".join(t for t in re.findall(r"<[ph][^>]*>(.*?)</", page) if "subscribe" not in t)
            for i, _, page in rows}
    assert {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()} == want
    monkeypatch.setattr(html_text, "MAX_BROADCAST_BRANCHES", -1)
    assert {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()} == want


def test_importance_equals_brute_force(spark):
    import math
    rows = site(24)
    got = {r["key"]: r for r in html_text.importance(spark.createDataFrame(
        rows, "page_id long, url string, html string")).collect()}
    paths = html_text.Paths()
    keys = html_text.Keys(paths)
    texts, styles, seen, kids = (collections.defaultdict(set) for _ in range(4))
    for i, _, page in rows:
        blocks, shows = html_text.walk(page, paths)
        for p, t in blocks:
            texts[p, t].add(i)
            seen[p].add(i)
        for p, s, n in shows:
            styles[p, s].add(i)
            kids[p].add((s, n))
            seen[p].add(i)
    content = {}
    for p in seen:
        logs = [math.log(len(x)) / math.log(max(2, len(seen[p]))) for (q, _), x in texts.items() if q == p]
        if logs:
            content[p] = (1 - sum(logs) / len(logs), len(logs))
    for p in seen:
        counts = [len(x) for (q, _), x in styles.items() if q == p]
        node = -sum(c / sum(counts) * math.log(c / sum(counts)) for c in counts) / math.log(len(seen[p])) if counts else 0
        below = [v for q, v in content.items() if q == p or p in paths.up[q]]
        mean = sum(c * n for c, n in below) / sum(n for _, n in below) if below else 0
        lengths = [n for _, n in kids[p]]
        weight = html_text.DECAY ** (sum(lengths) / len(lengths) if lengths else 0)
        want = (1 - weight) * node + weight * mean
        assert abs(got[keys.of("site.example", p)]["importance"] - want) < 1e-9


def test_html_odd_rows_and_join_path(spark, monkeypatch):
    rows = site(12) + [(None, None, None), (90, None, "<p>x"), (91, "https://other/", ""), (91, "https://other/", "")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    sent = html_text.main_text(pages).collect()
    monkeypatch.setattr(html_text, "MAX_BROADCAST_BRANCHES", -1)
    joined = html_text.main_text(pages).collect()
    assert sorted(map(repr, sent)) == sorted(map(repr, joined)) and len(sent) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in sent)
    assert html_text.main_text(empty(spark, pages.schema)).count() == 0


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        wide = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and rest * weight[s] / wide > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else rest * weight[s] / wide for s in names}
        capped |= over


def test_mixture(spark):
    rows = [(i, prose(5 + i % 40, i), ["a", "b", "c", None, "d"][min(i % 9, 4)]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(df).collect()
    sizes, taken = collections.Counter(), collections.Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"]
    want = brute_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 45, s  # the nearest whole document
    again = mixing.mixture(df.repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    copies = {r["doc_id"]: r["copies"] for r in got}
    mixed = collections.Counter(r["doc_id"] for r in mixing.mixed(df).collect())
    assert mixed == {i: n for i, n in copies.items() if n}


def test_mixture_odd_rows(spark):
    df = odd_documents(spark)
    got = mixing.mixture(df)
    assert got.count() == df.count()
    assert all(r["taken"] <= 2 * r["size"] for r in got.collect())
    assert mixing.mixed(df).columns == df.columns
    assert mixing.mixture(empty(spark, df.schema)).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert tuple(mixing.mixture(one).first())[2:] == (0, 0, 0.0, 0, 0)


def test_word_count(spark):
    df = spark.createDataFrame([("a b c\x1fd",), (None,), ("",), (" \t\n\x0b\x0c\r",), ("x" * 100_000,)], "t string")
    assert [r[0] for r in df.select(word_count(F.col("t"))).collect()] == [2, 0, 0, 0, 1]


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 37)
    rows = [(i, "hot" if i % 3 else f"s{i % 5}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = sharding.interleave(df, 24).collect()
    shards = collections.defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r)
    counts = [len(shards[s]) for s in range(24)]
    assert sum(counts) == 1000 and max(counts) - min(counts) <= 1
    mixture = collections.Counter(s for _, s in rows)
    for s in range(24):
        assert sorted(r["slot"] for r in shards[s]) == list(range(len(shards[s])))
        part = collections.Counter(r["source"] for r in shards[s])
        for source, n in mixture.items():
            assert abs(part[source] - n / 24) <= len(mixture) / 2
    again = sharding.interleave(df.repartition(7), 24).collect()
    assert sorted(got) == sorted(again)
    # ranks against brute force: by seeded key within a source, then by fraction
    keyed = df.select("doc_id", "source", sharding.hash_key(0, F.col("source"), F.col("doc_id"),
                                                            F.col("source")).alias("key")).collect()
    order = []
    for source in mixture:
        mine = sorted((r["key"], r["doc_id"]) for r in keyed if r["source"] == source)
        order += [((k + 0.5) / len(mine), "=" + source, d) for k, (_, d) in enumerate(mine)]
    place = {(r["shard"], r["slot"]): r["doc_id"] for r in got}
    assert [place[k] for k in sorted(place)] == [d for *_, d in sorted(order)]


def test_shards_odd_rows(spark):
    df = odd_documents(spark)
    got = sharding.interleave(df, 3)
    assert set(got.columns) == set(df.columns) and got.count() == df.count()
    assert {(r["shard"], r["slot"]) for r in got.collect()} == {(s, k) for s in range(3) for k in range(5)} - {(2, 4)}
    assert sharding.interleave(empty(spark, df.schema), 24).count() == 0
    repeated = spark.createDataFrame([(1, "a")] * 50, "doc_id long, source string")
    assert sharding.interleave(repeated, 24).select("shard", "slot").distinct().count() == 50


def toxic_corpus(spark):
    insults = ["grumbold", "snarfle", "wretchum", "blightard"]
    docs, labels = [], []
    for i in range(900):
        words = prose(40, i).split()
        bad = i % 5 == 0
        if bad:
            words[7 + i % 20] = insults[i % 4]
        docs.append((i, " ".join(words[:20]) + ". " + " ".join(words[20:]) + "."))
        labels.append((i, 1, int(bad)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_learns_and_tolerates_gaps(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.train(docs, labels)
    scored = toxicity.toxicity(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert len(scored) > 200
    assert all(r["predicted"] == r["toxic"] for r in scored)
    base = prose(30, 3)
    texts = [f"{base} grumxbold {base}", f"{base} s-n-a-r-f-l-e {base}", f"{base} w r e t c h u m {base}",
             f"{base} Bl1ghtard! {base}", base, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["score"] for r in toxicity.toxicity(df, model).orderBy("doc_id").collect()]
    assert min(got[:4]) > max(got[4:])


def test_toxicity_odd_rows(spark):
    df = odd_documents(spark)
    docs, labels = toxic_corpus(spark)
    model = toxicity.train(docs, labels)
    got = toxicity.toxicity(df, model)
    assert got.count() == df.count() and all(0 <= r["score"] <= 1 for r in got.collect())
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    assert toxicity.train(empty(spark, docs.schema), empty(spark, labels.schema)) is None
    assert {r["score"] for r in toxicity.toxicity(df, None).collect()} == {0.0}
    assert toxicity.toxicity(empty(spark, df.schema), model).count() == 0


def test_kernel_equals_brute_force():
    def grams(word):
        codes, out = toxicity._codes(word), collections.Counter()
        for i in range(len(codes)):
            for j in range(i + 1, min(len(codes), i + toxicity.SPAN)):
                for k in range(j + 1, min(len(codes), i + toxicity.SPAN)):
                    out[codes[i], codes[j], codes[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    words = ["idiot", "idxiot", "", "a", "réeux", "banana", "x" * 40]
    got = toxicity.kernel(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            x, y = grams(a), grams(b)
            norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
            want = sum(v * y[g] for g, v in x.items()) / norm if norm else 0
            assert abs(got[i, j] - want) < 1e-5


def test_entities_are_decoded_like_the_standard_library():
    assert text("<p>&amp;amp; &#x41;&notit; &eacute</p>") == " ".join(html.unescape("&amp;amp; &#x41;&notit; &eacute").split())
