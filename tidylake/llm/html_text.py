"""Main text of web pages by a site style tree.

The DOM trees of a host's pages are merged: elements with the same path of tags,
classes and ids are one element node, with the child sequences (presentation)
and the texts (content) that its pages show there.  Template parts look the same
on page after page, main content does not, which entropy measures:

* presentation importance of an element on m pages: the entropy, to base m, of
  its child sequences;
* content importance of an element with texts: one minus the mean, over its
  distinct texts, of the text's entropy over the pages, log n / log m for a text
  on n of m pages;
* composite importance: presentation weighs 1 - g^l and what lies below g^l, for
  l children.

Branches of low composite importance are cut from each page, and single texts that
most pages with their element show, also inside the article.  A tree says
nothing about hosts with few pages, and nothing about template parts with
changing text, so an element's presentation also counts by its meaning: tags,
roles and names of menus, notices, adverts, forms, comments and the like have
importance 0.  Inside article and main, a name that can also be a topic (``side``,
``related``), and any id that is not made of such words alone, is only a prior: the
element is judged by its importance; names of headings say nothing.
An article or main is preferred to the rest of the page where it holds most of the
words of high importance.  In article and main, the element of a heading or paragraph is kept
whatever its importance, and only its repeated texts are cut; headings, cells and
terms, which recur by nature, are kept altogether.

Trees are merged by Spark: tasks emit hashes of (host, path) with hashes of what
a page shows there, and grouped counts give the entropies, so a host with a
third of all pages is spread over its texts.  Pages are never shuffled: the low
branches, a list that a checked bound keeps small, are sent to the tasks that
read the pages again.  Above the bound they are joined by host, salted.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidylake.llm.common import checkpointed, ref

LOW_IMPORTANCE = 0.2
MIN_PAGES = 10
DECAY = 0.9
MAX_BROADCAST_BRANCHES = 1_000_000
SALTS = 32
REMEMBERED_PATHS = 100_000
#: Elements nested deeper belong to the node at this depth.
MAX_DEPTH = 256

# Element names and their roles in HTML.
VOID = set("area base basefont bgsound br col embed frame hr img input keygen link meta param "
           "source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label "
             "mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
             "input math annotation semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle "
             "merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts "
             "mprescripts mtable mtr mtd menclose".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset "
               "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav "
               "ol p pre section table ul".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_STOP = set("ul ol dl table select body html article section div".split())
# What marks an element as no main content.
NOISE_TAGS = set("head nav footer aside form script style noscript template button select "
                 "textarea iframe svg math object embed dialog menu title annotation".split())
# Of these, what can be a part of an article.
NOISE_OUTSIDE = {"header", "math", "dialog"}
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog "
                  "alert menu menubar toolbar tablist".split())
NOISE_WORDS = set("ad ads adv advert adverts advertisement advertisements advertising adsense "
                  "banner banners sponsor sponsors sponsored promo promos promotion sidebar side "
                  "rail menu menus nav navbar navigation breadcrumb breadcrumbs cookie cookies "
                  "consent gdpr notice notices notification alert popup modal overlay newsletter "
                  "subscribe subscription signup login share sharing social comment comments "
                  "commentlist reply replies respond disqus discussion related recommended "
                  "recommendations footer masthead topbar toolbar widget widgets pagination pager "
                  "copyright legal disclaimer hidden skip".split())
# Of these, what can be a topic or a part of an article.
TOPIC_WORDS = set("side rail related recommended recommendations legal discussion disclaimer "
                  "notice notices notification alert skip social sharing copyright reply replies "
                  "respond overlay modal login menu menus navigation promotion sponsor sponsors "
                  "consent".split())
DENIALS = {"no", "with", "without", "has", "article", "post", "entry"}
MAIN_TAGS = {"article", "main"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
KEPT_TAGS = set("h1 h2 h3 h4 h5 h6 p blockquote pre li dt dd td th figcaption".split())

#: Of these, what stays although most pages of the host show the same text.
LABEL_TAGS = set("h1 h2 h3 h4 h5 h6 pre dt dd td th".split())

_TAG = re.compile(r"""<(?:!--|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"<>]*+"|'[^'<>]*+')*+)(>?)|[!?/])""")
_ATTRIBUTE = re.compile(
    r"""\b(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
    re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _means_noise(names: str, in_main: bool, anchor: bool = False) -> bool | None:
    """Whether one of the class or id names says that an element is no main
    content; names like ``no-sidebar`` or ``with-menu`` say nothing.  Inside the
    main part, None is a mere sign of it: a word that can be a topic, or an id
    (``anchor``) with other words."""
    sign = False
    for name in names.split():
        words = {w.lower() for w in _NAME.findall(name)}
        if not words.isdisjoint(NOISE_WORDS) or ("header" in words and not in_main):
            if words.isdisjoint(DENIALS):
                verdict = words & (NOISE_WORDS - TOPIC_WORDS)
                if not in_main or (verdict and (not anchor or words <= NOISE_WORDS)):
                    return True
                sign = None
    return sign


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _hash(text: str) -> int:
    return _signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")))


class Paths:
    """Element paths met by a worker, numbered; 0 is the root."""

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.known: dict[tuple[int, str, str], int] = {}
        self.parent, self.label = [0], [""]
        self.noise, self.main, self.kept, self.labels = [False], [False], [False], [False]
        self.doubtful = [False]
        self.up: list[list[int]] = [[]]

    def child(self, parent: int, tag: str, attributes: str) -> int:
        """Path of an element by its tag and attributes (inline elements that
        mean nothing share their parent's path)."""
        key = (parent, tag, attributes)
        found = self.known.get(key)
        if found is not None:
            return found
        in_main, doubtful = self.main[parent], False
        label, noise = tag, (tag in NOISE_TAGS or tag == "header") and not (
            in_main and tag in NOISE_OUTSIDE)
        if attributes:
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, names = name.lower(), "".join(values)
                value = names.lower()
                if name in ("class", "id"):
                    label += ("." if name == "class" else "#") + value
                    # a class of the page, its body or its main part says nothing
                    if tag not in ("html", "body", "main") and not (in_main and tag in HEADINGS):
                        means = _means_noise(names, in_main, name == "id")
                        noise |= bool(means)
                        doubtful |= means is None
                elif name == "role":
                    noise |= value in NOISE_ROLES
                elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                    noise = True
                elif name == "style":
                    noise |= "display:none" in value.replace(" ", "")
        in_noise = noise or (self.noise[parent] and tag != "main")
        now_main = in_main or (tag in MAIN_TAGS and not noise)
        deep = len(self.up[parent]) >= MAX_DEPTH
        if deep:  # one node at this depth for all elements with the same flags
            label = f"{self.label[parent].split(chr(1))[0]}\1{in_noise:d}{now_main:d}"
        if (tag in INLINE and not noise) or (
                deep and (in_noise, now_main) == (self.noise[parent], in_main)):
            path = parent
        else:
            above = self.parent[parent] if deep else parent
            same = (above, label, "\0")
            path = self.known.get(same)
            if path is None:
                path = self.known[same] = len(self.parent)
                self.parent.append(above)
                self.label.append(label)
                self.noise.append(in_noise)
                self.main.append(now_main)
                self.doubtful.append(doubtful or self.doubtful[parent])
                self.kept.append(now_main and tag in KEPT_TAGS and not self.doubtful[path])
                self.labels.append((self.labels[parent] or tag in LABEL_TAGS)
                                   and not self.doubtful[path])
                self.up.append(self.up[parent] if deep else [*self.up[parent], parent] if parent else [])
        self.known[key] = path
        return path

    def name(self, path: int) -> str:
        return ">".join(self.label[p] for p in (*self.up[path], path))


def walk(html: str, paths: Paths) -> tuple[list[tuple[int, str]], list[tuple[int, int, int]]]:
    """Blocks ``(path, text)`` in page order without those in noise, and the
    presentations ``(path, hash of the child sequence, children)``."""
    blocks: list[tuple[int, str]] = []
    shows: list[tuple[int, int, int]] = []
    # open elements: tag, path, hash of child sequence so far, children
    stack: list[list] = [["", 0, 0, 0]]
    buffer: list[str] = []
    at, here, size = 0, 0, len(html)
    noise, missing = paths.noise, set()
    opened: Counter[str] = Counter()

    def flush() -> None:
        text = "".join(buffer)
        buffer.clear()
        text = " ".join((entities.unescape(text) if "&" in text else text).split())
        if text:
            blocks.append((here, text))

    def pop() -> None:
        tag, path, sequence, n = stack.pop()
        opened[tag] -= 1
        if path != stack[-1][1] and not noise[path]:
            shows.append((path, sequence, n))

    def block_path() -> int:
        for tag, path, _, _ in reversed(stack):
            if tag not in INLINE:
                return path
        return 0

    while at < size:
        m = _TAG.search(html, at)
        end = m.start() if m else size
        if end > at and not noise[stack[-1][1]]:
            buffer.append(html[at:end])
        if not m:
            break
        at = m.end()
        closing, tag, attributes, closed = m.groups()
        if tag is None:
            mark = html[end:at]
            stop = "-->" if mark == "<!--" else ">"
            if stop == "-->" and html.startswith((">", "->"), at):
                at = html.find(">", at) + 1
                continue
            found = -1 if stop in missing else html.find(stop, at)
            if found < 0:
                missing.add(stop)
                # an unclosed comment or declaration ends the page
                at = size
            else:
                at = found + len(stop)
            continue
        if not closed:  # a quoted value with < or > in it, or no end
            quote = html[at:at + 1]
            while quote in ("'", '"') and quote not in missing:
                found = html.find(quote, at + 1)
                if found < 0:
                    missing.add(quote)
                    break
                rest = _TAG_REST.match(html, found + 1)
                at, quote = rest.end(), html[rest.end():rest.end() + 1]
            found = -1 if ">" in missing else html.find(">", at)
            if found < 0:
                missing.add(">")
                break
            attributes, at = html[m.start(3):found], found + 1
        tag = tag.lower()
        inline = tag in INLINE
        if closing:
            if tag == "br":
                buffer.append(" ")
            elif opened[tag] > 0:
                if not inline:
                    flush()
                while stack[-1][0] != tag:
                    pop()
                pop()
                if not inline:
                    here = block_path()
            continue
        if tag in ("br", "img", "input", "wbr"):
            if tag == "br":
                buffer.append(" ")
            continue
        if not inline:
            flush()
            if tag in CLOSES_P and opened["p"] > 0:
                # a paragraph ends where a block begins, unless it is further out
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == "p":
                        while len(stack) > depth:
                            pop()
                        break
                    if stack[depth][0] in ("button", "td", "th", "table", "object", "caption"):
                        break
            elif tag in ENDS:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in ENDS[tag]:
                        while len(stack) > depth:
                            pop()
                        if tag != "tr":
                            break
                        continue
                    if stack[depth][0] in ENDS_STOP:
                        break
            elif tag == "body":
                while len(stack) > 1 and stack[-1][0] != "html":
                    pop()
        top = stack[-1]
        path = paths.child(top[1], tag, attributes)
        if path != top[1]:
            top[2] = (top[2] * 1_000_003 + path_hash(paths, path)) & 0xFFFFFFFFFFFFFFFF
            top[3] += 1
        if tag in VOID:
            if not inline:
                here = block_path()
            continue
        if tag in RAW:
            close = "</" + tag
            found = -1 if close in missing else _find_close(html, close, at)
            if found < 0:
                missing.add(close)
                break
            at = found
            gone = html.find(">", at)
            at = size if gone < 0 else gone + 1
            if not inline:
                here = block_path()
            continue
        stack.append([tag, path, 0, 0])
        opened[tag] += 1
        if not inline:
            here = path
    flush()
    while len(stack) > 1:
        pop()
    return [b for b in blocks if not noise[b[0]]], shows


_TAG_REST = re.compile(r"""(?:[^>"']++|"[^"<>]*+"|'[^'<>]*+')*+""")


def _find_close(html: str, close: str, at: int) -> int:
    found = re.compile(close, re.I).search(html, at)
    return found.start() if found else -1


def path_hash(paths: Paths, path: int) -> int:
    return _hash(paths.label[path]) & 0xFFFFFFFFFFFFFFFF


def host_key(url: str | None) -> str:
    """The host of a URL, lower-cased (empty without ``://``)."""
    _, mark, rest = (url or "").partition("://")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower() if mark else ""


class Keys:
    """64-bit keys of (host, path)."""

    def __init__(self, paths: Paths):
        self.paths, self.known = paths, {}

    def of(self, host: str, path: int) -> int:
        key = self.known.get((host, path))
        if key is None:
            key = self.known[host, path] = _hash(host + "\n" + self.paths.name(path))
        return key


def text_key(element: int, text: str) -> int:
    """64-bit key of a text at an element (by the element's key)."""
    return _signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"),
                                            seed=element & 0xFFFFFFFFFFFFFFFF))


_WORKER: list = []


def _worker() -> tuple[Paths, Keys]:
    """Paths and keys that this Python worker has met, dropped when many."""
    if not _WORKER or len(_WORKER[0].known) + len(_WORKER[1].known) > REMEMBERED_PATHS:
        _WORKER[:] = [paths := Paths(), Keys(paths)]
    return _WORKER[0], _WORKER[1]


_SEEN = "key long, kind int, feature long, children int, up array<long>"
_ELEMENT, _STYLE, _TEXT = 0, 1, 2


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each page shows at each element, each thing once per page."""
    for batch in batches:
        rows: list[tuple] = []
        for url, html in zip(batch.column(0), batch.column(1)):
            paths, keys = _worker()
            host = host_key(url.as_py())
            blocks, shows = walk(html.as_py() or "", paths)
            rows += {(key := keys.of(host, p), _TEXT, text_key(key, t), 0, None) for p, t in blocks}
            rows += {(keys.of(host, p), _STYLE, _signed(s), n, None) for p, s, n in shows}
            elements = {p for p, _ in blocks} | {p for p, _, _ in shows}
            rows += [(keys.of(host, p), _ELEMENT, 0, 0, [keys.of(host, u) for u in paths.up[p]])
                     for p in elements]
            if len(rows) > 50_000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
    columns = list(zip(*rows)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["key", "kind", "feature", "children", "up"])


def _counted(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """On how many pages an element shows a thing: ``key, kind, feature, n, ...``."""
    seen = pages.select(ref(url_col).alias("url"), ref(html_col).alias("html")).mapInArrow(
        _observed, _SEEN)
    return checkpointed(seen.groupBy("key", "kind", "feature").agg(
        F.count(F.lit(1)).alias("n"), F.max("children").alias("children"), F.max("up").alias("up")))


def importance(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``key, pages, importance`` of every element node of the merged trees."""
    return _importance(_counted(pages, url_col, html_col))


def repeated_texts(counted: DataFrame, elements: DataFrame) -> DataFrame:
    """``key`` (:func:`text_key`) of texts that more than half of the pages with
    their element show, and whose content importance there is low."""
    often = counted.where((F.col("kind") == _TEXT) & (F.col("n") > MIN_PAGES / 2)).select(
        "key", F.col("feature"), "n")
    enough = elements.where(F.col("pages") >= MIN_PAGES).select("key", "pages")
    content = 1 - F.log(F.col("n").cast("double")) / F.log(F.col("pages").cast("double"))
    return often.join(enough, "key").where(
        (2 * F.col("n") > F.col("pages")) & (content <= LOW_IMPORTANCE)).select(
        F.col("feature").alias("key"))


def _importance(counted: DataFrame) -> DataFrame:
    def only(kind: int, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    n = F.col("n").cast("double")
    per = checkpointed(counted.groupBy("key").agg(
        F.max(only(_ELEMENT, F.col("n"))).alias("pages"),
        F.max(only(_ELEMENT, F.col("up"))).alias("up"),
        F.sum(only(_STYLE, n)).alias("styles"),
        F.sum(only(_STYLE, n * F.log(n))).alias("style_logs"),
        F.avg(only(_STYLE, F.col("children"))).alias("children"),
        F.count(only(_TEXT, n)).alias("texts"),
        F.sum(only(_TEXT, F.log(n))).alias("text_logs")))
    base = F.log(F.greatest(F.col("pages"), F.lit(2)).cast("double"))
    alone = F.col("pages") < 2
    per = per.select(
        "key", "pages", "up", "children", "texts",
        F.when(alone, 1.0).otherwise(
            (F.log("styles") - F.col("style_logs") / F.col("styles")) / base).alias("node"),
        F.when(alone, 1.0).otherwise(
            1 - F.col("text_logs") / F.col("texts") / base).alias("content"))
    # what lies below an element: the texts of the element and its descendants
    below = (per.where("texts > 0")
             .select(F.explode(F.concat(F.array("key"), F.coalesce("up", F.array().cast("array<long>"))))
                     .alias("key"), "content", "texts")
             .groupBy("key").agg((F.sum(F.col("content") * F.col("texts")) / F.sum("texts"))
                                 .alias("below")))
    weight = F.pow(F.lit(DECAY), F.coalesce("children", F.lit(0)))
    composite = (1 - weight) * F.coalesce("node", F.lit(0.0)) + weight * F.coalesce("below", F.lit(0.0))
    return per.join(below, "key", "left").select("key", "pages", composite.alias("importance"))


def text_of(html: str, paths: Paths, is_low, is_repeated=lambda path, text: False) -> str:
    """A page's main text; ``is_low(path)`` tells branches of low importance,
    ``is_repeated(path, text)`` texts that the host's pages repeat."""
    blocks, _ = walk(html, paths)
    high = [(p, t) for p, t in blocks if (paths.kept[p] or not is_low(p)) and (
        (paths.main[p] and paths.labels[p]) or not is_repeated(p, t))]
    main = [(p, t) for p, t in high if paths.main[p]]
    words = sum(len(t.split()) for _, t in high)
    # an article or main with most of the words is the main text
    if 2 * sum(len(t.split()) for _, t in main) > words:
        high = main
    return "\n\n".join(t for _, t in high)


def _texts(urls: pa.Array, pages: pa.Array, low_of) -> pa.Array:
    out = []
    for i, (url, html) in enumerate(zip(urls, pages)):
        paths, keys = _worker()
        low, host = low_of(i), host_key(url.as_py())
        out.append(text_of(
            html.as_py() or "", paths,
            lambda p: any(keys.of(host, q) in low for q in (p, *paths.up[p])),
            lambda p, t: text_key(keys.of(host, p), t) in low))
    return pa.array(out, pa.string())


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    ``text`` holds the blocks of the main text joined by two line breaks: in a
    block, character references are decoded and white space is one space.  A page
    whose blocks are all cut, and a null or empty page, has an empty text.  A
    null URL counts as a host of its own.  Repeated rows give repeated results
    (each counts as a page of its host); an empty table gives none; other
    columns play no part, whatever their names.
    """
    spark = pages.sparkSession
    counted = _counted(pages, url_col, html_col)
    elements = checkpointed(_importance(counted))
    low = checkpointed(elements.where(
        (F.col("pages") >= MIN_PAGES) & (F.col("importance") <= LOW_IMPORTANCE)).select("key").union(
        repeated_texts(counted, elements)))
    rows = pages.select(ref(id_col).alias("page_id"), ref(url_col).alias("url"),
                        ref(html_col).alias("html"))
    kinds = dict(rows.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"

    def result(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        sizes = pa.array([len(t.as_py()) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, sizes],
                                          names=["page_id", "url", "text", "n_chars"])

    if low.count() <= MAX_BROADCAST_BRANCHES:
        shared = spark.sparkContext.broadcast(
            frozenset(low.toArrow()["key"].to_pylist()))  # bounded just above

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield result(batch, _texts(batch.column(1), batch.column(2),
                                           lambda i: shared.value))
        return rows.mapInArrow(run, schema)
    return _joined_text(rows, low, schema, result)


def _joined_text(rows: DataFrame, low: DataFrame, schema: str, result) -> DataFrame:
    """The same where the low branches are too many to send: each page meets
    those of its host, found by the element keys that its host's pages show."""
    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for url, html in zip(batch.column(0), batch.column(1)):
                paths, keys = _worker()
                host = host_key(url.as_py())
                blocks, shows = walk(html.as_py() or "", paths)
                for p in {p for p, _ in blocks} | {p for p, _, _ in shows}:
                    found.add((host, keys.of(host, p)))
                found |= {(host, text_key(keys.of(host, p), t)) for p, t in blocks}
            hosts, held = zip(*found) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()),
                                              pa.array(held, pa.int64())], names=["host", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            yield result(batch, _texts(batch.column(1), batch.column(2),
                                       lambda i: set(lists[i].as_py() or ())))

    by_host = (rows.select("url", "html").mapInArrow(keys_of, "host string, key long").distinct()
               .join(low, "key", "left_semi").groupBy("host")
               .agg(F.collect_list("key").alias("low")))
    spread = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rest = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    salted = rows.withColumn("host", F.lower(rest)).withColumn(
        "salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return salted.join(spread, ["host", "salt"], "left").select(
        "page_id", "url", "html", "low").mapInArrow(run, schema)
