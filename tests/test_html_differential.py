"""The table scanner against a reference built on the standard library's
``html.parser``: same tables on real pages and on random valid markup, and
linear time on hostile input."""

import random
import time
from html.parser import HTMLParser

import duckdb
import pytest

from tidylake.sources.html_tables import _grid, parse_tables


class ReferenceCollector(HTMLParser):
    """Straightforward html.parser-based table collector (test oracle)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.open, self.skip = [], [], 0

    @staticmethod
    def _span(attrs, name):
        for k, v in attrs:
            if k == name and v and v.strip()[:1].isdigit():
                digits = "".join(c for c in v.strip() if c.isdigit()) or "1"
                return max(1, int(digits))
        return 1

    def _close_cell(self, t):
        if t["cell"] is not None:
            t["row"].append(t["cell"])
            t["cell"] = None

    def _close_row(self, t):
        self._close_cell(t)
        if t["row"] is not None:
            self.tables[t["ix"]].append(t["row"])
            t["row"] = None

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "table":
            self.tables.append([])
            self.open.append({"ix": len(self.tables) - 1, "row": None, "cell": None})
        elif self.open and tag == "tr":
            self._close_row(self.open[-1])
            self.open[-1]["row"] = []
        elif self.open and tag in ("td", "th"):
            t = self.open[-1]
            self._close_cell(t)
            if t["row"] is None:
                t["row"] = []
            t["cell"] = [[], self._span(attrs, "colspan"), self._span(attrs, "rowspan")]

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif self.open and tag == "table":
            self._close_row(self.open.pop())
        elif self.open and tag == "tr":
            self._close_row(self.open[-1])
        elif self.open and tag in ("td", "th"):
            self._close_cell(self.open[-1])

    def handle_data(self, data):
        if not self.skip:
            for t in self.open:
                if t["cell"] is not None:
                    t["cell"][0].append(data)


def reference(html):
    if not html or "<table" not in html.lower():
        return []
    p = ReferenceCollector()
    p.feed(html)
    p.close()
    while p.open:
        p._close_row(p.open.pop())
    return [_grid(t) for t in p.tables]


TRICKY = [
    "<table><tr><th>​A</th><td>x &amp; y<td>z</tr><tr><td colspan=2>w</td></tr></table>",
    "<TABLE><TR><TD>a<table><tr><td>in</td></tr></table>b</TD></TR></TABLE>",
    "<script>var t='<table><tr><td>no</td></tr></table>';</script><table><tr><td>ok</td></tr></table>",
    "<table><tr><td title='a>b'>v</td></tr></table>",
    "<table><!-- <tr><td>hid</td></tr> --><tr><td rowspan='2'>r</td><td>c</td></tr>"
    "<tr><td>d</td></tr></table>",
    "<table><tr><td>unclosed", "<table><tr><td>&nbsp;&#233;&eacute</td></tr></table>",
    "<style>td{}</style><table><tbody><tr><td>x</td></tr></tbody><tfoot><tr><td>f</td></tr>"
    "</tfoot></table>",
]


def test_same_tables_on_real_pages():
    pages = [r[0] for r in duckdb.sql(
        "SELECT html FROM read_parquet('/root/testdata/sf0.001/pages.parquet')").fetchall()]
    rnd = random.Random(3)
    docs = [t + p for p in pages for t in rnd.sample(TRICKY, 2)] + TRICKY
    assert all(parse_tables(d) == reference(d) for d in docs)


VALID = ["<table>", "</table>", "<TABLE border=1>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>",
         "<td colspan=2>", "<td rowspan='3'>", "<td title=\"a>b\">", "<tbody>", "</tbody>", "<p>",
         "</p>", "<br>", "<br/>", "<!-- c <td>x</td> -->", "<script>if(a<b){'<table>'}</script>",
         "<style>td>p{}</style>", "text", " ", "\n", "&amp;", "&lt;", "&#233;", "&nbsp;",
         "a &lt; b", "<a href='/x'>link</a>", "<!DOCTYPE html>", "<td class=\"q'\">",
         "<img src=x alt='>'>"]


def test_same_tables_on_random_valid_markup():
    rnd = random.Random(11)
    for _ in range(3000):
        d = "".join(rnd.choice(VALID) for _ in range(rnd.randint(1, 40)))
        assert parse_tables(d) == reference(d), d


@pytest.mark.parametrize("doc", [
    "<a" * 200_000, '<p a="' * 100_000, '<td =" =" ' * 50_000, "<!--" * 100_000,
    "<table><script>" + "<table>" * 100_000, "<!x" * 100_000, "</ x" * 100_000,
])
def test_hostile_input_is_linear(doc):
    t0 = time.perf_counter()
    parse_tables("<table>" + doc)
    assert time.perf_counter() - t0 < 5
