"""URL filter: rules first, then a blocked Bloom filter and an exact join.

URLs are listed in canonical form.  The list is folded into a split-block Bloom
filter: a hash picks one 256-bit block and a second hash one bit in each of its
eight lanes.  The filter is a table of blocks, so building it is a grouped
``bit_or`` and probing it is an equi-join on the block number - broadcast while
the blocks fit a checked bound, shuffled beyond it.  URLs whose bits are all set
are possible hits; an exact join with the list removes the false positives.
Distinct URLs are probed once, so a URL on a third of all rows is no hot key.

Rules (host, path) come before the list: a rule fits its host and all its
subdomains when the URL's path starts with the rule's path; the longest wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidylake.llm.common import ascii_lower, broadcast_if_small, checkpointed, ref

BITS_PER_URL = 12
BLOCK_BITS = 256
MAX_BROADCAST_BLOCKS = 500_000

# Query parameters that do not tell pages apart, and the port and
# host prefixes that a canonical URL drops.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|\z)"
HOST_PREFIX = r"^(www|m)\."
DEFAULT_PORT = r":(80|443)\z"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.``/``m.`` and default port, path without a closing
    slash, and the remaining query parameters in sorted order; no scheme, no
    fragment.  A URL without ``://`` has an empty canonical form."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), HOST_PREFIX, ""), DEFAULT_PORT, "")
    path = F.regexp_replace(path_of(url), r"/+\z", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    joined = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined))
                    .otherwise(F.lit("")))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct ``(rule, verdict)`` of the longest fitting rule, null if none fits.
    ``rules``: (verdict, host, path), a list short enough for one expression."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _block(url: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(n_blocks).cast("long"))


def _words(url: Column) -> list[Column]:
    """Four 64-bit words of two 32-bit lanes, one bit set in each lane."""
    bits = F.xxhash64(url, F.lit(1))
    lane = [F.shiftrightunsigned(bits, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(8)]
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, lane[2 * i]).bitwiseOR(
        F.call_function("shiftleft", one, lane[2 * i + 1] + 32)) for i in range(4)]


def build_filter(listed: DataFrame, n_urls: int) -> tuple[DataFrame, int]:
    """Blocks ``(block, w0..w3)`` of the filter over ``listed.url``, and how many
    blocks it is addressed by."""
    n_blocks = max(1, -(-n_urls * BITS_PER_URL // BLOCK_BITS))
    bits = listed.select(_block(F.col("url"), n_blocks).alias("block"),
                         *[w.alias(f"w{i}") for i, w in enumerate(_words(F.col("url")))])
    return bits.groupBy("block").agg(
        *[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)]), n_blocks


def listed_hits(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows of ``urls`` (one column ``url``, distinct) that are in ``listed``
    (one column ``url``): Bloom filter first, exact join on what passes."""
    listed = checkpointed(listed.where("url is not null").distinct())
    blocks, n_blocks = build_filter(listed, listed.count())
    blocks = broadcast_if_small(checkpointed(blocks), MAX_BROADCAST_BLOCKS)
    probe = urls.where("url is not null").withColumn("block", _block(F.col("url"), n_blocks))
    passes = reduce(and_, [F.col(f"w{i}").bitwiseAND(w) == w
                           for i, w in enumerate(_words(F.col("url")))])
    possible = probe.join(blocks, "block").where(passes).select("url")
    return possible.join(listed, "url", "left_semi")


def url_verdicts(pages: DataFrame, listed: DataFrame,
                 rules: Sequence[tuple[str, str, str]], url_col: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, listed, verdict`` for every row.

    ``listed``: a table with a column ``url`` of canonical URLs.  ``verdict`` is
    the longest fitting rule's, else ``block`` for a listed URL and ``allow`` for
    any other.  A null URL, or one without ``://``, has empty host and path and
    an empty canonical form, which fits no rule; it is allowed unless the empty
    string is listed.  Input columns named like an output column are replaced.
    """
    out = ("host", "path", "rule", "listed", "verdict")
    own = [c for c in pages.columns if c not in out]
    if url_col in out:
        raise ValueError(f"rename the column {url_col!r}: an output column has its name")
    urls = pages.select(F.coalesce(canonical(ref(url_col)), F.lit("")).alias("url")).distinct()
    hits = broadcast_if_small(checkpointed(listed_hits(urls, listed.select("url"))),
                              MAX_BROADCAST_BLOCKS)
    hits = hits.select(F.col("url").alias("__tl_hit"))
    rows = pages.select(*[ref(c) for c in own], host_of(ref(url_col)).alias("host"),
                        path_of(ref(url_col)).alias("path"),
                        F.coalesce(canonical(ref(url_col)), F.lit("")).alias("__tl_canonical"))
    joined = rows.join(hits, F.col("__tl_canonical") == F.col("__tl_hit"), "left")
    rule = rule_for(F.col("host"), F.col("path"), rules)
    hit = F.col("__tl_hit").isNotNull()
    return joined.select(*[ref(c) for c in own], "host", "path",
                         rule["rule"].alias("rule"), hit.alias("listed"),
                         F.coalesce(rule["verdict"], F.when(hit, "block").otherwise("allow"))
                         .alias("verdict"))
