"""Captured pages: title, text and links of HTML, addresses, quality, stitching."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.plan import once
from quillon.functions.text import registered_domain
from quillon.operators.keyed import latest

# Words in a link that tell what its page is about, in the order in which they are tried.
LINK_KINDS = {
    "team": "team|people|leadership|who-we-are|partners|professionals|principals|management|bios|biograph|staff",
    "about": "about|firm|company|overview|story|mission",
    "strategy": "strategy|approach|investment|philosophy|what-we-do|services|focus",
    "contact": "contact|connect|get-in-touch",
}
SOCIAL = "(?i)(linkedin|twitter|x\\.com|facebook|instagram|youtube|plus\\.google|bizapedia|yelp|crunchbase|bloomberg\\.com)"
MAX_TEXT, STITCH_BUDGET, MAX_LINKS = 20_000, 16_000, 4


def title(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1), "\\s+", " "))


def text(html: Column) -> Column:
    """Visible text by patterns: scripts, styles and tags out, white space evened, cut at the cap."""
    bare = F.regexp_replace(F.regexp_replace(html, "(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>", " "), "(?s)<[^>]*>", " ")
    return F.substring(F.trim(F.regexp_replace(bare, "\\s+", " ")), 1, MAX_TEXT)


def link_kind(hay: Column) -> Column:
    out = F.when(F.lit(False), None)
    for kind, words in LINK_KINDS.items():
        out = out.when(hay.rlike(words), kind)
    return out


def _segments(path: Column) -> Column:
    """A rooted path without its dot segments; what leads above the root is ignored."""
    kept = F.aggregate(
        F.slice(F.split(path, "/"), 2, 1_000_000), F.array(F.lit("")),
        lambda held, s: F.when(s == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(1)))).when(s == ".", held).otherwise(F.concat(held, F.array(s))),
    )
    return F.concat(F.array_join(kept, "/"), F.when(path.rlike("/\\.{1,2}$"), "/").otherwise(""))


def resolved(base: Column, reference: Column) -> Column:
    """The address that a reference stands for on a page at `base` (http or https), without a fragment, after RFC 3986.

    References may be absolute, without a scheme, rooted, relative or queries only; an empty one is the page itself. One
    of another scheme stays as it is. Null if either is null.
    """
    ref, origin = F.regexp_replace(F.trim(reference), "#.*$", ""), F.regexp_extract(base, "^(https?://[^/?#]*)", 1)
    path_of = lambda url: F.regexp_extract(url, "^https?://[^/?#]*([^?#]*)", 1)
    query_of = lambda url: F.regexp_extract(url, "^[^?#]*(\\?[^#]*)?", 1)
    clean = lambda url: F.concat(F.regexp_extract(url, "^(https?://[^/?#]*)", 1), F.when(path_of(url) == "", "").otherwise(_segments(path_of(url))), query_of(url))
    own, said = path_of(base), F.regexp_extract(ref, "^([^?]*)", 1)
    merged = F.concat(F.when(own == "", "/").otherwise(F.regexp_extract(own, "^(.*/)", 1)), said)
    return (
        F.when(ref.rlike("^(?i)https?://"), clean(ref))
        .when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), clean(F.concat(F.regexp_extract(base, "^(https?:)", 1), ref)))
        .when(said == "", F.concat(origin, own, F.when(ref == "", query_of(base)).otherwise(ref)))
        .when(said.startswith("/"), F.concat(origin, _segments(said), query_of(ref)))
        .otherwise(F.concat(origin, _segments(merged), query_of(ref)))
    )


#: A tag's attributes in any quoting; a ">" within quotes does not end the tag.
ATTRIBUTES = "(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
ATTRIBUTE = "(?s)[^\\s=\"'/]+(?:\\s*=\\s*(?:\"[^\"]*\"|'[^']*'|[^\\s\"']+))?"


def links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, href, anchor) of each link of pages (page_id, html), whatever its quotes and the order of its attributes."""
    found = F.regexp_extract_all("html", F.lit(f"(?is)<a\\s{ATTRIBUTES}>.*?</a>"), F.lit(0))
    each = pages.select("page_id", "url", F.posexplode(found).alias("pos", "a"))
    given = F.regexp_extract_all(F.regexp_extract("a", f"(?is)^<a\\s({ATTRIBUTES})>", 1), F.lit(ATTRIBUTE), F.lit(0))
    href = F.regexp_replace(F.get(F.filter(given, lambda x: x.rlike("(?is)^href\\s*=")), F.lit(0)), "(?is)^href\\s*=\\s*", "")
    plain = F.replace(F.trim(F.regexp_replace(href, "^[\"']|[\"']$", "")), F.lit("&amp;"), F.lit("&"))
    told = F.trim(F.regexp_replace(F.regexp_replace("a", f"(?is)^<a\\s{ATTRIBUTES}>", ""), "(?s)<[^>]*>", ""))
    return each.select("page_id", "url", "pos", plain.alias("href"), told.alias("anchor")).filter("href is not null")


def discovered(pages: DataFrame, most: int = MAX_LINKS) -> DataFrame:
    """Internal links worth following: same domain, a known kind, once per address, by kind and place, at most `most` a page."""
    bare = lambda url: F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "/+$", "")
    known = once(links(pages), {"target": bare(resolved(F.col("url"), F.col("href")))}).filter(F.col("target").rlike("^https?://"))
    own = known.filter(registered_domain(F.col("target")) == registered_domain(F.col("url"))).filter(F.col("target") != bare(F.col("url")))
    kinds = own.withColumn("kind", link_kind(F.lower(F.concat_ws(" ", "href", "anchor")))).filter("kind is not null")
    first = latest(kinds, ["page_id", "target"], F.asc("pos"))
    order = F.array_position(F.array(*map(F.lit, LINK_KINDS)), F.col("kind"))
    return first.withColumn("nth", F.row_number().over(Window.partitionBy("page_id").orderBy(order, "pos"))).filter(F.col("nth") <= most).select("page_id", "nth", "target", "kind")


class _Reader(HTMLParser):
    """Title and visible text, with entities resolved; tolerant of broken markup."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.in_title, self.title, self.parts = 0, False, [], []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "noscript")
        self.in_title |= tag == "title"

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "noscript") and self.hidden > 0
        self.in_title &= tag != "title"

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.hidden:
            self.parts.append(data)


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, title, text) by a real parser, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page_id, html in zip(batch["page_id"], batch["html"]):
                reader = _Reader()
                reader.feed(html or "")
                reader.close()
                rows.append((page_id, " ".join(" ".join(reader.title).split()), " ".join(" ".join(reader.parts).split())[:MAX_TEXT]))
            yield pd.DataFrame(rows, columns=["page_id", "title", "text"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, title string, text string")


def quality(captures: DataFrame) -> DataFrame:
    """Level of evidence from the newest captures (key, url, status, insecure, kind, id) of each address of a key."""
    newest = latest(captures, ["key", "url"], F.desc("id"))
    sums = newest.groupBy("key").agg(F.count("*").alias("pages"), F.bool_or((F.col("kind") == "home") & (F.col("status") == 200)).alias("home"), F.bool_or("insecure").alias("insecure"))
    level = F.when(~F.col("home"), "unreachable").when(F.col("insecure"), "insecure").when(F.col("pages") >= 3, "full").otherwise("partial")
    return sums.select("key", "pages", level.alias("level"))


def stitched(pages: DataFrame, budget: int = STITCH_BUDGET) -> DataFrame:
    """Texts of a key's pages (key, pos, kind, text) in order under headers, until the budget of characters is used up.

    Headers are not charged; a page past the budget adds no text, but is still counted.
    """
    before = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    left = F.greatest(F.lit(0), budget - F.coalesce(F.sum(F.length("text")).over(before), F.lit(0))).cast("int")
    parts = pages.withColumn("part", F.expr("text")).withColumn("left", left).withColumn("part", F.when(F.col("left") > 0, F.concat(F.lit("["), "kind", F.lit("] "), F.left("text", F.col("left")))))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "part")))
    return parts.groupBy("key").agg(F.array_join(F.filter(F.transform(ordered, lambda x: x["part"]), lambda p: p.isNotNull()), "\n").alias("stitched"), F.count("*").alias("pages"))


def spans(texts: DataFrame, pattern: str, around: int = 80, most: int = 3, rows: int = 500) -> DataFrame:
    """(id, spans): up to `most` matches with `around` characters on either side; contexts may overlap, so by a function in
    Python, which holds one text at a time beside its Arrow batch."""
    import re

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(pattern)

        def found(t: str) -> list[str]:
            return [" ".join(t[max(0, m.start() - around) : m.end() + around].split()) for m, _ in zip(find.finditer(t), range(most))]

        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.slice(at, rows)
                out = pa.array([found(t.as_py() or "") for t in part.column("text")], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column("id").cast(pa.int64()), out], ["id", "spans"])

    return texts.select("id", "text").mapInArrow(run, "id long, spans array<string>")
