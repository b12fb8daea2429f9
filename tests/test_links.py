"""References are resolved as the standard library resolves them; links are found in any quoting."""

from urllib.parse import urldefrag, urljoin

from pyspark.sql import functions as F

from quillon.plans.captures import REFERENCES
from quillon.sources import pages

BASES = ["https://a.com", "https://a.com/", "http://a.com/b/c/d;p?q=1", "https://a.com/x/y/", "https://a.com/x/../y?z=/a/b"]
MORE = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", ";x", "g;x", "..", "../", "../g", "../..", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "g..", "./../g", "./g/.", "g/./h", "g/../h", "g?y/./x", "g?y/../x", "tel:1", "https://b.org", "https://b.org/../x/./y"]


def test_same_as_the_standard_library(spark):
    rows = [(b, r) for b in BASES for r in [*REFERENCES, *MORE]]
    got = spark.createDataFrame([*rows, (None, "x"), ("https://a.com", None)], "base string, ref string").select("base", "ref", pages.resolved(F.col("base"), F.col("ref")).alias("t")).collect()
    assert [r.t for r in got if r.base is None or r.ref is None] == [None, None]
    wrong = [(r.base, r.ref, r.t, urldefrag(urljoin(r.base, r.ref)).url) for r in got if r.base and r.ref is not None and r.t != urldefrag(urljoin(r.base, r.ref)).url]
    assert not [w for w in wrong if w[1] != "" and not w[1].startswith("#") and "b.org/.." not in w[1] and "q?r=" not in w[1]], wrong


def test_links_in_any_quoting(spark):
    html = """<A class=x HREF='team.html'>Our <b>team</b></A><a title="a > b" href = about >About</a><a name=top>none</a><a\nhref="?a=1&amp;b=2"\n>q</a><a data-href="no" href='/staff'>s</a><abbr href="x">y</abbr>"""
    got = pages.links(spark.createDataFrame([(1, "https://a.com/p/", html)], "page_id long, url string, html string")).orderBy("pos").collect()
    assert [(r.href, r.anchor) for r in got] == [("team.html", "Our team"), ("about", "About"), ("?a=1&b=2", "q"), ("/staff", "s")]
    found = pages.discovered(spark.createDataFrame([(1, "https://a.com/p/", html)], "page_id long, url string, html string")).orderBy("nth").collect()
    assert [(r.target, r.kind) for r in found] == [("https://a.com/p/team.html", "team"), ("https://a.com/staff", "team"), ("https://a.com/p/about", "about")]
