import base64
from urllib.parse import unquote, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from sigil.functions import urls


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


TEXTS = ["a+b", "%zz", "a%20b", "caf%C3%A9", "100%", "%2Bx", "", "%", "%4", "a%41%42c"]


def test_percent_decode(spark):
    assert column(spark, TEXTS, urls.percent_decode) == [unquote(t) for t in TEXTS]


def host(s):
    s = unquote(s).strip()
    if not s:
        return None
    s = s if s.startswith(("http://", "https://", "//")) else "http://" + s
    h = urlparse(s).netloc.lower()
    return h.removeprefix("www.") or None


def test_to_host(spark):
    values = ["example.com", " HTTP://x", "https://www.Example.com:8080/a?b#c", "//user:pw@www.host.org/x", "\t www.www.a.b \n", "", "  ", "a_b.com", "http://", "https%3A%2F%2Fq.com%2Fz", "www.a%2fb"]
    assert column(spark, values, urls.to_host) == [host(v) for v in values]
    assert column(spark, [None], urls.to_host) == [None]


def test_to_root(spark):
    given = {"example.com": "example", "shop.example.co.uk": "example", "example.de": "example", "localhost": "localhost", "10.0.0.1": "10.0.0.1", "a.b.unknown": "unknown", "x.example.org:80": "example", "me:pw@example.net": "example", "co.uk": None, "com": None}
    assert column(spark, list(given), urls.to_root) == list(given.values())


def test_to_root_of_further_suffixes(spark):
    given = {"www.example.go.jp": "example", "a.example.go.kr": "example", "example.go.id": "example", "b.example.go.th": "example", "x.example.ltd.uk": "example", "example.asn.au": "example", "shop.example.co.ao": "example", "go.jp": None, "a.example.com.bd": "example", "com.bd": None, "x.www.ck": "www", "a.b.ck": "a", "go.fr": "go"}
    assert column(spark, list(given), urls.to_root) == list(given.values())
    rules = ["com", "jp", "kobe.jp", "*.kawasaki.jp", "!city.kawasaki.jp", "a.b.kobe.jp"]
    given = {"x.y.a.b.kobe.jp": "y", "x.b.kobe.jp": "b", "x.kobe.jp": "x", "q.z.kawasaki.jp": "q", "z.kawasaki.jp": None, "w.city.kawasaki.jp": "city", "x.com": "x"}
    assert column(spark, list(given), lambda c: urls.to_root(c, rules)) == list(given.values())


def test_labels_and_cleaning(spark):
    assert column(spark, ["a.co.uk", "X.Com", "single"], urls.second_level_label) == ["co", "x", "single"]
    assert column(spark, ["\thttps://www.a.com/p ", "WWW.b.com", "http://c", "www.d"], urls.clean_domain) == ["a.com/p", "WWW.b.com", "c", "d"]


def test_join_and_normalize(spark):
    base = "https://a.com/x/y.html"
    refs = ["z.png", "/z", "../q?a#b", "//c.com/i", "#f", "data:image/png;base64,aa", " 'i.png' ", "", None, "local_file:x"]
    want = [None if not r or r.startswith("#") else r if r.startswith(("data:", "local_file:")) else "https:" + r if r.startswith("//") else urljoin(base, r.strip().strip("'")) for r in refs]
    assert column(spark, refs, lambda c: urls.normalize_url(F.lit(base), c)) == want
    assert column(spark, refs[:4], lambda c: urls.join_url(F.lit(base), c)) == [urljoin(base, r) for r in refs[:4]]


def test_extensions_and_rejection(spark):
    rows = [("image/png", "a.svg", "png", "svg"), ("image/jpeg", "a", "jpg", "jpg"), ("IMAGE/SVG+XML", "", "svg", "svg"), ("", "a.JPEG?x=1", "jpg", "jpg"), ("text/html", "b.svg#q", "svg", "svg"), (None, None, "png", "png")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, ct string, u string, a string, b string")
    for r in df.select("*", urls.extension(F.col("ct"), F.col("u")).alias("x"), urls.extension_svg_first(F.col("ct"), F.col("u")).alias("y")).collect():
        assert (r.x, r.y) == (r.a, r.b)
    bodies = [("text/html", "png", b"<html>", True), ("image/png", "png", b"", False), ("text/plain", "svg", b"  <svg/>", False), ("text/plain", "svg", b"<html>", True), ("image/svg+xml", "svg", b"x", False), ("", "svg", b"\n<?xml", False)]
    df = spark.createDataFrame([(c, e, bytearray(b), w) for c, e, b, w in bodies], "ct string, ext string, body binary, want boolean")
    for r in df.select("want", urls.rejected(F.col("ct"), F.col("ext"), F.col("body")).alias("x")).collect():
        assert r.x == r.want


def test_file_names(spark):
    assert column(spark, ["a.b-c.com"], lambda c: urls.logo_file_name(c, F.lit("png"))) == ["a_b-c_com_logo.png"]
    assert column(spark, ["a.b/c"], lambda c: urls.svg_file_name(c, "_logo")) == ["a_b_c_logo.svg"]
    assert column(spark, ["/x/y.tar.gz", "C:\\d\\e.PNG", "noext", ".hidden"], urls.base_name) == ["y.tar", "e", "noext", ".hidden"]
    assert column(spark, ["/x/y.PNG", "a", ".hidden"], urls.file_extension) == [".png", "", ""]


def test_styles(spark):
    values = ["background: url('a.png')", "BACKGROUND-IMAGE:url(b.png)", "-webkit-mask:url(\"c.svg\")", "mask-image: url(d.svg)", "color:red", "", "mask:url(m) ; background:url(n)"]
    assert column(spark, values, urls.style_url) == ["a.png", "b.png", "c.svg", "d.svg", None, None, "n"]
    assert column(spark, ["x:url( 'q' )", ""], urls.any_url) == [" 'q' ", None]


def test_css(spark):
    css = ".logo{color:red;background:url(1.png)} p{background:url(brand2.png)} i{-webkit-mask:url('logo3.svg')} b{background:url(x.png)}"
    assert column(spark, [css], urls.css_urls, "string") == [["1.png", "brand2.png", "logo3.svg"]]
    assert column(spark, [css], lambda c: urls.css_urls(c, masks=False)) == [["1.png", "brand2.png"]]


def test_data_uri(spark):
    svg = "<svg>é</svg>"
    values = ["data:image/svg+xml;base64," + base64.b64encode(svg.encode()).decode(), "data:image/svg+xml,%3Csvg%3E%C3%A9%3C/svg%3E", "data:image/svg+xml;base64," + base64.b64encode(b"<svg>\xff</svg>").decode(), "http://x"]
    assert column(spark, values, urls.data_svg) == [svg, svg, "<svg></svg>", None]


def test_unwrapping(spark):
    assert column(spark, ["https://cdn.shortpixel.ai/https://a.com/l.png", "https://b.com/https://c"], urls.unwrap_path_proxy) == ["https://a.com/l.png", "https://b.com/https://c"]
    assert column(spark, ["https://sp.shortpixel.com/i?u=https%3A%2F%2Fa.com%2Fsl.png&x=1", "https://spai.io/sp-1/https://b.com/s.png"], urls.unwrap_any_proxy) == ["https://a.com/sl.png", "https://spai.io/sp-1/https://b.com/s.png"]
    assert column(spark, ["/_next/image?url=%2Flogo.png&w=64", "/x?url=1"], urls.unwrap_next_image) == ["/logo.png", "/x?url=1"]


def test_both_forms_agree(spark):
    """Columns and the page parser read the same tables."""
    addresses = ["https://cdn.shortpixel.ai/x/https://a.com/l.png", "https://q.SHORTPIXEL.com/?u=http%3A%2F%2Fa%2Fb%2Bc&x", "https://spai.io/https://b", "/sp-/ https://c.com/d?e", "/_next/image?w=1&url=", "/_next/image?url=%2Fa%20b&url=c", "", "plain"]
    for family in (urls.PATH_PROXY, urls.ANY_PROXY, urls.NEXT_IMAGE):
        assert column(spark, addresses, lambda c, f=family: urls.unwrapped(c, f)) == [urls.unwrap(a, family) for a in addresses]
    sheets = [".logo{x} .brand a{background : url(1)} .BRAND{background:url('2')}", "a{mask:url(my-logo.svg);background-image:URL(\"brand\")}", "", "url(logo)"]
    for masks in (True, False):
        assert column(spark, sheets, lambda c, m=masks: urls.css_urls(c, m)) == [urls.css_addresses(x, masks) for x in sheets]
    sets = ["a 1x,b 2.5x , c 2400w", "a -5w, b", "a 1..2x, b 3W", "a\t7w extra, b 7w", ",,", "x 99999999999w", "a 1x b"]
    assert column(spark, sets, urls.largest_of_srcset) == [urls.largest_address(x) or None for x in sets]


@pytest.mark.parametrize(("srcset", "want"), [("a 1x, b 2x", "b"), ("a 640w, b 320w", "a"), ("a, b", "b"), ("a 100w,b 100w", "b"), ("", None), ("a 1.5x, b 1400w", "a"), (" , a zw", "a")])
def test_srcset(spark, srcset, want):
    assert column(spark, [srcset], urls.largest_of_srcset) == [want]
    assert (urls.largest_address(srcset) or None) == want


def test_root_links(spark):
    base = "https://a.com/x/"
    given = {"/": True, "": False, " ": True, None: False, "https://other.com": True, "https://other.com/p": False, "#top": False, "?q=1": False, "..": True}
    assert column(spark, list(given), lambda c: urls.is_root_link(c, F.lit(base))) == list(given.values())
    assert [urls.root_link(k, base) for k in given] == list(given.values())


def test_small_ones(spark):
    assert column(spark, ["a\0b"], urls.without_nul) == ["a b"]
    assert column(spark, ["local_file:x", "y"], urls.without_local) == ["x", "y"]
    assert column(spark, ["My LOGO", None], lambda c: urls.mentions(c, "logo", "brand")) == [True, False]
