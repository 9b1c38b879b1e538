"""Queries over pages made of table columns: extraction rules, scoring steps, address rules.

The test tables hold no logo markup, so each customer gets a page of one of the cases below,
with its key in the addresses. The SQL states, case by case, what must be found; it knows
the cases and nothing of the rules.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigil.functions import urls
from sigil.operators import candidates, results
from sigil.plans.registry import query, table

#: Stands for a customer's key in markup and in what is found there.
KEY = "@"


class Case(NamedTuple):
    """Markup, and what each policy chooses of it as "rule value"; a policy that isn't named
    chooses what `all` says, or nothing. The domain if it matters. An address without a host
    means one of the page's own.
    """

    html: str
    found: dict[str, str]
    domain: str = "shop@.example.com"


_SVG = '<svg id="m@"></svg>'
_MARK = f"inline_svg {_SVG}"
#: A symbol of the page, as the two policies that follow references write it out.
_SYMBOL = '<svg xmlns="http://www.w3.org/2000/svg" viewBox="{}"><g></g></svg>'
CASES = (
    Case(f'<a class="x logo__LogoLink-1">{_SVG}</a>', {"structure": f"augsburg {_SVG}", "basic": f"augsburg {_SVG}", "responsive": f"augsburg {_SVG}", "scoring": f"said_svg {_SVG}"}, "w@.berlitz-augsburg.de"),
    Case(f'<a class="brand"><svg class="brand--white"></svg><svg class="brand--color" id="m@"></svg></a>', {"structure": 'logistics <svg class="brand--color" id="m@"></svg>', "responsive": 'logistics <svg class="brand--color" id="m@"></svg>', "basic": 'inline_svg <svg class="brand--white"></svg>'}, "fr@.fmlogistic.com"),
    Case('<header><p class="brand"><a href="/p"><img src="/f@.png"></a></p></header>', {"responsive": "logistics /f@.png", "scoring": "every_image /f@.png"}, "fr@.fmlogistic.com"),
    Case('<header><a href="/"><img src="/h@.png"></a></header>', {"structure": "header_root /h@.png", "scoring": "every_image /h@.png"}),
    Case('<nav><a href="https://shop@.example.com"><svg id="m@"></svg></a></nav>', {"structure": f"header_root {_SVG}", "basic": _MARK, "responsive": _MARK}),
    Case('<div id="header"><a href="/deep"><img src="/h@.png"></a></div>', {"scoring": "every_image /h@.png"}),
    Case('<div class="x brandLogo"><img src="i@.png"></div>', {"structure": "brand_container /i@.png", "scoring": "every_image /i@.png"}),
    Case('<div class="brand_logo" style="background:url(q@.png)"></div>', {"structure": "brand_container /q@.png", "basic": "styled_box /q@.png", "responsive": "masked_element /q@.png", "scoring": "every_style /q@.png"}),
    Case('<a class="TopLogo"><img src="/c@.png"></a>', {"all": "anchor_class /c@.png"}),
    Case('<a aria-label="Our Logo"><img data-src="/l@.png" src="/x.png"></a>', {"all": "anchor_label /l@.png", "responsive": "anchor_label /l@.png"}),
    Case(f'<a class="logo">{_SVG}</a>', {"structure": _MARK, "basic": _MARK, "responsive": f"anchor_class {_SVG}", "scoring": f"said_svg {_SVG}"}),
    Case('<ion-img src="n@.png"></ion-img>', {"structure": "ion_image /n@.png", "responsive": "ion_image /n@.png", "scoring": "every_image /n@.png"}),
    Case('<i class="brand" style="-webkit-mask-image:url(k@.svg)"></i>', {"responsive": "masked_element /k@.svg"}),
    Case('<img src="a.png"><img data-src="/logo@.png" src="b.png">', {"all": "image_signal /logo@.png", "scoring": "every_image /logo@.png"}),
    Case('<img class="logo" src="/g@.png">', {"structure": "image_signal /g@.png", "basic": "image_signal /g@.png", "responsive": "image_signal /g@.png", "scoring": "every_image /g@.png"}),
    Case('<img src="/a@.png" alt="the logo">', {"structure": "image_signal /a@.png", "responsive": "image_signal /a@.png", "scoring": "every_image /a@.png"}),
    Case('<span class="logo" style="mask:url(w@.svg)"></span>', {"structure": "styled_element /w@.svg", "responsive": "masked_element /w@.svg", "basic": "styled_box /w@.svg", "scoring": "every_style /w@.svg"}),
    Case('<span class="brand" style="x:url(\'v@.png\')"></span>', {"structure": "styled_box /v@.png", "basic": "styled_box /v@.png", "responsive": "styled_box /v@.png", "scoring": "every_style /v@.png"}),
    Case('<meta property="og:image" content="/o@.png"><link rel="icon" href="f.ico">', {"all": "og_image /o@.png", "responsive": "og_image /o@.png"}),
    Case('<link rel="icon" href="f.ico"><meta name="twitter:image" content="/t@.png">', {"all": "twitter_image /t@.png", "responsive": "twitter_image /t@.png"}),
    Case('<link rel="stylesheet" href="/s@.css">', {"all": "stylesheet /css/l@.png", "responsive": "stylesheet /css/l@.png"}),
    Case('<link rel="stylesheet" href="/m@.css">', {"structure": "stylesheet /logo@.svg"}),
    Case('<svg></svg><svg role="img" id="b@"></svg>', {"structure": 'inline_svg <svg role="img" id="b@"></svg>', "basic": 'inline_svg <svg role="img" id="b@"></svg>', "responsive": 'inline_svg <svg role="img" id="b@"></svg>'}),
    Case('<b aria-label="logo"><svg id="c@"></svg></b>', {"structure": 'inline_svg <svg id="c@"></svg>', "basic": 'inline_svg <svg id="c@"></svg>', "responsive": 'inline_svg <svg id="c@"></svg>'}),
    Case('<link rel="shortcut icon" href="/f@.ico">', {"structure": "favicon /f@.ico", "basic": "favicon /f@.ico", "responsive": "favicon /f@.ico"}),
    Case('<svg viewBox="0 0 9 @"><use href="#q"/></svg><symbol id="q" viewBox="0 0 2 @"><g/></symbol>', {"structure": f"inline_svg {_SYMBOL.format('0 0 2 @')}", "responsive": f"inline_svg {_SYMBOL.format('0 0 9 @')}", "basic": 'inline_svg <svg viewbox="0 0 9 @"><use href="#q"></use></svg>'}),
    Case('<svg><use xlink:href="/d@.svg#q"/></svg>', {"structure": f"inline_svg {_SYMBOL.format('0 0 4 @')}", "basic": 'inline_svg <svg><use xlink:href="/d@.svg#q"></use></svg>', "responsive": 'inline_svg <svg><use xlink:href="/d@.svg#q"></use></svg>'}),
    Case('<svg><use xlink:href="#logo"/></svg><symbol id="logo" viewBox="0 0 3 @"><g/></symbol>', {"structure": f"inline_svg {_SYMBOL.format('0 0 3 @')}", "responsive": f"inline_svg {_SYMBOL.format('0 0 3 @')}", "basic": 'inline_svg <svg><use xlink:href="#logo"></use></svg>', "scoring": f"said_svg {_SYMBOL.format('0 0 3 @')}"}),
    Case('<a class="logo"><noscript><img src="/ns@.png"></noscript></a>', {"all": "anchor_class /ns@.png", "responsive": "anchor_class /ns@.png"}),
    Case('<img src="a.png"><img src="/b@.png" title="brand">', {"scoring": "every_image /b@.png"}),
    Case('<a href="/"><img src="/top@.png"></a><meta property="og:logo" content="/g.png">', {"scoring": "every_image /top@.png"}),
    Case('<meta itemprop="logo" content="/ip@.png"><img src="/x.png">', {"scoring": "itemprop_logo /ip@.png"}),
    Case('<meta property="og:logo" content="/ol@.png"><meta property="og:image" content="/x.png">', {"structure": "og_image /x.png", "basic": "og_image /x.png", "responsive": "og_image /x.png", "scoring": "og_logo /ol@.png"}),
    Case('<div style="a:url(//cdn@.example.net/d.png)"></div>', {"scoring": "every_style https://cdn@.example.net/d.png"}),
    Case("<svg><title>Logo @</title></svg>", {"structure": "inline_svg <svg><title>Logo @</title></svg>", "basic": "inline_svg <svg><title>Logo @</title></svg>", "responsive": "inline_svg <svg><title>Logo @</title></svg>", "scoring": "said_svg <svg><title>Logo @</title></svg>"}),
    Case('<a class="logo"><img src="data:image/svg+xml,%3Csvg%3E@%3C/svg%3E"></a>', {"all": "anchor_class <svg>@</svg>", "responsive": "anchor_class <svg>@</svg>"}),
    Case('<img class="logo" data-lazy-src="/z@.png" src="/y.png">', {"structure": "image_signal /z@.png", "basic": "image_signal /z@.png", "responsive": "image_signal /z@.png", "scoring": "every_image /z@.png"}),
    Case('<img class="logo" srcset="s.png 1x, /w@.png 2x" src="/c@.png">', {"structure": "image_signal /c@.png", "basic": "image_signal /c@.png", "responsive": "image_signal /w@.png", "scoring": "every_image /c@.png"}),
    Case('<img class="logo" data-srcset="/u1.png 9w, /u@.png 3w">', {"responsive": "image_signal /u1.png", "scoring": "every_image /u@.png"}),
    Case('<img class="logo" src="/_next/image?url=%2Fn@.png&w=1">', {"structure": "image_signal /_next/image?url=%2Fn@.png&w=1", "basic": "image_signal /_next/image?url=%2Fn@.png&w=1", "responsive": "image_signal /n@.png", "scoring": "every_image /_next/image?url=%2Fn@.png&w=1"}),
    Case('<img class="logo" src="https://cdn.shortpixel.ai/https://shop@.example.com/sp.png">', {"all": "image_signal /sp.png", "scoring": "every_image /sp.png", "responsive": "image_signal https://cdn.shortpixel.ai/https://shop@.example.com/sp.png"}),
    Case("", {}),
    Case("<<<a b='@", {}),
    Case("<p>no mark of any kind on page @</p>", {}),
)
#: Fetched files that pages link to: address and text.
FILES = (
    ("/s@.css", "p{background:url(brand.png)} .logo x{BACKGROUND:url('css/l@.png')}"),
    ("/m@.css", "i{mask:url(logo@.svg)} b{background:url(x.png)}"),
    ("/d@.svg", '<svg><symbol id="q" viewBox="0 0 4 @"><g/></symbol></svg>'),
)


def _of(policy: str, case: Case) -> str | None:
    return case.found.get(policy, case.found.get("all"))


def _value(found: str) -> tuple[str, str]:
    rule, _, value = found.partition(" ")
    return rule, f"https://shop@.example.com{value}" if value.startswith("/") else value


def _keyed(text: str, key: Column) -> Column:
    return F.replace(F.lit(text), F.lit(KEY), key.cast("string"))


def _choice(texts: list[str], which: Column, key: Column) -> Column:
    return F.element_at(F.array(*(_keyed(t, key) for t in texts)), which + 1)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, domain, base_url, html: a case for each customer."""
    key = F.col("c_custkey")
    which = (key % len(CASES)).cast("int")
    rows = table(spark, sf_dir, "customer").select(key.alias("page_id"), _choice([c.domain for c in CASES], which, key).alias("domain"), _choice([c.html for c in CASES], which, key).alias("html"))
    return rows.withColumn("base_url", F.concat(F.lit("https://shop"), F.col("page_id").cast("string"), F.lit(".example.com/")))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text of fetched files."""
    key = F.col("c_custkey")
    each = F.explode(F.array(*(F.struct(_keyed(f"https://shop@.example.com{u}", key).alias("url"), _keyed(t, key).alias("text")) for u, t in FILES)))
    return table(spark, sf_dir, "customer").select(key.alias("page_id"), each.alias("f")).select("page_id", "f.*")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _expected(policies: tuple[str, ...]) -> str:
    rows = [(k, p, *_value(found)) for k, case in enumerate(CASES) for p in policies if (found := _of(p, case))]
    values = ", ".join(f"({k}, {_quoted(p)}, {_quoted(rule)}, {_quoted(value)})" for k, p, rule, value in rows)
    return f"""SELECT c_custkey AS page_id, policy, rule, CASE WHEN value LIKE '<%' THEN 'svg' ELSE 'url' END AS kind, replace(value, '{KEY}', CAST(c_custkey AS VARCHAR)) AS value
 FROM customer JOIN (VALUES {values}) v(k, policy, rule, value) ON c_custkey % {len(CASES)} = k"""


def _chosen(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    found = candidates.extract(pages(spark, sf_dir), (policy,), files(spark, sf_dir))
    return candidates.choose(found).select("page_id", "policy", "rule", "kind", "value")


@query(_expected(("structure",)))
def extract_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first mark by the page's structure."""
    return _chosen(spark, sf_dir, "structure")


@query(_expected(("basic",)))
def extract_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first mark of the shortest chain."""
    return _chosen(spark, sf_dir, "basic")


@query(_expected(("responsive",)))
def extract_responsive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first mark, with lazy and responsive images."""
    return _chosen(spark, sf_dir, "responsive")


@query(_expected(("scoring",)))
def extract_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of the highest score."""
    return _chosen(spark, sf_dir, "scoring")


#: Scores by step for pages that hold several kinds at once: rule, order, score.
_SCORED = (
    '<a class="logo"><img src="/1.png"></a><a aria-label="logo"><img src="/2.png"></a><img src="/emblem.png"><img src="/4.png" title="logo"><a href="/"><img src="/5.png"></a><img src="/6.png">'
    '<div class="brand" style="x:url(/7.png)"></div><span style="x:url(/8.png)"></span><meta property="og:image" content="/9.png"><meta name="twitter:image" content="/10.png">'
    '<meta itemprop="logo" content="/11.png"><meta property="og:logo" content="/12.png"><link rel="icon" href="/13.ico"><svg aria-label="logo"></svg><link rel="stylesheet" href="/s@.css">'
)
_SCORES = (("anchor_class", 1, 10), ("anchor_label", 1, 8), ("every_image", 6, 30), ("every_style", 2, 7), ("og_image", 1, 4), ("twitter_image", 1, 4), ("itemprop_logo", 1, 6), ("og_logo", 1, 6), ("favicon", 1, 1), ("said_svg", 1, 10), ("stylesheet", 2, 12))


@query(f"SELECT c_custkey AS page_id, rule, n, score FROM customer, (VALUES {', '.join(f'({_quoted(r)}, {n}, {s})' for r, n, s in _SCORES)}) v(rule, n, score)")
def score_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates and summed scores of every step, on a page that has them all."""
    one = pages(spark, sf_dir).withColumn("html", F.replace(F.lit(_SCORED), F.lit(KEY), F.col("page_id").cast("string")))
    found = candidates.extract(one, ("scoring",), files(spark, sf_dir))
    return found.groupBy("page_id", "rule").agg(F.count(F.lit(1)).cast("int").alias("n"), F.sum("score").cast("int").alias("score"))


#: Brands with a rule of their own, by domain.
_BRANDS = (
    ("de@.airbnb.com", '<a aria-label="Airbnb home"><svg id="m@"></svg></a>', "airbnb", _SVG),
    ("de@.airbnb.com", '<a href="/"><svg id="t@"></svg></a>', "airbnb", '<svg id="t@"></svg>'),
    ("atalian@.nl", '<p><svg id="n@"></svg></p>', "atalian", '<svg id="n@"></svg>'),
    ("atalian@.com", '<header><img class="attachment-large size-large" src="/w@.png"></header>', "atalian", "/w@.png"),
    ("shop@.example.com", '<a class="logo"><img src="/c@.png"></a>', "responsive", "/c@.png"),
)


@query(
    f"""SELECT c_custkey AS page_id, policy, replace(value, '{KEY}', CAST(c_custkey AS VARCHAR)) AS value FROM customer
 JOIN (VALUES {', '.join(f'({k}, {_quoted(p)}, {_quoted(_value("x " + v)[1])})' for k, (_, _, p, v) in enumerate(_BRANDS))}) v(k, policy, value) ON c_custkey % {len(_BRANDS)} = k"""
)
def brand_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by the route of their domain, each under its own policy."""
    which = (F.col("page_id") % len(_BRANDS)).cast("int")
    rows = pages(spark, sf_dir).withColumn("domain", _choice([b[0] for b in _BRANDS], which, F.col("page_id"))).withColumn("html", _choice([b[1] for b in _BRANDS], which, F.col("page_id")))
    return candidates.choose(candidates.extract_routed(rows)).select("page_id", "policy", "value")


#: Domains and their routes, stated one by one.
_ROUTED = (("www.airbnb.de", "airbnb"), ("my.Atalian.com", "atalian"), ("a.ibc-solar.jp", "rendered"), ("x.berlitz-augsburg.de", "soup"), ("fmlogistic.fr", "soup"), ("plain.example.com", "http"))


@query(f"SELECT c_custkey, route FROM customer JOIN (VALUES {', '.join(f'({k}, {_quoted(r)})' for k, (_, r) in enumerate(_ROUTED))}) v(k, route) ON c_custkey % {len(_ROUTED)} = k")
def domain_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's own routes, over a domain for each customer."""
    which = (F.col("c_custkey") % len(_ROUTED)).cast("int")
    return table(spark, sf_dir, "customer").select("c_custkey", results.route(F.element_at(F.array(*(F.lit(d) for d, _ in _ROUTED)), which + 1)).alias("route"))


# Addresses


#: What a Column function makes of an address or a text: name, function, given, wanted.
_ADDRESSES = (
    ("style_url", urls.style_url, "color:red;Background-Image: url('b@.png')", "b@.png"),
    ("style_url", urls.style_url, '-webkit-mask:url("m@.svg")', "m@.svg"),
    ("style_url", urls.style_url, "color:red", None),
    ("any_url", urls.any_url, "x:url(v@.png)", "v@.png"),
    ("css_urls", lambda c: F.array_join(urls.css_urls(c), " "), ".brand a{background:url(1@.png)} p{background:url(logo2.png)} i{mask:url('brand3.svg')} b{background:url(x.png)}", "1@.png logo2.png brand3.svg"),
    ("css_urls_no_masks", lambda c: F.array_join(urls.css_urls(c, masks=False), " "), "i{mask:url('brand3.svg')} p{background:url(logo@.png)}", "logo@.png"),
    ("data_svg", urls.data_svg, "data:image/svg+xml,%3Csvg%3E@%3C/svg%3E", "<svg>@</svg>"),
    ("data_svg", urls.data_svg, "data:image/svg+xml;base64,PHN2Zy8+", "<svg/>"),
    ("data_svg", urls.data_svg, "data:image/png;base64,AAAA", None),
    ("path_proxy", urls.unwrap_path_proxy, "https://cdn.shortpixel.ai/https://a.example/@.png", "https://a.example/@.png"),
    ("path_proxy", urls.unwrap_path_proxy, "https://b.example/https://c.example/@", "https://b.example/https://c.example/@"),
    ("any_proxy", urls.unwrap_any_proxy, "https://sp.shortpixel.com/i?u=https%3A%2F%2Fa.example%2F@.png&x=1", "https://a.example/@.png"),
    ("any_proxy", urls.unwrap_any_proxy, "/sp-@/?https://d.example/e.png?q", "https://d.example/e.png"),
    ("next_image", urls.unwrap_next_image, "/_next/image?w=64&url=%2Flogo@.png", "/logo@.png"),
    ("next_image", urls.unwrap_next_image, "/x?url=@", "/x?url=@"),
    ("largest", urls.largest_of_srcset, "a@.png 640w, b.png 320w", "a@.png"),
    ("largest", urls.largest_of_srcset, "a.png 1x, b@.png 2x", "b@.png"),
    ("largest", urls.largest_of_srcset, "a.png 100w, b@.png 100w", "b@.png"),
    ("last", urls.last_of_srcset, "a.png 640w, z@.png 320w", "z@.png"),
    ("decoded", urls.percent_decode, "a%20b+%zz%C3%A9@", "a b+%zzé@"),
    ("normalized", lambda c: urls.normalize_url(F.lit("https://h.example/d/e"), c), " '../q@?a#b' ", "https://h.example/q@?a#b"),
    ("normalized", lambda c: urls.normalize_url(F.lit("https://h.example/d/e"), c), "//cdn@.example/i", "https://cdn@.example/i"),
    ("normalized", lambda c: urls.normalize_url(F.lit("https://h.example/d/e"), c), "#top", None),
    ("extension", lambda c: urls.extension(F.lit(""), c), "https://a.example/@.JPEG?x=1", "jpg"),
    ("svg_first", lambda c: urls.extension_svg_first(F.lit("image/png"), c), "/l@.svg#q", "svg"),
    ("rejected", lambda c: urls.rejected(F.lit("text/html"), F.lit("png"), F.lit(None).cast("binary")).cast("string"), "x", "true"),
    ("rejected", lambda c: urls.rejected(c, F.lit("png")).cast("string"), "image/png", "false"),
    ("rejected_svg", lambda c: urls.rejected(F.lit("text/plain"), F.lit("svg"), c.cast("binary")).cast("string"), "  <SVG id='@'/>", "false"),
    ("rejected_svg", lambda c: urls.rejected(F.lit("text/plain"), F.lit("svg"), c.cast("binary")).cast("string"), "<html>@", "true"),
    ("base_name", urls.base_name, "/x/y@.tar.gz", "y@.tar"),
    ("file_extension", urls.file_extension, "C:\\d\\e@.PNG", ".png"),
    ("mentions", lambda c: urls.mentions(c, "logo", "brand").cast("string"), "My LOGO @", "true"),
    ("mentions", lambda c: urls.mentions(c, "logo", "brand").cast("string"), "none @", "false"),
    ("without_local", urls.without_local, "local_file:a@", "a@"),
    ("element_file", urls.element_file_name, "a@.example", "a@.example_logo_element.png"),
)


def _literal(text: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if text is None else _quoted(text)


@query(
    f"""SELECT c_custkey, place AS at, name, replace(wanted, '{KEY}', CAST(c_custkey AS VARCHAR)) AS value
 FROM customer, (VALUES {', '.join(f'({k}, {_quoted(n)}, {_literal(w)})' for k, (n, _, _, w) in enumerate(_ADDRESSES))}) v(place, name, wanted)"""
)
def address_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column functions over addresses, styles, srcsets, data addresses and file names."""
    key = F.col("c_custkey")
    each = [F.struct(F.lit(k).alias("at"), F.lit(n).alias("name"), build(_keyed(given, key)).cast("string").alias("value")) for k, (n, build, given, _) in enumerate(_ADDRESSES)]
    # Python functions want a row of their own, so the cases come as columns first.
    wide = table(spark, sf_dir, "customer").select("c_custkey", *(e.alias(f"e{k}") for k, e in enumerate(each)))
    return wide.select("c_custkey", F.explode(F.array(*(f"e{k}" for k in range(len(each))))).alias("e")).select("c_custkey", "e.*")


_LINKS = ("/", "", " ", "https://other.example", "https://other.example/p@", "#top", "?q=@", "..", "p@")


@query(
    f"""SELECT c_custkey, place AS at, place IN (0, 2, 3, 7) AS is_root FROM customer, range({len(_LINKS)}) r(place)"""
)
def root_link_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which links lead to a site's top."""
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.posexplode(F.array(*(_keyed(x, key) for x in _LINKS))).alias("at", "href"))
    return rows.select("c_custkey", F.col("at").cast("long").alias("at"), urls.is_root_link(F.col("href"), F.lit("https://a.example/x/")).alias("is_root"))


#: Hosts and their registrable labels under known suffixes of every kind, stated one by one.
_ROOTS = (("shop.name@.co.uk", "name@"), ("name@.de", "name@"), ("a.b.name@.com", "name@"), ("x.name@.go.jp", "name@"), ("name@.com.bd", "name@"), ("q.name@.ltd.uk", "name@"), ("name@.unknown", "unknown"), ("10.0.0.7", "10.0.0.7"), ("me:pw@name.net:80", "name"), ("single", "single"))


@query(f"SELECT c_custkey, replace(root, '{KEY}', CAST(c_custkey AS VARCHAR)) AS root FROM customer JOIN (VALUES {', '.join(f'({k}, {_quoted(r)})' for k, (_, r) in enumerate(_ROOTS))}) v(k, root) ON c_custkey % {len(_ROOTS)} = k")
def registrable_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrable labels by the longest suffix."""
    key = F.col("c_custkey")
    host = F.element_at(F.array(*(F.lit(h) if "me:pw" in h else _keyed(h, key) for h, _ in _ROOTS)), (key % len(_ROOTS)).cast("int") + 1)
    return table(spark, sf_dir, "customer").select("c_custkey", urls.to_root(host).alias("root"))
