"""URL, host and file-name expressions. All are Column builders that stay in the JVM, but
for urljoin and the lenient data-URI decoder, which are Arrow UDFs over the standard library.
"""

from __future__ import annotations

import base64
import contextlib
import functools
import operator
import re
from collections.abc import Callable, Iterable
from typing import NamedTuple
from urllib.parse import unquote, urljoin, urlparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def strip(c: Column) -> Column:
    """Without white space of any script at the ends; Spark's trim takes spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|(?U)\s+$", "")


def percent_decode(c: Column) -> Column:
    """Percent escapes as UTF-8; a plus stays, and so does a percent sign without two hex digits."""
    safe = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(safe)


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """body of c's value, which is computed once. Written out, c would stand in the plan as
    often as body uses it, and once more for each level of nesting.
    """
    return F.transform(F.array(c), body)[0]


def _none(c: Column) -> Column:
    return let(c, lambda x: F.when(x != "", x))


def to_host(c: Column) -> Column:
    """Authority of a URL or bare domain, lower-cased, with port and user information, less
    one leading www.; null for blank input.
    """

    def host(s: Column) -> Column:
        full = F.when(s.startswith("http://") | s.startswith("https://") | s.startswith("//"), s).when(s != "", F.concat(F.lit("http://"), s))
        return F.regexp_replace(F.lower(F.regexp_extract(full, r"^(?:https?:)?//([^/?#]*)", 1)), r"^www\.", "")

    return _none(let(strip(percent_decode(c)), host))


#: Public suffixes without a country: fixed values of the public suffix list, a subset.
GENERIC = ("com", "net", "org", "info", "biz", "edu", "gov", "mil", "int", "name", "pro", "aero", "coop", "museum", "app", "dev", "shop", "store", "online", "site", "xyz", "tech", "cloud", "blog", "agency", "group", "world", "global", "eco", "travel")
#: Labels under which countries register names, and the countries that do: fixed values, a subset.
SECOND = ("co", "com", "org", "net", "ac", "gov", "edu", "or", "ne", "gob", "mil")
COUNTRIES = ("uk", "jp", "nz", "za", "kr", "il", "in", "id", "th", "au", "br", "mx", "ar", "py", "pe", "tr", "cn", "tw", "hk", "sg", "my", "ph", "vn", "eg", "sa", "ua", "cy", "ve", "uy", "ec", "bo", "gt", "do", "ng", "ke", "tz", "ug", "at")


#: Further second levels of countries, a subset as well.
MORE = {
    "uk": "ltd plc me nhs police sch",
    "jp": "ad ed go gr lg",
    "kr": "go pe re es hs kg ms sc",
    "id": "go sch web my desa biz",
    "th": "go in mi",
    "au": "asn id",
    "nz": "geek gen govt iwi kiwi maori school",
    "za": "law nom school web",
    "il": "k12 muni",
    "in": "firm gen ind nic res",
    "br": "art blog eco eng ind inf jus leg tv",
    "tr": "av bbs bel dr gen info k12 name pol tel tv web",
    "tw": "game ebiz club idv",
    "hk": "idv",
    "sg": "per",
    "my": "name",
    "ke": "go info me mobi sc",
    "tz": "go hotel info me mobi sc tv",
    "ug": "go sc",
    "at": "gv",
    "ao": "co ed gv it og pb",
    "cr": "ac co ed fi go or sa",
    "bw": "co org",
    "zm": "ac co com edu gov net org sch",
    "pk": "com edu fam gok gop gos gov net org web",
    "bd": "*",
    "np": "*",
    "ck": "* !www",
}
#: Public suffixes with the list's wildcards ("*.ck") and exceptions ("!www.ck"); a subset of some hundred.
SUFFIXES = frozenset(
    [*GENERIC, *(f"{s}.{c}" for c in COUNTRIES for s in SECOND), *(f"{s}.{c}" for c, labels in MORE.items() for s in labels.split())]
)


def to_root(host: Column, suffixes: Iterable[str] = SUFFIXES) -> Column:
    """Registrable label ("example" of shop.example.co.uk) by the longest of the suffixes that
    matches, which may be the whole public suffix list; the last label if its suffix is
    unknown, the host itself for an IPv4 address, null without a label. Two-letter last
    labels count as country suffixes. Port and user information are ignored.
    """
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", ""), r"^\.+|\.+$", "")
    rules: dict[tuple[str, int], list[str]] = {}
    for rule in suffixes:
        kind = rule[0] if rule[0] in "!*" else ""
        rules.setdefault((kind, rule.count(".") + 1), []).append(rule.removeprefix("!").removeprefix("*."))
    depths = sorted({k for _, k in rules}, reverse=True)

    def root(parts: Column) -> Column:
        def tail(k: int) -> Column:
            return F.array_join(F.slice(parts, -k, k), ".")

        cases = [(tail(k).isin(rules["!", k]), k - 1) for k in depths if ("!", k) in rules]
        for k in depths:
            if ("", k) in rules:
                cases.append((tail(k).isin(rules["", k]), k))
            if ("*", k) in rules:
                cases.append(((F.size(parts) >= k) & tail(k - 1).isin(rules["*", k]), k))
        cases.append((F.element_at(parts, -1).rlike("^[a-z]{2}$"), 1))
        length = F.coalesce(*(F.when(found, F.lit(n)) for found, n in cases), F.lit(0))
        numbers = (F.size(parts) == 4) & F.forall(parts, lambda p: p.rlike(r"^\d{1,3}$"))
        return F.when(numbers, F.array_join(parts, ".")).otherwise(let(length, lambda n: F.try_element_at(parts, -(n + 1))))

    return _none(let(F.split(name, r"\."), root))


def second_level_label(domain: Column) -> Column:
    """The label before the last, whatever the suffix; a single label is itself."""
    parts = F.split(domain, r"\.")
    return F.lower(F.coalesce(F.try_element_at(parts, F.lit(-2)), domain))


def clean_domain(c: Column) -> Column:
    """Stripped, less http(s):// and then www.; case and path stay."""
    return F.regexp_replace(F.regexp_replace(strip(c.cast("string")), "^https?://", ""), r"^www\.", "")


@F.pandas_udf(StringType())
def join_url(base: pd.Series, ref: pd.Series) -> pd.Series:
    """RFC 3986 resolution; what can't be resolved stays as it is, null stays null."""
    return pd.Series([resolve(b, r) for b, r in zip(base, ref, strict=True)], dtype=object)


def resolve(base: str | None, ref: str | None) -> str | None:
    if ref is None:
        return None
    try:
        return urljoin(base or "", ref)
    except ValueError:
        return ref


def _unquoted(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(strip(c), '^"+|"+$', ""), "^'+|'+$", "")


def normalize_url(base: Column, href: Column) -> Column:
    """Absolute URL; data: and local_file: pass; //x takes the base's scheme; a bare fragment or blank is null."""
    h = _unquoted(href)
    scheme = F.when(base.startswith("https:"), F.lit("https:")).otherwise(F.lit("http:"))
    return (
        F.when(href.isNull() | (href == "") | h.startswith("#"), F.lit(None).cast("string"))
        .when(h.startswith("data:") | h.startswith("local_file:"), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .otherwise(join_url(base, h))
    )


def extension(content_type: Column, url: Column) -> Column:
    """png, jpg or svg: by content type, else by the URL's path, else png."""
    ct, path = F.lower(F.coalesce(content_type, F.lit(""))), F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", ""))
    return (
        F.when(ct.contains("png"), "png")
        .when(ct.contains("jpeg") | ct.contains("jpg"), "jpg")
        .when(ct.contains("svg"), "svg")
        .when(path.endswith(".png"), "png")
        .when(path.rlike(r"\.jpe?g$"), "jpg")
        .when(path.endswith(".svg"), "svg")
        .otherwise("png")
    )


def extension_svg_first(content_type: Column, url: Column) -> Column:
    """Another precedence: svg by type or URL, then png, then jpg, else png."""
    ct, path = F.lower(F.coalesce(content_type, F.lit(""))), F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", ""))
    return (
        F.when(ct.contains("svg") | path.endswith(".svg"), "svg")
        .when(ct.contains("png") | path.endswith(".png"), "png")
        .when(ct.contains("jpeg") | ct.contains("jpg") | path.rlike(r"\.jpe?g$"), "jpg")
        .otherwise("png")
    )


def rejected(content_type: Column, ext: Column, body: Column | None = None) -> Column:
    """No image and not svg. With a body, an svg must also say so by type or at its start."""
    ct = F.lower(F.coalesce(content_type, F.lit("")))
    out = ~ct.contains("image") & (ext != "svg")
    if body is not None:
        head = F.lower(F.regexp_replace(F.decode(F.substring(body, 1, 1024), "UTF-8"), r"^\s+", ""))
        out = out | ((ext == "svg") & ~ct.contains("svg") & ~(head.startswith("<svg") | head.startswith("<?xml")))
    return out


def logo_file_name(domain: Column, ext: Column) -> Column:
    return F.concat(F.replace(domain, F.lit("."), F.lit("_")), F.lit("_logo."), ext)


def svg_file_name(domain: Column, suffix: str = "") -> Column:
    return F.concat(F.regexp_replace(domain, "[^A-Za-z0-9_-]", "_"), F.lit(f"{suffix}.svg"))


def inline_name(domain: Column, rule: str = "suffixed") -> Column:
    """File name of a domain's inline mark, by one of three rules: plain and suffixed replace all but
    letters, digits, _ and -, the latter with _logo; dotted replaces dots only, with _logo.
    """
    if rule == "dotted":
        return logo_file_name(domain, F.lit("svg"))
    return svg_file_name(domain, {"plain": "", "suffixed": "_logo"}[rule])


def element_file_name(domain: Column) -> Column:
    return F.concat(domain, F.lit("_logo_element.png"))


def base_name(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]*)$", 1), r"(?<=.)\.[^.]*$", "")


def file_extension(path: Column) -> Column:
    """With its dot, lower-cased; empty if there is none."""
    return F.lower(F.regexp_extract(path, r"[^/\\](\.[^./\\]*)$", 1))


#: CSS patterns for an image's address, and words that mark it as a logo's (fixed values).
BACKGROUND = r"(?i)background(?:-image)?:\s*url\(([^)]+)\)"
MASK = r"(?i)(?:-webkit-)?mask(?:-image)?:\s*url\(([^)]+)\)"
ANY_URL = r"url\(([^)]+)\)"
CLASS_RULE = r"(?i)\.(?:logo|brand)[^{]*\{[^}]*background(?:-image)?:\s*url\(([^)]+)\)"
MARKS = ("logo", "brand")
#: What a stylesheet is searched for, in order of preference: a pattern, and whether the address must say MARKS.
#: The last one is for masks. The page parser and the Column form both read this table.
STYLESHEET = ((CLASS_RULE, False), (BACKGROUND, True), (MASK, True))


def style_url(style: Column) -> Column:
    """Address of a background, else of a mask, without quotes; null if there is none."""
    found = F.coalesce(_none(F.regexp_extract(style, BACKGROUND, 1)), _none(F.regexp_extract(style, MASK, 1)))
    return F.regexp_replace(found, "^['\"]+|['\"]+$", "")


def any_url(style: Column) -> Column:
    return F.regexp_replace(_none(F.regexp_extract(style, ANY_URL, 1)), "^['\"]+|['\"]+$", "")


def css_urls(text: Column, masks: bool = True) -> Column:
    """Addresses in a stylesheet, in the order of STYLESHEET."""

    def found(pattern: str, marked: bool) -> Column:
        each = F.regexp_extract_all(text, F.lit(pattern), 1)
        return F.filter(each, lambda x: mentions(x, *MARKS)) if marked else each

    every = F.concat(*(found(*rule) for rule in STYLESHEET[: 3 if masks else 2]))
    return F.transform(every, lambda x: F.regexp_replace(x, "^['\"]+|['\"]+$", ""))


def css_addresses(text: str, masks: bool = True) -> list[str]:
    """css_urls for the page parser."""
    rules = STYLESHEET[: 3 if masks else 2]
    return [m[1].strip("'\"") for pattern, marked in rules for m in re.finditer(pattern, text) if not marked or any(w in m[1].lower() for w in MARKS)]


def decode_data_svg(url: str) -> str | None:
    """Markup of a data:image/svg+xml address: base64 with wrong bytes left out, or percent escapes."""
    if not url.startswith("data:image/svg+xml") or "," not in url:
        return None
    head, _, body = url.partition(",")
    if head.endswith(";base64"):
        try:
            return base64.b64decode(body + "=" * (-len(body) % 4)).decode("utf-8", errors="ignore")
        except ValueError:
            return None
    return unquote(body)


@F.pandas_udf(StringType())
def data_svg(url: pd.Series) -> pd.Series:
    return pd.Series([None if u is None else decode_data_svg(u) for u in url], dtype=object)


class Proxy(NamedTuple):
    """How an image proxy wraps addresses: signs in its own, of which one must be there (in any
    case if folded); the wrapped one; whether that is escaped; and a sign that must not be in it.
    """

    signs: tuple[str, ...]
    inner: str
    escaped: bool = False
    folded: bool = False
    without: str = ""


#: Families of proxies: of each family the first that fits counts (fixed values). The page
#: parser and the Column forms both read these.
PATH_PROXY = (Proxy(("shortpixel.ai",), r"https?://[^/]+/(https?://.+)"),)
ANY_PROXY = (
    Proxy(("shortpixel", "/sp-", "spai"), r"(https?%3A%2F%2F[^&]+)", escaped=True, folded=True),
    Proxy(("shortpixel", "/sp-", "spai"), r"(https?://[^?&\s]+)", folded=True, without="shortpixel"),
)
NEXT_IMAGE = (Proxy(("/_next/image",), r"[?&]url=([^&]*)", escaped=True),)


def unwrapped(url: Column, family: tuple[Proxy, ...]) -> Column:
    """The wrapped address, or the address itself if no proxy of the family fits."""

    def inner(p: Proxy) -> Column:
        where = F.lower(url) if p.folded else url
        signed = functools.reduce(operator.or_, (where.contains(x) for x in p.signs))
        found = F.regexp_extract(url, p.inner, 1)
        fits = signed & url.rlike(p.inner)
        if p.without:
            fits = fits & ~F.lower(found).contains(p.without)
        return F.when(fits, percent_decode(found) if p.escaped else found)

    return F.coalesce(*map(inner, family), url)


def unwrap(url: str, family: tuple[Proxy, ...]) -> str:
    """unwrapped for the page parser."""
    for p in family:
        where = url.lower() if p.folded else url
        found = re.search(p.inner, url) if any(x in where for x in p.signs) else None
        if found and not (p.without and p.without in found[1].lower()):
            return unquote(found[1]) if p.escaped else found[1]
    return url


def unwrap_path_proxy(url: Column) -> Column:
    """The address at the end of an image proxy's path, for addresses of that proxy."""
    return unwrapped(url, PATH_PROXY)


def unwrap_any_proxy(url: Column) -> Column:
    """An escaped address in the query, else a plain one that isn't the proxy's."""
    return unwrapped(url, ANY_PROXY)


def unwrap_next_image(url: Column) -> Column:
    return unwrapped(url, NEXT_IMAGE)


#: One candidate of a srcset: an address, and a descriptor in widths or densities.
SRCSET_ITEM = r"^\s*(\S+)(?:\s+(\S+))?"
DESCRIPTOR = {"w": r"^(?i)(-?\d+)w$", "x": r"^(?i)(-?[0-9.]+)x$"}


def largest_of_srcset(srcset: Column) -> Column:
    """Address of the largest candidate: Nw counts N, Nx 1000 N, none 0; the last of equals."""
    items = F.filter(F.split(srcset, ","), lambda x: x.rlike(SRCSET_ITEM))

    def sized(item: Column, at: Column) -> Column:
        size = F.regexp_extract(item, SRCSET_ITEM, 2)
        number = {k: F.regexp_extract(size, pattern, 1) for k, pattern in DESCRIPTOR.items()}
        width = F.coalesce(number["w"].try_cast("long"), (number["x"].try_cast("double") * 1000).try_cast("long"), F.lit(0))
        return F.struct(F.greatest(width, F.lit(-1)).alias("w"), at.alias("at"), F.regexp_extract(item, SRCSET_ITEM, 1).alias("u"))

    return F.array_max(F.transform(items, sized))["u"]


def largest_address(srcset: str) -> str:
    """largest_of_srcset for the page parser; empty if there is none."""

    def width(size: str | None) -> int:
        for unit, pattern in DESCRIPTOR.items():
            if m := re.match(pattern.replace("^(?i)", "(?i)"), size or ""):
                with contextlib.suppress(ValueError):
                    return max(-1, int(m[1]) if unit == "w" else int(float(m[1]) * 1000))
        return 0

    found = [m for m in (re.match(SRCSET_ITEM, item) for item in srcset.split(",")) if m]
    return max(enumerate(found), key=lambda x: (width(x[1][2]), x[0]))[1][1] if found else ""


def last_of_srcset(srcset: Column) -> Column:
    items = F.filter(F.transform(F.split(srcset, ","), strip), lambda x: x != "")
    return F.split(F.try_element_at(items, F.lit(-1)), " ")[0]


def is_root_link(href: Column, base: Column) -> Column:
    """Whether a link leads to a site's top: blank after stripping, a slash, or a resolved
    address without a path. Null and "" are not. The host is not compared.
    """
    h = strip(href)
    path = F.regexp_extract(join_url(base, h), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#;]*)", 1)
    return F.when(href.isNull() | (href == ""), F.lit(False)).when(h.isin("", "/"), F.lit(True)).otherwise(path.isin("", "/"))


def root_link(href: str | None, base: str) -> bool:
    """is_root_link for the page parser."""
    if not href:
        return False
    if href.strip() in ("", "/"):
        return True
    try:
        return urlparse(urljoin(base, href.strip())).path in ("", "/")
    except ValueError:
        return False


def mentions(c: Column, *words: str) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.lower(F.coalesce(c, F.lit(""))).contains(w)
    return out


def without_nul(c: Column) -> Column:
    return F.translate(c, "\0", " ")


def without_local(c: Column) -> Column:
    return F.regexp_replace(c, "^local_file:", "")


def bbox_text(box: Column) -> Column:
    return F.concat_ws(",", box["x0"], box["y0"], box["x1"], box["y1"])
