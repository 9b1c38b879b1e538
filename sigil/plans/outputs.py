"""Queries over sources and sinks: what is fetched, rendered or written must come back as it should."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigil.functions import urls
from sigil.operators import candidates
from sigil.plans import logos
from sigil.plans.registry import query, table
from sigil.sources import io
from sigil.sources.scratch import scratch_path


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("site"))


def _bytes(text: Column) -> Column:
    return text.cast("binary")


# Fetched and rendered


#: Of customer k: content type, body and end of the address, by k modulo six; five can't be fetched.
_SENT = (("image/png", b"png", "a"), ("image/svg+xml", b"<svg/>", "b"), ("text/html", b"<html>", "c.png"), ("text/plain", b"  <svg>", "d.svg"), ("text/plain", b"<html>", "e.svg?v=1"))


def _fetch(url: str) -> io.Response:
    k = int(url.split("/")[-1])
    if k % 6 == 5:
        raise OSError("no route")
    kind, body, end = _SENT[k % 6]
    return io.Response(200, f"{url}/{end}", kind, body)


@query(
    """WITH c AS (SELECT c_custkey AS k, c_custkey % 6 AS m FROM customer)
 SELECT k, CASE WHEN m = 5 THEN 0 ELSE 200 END AS status, 'https://img.example/' || k || CASE m WHEN 0 THEN '/a' WHEN 1 THEN '/b' WHEN 2 THEN '/c.png' WHEN 3 THEN '/d.svg' WHEN 4 THEN '/e.svg?v=1' ELSE '' END AS final_url,
 CASE WHEN m IN (1, 3, 4) THEN 'svg' ELSE 'png' END AS ext, 'c' || k || '_example_logo.' || CASE WHEN m IN (1, 3, 4) THEN 'svg' ELSE 'png' END AS file_name, m IN (0, 1, 3) AS accepted FROM c"""
)
def fetched_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images fetched by many threads; one that fails fails alone; type, name and acceptance of each."""
    key = F.col("c_custkey").cast("string")
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("c"), key, F.lit(".example")).alias("domain"), F.concat(F.lit("https://img.example/"), key).alias("url"))
    found = io.images_of(io.fetch_all(asked, "url", _fetch))
    return found.select("k", "status", "final_url", "ext", "file_name", "accepted")


def _render(domain: str, wanted: str, selectors: tuple[str, ...]) -> tuple[str, str, bytes]:
    k = int(domain.split(".")[0][1:])
    if k % 4 == 3:
        raise RuntimeError("no page")
    return f"https://www.{domain}/home/", '<a class="logo"><img src="l.png"></a>' if k % 4 else '<svg role="img"></svg>', " > ".join(selectors).encode()


def _rendered(spark: SparkSession, sf_dir: str, wanted: str) -> DataFrame:
    asked = _suppliers(spark, sf_dir).select(F.col("k").cast("long").alias("page_id"), F.concat("site", F.lit(".example")).alias("domain"))
    return io.render_all(asked, _render, wanted)


@query("""SELECT CAST(s_suppkey AS BIGINT) AS page_id, CASE WHEN s_suppkey % 4 = 0 THEN 'inline_svg' ELSE 'anchor_class' END AS rule,
 CASE WHEN s_suppkey % 4 = 0 THEN '<svg role="img"></svg>' ELSE 'https://www.s' || s_suppkey || '.example/home/l.png' END AS value FROM supplier WHERE s_suppkey % 4 <> 3""")  # fmt: skip
def rendered_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of pages as a browser left them; links count from where redirects led."""
    return candidates.choose(candidates.extract_rendered(_rendered(spark, sf_dir, "page"), ("basic",))).select("page_id", "rule", "value")


@query("""SELECT CAST(s_suppkey AS BIGINT) AS page_id, CASE WHEN s_suppkey % 4 = 3 THEN 'error: RuntimeError' ELSE 'ok' END AS status, CASE WHEN s_suppkey % 4 <> 3 THEN 's' || s_suppkey || '.example_logo_element.png' END AS file_name,
 CASE WHEN s_suppkey % 4 <> 3 THEN 'img[class*="logo"] > img[src*="logo"] > svg[class*="logo"] > svg' END AS asked FROM supplier""")  # fmt: skip
def element_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photographs of elements: the selectors that the browser is asked for, in order, and the file names."""
    return _rendered(spark, sf_dir, "element").select("page_id", "status", "file_name", F.col("png").cast("string").alias("asked"))


@query("""SELECT CAST(s_suppkey AS BIGINT) AS page_id, rule, CASE rule WHEN 'plain' THEN 's' || s_suppkey || '_example.svg' ELSE 's' || s_suppkey || '_example_logo.svg' END AS file_name
 FROM supplier, (VALUES ('plain'), ('suffixed'), ('dotted')) v(rule) WHERE s_suppkey % 4 = 0""")  # fmt: skip
def inline_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inline marks as files, by each of the three naming rules."""
    pages = _rendered(spark, sf_dir, "page")
    chosen = candidates.choose(candidates.extract_rendered(pages, ("basic",)))
    each = [candidates.inline_files(chosen, pages, rule).select("page_id", F.lit(rule).alias("rule"), "file_name") for rule in ("plain", "suffixed", "dotted")]
    return each[0].unionByName(each[1]).unionByName(each[2])


# Written


@query("SELECT c_custkey AS domain FROM customer")
def first_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The domain list of a table: its first column, whatever its name."""
    return io.read_domains(spark, f"{sf_dir}/customer.parquet").select("domain")


@query("SELECT c_name AS website, CASE WHEN c_custkey % 3 = 0 THEN 'https://x/a, \"b\"' ELSE 'none' END AS logo_url, CAST(CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n FROM customer")
def result_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results as CSV: overwritten, then appended to, then read back."""
    path = scratch_path(spark, "results")
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("website"), F.when(F.col("c_custkey") % 3 == 0, 'https://x/a, "b"').otherwise("none").alias("logo_url"), "c_custkey")
    io.write_csv(rows.limit(1).drop("c_custkey"), path)
    io.write_csv(rows.drop("c_custkey"), path, single=True)
    io.write_csv(rows.where("c_custkey % 2 = 0").drop("c_custkey"), path, append=True)
    back = spark.read.csv(path, header=True, escape='"', schema="website string, logo_url string")
    return back.groupBy("website", "logo_url").agg(F.count(F.lit(1)).alias("n"))


_WIDE = " UNION ALL ".join(f"SELECT '{p.rstrip('_')}' AS family, {n} AS width" for p, n, _ in io.FAMILIES)


@query(f"SELECT 's' || s_suppkey AS site, family, width, (SELECT CAST(sum((s_suppkey + i) % 7) AS DOUBLE) FROM range(1, width + 1) r(i)) AS total FROM supplier, ({_WIDE}) f")
def wide_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as a wide CSV, and back as one array for each family."""
    path = scratch_path(spark, "wide")
    io.write_csv(_suppliers(spark, sf_dir).select("site", *(((F.col("k") + i) % 7).alias(f"{p}{i}") for p, n, _ in io.FAMILIES for i in range(1, n + 1))), path)
    found = io.read_wide_features(spark, path)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double"))
    each = [F.struct(F.lit(c).alias("family"), F.size(c).alias("width"), total(F.col(c)).alias("total")) for c in (p.rstrip("_") for p, _, _ in io.FAMILIES)]
    return found.select("site", F.explode(F.array(*each)).alias("f")).select("site", "f.*")


def _groups_and_tiles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Groups of all suppliers; tiles of those that seven doesn't divide, without a master or a tight one at times."""
    rows = _suppliers(spark, sf_dir)
    groups = rows.select("site", (F.col("k") % 5 + 1).cast("int").alias("group_id"))
    tiles = rows.where("k % 7 <> 0").select("site", F.when(F.col("k") % 2 == 0, _bytes(F.concat(F.lit("m"), "site"))).alias("master"), F.when(F.col("k") % 3 != 0, _bytes(F.concat(F.lit("t"), "site"))).alias("tight"))
    return groups, tiles


@query("SELECT CAST(s_suppkey % 5 + 1 AS INTEGER) AS group_id, 's' || s_suppkey AS site FROM supplier WHERE s_suppkey % 7 <> 0")
def grouped_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles in one folder for each group; members without a tile are left out."""
    groups, tiles = _groups_and_tiles(spark, sf_dir)
    path = scratch_path(spark, "grouped")
    io.write_groups(tiles, groups, path)
    return spark.read.parquet(path).select("group_id", "site")


@query("""SELECT (s_suppkey % 5 + 1) || '_s' || s_suppkey || '.png' AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'ms' ELSE 'ts' END || s_suppkey AS image
 FROM supplier WHERE s_suppkey % 7 <> 0 AND (s_suppkey % 2 = 0 OR s_suppkey % 3 <> 0)""")  # fmt: skip
def flat_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One image for each member, the master tile or else the tight one, by group and site."""
    groups, tiles = _groups_and_tiles(spark, sf_dir)
    return io.flat_output(groups, tiles).select("name", F.col("image").cast("string").alias("image"))


@query("SELECT c_name AS site, row_number() OVER (ORDER BY c_name) - 1 AS site_idx, c_custkey % 20 BETWEEN 1 AND 19 AS mask_ok FROM customer")
def site_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites numbered in the order of their names."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("site"), ((F.col("c_custkey") % 20) / 20).alias("mask_cov"), F.lit(0.5).alias("s_med"), F.lit(0.5).alias("v_med"))
    return logos.indexed(rows).select("site", F.col("site_idx").cast("long").alias("site_idx"), "mask_ok")


@query("SELECT c_custkey AS k, c_custkey || ',' || (c_custkey + 1) || ',' || (c_custkey + 2) || ',' || (c_custkey + 3) AS bbox FROM customer")
def box_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes as text."""
    key = F.col("c_custkey")
    box = F.struct(*((key + n).alias(c) for n, c in enumerate(("x0", "y0", "x1", "y1"))))
    return table(spark, sf_dir, "customer").select(key.alias("k"), box.alias("b")).select("k", urls.bbox_text(F.col("b")).alias("bbox"))
