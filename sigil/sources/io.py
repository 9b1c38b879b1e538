"""Sources and sinks: domain lists, feature tables, results, groups, and fetched or rendered pages."""

from __future__ import annotations

import importlib.util
import shutil
import subprocess
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from sigil.functions import urls
from sigil.operators.results import first_column

#: Families of the wide feature table: prefix, width, type (fixed values).
FAMILIES = (("mp_h", 32, "float"), ("mp_v", 32, "float"), ("ph", 64, "tinyint"), ("ph12_", 144, "tinyint"), ("h", 192, "float"), ("e", 64, "float"), ("eph", 64, "tinyint"), ("mph", 64, "tinyint"), ("hu", 7, "float"), ("hog", 128, "float"))
#: Retries of a request, the statuses that earn one, seconds of backoff and of patience (fixed values).
RETRIES, RETRY_ON, BACKOFF, TIMEOUT = 3, (429, 500, 502, 503, 504), 1.0, 10


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """The first column of a Parquet table as `domain`, with an ordinal in file order."""
    return first_column(spark.read.parquet(path)).withColumn("ord", F.monotonically_increasing_id())


def read_wide_features(spark: SparkSession, path: str, compat_prefix: bool = False) -> DataFrame:
    """A wide feature CSV as one array column a family. With compat_prefix, h and e take every
    column that starts with their letter, as a reader that selects by bare prefix does.
    """
    df = spark.read.csv(path, header=True, inferSchema=False)
    return df.select("site", *(_family(df.columns, p, n, t, compat_prefix) for p, n, t in FAMILIES if f"{p}1" in df.columns))


def _family(columns: list[str], prefix: str, width: int, kind: str, compat: bool) -> object:
    chosen = [c for c in columns if c.startswith(prefix)] if compat and prefix in ("h", "e") else [f"{prefix}{k}" for k in range(1, width + 1)]
    return F.array(*(F.col(c).cast(kind) for c in chosen)).alias(prefix.rstrip("_"))


def write_csv(df: DataFrame, path: str, single: bool = False, append: bool = False) -> None:
    """Results as CSV with a header, quotes doubled; one file only if asked for."""
    (df.coalesce(1) if single else df).write.mode("append" if append else "overwrite").csv(path, header=True, escape='"')


def write_table(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").parquet(path)


def write_groups(tiles: DataFrame, groups: DataFrame, path: str) -> None:
    """Tiles in one folder a group; members without a tile are left out."""
    groups.join(tiles, "site").write.mode("overwrite").partitionBy("group_id").parquet(path)


def flat_output(groups: DataFrame, tiles: DataFrame) -> DataFrame:
    """name <group>_<site>.png and the master tile, else the tight one."""
    joined = groups.join(tiles.select("site", "master", "tight"), "site", "left").withColumn("image", F.coalesce("master", "tight"))
    return joined.where("image IS NOT NULL").select(F.concat(F.concat_ws("_", F.col("group_id").cast("string"), "site"), F.lit(".png")).alias("name"), "image")


# Fetching


class Response(NamedTuple):
    status: int
    url: str
    content_type: str
    body: bytes


Fetch = Callable[[str], Response]


def http_fetch(url: str) -> Response:
    """One GET, with retries on busy statuses and growing pauses."""
    for attempt in range(RETRIES + 1):
        try:
            request = urllib.request.Request(url, headers={"User-Agent": "Mozilla/5.0", "Accept": "text/html,image/*,*/*;q=0.8"})
            with urllib.request.urlopen(request, timeout=TIMEOUT) as r:
                return Response(r.status, r.url, r.headers.get("Content-Type", ""), r.read())
        except urllib.error.HTTPError as e:
            if e.code not in RETRY_ON or attempt == RETRIES:
                return Response(e.code, url, e.headers.get("Content-Type", ""), b"")
        except (urllib.error.URLError, OSError) as e:
            if attempt == RETRIES:
                return Response(0, url, type(e).__name__, b"")
        time.sleep(BACKOFF * 2**attempt)
    raise AssertionError


def fetch_all(df: DataFrame, url_col: str, fetch: Fetch = http_fetch, threads: int = 20) -> DataFrame:
    """df with status, final_url, content_type, body, in the rows' order; a failing row fails alone."""
    schema = StructType([*df.schema, StructField("status", IntegerType()), StructField("final_url", StringType()), StructField("content_type", StringType()), StructField("body", BinaryType())])

    def safe(url: str | None) -> Response:
        try:
            return fetch(url) if url else Response(0, "", "no address", b"")
        except Exception as e:  # one page must not stop the others
            return Response(0, url or "", type(e).__name__, b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    got = list(pool.map(safe, part.column(url_col).to_pylist()))
                    extra = [pa.array([r.status for r in got], pa.int32()), pa.array([r.url for r in got], pa.string()), pa.array([r.content_type for r in got], pa.string()), pa.array([r.body for r in got], pa.binary())]
                    yield pa.RecordBatch.from_arrays([*part.columns, *extra], names=schema.names)

    return df.mapInArrow(run, schema)


class _Urls(InputPartition):
    def __init__(self, urls: list[str]) -> None:
        self.urls = urls


class _PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.urls = options.get("urls", "").split()
        self.parts = max(1, int(options.get("partitions", "2")))

    def partitions(self) -> list[InputPartition]:
        return [_Urls(self.urls[k :: self.parts]) for k in range(self.parts) if self.urls[k :: self.parts]]

    def read(self, partition: _Urls) -> Iterator[tuple]:
        for url in partition.urls if partition else ():
            r = http_fetch(url)
            yield (url, r.status, r.url, r.content_type, r.body)


class PageSource(DataSource):
    """spark.dataSource.register(PageSource); spark.read.format("pages").option("urls", "https://a https://b")."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "url string, status int, final_url string, content_type string, body binary"

    def reader(self, schema: object) -> DataSourceReader:
        return _PageReader(self.options)


def images_of(fetched: DataFrame, domain_col: str = "domain", svg_first: bool = False, strict: bool = True) -> DataFrame:
    """Fetched images with ext, file_name and accepted, decided by type, address and first bytes."""
    ct, url = F.col("content_type"), F.col("final_url")
    ext = urls.extension_svg_first(ct, url) if svg_first else urls.extension(ct, url)
    out = fetched.withColumn("ext", ext)
    bad = urls.rejected(ct, F.col("ext"), F.col("body") if strict else None)
    return out.withColumn("file_name", urls.logo_file_name(F.col(domain_col), F.col("ext"))).withColumn("accepted", (F.col("status") == 200) & ~bad)


#: A renderer takes (domain, wanted, selectors) and returns (final_url, html, png): a browser outside
#: this library. wanted is one of page, svg, element, download; selectors are tried in order.
Renderer = Callable[[str, str, tuple[str, ...]], tuple[str, str, bytes]]
#: Elements that a renderer is asked to photograph, in order (fixed values).
SELECTORS = {
    "svg": ('svg[data-testid="zalando-logo"]', "svg.logo", "svg"),
    "element": ('img[class*="logo"]', 'img[src*="logo"]', 'svg[class*="logo"]', "svg"),
}
_RENDERED = pa.schema([("final_url", pa.string()), ("html", pa.string()), ("png", pa.binary()), ("file_name", pa.string()), ("status", pa.string())])


def render_all(df: DataFrame, renderer: Renderer | None, wanted: str = "page", tasks: int = 2) -> DataFrame:
    """df (domain and other columns) with final_url, html, png, file_name, status, at most `tasks` at a
    time. A photographed element has a file name. Without a renderer all rows say unavailable.
    """
    selectors = SELECTORS.get(wanted, ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, domain in enumerate(batch.column("domain").to_pylist()):
                row = {"status": "unavailable"}
                if renderer is not None:
                    try:
                        row["final_url"], row["html"], row["png"] = renderer(domain, wanted, selectors)
                        row["status"] = "ok"
                        if wanted == "element" and row["png"]:
                            row["file_name"] = f"{domain}_logo_element.png"
                    except Exception as e:
                        row = {"status": f"error: {type(e).__name__}"}
                made = pa.RecordBatch.from_pylist([row], _RENDERED)
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, *made.columns], names=[*batch.schema.names, *_RENDERED.names])

    schema = StructType([*df.schema, *(StructField(f.name, BinaryType() if f.name == "png" else StringType()) for f in _RENDERED)])
    return df.coalesce(tasks).mapInArrow(run, schema)


def _cairo(markup: bytes, size: int) -> bytes | None:
    """By a Python rasteriser, where one is installed."""
    if importlib.util.find_spec("cairosvg") is None:
        return None
    return importlib.import_module("cairosvg").svg2png(bytestring=markup, output_width=size, output_height=size)


def _program(name: str, *options: str) -> Callable[[bytes, int], bytes | None]:
    def run(markup: bytes, size: int) -> bytes | None:
        if (program := shutil.which(name)) is None:
            return None
        done = subprocess.run([program, *(o.format(size=size) for o in options)], input=markup, capture_output=True, timeout=60, check=False)
        return done.stdout if done.returncode == 0 else None

    return run


#: Rasterisers in order; the first that is there and gives a PNG counts.
RASTERIZERS = (
    _cairo,
    _program("rsvg-convert", "-w", "{size}", "-h", "{size}"),
    _program("inkscape", "--pipe", "--export-type=png", "--export-width={size}", "--export-height={size}", "--export-filename=-"),
)


def rasterize(markup: bytes, size: int = 2048, chain: tuple[Callable[[bytes, int], bytes | None], ...] = RASTERIZERS) -> bytes | None:
    """A PNG of svg markup; None if no rasteriser makes one."""
    for one in chain:
        try:
            made = one(markup, size)
        except (OSError, ValueError, subprocess.SubprocessError):
            continue
        if made and made.startswith(b"\x89PNG"):
            return made
    return None
