from sigil.operators import candidates, images
from sigil.sources import io
from sigil.streaming import ingest


def test_fetching(spark):
    def fetch(url):
        if "boom" in url:
            raise RuntimeError
        return io.Response(200, url, "image/svg+xml" if url.endswith("svg") else "text/html", b"<svg/>" if url.endswith("svg") else b"<p>")

    df = spark.createDataFrame([("a.com", "http://a/x.svg"), ("b.com", "http://boom"), ("c.com", None), ("d.com", "http://d/x")], "domain string, url string")
    rows = {r.domain: r for r in io.images_of(io.fetch_all(df, "url", fetch)).collect()}
    assert rows["a.com"].accepted and rows["a.com"].file_name == "a_com_logo.svg"
    assert [rows[d].accepted for d in ("b.com", "c.com", "d.com")] == [False] * 3
    assert rows["b.com"].content_type == "RuntimeError"


def test_rendering(spark):
    df = spark.createDataFrame([("a",), ("b",)], "domain string")
    assert {r.status for r in io.render_all(df, None).collect()} == {"unavailable"}
    found = {r.domain: (r.status, r.html) for r in io.render_all(df, lambda d, w, s: (f"https://{d}", w, b"") if d == "a" else 1 / 0).collect()}
    assert found == {"a": ("ok", "page"), "b": ("error: ZeroDivisionError", None)}
    shot = io.render_all(df, lambda d, w, s: (d, "|".join(s), b"png"), "element").collect()
    assert {(r.file_name, r.html) for r in shot} == {(f"{d}_logo_element.png", "|".join(io.SELECTORS["element"])) for d in "ab"}


def test_rendered_pages_are_extracted(spark):
    """Links count from the address that redirects led to; a failed page has no candidates; marks get names."""
    df = spark.createDataFrame([(1, "a.b"), (2, "c.d"), (3, "e-f.g")], "page_id long, domain string")
    html = {"a.b": '<a class="logo"><img src="l.png"></a>', "e-f.g": '<svg role="img"></svg>'}
    pages = io.render_all(df, lambda d, w, s: (f"https://www.{d}/home/", html[d], b""))
    chosen = candidates.choose(candidates.extract_rendered(pages, ("basic",)))
    assert {r.page_id: r.value for r in chosen.collect()} == {1: "https://www.a.b/home/l.png", 3: '<svg role="img"></svg>'}
    names = {rule: candidates.inline_files(chosen, df, rule).first().file_name for rule in ("plain", "suffixed", "dotted")}
    assert names == {"plain": "e-f_g.svg", "suffixed": "e-f_g_logo.svg", "dotted": "e-f_g_logo.svg"}


def test_wide_features_and_outputs(spark, tmp_path):
    names = ["site"] + [f"{p}{k}" for p, n, _ in io.FAMILIES for k in range(1, n + 1)]
    row = ["x"] + [str(k % 2 * 2 - 1) for k in range(len(names) - 1)]
    (tmp_path / "f.csv").write_text(",".join(names) + "\n" + ",".join(row) + "\n")
    plain, compat = (io.read_wide_features(spark, str(tmp_path / "f.csv"), c).first() for c in (False, True))
    assert (len(plain.h), len(plain.e), len(plain.ph), len(plain.ph12)) == (192, 64, 64, 144)
    assert (len(compat.h), len(compat.e)) == (327, 128)
    groups = spark.createDataFrame([("x", 1), ("y", 1), ("z", 2)], "site string, group_id int")
    tiles = spark.createDataFrame([("x", bytearray(b"m"), bytearray(b"t")), ("y", None, bytearray(b"u"))], "site string, master binary, tight binary")
    assert {r.name: bytes(r.image) for r in io.flat_output(groups, tiles).collect()} == {"1_x.png": b"m", "1_y.png": b"u"}
    io.write_groups(tiles, groups, str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g")).where("group_id = 1").count() == 2
    io.write_csv(groups, str(tmp_path / "c"), single=True)
    io.write_csv(groups, str(tmp_path / "c"), append=True)
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 6
    io.write_table(groups, str(tmp_path / "t"))
    assert io.read_domains(spark, str(tmp_path / "t")).columns == ["domain", "ord"]


def test_page_source(spark):
    spark.dataSource.register(io.PageSource)
    assert spark.read.format("pages").option("urls", "").load().count() == 0


def test_rasterizer_is_optional():
    made = io.rasterize(b"<svg xmlns='http://www.w3.org/2000/svg' width='8' height='8'/>", 8)
    assert made is None or made.startswith(b"\x89PNG")
    png = images.png_bytes(images.np.zeros((2, 2), images.np.uint8))

    def broken(markup, size):
        raise OSError

    assert io.rasterize(b"<svg/>", 8, (broken, lambda m, n: None, lambda m, n: b"text", lambda m, n: png)) == png
    assert io.rasterize(b"<svg/>", 8, (broken,)) is None
    assert images.png_bytes(images.np.zeros((2, 2), images.np.uint8)).startswith(b"\x89PNG")


def test_page_stream(spark, tmp_path):
    spark.createDataFrame([(1, "a.com", "https://a.com/", '<a class="logo"><img src="l.png"></a>')], ingest.PAGES).write.parquet(str(tmp_path / "in"))
    ingest.write_choices(ingest.page_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).where("policy = 'basic'").first().value == "https://a.com/l.png"
