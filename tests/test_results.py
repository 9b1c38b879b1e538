from sigil.operators import results


def frame(spark, rows):
    return spark.createDataFrame(rows, "website string, logo_url string, ord long")


def test_patch(spark):
    old = frame(spark, [("a", "", 1), ("b", "x", 2), ("c", None, 3), ("a", "", 4), ("d", "", 5)])
    new = frame(spark, [("a", "", 1), ("a", "n1", 2), ("a", "n2", 3), ("b", "y", 1), ("c", "z", 1)])
    found = {r.ord: r.logo_url for r in results.patch(old, new).collect()}
    assert found == {1: "n1", 2: "x", 3: "z", 4: "", 5: ""}
    assert sorted(r.website for r in results.failed(old).collect()) == ["a", "a", "c", "d"]


def test_rates_of_nothing(spark):
    empty = frame(spark, [])
    row = results.found_rate(empty).first()
    assert (row.found, row.total, row.percent) == (0, 0, None)
    assert results.summary(empty).first().total == 0


def test_lists(spark):
    rows = [(1, " https://www.a.com"), (2, "a.com"), (3, None), (4, "berlitz.com.py"), (5, "\tb.com\n"), (6, "  ")]
    df = spark.createDataFrame(rows, "ord long, domain string")
    assert [r.domain for r in results.domain_list(df, "ord").orderBy("ord").collect()] == ["a.com", "b.com"]
    assert results.first_column(df.select("domain", "ord"), "x").columns == ["x"]
    assert results.containing(df, "domain", "A.C").count() == 2


def test_routes_and_attempts(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("x.airbnb.com",), ("fmlogistic.com",), ("z",)], "d string")
    assert [r.r for r in df.select(results.route(F.col("d")).alias("r")).collect()] == ["airbnb", "soup", "http"]
    tried = spark.createDataFrame([("a", 1, "", "http"), ("a", 2, "https://u", "browser"), ("b", 1, None, "http")], "domain string, priority int, logo_url string, step string")
    found = {r.domain: (r.logo_url, r.step, r.status) for r in results.first_attempt(tried).collect()}
    assert found == {"a": ("https://u", "browser", "url"), "b": ("", None, "missing")}
