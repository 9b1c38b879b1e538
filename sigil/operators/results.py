"""Row operators over domain lists and scrape results: filters, routing, patching, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigil.functions import urls

#: Domains that a scrape leaves out (fixed values).
BLACKLIST = ("cafelasmargaritas.es", "berlitz.com.py")
#: Domain patterns and the route each takes (fixed values), in order.
ROUTES = (("airbnb", "airbnb"), ("atalian", "atalian"), ("ibc-solar.jp", "rendered"), ("berlitz-augsburg.de", "soup"), ("fmlogistic", "soup"))


def first_column(df: DataFrame, name: str = "domain") -> DataFrame:
    """The first column, whatever its name; only it is read."""
    return df.select(F.col(f"`{df.columns[0]}`").alias(name))


def containing(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows where a pattern occurs, whatever the case; null doesn't match."""
    return df.where(F.coalesce(F.col(column).rlike(f"(?i){pattern}"), F.lit(False)))


def without(df: DataFrame, column: str, listed: tuple[str, ...] | DataFrame = BLACKLIST) -> DataFrame:
    """Non-null rows not on a list, given as values or as a table's first column."""
    df = df.where(F.col(column).isNotNull())
    if isinstance(listed, DataFrame):
        return df.join(first_column(listed, "listed").where("listed IS NOT NULL").distinct(), F.col(column) == F.col("listed"), "left_anti")
    return df.where(~F.col(column).isin(*listed))


def distinct_in_order(df: DataFrame, column: str, ordinal: str) -> DataFrame:
    """The first row of each value, by ordinal."""
    return df.groupBy(column).agg(F.min(ordinal).alias(ordinal))


def head(df: DataFrame, ordinal: str, n: int = 100) -> DataFrame:
    return df.orderBy(ordinal).limit(n)


def domain_list(df: DataFrame, ordinal: str, column: str = "domain", n: int | None = 100) -> DataFrame:
    """Cleaned, non-blank, distinct domains off the blacklist, the first n by ordinal."""
    cleaned = df.where(F.col(column).isNotNull()).select(urls.clean_domain(F.col(column)).alias(column), ordinal).where(F.col(column) != "")
    kept = without(distinct_in_order(cleaned, column, ordinal), column)
    return head(kept, ordinal, n) if n is not None else kept


def root_counts(df: DataFrame, column: str) -> DataFrame:
    """Registrable labels and their counts."""
    return df.select(urls.to_root(urls.to_host(F.col(column))).alias("root")).where("root IS NOT NULL").groupBy("root").count()


def route(domain: Column, routes: tuple[tuple[str, str], ...] = ROUTES, other: str = "http") -> Column:
    """The route of the first pattern that the domain contains."""
    out = F.lit(other)
    for pattern, name in reversed(routes):
        out = F.when(F.lower(domain).contains(pattern), name).otherwise(out)
    return out


def found(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def status(logo: Column) -> Column:
    """What a result column says: missing, error, file, inline or url."""
    return (
        F.when(~found(logo) | logo.isNull(), "missing")
        .when(logo.startswith("local_file:"), "file")
        .when(logo.startswith("data:"), "inline")
        .when(logo.rlike("^https?://"), "url")
        .otherwise("error")
    )


def failed(df: DataFrame, column: str = "logo_url") -> DataFrame:
    return df.where(F.col(column).isNull() | (F.col(column) == ""))


def split_by_file(df: DataFrame, column: str = "logo_url") -> tuple[DataFrame, DataFrame]:
    """(rows with a saved file, all others)."""
    good = F.coalesce(F.col(column).startswith("local_file:"), F.lit(False))
    return df.where(good), df.where(~good)


def found_rate(df: DataFrame, column: str = "logo_url") -> DataFrame:
    """found, total, percent; an empty table has a null percentage."""
    hit = F.count_if(found(F.col(column)))
    return df.agg(hit.alias("found"), F.count(F.lit(1)).alias("total"), (F.try_divide(hit, F.count(F.lit(1))) * 100).alias("percent"))


def summary(df: DataFrame, column: str = "logo_url") -> DataFrame:
    good = F.coalesce(F.col(column).startswith("local_file:"), F.lit(False))
    return df.agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"), F.count(F.lit(1)).alias("total"))


def patch(results: DataFrame, second: DataFrame, key: str = "website", value: str = "logo_url") -> DataFrame:
    """Blank values take that of a second pass: of several results of a key the first found
    one, by its ordinal column `ord`; only the first row of a repeated key, by `ord`, is patched.
    """
    better = second.where(found(F.col(value))).groupBy(F.col(key).alias("_key")).agg(F.min_by(value, "ord").alias("_value"))
    first = Window.partitionBy(key).orderBy("ord")
    numbered = results.withColumn("_n", F.when(~found(F.col(value)) | F.col(value).isNull(), F.row_number().over(first)))
    joined = numbered.join(better, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(value, F.when(F.col("_n") == 1, F.coalesce("_value", F.col(value), F.lit(""))).otherwise(F.col(value))).drop("_n", "_key", "_value")


def first_attempt(attempts: DataFrame, key: str = "domain", priority: str = "priority", value: str = "logo_url") -> DataFrame:
    """A cascade as data: of each key's attempts the found one of the smallest priority; without any, an empty value and status missing."""
    rank = Window.partitionBy(key).orderBy(F.when(found(F.col(value)), 0).otherwise(1), priority)
    best = attempts.withColumn("_n", F.row_number().over(rank)).where("_n = 1")
    return best.select(key, F.when(found(F.col(value)), F.col(value)).otherwise("").alias(value), F.when(found(F.col(value)), F.col("step")).alias("step"), status(F.col(value)).alias("status"))


def second_pass(results: DataFrame, attempt, key: str = "website", value: str = "logo_url") -> DataFrame:
    """Runs attempt(DataFrame of failed rows) -> DataFrame with key, value, ord, and patches what it found."""
    return patch(results, attempt(failed(results, value)), key, value)


def status_counts(df: DataFrame, column: str = "status") -> DataFrame:
    return df.groupBy(column).count()
