"""Feeds and sitemaps: XML to one row an entry, by Spark's own reader; compressed files by their suffix."""

from __future__ import annotations

from pyspark.errors import AnalysisException, UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.filters import recent_archives

_DISCOVERED = ("url", "title", "published_date", "source")


def rfc_time(text: Column) -> Column:
    """The weekday goes: Spark does not parse it."""
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")))


def iso_time(text: Column) -> Column:
    """Without a zone, UTC."""
    return F.coalesce(F.try_to_timestamp(F.trim(text)), F.try_to_timestamp(F.trim(text), F.lit("yyyy-MM-dd'T'HH:mmXXX")))


def _since(rows: DataFrame, start: str | None) -> DataFrame:
    """Entries before the start go; undated and future ones stay."""
    rows = rows.withColumn("published_date", F.date_format("ts", "yyyy-MM-dd"))
    return (rows.where(F.col("ts").isNull() | (F.col("ts") >= F.lit(start).cast("timestamp"))) if start else rows).select(*_DISCOVERED)


def _xml(spark: SparkSession, paths: list[str], tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(paths)


def rss(spark: SparkSession, paths: list[str], start: str | None = None) -> DataFrame:
    rows = _xml(spark, paths, "item", "title string, link string, pubDate string").where("link is not null")
    return _since(rows.select(F.trim("link").alias("url"), F.trim(F.coalesce("title", F.lit(""))).alias("title"), rfc_time(F.col("pubDate")).alias("ts"), F.lit("RSS").alias("source")), start)


def atom(spark: SparkSession, paths: list[str], start: str | None = None) -> DataFrame:
    rows = _xml(spark, paths, "entry", "title string, link struct<_href:string>, updated string").where("link._href is not null")
    return _since(rows.select(F.col("link._href").alias("url"), F.trim(F.coalesce("title", F.lit(""))).alias("title"), iso_time(F.col("updated")).alias("ts"), F.lit("Atom").alias("source")), start)


def feed(spark: SparkSession, path: str, start: str | None = None) -> DataFrame:
    """RSS, or Atom where that has no entry."""
    found = rss(spark, [path], start)
    return atom(spark, [path], start) if found.isEmpty() else found


def sitemap(spark: SparkSession, paths: list[str], start: str | None = None) -> DataFrame:
    rows = _xml(spark, paths, "url", "loc string, lastmod string").where("loc is not null")
    return _since(rows.select(F.trim("loc").alias("url"), F.lit("").alias("title"), iso_time(F.col("lastmod")).alias("ts"), F.lit("Sitemap").alias("source")), start)


def sitemaps_of(spark: SparkSession, index: str, least_year: int | None = None, most: int = 10, depth: int = 5) -> list[str]:
    """The sitemaps under an index, indexes in it followed to a depth, old archives pruned, of each index the first so many by url.

    An index met again is not followed again. What can't be read from here is a sitemap of pages as far as we know.
    """
    found, seen, level = [], {index}, [index]
    for _ in range(depth):
        below = []
        for path in level:
            try:
                rows = _xml(spark, [path], "sitemap", "loc string").where("loc is not null").select(F.trim("loc").alias("url")).distinct()
                listed = [r.url for r in (recent_archives(rows, least_year) if least_year else rows).orderBy("url").limit(most).collect()]
            except (AnalysisException, UnsupportedOperationException):
                if path == index:
                    raise
                listed = []
            if not listed and path != index:
                found.append(path)  # it lists pages
            below += [u for u in listed if u not in seen and not seen.add(u)]
        level = below
        if not level:
            break
    return found + level


def archive_months(pattern: str, start: str, end: str, spark: SparkSession) -> DataFrame:
    """url, month of each month's archive page, both ends included."""
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit(start).cast("date"), "month"), F.lit(end).cast("date"), F.expr("interval 1 month"))).alias("month"))
    url = F.replace(F.replace(F.lit(pattern), F.lit("{year}"), F.date_format("month", "yyyy")), F.lit("{month}"), F.date_format("month", "MM"))
    return months.select(url.alias("url"), F.date_format("month", "yyyy-MM-dd").alias("month"))


def links(pages: DataFrame, base: str) -> DataFrame:
    """Different links of pages (html, published_date), made absolute."""
    hrefs = F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]+)"'), F.lit(1)))
    rows = pages.select(hrefs.alias("url"), "published_date")
    return rows.withColumn("url", F.when(F.startswith("url", F.lit("/")), F.concat(F.lit(base), "url")).otherwise(F.col("url"))).groupBy("url").agg(F.min("published_date").alias("published_date"))


def is_challenge(html: Column) -> Column:
    """A short page of a guard instead of the article."""
    low = F.lower(html)
    return low.contains("cloudflare") & low.contains("ray id:") & (F.length(html) < 5000)
