"""Row filters of the funnel; each keeps the conditions in the plan, so that they reach the scan where they can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Urls of compilations and notices. Fixed patterns.
URL_REJECTS = (
    r"/financings?(-roundup)?/?$",
    "/appointments-and-advancements",
    "/other-news-to-note",
    r"/earnings/?$",
    "/regulatory-front",
    "/in-the-clinic",
    "/week-in-review",
    "/word-on-the-street",
    r"collaborations-.*-agreements-.*-\d{4}",
    "manufacturing-marketing-and-distribution-agreements",
    "money-raised-by-biotech",
    "top-.*-deals",
    "top-.*-financings",
    "biotech-.*-collaborations-.*-agreements",
)


def valid_date(date: str = "published_date") -> Column:
    return F.length(F.coalesce(date, F.lit(""))) >= 10


def in_dates(lo: str, hi: str, date: str = "published_date") -> Column:
    """Both ends inclusive, as strings: an instant on the last day is past its date."""
    return F.col(date).between(lo, hi)


def rejected_url(url: str = "url", patterns: tuple = URL_REJECTS) -> Column:
    return F.coalesce(F.col(url), F.lit("")).rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))


def site_allows(rows: DataFrame, rules: DataFrame, site: str = "source", url: str = "url") -> DataFrame:
    """Rows that their site's rules (site, kind allow|block, pattern) keep.

    A site without rules keeps all; a block that hits drops; with allows, one has to hit. Rules are one row a site
    after grouping, and the patterns of a site one alternation.
    """
    one = rules.groupBy("site").agg(*(F.array_join(F.collect_set(F.when(F.col("kind") == k, F.concat(F.lit("(?:"), "pattern", F.lit(")")))), "|").alias(k) for k in ("block", "allow")))
    j = rows.join(one, F.col(site) == F.col("site"), "left")
    blocked = (F.coalesce("block", F.lit("")) != "") & F.expr(f"{url} rlike block")
    allowed = (F.coalesce("allow", F.lit("")) == "") | F.coalesce(F.expr(f"{url} rlike allow"), F.lit(False))
    return j.where(~F.coalesce(blocked, F.lit(False)) & allowed).select(*[rows[c] for c in rows.columns])


def archive_year(url: Column) -> Column:
    year = F.coalesce(F.nullif(F.regexp_extract(url, r"(?i)sitemap-(\d{4})", 1), F.lit("")), F.nullif(F.regexp_extract(url, r"_(\d{4})\.xml", 1), F.lit("")))
    return year.cast("int")


def recent_archives(urls: DataFrame, least_year: int) -> DataFrame:
    """Sitemaps of topics and footers go; dated ones before the year go; undated ones stay."""
    y = archive_year(F.col("url"))
    return urls.where(~F.col("url").contains("sitemap-topics") & ~F.col("url").contains("sitemap-footer") & (y.isNull() | (y >= least_year)))


def long_enough(text: str = "content", chars: int = 500) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) >= chars


def fetched_since(start: str, end: str, date: str = "published_date") -> Column:
    """An undated row counts as of the end."""
    return F.coalesce(F.col(date), F.lit(end)) >= start


def required(*cols: str) -> Column:
    """Null where all are filled, else the reason."""
    gone = None
    for c in cols:
        one = F.coalesce(F.col(c), F.lit("")) == ""
        gone = one if gone is None else gone | one
    return F.when(gone, F.lit("Missing required fields"))


def checked_keywords(words: Column, least: int = 3) -> Column:
    """Trimmed words without blanks; a shorter one than allowed is an error."""
    kept = F.filter(F.transform(words, lambda w: F.trim(w)), lambda w: w != "")
    return F.when(F.exists(kept, lambda w: F.length(w) < least), F.raise_error(F.lit(f"a keyword has fewer than {least} characters"))).otherwise(kept)
