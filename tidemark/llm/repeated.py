"""Lines repeated across one source's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

#: A line is repeated excessively from this many rows and this share (one in ...) of its source's rows on.
ROWS, ONE_IN = 5, 10
_SPACE = r"(?U)\s+"


def normal_line(line: F.Column) -> F.Column:
    """Trimmed, white space as one space, lower case, each run of digits as one 0."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(line, _SPACE, " "))), "[0-9]+", "0")


def _lines(articles: DataFrame) -> DataFrame:
    """source, line_text: each different line of each row once; rows whose source or content is null have none."""
    rows = articles.where("source is not null and content is not null")
    cut = F.array_distinct(F.transform(F.split("content", "\n"), normal_line))
    return rows.select("source", F.explode(cut).alias("line_text")).where("line_text <> ''")


def repeated_lines(articles: DataFrame) -> DataFrame:
    """source, line_text of the lines that stand in at least ROWS rows and one in ONE_IN of all rows of their source.

    Lines are counted by hash, so that text never enters the shuffle, partly before it (a hot source costs no more
    than any other); the text is then counted exactly for the few hashes that pass. A source passes fewer hashes than
    ONE_IN times the lines of its mean row. Null sources are left out; blank lines are none; repeated rows count each.
    """
    totals = articles.where("source is not null").groupBy("source").agg(F.count("*").alias("total"))
    lines = _lines(articles)
    counts = lines.groupBy("source", F.xxhash64("line_text").alias("line_hash")).agg(F.count("*").alias("n"))
    often = counts.where(F.col("n") >= ROWS).join(totals, "source").where(F.col("n") * ONE_IN >= F.col("total"))
    often = stage(often.select("source", "line_hash", "total"), "repeated")
    held = lines.withColumn("line_hash", F.xxhash64("line_text")).join(often, ["source", "line_hash"])
    exact = held.groupBy("source", "line_text").agg(F.count("*").alias("n"), F.first("total").alias("total"))
    return exact.where((F.col("n") >= ROWS) & (F.col("n") * ONE_IN >= F.col("total"))).select("source", "line_text")


def without_repeated(articles: DataFrame) -> DataFrame:
    """article_id, content without the lines repeated in its source, n_removed. Rows without source keep their text.

    The repeated lines of a source come as one array of fewer than ONE_IN times its mean row's lines; null content
    stays null.
    """
    found = repeated_lines(articles).groupBy("source").agg(F.collect_set("line_text").alias("gone"))
    rows = articles.select("article_id", "source", "content").join(found, "source", "left")
    cut = F.split("content", "\n")
    kept = F.when(F.col("gone").isNull(), cut).otherwise(F.filter(cut, lambda x: ~F.array_contains("gone", normal_line(x))))
    rows = rows.select("article_id", "content", cut.alias("cut"), kept.alias("kept"))
    return rows.select("article_id", F.array_join("kept", "\n").alias("content"), (F.size("cut") - F.size("kept")).cast("bigint").alias("n_removed"))
