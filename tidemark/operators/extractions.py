"""Replies of an extractor to typed rows: tolerant parsing, defaults, repair, validation with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import first_amount, lenient_number

#: Kinds that a row may state. Fixed values.
DEAL_TYPES = ("M&A", "partnership", "licensing", "option-to-license")


#: Arrays and objects around an extraction that are looked into.
DEPTH = 4


def _is_extraction(json: Column) -> Column:
    keys = F.json_object_keys(json)
    return F.coalesce(F.arrays_overlap(keys, F.array(*(F.lit(k) for k in ("money", "parties", "key_evidence")))), F.lit(False))


def _inside(json: Column) -> Column:
    """The elements of an array, or the values of an object, as JSON texts; none of other values."""
    kind = F.substring(F.ltrim(json), 1, 1)
    values = F.when(kind == "[", F.from_json(json, "array<string>")).when(kind == "{", F.map_values(F.from_json(json, "map<string,string>")))
    return F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda x: x.isNotNull())


def extractions_of(raw: str = "raw_json") -> Column:
    """All extractions of a reply as JSON texts in order: bare, in arrays, or in objects under whatever keys; null if unreadable.

    A readable reply without any is itself the one, so that what it lacks is told.
    """
    found = F.array(F.col(raw))
    for _ in range(DEPTH):
        found = F.flatten(F.transform(found, lambda j: F.when(_is_extraction(j), F.array(j)).otherwise(_inside(j))))
    found = F.filter(found, _is_extraction)
    found = F.when(F.size(found) > 0, found).otherwise(F.array(F.col(raw)))
    return F.when(F.expr(f"try_parse_json({raw})").isNotNull(), found)


def _text(json: Column, path: str) -> Column:
    return F.get_json_object(json, path)


def _default(json: Column, key: str, value: str) -> Column:
    """The key's value; the default only where the key is missing, so that an explicit null stays null."""
    return F.when(F.array_contains(F.json_object_keys(json), key), _text(json, f"$.{key}")).otherwise(F.lit(value))


def parsed(extractions: DataFrame) -> DataFrame:
    """One flat row an extraction, several of a reply by part from 0, money repaired from the quoted evidence where all of it is missing.

    An unreadable or null reply is one row without values.
    """
    j = F.col("j")
    rows = extractions.select("extraction_id", "url", F.posexplode_outer(extractions_of()).alias("part", "j")).withColumn("part", F.coalesce("part", F.lit(0)))
    money = {f: lenient_number(_text(j, f"$.money.{f}")) for f in ("upfront_value", "contingent_payment", "total_deal_value")}
    rows = rows.select(
        "extraction_id",
        "part",
        "j",
        F.coalesce(_text(j, "$.url"), "url").alias("url"),
        _text(j, "$.parties.target").alias("target"),
        _text(j, "$.parties.acquirer").alias("acquirer"),
        *(c.alias(f) for f, c in money.items()),
        _text(j, "$.money.currency").alias("currency"),
        _text(j, "$.deal_type").alias("deal_type"),
        _text(j, "$.date_announced").alias("date_announced"),
        _default(j, "asset_focus", "Undisclosed").alias("asset_focus"),
        _default(j, "stage", "unknown").alias("stage"),
        _text(j, "$.therapeutic_area_match").alias("therapeutic_area_match"),
        _text(j, "$.geography").alias("geography"),
        _default(j, "confidence", "medium").alias("confidence"),
        _text(j, "$.key_evidence").alias("key_evidence"),
    )
    none = F.coalesce("upfront_value", "contingent_payment", "total_deal_value").isNull()
    told = first_amount(F.col("key_evidence"))
    rows = rows.withColumn("told", F.when(none & (F.coalesce("key_evidence", F.lit("")) != ""), told))
    rows = rows.withColumn("total_deal_value", F.coalesce("total_deal_value", "told.value", F.col("upfront_value") + F.col("contingent_payment")))
    rows = rows.withColumn("currency", F.coalesce("told.currency", "currency", F.lit("USD")))
    mismatch = F.abs(F.col("total_deal_value") - F.col("upfront_value") - F.col("contingent_payment")) > 1
    return rows.withColumn("total_mismatch", F.coalesce(mismatch, F.lit(False))).drop("told")


def confidence_value(word: Column) -> Column:
    """0.9, 0.7 or 0.5 for high, medium, low; 0.7 for any other."""
    return F.when(word == "high", F.lit("0.90")).when(word == "low", F.lit("0.50")).otherwise(F.lit("0.70")).cast("decimal(3,2)")


def iso_day(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.expr("try_to_date(substring(date_announced, 1, 10), 'yyyy-MM-dd')"))


def validated(rows: DataFrame) -> DataFrame:
    """Parsed rows with reject_reason: null for good ones, else why no typed row comes of it.

    Zero amounts become null. Reasons: null_extraction (no readable reply), parse_failed (no url), model_error (a party
    or the date is missing, the kind is unknown, stage or asset is null, the url is none).
    """
    out = rows.withColumn("day", iso_day(F.col("date_announced")))
    for f in ("upfront_value", "contingent_payment", "total_deal_value"):
        out = out.withColumn(f, F.nullif(F.col(f), F.lit(0.0)))
    bad = F.col("target").isNull() | F.col("acquirer").isNull() | F.col("day").isNull() | ~F.coalesce(F.col("deal_type").isin(*DEAL_TYPES), F.lit(False))
    bad = bad | F.col("stage").isNull() | F.col("asset_focus").isNull() | ~F.col("url").rlike("(?i)^https?://[^/]+")
    reason = F.when(F.col("j").isNull(), "null_extraction").when(F.col("url").isNull(), "parse_failed").when(bad, "model_error")
    return out.withColumn("reject_reason", reason)


def last_per_url(extractions: DataFrame, seq: str = "extraction_id") -> DataFrame:
    """The last reply of each url; replies without one are lost."""
    rows = extractions.where("url is not null")
    return rows.groupBy("url").agg(F.max_by("raw_json", seq).alias("raw_json"), F.max(seq).alias(seq))


def mapped_back(articles: DataFrame, extractions: DataFrame) -> DataFrame:
    """Every article, repeated urls too, with the last reply to its url or null."""
    return articles.join(last_per_url(extractions).select("url", "raw_json", "extraction_id"), "url", "left")
