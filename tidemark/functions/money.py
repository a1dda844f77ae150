"""Amounts told in text, exchange, and lenient numbers of replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An amount with its unit. Fixed pattern.
_FIRST = r"(?iU)([€£$¥])?\s*(\d+(?:\.\d+)?)\s*(million|billion|M|B)"


def first_amount(text: Column) -> Column:
    """struct<value double, currency string> in millions of the first amount with a unit; null without one.

    There is no word boundary: '3 months' is 3 million and '1,500 million' 500.
    """
    number = F.nullif(F.regexp_extract(text, _FIRST, 2), F.lit("")).try_cast("double")
    unit = F.lower(F.regexp_extract(text, _FIRST, 3))
    symbol = F.regexp_extract(text, _FIRST, 1)
    value = F.when(unit.isin("billion", "b"), number * 1000).otherwise(number)
    currency = F.when(symbol == "€", "EUR").when(symbol == "£", "GBP").when(symbol == "¥", "JPY").otherwise("USD")
    return F.when(number.isNotNull(), F.struct(value.alias("value"), currency.alias("currency")))


def lenient_number(text: Column) -> Column:
    """A plain number that is not negative; anything else, also with thousands separators, is null."""
    plain = text.rlike(r"^\s*[-+]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?\s*$")
    v = F.when(plain, F.trim(text).try_cast("double"))
    return F.when(v >= 0, v)


def exchange(amount: Column, currency: Column, rate: Column, source: Column, base: str = "USD") -> Column:
    """struct<amount, rate, source>; an unknown rate gives nulls and the source 'Unavailable'."""
    own = F.upper(currency) == base
    r = F.when(own, F.lit(1).cast("decimal(18,8)")).otherwise(rate)
    return F.struct((amount * r).alias("amount"), r.alias("rate"), F.when(r.isNull(), "Unavailable").otherwise(source).alias("source"))


def previous_business_day(day: Column) -> Column:
    back = F.when(F.weekday(day) == 0, 3).when(F.weekday(day) == 6, 2).otherwise(1)
    return F.date_sub(day, back)


def as_of(rows: DataFrame, rates: DataFrame, key: str, day: str, lookback: int) -> DataFrame:
    """Rows with the rate of the same key on the row's day or the latest of so many days before it; null without one.

    Both sides are cut into slots of that many days, so that the join is one of equal keys and a busy key has many tasks.
    """
    span = lookback + 1
    slot = F.floor(F.unix_date(day) / span)
    told = rates.groupBy(key, F.col(day).alias("_day")).agg(F.max("rate").alias("rate"))
    own = F.floor(F.unix_date("_day") / span)
    told = told.select(F.col(key).alias("_key"), "_day", "rate", F.explode(F.array(own, own + 1)).alias("_slot"))
    keyed = rows.withColumns({"_row": F.monotonically_increasing_id(), "_slot": slot})
    near = (F.col(key) == F.col("_key")) & (keyed["_slot"] == told["_slot"]) & (F.col("_day") <= F.col(day)) & (F.date_diff(F.col(day), F.col("_day")) <= lookback)
    found = keyed.join(told, near, "left").groupBy("_row", *(F.col(f"`{c}`") for c in rows.columns)).agg(F.max_by("rate", "_day").alias("rate"))
    return found.drop("_row")
