"""Amounts in many units to whole units of one currency."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Context, Decimal, InvalidOperation

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.functions.units import resolve
from tidemark.session import stage

FIELDS = ("upfront_value", "total_deal_value")
#: Below this, a bare figure is in millions.
MILLIONS_BELOW = 1_000_000

_NUMBER = re.compile(r"(?<![\w.,])[-−+]?\d(?:[\d]|[.,'’](?=\d))*(?:[eE][+]?\d+)?|(?<=[A-Za-z$€£¥₹₩~≈(])\d(?:[\d]|[.,'’](?=\d))*(?:[eE][+]?\d+)?")
_GERMAN = re.compile(r"\b(?:mio|mrd|tsd|millionen|milliarden|tausend)\b", re.I)
#: Number words. Fixed values.
_ONES = dict(zip("one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(), range(1, 20)))
_TENS = dict(zip("twenty thirty forty fifty sixty seventy eighty ninety".split(), range(20, 100, 10)))
_WORDS = re.compile(r"\b(?:a hundred|(?:(?:%s)\s+hundred(?:\s+and)?\s*)?(?:(?:%s)(?:[\s-]+(?:%s))?|(?:%s))?)\b(?!-)" % (*["|".join(_ONES)], "|".join(_TENS), "|".join(_ONES), "|".join(_ONES)), re.I)


def figure(text: str, german: bool = False) -> Decimal | None:
    """A written figure; commas group thousands, or mark decimals where they can't or the wording is German."""
    t = text.replace("−", "-").replace("'", "").replace("’", "")
    m, _, e = t.lower().partition("e")
    if german:
        m = m.replace(".", "") if "," in m or re.fullmatch(r"[-+]?\d{1,3}(?:\.\d{3})+", m) else m
        m = m.replace(",", ".")
    elif "," in m and "." in m:
        m = m.replace(",", "") if m.rindex(".") > m.rindex(",") else m.replace(".", "").replace(",", ".")
    elif "," in m:
        m = m.replace(",", "") if re.fullmatch(r"[-+]?\d{1,3}(?:,\d{2,3})*,\d{3}", m) else m.replace(",", ".")
    elif m.count(".") > 1:
        m = m.replace(".", "")
    try:
        return Decimal(m).scaleb(int(e or 0)) if abs(int(e or 0)) < 30 else None
    except (InvalidOperation, ValueError):
        return None


def spelled_figure(text: str) -> tuple[Decimal, str] | None:
    """A figure in words and the text without it."""
    for m in _WORDS.finditer(text):
        words = [w for w in re.split(r"[\s-]+", m.group().lower()) if w]
        if not words:
            continue
        n = 0
        for w in words:
            n = n * 100 if w == "hundred" else n + (_ONES.get(w) or _TENS.get(w) or (1 if w == "a" else 0))
        if n:
            return Decimal(n), text[: m.start()] + " " + text[m.end() :]
    return None


class _Literal(str):
    """A JSON number as it is written."""


def extraction_of(raw: str | None) -> dict | None:
    """The one extraction in a reply, bare or wrapped in arrays and objects; None if unreadable."""
    try:
        found = json.loads(raw or "", parse_float=_Literal, parse_int=_Literal, parse_constant=lambda _: None)
    except (ValueError, RecursionError):
        return None
    todo = [found]
    while todo:
        x = todo.pop(0)
        if isinstance(x, dict):
            if "money" in x or "parties" in x or "key_evidence" in x:
                return x
            todo += list(x.values())
        elif isinstance(x, list):
            todo += x
    return None


def reading(value: object) -> tuple[Decimal, str, bool] | None:
    """The single figure of a value, the text around it, and whether the figure has an exponent as its scale."""
    if isinstance(value, _Literal):
        n = figure(value)
        return (n, "", "e" in value.lower()) if n is not None else None
    if not isinstance(value, str) or isinstance(value, bool):
        return None
    found = list(_NUMBER.finditer(value))
    if len(found) > 1:
        return None
    if found:
        m = found[0]
        n = figure(m.group(), _GERMAN.search(value) is not None)
        return (n, f"{value[: m.start()]} {value[m.end() :]}".strip(), "e" in m.group().lower()) if n is not None else None
    words = spelled_figure(value)
    return (words[0], words[1].strip(), False) if words else None


_BEFORE = re.compile(r"((?:[A-Za-z]{0,3}[$€£¥₹₩]|\b(?:[A-Z]{3,5}|Rs\.?|SFr\.?|Euro|kr\.?))\s?)$")
_AFTER = re.compile(r"\s?((?:[^\W\d_]+\.?|[$€£¥₹₩])(?:\s(?:[^\W\d_]+\.?|[A-Za-z]{0,3}[$€£¥₹₩])){0,3})")


def told_with(evidence: str | None, n: Decimal) -> list[tuple[str, str]]:
    """What stands before and after each mention of the same figure in a text."""
    out = []
    if isinstance(evidence, str):
        for m in _NUMBER.finditer(evidence):
            after = _AFTER.match(evidence, m.end())
            rest = after.group(1) if after else ""
            if figure(m.group(), _GERMAN.search(rest) is not None) != n:
                continue
            before = _BEFORE.search(evidence[: m.start()])
            if before or rest:
                out.append((before.group(1).strip() if before else "", rest))
    return out


#: Wide enough for any figure here times scale and rate, without rounding.
_WIDE = Context(prec=400, rounding=ROUND_HALF_UP)
#: What the figure column holds at most. It is only compared with MILLIONS_BELOW; amounts come of the exact figure.
_MOST = Decimal(10) ** 25

_READ = "extraction_id bigint, field_name string, figure decimal(38,12), exact string, exponent boolean, unit string, currency string, told array<string>"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for i, raw in zip(pdf["extraction_id"], pdf["raw_json"]):
            found = extraction_of(raw)
            money = found.get("money") if found else None
            if not isinstance(money, dict):
                continue
            for field in FIELDS:
                got = reading(money.get(field))
                if got is None or not 0 < got[0]:
                    continue
                currency = money.get("currency")
                currency = currency.strip() if isinstance(currency, str) and currency.strip() else None
                told = [f"{a} {b}".strip() for a, b in told_with(found.get("key_evidence"), got[0])]
                rows.append((i, field, min(got[0], _MOST).quantize(Decimal("1e-12"), context=_WIDE), str(got[0]), got[2], got[1].lower(), currency and currency.lower(), told))
        yield pd.DataFrame(rows, columns=["extraction_id", "field_name", "figure", "exact", "exponent", "unit", "currency", "told"])


def _lookup(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for s, told in zip(pdf["spelling"], pdf["told"]):
            u = resolve(s, prefix=bool(told))
            rows.append((s, told, u is not None, u.currency if u else None, u.scale if u else None))
        yield pd.DataFrame(rows, columns=["spelling", "told", "known", "code", "scale"]).astype({"scale": "Int64"})


@F.pandas_udf(LongType())
def _dollars(exact: pd.Series, rate: pd.Series, scale: pd.Series) -> pd.Series:
    """Whole dollars, half up; null beyond 64 bits."""
    out = []
    for x, r, s in zip(exact, rate, scale):
        n = None if r is None else int(_WIDE.multiply(_WIDE.multiply(Decimal(x), r), s).to_integral_value(ROUND_HALF_UP))
        out.append(n if n is not None and n < 1 << 63 else None)
    return pd.Series(out, dtype="Int64")


def usd_amounts(extractions: DataFrame, rates: DataFrame) -> DataFrame:
    """extraction_id, field_name, usd_amount (whole dollars, half up) of each value that gives a single amount above 0.

    No amounts: unreadable JSON, null or missing values, money that is no object, vague amounts, ranges, zero and
    below, dollars beyond 64 bits, currencies without a rate. Repeated extractions give theirs each; of repeated rates the largest counts.
    """
    read = stage(extractions.select("extraction_id", "raw_json").mapInPandas(_read, _READ), "figures")
    own = read.select(F.col("unit").alias("spelling"), F.lit(False).alias("told"))
    named = read.where("currency is not null").select("currency", F.lit(False))
    told = read.select(F.explode("told"), F.lit(True))
    spellings = own.union(named).union(told).distinct()
    # A number given, so that small rows which take long are not put together in one task.
    tasks = max(int(spellings.sparkSession.conf.get("spark.sql.shuffle.partitions")), spellings.sparkSession.sparkContext.defaultParallelism)
    words = stage(spellings.repartition(tasks, "spelling").mapInPandas(_lookup, "spelling string, told boolean, known boolean, code string, scale bigint"), "units")

    def named_as(prefix: str, is_told: bool) -> DataFrame:
        return words.where(F.col("told") == is_told).select(*(F.col(c).alias(f"{prefix}_{c}") for c in ("spelling", "known", "code", "scale")))

    rows = read.join(named_as("own", False), F.col("unit") == F.col("own_spelling")).where("own_known")
    rows = rows.join(named_as("named", False), F.col("currency") == F.col("named_spelling"), "left")
    mentions = read.select("extraction_id", "field_name", F.posexplode("told").alias("at", "mention")).join(named_as("told", True), F.col("mention") == F.col("told_spelling"))
    # One mention a value: the first with a scale for the scale, the first with a currency for the currency.
    first = mentions.groupBy("extraction_id", "field_name").agg(
        F.min_by("told_scale", F.when(F.col("told_scale").isNotNull(), F.col("at"))).alias("told_scale"),
        F.min_by("told_code", F.when(F.col("told_code").isNotNull(), F.col("at"))).alias("told_code"),
    )
    rows = rows.join(first, ["extraction_id", "field_name"], "left")
    unreadable = F.col("currency").isNotNull() & ~F.coalesce("named_known", F.lit(False))
    code = F.coalesce("own_code", F.when(unreadable, F.lit("?")), "named_code", "told_code", F.lit("USD"))
    single = F.col("exponent") | F.col("own_code").isNotNull() | (F.col("figure") >= MILLIONS_BELOW)
    scale = F.coalesce("own_scale", F.when(F.col("exponent") | F.col("own_code").isNotNull(), F.lit(1)), "told_scale", F.when(single, F.lit(1)).otherwise(F.lit(1_000_000)))
    worth = rates.groupBy(F.upper("currency").alias("code")).agg(F.max("rate").alias("rate"))
    out = rows.select("extraction_id", "field_name", "exact", code.alias("code"), scale.cast("decimal(14,0)").alias("scale")).join(worth, "code")
    return out.select("extraction_id", "field_name", _dollars("exact", "rate", "scale").alias("usd_amount")).where("usd_amount > 0")
