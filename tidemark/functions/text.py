"""Text functions as Column expressions; only Unicode folding and HTML need Python."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Legal suffixes in the order they are stripped. Fixed values.
LEGAL_SUFFIXES = (
    "inc", "incorporated", "ltd", "limited", "plc", "corp", "corporation", "ag", "sa", "llc", "llp", "lp", "co", "company",
    "pharmaceuticals", "pharma", "therapeutics", "biotech", "biotechnology",
)
#: Words that say nothing about an amount. Fixed values.
AMOUNT_NOISE = ("approximately", "about", "around", "up to", "upto", "roughly")
_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
#: Date notations by precedence. Fixed patterns.
DATE_PATTERNS = (
    r"\b\d{4}-\d{2}-\d{2}\b",
    rf"\b(?:{_MONTHS})\s+\d{{1,2}},?\s+\d{{4}}\b",
    rf"\b\d{{1,2}}\s+(?:{_MONTHS})\s+\d{{4}}\b",
    r"\b\d{1,2}/\d{1,2}/\d{4}\b",
)
#: Countries by the words that name them, in order. Fixed values.
COUNTRY_WORDS = {
    "United States": r"U\.?S\.?|USA|United States|California|Massachusetts|New York|Texas|boston|san francisco|san diego",
    "United Kingdom": r"U\.?K\.?|United Kingdom|England|London|Cambridge|Oxford",
    "Germany": "Germany|Berlin|Munich|Heidelberg",
    "Switzerland": "Switzerland|Swiss|Basel|Zurich",
    "France": "France|Paris|French",
    "China": "China|Chinese|Beijing|Shanghai",
    "Japan": "Japan|Japanese|Tokyo|Osaka",
    "Canada": "Canada|Canadian|Toronto|Montreal",
    "Israel": "Israel|Israeli|Tel Aviv",
    "Denmark": "Denmark|Danish|Copenhagen",
    "Sweden": "Sweden|Swedish|Stockholm",
    "Netherlands": "Netherlands|Dutch|Amsterdam",
    "Belgium": "Belgium|Belgian|Brussels",
    "Italy": "Italy|Italian|Rome|Milan",
    "Spain": "Spain|Spanish|Madrid|Barcelona",
    "Australia": "Australia|Australian|Sydney|Melbourne",
}
#: Countries by a part of the url, in order. Fixed values.
COUNTRY_DOMAINS = {
    ".com": "United States", ".co.uk": "United Kingdom", ".uk": "United Kingdom", ".de": "Germany", ".ch": "Switzerland", ".fr": "France", ".cn": "China", ".jp": "Japan", ".ca": "Canada",
    ".il": "Israel", ".dk": "Denmark", ".se": "Sweden", ".nl": "Netherlands", ".be": "Belgium", ".it": "Italy", ".es": "Spain", ".au": "Australia",
}


@F.pandas_udf(StringType())
def normalize_text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Lower case ASCII with white space as one space; characters without an ASCII base are dropped."""
    for s in parts:
        yield s.map(lambda t: None if t is None else re.sub(r"\s+", " ", unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii").lower()).strip())


def strip_legal_suffixes(name: Column, suffixes: list[str] | tuple = LEGAL_SUFFIXES) -> Column:
    """Each suffix once, in order, with an optional comma before and point after."""
    out = F.trim(name)
    for s in suffixes:
        out = F.trim(F.regexp_replace(out, rf"(?i),?\s+{re.escape(s)}\.?$", ""))
    return out


def extract_snippet(text: Column, phrase: str, context: int = 200) -> Column:
    """The phrase with context on either side and dots where cut; without the phrase, the first 2 * context characters."""
    at = F.locate(phrase.lower(), F.lower(text))
    start = F.greatest(F.lit(1), at - context)
    end = F.least(F.length(text), at - 1 + len(phrase) + context)
    cut = F.substring(text, start, end - start + 1)
    found = F.concat(F.when(start > 1, F.lit("...")).otherwise(F.lit("")), cut, F.when(end < F.length(text), F.lit("...")).otherwise(F.lit("")))
    return F.when(at == 0, F.substring(text, 1, 2 * context)).otherwise(found)


def clean_amount_text(text: Column) -> Column:
    out = F.lower(text)
    for w in AMOUNT_NOISE:
        out = F.regexp_replace(out, rf"\b{w}\b", "")
    return F.trim(F.replace(out, F.lit(","), F.lit("")))


def is_ambiguous_stage(text: Column) -> Column:
    """Phases 1/2 and 1-2; the Roman form does not count, as text is lower-cased first."""
    return F.lower(text).rlike(r"phase\s*1\s*[/\-]\s*2")


def date_from_text(text: Column) -> Column:
    """The first hit of the first notation that hits anywhere."""
    return F.coalesce(*(F.nullif(F.regexp_extract(text, f"(?i){p}", 0), F.lit("")) for p in DATE_PATTERNS))


def country_from_text(text: Column) -> Column:
    """The first country, in order, of which a word occurs. The pronoun us counts as a word of the first."""
    out = F.lit(None).cast("string")
    for country, words in reversed(COUNTRY_WORDS.items()):
        out = F.when(text.rlike(rf"(?i)\b(?:{words})\b"), country).otherwise(out)
    return out


def country_from_url(url: Column) -> Column:
    out = F.lit(None).cast("string")
    for part, country in reversed(COUNTRY_DOMAINS.items()):
        out = F.when(F.contains(F.lower(url), F.lit(part)), country).otherwise(out)
    return out


def document_text(title: Column, content: Column, chars: int = 2500) -> Column:
    """What is embedded: title, a space, the first chars of content."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.substring(F.coalesce(content, F.lit("")), 1, chars))


def snippet_of(document: Column) -> Column:
    """All after the document's first space; empty without one."""
    at = F.instr(document, " ")
    return F.when(at > 0, F.substring(document, at + 1, F.length(document))).otherwise(F.lit(""))


def prefixes(word: Column, least: int = 3) -> Column:
    """All lower-case prefixes of at least so many characters."""
    return F.when(F.length(word) >= least, F.transform(F.sequence(F.lit(least), F.length(word)), lambda n: F.lower(F.substring(word, 1, n)))).otherwise(F.array().cast("array<string>"))


def duration(seconds: Column) -> Column:
    s = F.floor(seconds)
    h, m = F.floor(s / 3600), F.floor((s % 3600) / 60)
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm %ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%dh %dm", h, m))


def cache_key(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *parts))


def domain(url: Column) -> Column:
    """Host with port and user, as written."""
    return F.try_parse_url(url, F.lit("AUTHORITY"))


def absolute(href: Column, base: Column) -> Column:
    return F.when(F.startswith(href, F.lit("/")), F.concat(F.regexp_extract(base, r"^[a-z]+://[^/]+", 0), href)).otherwise(href)


def label(text: Column) -> Column:
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))


class _Text(HTMLParser):
    """Text nodes without comments, scripts, styles and templates."""

    _SKIP = ("script", "style", "template")

    def __init__(self):
        super().__init__()
        self.parts: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.depth += tag in self._SKIP

    def handle_endtag(self, tag: str) -> None:
        self.depth -= tag in self._SKIP and self.depth > 0

    def handle_data(self, data: str) -> None:
        if not self.depth and data.strip():
            self.parts.append(data.strip())


def text_of_html(html: str) -> str:
    p = _Text()
    p.feed(html)
    p.close()
    return " ".join(p.parts)


@F.pandas_udf(StringType())
def html_text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda t: None if t is None else text_of_html(t))
