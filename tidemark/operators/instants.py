"""Mixed time notations to one UTC second.

A value's shape mask keeps one class letter a character: figures, letters, the rest as is. A worker meets few masks;
each is compiled once into a parser of fixed columns (or into a refusal), and all values of one mask are converted
together from a matrix of code points. Local clocks go through zone transition tables (functions/zones.py).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.zones import local_to_utc, version

#: Months by name and abbreviation, English and German. Fixed values.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
    "januar": 1, "februar": 2, "märz": 3, "mai": 5, "juni": 6, "juli": 7, "oktober": 10, "dezember": 12, "jän": 1, "mär": 3, "okt": 10, "dez": 12,
}
DAYS = frozenset("mon tue wed thu fri sat sun monday tuesday wednesday thursday friday saturday sunday mo di mi do fr sa so montag dienstag mittwoch donnerstag freitag samstag sonntag".split())
#: Zone letters in minutes east. Fixed values.
LETTERS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "bst": 60, "west": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180, "ist": 330, "sgt": 480, "hkt": 480, "jst": 540, "kst": 540,
    "aest": 600, "aedt": 660, "acst": 570, "acdt": 630, "awst": 480, "nzst": 720, "nzdt": 780, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}
FIELDS = ("published_date", "lastmod", "fetched_at")

_TOKEN = re.compile(r"9+|a+|.", re.S)
_CLASS = str.maketrans({**dict.fromkeys("0123456789", "9")})
_LETTER = re.compile(r"[^\W\d_]")


def shape(value: str) -> str:
    """The mask of a trimmed value: 9 for a figure, a for a letter, other characters as they are."""
    return _LETTER.sub("a", value.translate(_CLASS))


def shapes(values: list[str]) -> list[str]:
    """The masks of values, by a table gather over all of their code points at once."""
    cp = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32)
    met = np.flatnonzero(np.bincount(cp)) if len(cp) else cp
    table = np.zeros(int(met.max()) + 1 if len(met) else 0, np.uint32)
    table[met] = [ord(shape(chr(c))) for c in met]
    whole = table[cp].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    ends = np.cumsum([len(v) for v in values]).tolist()
    return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends)]


_CLOCK = r"(?P<h>9{1,2}):(?P<mi>99)(?::(?P<s>99)(?:[.,](?P<f>9+))?)?"
_ZONE = r"(?: ?(?P<off>[+-]99:?(?:99)?)| ?(?P<zl>a{1,4}))?(?P<zid>\[[a/_]+\])?"
#: Shapes that are read; a named part is a field. Letters are compared after the mask fits.
_SHAPES = [
    re.compile(p)
    for p in (
        rf"(?P<y>9999)-(?P<mo>99)-(?P<d>99)(?:(?P<t>a| ){_CLOCK}{_ZONE})?",
        rf"(?P<y>9999)/(?P<mo>99)/(?P<d>99)(?: {_CLOCK}{_ZONE})?",
        rf"(?P<y>9999)(?P<mo>99)(?P<d>99)(?P<t>a)(?P<h>99)(?P<mi>99)(?P<s>99)?{_ZONE}",
        rf"(?P<y>9999)(?P<mo>99)(?P<d>99)",
        rf"(?:(?P<dow>a+), )?(?P<d>9{{1,2}}) (?P<mon>a+) (?P<y>9999)(?: {_CLOCK}{_ZONE})?",
        rf"(?:(?P<dow>a+), )?(?P<d>9{{1,2}})\. ?(?P<mon>a+) (?P<y>9999)(?:,? {_CLOCK}(?P<uhr> aaa)?)?",
        rf"(?:(?P<dow>a+), )?(?P<mon>a+)\.? (?P<d>9{{1,2}}), (?P<y>9999)(?:,?(?P<at> aa)? {_CLOCK}(?: ?(?P<ap>aa))?{_ZONE})?",
        rf"(?P<n1>9{{1,2}})[/.](?P<n2>9{{1,2}})[/.](?P<y>9999)(?:,? {_CLOCK}(?: ?(?P<ap>aa))?{_ZONE})?",
        r"(?P<e>9{10})",
        r"(?P<e>9{10})\.9+",
        r"(?P<ms>9{13})",
    )
]

Parser = Callable[[np.ndarray, list[str], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970 of a civil date."""
    y = y - (m <= 2)
    era = y // 400
    yoe = y - era * 400
    doy = (153 * (m + np.where(m > 2, -3, 9)) + 2) // 5 + d - 1
    return era * 146097 + yoe * 365 + yoe // 4 - yoe // 100 + doy - 719468


def _month_length(y: np.ndarray, m: np.ndarray) -> np.ndarray:
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    return np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[np.clip(m, 0, 12)] + ((m == 2) & leap)


def _words(values: list[str], span: tuple[int, int], of: Callable[[str], int | None]) -> tuple[np.ndarray, np.ndarray]:
    """A lettered field by its distinct spellings: numbers and whether known."""
    known: dict[str, int | None] = {}
    out, ok = np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    for i, v in enumerate(values):
        w = v[span[0] : span[1]].lower()
        if w not in known:
            known[w] = of(w)
        if (n := known[w]) is not None:
            out[i], ok[i] = n, True
    return out, ok


def _shaped(m: re.Match) -> Parser:
    """The parser of one mask: fixed columns for each field."""
    spans = {k: m.span(k) for k, v in m.groupdict().items() if v is not None}

    def parse(cp: np.ndarray, values: list[str], zones: np.ndarray, month_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(values)

        def number(k: str) -> np.ndarray:
            out = np.zeros(n, np.int64)
            for i in range(*spans[k]):
                out = out * 10 + (cp[:, i].astype(np.int64) - 48)
            return out

        if "e" in spans:
            return number("e"), np.ones(n, bool)
        if "ms" in spans:
            return number("ms") // 1000, np.ones(n, bool)
        ok = np.ones(n, bool)

        def lettered(k: str, of: Callable[[str], int | None]) -> np.ndarray:
            nonlocal ok
            out, fine = _words(values, spans[k], of)
            ok &= fine
            return out

        for k, words in (("t", ("t", " ")), ("at", (" at", " um")), ("uhr", (" uhr",)), ("dow", DAYS)):
            if k in spans:
                lettered(k, lambda w, words=words: 0 if w in words else None)
        y = number("y")
        if "mon" in spans:
            mo, d = lettered("mon", MONTHS.get), number("d")
        elif "n1" in spans:
            a, b = number("n1"), number("n2")
            mo, d = np.where(month_first, a, b), np.where(month_first, b, a)
        else:
            mo, d = number("mo"), number("d")
        ok &= (mo >= 1) & (mo <= 12) & (d >= 1) & (d <= _month_length(y, mo))
        day = _days(y, np.clip(mo, 1, 12), d) * 86400
        if "h" not in spans:
            return day, ok
        h, mi = number("h"), number("mi")
        s = number("s") if "s" in spans else np.zeros(n, np.int64)
        if "ap" in spans:
            late = lettered("ap", {"am": 0, "pm": 1}.get)
            ok &= (h >= 1) & (h <= 12)
            h = h % 12 + 12 * late
        ok &= (h <= 23) & (mi <= 59) & (s <= 59)
        clock = day + h * 3600 + mi * 60 + s
        if "off" in spans:
            a, b = spans["off"]
            sign = np.where(cp[:, a] == ord("-"), -1, 1)
            digits = [cp[:, i].astype(np.int64) - 48 for i in range(a + 1, b) if m.string[i] == "9"]
            minutes = (digits[0] * 10 + digits[1]) * 60 + (digits[2] * 10 + digits[3] if len(digits) > 2 else 0)
            ok &= minutes <= 18 * 60
            return clock - sign * minutes * 60, ok
        if "zl" in spans:
            return clock - lettered("zl", LETTERS.get) * 60, ok
        if "zid" in spans:
            a, b = spans["zid"]
            zones = np.array([v[a + 1 : b - 1] for v in values], object)
        out = clock.copy()
        for z in set(zones.tolist()):
            at = zones == z
            utc = local_to_utc(clock[at], z) if isinstance(z, str) else None
            if utc is None:
                ok = ok & ~at  # a clock of no known zone tells no instant
            else:
                out[at] = utc
        return out, ok

    return parse


_PARSERS: dict[str, Parser | None] = {}


def parser_of(mask: str) -> Parser | None:
    """The mask's parser, compiled at its first value in this worker; None where no shape fits."""
    if mask in _PARSERS:
        return _PARSERS[mask]
    fits = next((m for p in _SHAPES if (m := p.fullmatch(mask))), None)
    parser = _shaped(fits) if fits else None
    if len(mask) < 200:  # longer ones are read, but not remembered
        if len(_PARSERS) > 100_000:  # masks of hostile input
            _PARSERS.clear()
        _PARSERS[mask] = parser
    return parser


def to_utc_seconds(values: pd.Series, zones: pd.Series, month_first: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Seconds since 1970 and whether the value tells a possible date."""
    out, ok = np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    trimmed = [v.strip() if isinstance(v, str) else "" for v in values]
    by_mask: dict[str, list[int]] = {}
    for i, mask in enumerate(shapes(trimmed)):
        if mask:
            by_mask.setdefault(mask, []).append(i)
    z, mf = zones.to_numpy(object), month_first.fillna(False).to_numpy(bool)
    for mask, at in by_mask.items():
        parse = parser_of(mask)
        if parse is None:
            continue
        own = [trimmed[i] for i in at]
        cp = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), len(mask))
        ix = np.array(at)
        out[ix], ok[ix] = parse(cp, own, z[ix], mf[ix])
    return out, ok & (out >= -62135596800) & (out < 253402300800)


def utc_instants(articles: DataFrame, sites: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """article_id, field_name, utc_time (yyyy-MM-ddTHH:mm:ssZ) of every value that tells a possible date.

    A time without zone is on the clock of the site whose host is the url's; without a site it tells no instant, and
    neither do nulls, blanks and unknown notations. All-figure dates follow the site's order, else month last. Rows
    repeated give their values each. Sites are one row a host; of repeated hosts the least row counts. All workers have
    to have the driver's release of the zone tables, else the query fails, as clocks would be read in two ways.
    """
    release = version()
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    clocks = sites.groupBy(F.lower("host").alias("host")).agg(F.min(F.struct("tz", "date_order")).alias("site"))
    rows = articles.select("article_id", host.alias("host"), *fields).join(clocks, "host", "left")
    rows = rows.select("article_id", F.col("site.tz").alias("tz"), (F.col("site.date_order") == "mdy").alias("month_first"), *fields)

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if version() != release:
            raise RuntimeError(f"zone tables of release {version()} here, {release} on the driver")
        for pdf in batches:
            for field in fields:
                t, ok = to_utc_seconds(pdf[field], pdf["tz"], pdf["month_first"])
                text = [f"{x}Z" for x in np.datetime_as_string(t[ok].astype("datetime64[s]"), unit="s")]
                yield pd.DataFrame({"article_id": pdf["article_id"].to_numpy()[ok], "field_name": np.full(len(text), field, object), "utc_time": np.array(text, object)})

    return rows.mapInPandas(convert, "article_id bigint, field_name string, utc_time string")
