"""Spellings of currencies and scales: a vocabulary, and fuzzy lookup of spellings in it.

A spelling is looked up part by part. Parts missing from the vocabulary get candidates from an inverted index of
character n-grams, which a weighted edit distance verifies. Distinct spellings are few, so each is looked up once and
the result is joined to all rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

#: Spellings of currencies. Fixed values.
CURRENCIES = {
    "USD": "usd us$ u.s.$ $ us-dollar;us dollar;us dollars;u.s. dollars;american dollars;dollar;dollars",
    "EUR": "eur € euro euros",
    "GBP": "gbp £ uk£ gb£ stg;pound;pounds;pounds sterling;british pounds;sterling;quid",
    "JPY": "jpy ¥ jp¥ 円 yen;japanese yen",
    "CHF": "chf sfr fr. sfr.;swiss franc;swiss francs;francs",
    "SEK": "sek kronor;swedish krona;swedish kronor;krona",
    "DKK": "dkk dkr kroner;danish krone;danish kroner;krone",
    "NOK": "nok;norwegian kroner;norwegian krone",
    "CAD": "cad c$ ca$ can$;canadian dollar;canadian dollars",
    "AUD": "aud a$ au$;australian dollar;australian dollars",
    "NZD": "nzd nz$;new zealand dollars",
    "HKD": "hkd hk$;hong kong dollars",
    "SGD": "sgd s$;singapore dollars",
    "INR": "inr ₹ rs rs.;rupee;rupees;indian rupees",
    "CNY": "cny rmb cn¥ 元;yuan;renminbi;chinese yuan",
    "KRW": "krw ₩ won;korean won;south korean won",
    "MXN": "mxn mx$;pesos;peso;mexican pesos",
    "BRL": "brl r$;real;reais;brazilian reais",
    "ILS": "ils ₪;shekel;shekels",
}
#: Spellings of scales. Fixed values.
SCALES = {
    1_000: "k thousand thousands tsd tsd. tausend thsd",
    100_000: "lakh lakhs lac",
    1_000_000: "m mm mn mln mio mio. million millions millionen mill mill. mil m.",
    10_000_000: "cr cr. crore crores",
    1_000_000_000: "b bn bln billion billions mrd mrd. milliarden milliarde md",
    1_000_000_000_000: "tn trn trillion trillions billionen",
}
#: Words that hedge a figure and change nothing. Fixed values.
HEDGES = "~ ≈ about approx approx. approximately roughly around circa ca ca. c. nearly almost some up to as much as an estimated estimated over more than at least rund etwa bis zu".split()
#: Words by which a figure is a range or no figure. Fixed values.
RANGES = "between and to - – — from or".split()


@dataclass(frozen=True)
class Unit:
    currency: str | None = None
    scale: int | None = None
    hedge: bool = False


@cache
def vocabulary() -> dict[str, Unit]:
    out = {h: Unit(hedge=True) for h in HEDGES}
    for scale, names in SCALES.items():
        out |= {n: Unit(scale=scale) for n in names.split()}
    for code, names in CURRENCIES.items():
        words, *phrases = names.split(";")
        for n in [*words.split(), *phrases]:
            out[n] = Unit(currency=code)
        for mark, scale in (("m", 1_000_000), ("k", 1_000), ("bn", 1_000_000_000)):
            out[mark + code.lower()] = Unit(code, scale)
    return out


def _grams(word: str) -> set[str]:
    w = f"^{word}$"
    return {w[i : i + 2] for i in range(len(w) - 1)}


@cache
def _index() -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for name in vocabulary():
        if len(name) >= 4 and not vocabulary()[name].hedge:
            for g in _grams(name):
                found.setdefault(g, []).append(name)
    return found


def distance(a: str, b: str) -> float:
    """Edit distance in which swapped neighbours, doubled letters and vowels for vowels cost half."""
    rows = [[float(j) for j in range(len(b) + 1)]]
    for i in range(1, len(a) + 1):
        row = [float(i)]
        for j in range(1, len(b) + 1):
            x, y = a[i - 1], b[j - 1]
            swap = 0.0 if x == y else 0.5 if x in "aeiou" and y in "aeiou" else 1.0
            gone = 0.5 if i > 1 and a[i - 2] == x else 1.0
            more = 0.5 if j > 1 and b[j - 2] == y else 1.0
            best = min(rows[i - 1][j - 1] + swap, rows[i - 1][j] + gone, row[j - 1] + more)
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2] and x != y:
                best = min(best, rows[i - 2][j - 2] + 0.5)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


def nearest(word: str) -> Unit | None:
    """The unit a part spells: itself in the vocabulary, else the one nearest to it of those that share n-grams."""
    known = vocabulary()
    if word in known:
        return known[word]
    if len(word) < 4:
        return None
    shared: dict[str, int] = {}
    for g in _grams(word):
        for name in _index().get(g, ()):
            shared[name] = shared.get(name, 0) + 1
    allowed = 1.0 if len(word) < 7 else 2.0
    best = min(((distance(word, n), n) for n, k in shared.items() if k >= max(2, len(word) // 3)), default=(9.0, ""))
    return known[best[1]] if best[0] <= allowed else None


def near_phrase(text: str) -> bool:
    """Is the text one edit from a phrase of as many words?"""
    n = text.count(" ")
    return any(name.count(" ") == n and abs(len(name) - len(text)) < 3 and distance(text, name) <= 1 for name in vocabulary() if " " in name)


_PART = re.compile(r"[^\W\d_]+(?:\.[^\W\d_]+)*[$€£¥]|[^\W\d_]+(?:\.[^\W\d_]+)*\.?|[^\w\s]", re.U)


def resolve(spelling: str, prefix: bool = False) -> Unit | None:
    """Currency and scale of a spelling; None if a part is neither. With prefix, of its first parts that are."""
    parts = _PART.findall(spelling.lower())
    currency, scale, i, hedged = None, None, 0, False
    while i < len(parts):
        unit, taken = None, 0
        for n in (3, 2, 1):
            text = " ".join(parts[i : i + n])
            if i + n <= len(parts) and (text in vocabulary() or n == 1 or near_phrase(text)):
                unit, taken = nearest(text) or nearest(text.rstrip(".")), n
                if unit:
                    break
        if unit is None and parts[i] in (",", ".", "(", ")", ":", ";"):
            i += 1
            continue
        if unit is None or unit.currency and currency not in (None, unit.currency) or unit.scale and scale:
            if prefix:
                break
            return None
        if unit.hedge:
            hedged = True
        currency, scale = unit.currency or currency, unit.scale or scale
        i += taken
    return Unit(currency, scale, hedged)
