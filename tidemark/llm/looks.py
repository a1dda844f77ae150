"""Text that looks the same in one form.

Texts of a batch become one array of code points. Table gathers decompose presentation forms and accents, drop what is
invisible, bring spaces, hyphens and look-alike letters to one; expansion offsets place the longer results; marks are
then ordered and composed for the whole array at once. The tables come from Unicode's data by rule.

Differences that show stay: case, superscripts, fractions, circled forms, curly against straight quotes, dashes.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.session import stage

#: Look-alike letters of Cyrillic, Greek, Armenian, Cherokee and phonetic script and the Latin ones they show as. Fixed values.
LOOKS = dict(
    zip(
        "аеорсухіѕјԁһԛԝӏѵАВЕКМНОРСТХІЅЈԚԜΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲϳօɡᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏚᎢᏙᎳᏃ",
        "aeopcyxisjdhqwlvABEKMHOPCTXISJQWABEZHIKMNOPTYXovcjogABCDEHJKLMPSTVWZ",
        strict=True,
    )
)
#: Compatibility forms that show a difference.
_SHOWN = ("<super>", "<sub>", "<fraction>", "<circle>", "<square>")
_HYPHENS = (0x2010, 0x2011, 0xFE63, 0xFF0D)
_HIDDEN = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x180F), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
_HANGUL = range(0xAC00, 0xD7A4)
#: Separate letters of Hangul, which show as such and never as a syllable.
_LETTERS = range(0x3131, 0x318F)
_TOP = 0x110000


def _expand(cp: int) -> list[int]:
    """What one code point is brought to, decomposed fully."""
    if cp in _HIDDEN or unicodedata.category(chr(cp)) == "Cf":
        return []
    if cp in _LETTERS:
        return [cp]
    if cp in _HYPHENS:
        return [0x2D]
    if unicodedata.category(chr(cp)) == "Zs":
        return [0x20]
    parts = unicodedata.decomposition(chr(cp)).split()
    if parts and cp not in _HANGUL and not parts[0].startswith(_SHOWN):
        out: list[int] = []
        for p in parts[parts[0][0] == "<" :]:
            out += _expand(int(p, 16))
        return out
    return [ord(LOOKS.get(chr(cp), chr(cp)))]


@cache
def _tables() -> tuple[np.ndarray, ...]:
    count, at, flat = np.ones(_TOP, np.uint8), np.arange(_TOP, dtype=np.int64), np.arange(_TOP, dtype=np.uint32)
    more: list[int] = []
    marks, pairs, made = np.zeros(_TOP, np.uint8), [], []
    for cp in range(_TOP):
        if 0xD800 <= cp < 0xE000 or cp in _HANGUL or 0x20000 <= cp < 0xE0000 and not 0x2F800 <= cp < 0x2FA20 or cp >= 0xF0000:
            continue  # surrogates, whole syllables, plain ideographs and private use stand for themselves
        c = chr(cp)
        marks[cp] = unicodedata.combining(c)
        out = _expand(cp)
        if out != [cp]:
            count[cp], at[cp] = len(out), _TOP + len(more)
            more += out
        d = unicodedata.decomposition(c)
        if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", c) == c:
            a, b = (int(x, 16) for x in d.split())
            a = ord(LOOKS.get(chr(a), chr(a)))
            pairs.append(a << 21 | b)
            made.append(cp)
    key, first = np.unique(np.array(pairs, np.int64), return_index=True)
    return count, at, np.concatenate([flat, np.array(more, np.uint32)]), marks, key, np.array(made, np.uint32)[first]


def one_form(texts: list[str]) -> list[str]:
    """Every text in its one form."""
    if not texts:
        return []
    joined = "".join(texts)
    if joined.isascii():
        return list(texts)
    count, at, flat, marks, pairs, made = _tables()
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    n = count[cp].astype(np.int64)
    if (n == 1).all():
        out = flat[at[cp]]
    else:
        starts = np.cumsum(n) - n
        out = flat[np.repeat(at[cp] - starts, n) + np.arange(int(n.sum()))]
        owner = np.repeat(owner, n)
    for _ in range(4):
        ccc = marks[out]
        if not ccc.any():
            break
        swap = (ccc[1:] > 0) & (ccc[:-1] > ccc[1:]) & (owner[1:] == owner[:-1])
        if swap.any():
            start = ccc == 0
            start[1:] |= owner[1:] != owner[:-1]
            order = np.lexsort((np.arange(len(out)), ccc, np.cumsum(start)))
            out, owner = out[order], owner[order]
            ccc = marks[out]
        second = np.flatnonzero((ccc[1:] > 0) & (owner[1:] == owner[:-1])) + 1
        key = out[second - 1].astype(np.int64) << 21 | out[second]
        found = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
        fits = pairs[found] == key
        second, found = second[fits], found[fits]
        if not len(second):
            break
        out = out.copy()
        out[second - 1] = made[found]
        keep = np.ones(len(out), bool)
        keep[second] = False
        out, owner = out[keep], owner[keep]
    out, owner = _syllables(out, owner)
    whole = out.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    return [whole[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist())]


def _syllables(cp: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hangul syllables written as two or three conjoining letters as one, by their arithmetic rule."""
    for first, second, made in (
        (lambda a: (a >= 0x1100) & (a <= 0x1112), lambda b: (b >= 0x1161) & (b <= 0x1175), lambda a, b: 0xAC00 + ((a - 0x1100) * 21 + b - 0x1161) * 28),
        (lambda a: (a >= 0xAC00) & (a <= 0xD7A3) & ((a - 0xAC00) % 28 == 0), lambda b: (b >= 0x11A8) & (b <= 0x11C2), lambda a, b: a + b - 0x11A7),
    ):
        x = cp.astype(np.int64)
        at = np.flatnonzero(first(x[:-1]) & second(x[1:]) & (owner[1:] == owner[:-1]))
        if len(at):
            cp = cp.copy()
            cp[at] = made(x[at], x[at + 1])
            keep = np.ones(len(cp), bool)
            keep[at + 1] = False
            cp, owner = cp[keep], owner[keep]
    return cp, owner


@F.pandas_udf(StringType())
def _form(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        known = s.notna().to_numpy()
        out = np.full(len(s), None, object)
        values = s[known].tolist()
        done: list[str] = []
        for i in range(0, len(values), 256):
            done += one_form(values[i : i + 256])
        out[known] = done
        yield pd.Series(out)


def consistent_text(documents: DataFrame) -> DataFrame:
    """doc_id, text in its one form. Null stays null, empty stays empty; repeated rows give a row each."""
    return documents.select("doc_id", _form("text").alias("text"))


def look_alike_classes(documents: DataFrame) -> DataFrame:
    """doc_id, class_id, spellings: each text with the least id of those that look the same, and in how many ways these are written. Null texts are left out."""
    docs = stage(documents.where("text is not null").select("doc_id", F.unhex(F.md5("text")).alias("own"), F.unhex(F.md5(_form("text"))).alias("form")), "forms")
    ways = docs.groupBy("form", "own").agg(F.min("doc_id").alias("least")).groupBy("form").agg(F.min("least").alias("class_id"), F.count("*").alias("spellings"))
    return docs.join(ways, "form").select("doc_id", "class_id", "spellings")


def look_alikes(documents: DataFrame) -> DataFrame:
    """doc_id_a < doc_id_b of documents whose texts differ in characters and have one form.

    Texts and forms go by 128-bit digests; only classes of equal text are paired, so exact copies, however many, meet
    no pair among themselves, and members come in at the end. Null texts look like nothing.
    """
    docs = documents.where("text is not null").select("doc_id", F.unhex(F.md5("text")).alias("own"), F.unhex(F.md5(_form("text"))).alias("form"))
    docs = stage(docs, "forms")
    mixed = docs.groupBy("form").agg(F.min("own").alias("a"), F.max("own").alias("b")).where("a <> b").select("form")
    members = docs.join(mixed, "form")
    classes = members.select("form", "own").distinct()
    links = classes.withColumnRenamed("own", "own_a").join(classes.withColumnRenamed("own", "own_b"), "form").where("own_a < own_b")
    ids = members.select("form", "own", "doc_id")
    a = ids.select("form", F.col("own").alias("own_a"), F.col("doc_id").alias("a"))
    b = ids.select("form", F.col("own").alias("own_b"), F.col("doc_id").alias("b"))
    both = links.join(a, ["form", "own_a"]).join(b, ["form", "own_b"])
    return both.select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b"))
