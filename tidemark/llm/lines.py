"""Line paths and line scores: what a page is cut into before its furniture is voted on.

A line's path is the line generalised over case, figures, white space and the site's name. Lines with a part that changes
from page to page have further paths in which that part is a slot: what follows a label, the ends of a row of labels, runs
of names, and the last sentence of a line. Paths of all lines of a batch are hashed at once from its code points.
"""

from __future__ import annotations

import re
from functools import cache, lru_cache

import numpy as np
import xxhash

from tidemark.llm.wordhash import _char_hashes, _powers, mix

_WS = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_LETTER = re.compile(r"[^\W\d_]")
_SEPARATORS = "|·•»©"
_ENDS = ".!?”\""
_MARKS = "-*–“\""
_LABEL = re.compile(r"([^\W\d_][^:.!?|“\"]{0,40}):\s+\S")
_PARTS = re.compile(r"\s+[|·•»›>/]\s+")


def site_names(source: str | None, host: str) -> list[str]:
    """Lower-cased spellings of a site's own name: the source and the host's main label."""
    out = []
    if source and source.strip():
        out.append(_WS.sub(" ", source).strip().lower())
    parts = [p for p in host.split(".") if p not in ("www", "m", "news")]
    if parts:
        out.append(parts[0].replace("-", " "))
    return list(dict.fromkeys(n for n in out if n))


def path_of(line: str, names: list[str]) -> str:
    """The generalised path of a line: case, white space, figures and the site's own name do not matter."""
    s = " ".join(line.split()).lower()
    for n in names:
        if n in s:
            s = s.replace(n, "{s}")
    return _DIGITS.sub("0", s)


def digest(text: str) -> int:
    """64 bits of a text, signed."""
    v = xxhash.xxh64_intdigest(text)
    return v - (1 << 64) if v >= 1 << 63 else v


def _is_name(word: str) -> bool:
    return word[:1].isupper()


def _slotted(words: list[str], fixed: int) -> str:
    """Words with each run of two or more capitals after the first `fixed` ones as a slot."""
    out, i = words[:fixed], fixed
    while i < len(words):
        j = i
        while j < len(words) and _is_name(words[j]):
            j += 1
            if words[j - 1][-1] in ",;:":
                break
        if j - i >= 2:
            out.append("{n}" + (words[j - 1][-1] if words[j - 1][-1] in ",;:" else ""))
            i = j
        else:
            out.append(words[i])
            i += 1
    return " ".join(out)


def slot_paths(line: str, names: list[str]) -> list[str]:
    """Paths of a line (white space as single spaces) in which a part that may change is a slot; each keeps a constant part."""
    s, found = line, []
    label = _LABEL.match(s) if ":" in s else None
    if label and label[1].count(" ") < 4:
        found.append(f"{label[1]}: {{*}}")
    if s[-1] in _ENDS:
        cut = max(s.rfind(". "), s.rfind("! "), s.rfind("? ")) + 2
        if cut > 1 and 2 * (s.count(" ", cut) + 1) >= s.count(" ") + 1:
            found.append("{*} " + s[cut:])
    else:
        parts = _PARTS.split(s) if any(x in s for x in "|·•»›>/") else ()
        if len(parts) > 1:
            found += [f"{parts[0]} > {{*}}", f"{{*}} | {parts[-1]}"]
        words = s.split(" ")
        for fixed in (1, 2) if s.isupper() else (1,):
            p = _slotted(words, fixed)
            if "{n}" in p:
                found.append(p)
    return [path_of(p, names) for p in found] if found else found


@cache
def _flags() -> np.ndarray:
    """By code point: 1 separator, 2 end of a sentence, 4 mark of a list or quote."""
    out = np.zeros(0x110000, np.uint8)
    for bit, chars in ((1, _SEPARATORS), (2, _ENDS), (4, _MARKS)):
        for c in chars:
            out[ord(c)] |= bit
    return out


def _spaced(line: str) -> str:
    """The line with white space as single spaces."""
    s = line.strip()
    return s if s.isprintable() and "  " not in s else " ".join(s.split())


class Cut:
    """The lines of a batch of pages, each page's title first: digests of their paths, and how each is built.

    ``starts`` has the first line of each page (its title, blank where there is none), ``lines`` the lines
    with white space as single spaces.
    """

    def __init__(self, pages: list[tuple[str | None, str | None, list[str]]]):
        lines: list[str] = []
        low: list[str] = []
        starts = [0]
        for title, content, names in pages:
            own = [" ".join(title.split()) if title else ""]
            own += map(_spaced, content.split("\n")) if content else ()
            lines += own
            text = "\n".join(own).lower()
            for n in names:
                if n in text:
                    text = text.replace(n, "{s}")
            low.append(text)
            starts.append(len(lines))
        self.lines, self.starts = lines, starts
        cp = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        digit = (cp >= 48) & (cp <= 57)
        if len(cp):
            cp = cp[~(digit & np.concatenate([[False], digit[:-1]]))]
            cp = np.where((cp >= 48) & (cp <= 57), np.uint32(48), cp)
        breaks = np.flatnonzero(cp == 10)
        a, b = np.concatenate([[0], breaks + 1]), np.append(breaks, len(cp))
        if not pages:
            a = b = np.empty(0, np.int64)
        up, down = _powers(1 << max(19, int(len(cp) + 1).bit_length()))
        with np.errstate(over="ignore"):
            sums = np.zeros(len(cp) + 1, np.uint64)
            np.cumsum(_char_hashes(False)[cp] * up[: len(cp)], out=sums[1:])
            self.digests = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)).view(np.int64)
        kind = _flags()[cp]
        spaces = np.concatenate([[0], np.cumsum(cp == 32)])
        apart = np.concatenate([[0], np.cumsum(kind & 1)])
        self.filled = b > a
        last, first = kind[np.maximum(b - 1, 0)] if len(cp) else np.zeros(len(a), np.uint8), kind[np.minimum(a, max(len(cp) - 1, 0))] if len(cp) else np.zeros(len(a), np.uint8)
        words = np.where(self.filled, spaces[b] - spaces[a] + 1, 0)
        self.ended = self.filled & (last & 2 > 0)
        self.sentence = self.ended & (words >= 5)
        self.prose = prose_of(words, self.ended, self.filled & (first & 4 > 0), apart[b] > apart[a])

    def body(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the filled lines but titles, the page of each, and their furniture scores."""
        page = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        filled = self.filled.copy()
        filled[self.starts[:-1]] = False
        at = np.flatnonzero(filled)
        return at, page[at], line_scores(self.prose[at], page[at])


def prose_of(words: np.ndarray, ended: np.ndarray, marked: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """How much lines are built like a story's prose, in quarters: ended sentences by their words, quotes and list items, never separated labels."""
    of = np.where(ended, np.where(words >= 12, 4, np.where(words >= 5, 2, 1)), np.where((marked & (words >= 4)) | (words >= 40), 2, 0))
    return np.where(apart, 0, of)


def line_scores(prose: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Furniture scores of lines, from 4 to 16 sixteenths: low for prose that stands amid prose of its page."""
    same = np.concatenate([[False], page[1:] == page[:-1], [False]])
    padded = np.concatenate([[0], prose, [0]])
    around = padded[:-2] * same[: len(prose)] + padded[2:] * same[1:]
    return np.where(prose > 0, 16 - 3 * prose * around // 8, 16)


@lru_cache(1 << 16)
def headline_like(line: str) -> bool:
    """An unterminated line of four words or more with figures or several capitals: some story's headline."""
    if line[-1] in ".!?”\"':;" or line[0] in "-•*–" or " | " in line:
        return False
    words = line.split()
    if not 3 <= len(words) <= 30:
        return False
    caps = sum([w[0].isupper() for w in words[1:]])
    return caps >= 2 or (caps >= 1 and words[0][0].isupper() and len(words) >= 4) or _DIGITS.search(line) is not None


def names_of(headline: str) -> set[str]:
    """What tells a headline's story: words with letters and figures, and pairs of words with capitals that stand together."""
    out, before = set(), None
    for i, raw in enumerate(headline.split()):
        w = raw if raw.isalpha() else raw.strip(".,:;()'’\"“”")
        if not w.isalpha() and _DIGITS.search(w):
            if _LETTER.search(w):
                out.add(w.lower())
            before = None
        elif w[:1].isupper():
            w = w.lower()
            if before is not None:
                out.add(f"{before} {w}")
            elif i:
                out.add(w)
            before = None if raw[-1] in ":,;" else w
        else:
            before = None
    return out
