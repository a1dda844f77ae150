"""Template residue, filler, error pages and script notices instead of content.

A regularised linear classifier on hashed n-grams, length and title features is fitted on a bounded sample labelled
weakly: by phrases, and by the status a response line states. It scores every value of every row and decides, at the
threshold that fits hosts best which it has not seen. Only unfilled template syntax, which may stand anywhere in a real
story, is told by its form. Furniture of the page is set aside first, so that a notice in it never counts.

Defined results: null and blank values are no cases; ties and repeated rows are scored each by itself; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.furniture import Winners, marked, pages_with_paths, winners
from tidemark.llm.lines import digest
from tidemark.llm.wordhash import distinct, grams, mix, word_hashes

#: Rows of the labelled sample at most; the only bound here. Everything else sees all rows.
SAMPLE_ROWS = 5_000
#: Values of the sample labelled as none, of which the fit takes this many (by hash) at most; those labelled as residue all count.
FIT_OTHERS = 1_500
BITS = 18
#: One host in so many of the sample is kept back to choose the threshold.
KEPT_BACK = 4

#: Unfilled template syntax. Fixed patterns.
PLACEHOLDER = re.compile(
    r"\{\{[^{}\n]*\}\}|\{%[^{}\n]*%\}|[$#]\{[^{}\n]*\}|\{[\w.]{0,40}\}|\[\[[^\[\]\n]*\]\]|%\(\w+\)[a-z]|\$\$\w+\$\$|%%\w+%%|%[A-Z][A-Z_]{2,}%"
    r"|<%[^<>\n]*%>|<(?:insert|your|enter)\b[^<>\n]*>|__[A-Z][A-Z_]*__|@@\w+@@|\[(?:INSERT|TBC|TBD|TODO|PLACEHOLDER|YOUR|ENTER|ADD)\b[^\[\]\n]*\]"
    r"|\[[A-Z][A-Z _]{2,}\]|\[object Object\]|%[sd]\b|^TODO:|\bTODO\b|\[DUMMY TEXT[^\[\]\n]*\]"
)
_UNDEFINED = re.compile(r"undefined(?!\w)")
#: What an unset field and a guard may rightly be called.
_DEFINED = re.compile(r"\b(?:left|field\S*(?: \S+)?) undefined\b|\bundefined (?:behaviou?r|counts)\b", re.I)
#: Words of error pages, script notices and filler. Fixed patterns.
_JUNK = re.compile(
    r"\b(?:[45]\d\d )(?:not found|forbidden|bad gateway|service unavailable|internal server error|too many requests|gateway time-?out|unauthorized|bad request)\b"
    r"|\bpage (?:not found|introuvable)\b|\bseite nicht gefunden\b|\bnever existed\b|\bpage demandée\b|\bgewünschte seite\b|^error \d{3}\b|\baccess denied\b|\boops\b|something went wrong"
    r"|\bdown for maintenance\b|\bsession has expired\b|\battention required\b|\bchecking your browser\b|\bdatabase connection\b|unavailable in your region|gateway time-?out|^request id:|^ray:"
    r"|\btry again (?:later|in a few)|\bsearch box\b|\bstart page\b|\bserver did not answer\b|\baddress you asked for\b|\bdo not have permission\b|\bfrom your network\b|\bverify that you are\b|\bwebmaster\b"
    r"|\b(?:enable|requires?|aktivieren)\b.{0,24}\b(?:javascript|scripts?|scripting)\b|\bjavascript (?:is required|to (?:continue|run|view))|\bblocking scripts\b|\bactive scripting\b|\bswitch on scripts\b|\bturn on scripting\b|\bdoes not support scripts\b"
    r"|\bcontent goes here\b|\barticle body here\b|\bx{4,}\b|\bbody copy to come\b|\bheadline goes here\b|\btk tk\b|\bsample paragraph\b|\basdf\b|\btest test\b|\bplaceholder text\b|\bdummy text\b|\blorem ipsum\b",
    re.I,
)
_HTML = re.compile(r"<!doctype|</?(?:html|head|body|b|hr|h1|noscript|title)\b", re.I)
#: The words of the customary filler text. Fixed values.
LOREM = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco "
    "laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident "
    "sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
_WORD = re.compile(r"[^\W\d_]+")


#: Where a placeholder may start; the patterns are tried there and nowhere else.
_HINT = re.compile(r"[{\[<%]|\$[{$]|#\{|__|@@|TODO")


#: One of these stands in every text with a placeholder.
_SIGNS = ("{", "[", "<", "%", "$$", "__", "@@", "TODO", "undefined")


def has_placeholder(text: str) -> bool:
    if not any(x in text for x in _SIGNS):
        return False
    if any(PLACEHOLDER.match(text, m.start()) for m in _HINT.finditer(text)):
        return True
    for m in _UNDEFINED.finditer(text):
        a, b = m.span()
        if (not a or not (text[a - 1].isalnum() or text[a - 1] == "_")) and not _DEFINED.search(text[max(0, a - 40) : b + 12]):
            return True
    return False


def is_filler(line: str) -> bool:
    words = [w.lower() for w in _WORD.findall(line)]
    return len(words) >= 3 and sum(w in LOREM for w in words) >= 0.6 * len(words)


def is_junk(line: str) -> bool:
    return _JUNK.search(line) is not None or is_filler(line)


def weak_label(field: str, text: str, lines: list[str]) -> int:
    """A label by phrases and by the status that the first line states, as a response's would be."""
    first = lines[0] if lines else ""
    status = re.match(r"(?:HTTP )?[45]\d\d\b", first) is not None and "fetching" not in first
    if field == "error_message":
        status = status or _HTML.search(text) is not None or text.strip().lower() == "undefined"
    if status:
        return 1
    long = [x for x in lines if x.count(" ") >= 25]
    if sum(map(len, long)) * 4 >= len(text) and not any(map(is_filler, long)):
        return 0
    junk = [is_junk(x) for x in lines]
    return int(any(junk) and 4 * sum(len(x) for x, j in zip(lines, junk) if not j and x.count(" ") >= 7) < len(text))


def features(texts: list[str], titles: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """value number, feature number: hashed one- and two-grams of the text and of the title, and classes of lengths: of the text, of its longest line in words, and of its lines of twelve words or more."""
    mask = np.uint64((1 << BITS) - 1)
    rows, cols = [], []
    for seed, values in ((1, texts), (2, titles)):
        h, at = word_hashes(values, symbols=True, digits_alike=True)
        g, ga = grams(h, at, 2)
        with np.errstate(over="ignore"):
            rows += [at, ga]
            cols += [mix(h + np.uint64(seed)) & mask, mix(g + np.uint64(seed * 7)) & mask]
    n = len(texts)
    for k, length in enumerate((len, lambda t: max(x.count(" ") for x in t.split("\n")), lambda t: sum(x.count(" ") >= 11 for x in t.split("\n")))):
        rows.append(np.arange(n))
        cols.append(np.array([(1 << BITS) + 16 * k + min(15, length(t).bit_length()) for t in texts], np.uint64))
    return np.concatenate(rows), np.concatenate(cols).view(np.int64)


def row_norm(rows: np.ndarray, n: int) -> np.ndarray:
    """Long values hold more features, so each weighs less in them."""
    return 8 / np.sqrt(np.maximum(1, np.bincount(rows, minlength=n)))


class Linear:
    """Logistic regression with an L1 penalty; most weights are zero, so scoring touches few features."""

    size = (1 << BITS) + 48

    def __init__(self):
        self.w, self.b, self.threshold = np.zeros(self.size, np.float32), 0.0, 0.5

    def fit(self, rows: np.ndarray, cols: np.ndarray, y: np.ndarray, penalty: float = 0.03, steps: int = 80) -> Linear:
        """Accelerated proximal gradient steps; classes weigh alike, features as one over the root of their count."""
        norm = row_norm(rows, len(y))
        key = distinct(rows * self.size + cols)
        rows, cols = key // self.size, key % self.size
        often = np.bincount(cols, minlength=self.size)
        keep = often[cols] >= 2
        rows, cols = rows[keep], cols[keep]
        used, cols = np.unique(cols, return_inverse=True)
        rows, cols = rows.astype(np.int32), cols.astype(np.int32)
        del key, keep
        n, d = len(y), len(used)
        scale = 1 / np.sqrt(often[used])
        x = (scale[cols] * norm[rows]).astype(np.float32)
        share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        v = np.ones(d)
        for _ in range(8):  # the largest curvature, by power iteration
            v = np.bincount(cols, (np.bincount(rows, v[cols] * x, n) * share)[rows] * x, d)
            top = float(np.linalg.norm(v)) or 1.0
            v /= top
        rate = 2.0 / (top + 1e-9)
        pull = penalty * rate * float(np.abs(np.bincount(cols, ((0.5 - y) * share)[rows] * x, d)).max())
        w, b, z, zb, t = np.zeros(d), 0.0, np.zeros(d), 0.0, 1.0
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, z[cols] * x, n) + zb, -30, 30)))
            g = (p - y) * share
            new = z - rate * np.bincount(cols, g[rows] * x, d)
            new = np.sign(new) * np.maximum(np.abs(new) - pull, 0)
            nb = zb - rate * g.sum()
            t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
            z, zb = new + (t - 1) / t2 * (new - w), nb + (t - 1) / t2 * (nb - b)
            w, b, t = new, nb, t2
        self.w[used], self.b = w * scale, b
        return self

    def tuned(self, p: np.ndarray, y: np.ndarray) -> Linear:
        """The threshold with the fewest errors on values it has not seen, in the middle of the widest gap that has."""
        if 0 < y.sum() < len(y):
            o = np.argsort(p)
            p, y = p[o], y[o]
            errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
            edges = np.concatenate([[0.0], p, [1.0]])
            gap = np.where(errors == errors.min(), np.diff(edges), -1)
            k = int(gap.argmax())
            self.threshold = float((edges[k] + edges[k + 1]) / 2)
        return self

    def score(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        norm = row_norm(rows, n)
        keep = self.w[cols] != 0
        key = distinct(rows[keep] * self.size + cols[keep])
        m = np.bincount(key // self.size, self.w[key % self.size], n) * norm + self.b
        return 1 / (1 + np.exp(-np.clip(m, -30, 30)))


class Values:
    """The non-blank values of a batch of pages: ids, fields, texts without furniture, titles, lines, and the content's marks."""

    def __init__(self, pdf: pd.DataFrame, won: Winners):
        self.ids, self.fields, self.texts, self.titles, self.lines, self.marks, self.hosts = [], [], [], [], [], [], []
        for r, raw, marks in marked(pdf, won):
            if raw and r.content.strip():
                self._add(r, "content", [x for x, m in zip(raw, marks) if not m and x], r.title or "", marks)
            if r.error_message and r.error_message.strip():
                self._add(r, "error_message", [x.strip() for x in r.error_message.split("\n") if x.strip()], "", None)

    def _add(self, r, field: str, lines: list[str], title: str, marks: list[bool] | None) -> None:
        self.ids.append(r.article_id), self.fields.append(field), self.texts.append("\n".join(lines)), self.titles.append(title)
        self.lines.append(lines), self.marks.append(marks), self.hosts.append(r.host)

    def of(self, field: str) -> list[int]:
        return [i for i, f in enumerate(self.fields) if f == field]

    def features(self, at: list[int]) -> tuple[np.ndarray, np.ndarray]:
        return features([self.texts[i] for i in at], [self.titles[i] for i in at])

    def residue(self, models: tuple[Linear, Linear]) -> np.ndarray:
        """Whether each value is residue: by its classifier, or by unfilled template syntax."""
        case = np.zeros(len(self.ids), bool)
        for field, model in zip(FIELDS, models):
            at = self.of(field)
            for i in range(0, len(at), 256):
                some = at[i : i + 256]
                p = model.score(*self.features(some), len(some))
                case[some] = p > model.threshold
                for k, sure in zip(some, case[some]):
                    if not sure and has_placeholder(self.texts[k]):
                        case[k] = True
        return case


FIELDS = ("content", "error_message")


def fit(articles: DataFrame, won: Winners, each: DataFrame | None) -> tuple[Linear, Linear]:
    """Classifiers of content and of error messages, fitted on at most SAMPLE_ROWS rows drawn by hash."""
    n = articles.count()
    rate = min(1.0, SAMPLE_ROWS / max(1, n))
    picked = articles.where(F.pmod(F.xxhash64("article_id", F.lit("fit")), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1) if rate < 1 else articles
    values = Values(pages_with_paths(picked, each).limit(SAMPLE_ROWS).toPandas(), won)
    return tuple(fit_field(values, field) for field in FIELDS)


def fit_field(values: Values, field: str) -> Linear:
    """A classifier of one field: fitted on most hosts, its threshold chosen on those kept back."""
    at = values.of(field)
    y = np.array([weak_label(field, values.texts[i], values.lines[i]) for i in at], float)
    back = np.array([digest(values.hosts[i]) % KEPT_BACK == 0 for i in at], bool)
    model = Linear()
    if not at or not 0 < y[~back].sum() < (~back).sum():  # one class only: no value is residue by its words
        model.threshold = 1.0
        return model
    some = [k for k in np.flatnonzero(~back) if y[k]] + sorted((k for k in np.flatnonzero(~back) if not y[k]), key=lambda k: digest(f"{values.ids[at[k]]}"))[:FIT_OTHERS]
    used, labels = [at[k] for k in some], y[some]
    if field != FIELDS[0]:  # few messages are residue: what is residue as content would be so here
        more = [i for i in values.of(FIELDS[0]) if weak_label(FIELDS[0], values.texts[i], values.lines[i]) and digest(values.hosts[i]) % KEPT_BACK]
        used, labels = used + more, np.concatenate([labels, np.ones(len(more))])
    model.fit(*features([values.texts[i] for i in used], [values.titles[i] if field == FIELDS[0] else "" for i in used]), labels)
    kept = [i for i, b in zip(at, back) if b]
    return model.tuned(model.score(*values.features(kept), len(kept)), y[back]) if kept else model


def residue_values(articles: DataFrame) -> DataFrame:
    """article_id, field_name of every value that holds residue instead of what belongs there."""
    won, each = winners(articles)
    models = fit(articles, won, each)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = Values(pdf, won)
            at = np.flatnonzero(values.residue(models))
            yield pd.DataFrame([(values.ids[i], values.fields[i]) for i in at], columns=["article_id", "field_name"])

    return pages_with_paths(articles, each).mapInPandas(run, "article_id bigint, field_name string")
