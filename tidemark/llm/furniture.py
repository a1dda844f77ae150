"""Main body of pages: consensus line paths, voted per host.

The pages reach us as text, so a container is a line block and its path is the line generalised over case, figures, white
space, the site's name and the parts that change from page to page. Each page scores its lines, by length, sentence build,
separators and what stands next to them, and votes on their paths with that score. However many pages tell one story, on a
host it has one vote: a path's share is the smaller of its shares of the host's pages and of the host's stories, and a path
wins on the host when the lower confidence bound of share times mean score reaches ``SHARE``. Paths that win on many hosts
win everywhere, and so do whole sentences and labels that different stories of several hosts repeat, as stories never do. The second
pass re-reads each page and marks the lines on winning paths, and the headlines listed under a path which headlines follow.
No line is marked without votes.

Defined results: null or blank content has no lines; a blank line is counted but never marked; repeated rows tell one
story; an empty table gives an empty result; columns besides those named are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.lines import Cut, digest, headline_like, names_of, path_of, site_names, slot_paths
from tidemark.session import stage, unstage

#: A path wins on a host when the lower bound (95 %) of its share of the host's pages reaches this.
SHARE = 0.10
#: A whole sentence or a label wins everywhere when the lower bound of its share on the hosts that have it reaches this.
SENTENCE = 0.01
#: A winning path that headlines follow this often, seldom one headline twice, opens a list of other stories.
FOLLOW = 0.5
#: A path winning on this many hosts, and on this share of them, wins everywhere. At most lines-per-page / SHARE /
#: EVERYWHERE paths can, however many pages there are.
HOSTS, EVERYWHERE = 2, 0.001
#: Winning paths of hosts are sent to the executors whole up to this many; beyond it they are joined by host.
SENT_PATHS = 1_000_000

#: Lines whose slots a worker remembers, and pages it cuts at a time.
CACHED, PAGES = 200_000, 128

_VOTES = "host bigint, path bigint, story int, score tinyint, next tinyint, sentence boolean"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: str = "url") -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1))


def _pooled(path: str) -> bool:
    """Is a slot path a label or a last sentence, which hosts may vote on together as on whole sentences?"""
    return path.endswith(": {*}") or path.startswith("{*} ") and not path.startswith("{*} |")


class Slots:
    """Slot paths of lines, as digests and whether hosts pool their votes; those of lines that end no sentence, which many pages share, are remembered."""

    def __init__(self):
        self._known: dict = {}

    def of(self, key: tuple, names: list[str], line: str, ended: bool) -> list[tuple[int, bool]]:
        if ended:
            return [(digest(p), _pooled(p)) for p in slot_paths(line, names)]
        got = self._known.get((key, line))
        if got is None:
            if len(self._known) > CACHED:
                self._known.clear()
            got = self._known[key, line] = [(digest(p), _pooled(p)) for p in slot_paths(line, names)]
        return got


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    slots = Slots()
    for pdf in batches:
        for i in range(0, len(pdf), PAGES):
            yield _vote(pdf.iloc[i : i + PAGES], slots)


def _vote(pdf: pd.DataFrame, slots: Slots) -> pd.DataFrame:
    """Per page: a row of path 0, and one of each of its paths with its score and 6 bits of the headline after it, or -1."""
    names = [site_names(s, h) for s, h in zip(pdf["source"], pdf["host"])]
    titles, contents = pdf["title"].tolist(), pdf["content"].tolist()
    cut = Cut(list(zip(titles, contents, names)))
    at, page, score = cut.body()
    own = cut.digests[np.array(cut.starts[:-1], np.int64)]
    d = cut.digests[at]
    # The line after each line, where it is a headline and not of the page's own story.
    follows = np.full(len(at), -1, np.int64)
    could = np.flatnonzero(~cut.ended[at[1:]] & (page[1:] == page[:-1]) & (d[1:] != own[page[1:]])) + 1
    lines = cut.lines
    for k in could.tolist():
        line = lines[at[k]]
        if headline_like(line) and not same_story(line, titles[page[k]], names[page[k]]):
            follows[k - 1] = d[k] & 63
    exact = pd.DataFrame({"page": page, "path": d, "score": score, "next": follows, "sentence": cut.sentence[at]})
    keys = [tuple(n) for n in names]
    ended, pages, owner, slot, pooled = cut.ended[at].tolist(), page.tolist(), [], [], []
    for k, (m, p) in enumerate(zip(at.tolist(), pages)):
        for x, several in slots.of(keys[p], names[p], lines[m], ended[k]):
            owner.append(k), slot.append(x), pooled.append(several)
    owner = np.array(owner, np.int64)
    slotted = pd.DataFrame({"page": page[owner], "path": np.array(slot, np.int64), "score": score[owner], "next": np.full(len(owner), -1), "sentence": np.array(pooled, bool)})
    n = len(pdf)
    whole = pd.DataFrame({"page": np.arange(n), "path": np.zeros(n, np.int64), "score": np.full(n, 16), "next": np.full(n, -1), "sentence": np.zeros(n, bool)})
    out = pd.concat([whole, exact, slotted]).drop_duplicates(["page", "path"])
    story = np.array([digest(story_of(t, c)) >> 32 for t, c in zip(titles, contents)], np.int32)
    who = out["page"].to_numpy()
    return pd.DataFrame({"host": pdf["host_key"].to_numpy(np.int64)[who], "path": out["path"].to_numpy(), "story": story[who], "score": out["score"].to_numpy(np.int8), "next": out["next"].to_numpy(np.int8), "sentence": out["sentence"].to_numpy()})


@lru_cache(4096)
def _told(title: str, names: tuple) -> tuple[str, set[str]]:
    return path_of(title, list(names)), names_of(title)


def same_story(line: str, title: str | None, names: list[str]) -> bool:
    """Is a headline the page's own, as its title has it or with some words changed?

    Other stories' headlines often have the same build, so only names are compared, not single common words.
    """
    if not title:
        return False
    b, y = _told(title, tuple(names))
    a, x = path_of(line, names), names_of(line)
    if a in b or b in a:
        return True
    return len(x & y) * 2 > min(len(x), len(y)) > 0


def story_of(title: str | None, content: str | None) -> str:
    """What tells a page's story, alike in near copies: of the names in its title (in its text, without a title), the one its text has most.

    Edits of a few words seldom change it, so copies of a story share few of these, however many they are. Stories of
    one name count as one, which only lowers a vote.
    """
    if not title:
        found = Counter(w for line in (content or "").split("\n") for w in names_of(line))
        return max(found, key=lambda w: (len(w) >= 4, found[w], w), default="")
    text = (content or "").lower()
    return max(names_of(title), key=lambda w: (text.count(w), w), default=title.lower())


def wilson_low(n: F.Column, total: F.Column, z: float = 1.96) -> F.Column:
    p = n / total
    return (p + z * z / (2 * total) - z * F.sqrt((p * (1 - p) + z * z / (4 * total)) / total)) / (1 + z * z / total)


def host_paths(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """host, path, head: the winning paths of each host; path, head: sentences and labels that win everywhere. Both staged."""
    pages = articles.select(F.xxhash64(host_of()).alias("host_key"), host_of().alias("host"), "source", "title", "content")
    votes = pages.mapInPandas(_votes, _VOTES).groupBy("host", "path", "story").agg(F.count("*").alias("n"), F.sum("score").alias("score"), F.count_if(F.col("next") >= 0).alias("follows"), F.max("next").alias("next"), F.max("sentence").alias("sentence"))
    seen = F.when(F.col("next") >= 0, F.expr("shiftleft(1L, cast(next as int))")).otherwise(F.lit(0).cast("long"))
    votes = votes.groupBy("host", "path").agg(*(F.sum(c).alias(c) for c in ("n", "score", "follows")), F.count("*").alias("stories"), F.bit_count(F.bit_or(seen)).alias("heads"), F.count_if(F.col("next") >= 0).alias("listed"), F.max("sentence").alias("sentence"), F.bit_or(F.expr("shiftleft(1L, cast(story & 63 as int))")).alias("tells"))
    votes = stage(votes.where("path = 0 or n >= 4 or sentence"), "votes")
    total = votes.where("path = 0").select("host", F.col("n").alias("total"), F.col("stories").alias("told"))
    # In stories: those with the path, but no more than by its share of pages, as many pages may share few stories.
    held = F.least(F.col("stories"), F.col("n") / F.col("total") * F.col("told")) * F.col("score") / (16 * F.col("n"))
    head = (F.col("follows") >= FOLLOW * F.col("n")) & (F.col("heads") >= F.least(F.lit(8), F.col("listed") / 2))
    ballot = votes.where("path <> 0").join(total, "host").withColumns({"held": held, "head": head})
    won = stage(ballot.where("n >= 4").where(wilson_low(F.col("held"), F.col("told")) >= SHARE).select("host", "path", "head", "total"), "paths")
    many = ballot.where("sentence").groupBy("path").agg(F.count("*").alias("hosts"), F.sum("held").alias("held"), F.sum("told").alias("told"), F.count_if("head").alias("heads"), F.sum("n").alias("n"), F.bit_count(F.bit_or("tells")).alias("tells"))
    # Copies of one story repeat its sentences too, on however many hosts, but tell few stories.
    many = many.where((F.col("hosts") >= HOSTS) & (F.col("held") >= 3) & (F.col("tells") >= F.least(F.lit(16), F.col("n") / 4)) & (wilson_low(F.col("held"), F.col("told")) >= SENTENCE))
    many = stage(many.select("path", "hosts", (F.col("heads") >= FOLLOW * F.col("hosts")).alias("head")), "sentences")
    unstage(votes)
    return won, many


class Winners:
    """What the second pass needs: winning paths by host and those that win everywhere. Path -> opens a list."""

    def __init__(self, by_host: dict[int, dict[int, bool]], everywhere: dict[int, bool]):
        self.by_host, self.everywhere = by_host, everywhere
        self._slots = Slots()

    def of(self, host_key: int, paths: list | None = None, heads: list | None = None) -> dict[int, bool]:
        if paths is not None:
            return dict(zip(paths, heads))
        return self.by_host.get(host_key, {})

    def mark_pages(self, rows: list[tuple[str, str | None, str | None, str | None, dict[int, bool]]]) -> list[tuple[list[str], list[bool]]]:
        """The lines of pages (host, source, title, content, the host's winning paths) and whether each is furniture."""
        names = [site_names(source, host) for host, source, *_ in rows]
        cut = Cut([(title, content if content and content.strip() else None, n) for (_, _, title, content, _), n in zip(rows, names)])
        digests, ended, filled, everywhere, slots = cut.digests.tolist(), cut.ended.tolist(), cut.filled.tolist(), self.everywhere, self._slots
        found = []
        for k, (_, _, title, _, won) in enumerate(rows):
            i, j = cut.starts[k] + 1, cut.starts[k + 1]
            lines, out, own, listing, key = cut.lines[i:j], [False] * (j - i), digests[i - 1], False, tuple(names[k])
            if won or everywhere:
                for m in range(j - i):
                    d = digests[i + m]
                    if not filled[i + m]:
                        continue
                    if d != own:
                        head = won.get(d)
                        head = everywhere.get(d) if head is None else head
                        if head is not None:
                            out[m], listing = True, listing or head
                            continue
                        line = lines[m]
                        slotted = any(x in won or x in everywhere for x, _ in slots.of(key, names[k], line, ended[i + m]))
                        headline = (slotted or listing) and headline_like(line)
                        if (slotted or listing and headline) and not (headline and same_story(line, title, names[k])):
                            out[m] = True
                            continue
                    listing = False
            found.append((lines, out))
        return found

    def marks(self, host: str, source: str | None, title: str | None, content: str | None, won: dict[int, bool]) -> tuple[list[str], list[bool]]:
        """The lines of one page and whether each is furniture."""
        return self.mark_pages([(host, source, title, content, won)])[0]


def winners(articles: DataFrame) -> tuple[Winners, DataFrame | None]:
    """The winning paths to send along, and, where too many, those to join by host instead."""
    paths, sentences = host_paths(articles)
    hosts = paths.select("host").distinct().count()
    everywhere = paths.groupBy("path").agg(F.count("*").alias("hosts"), F.avg(F.col("head").cast("int")).alias("head"))
    everywhere = everywhere.where((F.col("hosts") >= HOSTS) & (F.col("hosts") >= EVERYWHERE * hosts)).select("path", (F.col("head") >= FOLLOW).alias("head"))
    known = {r.path: r.head for r in everywhere.unionByName(sentences.where(F.col("hosts") >= EVERYWHERE * hosts).select("path", "head")).toLocalIterator()}
    if paths.count() > SENT_PATHS:
        each = paths.groupBy("host").agg(F.collect_list("path").alias("paths"), F.collect_list("head").alias("heads"))
        return Winners({}, known), each
    by_host: dict[int, dict[int, bool]] = {}
    for r in paths.toLocalIterator():
        by_host.setdefault(r.host, {})[r.path] = r.head
    unstage(paths, sentences)
    return Winners(by_host, known), None


def pages_with_paths(articles: DataFrame, each: DataFrame | None) -> DataFrame:
    """article_id, host, source, title, content (and error_message where there) with the paths of the page's host."""
    keep = ["article_id", "source", "title", "content"] + [c for c in ("error_message",) if c in articles.columns]
    pages = articles.select(*keep, host_of().alias("host")).withColumn("host_key", F.xxhash64("host"))
    if each is None:
        return pages
    # One row a host on the right: a hot host is split by AQE's skew join.
    return pages.join(each.withColumnRenamed("host", "host_key"), "host_key", "left")


def furniture_lines(articles: DataFrame) -> DataFrame:
    """article_id, line_no of every line that is not main body, over all pages."""
    won, each = winners(articles)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, nos = [], []
            for r, _, marks in marked(pdf, won):
                at = [i + 1 for i, m in enumerate(marks) if m]
                ids += [r.article_id] * len(at)
                nos += at
            yield pd.DataFrame({"article_id": ids, "line_no": nos})

    return pages_with_paths(articles, each).mapInPandas(mark, "article_id bigint, line_no bigint")


class _Row:
    __slots__ = ("article_id", "host", "source", "title", "content", "error_message", "_key", "_paths", "_heads")

    def won(self, winners: Winners) -> dict[int, bool]:
        return winners.of(self._key, self._paths, self._heads)


def rows_of(pdf: pd.DataFrame) -> Iterator[_Row]:
    """The pages of a batch; None for nulls."""
    n = len(pdf)
    none = [None] * n
    cols = [pdf[c] if c in pdf else none for c in ("article_id", "host", "source", "title", "content", "error_message", "host_key", "paths", "heads")]
    for values in zip(*cols):
        r = _Row()
        r.article_id, r.host, r.source, r.title, r.content, r.error_message, r._key, r._paths, r._heads = (None if v is None or v is pd.NA or (v.__class__ is float and v != v) else v for v in values)
        yield r


def marked(pdf: pd.DataFrame, won: Winners) -> Iterator[tuple[_Row, list[str], list[bool]]]:
    """Each page of a batch with its lines and whether each is furniture; no lines for null or blank content."""
    for i in range(0, len(pdf), PAGES):
        rows = list(rows_of(pdf.iloc[i : i + PAGES]))
        for r, (lines, marks) in zip(rows, won.mark_pages([(r.host, r.source, r.title, r.content, r.won(won)) for r in rows])):
            yield r, lines, marks
