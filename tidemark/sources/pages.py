"""Pages through a pluggable fetcher, and text from them."""

from __future__ import annotations

import time
from collections.abc import Iterator
from typing import Protocol
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.providers import retried
from tidemark.functions.text import domain, html_text
from tidemark.operators.filters import fetched_since, long_enough
from tidemark.sources.feeds import is_challenge


class Fetcher(Protocol):
    def fetch(self, url: str) -> str | None: ...


class StoredPages:
    """The offline fetcher: pages from a mapping."""

    def __init__(self, pages: dict[str, str]):
        self.pages = pages

    def fetch(self, url: str) -> str | None:
        return self.pages.get(url)


class Refused(Exception):
    """Raised by a fetcher whose request was refused (403)."""


class PoliteFetcher:
    """Keeps to robots.txt and to a least time between a host's requests; asks another fetcher where the first is refused.

    One instance lives in each task, and fetched() brings each host to one task, so that the limits hold a host.
    """

    def __init__(self, fetcher: Fetcher, interval: float = 1.0, agent: str = "tidemark", fallback: Fetcher | None = None, clock=time.monotonic, sleep=time.sleep):
        self.fetcher, self.interval, self.agent, self.fallback, self.clock, self.sleep = fetcher, interval, agent, fallback, clock, sleep
        self._robots: dict[str, RobotFileParser] = {}
        self._last: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_robots": {}, "_last": {}}

    def _wait(self, host: str, least: float) -> None:
        now = self.clock()
        due = self._last.get(host, now - least) + least
        if due > now:
            self.sleep(due - now)
        self._last[host] = max(now, due)

    def _rules(self, host: str) -> RobotFileParser:
        if host not in self._robots:
            rules = RobotFileParser()
            try:
                self._wait(host, self.interval)
                rules.parse((self.fetcher.fetch(f"{host}/robots.txt") or "").splitlines())
            except Exception:
                rules.parse([])
            self._robots[host] = rules
        return self._robots[host]

    def fetch(self, url: str) -> str | None:
        parts = urlsplit(url)
        host = f"{parts.scheme}://{parts.netloc}"
        rules = self._rules(host)
        if not rules.can_fetch(self.agent, url):
            return None
        self._wait(host, max(self.interval, float(rules.crawl_delay(self.agent) or 0)))
        try:
            html = self.fetcher.fetch(url)
        except Refused:
            html = self.fallback.fetch(url) if self.fallback else None
        if html is not None and self.fallback is not None and challenged(html):
            html = self.fallback.fetch(url)
        return html


def challenged(html: str) -> bool:
    """As is_challenge, of a text."""
    low = html.lower()
    return "cloudflare" in low and "ray id:" in low and len(html) < 5000


def fetched(urls: DataFrame, fetcher: Fetcher, tasks: int = 32) -> DataFrame:
    """urls with html; null where a fetch failed. A host's urls stay in one task's order, so that limits hold a host."""
    schema = f"{urls.select('url', 'title', 'published_date', 'source').schema.simpleString()[7:-1].replace(':', ' ')}, html string"

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            html = []
            for u in pdf["url"]:
                try:
                    html.append(retried(fetcher.fetch, u))
                except Exception:
                    html.append(None)
            yield pdf.assign(html=pd.Series(html, index=pdf.index, dtype=object))

    rows = urls.select("url", "title", "published_date", "source").repartition(tasks, domain(F.col("url")))
    return rows.mapInPandas(run, schema)


def articles_of(pages: DataFrame, start: str, end: str, chars: int = 500) -> DataFrame:
    """Text of pages that are no guard's page, long enough, and not before the start."""
    rows = pages.where(F.col("html").isNotNull()).where(~is_challenge(F.col("html"))).where(fetched_since(start, end))
    return rows.withColumn("content", html_text("html")).where(long_enough("content", chars)).drop("html")
