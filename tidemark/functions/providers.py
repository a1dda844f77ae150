"""Models behind small interfaces, with offline defaults that are deterministic.

A provider is a plain object that is sent to the executors; one instance lives in each Python worker. Calls are
batched, retried on limits, and never fail a whole job: a batch that fails is tried row by row.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import document_text
from tidemark.sources.stages import read_or_empty


class Embedder(Protocol):
    name: str

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingEmbedder:
    """Words and word pairs hashed into so many signed dimensions, normalised."""

    def __init__(self, dims: int = 64):
        self.dims, self.name = dims, f"hashing-{dims}"

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dims), np.float32)
        for i, t in enumerate(texts):
            words = re.findall(r"[^\W_]+", t.lower())
            for w in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
                h = xxhash.xxh64_intdigest(w)
                out[i, h % self.dims] += 1.0 if h >> 63 else -1.0
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, n, out=np.zeros_like(out), where=n > 0)


class RateLimited(Exception):
    """Raised by a provider that asks to wait."""


def retried(call: Callable, *args, attempts: int = 5, wait: float = 5.0, sleep: Callable[[float], None] = time.sleep):
    """Waits wait * 2^k on limits, up to so many attempts; other errors are raised at once."""
    for k in range(attempts):
        try:
            return call(*args)
        except RateLimited:
            if k == attempts - 1:
                raise
            sleep(wait * 2**k)


def embed(articles: DataFrame, provider: Embedder, key: str = "article_id", batch: int = 256) -> DataFrame:
    """key, model, embedding, error of each row's document text; a row that fails alone carries its error."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            if not len(pdf):
                continue
            vecs: list = []
            errors: list = []
            for i in range(0, len(pdf), batch):
                texts = pdf["document"].iloc[i : i + batch].tolist()
                try:
                    vecs += [v.tolist() for v in retried(provider.encode, texts)]
                    errors += [None] * len(texts)
                except Exception:
                    for t in texts:
                        try:
                            vecs.append(retried(provider.encode, [t])[0].tolist())
                            errors.append(None)
                        except Exception as e:
                            vecs.append(None)
                            errors.append(f"Failed to embed: {e}"[:500])
            yield pd.DataFrame({key: pdf[key], "model": provider.name, "embedding": vecs, "error": errors})

    docs = articles.select(key, document_text(F.col("title"), F.col("content")).alias("document"))
    return docs.mapInPandas(run, f"{key} bigint, model string, embedding array<float>, error string")


def same_model(a: DataFrame, b: DataFrame) -> None:
    """Vectors of two models must not meet."""
    found = {r.model for r in a.select("model").distinct().union(b.select("model").distinct()).collect()}
    if len(found) > 1:
        raise ValueError(f"vectors of several models: {sorted(found)}")


class Classifier(Protocol):
    def classify(self, titles: list[str], contents: list[str]) -> list[bool]: ...


class KeywordClassifier:
    """A text passes that has one of the wanted words and, in its title, none of the unwanted."""

    def __init__(self, wanted: list[str], unwanted: list[str] = ()):
        self.wanted = re.compile(r"\b(?:" + "|".join(map(re.escape, wanted)) + ")", re.I)
        self.unwanted = re.compile(r"\b(?:" + "|".join(map(re.escape, unwanted)) + r")\b", re.I) if unwanted else None

    def classify(self, titles: list[str], contents: list[str]) -> list[bool]:
        return [bool(self.wanted.search(f"{t} {c}")) and not (self.unwanted and self.unwanted.search(t)) for t, c in zip(titles, contents)]


def quick_filter(articles: DataFrame, provider: Classifier, batch: int = 40, chars: int = 1000) -> DataFrame:
    """Rows that pass. A batch that fails passes whole; a verdict that is missing does not."""
    schema = articles.schema

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            keep: list[bool] = []
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                try:
                    got = list(retried(provider.classify, part["title"].fillna("").tolist(), part["content"].fillna("").str.slice(0, chars).tolist()))
                except Exception:
                    got = [True] * len(part)
                keep += [bool(x) for x in (got + [False] * len(part))[: len(part)]]
            yield pdf[np.array(keep, bool)]

    return articles.mapInPandas(run, schema)


class Extractor(Protocol):
    def extract(self, titles: list[str], contents: list[str]) -> list[str | None]: ...


class RuleExtractor:
    """An extraction as JSON from a headline that says who buys, pays for or licenses what from whom."""

    _RULE = re.compile(r"^(?P<a>.+?) (?:to buy|pays .+? for|licenses|takes option on|bets .+? on|buys|acquires) (?P<t>.+?)(?: (?:from|in deal) .*)?$")

    def extract(self, titles: list[str], contents: list[str]) -> list[str | None]:
        import json

        out: list[str | None] = []
        for t, c in zip(titles, contents):
            m = self._RULE.match(t)
            kind = "licensing" if "licenses" in t else "option-to-license" if "option" in t else "M&A"
            out.append(json.dumps({"parties": {"acquirer": m["a"], "target": m["t"]}, "deal_type": kind, "money": {}, "key_evidence": c[:300]}) if m else None)
        return out


def extract(articles: DataFrame, provider: Extractor, key: str = "article_id", batch: int = 20, chars: int = 10_000) -> DataFrame:
    """key, url, raw_json; null where nothing was extracted or the batch failed. Replies go to rows by place."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            if not len(pdf):
                continue
            got: list = []
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                try:
                    found = list(retried(provider.extract, part["title"].fillna("").tolist(), part["content"].fillna("").str.slice(0, chars).tolist()))
                except Exception:
                    found = []
                got += (found + [None] * len(part))[: len(part)]
            yield pd.DataFrame({key: pdf[key], "url": pdf["url"], "raw_json": got})

    return articles.select(key, "url", "title", "content").mapInPandas(run, f"{key} bigint, url string, raw_json string")


def translated(texts: DataFrame, cache_path: str, translate: Callable[[list[str]], list[str]], lang: str = "en") -> DataFrame:
    """Rows (text, lang) with translation: unchanged in the same language or where blank, else from the cache, else
    translated once for each different text; an error leaves the original."""
    rows = texts.withColumn("k", F.md5(F.concat_ws(":", F.coalesce("lang", F.lit("unknown")), F.lit(lang), "text")))
    cache = read_or_empty(texts.sparkSession, cache_path, "k string, translation string").groupBy("k").agg(F.max("translation").alias("translation"))
    due = rows.where((F.coalesce("lang", F.lit("")) != lang) & (F.trim(F.coalesce("text", F.lit(""))) != "")).select("k", "text").dropDuplicates(["k"]).join(cache, "k", "left_anti")

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            try:
                out = translate(pdf["text"].tolist())
            except Exception:
                continue
            yield pd.DataFrame({"k": pdf["k"], "translation": out})

    due.mapInPandas(run, "k string, translation string").write.mode("append").parquet(cache_path)
    cache = texts.sparkSession.read.schema("k string, translation string").parquet(cache_path).groupBy("k").agg(F.max("translation").alias("translation"))
    return rows.join(cache, "k", "left").withColumn("translation", F.coalesce("translation", "text")).drop("k")
