"""The whole query: search, filters, classifier, near duplicates, extraction, typed rows, sheets.

What has effects outside the plan (classifier, extractor) runs once: each is a stage of this very query, so that a
restart takes it up and another query never does.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.providers import Classifier, Embedder, Extractor, HashingEmbedder, KeywordClassifier, RuleExtractor, extract, quick_filter
from tidemark.operators import extractions, filters, tables, vectors
from tidemark.sources.sheets import write_sheets
from tidemark.sources.stages import resumed, resumed_in_parts

#: Stages of development by the sheet they go to. Fixed values.
BUCKETS = {
    "EARLY_STAGE": ("preclinical", "pre-clinical", "phase 1", "phase i", "first-in-human", "fih", "discovery"),
    "MID_STAGE": ("phase 2", "phase ii", "phase 3", "phase iii"),
    "UNDISCLOSED": ("unknown", "undisclosed", "not specified", "clinical"),
}


@dataclass(frozen=True)
class Config:
    topic: str
    start: str
    end: str
    sources: tuple[str, ...] = ()
    top_k: int = 20_000
    least_similarity: float = 0.2
    first: int = 1_000
    near: float = 0.85
    keywords: tuple[str, ...] = field(default=())

    @classmethod
    def load(cls, path: str) -> Config:
        """From YAML or JSON; a key that is not known is an error."""
        with open(path) as f:
            text = f.read()
        try:
            found = json.loads(text)
        except ValueError:
            import yaml

            found = yaml.safe_load(text)
        unknown = set(found) - {x.name for x in fields(cls)}
        if unknown:
            raise ValueError(f"unknown keys: {sorted(unknown)}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})

    def save(self, path: str) -> None:
        """As YAML where that can be written, else JSON; load() reads both."""
        found = {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(self).items()}
        try:
            import yaml

            text = yaml.safe_dump(found, allow_unicode=True, sort_keys=False)
        except ImportError:
            text = json.dumps(found, ensure_ascii=False, indent=1)
        with open(path, "w") as f:
            f.write(text)

    def query_text(self) -> str:
        return f"{self.topic} {' '.join(self.keywords)} acquisition merger partnership licensing".strip()


def candidates(articles: DataFrame, stored: DataFrame, config: Config, embedder: Embedder) -> DataFrame:
    """The best rows by similarity whose date, source and url fit, in order. stored: article_id, model, embedding."""
    query = embedder.encode([config.query_text()])[0].tolist()
    keep = filters.valid_date() & filters.in_dates(config.start, config.end) & ~filters.rejected_url()
    if config.sources:
        keep = keep & F.col("source").isin(*config.sources)
    facts = articles.select("article_id", "url", "title", "published_date", "source")
    carry = ("url", "title", "published_date", "source")
    hits = vectors.search(stored.select("article_id", "embedding").join(facts, "article_id"), query, config.top_k, "article_id", config.least_similarity, keep, exact=True, carry=carry)
    return hits.orderBy("distance", "article_id").limit(config.first)


def stage_bucket(stage: str = "stage") -> F.Column:
    out = F.lit(None).cast("string")
    for name, words in BUCKETS.items():
        out = F.when(F.lower(stage).isin(*words), name).otherwise(out)
    return out


def run(articles: DataFrame, stored: DataFrame, config: Config, root: str, embedder: Embedder | None = None, classifier: Classifier | None = None, extractor: Extractor | None = None) -> DataFrame:
    """Typed rows with reject_reason and bucket; the stages before them are kept under root."""
    spark = articles.sparkSession
    embedder = embedder or HashingEmbedder()
    classifier = classifier or KeywordClassifier(list(config.keywords) or config.topic.split(), ["roundup", "earnings"])
    key = asdict(config)
    hits = resumed(spark, root, key, "hits", lambda: candidates(articles, stored, config, embedder))
    texts = articles.select("article_id", "content")
    passed = resumed(spark, root, key, "passed", lambda: quick_filter(hits.join(texts, "article_id").select("article_id", "url", "title", "content", "distance"), classifier))
    vecs = stored.select(F.col("article_id").alias("id"), "embedding")

    def distinct() -> DataFrame:
        rows = passed.select(F.col("article_id").alias("id"), F.col("distance").alias("ord"), F.length(F.coalesce("content", F.lit(""))).cast("bigint").alias("length"))
        kept = vectors.greedy_distinct(rows.join(vecs, "id"), above=config.near)
        return passed.join(kept.select(F.col("id").alias("article_id"), "pos"), "article_id")

    kept = resumed(spark, root, key, "distinct", distinct)
    replies = resumed_in_parts(kept, root, key, "extracted", lambda rows: extract(rows, extractor or RuleExtractor()), "article_id")
    rows = extractions.validated(extractions.parsed(replies.withColumnRenamed("article_id", "extraction_id")))
    return rows.withColumn("bucket", stage_bucket())


def write(rows: DataFrame, folder: str, topic: str, at: datetime | None = None) -> list[str]:
    """One sheet a bucket that has rows, with the time in its name; rows of no bucket are in none."""
    good = rows.where("reject_reason is null and bucket is not null")
    deals = good.select(
        F.col("day").alias("date_announced"), "target", "acquirer", F.col("upfront_value").alias("upfront_value_usd"), F.col("contingent_payment").alias("contingent_payment_usd"), F.col("total_deal_value").alias("total_deal_value_usd"),
        F.lit(None).cast("double").alias("upfront_pct_total"), "stage", F.lit(topic).alias("therapeutic_area"), F.lit(None).cast("string").alias("secondary_areas"), "asset_focus", F.col("deal_type").alias("deal_type_detailed"), "geography", F.col("url").alias("source_url"), F.lit(False).alias("needs_review"),
        F.concat(F.lit(f"deals_{topic.replace(' ', '_')}_"), "bucket").alias("bucket"),
    )
    return write_sheets(deals, folder, "bucket", f"{{bucket}}_{at or datetime.now():%Y%m%d_%H%M%S}.xlsx")


def new_articles(discovered: DataFrame, known: DataFrame) -> DataFrame:
    """Urls to fetch: each once, the feed before the sitemap, none that is known."""
    rows = discovered.withColumn("p", F.when(F.col("source") == "RSS", 0).when(F.col("source") == "Atom", 1).otherwise(2))
    return tables.not_in(tables.first_of(rows, "url", "p", "title").drop("p"), known, "url")
