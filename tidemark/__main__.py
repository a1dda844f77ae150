"""spark-submit or python -m tidemark: run, embed, update, reset.

    run    --config FILE --articles PATH --vectors PATH --stages FOLDER --sheets FOLDER
    embed  --articles PATH --out PATH --vectors PATH [--limit N] [--retry-failed]
    update --articles PATH --discovered PATH --out PATH [--pages PATH] [--start DATE --end DATE]   (yesterday to today)
    reset  --articles PATH --out PATH --vectors PATH --yes
"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions.providers import HashingEmbedder
from tidemark.operators import tables
from tidemark.operators.vectors import upsert_vectors
from tidemark.plans import funnel
from tidemark.sources.pages import articles_of
from tidemark.sources.stages import replace_table
from tidemark.streaming import queue


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("command", choices=["run", "embed", "update", "reset"])
    for name in ("config", "articles", "vectors", "stages", "sheets", "discovered", "out", "pages", "start", "end"):
        p.add_argument(f"--{name}")
    p.add_argument("--limit", type=int)
    p.add_argument("--retry-failed", action="store_true")
    p.add_argument("--yes", action="store_true")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    articles = spark.read.parquet(a.articles)
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    if a.command == "run":
        config = funnel.Config.load(a.config)
        funnel.write(funnel.run(articles, spark.read.parquet(a.vectors), config, a.stages), a.sheets, config.topic)
    elif a.command == "embed":
        if a.retry_failed:
            articles = queue.retry_failed(articles)
        snapshot, vectors = queue.process_pending(articles, HashingEmbedder(), now, a.limit)
        upsert_vectors(spark, a.vectors, vectors)
        snapshot.write.parquet(a.out)
    elif a.command == "update":
        new = funnel.new_articles(spark.read.parquet(a.discovered), articles)
        if a.pages:  # the pages that a crawler left: url, html
            stored = spark.read.parquet(a.pages).select("url", "html")
            start, end = a.start or (datetime.now(UTC) - timedelta(days=1)).strftime("%Y-%m-%d"), a.end or now[:10]
            new = articles_of(new.join(stored, "url"), start, end)
        rows = new.withColumns({"fetched_at": F.lit(now), "embedding_status": F.lit("pending"), "embedded_at": F.lit(None).cast("string"), "error_message": F.lit(None).cast("string"), "lastmod": F.lit(None).cast("string")})
        rows = rows if "content" in rows.columns else rows.withColumn("content", F.lit(None).cast("string"))
        rows = rows.withColumn("article_id", F.xxhash64("url")).select(*articles.columns)
        tables.insert_new(articles, rows, "url", "fetched_at").write.parquet(a.out)
    elif not a.yes:
        raise SystemExit("reset deletes all vectors; say --yes")
    else:
        articles.withColumns({"embedding_status": F.lit("pending"), "embedded_at": F.lit(None).cast("string"), "error_message": F.lit(None).cast("string")}).write.parquet(a.out)
        replace_table(spark.createDataFrame([], "article_id bigint, model string, embedding array<float>"), a.vectors)


if __name__ == "__main__":
    main()
