"""Incremental work: the embedding queue, new urls and request rates, as batches or streams of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.providers import Embedder, embed
from tidemark.operators import filters, tables


def process_pending(articles: DataFrame, provider: Embedder, now: str, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The new snapshot and the new vectors: pending rows become embedded, or failed with their reason."""
    queue = articles.where("embedding_status = 'pending'")
    if limit:
        queue = tables.pending(articles, limit)
    missing = filters.required("url", "content")
    done = embed(queue.where(missing.isNull()), provider).select("article_id", "model", "embedding", "error")
    told = done.select("article_id", "error").unionByName(queue.where(missing.isNotNull()).select("article_id", missing.alias("error")))
    told = told.withColumn("_done", F.lit(True)).withColumnRenamed("error", "_error")
    j = articles.join(told, "article_id", "left")
    hit = F.coalesce("_done", F.lit(False))
    ok = F.col("_error").isNull()
    values = {
        "embedding_status": F.when(hit, F.when(ok, "embedded").otherwise("failed")).otherwise(F.col("embedding_status")),
        "embedded_at": F.when(hit, F.lit(now)).otherwise(F.col("embedded_at")),
        "error_message": F.when(hit, F.col("_error")).otherwise(F.col("error_message")),
    }
    snapshot = j.select(*(values[c].alias(c) if c in values else F.col(c) for c in articles.columns))
    return snapshot, done.where("embedding is not null").drop("error")


def retry_failed(articles: DataFrame) -> DataFrame:
    bad = F.col("embedding_status") == "failed"
    return articles.withColumns({"error_message": F.when(bad, F.lit(None)).otherwise(F.col("error_message")), "embedding_status": F.when(bad, "pending").otherwise(F.col("embedding_status"))})


def stream_embeddings(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, provider: Embedder) -> StreamingQuery:
    """Files that arrive are embedded once each, in as many batches as are due; a restart goes on where it stopped."""
    rows = spark.readStream.schema(schema).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        embed(batch.where(filters.required("url", "content").isNull()), provider).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_new_urls(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str) -> StreamingQuery:
    """Each url once, at its first sight; seen ones are the stream's state."""
    rows = spark.readStream.schema(schema).parquet(source).where("url is not null").dropDuplicates(["url"])
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_rates(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, late: str = "10 minutes") -> StreamingQuery:
    """Rows of each key in windows of a minute that slide by ten seconds; windows close when the watermark has passed."""
    rows = spark.readStream.schema(schema).parquet(source).withWatermark("ts", late)
    counts = rows.groupBy(F.window("ts", "60 seconds", "10 seconds"), "user_id").agg(F.count("*").alias("n"))
    flat = counts.select(F.col("window.start").alias("start"), "user_id", "n")
    return flat.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
