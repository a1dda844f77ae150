"""Keyed snapshots: who wins a key, upserts, updates, differences, queues and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row a key, the greatest by order. An aggregate, so that it combines before the shuffle and no key sorts."""
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(key, "r.*").select(*rows.columns)


def first_of(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row a key, the least by order."""
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(key, "r.*").select(*rows.columns)


def upsert(existing: DataFrame, incoming: DataFrame, key: str, seq: str, reset: dict[str, Column] | None = None) -> DataFrame:
    """Incoming rows over existing ones, the last of several by seq; columns in reset start anew on every write."""
    new = latest(incoming, key, seq).withColumns(reset or {})
    return existing.join(new.select(key), key, "left_anti").unionByName(new.select(*existing.columns))


def insert_new(existing: DataFrame, incoming: DataFrame, key: str, *order: str) -> DataFrame:
    """Incoming rows with new keys are added, the last of several; known keys stay as they are."""
    return existing.unionByName(latest(incoming, key, *order).join(existing.select(key), key, "left_anti").select(*existing.columns))


def mark(rows: DataFrame, keys: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Rows with a listed key get the values."""
    hit = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    j = rows.join(hit, key, "left")
    return j.select(*(F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in rows.columns))


def not_in(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is unknown, repeated ones too."""
    return rows.join(known.select(key), key, "left_anti")


def pending(rows: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """The queue by arrival; no limit, or 0, means all."""
    out = rows.where("embedding_status = 'pending'").orderBy("fetched_at", "url", "article_id")
    out = out.offset(offset) if offset else out
    return out.limit(limit) if limit else out


def failed(rows: DataFrame, limit: int = 100) -> DataFrame:
    return rows.where("embedding_status = 'failed'").orderBy(F.desc("embedded_at"), "article_id").limit(limit)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with their place in order, from 0, as position.

    Ranges are sorted apart and the counts before them carried over, so that no task holds the whole table.
    """
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    parts = stage(parts, "numbered")  # ranges are sampled: another run may cut them otherwise
    counts = parts.groupBy("_p").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_before")
    return parts.join(before, "_p").withColumn("position", F.col("_before") + F.col("_i")).select(*rows.columns, "position")


def batches(rows: DataFrame, size: int, *order: str) -> DataFrame:
    """Rows with the number of their batch of so many rows in order."""
    return numbered(rows, *order).withColumn("batch", F.floor(F.col("position") / size)).drop("position")


def by_position(left: DataFrame, right: DataFrame, left_order: str, right_order: str, how: str = "inner") -> DataFrame:
    """Rows of two lists by place: cut to the shorter, or with how='left' padded with nulls to the left one's length."""
    return numbered(left, left_order).join(numbered(right, right_order), "position", how)


def status_snapshot(rows: DataFrame, elapsed: float) -> DataFrame:
    """One row: total, pending, failed and processed rows, the rate so far per hour, and the seconds that the rest will take; null before the first."""
    counts = rows.agg(F.count("*").alias("total"), *(F.count_if(F.col("embedding_status") == s).alias(s) for s in ("pending", "failed")), F.count_if(F.col("embedding_status") != "pending").alias("processed"))
    rate = F.round(F.col("processed") * 3600.0 / elapsed, 4)
    return counts.withColumns({"per_hour": rate, "eta_seconds": F.when(F.col("processed") > 0, F.round(F.col("pending") * elapsed / F.col("processed"), 4))})


def sliding_count(rows: DataFrame, key: str, ts: str, seconds: int) -> DataFrame:
    """Rows of the key in the window that ends with each row; windows cut by time, so that a busy key has many tasks.

    Counting by second first bounds what a second of a busy key costs.
    """
    per = rows.select(F.col(key), F.unix_timestamp(ts).alias("t")).groupBy(key, "t").agg(F.count("*").alias("n"))
    cut = per.withColumn("slot", F.explode(F.sequence(F.floor(F.col("t") / (seconds * 16)), F.floor((F.col("t") + seconds) / (seconds * 16)))))
    w = Window.partitionBy(key, "slot").orderBy("t").rangeBetween(-(seconds - 1), 0)
    counted = cut.withColumn("in_window", F.sum("n").over(w)).where(F.col("slot") == F.floor(F.col("t") / (seconds * 16)))
    return counted.select(key, "t", "n", "in_window")
