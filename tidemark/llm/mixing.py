"""Sources combined to target shares of tokens, by nested hash thresholds.

Each source's tokens are summed by bucket of a record hash. The bucket in which its budget ends is the only one
refined, by the next bits of the hash, until a level holds single records; a filter on the hash then takes the part, and
no record is ever sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.session import stage

#: Where the public vocabulary files lie unless spark.tidemark.tokenizers names another folder, and the one counted with.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
#: How that vocabulary's texts are cut before merging. Fixed pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bits of the hash that one histogram resolves; LEVELS of them resolve the hash.
BITS, LEVELS = 12, 5


@cache
def _encoder(folder: str, name: str):
    import base64

    import tiktoken

    with open(Path(folder, name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, folder: str = TOKENIZERS, name: str = VOCABULARY) -> Column:
    """Tokens of a text; 0 for null."""

    @F.pandas_udf(LongType())
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _encoder(folder, name).encode_ordinary
        for s in parts:
            yield pd.Series([len(encode(t)) if isinstance(t, str) else 0 for t in s], dtype="int64")

    return count(text)


def _sized(documents: DataFrame, targets: DataFrame, folder: str) -> DataFrame:
    """doc_id, source, n_tokens, h of the records of target sources; h is a 60-bit hash of the record."""
    h = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << (BITS * LEVELS)) - 1))
    wanted = documents.where("source is not null and text is not null").join(targets.select("source").distinct(), "source", "left_semi")
    return stage(wanted.select("doc_id", "source", token_count(F.col("text"), folder).alias("n_tokens"), h.alias("h")), "sized")


def budgets(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None, keep_shares: bool = False) -> DataFrame:
    """source, target_share, max_repeats, tokens, budget, whole (full repeats), rest (tokens to take once more).

    The mix holds total_tokens; by default as many as the target sources hold. A source short of its budget is
    repeated whole as often as its cap allows and falls short of its share. With keep_shares the mix is made no larger
    than lets every source that has tokens reach its share.
    """
    t = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    t = t.join(have, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    total = F.lit(total_tokens) if total_tokens is not None else F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    t = t.withColumn("total", total.cast("double"))
    if keep_shares:
        most = F.when((F.col("tokens") > 0) & (F.col("target_share") > 0), F.col("tokens") * F.col("max_repeats") / F.col("target_share"))
        most = F.min(most).over(Window.partitionBy(F.lit(0)))
        t = t.withColumn("total", F.least("total", most) if total_tokens is not None else F.coalesce(most, "total"))
    t = t.withColumn("budget", F.floor(F.col("target_share") * F.col("total"))).drop("total")
    whole = F.when(F.col("tokens") > 0, F.least(F.floor(F.col("budget") / F.col("tokens")), "max_repeats")).otherwise(F.lit(0))
    t = t.withColumn("whole", whole.cast("long"))
    rest = F.when(F.col("whole") < F.col("max_repeats"), F.col("budget") - F.col("whole") * F.col("tokens")).otherwise(F.lit(0))
    return t.withColumn("rest", F.when(F.col("tokens") > 0, rest).otherwise(F.lit(0)).cast("long"))


def thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """source, below: records of the source with h < below hold at most its rest, and one more would exceed it."""
    left = plan.select("source", "rest", F.lit(0).cast("long").alias("below"))
    records = sized
    for level in range(LEVELS):
        low = BITS * (LEVELS - 1 - level)
        bucket = F.shiftright("h", low)
        # Only the records in the bucket where the budget ends: those at or past `below` within one step of it.
        inside = records.join(left, "source") if level == 0 else records.join(left, "source").where(F.shiftright("h", low + BITS) == F.shiftright("below", low + BITS))
        sums = inside.groupBy("source", "rest", "below", bucket.alias("bucket")).agg(F.sum("n_tokens").alias("n"))
        run = Window.partitionBy("source").orderBy("bucket")  # at most 2^BITS rows a source
        sums = sums.withColumn("sum", F.sum("n").over(run))
        over = sums.where("sum > rest").groupBy("source").agg(F.min(F.struct("bucket", (F.col("rest") - F.col("sum") + F.col("n")).alias("rest"))).alias("end"))
        end = left.join(over, "source", "left")
        # No bucket exceeds the rest: everything up to the end of this range is taken.
        none = F.when(F.lit(level == 0), F.lit(1 << (BITS * LEVELS))).otherwise((F.shiftright("below", low + BITS) + 1) * F.lit(1 << (low + BITS)))
        nxt = end.select(
            "source",
            F.when(F.col("end").isNotNull(), F.col("end.rest")).otherwise(F.lit(0)).alias("rest"),
            F.when(F.col("end").isNotNull(), F.col("end.bucket") * F.lit(1 << low)).otherwise(none).alias("below"),
            F.col("end").isNotNull().alias("open"),
        )
        nxt = stage(nxt, f"below{level}")
        done = nxt.where("not open").select("source", "below")
        out = done if level == 0 else out.unionByName(done)
        left = nxt.where("open").select("source", "rest", "below")
    return out.unionByName(left.select("source", "below"))


def _mix(documents: DataFrame, targets: DataFrame, total_tokens: int | None, folder: str | None, keep_shares: bool) -> tuple[DataFrame, DataFrame]:
    sized = _sized(documents, targets, folder or documents.sparkSession.conf.get("spark.tidemark.tokenizers", TOKENIZERS))
    plan = stage(budgets(sized, targets, total_tokens, keep_shares), "plan")
    cut = plan.join(thresholds(sized, plan), "source", "left")
    # One row a source, of eight numbers: a table of sources is small by kind, but its size is left to the planner.
    records = sized.join(cut.select("source", "whole", "below"), "source")
    copies = F.col("whole") + (F.col("h") < F.coalesce("below", F.lit(0))).cast("long")
    return records.select("doc_id", "source", "n_tokens", copies.alias("copies")).where("copies > 0"), plan


def mixed_records(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, folder: str | None = None, keep_shares: bool = False) -> DataFrame:
    """doc_id, source, n_tokens, copies of every record in the mix, copies at most the source's max_repeats.

    Sources without target, null sources and null texts stay out; a record without tokens may come along. Rows
    repeated with one id and text share a hash and come together. Of repeated targets the largest counts.
    """
    return _mix(documents, targets, total_tokens, folder, keep_shares)[0]


def reached_shares(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, folder: str | None = None, keep_shares: bool = False) -> DataFrame:
    """source, target_share, tokens, mixed_tokens, records, actual_share of every source with a target."""
    mixed, plan = _mix(documents, targets, total_tokens, folder, keep_shares)
    by = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.count("*").alias("records"))
    out = plan.join(by, "source", "left").select("source", "target_share", "tokens", F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), F.coalesce("records", F.lit(0)).alias("records"))
    total = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(0)))
    return out.withColumn("actual_share", F.when(total > 0, F.round(F.col("mixed_tokens") / total, 6)).otherwise(F.lit(0.0)))
