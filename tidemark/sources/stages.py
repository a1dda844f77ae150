"""Stage tables, checkpoints, indexes and listings on disk."""

from __future__ import annotations

import json
import uuid
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_key(config: dict) -> str:
    """Stages are told apart by the whole query, so that another query never resumes from them."""
    return sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_stage(df: DataFrame, root: str, config: dict, name: str) -> DataFrame:
    path = f"{root}/{stage_key(config)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_stage(spark: SparkSession, root: str, config: dict, name: str) -> DataFrame | None:
    """The stage of this very query if it was finished, else None."""
    path = f"{root}/{stage_key(config)}/{name}"
    return spark.read.parquet(path) if _exists(spark, f"{path}/_SUCCESS") else None


def resumed(spark: SparkSession, root: str, config: dict, name: str, make) -> DataFrame:
    found = read_stage(spark, root, config, name)
    return found if found is not None else write_stage(make(), root, config, name)


def resumed_in_parts(rows: DataFrame, root: str, config: dict, name: str, make, key: str, size: int = 250) -> DataFrame:
    """make(rows), kept in parts of about so many rows: a restart goes on after the last part that was finished.

    Rows go to parts by a hash of their key, so that the parts are the same on every start.
    """
    path, spark = f"{root}/{stage_key(config)}/{name}", rows.sparkSession
    parts_path = f"{path}/parts.json"
    if not _exists(spark, parts_path):
        parts = max(1, -(-rows.count() // size))
        spark.createDataFrame([(parts,)], "parts int").write.mode("overwrite").json(parts_path)
    parts = spark.read.schema("parts int").json(parts_path).first()[0]
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    for k in range(parts):
        if not _exists(spark, f"{path}/part={k}/_SUCCESS"):
            make(rows.where(part == k)).write.mode("overwrite").parquet(f"{path}/part={k}")
    return spark.read.parquet(*(f"{path}/part={k}" for k in range(parts)))


def replace_table(df: DataFrame, path: str) -> None:
    """Writes beside the table and takes its place when done: a failure leaves the old one."""
    spark = df.sparkSession
    new = f"{path}.new-{uuid.uuid4().hex}"
    df.write.parquet(new)
    at, to = spark._jvm.org.apache.hadoop.fs.Path(new), spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(to, True)
    fs.rename(at, to)


def clear_stages(spark: SparkSession, root: str, config: dict | None = None) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{stage_key(config)}" if config is not None else root)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_checkpoint(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A JSON document, also compressed; missing or unreadable: None."""
    if not _exists(spark, path):
        return None
    reader = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    df = (reader.schema(schema) if schema else reader).json(path)
    return None if df.columns == ["_corrupt_record"] else df


def write_checkpoint(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, compression="gzip")


def ensure_table(spark: SparkSession, path: str, schema: str) -> None:
    """An empty table where there is none."""
    if not _exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def listing(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """path, length, modificationTime of files, the newest first; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "length", "modificationTime")
    return files.orderBy(F.desc("modificationTime"), "path")


def url_index(spark: SparkSession, path: str) -> DataFrame:
    rows = read_or_empty(spark, path, "url string, source string, published_date string, crawled_at string")
    return rows.withColumn("source", F.coalesce("source", F.lit("Unknown")))
