"""Queries on mixed notations: times and amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.amounts import usd_amounts
from tidemark.operators.instants import utc_instants
from tidemark.session import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc_instants(table(spark, sf_dir, "articles"), table(spark, sf_dir, "sites"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usd_amounts(table(spark, sf_dir, "raw_extractions"), table(spark, sf_dir, "fx_rates"))


QUERIES = {f.__name__: f for f in (p4_found, p5_found)}
SQL: dict[str, str] = {}
