"""Names by a dictionary of known spellings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import normalize_text, strip_legal_suffixes


def canonical_names(names: DataFrame, aliases: DataFrame, column: str = "name") -> DataFrame:
    """column and canonical: the suffix goes first, then the dictionary is asked, case and accents aside.

    A canonical name is its own spelling; of several hits the first by precedence counts; a miss is the name itself.
    The dictionary is asked once for each different name.
    """
    spelled = aliases.select("canonical", F.col("variant").alias("spelling"), "precedence").unionByName(aliases.select("canonical", F.col("canonical").alias("spelling"), F.lit(0).alias("precedence")))
    known = spelled.withColumn("k", normalize_text("spelling")).groupBy("k").agg(F.min_by("canonical", F.struct("precedence", "canonical")).alias("found"))
    different = names.select(column).distinct().withColumn("stripped", strip_legal_suffixes(F.col(column)))
    found = different.withColumn("k", normalize_text("stripped")).join(known, "k", "left")
    return names.join(found.select(column, F.when(F.trim(column) == "", F.col(column)).otherwise(F.coalesce("found", "stripped")).alias("canonical")), column, "left")
