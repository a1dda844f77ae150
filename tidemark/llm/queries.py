"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.leaks import leak_report, leaked_items
from tidemark.llm.looks import consistent_text, look_alike_classes, look_alikes
from tidemark.llm.mixing import mixed_records, reached_shares
from tidemark.llm.names import organisations, variant_pairs
from tidemark.llm.near import near_classes, near_copies
from tidemark.llm.pages import main_body_lines, template_residue
from tidemark.llm.repeated import repeated_lines, without_repeated
from tidemark.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "articles"))


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as membership: a row a text, with its class and number of links."""
    return near_classes(table(spark, sf_dir, "articles"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_body_lines(table(spark, sf_dir, "articles"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_pairs(table(spark, sf_dir, "deals"), table(spark, sf_dir, "aliases"))


def p3_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return organisations(table(spark, sf_dir, "deals"), table(spark, sf_dir, "aliases"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(table(spark, sf_dir, "articles"))


def p6_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated(table(spark, sf_dir, "articles"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_residue(table(spark, sf_dir, "articles"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_records(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), keep_shares=True)


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reached_shares(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), keep_shares=True)


def p9_capped_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a mix as large as its sources, in which the caps bind."""
    return reached_shares(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_capped_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of that mix."""
    return mixed_records(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_alikes(table(spark, sf_dir, "documents"))


def p10_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consistent_text(table(spark, sf_dir, "documents"))


def p10_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_alike_classes(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_classes, p2_found, p3_found, p3_organisations, p6_found, p6_rebuilt, p7_found, p8_found, p8_report, p9_mix, p9_shares, p9_capped_shares, p9_capped_mix, p10_found, p10_classes, p10_texts)}

_P6_LINES = r"""
pages AS (SELECT article_id, source, content FROM articles WHERE source IS NOT NULL),
totals AS (SELECT source, count(*) AS total FROM pages GROUP BY source),
lines AS (
  SELECT DISTINCT article_id, source, lower(regexp_replace(trim(regexp_replace(line, '[\s\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')), '[0-9]+', '0', 'g')) AS line_text
  FROM pages, unnest(string_split(content, chr(10))) AS t(line)
),
found AS (
  SELECT l.source, l.line_text FROM lines l JOIN totals t USING (source)
  WHERE l.line_text <> '' GROUP BY l.source, l.line_text, t.total HAVING count(*) >= 5 AND count(*) * 10 >= t.total
)
"""
_P6_NORMAL = r"lower(regexp_replace(trim(regexp_replace(x, '[\s\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')), '[0-9]+', '0', 'g'))"
SQL = {
    "p6_found": f"WITH {_P6_LINES} SELECT source, line_text FROM found",
    "p6_rebuilt": f"""
WITH {_P6_LINES}, gone AS (SELECT source, list(line_text) AS gone FROM found GROUP BY source),
cut AS (SELECT article_id, string_split(content, chr(10)) AS cut, coalesce(gone, []) AS gone FROM articles LEFT JOIN gone USING (source)),
kept AS (SELECT article_id, cut, list_filter(cut, lambda x: NOT list_contains(gone, {_P6_NORMAL})) AS kept FROM cut)
SELECT article_id, array_to_string(kept, chr(10)) AS content, (len(cut) - len(kept))::BIGINT AS n_removed FROM kept
""",
}
