"""Queries of the llm problems (1, 4, 6, 7 and 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gramsmith.llm import canonical, encode, leaks, residue, survivors
from gramsmith.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors(table(spark, d, "density"), table(spark, d, "food"), table(spark, d, "density_source"))


def p1_consensus(spark: SparkSession, d: str) -> DataFrame:
    """The same groups by the counted vote."""
    return survivors.consensus_survivors(table(spark, d, "density"), table(spark, d, "food"), table(spark, d, "density_source"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.match(table(spark, d, "synonym").filter("food_id IS NULL"), "id", "name", table(spark, d, "food"), "id", "name")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode(table(spark, d, "documents"), "doc_id", "text", encode.vocabulary_path())


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_item"), "item_id", "text")


def p7_templates(spark: SparkSession, d: str) -> DataFrame:
    """Re-parameterised items: twelve words or more of the template with consistent slots, and how many slot values differ."""
    return leaks.templates(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_item"), "item_id", "text", whole_runs=False)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {"p1_found": p1_found, "p1_consensus": p1_consensus, "p4_found": p4_found, "p6_ids": p6_ids, "p7_found": p7_found, "p7_templates": p7_templates, "p8_found": p8_found}

ORACLES = {
    "p1_found": r"""
WITH src AS (SELECT regexp_replace(lower(source), '[^a-z]', '', 'g') AS k, max_by(source, trust) AS name, max(trust) AS trust FROM density_source GROUP BY 1),
r AS (SELECT regexp_replace(lower(d.sample_code), '[^\p{L}\p{N}]', '', 'g') AS k, d.id, d.food_id, d.g_per_ml, s.name,
  f.id IS NOT NULL AS known, d.g_per_ml > 0 AND d.g_per_ml <= 3 AND NOT isnan(d.g_per_ml) AS usable,
  row_number() OVER (PARTITION BY regexp_replace(lower(d.sample_code), '[^\p{L}\p{N}]', '', 'g') ORDER BY coalesce(s.trust, 0) DESC, d.updated_at DESC NULLS LAST, d.id) AS rank
  FROM density d LEFT JOIN src s ON s.k = regexp_replace(lower(split_part(d.source, '/', 1)), '[^\p{L}]', '', 'g') LEFT JOIN (SELECT DISTINCT id FROM food) f ON f.id = d.food_id
  WHERE d.sample_code IS NOT NULL)
SELECT min(id) AS group_id, min_by(food_id, rank) FILTER (WHERE known) AS food_id, min_by(id, rank) FILTER (WHERE usable) AS g_per_ml_id, min_by(name, rank) FILTER (WHERE name IS NOT NULL) AS source
FROM r GROUP BY k HAVING count(*) > 1""",
}
