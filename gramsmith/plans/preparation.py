"""Queries of the general data-preparation problems (2, 3 and 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gramsmith.operators import badrows, nested, units
from gramsmith.session import small_rows, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.recipe_nodes(table(spark, d, "curated_recipes"))


def p2_units_linked(spark: SparkSession, d: str) -> DataFrame:
    """Whole units joined to the ingredient that contains their interval."""
    nodes = nested.shred(table(spark, d, "curated_recipes"), "record_id", nested.RECIPE_TYPES)
    u, i = nested.node_table(nodes, "whole_unit").alias("u"), nested.node_table(nodes, "ingredient").alias("i")
    return i.join(u, nested.contains("i", "u")).selectExpr("i.record_id", "i.pos", "i.label AS ingredient", "u.label AS unit", "u.number AS grams")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    known = units.registry(table(spark, d, "measure_unit"), table(spark, d, "ingredient"))
    cells = units.cells_to_milligrams(table(spark, d, "swedish_recipe_pannkisar"), "swedish_recipe_pannkisar", "recipe_id", ["flour", "milk", "egg"], "note", *known)
    return cells.unionByName(units.weights_to_milligrams(table(spark, d, "portion"), "portion", "id", "gram_weight", "unit_name", "notes", *known))


def _units(spark: SparkSession, d: str) -> tuple:
    rows = small_rows(table(spark, d, "measure_unit"), ["unit_name", "kind", "factor", "ingredient"])
    if rows is None:
        raise ValueError("the registry of units has more than 50,000 rows")
    return tuple(tuple(r) for r in rows)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    u = _units(spark, d)
    lines = badrows.bad_lines(table(spark, d, "measure_lines"), u)
    swedish = badrows.bad_cells(table(spark, d, "swedish_recipe_pannkisar"), "swedish_recipe_pannkisar", "recipe_id", {"butter": "butter", "salt": "salt"}, u)
    crumble = badrows.bad_cells(table(spark, d, "crumble"), "crumble", "recipe_id", {"sugar": "sugar"}, u)
    return lines.unionByName(swedish).unionByName(crumble)


def p5_located(spark: SparkSession, d: str) -> DataFrame:
    """The faults of lines with their place."""
    return badrows.located_faults(badrows.with_headers(table(spark, d, "measure_lines")), _units(spark, d), "measure_lines")


def p5_loaded(spark: SparkSession, d: str) -> DataFrame:
    return badrows.good_lines(table(spark, d, "measure_lines"), _units(spark, d))


QUERIES = {"p2_found": p2_found, "p2_units_linked": p2_units_linked, "p3_found": p3_found, "p5_found": p5_found, "p5_located": p5_located, "p5_loaded": p5_loaded}

_VALID = r"""(regexp_full_match({c}, '\s*0\s*') OR lower(regexp_extract({c}, '^\s*[0-9]+(?:[.,][0-9]+)? *(\S.*?)\s*$', 1)) IN (SELECT lower(unit_name) FROM measure_unit WHERE ingredient IS NULL)
  OR lower(regexp_extract({c}, '^\s*[0-9]+(?:[.,][0-9]+)? *(\S.*?)\s*$', 1)) || '|' || {n} IN (SELECT lower(unit_name) || '|' || ingredient FROM measure_unit WHERE ingredient IS NOT NULL))"""


def _bad(column: str, ingredient: str) -> str:
    return f"{column} IS NOT NULL AND NOT {_VALID.format(c=column, n=repr(ingredient))}"


_LINES = rf"""
WITH h AS (SELECT file_name, min_by(raw_line, line_id) AS head FROM measure_lines WHERE line_nr = 1 GROUP BY 1),
hc AS (SELECT file_name, list_transform(string_split(head, ','), lambda x: lower(trim(replace(x, '"', '')))) AS names FROM h),
l AS (SELECT line_id, line_nr, raw_line, names FROM measure_lines LEFT JOIN hc USING (file_name) WHERE (line_nr IS NULL OR line_nr <> 1) AND regexp_replace(raw_line, '\s', '', 'g') <> ''),
q AS (SELECT *, regexp_full_match(raw_line, '(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*') AS fine, len(regexp_replace(regexp_replace(raw_line, '"(?:[^"]|"")*"', '', 'g'), '[^,]', '', 'g')) + 1 AS n FROM l),
c AS (SELECT line_id, unnest(regexp_extract_all(raw_line, '("(?:[^"]|"")*"|[^",]*)(?:,|$)', 1)[1:n]) AS cell, unnest(names) AS name FROM q WHERE fine AND n = len(names)),
v AS (SELECT line_id, name, CASE WHEN cell LIKE '"%' THEN replace(cell[2:len(cell) - 1], '""', '"') ELSE cell END AS cell FROM c),
b AS (SELECT DISTINCT line_id FROM v WHERE NOT {_VALID.format(c="cell", n="name")})"""

ORACLES = {
    "p5_found": rf"""
{_LINES}
SELECT 'measure_lines' AS record_table, line_id AS record_id, CASE WHEN NOT fine THEN 'quoting' WHEN names IS NULL OR n <> len(names) THEN 'column_count' ELSE 'value' END AS reason
FROM q WHERE NOT fine OR names IS NULL OR n <> len(names) OR line_id IN (SELECT line_id FROM b)
UNION ALL SELECT 'swedish_recipe_pannkisar', recipe_id, 'value' FROM swedish_recipe_pannkisar WHERE ({_bad("butter", "butter")}) OR ({_bad("salt", "salt")})
UNION ALL SELECT 'crumble', recipe_id, 'value' FROM crumble WHERE {_bad("sugar", "sugar")}""",
    "p5_located": rf"""
{_LINES},
w AS (SELECT line_id, name, cell, row_number() OVER (PARTITION BY line_id ORDER BY k) - 1 AS k FROM (SELECT line_id, unnest(range(1, len(names) + 1)) AS k, unnest(names) AS name, unnest(regexp_extract_all(raw_line, '("(?:[^"]|"")*"|[^",]*)(?:,|$)', 1)[1:n]) AS cell FROM q WHERE fine AND n = len(names))),
x AS (SELECT line_id, min(k) AS k FROM (SELECT line_id, k, name, CASE WHEN cell LIKE '"%' THEN replace(cell[2:len(cell) - 1], '""', '"') ELSE cell END AS cell FROM w) WHERE NOT {_VALID.format(c="cell", n="name")} GROUP BY line_id)
SELECT 'measure_lines' AS record_table, line_id AS record_id, CASE WHEN NOT fine THEN 'quoting' WHEN names IS NULL OR n <> len(names) THEN 'column_count' ELSE 'value' END AS reason, line_nr,
  CAST(CASE WHEN NOT fine THEN length(regexp_extract(raw_line, '^(?:(?:"(?:[^"]|"")*"|[^",]*),)*')) WHEN names IS NULL OR n <> len(names) THEN n ELSE k END AS INT) AS place
FROM q LEFT JOIN x USING (line_id) WHERE NOT fine OR names IS NULL OR n <> len(names) OR k IS NOT NULL""",
    "p5_loaded": rf"""
{_LINES},
e AS (SELECT line_id, unnest(range(0, len(names))) AS k, unnest(names) AS name, unnest(regexp_extract_all(raw_line, '("(?:[^"]|"")*"|[^",]*)(?:,|$)', 1)[1:n]) AS cell FROM q WHERE fine AND n = len(names) AND line_id NOT IN (SELECT line_id FROM b)),
g AS (SELECT line_id, k, name, CASE WHEN cell LIKE '"%' THEN replace(cell[2:len(cell) - 1], '""', '"') ELSE cell END AS cell FROM e)
SELECT line_id, CAST(k AS INT) AS place, name AS ingredient, CASE WHEN regexp_full_match(cell, '\s*0\s*') THEN 0.0::DOUBLE ELSE CAST(replace(regexp_extract(cell, '^\s*([0-9]+(?:[.,][0-9]+)?)', 1), ',', '.') AS DOUBLE) END AS value,
  CASE WHEN regexp_full_match(cell, '\s*0\s*') THEN 'g' ELSE lower(regexp_extract(cell, '^\s*[0-9]+(?:[.,][0-9]+)? *(\S.*?)\s*$', 1)) END AS unit FROM g""",
    "p2_found": """
WITH i AS (SELECT record_id, unnest(ingredients) AS x, generate_subscripts(ingredients, 1) - 1 AS pos FROM curated_recipes),
s AS (SELECT record_id, unnest(sources) AS x, generate_subscripts(sources, 1) - 1 AS pos FROM curated_recipes)
SELECT record_id, 'ingredient' AS node, CAST(pos AS INT) AS pos, coalesce(x.name, '') AS label, CAST(0 AS BIGINT) AS milligrams FROM i WHERE x IS NOT NULL
UNION ALL
SELECT record_id, 'whole_unit', CAST(pos AS INT), coalesce(x.whole_unit.name, ''), CAST(coalesce(floor(x.whole_unit.grams * 1000 + 0.5), 0) AS BIGINT) FROM i WHERE x IS NOT NULL AND x.whole_unit IS NOT NULL
UNION ALL
SELECT record_id, 'source', CAST(pos AS INT), coalesce(x.title, ''), CAST(0 AS BIGINT) FROM s WHERE x IS NOT NULL""",
    "p2_units_linked": """
WITH i AS (SELECT record_id, unnest(ingredients) AS x, generate_subscripts(ingredients, 1) - 1 AS pos FROM curated_recipes)
SELECT record_id, CAST(pos AS INT) AS pos, x.name AS ingredient, x.whole_unit.name AS unit, x.whole_unit.grams AS grams
FROM i WHERE x IS NOT NULL AND x.whole_unit IS NOT NULL""",
}
