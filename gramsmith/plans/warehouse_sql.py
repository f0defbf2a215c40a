"""The SQL of the warehouse queries, for DuckDB."""

from __future__ import annotations

_M = r"""
t AS (SELECT *, CAST(CAST(l_quantity AS INT) AS VARCHAR) || (['g', ' dl', 'cups', ' tbsp', 'oz', ' large', 'hg'])[l_linenumber] AS measure FROM lineitem),
m AS (SELECT *, CAST(regexp_extract(measure, '^([0-9]+) *([a-zA-Z][a-zA-Z ]*)', 1) AS DOUBLE) AS value, lower(trim(regexp_extract(measure, '^([0-9]+) *([a-zA-Z][a-zA-Z ]*)', 2))) AS unit FROM t)"""
_G = (
    _M
    + """,
g AS (SELECT l_orderkey, l_linenumber, l_linestatus, p_type, 0.5::DOUBLE + p_size / 100.0::DOUBLE AS density,
  value * CASE unit WHEN 'g' THEN 1.0::DOUBLE WHEN 'hg' THEN 100.0::DOUBLE WHEN 'oz' THEN 28.3495231::DOUBLE WHEN 'large' THEN 50.0::DOUBLE
    ELSE CASE unit WHEN 'dl' THEN 100.0::DOUBLE WHEN 'cups' THEN 238.337210755::DOUBLE WHEN 'tbsp' THEN 14.7868::DOUBLE END * (0.5::DOUBLE + p_size / 100.0::DOUBLE) END AS grams
  FROM m JOIN part ON l_partkey = p_partkey)"""
)
_TYPES = ["STANDARD", "ECONOMY", "MEDIUM", "PROMO", "LARGE", "SMALL"]
_C = [f"c{k}" for k in range(6)]


def _frame(keys: str) -> str:
    cells = ", ".join(f"CAST(coalesce(sum(CASE WHEN p_type = '{t}' THEN CAST(floor(grams * 1000 + 0.5) AS BIGINT) END), 0) AS DOUBLE) / 1000.0::DOUBLE AS c{k}" for k, t in enumerate(_TYPES))
    return _G + f",\nf AS (SELECT {keys}, {cells} FROM g GROUP BY ALL)"


def _long(source: str, keys: str, value: str = "{c}") -> str:
    return " UNION ALL ".join(f"SELECT {keys}, {k} AS col_idx, '{t.lower()}' AS ingredient, {value.format(c=f'c{k}')} AS value FROM {source}" for k, t in enumerate(_TYPES))


_SUM = " + ".join(_C)
_F, _FK = _frame("l_orderkey"), _frame("l_orderkey, l_linestatus")
_S = _F + f",\nl AS ({_long('f', 'l_orderkey', '{c} * (100.0::DOUBLE / (' + _SUM + '))')})"
_SK = _FK + f",\nl AS ({_long('f', 'l_orderkey, l_linestatus', '{c} * (100.0::DOUBLE / (' + _SUM + '))')})"
_AGG = "count(value) AS n, avg(value) AS mean, stddev_pop(value) AS std, 1.96::DOUBLE * stddev_pop(value) / sqrt(count(value)) AS ci_half"
_MIN = "CASE WHEN mean = 0 THEN 0 ELSE CAST(ceil(pow(1.96::DOUBLE * std / (mean * 0.05::DOUBLE), 2)) AS BIGINT) END"
_A = _S + f",\na AS (SELECT col_idx, ingredient, {_AGG} FROM l GROUP BY ALL)"
_AK = _SK + f",\na AS (SELECT l_linestatus, col_idx, ingredient, {_AGG} FROM l GROUP BY ALL)"
_R = _A + ",\nr AS (SELECT col_idx, ingredient, mean, std, ci_half, mean / first_value(mean) OVER (ORDER BY col_idx) AS value FROM a)"
_D = _AK + """,
p AS (SELECT *, mean * 100 / sum(mean) OVER (PARTITION BY l_linestatus) AS pct FROM a),
x AS (SELECT f.col_idx, f.ingredient, abs(o.pct - f.pct) / ((f.pct + o.pct) / 2) AS difference, (o.pct - f.pct) / f.pct AS change FROM p f JOIN p o ON f.col_idx = o.col_idx AND f.l_linestatus = 'F' AND o.l_linestatus = 'O')"""
_Z = _F + f""",
n AS (SELECT {", ".join(f"{c} * (100.0::DOUBLE / ({_SUM})) AS {c}" for c in _C)} FROM f),
mu AS (SELECT {", ".join(f"avg({c}){' FILTER (WHERE ' + c + ' <> 0)' if c in ('c2', 'c5') else ''} AS m{c[1]}" for c in _C)} FROM n),
sh AS (SELECT m2 / (m0 + m1 + m2 + m3 + m4 + m5) AS p2, m5 / (m0 + m1 + m2 + m3 + m4 + m5) AS p5 FROM mu),
w AS (SELECT *, CASE WHEN c2 = 0 THEN 1 - p2 ELSE 1 END * CASE WHEN c5 = 0 THEN 1 - p5 ELSE 1 END AS k FROM n, sh),
i AS (SELECT c0 * k AS c0, c1 * k AS c1, CASE WHEN c2 = 0 THEN 100 * p2 ELSE c2 * k END AS c2, c3 * k AS c3, c4 * k AS c4, CASE WHEN c5 = 0 THEN 100 * p5 ELSE c5 * k END AS c5 FROM w),
l AS ({" UNION ALL ".join(f"SELECT {k} AS col_idx, c{k} * (100.0::DOUBLE / ({_SUM})) AS value FROM i" for k in range(6))})"""
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_U = "lower(" + _STRIP.format("unit_name") + ")"
_RANK = "CASE source WHEN 'fdc_derived' THEN 1 WHEN 'supplementary' THEN 2 ELSE 3 END"
_MEASURE_NAMES = "^(cup|tbsp|tablespoon|tsp|teaspoon|fl oz|fluid ounce|quart|pint|liter|oz)($|[ ,])"


# The registry built from the tables: foods are those of food, portions those of portion, measured densities those of density by sample.
_REG = rf"""rf AS (SELECT id AS fdc_id, name, row_number() OVER (ORDER BY id) AS food_id FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY id) AS k FROM food WHERE name IS NOT NULL) WHERE k = 1),
ri AS (SELECT f.id AS fdc_id, rf.food_id FROM food f JOIN rf USING (name)),
rp AS (SELECT p.id AS pos, ri.food_id, {_STRIP.format('unit_name')} AS unit_name, round(gram_weight, 4) AS gram_weight FROM portion p JOIN ri ON p.food_id = ri.fdc_id WHERE {_STRIP.format('unit_name')} <> '' AND gram_weight > 0),
rk AS (SELECT *, min(pos) OVER (PARTITION BY food_id) AS first_at, CASE WHEN u = 'cup' THEN 0 WHEN u LIKE '%cup%' AND u LIKE '%fluid%' THEN 1 WHEN u LIKE '%cup%' AND u NOT LIKE '%whip%' THEN 2 WHEN u LIKE '%cup%' THEN 3
  WHEN u IN ('tbsp', 'tablespoon') THEN 4 WHEN regexp_matches(u, '^tsp\b') THEN 5 WHEN u IN ('fl oz', 'fluid ounce') THEN 6 END AS tier FROM (SELECT *, lower(unit_name) AS u FROM rp)),
rb AS (SELECT food_id, first_at AS pos, gram_weight, tier FROM (SELECT *, row_number() OVER (PARTITION BY food_id ORDER BY tier, pos) AS n FROM rk WHERE tier IS NOT NULL AND gram_weight > 0) WHERE n = 1),
rs AS (SELECT * FROM (VALUES (1, 'rum', 0.94::DOUBLE), (2, 'juice (generic)', 1.05::DOUBLE), (3, 'apple (raw)', 0.56::DOUBLE), (4, 'raisins', 0.65::DOUBLE), (5, 'candied peel', 0.75::DOUBLE), (6, 'grated cheese (generic)', 0.38::DOUBLE), (7, 'potato starch', 0.72::DOUBLE), (8, 'cardamom seeds', 0.65::DOUBLE)) t(k, name, d)),
ru AS (SELECT id AS pos, {_STRIP.format('sample_code')} AS name, g_per_ml, CASE WHEN {_STRIP.format('source')} <> '' THEN 'fao/' || {_STRIP.format('source')} ELSE 'fao' END AS source FROM density WHERE {_STRIP.format('sample_code')} <> '' AND g_per_ml > 0 AND NOT isnan(g_per_ml)),
rn AS (SELECT lower(name) AS key, food_id FROM rf UNION ALL SELECT name, (SELECT count(*) FROM rf) + k FROM rs),
rw AS (SELECT key, row_number() OVER (ORDER BY pos) + (SELECT count(*) + 8 FROM rf) AS food_id FROM (SELECT lower(name) AS key, min(pos) AS pos FROM ru WHERE lower(name) NOT IN (SELECT key FROM rn) GROUP BY 1)),
rm AS (SELECT ru.pos, ru.g_per_ml, ru.source, x.food_id FROM ru JOIN (SELECT key, min(food_id) AS food_id FROM (SELECT * FROM rn UNION ALL SELECT * FROM rw) GROUP BY key) x ON lower(ru.name) = x.key)"""


def _w(prefix: str, select: str) -> str:
    return f"WITH {prefix}\n{select}"


ORACLES = {
    "parse_measures": _w(_M, "SELECT l_orderkey, l_linenumber, value, unit FROM m"),
    "unit_to_grams": _w(_G, "SELECT l_orderkey, l_linenumber, p_type, round(grams, 6) AS grams FROM g"),
    "whole_unit_lookup": _w(_M, "SELECT l_orderkey, l_linenumber, unit AS size, value, value * 50.0::DOUBLE AS grams FROM m WHERE unit = 'large'"),
    "normalize_100": _w(_S, "SELECT l_orderkey, col_idx, round(value, 6) AS share FROM l"),
    "wide_pivot": _w(_F, "SELECT * FROM f"),
    "to_long": _w(_F, _long("f", "l_orderkey")),
    "distinct_compositions": _w(_F, "SELECT DISTINCT c0, c1, c2, c3, c4, c5 FROM f"),
    "merge_full": _w(_F, "SELECT l_orderkey, round(c0 + c5, 6) AS c0, round(c1 + c2, 6) AS c1, round(c3, 6) AS c2, round(c4, 6) AS c3 FROM f"),
    "merge_partial": _w(_F, "SELECT l_orderkey, round(c1 + c0 * 0.25::DOUBLE, 6) AS c0, round(c2 * 0.5::DOUBLE + c5, 6) AS c1, round(c3, 6) AS c2, round(c4, 6) AS c3 FROM f"),
    "column_stats": _w(_A, "SELECT col_idx, ingredient, n, round(mean, 6) AS mean, round(std, 6) AS std FROM a"),
    "ci_bounds": _w(_A, "SELECT col_idx, round(mean - ci_half, 6) AS ci_low, round(mean + ci_half, 6) AS ci_high FROM a"),
    "min_sample_size": _w(_A, f"SELECT col_idx, {_MIN} AS min_n FROM a"),
    "sample_size": _w(_F, "SELECT count(*) AS sample_size FROM (SELECT DISTINCT c0, c1, c2, c3, c4, c5 FROM f)"),
    "bakers_percentage": _w(_R, "SELECT col_idx, round(value, 6) AS ratio FROM r"),
    "proportions": _w(_A, "SELECT col_idx, round(mean * 100 / sum(mean) OVER (), 6) AS proportion FROM a"),
    "stats_by_status": _w(_AK, f"SELECT l_linestatus, col_idx, n, round(mean, 6) AS mean, round(ci_half, 6) AS ci_half, {_MIN} AS min_n FROM a"),
    "zero_filtered_means": _w(_S, "SELECT col_idx, round(avg(value) FILTER (WHERE value <> 0), 6) AS mean FROM l GROUP BY col_idx"),
    "zero_imputed_stats": _w(_Z, "SELECT col_idx, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM l GROUP BY col_idx"),
    "recipe_scaled": _w(_R, "SELECT col_idx, round(value * (500.0::DOUBLE / sum(value) OVER ()), 6) AS grams FROM r"),
    "recipe_restricted": _w(
        _R, "SELECT col_idx, round(value * least((SELECT 500.0::DOUBLE / sum(value) FROM r), (SELECT 60.0::DOUBLE / sum(value) FROM r WHERE ingredient = 'standard'), (SELECT 90.0::DOUBLE / sum(value) FROM r WHERE ingredient = 'promo')), 6) AS grams FROM r"
    ),
    "as_percentages": _w(_R, "SELECT col_idx, round(value * 100 / sum(value) OVER (), 6) AS percentage FROM r"),
    "ingredient_values": _w(_R, "SELECT ingredient, round(value * 250, 6) AS grams FROM r WHERE ingredient IN ('promo', 'small')"),
    "grams_to_ml_pieces": _w(_G, "SELECT l_orderkey, l_linenumber, round(grams / density, 6) AS ml, round(grams / 44.0::DOUBLE, 6) AS pieces FROM g"),
    "ratio_diff": _w(_D, "SELECT col_idx, ingredient, round(difference, 6) AS difference, round(change, 6) AS change FROM x"),
    "overall_diff": _w(_D, "SELECT round(avg(difference), 6) AS overall FROM x"),
    "diff_ranked": _w(_D, "SELECT col_idx, row_number() OVER (ORDER BY difference DESC, col_idx) AS diff_rank, row_number() OVER (ORDER BY abs(change) DESC, col_idx) AS change_rank FROM x"),
    "format_ratio": _w(_R, "SELECT string_agg(format('{:.2f}', value), ':' ORDER BY col_idx) || ' (' || string_agg(ingredient, ':' ORDER BY col_idx) || ')' AS ratio_text FROM r"),
    "recipe_lines": _w(_R, "SELECT format('{:.1f}g, {:.1f}ml or {:.1f} {}(s) where each {} is 44.0g', g, g, g / 44.0::DOUBLE, ingredient, ingredient) AS line FROM (SELECT ingredient, value * (500.0::DOUBLE / sum(value) OVER ()) AS g FROM r)"),
    "interval_lines": _w(
        _A,
        f"""SELECT format('The {{}} proportion is between {{:.3f}}% and {{:.3f}}% (the interval is {{:.0f}}% of the mean proportion: {{:.3f}}%)', ingredient, p - ci_half, p + ci_half, abs(ci_half / p) * 100, p) AS line FROM (SELECT *, mean * 100 / sum(mean) OVER () AS p FROM a)
UNION ALL SELECT format('Minimum sample size for {{}} proportion: {{}}', ingredient, {_MIN}) FROM a""",
    ),
    "diff_lines": _w(
        _D,
        """SELECT format('Percentage difference between {} proportions {:.3f}%', ingredient, difference * 100) AS line FROM x
UNION ALL SELECT format('The {} proportion has {} by {:.3f}% from data set 1 to 2', ingredient, CASE WHEN change < 0 THEN 'decreased' ELSE 'increased' END, abs(change) * 100) FROM x
UNION ALL SELECT format('Overall percentage difference = {:.3f}%', avg(difference) * 100) FROM x""",
    ),
    "union_files": r"""
WITH u AS (SELECT 0 AS file_idx, recipe_id, regexp_replace(coalesce(butter, ''), '^\s+|\s+$', '', 'g') AS c FROM crumble UNION ALL SELECT 1, recipe_id, regexp_replace(coalesce(butter, ''), '^\s+|\s+$', '', 'g') FROM swedish_recipe_pannkisar),
v AS (SELECT *, regexp_extract(c, '^(?:([0-9]+|[0-9]*\.[0-9]+) *([a-zA-Z][a-zA-Z ]*)|(0))', 1) AS v, regexp_extract(c, '^(?:([0-9]+|[0-9]*\.[0-9]+) *([a-zA-Z][a-zA-Z ]*)|(0))', 2) AS w FROM u WHERE regexp_matches(c, '^(?:([0-9]+|[0-9]*\.[0-9]+) *([a-zA-Z][a-zA-Z ]*)|(0))'))
SELECT file_idx, recipe_id, CASE WHEN v = '' THEN 0.0::DOUBLE ELSE CAST(v AS DOUBLE) END AS value, CASE WHEN v = '' THEN 'gram' ELSE lower(trim(w)) END AS unit FROM v""",
    "table_counts": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in ("food", "synonym", "density", "portion")),
    "density_pick": f"SELECT food_id, g_per_ml, source FROM (SELECT *, row_number() OVER (PARTITION BY food_id ORDER BY {_RANK}, id) AS k FROM density WHERE food_id IS NOT NULL AND NOT isnan(g_per_ml)) WHERE k = 1",
    "density_alternatives": f"SELECT food_id, count(*) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY {_RANK}, id) AS ids FROM density WHERE food_id IS NOT NULL GROUP BY food_id",
    "density_derived": f"""
WITH r AS (SELECT food_id, id, gram_weight, {_U} AS u FROM portion WHERE food_id IS NOT NULL AND gram_weight > 0),
k AS (SELECT *, CASE WHEN u = 'cup' THEN 0 WHEN u LIKE '%cup%' AND u LIKE '%fluid%' THEN 1 WHEN u LIKE '%cup%' AND u NOT LIKE '%whip%' THEN 2 WHEN u LIKE '%cup%' THEN 3
  WHEN u IN ('tbsp', 'tablespoon') THEN 4 WHEN regexp_matches(u, '^tsp\\b') THEN 5 WHEN u IN ('fl oz', 'fluid ounce') THEN 6 END AS tier FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY food_id ORDER BY tier, id) AS n FROM k WHERE tier IS NOT NULL)
SELECT food_id, round(gram_weight / CASE WHEN tier <= 3 THEN 236.588::DOUBLE WHEN tier = 4 THEN 14.787::DOUBLE WHEN tier = 5 THEN 4.929::DOUBLE ELSE 29.5735::DOUBLE END, 6) AS g_per_ml FROM b WHERE n = 1""".replace("\\\\b", "\\b"),
    "food_ids": "SELECT DISTINCT food_id FROM portion",
    "portion_filter": f"SELECT id, unit_name FROM portion WHERE NOT regexp_matches({_U}, '{_MEASURE_NAMES}')",
    "portion_per_unit": f"SELECT id, {_STRIP.format('unit_name')} AS unit_name, round(gram_weight / length({_STRIP.format('unit_name')}), 4) AS gram_weight FROM portion WHERE {_STRIP.format('unit_name')} <> '' AND gram_weight > 0",
    "portion_pieces": f"SELECT food_id, {_U} AS size, max_by(gram_weight, id) AS grams FROM portion WHERE food_id IS NOT NULL AND gram_weight IS NOT NULL AND NOT regexp_matches({_U}, '{_MEASURE_NAMES}') GROUP BY ALL",
    "default_piece": f"SELECT food_id, max_by(gram_weight, id) AS grams FROM portion WHERE food_id IS NOT NULL AND {_U} = 'medium' GROUP BY ALL",
    "synonym_lookup": f"SELECT DISTINCT a.name, s.food_id FROM food a JOIN synonym s ON lower({_STRIP.format('a.name')}) = lower(s.name) JOIN food f ON f.id = s.food_id",
    "left_density_lookup": f"""
WITH p AS (SELECT food_id, g_per_ml FROM (SELECT *, row_number() OVER (PARTITION BY food_id ORDER BY {_RANK}, id) AS k FROM density WHERE food_id IS NOT NULL AND source IS NOT NULL AND NOT isnan(g_per_ml)) WHERE k = 1)
SELECT DISTINCT a.name, s.food_id, p.g_per_ml FROM food a JOIN synonym s ON lower({_STRIP.format('a.name')}) = lower(s.name) JOIN food f ON f.id = s.food_id LEFT JOIN p ON p.food_id = s.food_id""",
    "unmatched_aliases": f"SELECT id, name FROM synonym WHERE name IS NOT NULL AND lower({_STRIP.format('name')}) NOT IN (SELECT lower({_STRIP.format('name')}) FROM food)",
    "first_writer_synonym": "SELECT id, food_id, name FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY id) AS k FROM synonym WHERE name IS NOT NULL) WHERE k = 1",
    "suggest_names": "SELECT name FROM (SELECT name FROM food UNION SELECT name FROM synonym) WHERE name ILIKE '%flour%' AND name ILIKE '%chest%' ORDER BY length(name), name LIMIT 5",
    "short_names": "WITH n AS (SELECT DISTINCT s.food_id, lower(s.name) AS n FROM synonym s JOIN food f ON f.id = s.food_id WHERE s.name IS NOT NULL AND lower(s.name) <> lower(f.name)) SELECT food_id, count(*) AS n, CASE WHEN bool_or(n = 'cornstarch') THEN 'cornstarch' ELSE min(n) END AS first_name FROM n GROUP BY food_id",
    "upsert_measured": "WITH f AS (SELECT lower(name) AS k, min(id) AS food_id FROM food GROUP BY 1) SELECT s.id, f.food_id FROM synonym s LEFT JOIN f ON lower(s.name) = f.k WHERE s.name IS NOT NULL AND s.food_id IS NULL",
    "catalog_rows": _w(_R, f"SELECT col_idx, round(value, 4) AS ratio, round(mean / 100, 4) AS proportion, round(std / 100, 4) AS std_deviation, round(greatest(0, mean - ci_half) / 100, 4) AS ci_lower, round((mean + ci_half) / 100, 4) AS ci_upper, {_MIN} AS min_sample_size FROM r"),
    "catalog_document": _w(
        _AK,
        f"""SELECT l_linestatus, 'standard' AS base_ingredient, n AS sample_size, col_idx AS pos, ingredient AS name, round(mean / first_value(mean) OVER (PARTITION BY l_linestatus ORDER BY col_idx), 4) AS ratio, round(mean / 100, 4) AS proportion,
  round(std / 100, 4) AS std_deviation, round(greatest(0, mean - ci_half) / 100, 4) AS ci_lower, round((mean + ci_half) / 100, 4) AS ci_upper, {_MIN} AS min_sample_size,
  CASE WHEN col_idx % 2 = 1 THEN round(0.9::DOUBLE + col_idx / 8.0::DOUBLE, 4) END AS density_g_per_ml, CASE WHEN col_idx < 3 THEN 44.0::DOUBLE END AS whole_unit_grams FROM a""",
    ),
    "catalog_violations": """
WITH i AS (SELECT record_id, unnest(ingredients) AS x FROM curated_recipes), s AS (SELECT record_id, unnest(sources) AS x FROM curated_recipes)
SELECT record_id, 'slug' AS rule FROM curated_recipes WHERE NOT coalesce(regexp_full_match(id, '[a-z0-9]+(-[a-z0-9]+)*'), false)
UNION ALL SELECT record_id, 'title' FROM curated_recipes WHERE title IS NULL
UNION ALL SELECT record_id, 'category' FROM curated_recipes WHERE category IS NULL
UNION ALL SELECT record_id, 'base_ingredient' FROM curated_recipes WHERE base_ingredient IS NULL
UNION ALL SELECT DISTINCT record_id, 'required' FROM i WHERE x IS NULL OR x.name IS NULL OR x.ratio IS NULL OR x.proportion IS NULL OR x.std_deviation IS NULL OR x.ci_lower IS NULL OR x.ci_upper IS NULL
UNION ALL SELECT DISTINCT record_id, 'std_deviation' FROM i WHERE x.std_deviation < 0
UNION ALL SELECT DISTINCT record_id, 'min_sample_size' FROM i WHERE x.min_sample_size < 0
UNION ALL SELECT DISTINCT record_id, 'source_ref' FROM s WHERE x.ref IS NULL
UNION ALL SELECT record_id, 'sample_size' FROM curated_recipes WHERE NOT coalesce(sample_size >= 1, false)
UNION ALL SELECT record_id, 'ingredients' FROM curated_recipes WHERE coalesce(len(ingredients), 0) < 1
UNION ALL SELECT DISTINCT record_id, 'ratio' FROM i WHERE x.ratio < 0
UNION ALL SELECT DISTINCT record_id, 'proportion' FROM i WHERE x.proportion < 0 OR x.proportion > 1
UNION ALL SELECT DISTINCT record_id, 'interval' FROM i WHERE x.ci_lower < 0 OR x.ci_upper < 0
UNION ALL SELECT DISTINCT record_id, 'whole_unit' FROM i WHERE x.whole_unit IS NOT NULL AND (x.whole_unit.name IS NULL OR NOT coalesce(x.whole_unit.grams > 0, false))
UNION ALL SELECT DISTINCT record_id, 'source_type' FROM s WHERE x.type IS NULL OR x.type NOT IN ('url', 'book', 'text')""",
    "header_columns": f"""
WITH h AS (SELECT file_name, min_by(raw_line, line_id) AS head FROM measure_lines WHERE line_nr = 1 GROUP BY 1),
u AS (SELECT file_name, unnest(string_split(head, ',')) AS name, generate_subscripts(string_split(head, ','), 1) - 1 AS col_idx FROM h)
SELECT file_name, CAST(col_idx AS INT) AS col_idx, lower({_STRIP.format("replace(name, '" + chr(34) + "', '')")}) AS ingredient FROM u""",
    "arity_faults": f"""
WITH h AS (SELECT file_name, len(string_split(min_by(raw_line, line_id), ',')) AS expected FROM measure_lines WHERE line_nr = 1 GROUP BY 1)
SELECT line_id, 'The row on line ' || line_nr || ' has ' || len(string_split(raw_line, ',')) || ' columns where ' || expected || ' were expected' AS message FROM measure_lines JOIN h USING (file_name) WHERE line_nr > 1 AND {_STRIP.format("raw_line")} <> '' AND len(string_split(raw_line, ',')) <> expected""",
    "row_sums": _w(_F, f"SELECT l_orderkey, round({_SUM}, 6) AS total FROM f"),
    "interval_percent_of_mean": _w(_A, "SELECT col_idx, round(ci_half / mean * 100, 6) AS percent FROM a"),
    "total_weight": _w(_R, "SELECT round(sum(value) * 120, 6) AS total FROM r"),
    "restriction_ceiling": _w(_R, "SELECT round(least((SELECT 60.0::DOUBLE / value FROM r WHERE ingredient = 'standard'), (SELECT 90.0::DOUBLE / value FROM r WHERE ingredient = 'promo')), 6) AS scale"),
    "measured_densities": f"SELECT id, coalesce(g_per_ml, TRY_CAST(notes AS DOUBLE)) AS g_per_ml, CASE WHEN {_STRIP.format('source')} <> '' THEN 'fao/' || {_STRIP.format('source')} ELSE 'fao' END AS source FROM density WHERE (g_per_ml IS NULL OR NOT isnan(g_per_ml)) AND coalesce(g_per_ml, TRY_CAST(notes AS DOUBLE)) > 0",
    "registry_portions": _w(_REG, "SELECT row_number() OVER (ORDER BY pos) AS id, food_id, unit_name, gram_weight, 'fdc' AS source FROM rp"),
    "registry_densities": _w(
        _REG,
        f"""SELECT id, food_id, g_per_ml, source FROM (
  SELECT row_number() OVER (ORDER BY pos) AS id, food_id, round(gram_weight / CASE WHEN tier <= 3 THEN 236.588::DOUBLE WHEN tier = 4 THEN 14.787::DOUBLE WHEN tier = 5 THEN 4.929::DOUBLE ELSE 29.5735::DOUBLE END, 6) AS g_per_ml, 'fdc_derived' AS source FROM rb
  UNION ALL SELECT (SELECT count(*) FROM rb) + k, (SELECT count(*) FROM rf) + k, d, 'supplementary' FROM rs
  UNION ALL SELECT (SELECT count(*) + 8 FROM rb) + row_number() OVER (ORDER BY pos), food_id, round(g_per_ml, 6), source FROM rm)""",
    ),
    "portions_of_foods": "SELECT p.id, f.fdc_id, p.unit_name FROM portion p JOIN food f ON f.id = p.food_id WHERE f.fdc_id IS NOT NULL",
    "portions_without_food": "SELECT id FROM portion p WHERE NOT EXISTS (SELECT 1 FROM food f WHERE f.id = p.food_id)",
    "density_or_default": f"""
WITH p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY food_id ORDER BY {_RANK}, id) AS k FROM density WHERE food_id IS NOT NULL AND source = 'bench_test' AND NOT isnan(g_per_ml)) WHERE k = 1)
SELECT f.id AS food_id, coalesce(p.g_per_ml, 1.0::DOUBLE) AS g_per_ml, coalesce(p.source, 'default') AS source FROM food f LEFT JOIN p ON p.food_id = f.id""",
    "catalog_json": "SELECT record_id, id, coalesce(len(ingredients), 0) AS n FROM curated_recipes",
}
