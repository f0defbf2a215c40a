"""The engine's operators over the warehouse tables, each with its SQL.

A recipe is an order, an ingredient the type of a part, a measure the quantity
with a unit by line number, a density follows from the size of the part. The
registry's operators run over the tables food, synonym, density and portion, the
catalog's over curated_recipes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramsmith.functions import measures
from gramsmith.operators import catalog, compose, ratio, stats
from gramsmith.session import broadcast_if_small, spread, table
from gramsmith.plans import report
from gramsmith.sources import recipes, registry
from gramsmith.sources.recipes import Frame
from gramsmith.sources.registry import Ingredient

TYPES = ["STANDARD", "ECONOMY", "MEDIUM", "PROMO", "LARGE", "SMALL"]
UNITS = ["g", " dl", "cups", " tbsp", "oz", " large", "hg"]
PIECE = 50.0
INGREDIENTS = tuple(Ingredient(t.lower(), k, pieces={"medium": 44.0, "large": PIECE}) for k, t in enumerate(TYPES))


def _text() -> Column:
    """The measure of a line; null where the line number, or none, has no unit.

    As in the SQL, amounts are rounded to whole ones, halves to the even one.
    element_at fails beyond the list and takes the last unit for a null.
    """
    unit = F.try_element_at(F.array(*map(F.lit, UNITS)), F.nullif(F.col("l_linenumber"), F.lit(0)))
    return F.concat(F.rint("l_quantity").cast("int").cast("string"), unit)


def _measures(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """Lines with their parsed measure as p."""
    lines = spread(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", *more), "l_orderkey")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", *more, measures.parse(_text()).alias("p"))


def _grams(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """Lines with grams by the density of their part, which is a column here.

    As in the SQL, the value multiplies the weight of one unit: the order of the
    factors decides to which side half a milligram is rounded.
    """
    part = table(spark, d, "part").select("p_partkey", "p_type", (F.lit(0.5) + F.col("p_size") / 100).alias("density"))
    grams = F.col("p.value") * measures.to_grams(F.lit(1.0), F.col("p.key"), F.col("density"), {"large": PIECE})
    return _measures(spark, d, *more).join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_type", *more, grams.alias("grams"), F.col("density"))


def _total(n: Column) -> Column:
    """The sum of a bigint as a double, 0 of no rows; in halves, as it may exceed a bigint, where the SQL sums hugeints."""
    high, low = F.sum(F.shiftright(n, 32)), F.sum(n.bitwiseAND(F.lit(0xFFFFFFFF)))
    size = F.lit(1 << 32)
    return F.when(high.isNull(), 0.0).when(F.abs(high) < 1 << 30, (high * size + low).cast("double")).otherwise((high.cast("decimal(20,0)") * size + low).cast("double"))


def _frame(spark: SparkSession, d: str, *keys: str) -> Frame:
    """A row for each order (and keys), a column for each type; sums are of whole milligrams, so that they are exact."""
    exact = F.col("grams") * 1000 + 0.5
    # floor gives the largest bigint for all beyond it; the cast fails, as the SQL's does.
    mg = F.when(F.abs(exact) < 2.0**63, F.floor(exact)).otherwise(exact.cast("bigint"))
    cells = [(_total(F.when(F.col("p_type") == t, mg)) / F.lit(1000.0)).alias(f"c{k}") for k, t in enumerate(TYPES)]
    return Frame(_grams(spark, d, *keys).groupBy("l_orderkey", *keys).agg(*cells), INGREDIENTS)


def _r(c: Column | str, n: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def _shares(spark: SparkSession, d: str, *keys: str) -> DataFrame:
    """Long rows of normalised compositions."""
    return compose.normalize(_frame(spark, d, *keys)).to_long("l_orderkey", *keys)


def _stats(spark: SparkSession, d: str, *keys: str) -> DataFrame:
    return stats.long_stats(_shares(spark, d, *keys), *keys, "col_idx", "ingredient")


def parse_measures(spark: SparkSession, d: str) -> DataFrame:
    return _measures(spark, d).select("l_orderkey", "l_linenumber", F.col("p.value").alias("value"), F.col("p.key").alias("unit"))


def unit_to_grams(spark: SparkSession, d: str) -> DataFrame:
    return _grams(spark, d).select("l_orderkey", "l_linenumber", "p_type", _r("grams").alias("grams"))


def whole_unit_lookup(spark: SparkSession, d: str) -> DataFrame:
    sizes = _measures(spark, d).select("l_orderkey", "l_linenumber", measures.size(F.col("p.key")).alias("size"), F.col("p.value").alias("value"))
    return sizes.filter("size IS NOT NULL").withColumn("grams", F.col("value") * PIECE)


def normalize_100(spark: SparkSession, d: str) -> DataFrame:
    return _shares(spark, d).select("l_orderkey", "col_idx", _r("value").alias("share"))


def wide_pivot(spark: SparkSession, d: str) -> DataFrame:
    return _frame(spark, d).df


def to_long(spark: SparkSession, d: str) -> DataFrame:
    return _frame(spark, d).to_long("l_orderkey")


def distinct_compositions(spark: SparkSession, d: str) -> DataFrame:
    return compose.distinct(_frame(spark, d)).df


def _merged(spark: SparkSession, d: str, spec: str) -> DataFrame:
    """Merged columns; rounded as in the SQL, by a product with 10^6, which above 2^53 millionths isn't exact."""
    f = compose.merge(_frame(spark, d), compose.parse_merge(spec))
    return f.df.select("l_orderkey", *[(F.round(F.col(c) * 1e6) / 1e6).alias(c) for c in f.columns])


def merge_full(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d, "economy+medium:standard+small")


def merge_partial(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d, "1+0.25:2.50+5")


def column_stats(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).select("col_idx", "ingredient", "n", _r("mean").alias("mean"), _r("std").alias("std"))


def ci_bounds(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).select("col_idx", _r(F.col("mean") - F.col("ci_half")).alias("ci_low"), _r(F.col("mean") + F.col("ci_half")).alias("ci_high"))


def min_sample_size(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).select("col_idx", "min_n")


def sample_size(spark: SparkSession, d: str) -> DataFrame:
    return compose.distinct(_frame(spark, d)).df.agg(F.count(F.lit(1)).alias("sample_size"))


def bakers_percentage(spark: SparkSession, d: str) -> DataFrame:
    return stats.bakers_percentage(_stats(spark, d), "col_idx").select("col_idx", _r("ratio").alias("ratio"))


def proportions(spark: SparkSession, d: str) -> DataFrame:
    return stats.proportions(_stats(spark, d)).select("col_idx", _r("proportion").alias("proportion"))


def stats_by_status(spark: SparkSession, d: str) -> DataFrame:
    """Several data sets in one job: statistics by line status."""
    return _stats(spark, d, "l_linestatus").select("l_linestatus", "col_idx", "n", _r("mean").alias("mean"), _r("ci_half").alias("ci_half"), "min_n")


def zero_filtered_means(spark: SparkSession, d: str) -> DataFrame:
    f = compose.normalize(_frame(spark, d))
    return f.to_long().groupBy("col_idx").agg(_r(F.avg(F.when(F.col("value") != 0, F.col("value")))).alias("mean"))


def zero_imputed_stats(spark: SparkSession, d: str) -> DataFrame:
    f = compose.normalize(compose.impute_zeros(_frame(spark, d), ["medium", 5]))
    return f.to_long().groupBy("col_idx").agg(_r(F.avg("value")).alias("mean"), _r(F.stddev_pop("value")).alias("std"))


def _ratio(spark: SparkSession, d: str) -> DataFrame:
    return stats.bakers_percentage(_stats(spark, d), "col_idx").select("col_idx", "ingredient", F.col("ratio").alias("value"))


def recipe_scaled(spark: SparkSession, d: str) -> DataFrame:
    return ratio.scaled(_ratio(spark, d), 500, None).select("col_idx", _r("grams").alias("grams"))


def recipe_restricted(spark: SparkSession, d: str) -> DataFrame:
    limits = spark.createDataFrame([("standard", 60.0), ("promo", 90.0)], "name string, grams double")
    return ratio.scaled(_ratio(spark, d), 500, limits).select("col_idx", _r("grams").alias("grams"))


def as_percentages(spark: SparkSession, d: str) -> DataFrame:
    return ratio.as_percentages(_ratio(spark, d)).select("col_idx", _r("percentage").alias("percentage"))


def _collected(spark: SparkSession, d: str) -> ratio.Ratio:
    """The ratio on the driver, where reports are made: a number for each column."""
    parts = {r["col_idx"]: r["value"] for r in _ratio(spark, d).collect()}
    return ratio.Ratio(INGREDIENTS, [parts[k] for k in range(len(INGREDIENTS))])


def ingredient_values(spark: SparkSession, d: str) -> DataFrame:
    """Columns by name and by place."""
    r = _collected(spark, d)
    rows = [(i.name, round(v, 6)) for column in ("promo", 5) for v, i in r.of(column, 250)]
    return spark.createDataFrame(rows, "ingredient string, grams double")


def grams_to_ml_pieces(spark: SparkSession, d: str) -> DataFrame:
    g = _grams(spark, d)
    return g.select("l_orderkey", "l_linenumber", _r(measures.milliliters(F.col("grams"), F.col("density"))).alias("ml"), _r(measures.pieces_of(F.col("grams"), F.lit(44.0))).alias("pieces"))


def _compared(spark: SparkSession, d: str) -> DataFrame:
    """Both data sets in one pass, one against the other by column."""
    s = stats.proportions(_stats(spark, d, "l_linestatus"), "l_linestatus")
    share = lambda status: F.max(F.when(F.col("l_linestatus") == status, F.col("proportion")))
    return ratio.against(s.groupBy("col_idx", "ingredient").agg(share("F").alias("a"), share("O").alias("b")))


def ratio_diff(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d).select("col_idx", "ingredient", _r("difference").alias("difference"), _r("change").alias("change"))


def overall_diff(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d).agg(_r(F.avg("difference")).alias("overall"))


def diff_ranked(spark: SparkSession, d: str) -> DataFrame:
    return ratio.ranked(_compared(spark, d)).select("col_idx", F.col("diff_rank").cast("bigint").alias("diff_rank"), F.col("change_rank").cast("bigint").alias("change_rank"))


def format_ratio(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(report.ratio_text(_collected(spark, d)),)], "ratio_text string")


def recipe_lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines of a recipe of 500 g."""
    return spark.createDataFrame([(x,) for x in report.recipe_text(_collected(spark, d), 500, 1)[1].splitlines()], "line string")


def _statistics(rows: list) -> stats.Statistics:
    rows = sorted(rows, key=lambda r: r["col_idx"])
    return stats.Statistics(INGREDIENTS, rows[0]["n"], [r["mean"] for r in rows], [r["std"] for r in rows], [r["ci_half"] for r in rows])


def interval_lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines of a verbose report on intervals and sample sizes."""
    r = report.stats_report(_statistics(_stats(spark, d).collect()), verbose=True, digits=3)
    return spark.createDataFrame([(x,) for x in r.lines if x.startswith(("The ", "Minimum sample size for"))], "line string")


def diff_lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines of a report on two data sets, in both forms."""
    rows = _stats(spark, d, "l_linestatus").collect()
    f, o = (_statistics([r for r in rows if r["l_linestatus"] == s]) for s in "FO")
    lines = [x for change in (False, True) for x in report.diff_report(f, o, change, 3).lines if x.startswith(("The ", "Percentage", "Overall"))]
    return spark.createDataFrame([(x,) for x in lines], "line string").distinct()


def union_files(spark: SparkSession, d: str) -> DataFrame:
    cells = ["flour", "butter"]
    a = table(spark, d, "crumble").select("recipe_id", *cells, F.lit(0).alias("file_idx"))
    b = table(spark, d, "swedish_recipe_pannkisar").select("recipe_id", *cells, F.lit(1).alias("file_idx"))
    u = a.unionByName(b).select("file_idx", "recipe_id", recipes.measure_of(F.coalesce("butter", F.lit(""))).alias("p"))
    return u.filter("p.matched").select("file_idx", "recipe_id", F.col("p.value").alias("value"), F.col("p.key").alias("unit"))


def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).counts()


def _tables(spark: SparkSession, d: str) -> registry.Tables:
    return registry.Tables(*(table(spark, d, n) for n in ("food", "synonym", "density", "portion")))


def density_pick(spark: SparkSession, d: str) -> DataFrame:
    return registry.picked_density(table(spark, d, "density").filter("food_id IS NOT NULL"))


def density_alternatives(spark: SparkSession, d: str) -> DataFrame:
    """The number of alternatives, and their ids in order of preference as a text."""
    rows = registry.density_alternatives(table(spark, d, "density").filter("food_id IS NOT NULL"))
    return rows.select("food_id", F.size("alternatives").cast("bigint").alias("n"), F.array_join(F.transform("alternatives", lambda a: a["id"].cast("string")), ",").alias("ids"))


def density_derived(spark: SparkSession, d: str) -> DataFrame:
    return registry.derived_density(table(spark, d, "portion").filter("food_id IS NOT NULL"))


def food_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "portion").select("food_id").distinct()


def portion_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "portion").filter(measures.is_whole_unit(F.col("unit_name"))).select("id", "unit_name")


def portion_per_unit(spark: SparkSession, d: str) -> DataFrame:
    """Portions of several pieces, by piece: the amount is the length of the name."""
    raw = table(spark, d, "portion").select(F.col("id").alias("fdc_id"), F.col("unit_name").alias("modifier"), F.length(measures.strip(F.col("unit_name"))).cast("string").alias("amount"), F.col("gram_weight").cast("string").alias("gram_weight"))
    return registry.valid_portions(raw).select(F.col("fdc_id").alias("id"), "unit_name", "gram_weight")


def portion_pieces(spark: SparkSession, d: str) -> DataFrame:
    return registry.pieces(table(spark, d, "portion").filter("food_id IS NOT NULL"))


def default_piece(spark: SparkSession, d: str) -> DataFrame:
    return registry.pieces(table(spark, d, "portion").filter("food_id IS NOT NULL")).filter("size = 'medium'").select("food_id", "grams")


def synonym_lookup(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "food").select("name")
    t = _tables(spark, d)
    return registry.by_synonym(names, t.synonym.filter("food_id IS NOT NULL"), t.food).select("name", "food_id").distinct()


def left_density_lookup(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    names = t.food.select("name")
    density = t.density.filter("food_id IS NOT NULL AND source IS NOT NULL")
    return registry.with_density(names, t.synonym.filter("food_id IS NOT NULL"), t.food, density).select("name", "food_id", "g_per_ml").distinct()


def unmatched_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Typed names that are the name of no food, case and outer blanks apart."""
    t = _tables(spark, d)
    key = F.lower(measures.strip(F.col("name")))
    aliases = t.synonym.filter("name IS NOT NULL").select("id", "name", key.alias("description"))
    return registry.aliases_to_foods(aliases, t.food.select("id", key.alias("name"), F.lit("fdc").alias("source")))[1].select("id", "name")


def _built(spark: SparkSession, d: str) -> registry.Tables:
    """The registry built from the tables, their ids being the order of loading."""
    t = _tables(spark, d)
    foods = t.food.filter("name IS NOT NULL").select(F.col("id").alias("fdc_id"), "name", F.col("id").alias("row"))
    portions = t.portion.select(F.col("food_id").cast("string").alias("fdc_id"), F.col("unit_name").alias("modifier"), F.lit("1").alias("amount"), F.col("gram_weight").cast("string").alias("gram_weight"), F.col("id").alias("row"))
    measured = table(spark, d, "density").filter("NOT isnan(g_per_ml)").select(F.col("sample_code").alias("name"), F.col("g_per_ml").cast("string").alias("density"), F.lit(None).cast("string").alias("specific_gravity"), "source", F.col("id").alias("row"))
    return registry.build(spark, foods, portions, measured)


def registry_portions(spark: SparkSession, d: str) -> DataFrame:
    return _built(spark, d).portion.select("id", "food_id", "unit_name", "gram_weight", "source")


def registry_densities(spark: SparkSession, d: str) -> DataFrame:
    return _built(spark, d).density.select("id", "food_id", "g_per_ml", "source")


def first_writer_synonym(spark: SparkSession, d: str) -> DataFrame:
    return registry.first_writers(table(spark, d, "synonym").filter("name IS NOT NULL"), "id").select("id", "food_id", "name")


def suggest_names(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    return registry.suggest(t.food, t.synonym, "flour chest", 5)


def short_names(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    rows = registry.short_names(t.food, t.synonym.filter("name IS NOT NULL"), "cornstarch")
    return rows.select("food_id", F.size("names").cast("bigint").alias("n"), F.element_at("names", 1).alias("first_name"))


def upsert_measured(spark: SparkSession, d: str) -> DataFrame:
    """Names typed for measured foods: known ones with their food, new ones with null."""
    t = _tables(spark, d)
    measured = t.synonym.filter("name IS NOT NULL AND food_id IS NULL").select("id", "name")
    known, new = registry.upsert_measured(measured, t.food)
    return known.select("id", "food_id").unionByName(new.select("id", F.lit(None).cast("bigint").alias("food_id")))


def catalog_rows(spark: SparkSession, d: str) -> DataFrame:
    s = stats.bakers_percentage(_stats(spark, d), "col_idx")
    return catalog.catalog_rows(s.select("col_idx", "ratio", "mean", "std", "ci_half", "min_n"))


def catalog_document(spark: SparkSession, d: str) -> DataFrame:
    """A recipe for each line status, nested, to JSON and back: its ingredients with densities and whole units."""
    s = stats.bakers_percentage(_stats(spark, d, "l_linestatus"), "col_idx", "l_linestatus")
    units = spark.createDataFrame([(i.name, 0.9 + k / 8 if k % 2 else None, i.default_piece if k < 3 else None) for k, i in enumerate(INGREDIENTS)], "ingredient string, density double, piece double")
    docs = catalog.documents(catalog.with_units(catalog.catalog_rows(s), units), "l_linestatus")
    back = docs.select("l_linestatus", F.from_json(F.to_json(F.struct(*[c for c in docs.columns if c != "l_linestatus"])), catalog.RECIPE_TYPE).alias("r"))
    flat = back.select("l_linestatus", "r.base_ingredient", "r.sample_size", F.posexplode("r.ingredients").alias("pos", "i"))
    return flat.select("l_linestatus", "base_ingredient", "sample_size", "pos", *[f"i.{c}" for c in (*catalog.REQUIRED, "min_sample_size", "density_g_per_ml")], F.col("i.whole_unit.grams").alias("whole_unit_grams"))


def catalog_violations(spark: SparkSession, d: str) -> DataFrame:
    return catalog.violations(table(spark, d, "curated_recipes"))


def catalog_json(spark: SparkSession, d: str) -> DataFrame:
    """Records to JSON and back: the number of ingredients that survive."""
    docs = catalog.to_json(table(spark, d, "curated_recipes").select("record_id", "id", "title", "ingredients"))
    back = F.from_json("json", "record_id bigint, id string, title string, ingredients array<struct<name:string,ratio:double,proportion:double>>")
    return docs.select(back.alias("r")).select("r.record_id", "r.id", F.coalesce(F.size("r.ingredients"), F.lit(0)).cast("bigint").alias("n"))


def _headers(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "measure_lines").filter("line_nr = 1")
    return lines.groupBy("file_name").agg(F.min_by("raw_line", "line_id").alias("head"))


def header_columns(spark: SparkSession, d: str) -> DataFrame:
    """Ingredients of each file's header by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(f, k, n) for f, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if line is not None for k, n in enumerate(recipes.header_names(line))]
            yield pa.RecordBatch.from_pylist([dict(zip(("file_name", "col_idx", "ingredient"), r, strict=True)) for r in rows], schema=pa.schema([("file_name", pa.string()), ("col_idx", pa.int32()), ("ingredient", pa.string())]))

    return _headers(spark, d).select("file_name", "head").mapInArrow(run, "file_name string, col_idx int, ingredient string")


def arity_faults(spark: SparkSession, d: str) -> DataFrame:
    """Lines whose plain commas give another number of cells than the header's, with the message."""
    heads = _headers(spark, d).select("file_name", F.size(recipes.cells(F.col("head"))).alias("expected"))
    rows = table(spark, d, "measure_lines").filter("line_nr > 1").filter(measures.strip(F.col("raw_line")) != "")
    message = recipes.arity_fault(F.size(recipes.cells(F.col("raw_line"))), F.col("expected"), F.col("line_nr"))
    return rows.join(heads, "file_name").select("line_id", message.alias("message")).filter("message IS NOT NULL")


def row_sums(spark: SparkSession, d: str) -> DataFrame:
    f = _frame(spark, d)
    return f.df.select("l_orderkey", _r(compose.row_sum(f.columns)).alias("total"))


def interval_percent_of_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = [(r["col_idx"], round(report.interval_percent(r["mean"], r["ci_half"]), 6)) for r in _stats(spark, d).collect()]
    return spark.createDataFrame(rows, "col_idx int, percent double")


def total_weight(spark: SparkSession, d: str) -> DataFrame:
    return _ratio(spark, d).agg(_r(F.sum("value") * 120).alias("total"))


def restriction_ceiling(spark: SparkSession, d: str) -> DataFrame:
    """The scale that the tightest of two limits allows."""
    r = _collected(spark, d).restricted(compose.parse_restrictions("standard=60,3=90"))
    return spark.createDataFrame([(round(r.scale(float("inf")), 6),)], "scale double")


def measured_densities(spark: SparkSession, d: str) -> DataFrame:
    """A density, else the gravity, above 0; here the gravity is what notes say as a number."""
    raw = table(spark, d, "density").select(F.col("id").cast("string").alias("name"), F.col("g_per_ml").cast("string").alias("density"), F.col("notes").alias("specific_gravity"), "source").filter("density IS NULL OR density <> 'NaN'")
    return registry.usable_densities(raw).select(F.col("name").cast("bigint").alias("id"), "g_per_ml", "source")


def portions_of_foods(spark: SparkSession, d: str) -> DataFrame:
    """Portions of foods with an fdc_id; others don't join."""
    food = table(spark, d, "food").filter("fdc_id IS NOT NULL").select(F.col("id").alias("food_id"), "fdc_id")
    portions = table(spark, d, "portion").select("id", "food_id", "unit_name").join(broadcast_if_small(food), "food_id").drop("food_id")
    return registry.portions_of_foods(portions, food).select("id", "fdc_id", "unit_name")


def portions_without_food(spark: SparkSession, d: str) -> DataFrame:
    food = table(spark, d, "food").select(F.col("id").alias("food_id"))
    return table(spark, d, "portion").join(food, "food_id", "left_anti").select("id")


def density_or_default(spark: SparkSession, d: str) -> DataFrame:
    """Every food with its density; 1.0 of source default where it has none from a measuring bench."""
    picked = registry.picked_density(table(spark, d, "density").filter("food_id IS NOT NULL AND source = 'bench_test'"))
    food = table(spark, d, "food").select(F.col("id").alias("food_id"))
    return food.join(picked, "food_id", "left").select("food_id", F.coalesce("g_per_ml", F.lit(1.0)).alias("g_per_ml"), F.coalesce("source", F.lit("default")).alias("source"))


QUERIES = {
    f.__name__: f
    for f in (
        parse_measures, unit_to_grams, whole_unit_lookup, normalize_100, wide_pivot, to_long, distinct_compositions, merge_full, merge_partial, column_stats, ci_bounds, min_sample_size, sample_size, bakers_percentage, proportions,
        stats_by_status, zero_filtered_means, zero_imputed_stats, recipe_scaled, recipe_restricted, as_percentages, ingredient_values, grams_to_ml_pieces, ratio_diff, overall_diff, diff_ranked, format_ratio, recipe_lines, interval_lines, diff_lines, union_files, table_counts,
        density_pick, density_alternatives, density_derived, food_ids, portion_filter, portion_per_unit, portion_pieces, default_piece, synonym_lookup, left_density_lookup, unmatched_aliases, registry_portions, registry_densities, first_writer_synonym, suggest_names,
        short_names, upsert_measured, catalog_rows, catalog_document, catalog_violations, catalog_json, header_columns, arity_faults, row_sums, interval_percent_of_mean, total_weight, restriction_ceiling, measured_densities, portions_of_foods,
        portions_without_food, density_or_default,
    )
}


def _oracles() -> dict[str, str]:
    from gramsmith.plans.warehouse_sql import ORACLES

    return ORACLES


ORACLES = _oracles()
