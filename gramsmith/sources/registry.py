"""The registry of foods, synonyms, densities and portions: its build and its lookups.

Everything is a DataFrame until a header is resolved, which needs its ingredients on
the driver: of a small registry all, of a larger one those that the header names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gramsmith.errors import InvalidInput
from gramsmith.functions.measures import is_whole_unit, strip
from gramsmith.session import SMALL_ROWS, broadcast_if_small, cut, free_name, small_rows
from gramsmith.sources import seed

FOOD, SYNONYM = "id bigint, name string, source string, fdc_id bigint", "id bigint, food_id bigint, name string"
DENSITY, PORTION = "id bigint, food_id bigint, g_per_ml double, source string, notes string", "id bigint, food_id bigint, unit_name string, gram_weight double, source string, notes string"


@dataclass(frozen=True)
class Ingredient:
    """What a header's name stands for. Two ingredients are the same if their food is."""

    name: str
    food_id: int
    density: float = 1.0
    density_source: str = "default"
    alternatives: tuple[tuple[float, str], ...] = ()
    pieces: Mapping[str, float] = field(default_factory=dict, hash=False, compare=False)
    synonyms: tuple[str, ...] = ()

    @property
    def default_piece(self) -> float | None:
        return self.pieces.get("medium")

    def called(self, name: str) -> Ingredient:
        return Ingredient(name, self.food_id, self.density, self.density_source, self.alternatives, self.pieces, self.synonyms)

    def __str__(self) -> str:
        return self.name


@dataclass(frozen=True)
class Tables:
    food: DataFrame
    synonym: DataFrame
    density: DataFrame
    portion: DataFrame

    def write(self, path: str) -> None:
        for name in ("food", "synonym", "density", "portion"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}.parquet")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Tables:
        return cls(*(spark.read.parquet(f"{path}/{n}.parquet") for n in ("food", "synonym", "density", "portion")))

    def counts(self) -> DataFrame:
        parts = [getattr(self, n).select(F.lit(n).alias("table_name")).groupBy("table_name").count() for n in ("food", "synonym", "density", "portion")]
        return reduce(DataFrame.unionByName, parts).withColumnRenamed("count", "n_rows")


# ---- Sources ------------------------------------------------------------------------------------


def read_foods(spark: SparkSession, path: str) -> DataFrame:
    """fdc_id, description and row of a CSV with a header."""
    raw = in_file_order(spark.read.csv(path, header=True))
    return raw.select(F.col("fdc_id").try_cast("bigint").alias("fdc_id"), F.col("description").alias("name"), "row").filter("fdc_id IS NOT NULL AND name IS NOT NULL")


def read_portions(spark: SparkSession, path: str) -> DataFrame:
    """fdc_id, modifier, amount and gram_weight of a CSV with a header, as text, and row."""
    return in_file_order(spark.read.csv(path, header=True)).select("fdc_id", "modifier", "amount", "gram_weight", "row")


def read_measured(spark: SparkSession, path: str) -> DataFrame:
    """name, density, specific_gravity and source of a sheet of measured densities, saved as CSV."""
    return in_file_order(spark.read.csv(path, header=True)).select("name", "density", "specific_gravity", "source", "row")


def in_file_order(df: DataFrame) -> DataFrame:
    """Adds row, which sorts the rows of a scan as their files do, whatever splits the scan makes of them."""
    return df.withColumn("row", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("at")))


def numbered(df: DataFrame, start: int, *order: str) -> DataFrame:
    """Adds id, from start + 1 on in an order, without gathering the rows in one task.

    The rows are sorted over ranges and written; the sizes of the ranges, one
    number a task, give where each begins.
    """
    where, at = free_name(df.columns, "range"), free_name(df.columns, "at")
    rows = cut(df.orderBy(*order).withColumn(where, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = {r[where]: r["count"] for r in rows.groupBy(where).count().collect()}
    begin, firsts = start + 1, {}
    for k in sorted(sizes):
        firsts[k], begin = begin, begin + sizes[k]
    first = F.element_at(F.create_map(*[F.lit(x) for kv in (firsts or {-1: 0}).items() for x in kv]), F.col(where))
    return rows.withColumn("id", (first + F.col(at)).cast("bigint")).drop(where, at)


def valid_portions(raw: DataFrame) -> DataFrame:
    """Portions that can be used, per single unit: a name, an amount and a weight above 0."""
    typed = raw.select(F.col("fdc_id").try_cast("bigint").alias("fdc_id"), strip(F.col("modifier")).alias("unit_name"), F.col("amount").try_cast("double").alias("amount"), F.col("gram_weight").try_cast("double").alias("grams"), *_row(raw))
    return typed.filter("unit_name <> '' AND amount > 0 AND grams > 0").select("fdc_id", "unit_name", F.round(F.col("grams") / F.col("amount"), 4).alias("gram_weight"), *_row(raw))


def _row(df: DataFrame) -> list[str]:
    return ["row"] if "row" in df.columns else []


def usable_densities(raw: DataFrame) -> DataFrame:
    """The density, else the specific gravity, of rows where one is a number above 0."""
    value = F.coalesce(F.col("density").try_cast("double"), F.col("specific_gravity").try_cast("double"))
    tag = strip(F.col("source"))
    return raw.select(strip(F.col("name")).alias("name"), value.alias("g_per_ml"), F.when(tag != "", F.concat(F.lit("fao/"), tag)).otherwise(F.lit("fao")).alias("source"), *_row(raw)).filter("name <> '' AND g_per_ml > 0")


# ---- Derivations --------------------------------------------------------------------------------


def derived_density(portion: DataFrame) -> DataFrame:
    """food_id and g_per_ml, from the best portion by volume of a food.

    Cups come first (an exact cup, then a fluid one, then any but whipped, then
    any), then tablespoons, teaspoons and fluid ounces; within a tier the first row.
    """
    u = F.lower(strip(F.col("unit_name")))
    tier = (
        F.when(u == "cup", 0).when(u.contains("cup") & u.contains("fluid"), 1).when(u.contains("cup") & ~u.contains("whip"), 2).when(u.contains("cup"), 3)
        .when(u.isin("tbsp", "tablespoon"), 4).when(u.rlike(r"^tsp\b"), 5).when(u.isin("fl oz", "fluid ounce"), 6)
    )
    ml = F.when(F.col("tier") <= 3, seed.DERIVE_CUP).when(F.col("tier") == 4, seed.DERIVE_TBSP).when(F.col("tier") == 5, seed.DERIVE_TSP).otherwise(seed.DERIVE_FLOZ)
    rows = portion.select("food_id", "id", "gram_weight", tier.alias("tier")).filter("tier IS NOT NULL AND gram_weight > 0")
    best = rows.groupBy("food_id").agg(F.min_by(F.struct("gram_weight", "tier"), F.struct("tier", "id")).alias("b")).select("food_id", "b.*")
    return best.select("food_id", F.round(F.col("gram_weight") / ml, 6).alias("g_per_ml"))


def density_rank(source: Column) -> Column:
    return F.when(source == "fdc_derived", 1).when(source == "supplementary", 2).otherwise(3)


def picked_density(density: DataFrame) -> DataFrame:
    """food_id, g_per_ml, source of the preferred density of each food; rows without a number are none."""
    key = F.struct(density_rank(F.col("source")).alias("rank"), F.col("id").alias("id"))
    return density.filter("g_per_ml IS NOT NULL AND NOT isnan(g_per_ml)").groupBy("food_id").agg(F.min_by(F.struct("g_per_ml", "source"), key).alias("b")).select("food_id", "b.g_per_ml", "b.source")


def density_alternatives(density: DataFrame) -> DataFrame:
    """food_id and all its densities in order of preference."""
    cell = F.struct(density_rank(F.col("source")).alias("rank"), F.col("id").alias("id"), F.col("g_per_ml"), F.col("source"))
    return density.groupBy("food_id").agg(F.sort_array(F.collect_list(cell)).alias("alternatives"))


def pieces(portion: DataFrame) -> DataFrame:
    """food_id, size and grams of whole pieces; of equal sizes the last row with a weight counts."""
    rows = portion.filter(is_whole_unit(F.col("unit_name")) & F.col("gram_weight").isNotNull()).select("food_id", F.lower(strip(F.col("unit_name"))).alias("size"), "gram_weight", "id")
    return rows.groupBy("food_id", "size").agg(F.max_by("gram_weight", "id").alias("grams"))


def short_names(food: DataFrame, synonym: DataFrame, looked_up: str) -> DataFrame:
    """food_id and its names but the food's own, the one looked up first."""
    rows = synonym.join(food.select(F.col("id").alias("food_id"), F.lower("name").alias("own")), "food_id").filter(F.lower("name") != F.col("own"))
    names = rows.groupBy("food_id").agg(F.array_sort(F.collect_set(F.lower("name"))).alias("names"))
    first = F.lit(looked_up.lower())
    return names.select("food_id", F.when(F.array_contains("names", first), F.concat(F.array(first), F.array_remove("names", first))).otherwise(F.col("names")).alias("names"))


# ---- Joins --------------------------------------------------------------------------------------


def by_synonym(names: DataFrame, synonym: DataFrame, food: DataFrame) -> DataFrame:
    """Names (column name) with the food that a synonym gives, case apart."""
    s = synonym.select(F.lower("name").alias("key"), F.col("food_id"))
    f = food.select(F.col("id").alias("food_id"), F.col("name").alias("food_name"))
    return names.withColumn("key", F.lower(strip(F.col("name")))).join(broadcast_if_small(s), "key").join(broadcast_if_small(f), "food_id").select("name", "food_id", "food_name")


def with_density(names: DataFrame, synonym: DataFrame, food: DataFrame, density: DataFrame) -> DataFrame:
    """Names with food and preferred density; names without a density stay."""
    return by_synonym(names, synonym, food).join(broadcast_if_small(picked_density(density).select("food_id", "g_per_ml")), "food_id", "left")


def first_writers(synonyms: DataFrame, order: str = "seq") -> DataFrame:
    """Of synonyms that are equal but for case, the one entered first."""
    return synonyms.withColumn("place", F.row_number().over(Window.partitionBy(F.lower("name")).orderBy(order))).filter("place = 1").drop("place")


def aliases_to_foods(aliases: DataFrame, food: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Aliases (name, description) with their food, and those of which the food is missing."""
    f = food.filter("source = 'fdc'").groupBy(F.col("name").alias("description")).agg(F.min("id").alias("food_id"))
    return aliases.join(f, "description"), aliases.join(f, "description", "left_anti")


def upsert_measured(measured: DataFrame, food: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Measured densities of foods that are known by name, and the names to be added."""
    f = food.groupBy(F.lower("name").alias("key")).agg(F.min("id").alias("food_id"))
    m = measured.withColumn("key", F.lower("name"))
    return m.join(f, "key").drop("key"), m.join(f, "key", "left_anti").drop("key")


def suggest(food: DataFrame, synonym: DataFrame, query: str, limit: int = 5) -> DataFrame:
    """The shortest names that contain every word of a query, by length and name."""
    words = query.lower().split()
    names = food.select("name").union(synonym.select("name")).filter("name IS NOT NULL")
    if not words:
        return names.limit(0)
    all_words = reduce(lambda a, b: a & b, [F.lower("name").contains(w) for w in words])
    return names.filter(all_words).groupBy("name").agg(F.first(F.length("name")).alias("len")).orderBy("len", "name").limit(limit).select("name")


# ---- Build --------------------------------------------------------------------------------------


def portions_of_foods(valid: DataFrame, foods: DataFrame) -> DataFrame:
    """Portions with the food that has their fdc_id; the others don't join."""
    return valid.join(foods, "fdc_id")


def build(spark: SparkSession, foods: DataFrame, portions: DataFrame, measured: DataFrame | None = None) -> Tables:
    """The registry from foods (fdc_id, name), raw portions and measured densities.

    Everything is numbered in the order of loading: foods of the file, then
    supplementary ones, then measured ones that are new; portions of the file, then
    supplementary ones; densities derived from portions, in the order of the first
    portion of a food, then supplementary, then measured ones. A synonym belongs to
    who writes it first: foods, then supplementary synonyms, then aliases, then
    measured foods. Of rows with the same description the first is the food, and
    of rows with the same fdc_id the last one counts. The order is that of row
    where a frame has it, else that of its rows as they come.
    """
    in_order = lambda df: df if "row" in df.columns else df.withColumn("row", F.monotonically_increasing_id())
    none = F.lit(None).cast("string").alias("notes")
    # Foods.
    listed = cut(in_order(foods).select("fdc_id", "name", "row"))
    first = listed.groupBy("name").agg(F.min_by("fdc_id", "row").alias("fdc_id"), F.min("row").alias("row"))
    fdc = numbered(first, 0, "row").select("id", "name", F.lit("fdc").alias("source"), "fdc_id")
    n_fdc, n_sup = fdc.count(), len(seed.SUPPLEMENTARY)
    sup = spark.createDataFrame([(n_fdc + k, n, "supplementary", None) for k, (n, *_) in enumerate(seed.SUPPLEMENTARY, 1)], FOOD)
    known = fdc.unionByName(sup)
    if measured is not None:
        usable = cut(usable_densities(in_order(measured)))
        _, new = upsert_measured(usable, known)
        fresh = new.groupBy(F.lower("name").alias("key")).agg(F.min_by("name", "row").alias("name"), F.min("row").alias("row"))
        fao = numbered(fresh, n_fdc + n_sup, "row").select("id", "name", F.lit("fao").alias("source"), F.lit(None).cast("bigint").alias("fdc_id"))
        known = cut(known.unionByName(fao))
    # Synonyms.
    seq = lambda stage, at: F.struct(F.lit(stage).alias("stage"), F.col(at).cast("bigint").alias("at"))
    sup_names = spark.createDataFrame([(n_fdc + k, s, 100 * k + j) for k, (_, syns, *_) in enumerate(seed.SUPPLEMENTARY, 1) for j, s in enumerate(syns)], "food_id bigint, name string, at bigint")
    aliased, _ = aliases_to_foods(seed_aliases(spark), known)
    parts = [known.filter("source = 'fdc'").select(F.col("id").alias("food_id"), "name", seq(0, "id").alias("seq")), sup_names.select("food_id", "name", seq(1, "at").alias("seq")), aliased.select("food_id", "name", seq(2, "at").alias("seq"))]
    parts.append(known.filter("source = 'fao'").select(F.col("id").alias("food_id"), "name", seq(3, "id").alias("seq")))
    synonym = numbered(first_writers(reduce(DataFrame.unionByName, parts), "seq"), 0, "seq").select("id", "food_id", "name")
    # Portions.
    fdc_ids = listed.join(fdc.select("name", F.col("id").alias("food_id")), "name").groupBy("fdc_id").agg(F.max_by("food_id", "row").alias("food_id"))
    usda = numbered(portions_of_foods(valid_portions(in_order(portions)), fdc_ids), 0, "row").select("id", "food_id", "unit_name", "gram_weight", F.lit("fdc").alias("source"), none)
    n_usda = usda.count()
    own, _ = aliases_to_foods(seed_portions(spark), known)
    sup_portions = numbered(own, n_usda, "at").select("id", "food_id", F.col("name").alias("unit_name"), "gram_weight", F.lit("supplementary").alias("source"), "notes")
    # Densities.
    derived = derived_density(usda).join(usda.groupBy("food_id").agg(F.min("id").alias("row")), "food_id")
    derived = numbered(derived, 0, "row").select("id", "food_id", "g_per_ml", F.lit("fdc_derived").alias("source"), F.lit("derived from portion data").alias("notes"))
    n_derived = derived.count()
    sup_density = spark.createDataFrame([(n_derived + k, n_fdc + k, d, "supplementary", note) for k, (_, _, d, note) in enumerate(seed.SUPPLEMENTARY, 1)], DENSITY)
    density = derived.unionByName(sup_density)
    if measured is not None:
        by_name = known.groupBy(F.lower("name").alias("key")).agg(F.min("id").alias("food_id"))
        rows = usable.withColumn("key", F.lower("name")).join(by_name, "key").select("food_id", F.round("g_per_ml", 6).alias("g_per_ml"), "source", "row")
        density = density.unionByName(numbered(rows, n_derived + n_sup, "row").select("id", "food_id", "g_per_ml", "source", none))
    return Tables(known, synonym, density, usda.unionByName(sup_portions))


def seed_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *a) for k, a in enumerate(seed.ALIASES)], "at bigint, name string, description string")


def seed_portions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, d, u, g, note) for k, (d, u, g, note) in enumerate(seed.SUPPLEMENTARY_PORTIONS)], "at bigint, description string, name string, gram_weight double, notes string")


def warnings(spark: SparkSession, food: DataFrame) -> list[str]:
    """What of the embedded aliases and portions names no food of the registry; their number is that of the embedded rows at most."""
    _, aliases = aliases_to_foods(seed_aliases(spark), food)
    _, portions = aliases_to_foods(seed_portions(spark), food)
    out = [f"FDC food not found for synonym '{r['name']}': '{r['description']}'" for r in aliases.orderBy("at").collect()]
    return out + [f"FDC food not found for portion: '{r['description']}'" for r in portions.orderBy("at").collect()]


def seed_tables(spark: SparkSession) -> Tables:
    """The registry of the foods whose weights are embedded."""
    foods = spark.createDataFrame([(k, n) for k, (n, _, _) in enumerate(seed.FOODS, 1)], "fdc_id bigint, name string")
    rows = [(str(k), u, "1", str(g)) for k, (_, cup, whole) in enumerate(seed.FOODS, 1) for u, g in [("cup", cup), *whole.items()]]
    return build(spark, foods, spark.createDataFrame(rows, "fdc_id string, modifier string, amount string, gram_weight string"))


# ---- Lookup on the driver -----------------------------------------------------------------------


class Registry:
    """Ingredients by name, case apart. What of them is needed comes to the driver, by the names of headers."""

    def __init__(self, ingredients: Mapping[str, Ingredient], tables: Tables | None = None):
        self.ingredients, self.tables = dict(ingredients), tables

    @classmethod
    def of(cls, tables: Tables, limit: int = SMALL_ROWS) -> Registry:
        """A small registry is read at once, a larger one by names as they are asked for."""
        sides = (tables.synonym, tables.density, tables.portion)
        small = all(side.limit(limit + 1).count() <= limit for side in sides)
        return cls(_ingredients(tables) if small else {}, tables)

    def load(self, names: Sequence[str]) -> None:
        """Reads the foods that names stand for, with all of their synonyms."""
        keys = sorted({n.strip().lower() for n in names} - self.ingredients.keys())
        if not keys or self.tables is None:
            return
        t = self.tables
        ids = [r["food_id"] for r in t.synonym.filter(F.lower("name").isin(keys)).select("food_id").distinct().collect()]
        of = lambda df: df.filter(F.col("food_id").isin(ids))
        if ids:
            self.ingredients |= _ingredients(Tables(t.food, of(t.synonym), of(t.density), of(t.portion)))

    @classmethod
    def seed(cls, spark: SparkSession) -> Registry:
        return cls.of(seed_tables(spark))

    def get(self, name: str) -> Ingredient:
        key = name.strip().lower()
        self.load([key])
        if key not in self.ingredients:
            hints = [r["name"] for r in suggest(self.tables.food, self.tables.synonym, key).collect()] if self.tables else []
            more = f". Did you mean: {', '.join(hints)}?" if hints else ""
            raise InvalidInput(f"No such ingredient as {name.strip()} (line 1){more}")
        return self.ingredients[key].called(key)


def _ingredients(tables: Tables) -> dict[str, Ingredient]:
    """All ingredients of tables, by each of their synonyms."""
    picked = {r["food_id"]: r for r in _small(picked_density(tables.density), ["food_id", "g_per_ml", "source"])}
    more = {r["food_id"]: r["alternatives"] for r in _small(density_alternatives(tables.density), ["food_id", "alternatives"])}
    whole: dict[int, dict[str, float]] = {}
    for r in _small(pieces(tables.portion), ["food_id", "size", "grams"]):
        whole.setdefault(r["food_id"], {})[r["size"]] = r["grams"]
    names: dict[int, list[str]] = {}
    for r in sorted(_small(tables.synonym, ["id", "food_id", "name"])):
        names.setdefault(r["food_id"], []).append(r["name"].lower())
    made: dict[str, Ingredient] = {}
    for food_id, synonyms in names.items():
        p = picked.get(food_id)
        density, source = (p["g_per_ml"], p["source"]) if p else (1.0, "default")
        alternatives = tuple((a["g_per_ml"], a["source"]) for a in more.get(food_id, [])[1:])
        for s in synonyms:
            made[s] = Ingredient(s, food_id, density, source, alternatives, whole.get(food_id, {}), tuple(synonyms))
    return made


def _small(df: DataFrame, columns: Sequence[str]) -> list:
    rows = small_rows(df, columns)
    if rows is None:
        raise ValueError("the foods that are asked for have too many rows for the driver")
    return rows
