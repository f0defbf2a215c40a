"""The catalog document: projection, constraints, export, build from configured files.

The constraints are one set of column rules (``violations``), for tables of records
and for the document of a build alike.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramsmith.operators.ratio import Ratio
from gramsmith.operators.stats import Statistics, statistics
from gramsmith.session import broadcast_if_small
from gramsmith.sources import recipes
from gramsmith.sources.registry import Registry

RECIPE_TYPE = (
    "struct<id:string,title:string,category:string,description:string,base_ingredient:string,sample_size:bigint,confidence_level:double,"
    "ingredients:array<struct<name:string,ratio:double,proportion:double,std_deviation:double,ci_lower:double,ci_upper:double,min_sample_size:bigint,density_g_per_ml:double,whole_unit:struct<name:string,grams:double>>>,"
    "sources:array<struct<type:string,title:string,ref:string>>>"
)
CATALOG_TYPE = f"struct<version:int,recipes:array<{RECIPE_TYPE}>>"
#: What an ingredient must have.
REQUIRED = ("name", "ratio", "proportion", "std_deviation", "ci_lower", "ci_upper")
SLUG = r"^[a-z0-9]+(-[a-z0-9]+)*$"  # fixed value
SOURCE_TYPES = ("url", "book", "text")  # fixed value


def catalog_rows(stats: DataFrame) -> DataFrame:
    """Rows of keys, ratio, mean, std, ci_half, min_n (in per cent) as a catalog shows them (of 1, four places)."""
    of1 = lambda c: F.round(c / 100, 4)
    return stats.select(
        *[c for c in stats.columns if c not in ("mean", "std", "ci_half", "ratio", "min_n")], F.round("ratio", 4).alias("ratio"), of1(F.col("mean")).alias("proportion"), of1(F.col("std")).alias("std_deviation"),
        of1(F.greatest(F.lit(0.0), F.col("mean") - F.col("ci_half"))).alias("ci_lower"), of1(F.col("mean") + F.col("ci_half")).alias("ci_upper"), F.col("min_n").alias("min_sample_size"),
    )


def with_units(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Adds density_g_per_ml and whole_unit to catalog rows with an ingredient.

    units: ingredient, density (null where only the default is known) and piece,
    the grams of a medium one, or null. One row an ingredient.
    """
    whole = F.when(F.col("piece").isNotNull(), F.struct(F.lit("medium").alias("name"), F.round("piece", 4).alias("grams")))
    u = units.select(F.col("ingredient"), F.round("density", 4).alias("density_g_per_ml"), whole.alias("whole_unit"))
    return rows.join(broadcast_if_small(u), "ingredient", "left")


def documents(rows: DataFrame, *keys: str) -> DataFrame:
    """keys, base_ingredient, sample_size, confidence_level and ingredients of each recipe, from catalog rows with units, col_idx and n."""
    cell = F.struct("col_idx", F.col("ingredient").alias("name"), "ratio", "proportion", "std_deviation", "ci_lower", "ci_upper", "min_sample_size", "density_g_per_ml", "whole_unit")
    cells = F.sort_array(F.collect_list(cell))
    nested = rows.groupBy(*keys).agg(F.min_by("ingredient", "col_idx").alias("base_ingredient"), F.max("n").alias("sample_size"), cells.alias("cells"))
    return nested.select(*keys, "base_ingredient", "sample_size", F.lit(0.95).alias("confidence_level"), F.transform("cells", lambda c: c.dropFields("col_idx")).alias("ingredients"))


def recipe(entry: Mapping, stats: Statistics, desired: float = 0.05) -> dict:
    """One recipe of the catalog. Rounding is Python's, half to even, on the driver."""
    ratio = Ratio(stats.ingredients, stats.ratio)
    sizes = stats.min_sample_sizes(desired)
    rows = []
    for k, i in enumerate(stats.ingredients):
        p, s, h = stats.percentages[k] / 100, stats.stds[k] / 100, stats.intervals[k] / 100
        whole = {"name": "medium", "grams": round(i.default_piece, 4)} if i.default_piece is not None else None
        rows.append(
            {
                "name": i.name, "ratio": round(ratio.parts[k], 4), "proportion": round(p, 4), "std_deviation": round(s, 4), "ci_lower": round(max(0.0, p - h), 4), "ci_upper": round(p + h, 4),
                "min_sample_size": sizes[k], "density_g_per_ml": None if i.density_source == "default" else round(i.density, 4), "whole_unit": whole,
            }
        )
    head = {k: entry[k] for k in ("id", "title", "category", "description") if k in entry}
    return head | {"base_ingredient": stats.ingredients[0].name, "sample_size": stats.n, "confidence_level": 0.95, "ingredients": rows} | ({"sources": entry["sources"]} if "sources" in entry else {})


def build_catalog(spark: SparkSession, registry: Registry, config: Sequence[Mapping], folder: str) -> list[dict]:
    """The recipes of a configuration: id, title, category, description, csv_files (in the folder) and sources of each."""
    return [recipe(e, statistics(recipes.read(spark, registry, [str(Path(folder) / f) for f in e["csv_files"]]))) for e in config]


def write_catalog(spark: SparkSession, made: Sequence[Mapping], path: str) -> None:
    """The document, indented by two, in UTF-8, with a newline at its end; nothing is written if a constraint is broken."""
    if broken := faults(spark, made):
        raise ValueError("; ".join(broken))
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps({"version": 1, "recipes": list(made)}, indent=2, ensure_ascii=False) + "\n", encoding="utf-8")


def faults(spark: SparkSession, made: Sequence[Mapping]) -> list[str]:
    """What of a document's recipes breaks the constraints, unknown fields included."""
    schema = T._parse_datatype_string(RECIPE_TYPE)
    out = [f"recipe {k}: unknown field {f}" for k, r in enumerate(made) for f in _unknown(r, schema)]
    texts = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(made)], "record_id bigint, json string")
    rows = violations(texts.select("record_id", F.from_json("json", RECIPE_TYPE).alias("r")).select("record_id", "r.*"))
    return out + [f"recipe {r['record_id']}: {r['rule']}" for r in rows.orderBy("record_id", "rule").collect()]


def _unknown(value: object, schema: T.DataType, at: str = "") -> list[str]:
    if isinstance(schema, T.ArrayType) and isinstance(value, list):
        return [x for v in value for x in _unknown(v, schema.elementType, at)]
    if isinstance(schema, T.StructType) and isinstance(value, Mapping):
        return [x for k, v in value.items() for x in (_unknown(v, schema[k].dataType, f"{at}{k}.") if k in schema.names else [f"{at}{k}"])]
    return []


def violations(recipes: DataFrame) -> DataFrame:
    """record_id and rule of each constraint that a nested record breaks; no rows if all hold."""
    some = lambda column, f: F.exists(F.coalesce(column, F.array()), lambda x: F.coalesce(f(x), F.lit(False)))
    within = lambda c, low, high=None: (c < low) | ((c > high) if high is not None else F.lit(False))
    lacks = lambda x, names: functools.reduce(lambda a, b: a | b, [x.isNull(), *[x[n].isNull() for n in names]])
    rules: dict[str, Column] = {
        "slug": ~F.coalesce(F.col("id").rlike(SLUG), F.lit(False)),
        "title": F.col("title").isNull(),
        "category": F.col("category").isNull(),
        "base_ingredient": F.col("base_ingredient").isNull(),
        "sample_size": ~F.coalesce(F.col("sample_size") >= 1, F.lit(False)),
        "ingredients": F.coalesce(F.size("ingredients"), F.lit(0)) < 1,
        "required": some("ingredients", lambda i: lacks(i, REQUIRED)),
        "ratio": some("ingredients", lambda i: within(i["ratio"], 0)),
        "proportion": some("ingredients", lambda i: within(i["proportion"], 0, 1)),
        "std_deviation": some("ingredients", lambda i: within(i["std_deviation"], 0)),
        "interval": some("ingredients", lambda i: F.coalesce(within(i["ci_lower"], 0), F.lit(False)) | F.coalesce(within(i["ci_upper"], 0), F.lit(False))),
        "min_sample_size": some("ingredients", lambda i: within(i["min_sample_size"], 0)),
        "whole_unit": some("ingredients", lambda i: i["whole_unit"].isNotNull() & (i["whole_unit"]["name"].isNull() | ~F.coalesce(i["whole_unit"]["grams"] > 0, F.lit(False)))),
        "source_type": some("sources", lambda s: s["type"].isNull() | ~s["type"].isin(*SOURCE_TYPES)),
        "source_ref": some("sources", lambda s: s["ref"].isNull()),
    }
    found = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]), lambda x: x.isNotNull())
    return recipes.select("record_id", F.explode(found).alias("rule"))


def to_json(recipes: DataFrame) -> DataFrame:
    """Records as JSON lines."""
    return recipes.select(F.to_json(F.struct("*")).alias("json"))
