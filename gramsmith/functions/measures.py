"""Column expressions over measures: parsing, grams, millilitres, pieces."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gramsmith.sources import seed

# Fixed value: what a cell may be; anchored at its start only.
MEASURE = r"^(?:([0-9]+|[0-9]*\.[0-9]+) *([a-zA-Z][a-zA-Z ]*)|(0))"


def strip(c: Column) -> Column:
    """Without blanks of any kind at both ends (trim removes spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _literal_map(pairs: Mapping[str, object], empty: str) -> Column:
    if not pairs:
        return F.expr(f"CAST(map() AS {empty})")
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


WEIGHTS = {n: f for names, kind, f in seed.UNITS if kind == "weight" for n in names}
VOLUMES = {n: f for names, kind, f in seed.UNITS if kind == "volume" for n in names}
SIZES = {n: names[0] for names, kind, _ in seed.UNITS if kind == "whole" for n in names}


def parse(cell: Column) -> Column:
    """STRUCT<matched, value, unit, key>; unit is as written, trailing blanks included, key is for lookups.

    To be projected once: its fields are used several times.
    """
    # One pass of the pattern: its groups come out with marks between them, a cell without a match as it is.
    parts = F.split(F.regexp_replace(cell, f"(?s){MEASURE}.*$", "$1\u0001$2\u0001$3"), "\u0001")
    at = lambda k: F.try_element_at(parts, F.lit(k))
    zero = F.coalesce(at(3) != "", F.lit(False))
    unit = F.when(zero, F.lit("gram")).otherwise(at(2))
    return F.struct(F.coalesce(F.size(parts) == 3, F.lit(False)).alias("matched"), F.when(zero, F.lit(0.0)).otherwise(at(1).try_cast("double")).alias("value"), unit.alias("unit"), F.lower(F.rtrim(unit)).alias("key"))


def unit_known(key: Column) -> Column:
    return key.isin(*WEIGHTS, *VOLUMES, *SIZES)


def size(key: Column) -> Column:
    """The canonical size that a unit of whole pieces stands for, else null."""
    return F.element_at(_literal_map(SIZES, "map<string,string>"), key)


def to_grams(value: Column, key: Column, density: float | Column, pieces: Mapping[str, float]) -> Column:
    """Grams of a measure of an ingredient; null where it has no weight for the unit.

    All factors are literals of one map, and the conversion stays within code
    generation. The factor of a unit comes before the density, so that 2 dl and
    200 ml are the same number.
    """
    pieces_ = {n: float(pieces[s]) for n, s in SIZES.items() if s in pieces}
    factors = {n: (f, n in VOLUMES) for n, f in (WEIGHTS | VOLUMES | pieces_).items()}
    table = F.create_map(*[x for n, (f, v) in factors.items() for x in (F.lit(n), F.struct(F.lit(f).alias("f"), F.lit(v).alias("is_volume")))])
    hit = F.try_element_at(table, key)
    return value * hit["f"] * F.when(hit["is_volume"], density if isinstance(density, Column) else F.lit(float(density))).otherwise(F.lit(1.0))


def is_whole_unit(unit: Column) -> Column:
    """Whether a portion's name is a size of whole pieces rather than a measure."""
    names = "|".join(seed.MEASURE_NAMES)
    return ~F.lower(strip(unit)).rlike(f"^({names})($|[ ,])")


def milliliters(grams: Column, density: Column) -> Column:
    return grams / F.nullif(density, F.lit(0.0))


def grams_of_milliliters(ml: Column, density: Column) -> Column:
    return ml * density


def pieces_of(grams: Column, piece: Column) -> Column:
    """Null where there is no default piece."""
    return grams / F.nullif(piece, F.lit(0.0))
