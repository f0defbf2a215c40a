"""Ratios: scaling, limits, percentages, comparison."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gramsmith.errors import InvalidInput
from gramsmith.operators.compose import ColumnId, places
from gramsmith.session import broadcast_if_small
from gramsmith.sources.registry import Ingredient


@dataclass(frozen=True)
class Ratio:
    """Values by ingredient, the first being 1, and limits of weight on some of them."""

    ingredients: tuple[Ingredient, ...]
    parts: list[float]
    limits: tuple[tuple[ColumnId, float], ...] = field(default=())

    def restricted(self, limits: Sequence[tuple[ColumnId, float]]) -> Ratio:
        for column, _ in limits:
            places(self.ingredients, column)
        return Ratio(self.ingredients, self.parts, tuple(limits))

    def values(self, scale: float = 1.0) -> list[float]:
        return [p * scale for p in self.parts]

    def scale(self, weight: float) -> float:
        """The scale for a weight, cut by the tightest limit; a limit on nothing is none."""
        by = weight / sum(self.parts)
        for column, limit in self.limits:
            part = sum(self.parts[k] for k in places(self.ingredients, column))
            if part > 0:
                by = min(by, limit / part)
        return by

    def recipe(self, weight: float) -> tuple[float, list[float]]:
        grams = self.values(self.scale(weight))
        return sum(grams), grams

    def percentages(self) -> list[float]:
        return self.values(100 / sum(self.parts))

    def of(self, column: ColumnId, scale: float = 1.0) -> list[tuple[float, Ingredient]]:
        return [(self.parts[k] * scale, self.ingredients[k]) for k in places(self.ingredients, column)]


# ---- The same over DataFrames of keys, col_idx, value -------------------------------------------


def as_percentages(ratio: DataFrame, *keys: str) -> DataFrame:
    return ratio.withColumn("percentage", F.col("value") * 100 / F.nullif(F.sum("value").over(Window.partitionBy(*keys)), F.lit(0.0)))


def scaled(ratio: DataFrame, weight: float, limits: DataFrame | None, *keys: str) -> DataFrame:
    """Adds grams. limits: name (the ingredient's) and grams of the most there may be."""
    total = F.lit(float(weight)) / F.nullif(F.sum("value").over(Window.partitionBy(*keys)), F.lit(0.0))
    if limits is None:
        return ratio.withColumn("grams", F.col("value") * total)
    named = ratio.join(broadcast_if_small(limits.select(F.col("name").alias("ingredient"), F.col("grams").alias("most"))), "ingredient", "left")
    part = F.sum("value").over(Window.partitionBy(*keys, "ingredient"))
    named = named.withColumn("ceiling", F.when(part > 0, F.col("most") / part))
    by = F.least(total, F.min("ceiling").over(Window.partitionBy(*keys)))
    return named.withColumn("grams", F.col("value") * by).drop("most", "ceiling")


def percentage_difference(a: Column, b: Column) -> Column:
    """|b − a| over their mean; null if both are 0."""
    return F.abs(b - a) / F.nullif((a + b) / 2, F.lit(0.0))


def percentage_change(a: Column, b: Column) -> Column:
    """(b − a) over a; null if a is 0."""
    return (b - a) / F.nullif(a, F.lit(0.0))


def compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """col_idx, ingredient, a, b, difference, change of two frames col_idx, ingredient, percentage."""
    r = right.select("col_idx", F.col("percentage").alias("b"))
    return against(left.select("col_idx", "ingredient", F.col("percentage").alias("a")).join(r, "col_idx"))


def against(both: DataFrame) -> DataFrame:
    """Adds difference and change to rows with both percentages, a and b."""
    return both.withColumn("difference", percentage_difference(F.col("a"), F.col("b"))).withColumn("change", percentage_change(F.col("a"), F.col("b")))


def ranked(compared_: DataFrame) -> DataFrame:
    """Places by difference and by size of change, ties by column."""
    by = lambda *o: F.row_number().over(Window.orderBy(*o))
    return compared_.withColumn("diff_rank", by(F.desc("difference"), "col_idx")).withColumn("change_rank", by(F.desc(F.abs("change")), "col_idx"))


@dataclass(frozen=True)
class Comparison:
    ingredients: tuple[Ingredient, ...]
    first: list[float]
    second: list[float]

    @property
    def differences(self) -> list[float | None]:
        return [abs(b - a) / ((a + b) / 2) if a + b else None for a, b in zip(self.first, self.second, strict=True)]

    @property
    def changes(self) -> list[float | None]:
        return [(b - a) / a if a else None for a, b in zip(self.first, self.second, strict=True)]

    @property
    def overall(self) -> float:
        known = [d for d in self.differences if d is not None]
        if len(known) < len(self.first):
            raise InvalidInput("An ingredient is absent from both data sets: its difference is undefined")
        return sum(known) / len(known)


def compare(a: Ratio, b: Ratio) -> Comparison:
    if [i.food_id for i in a.ingredients] != [i.food_id for i in b.ingredients]:
        raise InvalidInput("Ingredients for input files do not match: unable to compare")
    return Comparison(a.ingredients, a.percentages(), b.percentages())
