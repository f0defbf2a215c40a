"""Statistics of compositions: one aggregation for all columns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gramsmith.operators import compose
from gramsmith.sources.recipes import Frame
from gramsmith.sources.registry import Ingredient

Z = 1.96  # fixed value: of 95 % confidence


def half_width(x: Column) -> Column:
    """Half of the 95 % confidence interval of a mean; null without rows."""
    return F.lit(Z) * F.stddev_pop(x) / F.sqrt(F.nullif(F.count(x), F.lit(0)))


def min_sample_size(std: Column, mean: Column, desired: float = 0.05) -> Column:
    """Rows needed for an interval of ± desired of the mean; 0 for a mean of 0."""
    return F.when(mean == 0, F.lit(0)).otherwise(F.ceil(F.pow(F.lit(Z) * std / (F.nullif(mean, F.lit(0.0)) * F.lit(desired)), 2))).cast("bigint")


def wide_stats(frame: Frame, *keys: str) -> DataFrame:
    """n, and mean, std and ci of each column, by keys: a partial and a final hash aggregation."""
    cells = [f(F.col(c)).alias(f"{name}_{c}") for c in frame.columns for name, f in (("mean", F.avg), ("std", F.stddev_pop), ("ci", half_width))]
    return frame.df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *cells)


def long_stats(long: DataFrame, *keys: str, desired: float = 0.05) -> DataFrame:
    """keys, n, mean, std, ci_half, min_n of rows keys …, value: for batches of different columns."""
    out = long.groupBy(*keys).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), half_width(F.col("value")).alias("ci_half"))
    return out.withColumn("min_n", min_sample_size(F.col("std"), F.col("mean"), desired))


def bakers_percentage(stats: DataFrame, order: str, *keys: str) -> DataFrame:
    """Adds ratio, the mean over that of the first column."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return stats.withColumn("ratio", F.col("mean") / F.nullif(F.first("mean").over(w), F.lit(0.0)))


def proportions(stats: DataFrame, *keys: str) -> DataFrame:
    """Adds proportion, the share of the mean in the sum of means, in per cent."""
    return stats.withColumn("proportion", F.col("mean") * 100 / F.nullif(F.sum("mean").over(Window.partitionBy(*keys)), F.lit(0.0)))


@dataclass(frozen=True)
class Statistics:
    """The aggregated row of a frame, on the driver."""

    ingredients: tuple[Ingredient, ...]
    n: int
    means: list[float]
    stds: list[float]
    intervals: list[float]

    @property
    def ratio(self) -> list[float]:
        return [m / self.means[0] for m in self.means]

    @property
    def percentages(self) -> list[float]:
        return [m / sum(self.means) * 100 for m in self.means]

    def min_sample_sizes(self, desired: float = 0.05) -> list[int]:
        return [0 if m == 0 else math.ceil((Z * s / (m * desired)) ** 2) for m, s in zip(self.means, self.stds, strict=True)]


def collect(frame: Frame, zeros: Sequence[compose.ColumnId] = ()) -> Statistics:
    """Normalises, imputes zeros if any column is flagged, and aggregates. One row comes to the driver."""
    rows = compose.normalize(compose.impute_zeros(frame, zeros))
    got = wide_stats(rows).first()
    pick = lambda name: [got[f"{name}_{c}"] for c in frame.columns]
    return Statistics(frame.ingredients, got["n"], pick("mean"), pick("std"), pick("ci"))


def statistics(frame: Frame, distinct: bool = True, merge: compose.MergeSpec | None = None, zeros: Sequence[compose.ColumnId] = ()) -> Statistics:
    """Duplicates go before the merge: rows are equal if all their grams are."""
    frame = compose.distinct(frame) if distinct else frame
    return collect(compose.merge(frame, merge or []), zeros)
