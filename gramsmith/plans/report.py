"""Text reports with the figures behind them. Numbers are few here, and formatted by Python on the driver.

All texts of this module are fixed values: reports must read as they do.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from gramsmith.operators.compose import ColumnId
from gramsmith.operators.ratio import Comparison, Ratio, compare
from gramsmith.operators.stats import Statistics
from gramsmith.sources.registry import Ingredient


def _heading(text: str) -> list[str]:
    return [text, "-" * len(text)]


def number(x: float, digits: int) -> str:
    return f"%.{digits}f" % x


def ratio_text(ratio: Ratio, digits: int = 2) -> str:
    return ":".join(number(v, digits) for v in ratio.parts) + " (" + ":".join(i.name for i in ratio.ingredients) + ")"


def portion_text(grams: float, i: Ingredient, digits: int = 0) -> str:
    g, ml = number(grams, digits), number(grams / i.density, digits)
    if i.default_piece is None:
        return f"{g}g or {ml}ml {i.name}"
    return f"{g}g, {ml}ml or {number(grams / i.default_piece, digits)} {i.name}(s) where each {i.name} is {number(i.default_piece, digits)}g"


def recipe_text(ratio: Ratio, weight: float, digits: int = 0) -> tuple[float, str]:
    total, grams = ratio.recipe(weight)
    return total, "\n".join(portion_text(g, i, digits) for g, i in zip(grams, ratio.ingredients, strict=True))


def ingredient_text(ratio: Ratio, column: ColumnId, digits: int = 0) -> str:
    return "\n".join(portion_text(g, i, digits) for g, i in ratio.of(column))


@dataclass(frozen=True)
class ColumnFigures:
    """What a report says of a column: its part of the ratio, its share in per cent with the interval, the rows needed, the grams of the example."""

    name: str
    part: float
    share: float
    low: float
    high: float
    needed: int
    grams: float


@dataclass(frozen=True)
class Report:
    """The lines of a report on one data set, and its figures."""

    lines: tuple[str, ...]
    columns: tuple[ColumnFigures, ...]
    total: float
    rows: int

    def __str__(self) -> str:
        return "\n".join(self.lines)


def interval_percent(mean: float, half: float) -> float:
    """Half of an interval over its mean, in per cent."""
    return abs(half / mean) * 100 if half and mean else 0.0


def interval_line(name: str, mean: float, half: float, digits: int) -> str:
    low, high, part = mean - half, mean + half, interval_percent(mean, half)
    if part > 0.01:
        return f"The {name} proportion is between {number(low, digits)}% and {number(high, digits)}% (the interval is {part:0.0f}% of the mean proportion: {number(mean, digits)}%)"
    return f"The {name} proportion {number(low, digits)}"


def _details(stats: Statistics, needed: Sequence[int], desired: float, digits: int) -> list[str]:
    if stats.n < 2:
        return ["", "Too little data available to provide statistics.", ""]
    names = [i.name for i in stats.ingredients]
    intervals = [interval_line(name, p, h, digits) for name, p, h in zip(names, stats.percentages, stats.intervals, strict=True)]
    sizes = [f"Minimum sample size for {name} proportion: {n}" for name, n in zip(names, needed, strict=True)]
    heading = f"Minimum sample sizes needed for confidence interval with {int(desired * 100)}% difference and confidence level of 95%"
    return [*_heading("Recipe ratio with confidence intervals (confidence level is 95%)"), *intervals, "", *_heading(heading), *sizes, ""]


def stats_report(stats: Statistics, distinct: bool = True, limits: Sequence[tuple[ColumnId, float]] = (), desired: float = 0.05, digits: int = 2, recipe_digits: int = 0, weight: float = 100, verbose: bool = False) -> Report:
    ratio = Ratio(stats.ingredients, stats.ratio).restricted(limits)
    needed = stats.min_sample_sizes(desired)
    total, recipe = recipe_text(ratio, weight, recipe_digits)
    kind = "distinct recipe proportions. Duplicates have been removed." if distinct else "recipe proportions. The data may contain duplicates."
    lines = ["", f"Recipe ratio in units of weight is {ratio_text(ratio, digits)}", ""]
    lines += _details(stats, needed, desired, digits) if verbose else []
    lines += [*_heading(f"{total:g}g Recipe"), recipe, "", f"Note: these calculations are based on {stats.n} {kind}"]
    columns = [ColumnFigures(i.name, part, p, p - h, p + h, n, p / 100 * total) for i, part, p, h, n in zip(stats.ingredients, ratio.parts, stats.percentages, stats.intervals, needed, strict=True)]
    return Report(tuple(lines), tuple(columns), total, stats.n)


@dataclass(frozen=True)
class ColumnChange:
    """A column in two data sets: its shares in per cent, their difference, and the change from the first; None where undefined."""

    name: str
    first: float
    second: float
    difference: float | None
    change: float | None


@dataclass(frozen=True)
class DiffReport:
    lines: tuple[str, ...]
    columns: tuple[ColumnChange, ...]
    overall: float

    def __str__(self) -> str:
        return "\n".join(self.lines)


def change_line(c: ColumnChange, digits: int) -> str:
    if c.change is None:
        return f"The {c.name} proportion is absent from data set 1"
    return f"The {c.name} proportion has {'decreased' if c.change < 0 else 'increased'} by {number(abs(c.change) * 100, digits)}% from data set 1 to 2"


def difference_line(c: ColumnChange, digits: int) -> str:
    return f"Percentage difference between {c.name} proportions {number(c.difference * 100, digits)}%"


def diff_report(first: Statistics, second: Statistics, change: bool = False, digits: int = 0) -> DiffReport:
    a, b = Ratio(first.ingredients, first.ratio), Ratio(second.ingredients, second.ratio)
    c: Comparison = compare(a, b)
    overall = c.overall
    columns = [ColumnChange(i.name, *x) for i, *x in zip(c.ingredients, c.first, c.second, c.differences, c.changes, strict=True)]
    if change:
        told = [change_line(x, digits) for x in sorted(columns, key=lambda x: -abs(x.change) if x.change is not None else 0.0)]
    else:
        told = [difference_line(x, digits) for x in sorted(columns, key=lambda x: -x.difference)]
    lines = ["", f"Ratio for data set 1 in units of weight is {ratio_text(a)}", f"Ratio for data set 2 in units of weight is {ratio_text(b)}", "", *told, "", f"Overall percentage difference = {number(overall * 100, digits)}%", ""]
    return DiffReport(tuple(lines), tuple(columns), overall)
