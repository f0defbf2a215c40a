"""Files of measures as wide frames of grams.

The first non-blank line of a file is its header, quoted names allowed; every
further non-blank line is a row, its cells separated by plain commas. Columns are
known by place (c0, c1, …), as names may repeat.

Files are scanned line by line, in as many tasks as they have splits. Their first
two lines tell header and emptiness; one aggregation, of a row for each task, then
finds the first faults and how many lines each task has, from which lines get their
numbers without a sort. Faults are raised on the driver with their message before
anything is computed: all cells of all files are parsed before any is converted, so
a fault of parsing comes before one of conversion.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramsmith.errors import BadUnit, InvalidInput
from gramsmith.functions import measures
from gramsmith.sources.registry import Ingredient, Registry


@dataclass(frozen=True)
class Frame:
    """Rows of amounts by column. df has c0 … ck, and may have further columns."""

    df: DataFrame
    ingredients: tuple[Ingredient, ...]

    @property
    def columns(self) -> list[str]:
        return [f"c{k}" for k in range(len(self.ingredients))]

    def with_df(self, df: DataFrame) -> Frame:
        return Frame(df, self.ingredients)

    def to_long(self, *keys: str) -> DataFrame:
        """keys, col_idx, ingredient, value: a row for each cell."""
        cells = F.array(*[F.struct(F.lit(k).alias("col_idx"), F.lit(i.name).alias("ingredient"), F.col(f"c{k}").alias("value")) for k, i in enumerate(self.ingredients)])
        return self.df.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.*")


_TASK = 33  # a number of monotonically_increasing_id has the task above this bit, the place in it below


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """line and at of the non-blank lines of a file. The splits of one file are scanned in its order, so at grows with the lines."""
    return spark.read.text(path).filter(measures.strip(F.col("value")) != "").select(F.col("value").alias("line"), F.monotonically_increasing_id().alias("at"))


def header_names(line: str) -> list[str]:
    """The names of a header, by the rules of CSV, in lower case and without outer blanks."""
    return [n.strip().lower() for n in next(csv.reader([line.strip()]), [])]


def header(line: str, registry: Registry) -> tuple[Ingredient, ...]:
    names = header_names(line)
    registry.load(names)
    return tuple(registry.get(n) for n in names)


def cells(line: Column) -> Column:
    """The cells of a row, separated by plain commas, quoted or not."""
    return F.split(line, ",")


def measure_of(cell: Column) -> Column:
    return measures.parse(measures.strip(cell))


def arity_fault(n: Column, expected: int | Column, line_nr: Column) -> Column:
    """The message of a row with another number of cells than its header, else null."""
    e = F.lit(expected) if isinstance(expected, int) else expected
    return F.when(n != e, F.concat(F.lit("The row on line "), line_nr.cast("string"), F.lit(" has "), n.cast("string"), F.lit(" columns where "), e.cast("string"), F.lit(" were expected")))


def _fault(m: Column, place: int) -> Column:
    """What is wrong with a parsed cell that is no measure, else null; @ stands for its line."""
    at = f" at line @, column {place}"
    return F.when(~m["matched"], F.lit("Incorrect format of measurement" + at)).when(~measures.unit_known(m["key"]), F.concat(F.lit("No unit named '"), m["unit"], F.lit("'" + at)))


def read(spark: SparkSession, registry: Registry, paths: Sequence[str]) -> Frame:
    """All rows of files with the same header, in grams, with file_idx and line_nr (among the non-blank lines of the file)."""
    parts, known = [], None
    for idx, path in enumerate(paths):
        lines = _lines(spark, path)
        top = lines.take(2)
        if not top:
            continue
        ingredients = header(top[0]["line"], registry)
        empty = len(top) == 1
        if known is not None and [i.food_id for i in known] != [i.food_id for i in ingredients]:
            if parts or not empty:
                raise InvalidInput("All input files must have the same header.")
        known = known if parts else ingredients
        if not parts and empty and idx + 1 < len(paths):
            continue  # a header without rows doesn't bind the files after it
        parts.append((idx, lines, top[0]["at"]))
    if known is None:
        raise InvalidInput("No data")
    frames, before, faults, unfit = [], 0, [], []
    for idx, lines, head in parts:
        wide = _measured(lines, known).withColumn("file_idx", F.lit(idx))
        first, counts = _survey(wide.filter(F.col("at") != head), lines)
        starts = _starts(counts)
        number = lambda at, starts=starts: starts[at >> _TASK] + (at & ((1 << _TASK) - 1))
        if first["fault"]:
            faults.append(first["fault"]["text"].replace("@", str(number(first["fault"]["at"])), 1))
        if first["unfit"]:
            unfit.append((before + number(first["unfit"]["at"]), first["unfit"]["j"], first["unfit"]["u"]))
        before += sum(counts.values()) - 1
        start = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.shiftright("at", _TASK))
        line_nr = (start + F.col("at").bitwiseAND(F.lit((1 << _TASK) - 1))).cast("bigint")
        frames.append(wide.filter(F.col("at") != head).select("file_idx", line_nr.alias("line_nr"), *[f"c{j}" for j in range(len(known))]))
    if faults:
        raise InvalidInput(faults[0])
    if unfit:
        line, j, unit = unfit[0]
        shown = unit.lower() if unit in ("STICK", "CUBE", "KNOB") else unit
        raise BadUnit(f"Inapplicable unit '{shown}' used for ingredient '{known[j].name}' at line {line}")
    return Frame(reduce(DataFrame.unionByName, frames), known)


def _measured(lines: DataFrame, known: tuple[Ingredient, ...]) -> DataFrame:
    """at, grams by column, and what is wrong with a row: fault (of parsing), unfit (the first unit without a weight)."""
    k = len(known)
    wide = lines.select("at", cells(F.col("line")).alias("cells"))
    wide = wide.select("at", F.size("cells").alias("n"), *[measure_of(F.try_element_at("cells", F.lit(j + 1))).alias(f"m{j}") for j in range(k)])
    # Of a row, an arity fault hides those of its cells.
    fault = F.coalesce(arity_fault(F.col("n"), k, F.lit("@")), *[_fault(F.col(f"m{j}"), j) for j in range(k)])
    grams = [measures.to_grams(F.col(f"m{j}.value"), F.col(f"m{j}.key"), i.density, i.pieces).alias(f"c{j}") for j, i in enumerate(known)]
    wide = wide.select("at", fault.alias("fault"), *grams, *[F.col(f"m{j}.key").alias(f"u{j}") for j in range(k)])
    unfit = F.coalesce(*[F.when(F.col(f"c{j}").isNull(), F.struct(F.lit(j).alias("j"), F.upper(measures.size(F.col(f"u{j}"))).alias("u"))) for j in range(k)])
    return wide.withColumn("unfit", unfit)


def _survey(rows: DataFrame, lines: DataFrame) -> tuple[dict, dict[int, int]]:
    """The first fault of parsing and the first of conversion among rows, and the number of lines of each task: one pass each."""
    first = rows.agg(
        F.min_by(F.struct("at", F.col("fault").alias("text")), F.when(F.col("fault").isNotNull(), F.col("at"))).alias("fault"),
        F.min_by(F.struct("at", "unfit.j", "unfit.u"), F.when(F.col("unfit").isNotNull(), F.col("at"))).alias("unfit"),
    ).first()
    counts = lines.groupBy(F.shiftright("at", _TASK).alias("task")).count().collect()
    return first.asDict(), {r["task"]: r["count"] for r in counts}


def _starts(counts: dict[int, int]) -> dict[int, int]:
    """The number, from 1, of the first line of each task."""
    starts, n = {}, 1
    for task in sorted(counts):
        starts[task], n = n, n + counts[task]
    return starts
