"""Compositions: columns by name, merges, normalising, duplicates, zeros."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from gramsmith.errors import InvalidInput, InvalidMerge
from gramsmith.session import written
from gramsmith.sources.recipes import Frame
from gramsmith.sources.registry import Ingredient

ColumnId = str | int
MergeSpec = list[list[tuple[ColumnId, float]]]


def places(ingredients: Sequence[Ingredient], column: ColumnId) -> list[int]:
    """The columns that a name (any synonym, case apart) or a place from 0 stands for."""
    if isinstance(column, int):
        found = [column] if 0 <= column < len(ingredients) else []
    else:
        key = column.strip().lower()
        found = [k for k, i in enumerate(ingredients) if key == i.name.lower() or key in i.synonyms]
    if not found:
        raise InvalidInput(f"Missing column specified: '{column}'")
    return found


def column_id(text: str) -> ColumnId:
    text = text.strip()
    return int(text) if text.isdigit() else text


def parse_merge(spec: str | None) -> MergeSpec:
    """Groups are separated by colons, members by plus signs; name.NN takes that part of a column.

    .100 is a tenth: what follows the point are the decimals of a part of 1. A
    member with more than one point is its first piece, taken whole.
    """
    groups: MergeSpec = []
    for group in (spec or "").split(":") if spec else []:
        members = []
        for member in group.split("+"):
            name, *rest = member.split(".")
            part = 1.0
            if len(rest) == 1:
                if not rest[0].isdigit():
                    raise InvalidInput("Expected percentage after period in merge specification")
                part = float("0." + rest[0])
            members.append((column_id(name), part))
        groups.append(members)
    return groups


def merge_plan(ingredients: Sequence[Ingredient], spec: MergeSpec) -> list[tuple[int, list[tuple[int, float]]]]:
    """The columns that remain, in order, with what each is the sum of.

    The first member of a group holds the sum and the others go, unless they hold
    one themselves. Of two groups with the same first column the last counts.
    """
    sums: dict[int, list[tuple[int, float]]] = {}
    gone: set[int] = set()
    for group in spec:
        members: list[tuple[int, float]] = []
        for column, part in group:
            if isinstance(column, int) and not 0 <= column < len(ingredients):
                raise InvalidMerge(f"Attempted to merge missing column {column}")
            members += [(k, part) for k in places(ingredients, column)]
        sums[members[0][0]] = members
        gone |= {k for k, _ in members[1:]}
    return [(k, sums.get(k, [(k, 1.0)])) for k in range(len(ingredients)) if k in sums or k not in gone]


def merge(frame: Frame, spec: MergeSpec) -> Frame:
    """A projection: what of a column isn't merged is dropped."""
    if not spec:
        return frame
    plan = merge_plan(frame.ingredients, spec)
    sums = [reduce(add, [F.col(f"c{k}") * F.lit(part) if part != 1.0 else F.col(f"c{k}") for k, part in members]).alias(f"c{n}") for n, (_, members) in enumerate(plan)]
    kept = [c for c in frame.df.columns if c not in frame.columns]
    return Frame(frame.df.select(*kept, *sums), tuple(frame.ingredients[k] for k, _ in plan))


def distinct(frame: Frame, *keys: str) -> Frame:
    """Rows of equal grams once (within keys); a hash aggregation over the columns."""
    return frame.with_df(frame.df.select(*keys, *frame.columns).distinct())


def row_sum(columns: Sequence[str]) -> Column:
    return reduce(add, [F.col(c) for c in columns])


def normalize(frame: Frame, total: float = 100.0) -> Frame:
    """Rows scaled to a common sum; a row that sums to 0 is an error, as a division by it is."""
    kept = [c for c in frame.df.columns if c not in frame.columns]
    return frame.with_df(frame.df.select(*kept, *[(F.col(c) * (F.lit(total) / row_sum(frame.columns))).alias(c) for c in frame.columns]))


def zero_places(ingredients: Sequence[Ingredient], ids: Sequence[ColumnId]) -> set[int]:
    return {k for i in ids for k in places(ingredients, i)}


def means_without_zeros(rows: Frame, flagged: set[int]) -> list[float]:
    """Means of normalised rows by column, exact zeros of flagged ones left out; one row comes to the driver."""
    got = rows.df.agg(*[F.avg(F.when(F.col(c) != 0, F.col(c)) if k in flagged else F.col(c)).alias(c) for k, c in enumerate(rows.columns)]).first()
    if any(got[c] is None for c in rows.columns):
        raise InvalidInput("A column whose zeros are to be ignored holds nothing else")
    return [got[c] for c in rows.columns]


def impute_zeros(frame: Frame, ids: Sequence[ColumnId]) -> Frame:
    """Zeros of flagged columns become the share that the column has where it isn't 0.

    With shares p of the means, a zero becomes 100 p and every other cell shrinks by
    (1 − p) for each zero of the row. The normalised rows are computed once and
    written, as they are read twice; the means enter the plan as literals.
    """
    flagged = zero_places(frame.ingredients, ids)
    if not flagged:
        return frame
    rows = normalize(frame)
    rows = rows.with_df(written(rows.df))
    means = means_without_zeros(rows, flagged)
    share = [m / sum(means) for m in means]
    shrink = reduce(lambda a, b: a * b, [F.when(F.col(f"c{k}") == 0, F.lit(1 - share[k])).otherwise(F.lit(1.0)) for k in sorted(flagged)])
    kept = [c for c in rows.df.columns if c not in rows.columns]
    out = [(F.when(F.col(c) == 0, F.lit(100 * share[k])).otherwise(F.col(c) * shrink) if k in flagged else F.col(c) * shrink).alias(c) for k, c in enumerate(rows.columns)]
    return rows.with_df(rows.df.select(*kept, *out))


def parse_restrictions(text: str | None) -> list[tuple[ColumnId, float]]:
    """col=weight, separated by commas."""
    out: list[tuple[ColumnId, float]] = []
    for part in (text or "").split(",") if text else []:
        name, sep, value = part.partition("=")
        try:
            out.append((column_id(name), float(value)))
        except ValueError:
            sep = ""
        if not sep:
            raise InvalidInput("Expected column option")
    return out
