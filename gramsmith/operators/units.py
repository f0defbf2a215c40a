"""Quantities recorded in different units, to milligrams (problem 3).

Cells repeat, so each worker parses a distinct cell once (a bounded memo) and
the scan stays a map without a shuffle: rows go in by Arrow batches and only
the cases come out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame

from gramsmith.functions.quantities import MASS, CellGrammar, Unit, Units, exact, fold, half_up
from gramsmith.session import small_rows, spread

#: Parsed cells kept by a worker; beyond it the memo starts anew.
MEMO = 200_000
SCHEMA = "record_table string, record_id bigint, field string, milligrams bigint"
_OUT = pa.schema([("record_table", pa.string()), ("record_id", pa.int64()), ("field", pa.string()), ("milligrams", pa.int64())])


class NoteGrammar:
    """Finds the unit that a note gives for numbers without one, and the fields it is meant for.

    note = anything statement anything, where a statement is a unit in
    parentheses, or a unit after a cue ("enhet=", "in", "i", "är", "avser",
    "mått:"). A unit with a number before it is an amount of something else.
    """

    # Cues after which a unit is meant for the numbers of the row.
    CUES = ["enhet=", "enhet:", "enhet =", "unit=", "unit:", "mått:", "measured in", "amounts are in", "given in", "avser", "är", "i", "in"]

    def __init__(self, units: Units):
        cues = "|".join(re.escape(c) for c in sorted(self.CUES, key=len, reverse=True))
        self.units = units
        self.find = re.compile(rf"(?:\(\s*({units.pattern})\.?\s*\)|(?<!\w)(?:{cues})\s*({units.pattern})(?!\w))")

    def unit(self, note: str, field: str) -> Unit | None:
        text = fold(note)
        m = self.find.search(text)
        if not m:
            return None
        before = text[: m.start()] + text[m.start() : m.end()]
        named = [f for f, words in FIELD_WORDS.items() if re.search(rf"(?<!\w)(?:{'|'.join(words)})(?!\w)", before)]
        if named and field not in named:
            return None
        return self.units.unit(m[1] or m[2])


# What the fields are called in notes.
FIELD_WORDS = {"flour": ["flour", "mjöl"], "milk": ["milk", "mjölk"], "egg": ["eggs?", "ägg"], "water": ["water", "vatten"]}


class WeightGrammar:
    """Finds the unit in which a weight was recorded, told by the name or the notes of a portion.

    A weight unit counts unless a number stands before it: that is the size of a
    container or package ("from a 2 kg bag"). In a name it counts only within
    parentheses or brackets, as names may be called after weights (pound cake).
    """

    def __init__(self, units: Units):
        self.units = units
        # All units, so that "fl oz" is read as one unit of volume and not as a weight.
        self.notes = re.compile(rf"(?<![\w.])({units.pattern})(?!\w)")
        self.name = re.compile(r"[(\[]([^)\]]*)[)\]]")

    def _first(self, text: str) -> Unit | None:
        for m in self.notes.finditer(text):
            if self.units.unit(m[1]).dim != MASS or re.search(r"[\d½¼¾]\s*$", text[: m.start()]):
                continue
            if re.match(r"\.?\s*(?:bag|tin|can|loaf|package|pack|jar|cake|box)(?!\w)", text[m.end() :]):
                continue
            if re.search(r"(?:not|inte|ej)\s+$", text[: m.start()]):
                continue
            return self.units.unit(m[1])
        return None

    def unit(self, name: str | None, notes: str | None) -> Unit | None:
        for m in self.name.finditer(fold(name or "")):
            if u := self._first(m[1]):
                return u
        return self._first(fold(notes or ""))


class _Worker:
    """Grammars and memo of one Python worker, kept from batch to batch."""

    made: dict[tuple, _Worker] = {}

    def __init__(self, units: tuple, densities: tuple):
        self.units = Units(units, densities)
        self.cells = CellGrammar(self.units)
        self.notes = NoteGrammar(self.units)
        self.weights = WeightGrammar(self.units)
        self.memo: dict = {}

    @classmethod
    def get(cls, units: tuple, densities: tuple) -> _Worker:
        key = (units, densities)
        if key not in cls.made:
            cls.made.clear()
            cls.made[key] = cls(*key)
        return cls.made[key]

    def remember(self, key: tuple, value: object) -> object:
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[key] = value
        return value

    def milligrams(self, cell: str, note: str | None, field: str) -> int:
        """0 where the cell is no case."""
        given = None
        if note is not None:
            key = ("n", note, field)
            given = self.memo[key] if key in self.memo else self.remember(key, self.notes.unit(note, field))
        key = ("c", cell, given.name if given else None, field)
        if key in self.memo:
            return self.memo[key]
        total, only_grams = Fraction(0), True
        for number, unit in self.cells.cell(cell):
            unit = unit or given
            grams = self.units.grams(unit.of(number), unit, field) if unit else None
            if grams is None:
                total = Fraction(0)
                break
            total += grams
            only_grams &= unit.is_gram
        return self.remember(key, 0 if only_grams or total <= 0 else half_up(total * 1000))


def registry(units: DataFrame, ingredient: DataFrame) -> tuple[tuple, tuple]:
    """Units and densities for the workers; both tables must be small, which is checked."""
    u = small_rows(units, ["unit_name", "kind", "factor", "ingredient"])
    d = small_rows(ingredient, ["name", "g_per_ml"])
    if u is None or d is None:
        raise ValueError("a registry of units or densities has more than 50,000 rows")
    return tuple(tuple(r) for r in u), tuple(tuple(r) for r in d)


def _batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _OUT.types, strict=True)], schema=_OUT)


def cells_to_milligrams(df: DataFrame, table: str, id_col: str, fields: list[str], note_col: str, units: tuple, densities: tuple) -> DataFrame:
    """One row for each cell that records an amount above 0 in anything but grams.

    A null or empty cell, a cell without an amount, an amount of 0 and a number
    for which neither cell nor note gives a unit are no cases; neither is an
    amount whose unit has no way to grams for the field's ingredient. Repeated
    rows give repeated results. Other columns are never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _Worker.get(units, densities)
        for b in batches:
            ids, notes = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: list[list] = [[], [], [], []]
            for k, field in enumerate(fields, 2):
                for i, (cell, note) in enumerate(zip(b.column(k).to_pylist(), notes, strict=True)):
                    if cell and (mg := w.milligrams(cell, note, field)):
                        out[1].append(ids[i])
                        out[2].append(field)
                        out[3].append(mg)
            out[0] = [table] * len(out[1])
            yield _batch(out)

    return spread(df.select(id_col, note_col, *fields)).mapInArrow(run, SCHEMA)


def weights_to_milligrams(df: DataFrame, table: str, id_col: str, value_col: str, name_col: str, notes_col: str, units: tuple, densities: tuple) -> DataFrame:
    """One row for each weight above 0 of which name or notes give another unit than grams.

    Null, NaN, infinite, zero and negative weights are no cases.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _Worker.get(units, densities)
        for b in batches:
            out: list[list] = [[], [], [], []]
            for i, value, name, notes in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if value is None or not 0 < value < float("inf"):
                    continue
                key = ("w", name, notes)
                unit = w.memo[key] if key in w.memo else w.remember(key, w.weights.unit(name, notes))
                if unit is not None and not unit.is_gram:
                    out[1].append(i)
                    out[3].append(half_up(unit.of(exact(value)).value * 1000))
            out[0], out[2] = [table] * len(out[1]), [value_col] * len(out[1])
            yield _batch(out)

    return spread(df.select(id_col, value_col, name_col, notes_col)).mapInArrow(run, SCHEMA)
