"""Rows that fail to parse, apart from those that load (problem 5).

A recursive-descent grammar of measure lines::

    line    = cell ("," cell)*
    cell    = quoted | plain
    quoted  = '"' (char | '""')* '"'      followed by "," or the end
    plain   = (any but "," and '"')*
    measure = blank* ("0" | digits [("." | ",") digits] " "* unit) blank*

A syntax error names its place, and the parser recovers from it: after a broken
quote it resumes at the next record-start anchor (``RecordGrammar.records``). What
an anchor is depends on the form of the file:

* Where a record is a line, as in a table of lines, every line start is an anchor:
  a quote that isn't closed on its line is broken, costs that line, and the next
  one is parsed afresh. So lines may come in any order, and a file that holds most
  of them needs no task of its own.
* Where quoted cells may run over line ends (``RecordGrammar.block``, for whole
  files), an open quote goes on over the lines up to its end; if that gives no
  record, the quote is broken, and the parser resumes at the first later line that
  is validated as a record: it has the header's number of cells, each of them a
  measure of its column.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramsmith.operators.units import MEMO
from gramsmith.session import broadcast_if_small, spread

SCHEMA = "record_table string, record_id bigint, reason string"
_OUT = pa.schema([("record_table", pa.string()), ("record_id", pa.int64()), ("reason", pa.string())])


class MeasureRule:
    """Which cells are valid measures, by ingredient (in lower case)."""

    def __init__(self, units: tuple):
        by: dict[str | None, list[str]] = {}
        for name, kind, _factor, only in units:
            if name is not None:
                by.setdefault((only or "").strip().lower() if kind == "whole" else None, []).append(name.lower())
        self.by, self.rules, self.memo = by, {}, {}

    def rule(self, ingredient: str) -> re.Pattern:
        if ingredient not in self.rules:
            names = sorted(self.by.get(None, []) + self.by.get(ingredient, []), key=len, reverse=True)
            self.rules[ingredient] = re.compile(r"\s*(?:0|([0-9]+(?:[.,][0-9]+)?) *(" + ("|".join(map(re.escape, names)) or "(?!)") + r"))\s*")
        return self.rules[ingredient]

    def valid(self, cell: str, ingredient: str) -> bool:
        return self.typed(cell, ingredient) is not None

    def typed(self, cell: str, ingredient: str) -> tuple[float, str] | None:
        """The value and the unit of a valid measure; a bare 0 is in grams."""
        key = (cell, ingredient)
        if key not in self.memo:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            m = self.rule(ingredient).fullmatch(cell.lower())
            self.memo[key] = m and ((0.0, "g") if m[1] is None else (float(m[1].replace(",", ".")), m[2]))
        return self.memo[key]


@dataclass(frozen=True)
class SyntaxFault:
    reason: str
    line: int
    column: int


class LineGrammar:
    """Cells of a line by recursive descent."""

    def cells(self, line: str, nr: int = 1) -> list[str] | SyntaxFault:
        if '"' not in line:
            return line.split(",")
        cells, at = [], 0
        while True:
            got = self._quoted(line, at) if line.startswith('"', at) else self._plain(line, at)
            if got is None:
                return SyntaxFault("quoting", nr, at)
            cell, at = got
            cells.append(cell)
            if at == len(line):
                return cells
            at += 1  # the comma

    @staticmethod
    def _quoted(line: str, at: int) -> tuple[str, int] | None:
        end = at + 1
        while (end := line.find('"', end)) >= 0:
            if line.startswith('""', end):
                end += 2
                continue
            after = end + 1
            return (line[at + 1 : end].replace('""', '"'), after) if after == len(line) or line[after] == "," else None
        return None

    @staticmethod
    def _plain(line: str, at: int) -> tuple[str, int] | None:
        end = line.find(",", at)
        end = len(line) if end < 0 else end
        cell = line[at:end]
        return None if '"' in cell else (cell, end)


class RecordGrammar:
    """Typed records and located faults of measure lines, given their header."""

    def __init__(self, rule: MeasureRule):
        self.rule, self.lines, self.headers = rule, LineGrammar(), {}

    def header(self, raw: str | None) -> list[str] | None:
        """Ingredients by column; None without a header or with a broken one."""
        if raw not in self.headers:
            if len(self.headers) >= MEMO:
                self.headers.clear()
            cells = self.lines.cells(raw) if raw is not None else None
            self.headers[raw] = [c.strip().lower() for c in cells] if isinstance(cells, list) else None
        return self.headers[raw]

    def record(self, text: str, header: list[str] | None, nr: int = 1) -> list[tuple[float, str]] | SyntaxFault:
        """A typed record, or the first fault that applies; one of a file without a header has a wrong count."""
        cells = self.lines.cells(text, nr)
        if isinstance(cells, SyntaxFault):
            return cells
        if header is None or len(cells) != len(header):
            return SyntaxFault("column_count", nr, len(cells))
        out = []
        for k, (cell, name) in enumerate(zip(cells, header, strict=True)):
            if (t := self.rule.typed(cell, name)) is None:
                return SyntaxFault("value", nr, k)
            out.append(t)
        return out

    def fault(self, line: str, header: list[str] | None, nr: int = 1) -> SyntaxFault | None:
        got = self.record(line, header, nr)
        return got if isinstance(got, SyntaxFault) else None

    def records(self, lines: Iterable[tuple[str, list[str] | None, int]], over_lines: bool = False) -> Iterator[tuple[int, list[tuple[float, str]] | SyntaxFault]]:
        """The place of each record among the lines (text, header, number), and the record or its fault.

        Blank lines are skipped. With over_lines quoted cells may hold line ends.
        """
        lines = list(lines) if over_lines else lines
        resume = 0
        for at, (text, header, nr) in enumerate(lines):
            if at < resume or not text or not text.strip():
                continue
            got = self.record(text, header, nr)
            if over_lines and isinstance(got, SyntaxFault) and got.reason == "quoting":
                got, resume = self._over_lines(lines, at, got)
            yield at, got

    def _over_lines(self, lines: list, at: int, broken: SyntaxFault) -> tuple[list[tuple[float, str]] | SyntaxFault, int]:
        """The record that begins with an open quote on a line, line ends in it read as blanks, and the next line to be read; or the fault and the next anchor."""
        text, header, nr = lines[at]
        for end in range(at + 1, len(lines)):
            more = lines[end][0] or ""
            if '"' in more:
                whole = self.record(" ".join([text, *((x[0] or "") for x in lines[at + 1 : end + 1])]), header, nr)
                if not isinstance(whole, SyntaxFault) or whole.reason == "value":
                    return whole, end + 1
            if more.strip() and not isinstance(self.record(*lines[end]), SyntaxFault):
                return broken, end
        return broken, len(lines)

    def block(self, text: str) -> Iterator[list[tuple[float, str]] | SyntaxFault]:
        """A whole file, its first non-blank line the header: its typed records and its faults, in order.

        After a broken quote, lines up to the next anchor belong to the broken
        record.
        """
        lines = text.splitlines()
        first = next((k for k, x in enumerate(lines) if x.strip()), len(lines))
        head = self.header(lines[first]) if first < len(lines) else None
        for _, got in self.records([(x, head, n) for n, x in enumerate(lines[first + 1 :], first + 2)], over_lines=True):
            yield got


_kept: dict[tuple, RecordGrammar] = {}


def _grammar(units: tuple) -> RecordGrammar:
    if units not in _kept:
        _kept.clear()
        _kept[units] = RecordGrammar(MeasureRule(units))
    return _kept[units]


def _out(table: str, ids: list | pa.Array, reasons: list | str) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays([pa.array([table] * n, pa.string()), pa.array(ids, pa.int64()) if isinstance(ids, list) else ids.cast(pa.int64()), pa.array([reasons] * n if isinstance(reasons, str) else reasons, pa.string())], schema=_OUT)


def with_headers(lines: DataFrame) -> DataFrame:
    """Data lines with the header of their file (line_nr 1; of several, that of the smallest line_id).

    Headers are one row a file. They are broadcast if a count shows that there
    are few files; else the join shuffles by file, where AQE splits a file that
    holds a large share of the lines.
    """
    heads = lines.filter("line_nr = 1 AND file_name IS NOT NULL").groupBy(F.col("file_name").alias("head_file")).agg(F.min_by("raw_line", "line_id").alias("head_line"))
    body = spread(lines.filter("line_nr IS NULL OR line_nr <> 1").select("line_id", "raw_line", "file_name", "line_nr"))
    return body.join(broadcast_if_small(heads), F.col("file_name") == F.col("head_file"), "left").select("line_id", "raw_line", "head_line", "line_nr")


def bad_lines(lines: DataFrame, units: tuple, table: str = "measure_lines") -> DataFrame:
    """Non-blank lines other than headers that don't load, with the first reason that applies.

    Null and blank lines are neither loaded nor reported; repeated lines are
    reported each.
    """
    return judge_lines(with_headers(lines), units, table)


LOCATED = SCHEMA + ", line_nr int, place int"
_LOCATED = pa.schema([*_OUT, ("line_nr", pa.int32()), ("place", pa.int32())])


def located_faults(lines: DataFrame, units: tuple, table: str) -> DataFrame:
    """Faults with their place, of lines that have their header: line_id, raw_line, head_line, line_nr. A map, in batches and streams.

    place is the letter of a quoting fault, the number of cells of a wrong count,
    and the cell of an invalid value, each from 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = _grammar(units)
        for b in batches:
            ids, texts, heads, nrs = (b.column(k).to_pylist() for k in range(4))
            found = [(at, f) for at, f in g.records((t, g.header(h), n or 0) for t, h, n in zip(texts, heads, nrs, strict=True)) if isinstance(f, SyntaxFault)]
            columns = [[table] * len(found), [ids[at] for at, _ in found], [f.reason for _, f in found], [nrs[at] for at, _ in found], [f.column for _, f in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _LOCATED.types, strict=True)], schema=_LOCATED)

    return lines.mapInArrow(run, LOCATED)


def judge_lines(lines: DataFrame, units: tuple, table: str) -> DataFrame:
    """The faults of lines that have their header, without their place."""
    return located_faults(lines, units, table).select("record_table", "record_id", "reason")


def good_lines(lines: DataFrame, units: tuple) -> DataFrame:
    """The lines that load, as typed cells: line_id, and place, ingredient, value, unit of each cell."""
    schema = pa.schema([("line_id", pa.int64()), ("place", pa.int32()), ("ingredient", pa.string()), ("value", pa.float64()), ("unit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = _grammar(units)
        for b in batches:
            rows = []
            ids, texts, heads = (b.column(k).to_pylist() for k in range(3))
            for at, record in g.records((t, g.header(h), 0) for t, h in zip(texts, heads, strict=True)):
                if not isinstance(record, SyntaxFault):
                    rows += [(ids[at], k, n, *cell) for k, (cell, n) in enumerate(zip(record, g.header(heads[at]), strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, schema.types, strict=True)], schema=schema)

    return with_headers(lines).mapInArrow(run, "line_id bigint, place int, ingredient string, value double, unit string")


def bad_cells(df: DataFrame, table: str, id_col: str, columns: dict[str, str], units: tuple) -> DataFrame:
    """Rows with a non-null cell that is no valid measure, once a row. columns: ingredient by column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = _grammar(units).rule
        for b in batches:
            bad = None
            for k, ingredient in enumerate(columns.values(), 1):
                col = b.column(k)
                failing = [c for c in pc.unique(col).to_pylist() if c is not None and not rule.valid(c, ingredient)]
                mask = pc.is_in(col, value_set=pa.array(failing, col.type))
                bad = mask if bad is None else pc.or_(bad, mask)
            yield _out(table, b.column(0).filter(bad), "value")

    return spread(df.select(id_col, *columns)).mapInArrow(run, SCHEMA)
