"""A grammar of amounts and an algebra of their units.

An amount is an exact fraction times a unit; a unit is a scale and an offset
over the canonical units gram, millilitre and piece, with the exponents of
mass, volume and count as its dimension. Densities (mass / volume) and weights
of a piece (mass / count) are quantities too, so that every conversion to grams
is a product whose exponents must come out as (1, 0, 0).

Grammar of a cell, after NFKC and case folding::

    cell    = noise* amount (joiner amount)* trailer
    amount  = number [unit ["."]]
    number  = whole fraction | decimal | fraction | word-number
    joiner  = "och" | "and" | "plus" | "+" | "&"

What follows the last amount is a description and changes nothing. A cell in
which no number comes before other content words gives no amount.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

Dim = tuple[int, int, int]
MASS: Dim = (1, 0, 0)
VOLUME: Dim = (0, 1, 0)
COUNT: Dim = (0, 0, 1)
DENSITY: Dim = (1, -1, 0)
PER_PIECE: Dim = (1, 0, -1)


def exact(value: float | int | str) -> Fraction:
    """The decimal value as written: 0.1 is a tenth."""
    return Fraction(Decimal(str(value)))


@dataclass(frozen=True)
class Quantity:
    value: Fraction
    dim: Dim

    def __mul__(self, other: Quantity) -> Quantity:
        return Quantity(self.value * other.value, tuple(a + b for a, b in zip(self.dim, other.dim, strict=True)))

    def __add__(self, other: Quantity) -> Quantity:
        if self.dim != other.dim:
            raise ValueError("quantities of different dimensions have no sum")
        return Quantity(self.value + other.value, self.dim)


@dataclass(frozen=True)
class Unit:
    """value in this unit * scale + offset = value in the canonical unit of dim."""

    name: str
    dim: Dim
    scale: Fraction
    offset: Fraction = Fraction(0)
    only: str | None = None

    def of(self, number: Fraction) -> Quantity:
        return Quantity(number * self.scale + self.offset, self.dim)

    @property
    def is_gram(self) -> bool:
        return self.dim == MASS and self.scale == 1 and self.offset == 0


KIND_DIM = {"weight": MASS, "volume": VOLUME, "whole": COUNT}


class Units:
    """The units of a table measure_unit and the densities of a table ingredient.

    A whole unit is a count; its weight of a piece is kept by ingredient.
    """

    def __init__(self, units: Iterable[tuple], densities: Iterable[tuple] = ()):
        self.by_name: dict[str, Unit] = {}
        self.piece: dict[tuple[str, str], Quantity] = {}
        for name, kind, factor, only in units:
            if name is None or kind not in KIND_DIM or factor is None:
                continue
            key = fold(name)
            if kind == "whole":
                self.by_name[key] = Unit(key, COUNT, Fraction(1), only=fold(only) if only else None)
                self.piece[key, fold(only or "")] = Quantity(exact(factor), PER_PIECE)
            else:
                self.by_name[key] = Unit(key, KIND_DIM[kind], exact(factor))
        self.density = {fold(n): Quantity(exact(d), DENSITY) for n, d in densities if n is not None and d is not None}
        names = sorted(self.by_name, key=len, reverse=True)
        self.pattern = "|".join(re.escape(n).replace(r"\ ", r"\s+") for n in names) or r"(?!)"

    def unit(self, name: str) -> Unit | None:
        return self.by_name.get(" ".join(name.split()))

    def applies(self, unit: Unit, ingredient: str) -> bool:
        return unit.dim != COUNT or (unit.name, ingredient) in self.piece

    def grams(self, amount: Quantity, unit: Unit, ingredient: str) -> Fraction | None:
        """None where the registry has no factor that leads to mass."""
        if amount.dim == VOLUME:
            factor = self.density.get(ingredient)
        elif amount.dim == COUNT:
            factor = self.piece.get((unit.name, ingredient))
        else:
            return amount.value
        if factor is None:
            return None
        product = amount * factor
        return product.value if product.dim == MASS else None


def fold(text: str) -> str:
    """Compatibility forms, case and outer blanks don't count."""
    return unicodedata.normalize("NFKC", text.replace("⁄", "/")).casefold().strip()


def half_up(value: Fraction) -> int:
    return (2 * value.numerator + value.denominator) // (2 * value.denominator)


# Number words of the two languages.
NUMBER_WORDS = {
    "en": 1, "ett": 1, "två": 2, "tre": 3, "fyra": 4, "fem": 5, "sex": 6, "sju": 7, "åtta": 8, "nio": 9, "tio": 10, "elva": 11, "tolv": 12,
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12,
}
# Words that stand before an amount without changing it.
NOISE_WORDS = ["cirka", "circa", "ca", "c:a", "about", "approx", "approximately", "around", "roughly", "drygt", "knappt", "ungefär", "omkring", "~", "≈"]

_VULGAR = {c: unicodedata.numeric(c) for c in "¼½¾⅐⅑⅒⅓⅔⅕⅖⅗⅘⅙⅚⅛⅜⅝⅞"}
_VULGAR_EXACT = {c: Fraction(n).limit_denominator(10) for c, n in _VULGAR.items()}
_WORD = "|".join(sorted(NUMBER_WORDS, key=len, reverse=True))


class CellGrammar:
    """Parses cells by recursive descent; one instance for a registry of units."""

    def __init__(self, units: Units):
        self.units = units
        self.noise = re.compile(r"(?:(?:" + "|".join(re.escape(w) for w in NOISE_WORDS) + r")\.?\s*)+")
        self.half = re.compile(r"(?:half(?:\s+an?)?|en\s+halv|ett\s+halvt|halv)(?!\w)")
        self.word = re.compile(rf"({_WORD})(?:\s+(?:och\s+en\s+halv|och\s+ett\s+halvt|and\s+a\s+half)|\s+(och\s+en\s+kvarts|and\s+a\s+quarter))?(?!\w)")
        self.mixed = re.compile(r"(\d+)\s+(\d+)\s*/\s*(\d+)")
        self.mixed_vulgar = re.compile(rf"(\d*)\s*([{''.join(_VULGAR)}])")
        self.fraction = re.compile(r"(\d+)\s*/\s*(\d+)")
        self.decimal = re.compile(r"\d+(?:[.,]\d+)?|[.,]\d+")
        self.unit_at = re.compile(rf"\s*({self.units.pattern})(?!\w)\.?")
        self.joiner = re.compile(r"\s*(?:(?:och|and|plus)(?!\w)|[+&])\s*")

    def number(self, text: str, at: int) -> tuple[Fraction, int] | None:
        if m := self.mixed.match(text, at):
            whole, top, bottom = map(int, m.groups())
            return (Fraction(whole) + Fraction(top, bottom), m.end()) if bottom else None
        if m := self.mixed_vulgar.match(text, at):
            return Fraction(int(m[1] or 0)) + _VULGAR_EXACT[m[2]], m.end()
        if m := self.fraction.match(text, at):
            return (Fraction(int(m[1]), int(m[2])), m.end()) if int(m[2]) else None
        if m := self.decimal.match(text, at):
            return Fraction(Decimal(m[0].replace(",", "."))), m.end()
        if m := self.half.match(text, at):
            return Fraction(1, 2), m.end()
        if m := self.word.match(text, at):
            more = Fraction(1, 4) if m[2] else Fraction(1, 2) if m.end() > m.end(1) else Fraction(0)
            return NUMBER_WORDS[m[1]] + more, m.end()
        return None

    def amount(self, text: str, at: int) -> tuple[Fraction, Unit | None, int] | None:
        if not (n := self.number(text, at)):
            return None
        value, end = n
        if m := self.unit_at.match(text, end):
            return value, self.units.unit(m[1]), m.end()
        return value, None, end

    def cell(self, raw: str) -> list[tuple[Fraction, Unit | None]]:
        """The amounts of a cell, in order; none if it gives no amount.

        A number that runs into something which is no unit (a letter, a range, a
        second point, a per cent sign) isn't an amount.
        """
        text = _clean(raw)
        at = m.end() if (m := self.noise.match(text)) else 0
        found: list[tuple[Fraction, Unit | None]] = []
        while a := self.amount(text, at):
            value, unit, end = a
            if unit is None and re.match(r"[.,\-–]?\d|\s*[%:/–-]|\s*[^\W\d_]", text[end:]) and not (not found and self._described(text, end)):
                break
            if re.match(r"\s*[-–]\s*\d", text[end:]):
                return []
            found.append((value, unit))
            at = end
            if not (m := self.joiner.match(text, at)):
                break
            at = m.end()
        return found

    @staticmethod
    def _described(text: str, end: int) -> bool:
        """A blank and a word after a number without a unit: the word describes the amount."""
        return re.match(r"\s+[^\W\d_]", text[end:]) is not None


def _clean(raw: str) -> str:
    # Vulgar fractions are kept: NFKC would turn 1½ into 11/2.
    parts = [c if c in _VULGAR else unicodedata.normalize("NFKC", c) for c in raw.replace("⁄", "/")]
    return " ".join(unicodedata.normalize("NFC", "".join(parts)).casefold().split())
