"""Evaluation passages in corpus texts (problem 7).

Template canonicalisation: the words of an item are replaced by typed
placeholders where they are numbers, units or names; windows of WINDOW such
words are the keys of a hash table. A document's windows are looked up in it,
and every hit is a candidate for an item and an alignment. What stood in the
slots is then checked for consistency: the identity for passages that leaked
word for word, a mapping of slot values that is a function for re-parameterised
ones. Exact runs are extended and joined over one exchanged, dropped or added
word.

No leak is lost: of SPAN words with one change, WINDOW = 6 unchanged words in a
row remain (11 or 12 words in two runs), so some window is equal in the item and
in the document.

The items are a stated query set. They go to the workers in blocks of a checked
size; documents are read once a block, in place, and no window is shuffled.
"""

from __future__ import annotations

import html
import unicodedata
import uuid
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramsmith.session import SMALL_ROWS, spread

SPAN = 12
WINDOW = 6
#: Letters of an item that a block reckons with; longer items make smaller blocks.
LETTERS = 1000
# Of any length where attributes follow its name; a bracket within prose that happens to be closed much later is no tag.
_TAG = regex.compile(r"</?[a-zA-Z](?:[^<>]{0,200}|[\w:.\-]*(?:\s+[\w:@.\-]+)*\s*=[^<>]*)>|<!--.*?-->", regex.S)
# Words with inner hyphens and apostrophes are one word; underscores are markup.
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+(?:['’\-‐‑­][\p{L}\p{M}\p{N}]+)*")
_INNER = regex.compile(r"['’\-‐‑­]|\p{M}")

# Words of numbers and of units.
NUMBER_WORDS = set(
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand dozen half".split()
)
UNIT_WORDS = set(
    "g gram grams kg kilogram kilograms mg oz ounce ounces lb lbs pound pounds ml millilitre millilitres milliliter milliliters cl centilitres dl decilitre decilitres deciliter deciliters l litre litres liter liters cup cups tablespoon tablespoons teaspoon teaspoons spoon spoons ladle ladles drop drops pinch pinches sack sacks portion portions pint pints gallon gallons".split()
)
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"


def words(text: str, strip_markup: bool = True) -> list[str]:
    """Words without case, marks, inner hyphens and apostrophes, markup and invisible characters."""
    if strip_markup:
        if "&" in text:
            text = html.unescape(text)
        if "<" in text:
            text = _TAG.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).replace("­", "").replace("​", "").replace("﻿", "")
        return [_INNER.sub("", w) for w in _WORD.findall(text.casefold())]
    return [w if w.isalnum() else _INNER.sub("", w) for w in _WORD.findall(text.lower())]


def names(text: str) -> set[str]:
    """Words that are capitalised within a sentence."""
    return {w for m in regex.finditer(r"(?<=[\p{Ll}\d,;] )\p{Lu}[\p{Ll}\p{M}]+", unicodedata.normalize("NFC", text)) for w in words(m[0])}


def kind(word: str, known_names: set[str]) -> str:
    """The typed placeholder of a word, or the word."""
    if word.isdigit() or word in NUMBER_WORDS or _compound_number(word):
        return NUMBER
    if word in UNIT_WORDS:
        return UNIT
    return NAME if word in known_names else word


_TENS = tuple("twenty thirty forty fifty sixty seventy eighty ninety".split())


def _compound_number(word: str) -> bool:
    return any(word.startswith(t) and word[len(t) :] in NUMBER_WORDS for t in _TENS)


class TemplateIndex:
    """Windows of canonical words of a block of items, and the items' words."""

    def __init__(self, items: list[tuple[int, str]]):
        raw = [(i, t, words(t)) for i, t in items if t]
        self.names = set().union(*(names(t) for _, t, _ in raw)) if raw else set()
        self.code: dict[str, int] = {}
        self.exact: dict[str, int] = {}
        self.items: list[tuple[int, list[int], list[int]]] = []
        self.windows: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for i, _, ws in raw:
            canon = [self.code.setdefault(kind(w, self.names), len(self.code)) for w in ws]
            exact = [self.exact.setdefault(w, len(self.exact)) for w in ws]
            self.items.append((i, canon, exact))
            for at in range(len(ws) - WINDOW + 1):
                self.windows.setdefault(tuple(canon[at : at + WINDOW]), []).append((len(self.items) - 1, at))
        self.of_word = {w: (self.code[kind(w, self.names)], e) for w, e in self.exact.items()}

    def read(self, text: str) -> tuple[list[int], list[int]]:
        """Codes of the canonical and of the exact words of a text; negative where no item has the word.

        Slot words that no item has get a code each, so that equal ones can be told from different ones.
        """
        canon, exact = [], []
        new: dict[str, int] = {}
        of, code = self.of_word, self.code
        for w in words(text):
            if (c := of.get(w)) is None:
                c = code.get(kind(w, self.names), -1)
                c = (c, -2 if c < 0 else new.setdefault(w, -3 - len(new)))
            canon.append(c[0])
            exact.append(c[1])
        return canon, exact

    def hits(self, canon: list[int]) -> Iterator[tuple[int, int, int]]:
        """Item, place in the item and place in the text of each window that both have."""
        start = 0
        n = len(canon)
        while start < n:
            if canon[start] < 0:
                start += 1
                continue
            end = start
            while end < n and canon[end] >= 0:
                end += 1
            for at in range(start, end - WINDOW + 1):
                for item, place in self.windows.get(tuple(canon[at : at + WINDOW]), ()):
                    yield item, place, at
            start = end

    def runs(self, canon: list[int]) -> Iterator[tuple[int, int, int, int]]:
        """Item, first place and place after the last in the item, and shift to the text, of each maximal run of canonical words that holds a window."""
        reach: dict[tuple[int, int], int] = {}
        for item, place, at in self.hits(canon):
            diagonal = (item, at - place)
            if reach.get(diagonal, -1) > at:
                continue
            low, high = _run(self.items[item][1], canon, place, at)
            reach[diagonal] = high + at - place
            yield item, low, high, at - place

    def leaks(self, text: str) -> list[int]:
        """Items that leak: runs of template windows whose slots hold the item's own values, with one change at most."""
        canon, exact = self.read(text)
        found: set[int] = set()
        for item, low, high, shift in self.runs(canon):
            if item in found:
                continue
            mine = self.items[item][2]
            for first, last in _identical(mine, exact, low, high, shift):
                if _long_enough(mine, exact, first, last, shift):
                    found.add(item)
                    break
        return sorted({self.items[k][0] for k in found})

    def templates(self, text: str, whole_runs: bool = True) -> list[tuple[int, int]]:
        """Items of which SPAN canonical words stand in the text with consistent slots, and how many slot values differ.

        With whole_runs the slots are those of the whole run of canonical words that both have: a run in which one value
        became several is no instance, even if SPAN words of it would be consistent. Without, each longest consistent
        stretch of a run is one. Of several the one with the fewest changes counts.
        """
        canon, exact = self.read(text)
        best: dict[int, int] = {}
        for item, low, high, shift in self.runs(canon):
            if high - low < SPAN:
                continue
            slots = [(self.items[item][2][k], exact[k + shift], self.items[item][1][k]) for k in range(low, high)]
            for first, last in [(0, high - low)] if whole_runs else _stretches(slots):
                changed = _consistent(slots[first:last])
                if changed is not None:
                    best[item] = min(changed, best.get(item, changed))
        return sorted((self.items[k][0], n) for k, n in best.items())


def _identical(mine: list[int], theirs: list[int], low: int, high: int, shift: int) -> Iterator[tuple[int, int]]:
    """The parts of WINDOW words or more of a canonical run in which all slots hold the same values."""
    first = low
    for k in range(low, high + 1):
        if k == high or mine[k] != theirs[k + shift]:
            if k - first >= WINDOW:
                yield first, k
            first = k + 1


def _consistent(slots: list[tuple[int, int, int]]) -> int | None:
    """How many distinct slot values differ, or None if one value became several."""
    became: dict[tuple[int, int], int] = {}
    for mine, theirs, typed in slots:
        if became.setdefault((typed, mine), theirs) != theirs:
            return None
    return sum(m != t for (_, m), t in became.items())


def _stretches(slots: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The longest stretches of SPAN slots or more in which no value became several; two places move along the run."""
    last_other: dict[tuple[int, int], tuple[int, int]] = {}  # what a value became last, and the last place where it was something else
    first = 0
    for k, (mine, theirs, typed) in enumerate(slots):
        key = (typed, mine)
        now, other = last_other.get(key, (theirs, -1))
        if now != theirs:
            other = max(j for j in range(k) if slots[j][0] == mine and slots[j][2] == typed)
            if other >= first:
                if k - first >= SPAN:
                    yield first, k
                first = other + 1
        last_other[key] = (theirs, other)
    if len(slots) - first >= SPAN:
        yield first, len(slots)


def _run(a: list[int], b: list[int], i: int, j: int) -> tuple[int, int]:
    """The maximal equal run through (i, j): its first place in a and the place after its last."""
    low, high, shift = i, i, j - i
    while low > 0 and low + shift > 0 and a[low - 1] == b[low - 1 + shift]:
        low -= 1
    while high < len(a) and high + shift < len(b) and a[high] == b[high + shift]:
        high += 1
    return low, high


def _forward(a: list[int], b: list[int], i: int, j: int) -> int:
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    return n


def _backward(a: list[int], b: list[int], i: int, j: int) -> int:
    n = 0
    while i - n >= 0 and j - n >= 0 and a[i - n] == b[j - n]:
        n += 1
    return n


def _long_enough(a: list[int], b: list[int], low: int, high: int, shift: int) -> bool:
    """SPAN words of the item in a row, one exchanged, dropped or added at most, between kept words."""
    n = high - low
    if n >= SPAN:
        return True
    # A dropped word that equals its neighbour leaves no gap behind which words could follow.
    if n + 1 >= SPAN and (high < len(a) and a[high] == a[high - 1] or low > 0 and a[low - 1] == a[low]):
        return True
    for di, dj in ((1, 1), (1, 0), (0, 1)):
        more = _forward(a, b, high + di, high + shift + dj)
        if more and n + di + more >= SPAN:
            return True
        more = _backward(a, b, low - 1 - di, low + shift - 1 - dj)
        if more and n + di + more >= SPAN:
            return True
    return False


_kept: dict[str, TemplateIndex] = {}


def _index(key: str, items: list[tuple[int, str]]) -> TemplateIndex:
    if key not in _kept:
        _kept.clear()
        _kept[key] = TemplateIndex(items)
    return _kept[key]


def _blocks(items: DataFrame, item_id: str, item_text: str, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of a bounded number of rows and letters."""
    rows = items.select(item_id, item_text).filter(F.col(item_text).isNotNull() & F.col(item_id).isNotNull())
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(item_text)), F.lit(0)).alias("letters")).first()
    parts = max(1, -(-size["n"] // max(1, limit // 2)), -(-size["letters"] // (limit * LETTERS)))
    for k in range(parts):
        block = rows if parts == 1 else rows.filter(F.pmod(F.xxhash64(item_id), F.lit(parts)) == k)
        yield [(r[0], r[1]) for r in block.collect()]


def _search(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, limit: int, schema: str, out: pa.Schema, per_text) -> DataFrame:
    result = None
    for block in _blocks(items, item_id, item_text, limit):
        shared, key = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            index = _index(key, shared.value)
            for b in batches:
                rows = []
                for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if t and i is not None:
                        rows += [(i, *r) for r in per_text(index, t)]
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*rows, strict=True) if rows else [[]] * len(out.types), out.types, strict=True)], schema=out)

        part = spread(docs.select(doc_id, text)).mapInArrow(run, schema)
        result = part if result is None else result.unionByName(part)
    return result


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, limit: int = SMALL_ROWS) -> DataFrame:
    """doc_id and item_id wherever a text contains SPAN consecutive words of an item, one changed at most.

    Null ids and null or empty texts have no leaks; items shorter than SPAN words
    leak nowhere; an id that occurs twice is reported for each of its rows, pairs
    once a row. Texts of any length are read whole.
    """
    out = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64())])
    return _search(docs, doc_id, text, items, item_id, item_text, limit, "doc_id bigint, item_id bigint", out, lambda index, t: [(i,) for i in index.leaks(t)])


def templates(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, limit: int = SMALL_ROWS, whole_runs: bool = True) -> DataFrame:
    """doc_id, item_id and changed: SPAN words of an item's template with consistent slots, and how many slot values differ.

    whole_runs: as in ``TemplateIndex.templates``. Nulls and repeats as in ``leaks``.
    """
    out = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("changed", pa.int32())])
    return _search(docs, doc_id, text, items, item_id, item_text, limit, "doc_id bigint, item_id bigint, changed int", out, lambda index, t: index.templates(t, whole_runs))
