"""Freely typed names to the entries of a reference list (problem 4).

Token-level repair: each distinct token of the names is joined to the
vocabulary of the reference by edit distance. Tokens and words meet on keys that
no pair within the allowed number of errors can miss (see ``word_keys``), and
Damerau–Levenshtein confirms them; a token with vowels left out meets its word on
the consonants. The corrected tokens are then combined by soft TF-IDF to rank
whole entries.

A name means an entry if nearly all of the entry's weight is found in it and
nothing of weight is left over but words of wrapping (organic, about 2 dl, …); or
if what stands before the entry's comma is found, and no other entry begins so.

There is one path for references of every size. Distinct tokens, words, names
and entries meet in joins; a side is broadcast only where a count shows that it
is small, and that changes nothing but the physical join. An entry is opened only
by its rarest tokens, without one of which it can't win (see ``_postings``), so a
common token doesn't open all its entries. A distinct name is scored once, in
rows of a name and an entry that are never gathered in one task. Counts, weights
and unique beginnings are those of the whole reference.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramsmith.session import SMALL_ROWS, broadcast_if_small, dealt, spread, written

MEMO = 200_000
#: Parts of an entry's weight that must be found, and of a name's weight that must be used.
COVERED = 0.84
USED = 0.70
TYPO_COST = 0.12
#: The least similarity of neighbours that are joined to one token: two errors, or vowels left out.
TOGETHER = 0.75
# A hyphenated word is one token, and so is one with an apostrophe.
_TOKEN = regex.compile(r"\p{L}+(?:[-'’‐‑]\p{L}+)*|\p{N}+")
_VOWELS = set("aeiouyåäö")

# Words that wrap a name without changing what it means.
WRAPPING = set(
    "eko ekologisk organic fresh färsk good some about ca cirka or similar eller liknande divided delad x dl cl ml l g kg hg gr gram grams msk tsk krm cup cups tbsp tsp oz lb st and och of a an the extra optional to taste for topping baking serving".split()
)


def plain(text: str) -> str:
    """Case and diacritical marks don't count."""
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))


_WRAPPING = {plain(w) for w in WRAPPING}


def tokens(text: str) -> list[str]:
    return [t for w in _TOKEN.findall(plain(text)) if (t := w if w.isalnum() else "".join(c for c in w if c.isalnum()))]


def distance(a: str, b: str, limit: int) -> int:
    """Damerau–Levenshtein with adjacent transpositions; limit + 1 if it is more than that."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > limit:
            return limit + 1
        before, row = row, new
    return min(row[-1], limit + 1)


def allowed(length: int) -> int:
    """Typing errors that a token of a length may have."""
    return 0 if length < 3 else 1 if length < 6 else 2 if length < 9 else 3


def deletions(word: str, n: int) -> set[str]:
    """What is left of a word after n deletions at most; each choice of letters is made once, from left to right."""
    found, last = {word}, [(word, 0)]
    for _ in range(n):
        last = [(w[:k] + w[k + 1 :], k) for w, at in last for k in range(at, len(w))]
        found.update([w for w, _ in last])
    return found


def skeleton(word: str) -> str:
    return "".join(c for c in word if c not in _VOWELS)


#: Words up to this length meet on deletions, longer ones on pieces.
SHORT = 20
ERRORS = 3  # the most that allowed() gives
PIECES = 2 * ERRORS + 1


def word_keys(word: str) -> set[str]:
    """Keys of a word of the vocabulary; every token it may stand for has one of them in ``token_keys``.

    Short words: all that is left after as many deletions as errors are allowed.
    With d errors (a transposition is one) a token and a word have a string in
    common that each gives after d deletions. Long words: seven pieces by place.
    Three errors touch six pieces at most, as one error touches two neighbours at
    most, so one piece stands unchanged, moved by three letters at most. Besides,
    the consonants.
    """
    keys = {"s" + skeleton(word)}
    if len(word) <= SHORT:
        return keys | {"d" + x for x in deletions(word, allowed(len(word)))}
    cuts = _cuts(len(word))
    return keys | {f"p{k} {word[a:b]}" for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}


def token_keys(token: str, longest: int, most: int = ERRORS) -> set[str]:
    """Keys of a typed token with ``most`` errors; longest: the length of the longest word of the vocabulary."""
    keys = set()
    if len(token) >= 3 and len(bones := skeleton(token)) >= 2:
        keys.add("s" + bones)
    if len(token) > longest + ERRORS:
        return keys
    if len(token) <= SHORT + ERRORS:
        keys |= {"d" + x for x in deletions(token, min(most, allowed(len(token) + 1)))}
    for n in range(max(SHORT + 1, len(token) - ERRORS), min(longest, len(token) + ERRORS) + 1):
        cuts = _cuts(n)
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            keys |= {f"p{k} {token[a + m : b + m]}" for m in range(-min(ERRORS, a), ERRORS + 1)}
    return keys


def _cuts(length: int) -> list[int]:
    return [length * k // PIECES for k in range(PIECES + 1)]


def similarity(token: str, word: str) -> float:
    """How well a typed token stands for a word of the vocabulary; 0 if it doesn't."""
    if token == word:
        return 1.0
    found = 0.0
    most = allowed(min(len(word), len(token) + 1))
    if most and (d := distance(token, word, most)) <= most:
        found = 1 - TYPO_COST * d * (1 if len(word) > 5 else 1.5)
    if len(token) >= 3 and len(bones := skeleton(token)) >= 2 and bones == skeleton(word) and _shortened(token, word):
        found = max(found, 0.85)
    return found


class Vocabulary:
    """The tokens of a reference in memory; finds those that a typed token may stand for. For small lists and tests."""

    def __init__(self, words: set[str]):
        self.words, self.longest = words, max(map(len, words), default=0)
        self.by_key: dict[str, list[str]] = {}
        for w in sorted(words):
            for key in word_keys(w):
                self.by_key.setdefault(key, []).append(w)

    def repairs(self, token: str) -> dict[str, float]:
        """Vocabulary tokens with their similarity to a typed token."""
        if token in self.words:
            return {token: 1.0}
        near = {w for key in token_keys(token, self.longest) for w in self.by_key.get(key, ())}
        return {w: s for w in near if (s := similarity(token, w))}


def _shortened(token: str, word: str) -> bool:
    """token is word with vowels left out."""
    it = iter(word)
    return len(token) < len(word) and all(c in it for c in token)


class Entry:
    """An entry of the reference as the scoring reads it, packed in one text: it travels through joins as a column."""

    __slots__ = ("head", "heavy", "id", "total", "unique", "weights")

    def __init__(self, packed: str):
        i, unique, unknown, *words = packed.split(" ")
        self.id, self.unique = int(i), unique == "1"
        self.weights: dict[str, float] = {}
        self.head: set[str] = set()
        for w in words:
            mark, word, weight = w[0], *w[1:].split("=")
            self.weights[word] = float(weight)
            if mark == "h":
                self.head.add(word)
        self.total = sum(self.weights.values())
        self.heavy = [w for w, x in self.weights.items() if x >= 0.5 * float(unknown)]

    @staticmethod
    def pack(i: int, unique: bool, unknown: float, weights: dict[str, float], head: set[str]) -> str:
        return " ".join([str(i), str(int(unique)), repr(unknown), *(f"{'h' if w in head else 't'}{w}={x!r}" for w, x in sorted(weights.items()))])


class Name:
    """A typed name with the repairs of its tokens, packed likewise.

    packed: the weight of an unknown token, and for each item its place, whether it is
    a pair of neighbours, the token, and its repairs word=similarity=weight.
    """

    __slots__ = ("found", "left", "typed", "words")

    def __init__(self, packed: str):
        unknown, *items = packed.split(" ")
        unknown = float(unknown)
        single: dict[int, tuple[str, dict[str, float]]] = {}
        pairs: dict[int, tuple[str, dict[str, float]]] = {}
        weights: dict[str, float] = {}
        for item in items:
            place, token, *words = item.split("|")
            repairs = {}
            for w in words:
                word, like, weight = w.split("=")
                repairs[word], weights[word] = float(like), float(weight)
            if token in repairs:
                repairs = {token: 1.0}
            (pairs if place[0] == "p" else single)[int(place[1:])] = token, repairs
        self.typed, self.found = _compounds(single, pairs)
        self.words = set().union(*self.found)
        self.left = [
            0.0 if t in _WRAPPING or t.isdigit() or len(t) == 1 else max((weights[w] for w in r), default=unknown) for t, r in zip(self.typed, self.found, strict=True)
        ]


def _compounds(single: dict, pairs: dict) -> tuple[list[str], list[dict[str, float]]]:
    """Joins neighbours that together stand for a token of the reference, with two errors at most, for which neither stands alone."""
    typed, found, k = [], [], 0
    while k < len(single):
        token, repairs = single[k]
        if k in pairs and k + 1 in single:
            joined, together = pairs[k][0], {w: s for w, s in pairs[k][1].items() if s >= TOGETHER}
            if any(w not in repairs and w not in single[k + 1][1] for w in together):
                typed.append(joined)
                found.append(together)
                k += 2
                continue
        typed.append(token)
        found.append(repairs)
        k += 1
    return typed, found


def score(name: Name, entry: Entry) -> float:
    """How well a name means an entry; 0 if it doesn't."""
    typed, found, weights, head = name.typed, name.found, entry.weights, entry.head
    # Without the whole beginning neither it alone nor a rough match can count, so the repairs must cover enough.
    if not head <= name.words and sum([x for w, x in weights.items() if w in name.words]) < COVERED * entry.total * (1 - 1e-9):
        return 0.0
    best: dict[str, float] = {}
    taken = [False] * len(typed)
    pairs = [(-s, k, t) for k, r in enumerate(found) for t, s in r.items() if t in weights]
    pairs.sort()
    for s, k, t in pairs:
        if t not in best and not taken[k]:
            best[t], taken[k] = -s, True
    # Where the beginning is found, the rest may be a worse misspelling or shortening.
    if len(head) < len(weights) and len(best) < len(weights) and all(t in best for t in head):
        rest = sorted((-s, k, t) for k in range(len(typed)) if not taken[k] for t in weights if t not in best if (s := _rough(typed[k], t)))
        for s, k, t in rest:
            if t not in best and not taken[k]:
                best[t], taken[k] = -s, True
        for k in range(len(typed) - 1):  # a shortened token may be in two pieces
            if not taken[k] and not taken[k + 1]:
                for t in sorted(weights.keys() - best.keys()):
                    if s := _rough(typed[k] + typed[k + 1], t):
                        best[t], taken[k], taken[k + 1] = s, True, True
                        break
    whole = sum(weights[t] for t in best)
    if not whole:
        return 0.0
    # A token may be typed twice.
    left = sum(name.left[k] for k in range(len(typed)) if not taken[k] and not any(t in best for t in found[k]))
    got = sum(weights[t] * s for t, s in best.items())
    if whole >= COVERED * entry.total and all(t in best for t in entry.heavy) and got >= 0.6 * whole and whole >= USED * (whole + left):
        return got / math.sqrt(entry.total * (whole + left)) * (0.5 + 0.5 * got / whole)
    if entry.unique and head and head == best.keys() and left == 0 and got >= 0.7 * whole:
        return 0.9 * got / math.sqrt(entry.total * whole)
    return 0.0


def _rough(token: str, word: str) -> float:
    """0.6 downwards for a token that begins like a word and has nearly its consonants, or half of its letters wrong at most."""
    if token[0] != word[0] or token in _WRAPPING or len(token) < 2 or len(token) > len(word) + 2:
        return 0.0
    bones, wanted = skeleton(token), skeleton(word)
    if _shortened(token, word) and bones == wanted:
        return 0.6
    d = distance(bones, wanted, 2)
    if d <= (1 if len(wanted) < 6 else 2) and len(bones) >= 2:
        return 0.58 - 0.04 * d
    most = len(word) // 3 + 1
    d = distance(token, word, most)
    return 0.5 - 0.04 * d if d <= most and len(token) >= 4 else 0.0


# ---- The joins ----------------------------------------------------------------------------------


def _map(df: DataFrame, schema: str, out: pa.Schema, each: Callable[[pa.RecordBatch], Iterable[list]]) -> DataFrame:
    """A map of Arrow batches to the columns that ``each`` gives for a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(each(b), out.types, strict=True)], schema=out)

    return df.mapInArrow(run, schema)


def _keyed(names: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """synonym_id and key (the tokens of the name) of every row."""

    def each(b: pa.RecordBatch) -> list:
        return [b.column(0).cast(pa.int64()), [" ".join(tokens(x)) if x else "" for x in b.column(1).to_pylist()]]

    return _map(spread(names.select(id_col, name_col)), "synonym_id bigint, key string", pa.schema([("synonym_id", pa.int64()), ("key", pa.string())]), each)


def _entries(ref: DataFrame, ref_id: str, ref_name: str) -> DataFrame:
    """entry, key and head of each distinct entry that has a token."""

    def each(b: pa.RecordBatch) -> list:
        texts = b.column(1).to_pylist()
        return [b.column(0).cast(pa.int64()), [" ".join(tokens(x)) for x in texts], [" ".join(tokens(x.split(",")[0])) for x in texts]]

    rows = ref.filter(F.col(ref_id).isNotNull() & F.col(ref_name).isNotNull()).select(ref_id, ref_name)
    out = pa.schema([("entry", pa.int64()), ("key", pa.string()), ("head", pa.string())])
    return _map(rows, "entry bigint, key string, head string", out, each).filter("key <> ''").distinct()


def _near(searched: DataFrame, vocabulary: DataFrame, longest: int, limit: int) -> DataFrame:
    """token and its repairs (word=similarity=weight, packed) of searched tokens (token, most) that may stand for words of the vocabulary."""
    out = pa.schema([("token", pa.string()), ("hit", pa.string())])

    def of_words(b: pa.RecordBatch) -> list:
        rows = [(w, x, key) for w, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for key in word_keys(w)]
        return list(zip(*rows, strict=True)) if rows else [[], [], []]

    def of_tokens(b: pa.RecordBatch) -> list:
        texts = b.column(0).to_pylist()
        keys = [token_keys(t, longest, m) for t, m in zip(texts, b.column(1).to_pylist(), strict=True)]
        return [[t for t, ks in zip(texts, keys, strict=True) for _ in ks], [k for ks in keys for k in ks]]

    def of_pairs(b: pa.RecordBatch) -> list:
        rows = [(t, f"{w}={s!r}={x!r}") for t, w, x in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True) if (s := similarity(t, w))]
        return [[r[0] for r in rows], [r[1] for r in rows]]

    words = _map(vocabulary, "word string, weight double, hit string", pa.schema([("word", pa.string()), ("weight", pa.float64()), ("hit", pa.string())]), of_words)
    met = _map(dealt(searched, "token"), "token string, hit string", out, of_tokens).join(broadcast_if_small(words, limit), "hit").select("token", "word", "weight").distinct()
    near = _map(met, "token string, hit string", out, of_pairs)
    return near.groupBy("token").agg(F.array_join(F.sort_array(F.collect_list("hit")), "|").alias("repairs"))


def _postings(entries: DataFrame, vocabulary: DataFrame, unknown: float) -> DataFrame:
    """opener and the packed entry, for each opener of each entry.

    An entry can win only if one of its rarest tokens is found, so many of them
    that the others together don't reach the part that must be covered; or by its
    beginning alone. Such a token is found by repair (opener w + token), or only
    roughly, which takes a found beginning (opener h + the rarest token of the
    beginning + the first letter of the token).
    """
    spread_ = entries.select("entry", "key", "head", F.explode(F.array_distinct(F.split("key", " "))).alias("word"))
    weighed = spread_.join(vocabulary, "word")
    rows = weighed.groupBy("entry", "key", "head").agg(F.collect_list(F.struct("word", "weight")).alias("ws"))
    unique = entries.groupBy("head").agg((F.min("entry") == F.max("entry")).alias("is_unique"))
    rows = rows.join(unique, "head")
    out = pa.schema([("opener", pa.string()), ("packed", pa.string())])

    def each(b: pa.RecordBatch) -> list:
        openers, packed = [], []
        for i, key, first, ws, alone in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
            weights = {w["word"]: w["weight"] for w in ws}
            head = set(first.split()) if first else set()
            order = sorted(weights, key=lambda w: (-weights[w], w))
            rest, keys = sum(weights.values()), set()
            least = COVERED * rest * (1 - 1e-9)
            start = min(head, key=lambda w: (-weights[w], w), default=None)
            for w in order:
                keys.add("w" + w)
                if start is not None and w not in head:
                    keys.add(f"h{start} {w[0]}")
                rest -= weights[w]
                if rest < least:
                    break
            if start is not None:
                keys.add("w" + start) if alone else None
            text = Entry.pack(i, alone, unknown, weights, head)
            openers += keys
            packed += [text] * len(keys)
        return [openers, packed]

    return _map(rows.select("entry", "key", "head", "ws", "is_unique"), "opener string, packed string", out, each)


def _memo(make: Callable[[str], object]) -> Callable[[str], object]:
    kept: dict[str, object] = {}

    def get(packed: str) -> object:
        if packed not in kept:
            if len(kept) >= MEMO // 10:
                kept.clear()
            kept[packed] = make(packed)
        return kept[packed]

    return get


def match(names: DataFrame, id_col: str, name_col: str, ref: DataFrame, ref_id: str, ref_name: str, limit: int = SMALL_ROWS) -> DataFrame:
    """synonym_id and food_id of every row: the entry its name means, or 0.

    0 for null and blank names, for names that mean no entry and for those that
    are as near to two. Repeated rows, and rows of equal or null ids, give a
    result each. Entries of equal names can't be told apart, so such a name gives
    0 unless their ids are equal. Null ids and names of the reference are no
    entries. limit: rows up to which a side of a join is broadcast.
    """
    entries = written(_entries(ref, ref_id, ref_name))
    ts = F.split("key", " ")
    facts = entries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(ts)).alias("tokens"), F.sum(F.length("key")).alias("letters"), F.max(F.array_max(F.transform(ts, F.length))).alias("longest")).first()
    n, longest = max(facts["n"], 1), facts["longest"] or 0
    # No side made of the reference has more rows than it has tokens, nor a row longer than an entry, packed.
    few = (facts["tokens"] or 0) <= limit and (facts["letters"] or 0) <= limit * 100
    small = F.broadcast if few else (lambda side: side)
    unknown = math.log(1 + n)
    vocabulary = written(entries.select(F.explode(F.array_distinct(F.split("key", " "))).alias("word")).groupBy("word").agg(F.log(1 + F.lit(float(n)) / F.count(F.lit(1))).alias("weight")))
    rows = _keyed(names, id_col, name_col)

    # Items of distinct names: single tokens with their weight where the reference has them, and neighbours that may be one token in two pieces.
    distinct = rows.filter("key <> ''").select("key").distinct()
    wrapping = sorted(_WRAPPING)
    known = small(vocabulary.select(F.col("word").alias("token"), "weight"))
    neighbours = distinct.select("key", F.posexplode(F.arrays_zip(ts.alias("token"), F.slice(ts, F.lit(2), F.size(ts)).alias("next"))).alias("place", "p")).select("key", "place", "p.token", "p.next")
    single = neighbours.join(known, "token", "left")
    single = single.select("key", F.concat(F.lit("s"), "place").alias("place"), "token", "weight", F.lit(ERRORS).alias("most"))
    pairs = neighbours.filter("next IS NOT NULL").select("key", "place", F.col("token").alias("a"), F.col("next").alias("b"))
    for side in ("a", "b"):
        t = F.col(side)
        pairs = pairs.filter((F.length(t) >= 2) & ~t.isin(wrapping) & ~t.rlike(r"^\p{N}+$"))
        pairs = pairs.join(known.select(F.col("token").alias(side), F.lit(True).alias(f"known_{side}")), side, "left")
    pairs = pairs.select("key", F.concat(F.lit("p"), "place").alias("place"), F.concat("a", "b").alias("token"), F.coalesce("known_a", "known_b", F.lit(False)).alias("known"))

    # Repairs: of tokens that the reference lacks; neighbours of which one is a word of its own are joined only if they are a word exactly.
    open_pairs = pairs.filter("NOT known").drop("known").withColumn("most", F.lit(2))
    open_items = single.filter("weight IS NULL").drop("weight").unionByName(open_pairs)
    searched = open_items.filter(~F.col("token").isin(wrapping)).groupBy("token").agg(F.max("most").alias("most"))
    looked = open_items.drop("most").join(_near(searched, vocabulary, longest, limit), "token", "left")
    itself = F.concat("token", F.lit("=1.0="), F.col("weight").cast("string")).alias("repairs")
    sure = single.filter("weight IS NOT NULL").select("token", "key", "place", itself)
    exact = pairs.filter("known").drop("known").join(known, "token").select("token", "key", "place", itself)
    cells = sure.unionByName(looked).unionByName(exact)
    packed = cells.groupBy("key").agg(F.concat(F.lit(f"{unknown!r} "), F.array_join(F.collect_list(F.concat_ws("|", "place", "token", "repairs")), " ")).alias("name"))

    def openers(b: pa.RecordBatch) -> list:
        out: list[list] = [[], [], []]
        for key, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            words = {w.split("=", 1)[0] for item in name.split(" ")[1:] for w in item.split("|")[2:]}
            letters = {t[0] for t in key.split(" ")}
            found = [f"w{w}" for w in words] + [f"h{w} {x}" for w in words for x in letters]
            out[0] += [key] * len(found)
            out[1] += [name] * len(found)
            out[2] += found
        return out

    three = pa.schema([("key", pa.string()), ("name", pa.string()), ("opener", pa.string())])
    opened = _map(dealt(packed, "key"), "key string, name string, opener string", three, openers)
    opened = opened.join(small(_postings(entries, vocabulary, unknown)), "opener").select("key", "name", "packed")

    parse_name, parse_entry = _memo(Name), _memo(Entry)

    def each(b: pa.RecordBatch) -> list:
        keep, ids, scores = [], [], []
        seen: set[tuple[str, str]] = set()
        for k, (name, entry) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
            if (name, entry) in seen:  # met on several openers
                continue
            seen.add((name, entry))
            e = parse_entry(entry)
            if s := score(parse_name(name), e):
                keep.append(k)
                ids.append(e.id)
                scores.append(s)
        return [b.column(0).take(pa.array(keep, pa.int64())), ids, scores]

    out = pa.schema([("key", pa.string()), ("entry", pa.int64()), ("score", pa.float64())])
    scored = _map(opened, "key string, entry bigint, score double", out, each)
    # As near to two: the smallest and the largest of the best entries differ.
    best = scored.groupBy("key").agg(F.max(F.struct("score", "entry")).alias("most"), F.max(F.struct("score", (-F.col("entry")).alias("entry"))).alias("least"))
    best = best.filter(F.col("most.entry") == -F.col("least.entry")).select("key", F.col("most.entry").alias("food_id"))
    return rows.join(best, "key", "left").select("synonym_id", F.coalesce("food_id", F.lit(0)).cast("bigint").alias("food_id"))
