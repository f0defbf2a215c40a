"""Best representative of each duplicate group, field by field (problem 1).

Token-level consensus: the values that a group has for a field are split into
tokens and aligned progressively, best weight first; each column of the alignment
is decided by the votes of the values, and the existing value closest to the
winning tokens survives.

There are two votes. ``RANKED``: a column goes to the token of the value whose row
ranks first (trust, then age, then id), whatever the number of the others; this is
the vote that the result of ``survivors`` is defined by. As the first-ranked value
so wins every column, and every gap, its own tokens are the consensus. ``COUNTED``:
each row votes with 1 + its trust, and a majority of lesser rows outvotes the first
(``consensus_survivors``); ranks only decide between values that the vote leaves
equal.

Groups of up to HOT rows are read in rank order, one after the other, in a single
exchange. Larger groups are split by a salt into parts of about HOT rows; each part
is aligned by itself, the alignments of the parts are aligned to each other, and the
distinct values, aggregated before they are shuffled, are measured against the
result. No row is left out, and no task holds more than a part. How a group is
split depends on its own rows only, not on partitions or other groups.
"""

from __future__ import annotations

import functools
import itertools
import json
import operator
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramsmith.session import broadcast_if_small, dealt

HOT = 10_000
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
GAP = None
#: A number of votes, or a place in the ranking as a tuple of which the greatest is the first.
Weight = float | tuple[int, ...]
Profile = list[dict[str | None, Weight]]


@functools.lru_cache(100_000)
def tokens(value: str) -> tuple[str, ...]:
    return tuple(_TOKEN.findall(value.casefold()))


@dataclass(frozen=True)
class Vote:
    """How the weights of values meet in a column."""

    name: str
    join: Callable[[Weight, Weight], Weight]


#: The best supporter decides.
RANKED = Vote("ranked", max)
#: All supporters count.
COUNTED = Vote("counted", operator.add)


def _align(a: Profile, b: Profile) -> list[tuple[int | None, int | None]]:
    """Needleman–Wunsch of the columns of two alignments; a match gains the shares of the tokens that both have."""
    n, m = len(a), len(b)
    if n == m == 1:
        return [(0, 0)]
    shares = [_shares(c) for c in a], [_shares(c) for c in b]
    best = [[-0.5 * (i + j) for j in range(m + 1)] if i == 0 else [-0.5 * i] + [0.0] * m for i in range(n + 1)]
    move = [["word"] * (m + 1)] + [["column"] + [""] * m for _ in range(n)]
    for i, left in enumerate(shares[0], 1):
        above, row, moves = best[i - 1], best[i], move[i]
        for j, right in enumerate(shares[1], 1):
            same = 0.0
            for t, s in right.items():
                if t in left and t is not GAP:
                    same += min(s, left[t])
            most, step = above[j - 1] + (same or -0.4), "both"
            if above[j] - 0.5 > most:
                most, step = above[j] - 0.5, "column"
            if row[j - 1] - 0.5 > most:
                most, step = row[j - 1] - 0.5, "word"
            row[j], moves[j] = most, step
    path, i, j = [], n, m
    while i or j:
        step = move[i][j]
        path.append((i - 1 if step != "word" else None, j - 1 if step != "column" else None))
        i, j = i - (step != "word"), j - (step != "column")
    return path[::-1]


def _shares(column: dict) -> dict:
    """Weights of a column as shares; places in a ranking as equal ones."""
    if isinstance(next(iter(column.values())), tuple):
        return dict.fromkeys(column, 1.0)
    total = sum(column.values()) or 1.0
    return {t: w / total for t, w in column.items()}


def _joined(a: Profile, b: Profile, weight_a: Weight, weight_b: Weight, vote: Vote) -> Profile:
    """Two alignments as one; where one has no column, its weight votes for a gap."""
    out: Profile = []
    for i, j in _align(a, b):
        column = dict(a[i]) if i is not None else {GAP: weight_a}
        for t, w in (b[j] if j is not None else {GAP: weight_b}).items():
            column[t] = vote.join(column[t], w) if t in column else w
        out.append(column)
    return out


def profile(values: Sequence[str], weights: Sequence[Weight], vote: Vote = COUNTED) -> tuple[Profile, Weight]:
    """The alignment of values, best weight first, with the weight that they have together."""
    order = sorted(range(len(values)), key=weights.__getitem__, reverse=True)
    columns: Profile = [{t: weights[order[0]]} for t in tokens(values[order[0]])]
    seen = weights[order[0]]
    for k in order[1:]:
        columns = _joined(columns, [{t: weights[k]} for t in tokens(values[k])], seen, weights[k], vote)
        seen = vote.join(seen, weights[k])
    return columns, seen


def winner(columns: Profile) -> tuple[str, ...]:
    return tuple([t for c in columns if (t := next(iter(c)) if len(c) == 1 else max(c, key=c.get)) is not GAP])


def _distance(a: tuple[str, ...], b: tuple[str, ...]) -> int:
    if a == b:
        return 0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def consensus(values: Sequence[str], weights: Sequence[Weight], vote: Vote = COUNTED) -> int:
    """The place of the value closest to the weighted token consensus; of equals the heaviest, then the first."""
    if len(values) == 1:
        return 0
    order = sorted(range(len(values)), key=weights.__getitem__, reverse=True)
    won = winner(profile(values, weights, vote)[0])
    if won == tokens(values[order[0]]):
        return order[0]
    return min(order, key=lambda k: _distance(tokens(values[k]), won))


def letters_only(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}]", "")


def group_key(code: Column) -> Column:
    """Letters and digits of a code without case."""
    return F.regexp_replace(F.lower(code), r"[^\p{L}\p{N}]", "")


def micros(c: str) -> Column:
    """Microseconds of a timestamp with or without zone, from its fields, so that no change of clocks can disturb the order."""
    return F.expr(f"unix_date(CAST({c} AS DATE)) * 86400000000L + hour({c}) * 3600000000L + minute({c}) * 60000000L + CAST(extract(SECOND FROM {c}) * 1000000 AS BIGINT)")


FIELDS = ("food_id", "g_per_ml", "source")
RANK = ("distrust", "age", "id")


def _rows(density: DataFrame, food: DataFrame, sources: DataFrame) -> DataFrame:
    """group_key, the rank (distrust, age, id) and the usable values of the fields, as texts, of every row with a code."""
    src = sources.filter("source IS NOT NULL").groupBy(letters_only(F.col("source")).alias("src_key")).agg(F.max_by("source", F.struct("trust", "source")).alias("src_name"), F.max("trust").alias("src_trust"))
    ids = food.filter("id IS NOT NULL").select(F.col("id").alias("known_food")).distinct()
    rows = density.filter("sample_code IS NOT NULL").select(
        group_key(F.col("sample_code")).alias("group_key"), "id", "food_id", "g_per_ml", "updated_at", letters_only(F.substring_index("source", "/", 1)).alias("row_src")
    )
    rows = rows.join(broadcast_if_small(src), F.col("row_src") == F.col("src_key"), "left").join(broadcast_if_small(ids), F.col("food_id") == F.col("known_food"), "left")
    usable = (F.col("g_per_ml") > 0) & (F.col("g_per_ml") <= 3)
    return rows.select(
        "group_key",
        (-F.coalesce("src_trust", F.lit(0))).cast("bigint").alias("distrust"),
        F.coalesce(-micros("updated_at"), F.lit(2**63 - 1)).alias("age"),
        "id",
        F.col("known_food").cast("string").alias("food_id"),
        F.when(usable, F.col("g_per_ml")).cast("string").alias("g_per_ml"),
        F.col("src_name").alias("source"),
    )


def _ballot(vote: Vote, values: dict[str, tuple]) -> list[Weight]:
    """The weights of distinct values: the place of their first row, or the votes of all rows."""
    return [v[1] for v in values.values()] if vote == RANKED else [v[2] for v in values.values()]


_OUT = pa.schema([("group_id", pa.int64()), ("food_id", pa.int64()), ("g_per_ml_id", pa.int64()), ("source", pa.string())])
_SCHEMA = "group_id bigint, food_id bigint, g_per_ml_id bigint, source string"


def _batch(rows: Iterable[tuple], out: pa.Schema) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(out.types), out.types, strict=True)], schema=out)


def _stream(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """The rows of each group of a sorted partition; a group may run over batches."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for _, group in itertools.groupby(rows, key=lambda r: r[:keys]):
        yield list(group)


def _tally(group: list[tuple], at: int) -> list[dict[str, list]]:
    """By field: each distinct value, in order of rank, with the id and the place of its first row and the votes of all."""
    out: list[dict[str, list]] = [{}, {}, {}]
    for row in group:
        for values, value in zip(out, row[at + 3 : at + 6], strict=True):
            if value is not None:
                cell = values.setdefault(value, [row[at + 2], tuple(2**63 if x is None else -x for x in row[at : at + 3]), 0.0])
                cell[2] += 1.0 - row[at]
    return out


def _small_groups(rows: DataFrame, vote: Vote) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        for group in _stream(batches, 1):
            if len(group) < 2:
                continue
            won = []
            for values in _tally(group, 1):
                place = consensus(list(values), _ballot(vote, values), vote) if len(values) > 1 else 0
                won.append(next(itertools.islice(values.items(), place, None), (None, (None,))))
            (food, _), (_, (density, *_)), (source, _) = won
            done.append((min((r[3] for r in group if r[3] is not None), default=None), food and int(food), density, source))
            if len(done) >= 4000:
                yield _batch(done, _OUT)
                done = []
        yield _batch(done, _OUT)

    return dealt(rows, "group_key").sortWithinPartitions("group_key", *RANK).select("group_key", *RANK, *FIELDS).mapInArrow(run, _SCHEMA)


def _large_groups(rows: DataFrame, vote: Vote) -> DataFrame:
    """The same for groups of more than HOT rows; rows have parts, the number of parts of their group."""
    part = F.pmod(F.xxhash64("id", *FIELDS), F.col("parts"))
    split = rows.withColumn("part", part)
    aligned = pa.schema([("group_key", pa.string()), ("part", pa.int64()), ("field", pa.string()), ("columns", pa.string()), ("weight", pa.string())])
    weigh = lambda w: tuple(w) if isinstance(w, list) else w

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _stream(batches, 2):
            rows_ = []
            for field, values in zip(FIELDS, _tally(group, 2), strict=True):
                if values:
                    columns, weight = profile(list(values), _ballot(vote, values), vote)
                    rows_.append((group[0][0], group[0][1], field, json.dumps([list(c.items()) for c in columns]), json.dumps(weight)))
            yield _batch(rows_, aligned)

    won = pa.schema([("group_key", pa.string()), ("field", pa.string()), ("won", pa.string())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _stream(batches, 2):
            columns, seen = None, None
            for _, _, _, packed, weight in group:
                mine, more = [{t: weigh(w) for t, w in c} for c in json.loads(packed)], weigh(json.loads(weight))
                columns, seen = (mine, more) if columns is None else (_joined(columns, mine, seen, more, vote), vote.join(seen, more))
            yield _batch([(group[0][0], group[0][1], json.dumps(winner(columns)))], won)

    split = dealt(split, "group_key", "part").sortWithinPartitions("group_key", "part", *RANK).select("group_key", "part", *RANK, *FIELDS)
    profiles = split.mapInArrow(parts, "group_key string, part bigint, field string, columns string, weight string")
    profiles = profiles.repartition("group_key", "field").sortWithinPartitions("group_key", "field", "part").select("group_key", "field", "part", "columns", "weight")
    winners = profiles.mapInArrow(whole, "group_key string, field string, won string")

    # Distinct values against the winning tokens.
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in FIELDS])
    values = rows.select("group_key", *RANK, F.explode(F.filter(cells, lambda c: c["value"].isNotNull())).alias("c")).select("group_key", *RANK, "c.field", "c.value")
    values = values.groupBy("group_key", "field", "value").agg(F.min(F.struct(*RANK)).alias("rank"), F.sum(1.0 - F.col("distrust")).alias("votes"))
    measured = pa.schema([("group_key", pa.string()), ("field", pa.string()), ("value", pa.string()), ("id", pa.int64()), ("far", pa.int64()), ("distrust", pa.int64()), ("age", pa.int64()), ("votes", pa.float64())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            far = [_distance(tokens(v), tuple(json.loads(w))) for v, w in zip(cols[2], cols[7], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([cols[0], cols[1], cols[2], cols[5], far, cols[3], cols[4], cols[6]], measured.types, strict=True)], schema=measured)

    joined = values.join(winners, ["group_key", "field"]).select("group_key", "field", "value", "rank.distrust", "rank.age", "rank.id", "votes", "won")
    near = joined.mapInArrow(measure, "group_key string, field string, value string, id bigint, far bigint, distrust bigint, age bigint, votes double")
    order = F.struct("far", *RANK) if vote == RANKED else F.struct("far", (-F.col("votes")).alias("votes"), *RANK)
    best = near.groupBy("group_key", "field").agg(F.min_by("value", order).alias("value"), F.min_by("id", order).alias("id"))
    of = lambda f, c: F.max(F.when(F.col("field") == f, F.col(c)))
    fields = best.groupBy("group_key").agg(of("food_id", "value").cast("bigint").alias("food_id"), of("g_per_ml", "id").alias("g_per_ml_id"), of("source", "value").alias("source"))
    return rows.groupBy("group_key").agg(F.min("id").alias("group_id")).join(fields, "group_key", "left").select("group_id", "food_id", "g_per_ml_id", "source")


def _survivors(density: DataFrame, food: DataFrame, sources: DataFrame, vote: Vote, hot: int) -> DataFrame:
    rows = _rows(density, food, sources)
    sizes = density.filter("sample_code IS NOT NULL").groupBy(group_key(F.col("sample_code")).alias("group_key")).count()
    large = broadcast_if_small(sizes.filter(F.col("count") > hot).select("group_key", F.ceil(F.col("count") / hot).alias("parts")))
    small = _small_groups(rows.join(large, "group_key", "left_anti"), vote)
    return small.unionByName(_large_groups(rows.join(large, "group_key"), vote))


def survivors(density: DataFrame, food: DataFrame, sources: DataFrame, hot: int = HOT) -> DataFrame:
    """group_id, food_id, g_per_ml_id, source of each group of two or more rows, by the ranked vote.

    Rows with a null code belong to no group. Codes without any letter or digit
    are equal to each other. A field that no row of a group has is null. Exact
    repeats count as rows; of repeats of a value the best-ranked row gives it.
    NaN is no value. A null id ranks before others of its trust and age. Empty tables give no rows; other columns are never read.
    hot: rows of a group up to which one task reads it.
    """
    return _survivors(density, food, sources, RANKED, hot)


def consensus_survivors(density: DataFrame, food: DataFrame, sources: DataFrame, hot: int = HOT) -> DataFrame:
    """The same by the counted vote: a row votes with 1 + its trust, ranks decide between equals."""
    return _survivors(density, food, sources, COUNTED, hot)
