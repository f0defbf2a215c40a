"""Representatives of duplicate groups."""

import datetime as dt
import random

from gramsmith.llm import survivors as S

DENSITY = "id bigint, sample_code string, food_id bigint, g_per_ml double, source string, updated_at timestamp, group_key string"
SOURCES = [("fdc_derived", 6), ("fao", 4), ("bench_test", 3), ("community", 1)]


def day(n):
    return dt.datetime(2021, 1, 1) + dt.timedelta(days=n)


def run(spark, rows, foods=((1,), (2,)), sources=SOURCES):
    df = spark.createDataFrame([(*r, "clash") for r in rows], DENSITY)
    out = S.survivors(df, spark.createDataFrame(list(foods), "id bigint"), spark.createDataFrame(list(sources), "source string, trust int"))
    return sorted(map(tuple, out.collect()), key=lambda r: r[0])


def brute(rows, foods, sources):
    norm = lambda s: "".join(c for c in s.lower() if c.isalpha())
    names = {norm(s): (s, t) for s, t in sources}
    groups: dict[str, list] = {}
    for r in rows:
        if r[1] is not None:
            groups.setdefault("".join(c for c in r[1].lower() if c.isalnum()), []).append(r)
    out = []
    for g in groups.values():
        if len(g) > 1:
            src = lambda r: names.get(norm((r[4] or "").split("/")[0]), (None, 0))
            g = sorted(g, key=lambda r: (-src(r)[1], -(r[5] or dt.datetime.min).timestamp() if r[5] else float("inf"), r[0]))
            first = lambda f, ok: next((f(r) for r in g if ok(r)), None)
            out.append((min(r[0] for r in g), first(lambda r: r[2], lambda r: r[2] in foods), first(lambda r: r[0], lambda r: r[3] is not None and 0 < r[3] <= 3), first(lambda r: src(r)[0], lambda r: src(r)[0])))
    return sorted(out)


def test_field_by_field(spark):
    rows = [
        (5, "AB-1", None, 1.2, "FAO/x", day(1)), (6, "ab 1", 1, float("nan"), "fdc derived", day(2)), (7, "#AB1", 9, 0.0, "community", None), (8, "a-b-1", 2, None, "??", day(9)),
        (9, "solo", 1, 1.0, "fao", day(1)), (10, None, 1, 1.0, "fao", day(1)), (11, None, 1, 1.0, "fao", day(1)), (12, "zz", None, None, None, None), (13, "ZZ", None, 5.0, None, None),
    ]
    assert run(spark, rows) == [(5, 1, 5, "fdc_derived"), (12, None, None, None)]
    assert run(spark, []) == []
    assert run(spark, [(None, "a", None, 0.5, None, None), (None, "a", 1, 0.7, None, None), (3, "A", 2, 0.9, None, None)]) == [(3, 1, None, None)]


def test_against_brute_force(spark):
    r = random.Random(7)
    rows = []
    for i in range(600):
        code = r.choice([None, f"S-{r.randrange(60)}", f"s {r.randrange(60)}", f"HOT{r.randrange(2)}"])
        rows.append((i, code, r.choice([None, 1, 2, 3, 77]), r.choice([None, float("nan"), -1.0, 0.0, 0.5, 0.5, 1.25, 3.0, 9.0]), r.choice([None, "fao/K1", "FDC-Derived", "bench test/2", "benchtest", "x", "Community "]), r.choice([None, day(r.randrange(5))])))
    rows += rows[:40]
    foods = [1, 2, 3]
    assert run(spark, rows, [(f,) for f in foods]) == brute(rows, foods, SOURCES)


def test_consensus_follows_weight():
    values = ["rolled oat flakes", "oat flakes rolled", "rolled oat flake", "rolled rye flakes"]
    assert S.consensus(values, [0.4, 0.1, 0.1, 0.1]) == 0
    assert S.consensus(values, [1.0, 1.0, 1.0, 1.0]) in (0, 2)
    assert S.consensus(["a b c", "a x c", "a b d"], [1.0, 1.0, 1.0]) == 0  # each column by its majority
    assert S.consensus(["1.5"], [0.0]) == 0
    r = random.Random(1)
    for _ in range(200):
        vs = ["".join(r.choice("ab 1") for _ in range(r.randrange(1, 6))) for _ in range(5)]
        assert S.tokens(vs[S.consensus(vs, [4.0**-k for k in range(5)])]) == S.tokens(vs[0])


def test_ranked_vote_is_the_ranking():
    """Whatever the values: the first-ranked value wins every column and gap."""
    r = random.Random(3)
    for _ in range(300):
        vs = list(dict.fromkeys("".join(r.choice("ab 1.") for _ in range(r.randrange(1, 8))) for _ in range(r.randrange(1, 9))))
        assert S.consensus(vs, [(0, -k) for k in range(len(vs))], S.RANKED) == 0


def test_majority_and_rank_differ(spark):
    """One trusted row against many lesser ones: the ranked vote follows the first, the counted vote the many."""
    rows = [(1, "k", 1, 1.25, "fao", day(9))] + [(k, "K", 2, 0.5, "community", day(1)) for k in range(2, 9)]
    assert run(spark, rows) == [(1, 1, 1, "fao")]
    df = spark.createDataFrame([(*x, "clash") for x in rows], DENSITY)
    args = df, spark.createDataFrame([(1,), (2,)], "id bigint"), spark.createDataFrame(SOURCES, "source string, trust int")
    for hot in (3, 100):
        assert [tuple(x) for x in S.consensus_survivors(*args, hot=hot).collect()] == [(1, 2, 2, "community")]
    # Token by token: no value has all of the winning tokens, the nearest one is taken.
    values = ["1.25", "1.30", "2.25", "1.25"]
    assert S.consensus(["9.99", "1.30", "2.25", "1.25"], [3.0, 2.0, 2.0, 2.0]) in (1, 2, 3) and S.consensus(values, [1.0] * 4) == 0


def test_large_groups_are_split(spark):
    """Groups above the limit give what small ones do, by both votes."""
    r = random.Random(11)
    rows = []
    for i in range(400):
        rows.append((i, r.choice(["HOT", "hot", f"S{r.randrange(20)}"]), r.choice([None, 1, 2, 3, 77]), r.choice([None, float("nan"), 0.5, 0.5, 0.5, 1.25, 3.0, round(r.random(), 2)]), r.choice([None, "fao/K1", "FDC-Derived", "x", "Community "]), r.choice([None, day(r.randrange(5))])))
    df = spark.createDataFrame([(*x, "clash") for x in rows], DENSITY)
    args = df, spark.createDataFrame([(1,), (2,), (3,)], "id bigint"), spark.createDataFrame(SOURCES, "source string, trust int")
    want = brute(rows, [1, 2, 3], SOURCES)
    assert sorted(map(tuple, S.survivors(*args, hot=15).collect())) == want == sorted(map(tuple, S.survivors(*args).collect()))
    got = {x["group_id"]: tuple(x) for x in S.consensus_survivors(*args, hot=15).collect()}
    assert got.keys() == {x[0] for x in want}
    # Where all values of a field are single tokens, the counted vote is a weighted count.
    norm = {"fdcderived": 6, "fao": 4, "community": 1}
    trust = lambda s: norm.get("".join(c for c in (s or "").lower().split("/")[0] if c.isalpha()), 0)
    hot = [x for x in rows if x[1].lower() == "hot"]
    votes = {f: sum(1 + trust(x[4]) for x in hot if x[2] == f) for f in (1, 2, 3)}
    assert got[min(x[0] for x in hot)][1] == max(votes, key=votes.get)
