"""The general data-preparation operators on small fixtures."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gramsmith.functions.quantities import CellGrammar, Unit, Units, half_up
from gramsmith.operators import badrows, nested, units

UNIT_ROWS = (
    ("g", "weight", 1.0, None), ("gram", "weight", 1.0, None), ("hg", "weight", 100.0, None), ("kg", "weight", 1000.0, None), ("oz", "weight", 28.35, None), ("lb", "weight", 453.6, None), ("dl", "volume", 100.0, None), ("ml", "volume", 1.0, None),
    ("l", "volume", 1000.0, None), ("cup", "volume", 240.0, None), ("msk", "volume", 15.0, None), ("fl oz", "volume", 29.6, None), ("st", "whole", 55.0, "egg"), ("eu large", "whole", 69.0, "egg"), ("knob", "whole", 28.0, "butter"),
)
DENSITIES = (("flour", 0.56), ("milk", 1.03), ("egg", 1.02))


@pytest.fixture(scope="module")
def worker():
    return units._Worker(UNIT_ROWS, DENSITIES)


@pytest.mark.parametrize(
    "cell,note,field,mg",
    [
        ("2 dl", None, "flour", 112_000), ("2dl.", None, "flour", 112_000), ("c:a 2,5 DL mjöl (siktat)", None, "flour", 140_000), ("1 1/2 cup", None, "flour", 201_600), ("1½cup", None, "flour", 201_600), ("1⁄3 cup", None, "flour", 44_800),
        ("fem och en halv dl", None, "flour", 308_000), ("half a cup", None, "flour", 67_200), ("one and a half cup", None, "flour", 201_600), ("~fyra st (vispade)", None, "egg", 220_000), ("1 hg & 25 g", None, "flour", 125_000),
        ("1 lb plus 2 oz", None, "flour", 510_300), (".5 l", None, "milk", 515_000), ("3 dl mjölk, 3 %", None, "milk", 309_000), ("2 fl oz", None, "milk", 60_976), ("2 EU large", None, "egg", 138_000), ("4.50", "enhet=dl", "flour", 252_000),
        ("4", "Mjöl och mjölk i dl.", "milk", 412_000), ("4", "Mjöl och mjölk i dl.", "egg", 0), ("4", "Servera med 2 dl grädde", "flour", 0), ("4", "(g) från mormor", "flour", 0), ("4", None, "flour", 0), ("2 knob", None, "flour", 0),
        ("200 g", None, "flour", 0), ("100 g + 20 gram", None, "flour", 0), ("0 dl", None, "flour", 0), ("lite", None, "flour", 0), ("", None, "flour", 0), ("-", None, "egg", 0), ("2 dl", None, "flour", 112_000), ("1 2", None, "flour", 0), ("2-3 dl", None, "flour", 0), ("1/0 dl", None, "flour", 0),
    ],
)
def test_cell_to_milligrams(worker, cell, note, field, mg):
    assert worker.milligrams(cell, note, field) == mg


@pytest.mark.parametrize(
    "name,notes,unit",
    [("cup (wt. oz.)", None, "oz"), ("cup", "from a 1 kg bag; figures are oz throughout", "oz"), ("cup", "US cup of 8 fl oz", None), ("tsp", "wt: g", "g"), ("pound cake", "1 lb loaf cut in 12", None), ("jar", "jar label says 12 oz", None), ("cup", "lb, not grams", "lb"), (None, None, None)],
)
def test_weight_unit(worker, name, notes, unit):
    got = worker.weights.unit(name, notes)
    assert (got and got.name) == unit


@given(st.integers(0, 40), st.integers(1, 9), st.sampled_from(["dl", "cup", "msk", "oz"]))
@settings(max_examples=60, deadline=None)
def test_notations_agree(whole, ninth, unit):
    g = CellGrammar(Units(UNIT_ROWS, DENSITIES))
    a, b = g.cell(f"{whole} {ninth}/10 {unit}"), g.cell(f"ca {whole},{ninth}{unit.upper()} flour")
    assert a == b and half_up(a[0][0] * 10) == whole * 10 + ninth


def test_scale_and_offset():
    from fractions import Fraction

    celsius = Unit("f", (0, 0, 0), Fraction(5, 9), Fraction(-160, 9))
    assert celsius.of(Fraction(212)).value == 100


def test_units_tables(spark):
    rows = spark.createDataFrame([(1, "2 dl", None, None, None, "x"), (1, "2 dl", None, None, None, "x"), (2, None, "1 l", "3 st", None, "y"), (3, "5", "", "?", "(dl)", "z")], "recipe_id bigint, flour string, milk string, egg string, note string, record_id string")
    got = units.cells_to_milligrams(rows, "t", "recipe_id", ["flour", "milk", "egg"], "note", UNIT_ROWS, DENSITIES)
    assert sorted(map(tuple, got.collect())) == [("t", 1, "flour", 112_000)] * 2 + [("t", 2, "egg", 165_000), ("t", 2, "milk", 1_030_000), ("t", 3, "flour", 280_000)]
    p = spark.createDataFrame([(1, "cup (wt. oz)", 2.0, None), (2, "cup", 2.0, None), (3, "cup", 0.0, "[lb]"), (4, "cup", float("nan"), "[lb]"), (5, None, None, "[lb]"), (6, None, 0.5, "[kg]")], "id bigint, unit_name string, gram_weight double, notes string")
    got = units.weights_to_milligrams(p, "portion", "id", "gram_weight", "unit_name", "notes", UNIT_ROWS, DENSITIES)
    assert sorted(map(tuple, got.collect())) == [("portion", 1, "gram_weight", 56_700), ("portion", 6, "gram_weight", 500_000)]
    assert units.cells_to_milligrams(rows.limit(0), "t", "recipe_id", ["flour"], "note", UNIT_ROWS, DENSITIES).count() == 0


RECORD = "record_id bigint, ingredients array<struct<name:string,whole_unit:struct<name:string,grams:double>>>, sources array<struct<type:string,title:string>>, node string"


def test_nested(spark):
    rows = [(1, [("a", None), None, ("b", ("u", 1.5))], [("t", None), None], "clash"), (1, [("a", None), None, ("b", ("u", 1.5))], None, None), (2, None, None, None), (3, [], [("t", "x")], None), (4, [(None, (None, None))], [], None)]
    got = sorted(map(tuple, nested.recipe_nodes(spark.createDataFrame(rows, RECORD)).collect()))
    b = [(1, "ingredient", 0, "a", 0), (1, "ingredient", 2, "b", 0), (1, "whole_unit", 2, "u", 1500)]
    assert got == sorted([*b, *b, (1, "source", 0, "", 0), (3, "source", 0, "x", 0), (4, "ingredient", 0, "", 0), (4, "whole_unit", 0, "", 0)])
    assert nested.recipe_nodes(spark.createDataFrame([], RECORD)).count() == 0
    big = 2**62 + 1
    odd = nested.recipe_nodes(spark.createDataFrame([(big, [("a", None)], None, None), (None, [("b", None)], None, None)], RECORD))
    assert {tuple(r)[:1] + (r["label"],) for r in odd.collect()} == {(big, "a"), (None, "b")}


def _walk(record):
    """Brute force: numbers of a depth-first traversal, node by node."""
    out, clock = [], {"pre": 0, "post": 0}

    def visit(node, level, children):
        pre = clock["pre"]
        clock["pre"] += 1
        at = len(out)
        out.append(None)
        for c in children:
            visit(*c)
        out[at] = (node, pre, clock["post"], level)
        clock["post"] += 1

    _, ingredients, sources = record
    kids = [("ingredient", 1, [("whole_unit", 2, [])] if i[1] else []) for i in ingredients or [] if i] + [("source", 1, []) for s in sources or [] if s]
    visit("record", 0, kids)
    return sorted(out)


def test_interval_labels_equal_traversal(spark):
    r = random.Random(3)
    rows = []
    for i in range(60):
        ing = None if r.random() < 0.1 else [None if r.random() < 0.2 else ("n", ("u", 1.0) if r.random() < 0.5 else None) for _ in range(r.randrange(7))]
        rows.append((i, ing, None if r.random() < 0.2 else [None if r.random() < 0.3 else ("t", "x") for _ in range(r.randrange(4))]))
    df = spark.createDataFrame(rows, "record_id bigint, ingredients array<struct<name:string,whole_unit:struct<name:string,grams:double>>>, sources array<struct<type:string,title:string>>")
    nodes = nested.shred(df, "record_id", nested.RECIPE_TYPES)
    by: dict[int, list] = {}
    for n in nodes.collect():
        by.setdefault(n["record_id"], []).append((n["node"], n["pre"], n["post"], n["level"]))
    assert {k: sorted(v) for k, v in by.items()} == {row[0]: _walk(row) for row in rows}
    linked = nested.link(nested.node_table(nodes, "ingredient"), nested.node_table(nodes, "whole_unit"), 1)
    assert linked.count() == nested.node_table(nodes, "whole_unit").count() and linked.filter("parent_pre >= pre").count() == 0


LINES = [
    (1, "a/1", 1, 'Flour,"Egg",Butter'), (2, "a/1", 2, "1 dl,2 st,1 knob"), (3, "a/1", 3, "1 dl,2 st"), (4, "a/1", 4, '1 dl,"2 st,1 knob'), (5, "a/1", 5, '1 "dl",2 st,1 knob'), (6, "a/1", 6, '"1,5 dl",0,"0"'), (7, "a/1", 7, "1 dl,2 knob,1 knob"),
    (8, "a/1", 8, "   "), (9, "a/1", 9, None), (10, "a/1", 10, '"1 dl" ,2 st,1 knob'), (11, "b", 2, "1 dl"), (12, "a/1", 11, " 1 DL , 2St,0 "), (13, "a/1", 12, "1 dl,,0"), (14, None, 3, "0"), (15, "a/1", 13, '1 dl,2 st,"1 ""knob"'), (16, "a/1", 14, '"1 dl",2 st,1 knob'), (16, "a/1", 14, '"1 dl",2 st,1 knob'),
    (17, "a/1", 15, "-1 dl,2 st,0"), (18, "a/1", 16, "1..5 dl,2 st,0"), (19, "a/1", 17, "1 dl;2 st;0"),
]


def test_bad_lines(spark):
    df = spark.createDataFrame(LINES, "line_id bigint, file_name string, line_nr int, raw_line string")
    got = {r["record_id"]: r["reason"] for r in badrows.bad_lines(df, UNIT_ROWS).collect()}
    assert got == {3: "column_count", 4: "quoting", 5: "quoting", 7: "value", 10: "quoting", 11: "column_count", 13: "value", 14: "column_count", 15: "value", 17: "value", 18: "value", 19: "column_count"}
    good = {r["line_id"] for r in badrows.good_lines(df, UNIT_ROWS).collect()}
    assert good == {2, 6, 12, 16}
    assert badrows.bad_lines(df.limit(0), UNIT_ROWS).count() == 0


def test_bad_lines_of_a_stream(spark, tmp_path):
    from gramsmith.streaming import ingest

    schema = "line_id bigint, file_name string, line_nr int, raw_line string"
    df = spark.createDataFrame(LINES, schema)
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    heads = df.filter("line_nr = 1").select("file_name", "raw_line")
    stream = ingest.bad_lines(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), heads, UNIT_ROWS)
    q = stream.writeStream.format("memory").queryName("bad").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("bad").collect())) == sorted(map(tuple, badrows.bad_lines(df, UNIT_ROWS).collect()))


def test_bad_cells(spark):
    df = spark.createDataFrame([(1, "1 msk", "0"), (2, "", None), (3, None, None), (4, "2 st", "x"), (5, "1,5 KNOB", "1 l"), (6, "0.0", "1 g")], "id bigint, butter string, salt string")
    got = badrows.bad_cells(df, "t", "id", {"butter": "butter", "salt": "salt"}, UNIT_ROWS)
    assert sorted(r["record_id"] for r in got.collect()) == [2, 4, 6]


def test_recovery_at_anchors():
    g = badrows.RecordGrammar(badrows.MeasureRule(UNIT_ROWS))
    out = list(g.block('Flour,Egg\n1 dl,2 st\n"3 dl,1 st\nrest of the broken cell\n2 dl,0\n1 dl\n'))
    assert out[0] == [(1.0, "dl"), (2.0, "st")]
    assert (out[1].reason, out[1].line) == ("quoting", 3)
    assert out[2] == [(2.0, "dl"), (0.0, "g")]
    assert (out[3].reason, out[3].line, out[3].column) == ("column_count", 6, 1)
    assert len(out) == 4


def test_quoted_cells_over_lines():
    g = badrows.RecordGrammar(badrows.MeasureRule(UNIT_ROWS))
    out = list(g.block('\nFlour,Egg\n"1\n g",2 st\n\n1 dl,0\n'))
    assert out == [[(1.0, "g"), (2.0, "st")], [(1.0, "dl"), (0.0, "g")]]
    # A broken quote: two cells alone make no anchor, they must be measures; the first valid record does.
    out = list(g.block('Flour,Egg\n"3 dl,1 st\nrest, of the cell\n1 dl,x\n2 dl,0\n1 dl,x\n'))
    assert [(f.reason, f.line, f.column) if isinstance(f, badrows.SyntaxFault) else f for f in out] == [("quoting", 2, 0), [(2.0, "dl"), (0.0, "g")], ("value", 6, 1)]
    assert [f.line for f in g.block('Flour\n"1 dl\nx\n"y\n')] == [2] and list(g.block("")) == [] == list(g.block("\n \n"))


def test_recovery_of_lines(spark):
    """Each line start is an anchor: a broken quote costs its line only, whatever the order of lines; faults are located."""
    rows = [(1, "f", 1, "Flour,Egg"), (2, "f", 2, '"3 dl,1 st'), (3, "f", 3, "2 dl,0"), (4, "f", 4, '1 dl,"1" st'), (5, "f", 5, "1 dl,x"), (6, "f", 6, "1 dl"), (7, "f", 7, "1 dl,1 st")]
    df = spark.createDataFrame(rows, "line_id bigint, file_name string, line_nr int, raw_line string")
    for frame in (df, df.orderBy(df.line_id.desc())):
        got = sorted(tuple(r)[1:] for r in badrows.located_faults(badrows.with_headers(frame), UNIT_ROWS, "t").collect())
        assert got == [(2, "quoting", 2, 0), (4, "quoting", 4, 5), (5, "value", 5, 1), (6, "column_count", 6, 1)]
        assert {r["line_id"] for r in badrows.good_lines(frame, UNIT_ROWS).collect()} == {3, 7}


@given(st.text(alphabet='ab",', max_size=12))
@settings(max_examples=300, deadline=None)
def test_line_grammar_equals_rules(line):
    """Brute force over the rules of quoting, character by character."""
    cells, i, ok = [], 0, True
    while ok:
        cell = ""
        if i < len(line) and line[i] == '"':
            i += 1
            while True:
                if i >= len(line):
                    ok = False
                    break
                if line[i] == '"' and i + 1 < len(line) and line[i + 1] == '"':
                    cell, i = cell + '"', i + 2
                elif line[i] == '"':
                    i += 1
                    ok = i == len(line) or line[i] == ","
                    break
                else:
                    cell, i = cell + line[i], i + 1
        else:
            while i < len(line) and line[i] != ",":
                ok &= line[i] != '"'
                cell, i = cell + line[i], i + 1
        cells.append(cell)
        if i >= len(line):
            break
        i += 1
    got = badrows.LineGrammar().cells(line)
    assert (got == cells) if ok else isinstance(got, badrows.SyntaxFault)
