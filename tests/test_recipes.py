"""Files of measures: parsing, faults, conversion, and the whole way to a report."""

import math

import pytest

from gramsmith.errors import BadUnit, InvalidInput, InvalidMerge
from gramsmith.operators import compose, ratio, stats
from gramsmith.plans import report
from gramsmith.sources import recipes


@pytest.fixture
def write(tmp_path):
    def f(text, name="a.csv"):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    return f


def rows(frame):
    return [tuple(r[c] for c in frame.columns) for r in frame.df.orderBy("file_idx", "line_nr").collect()]


def test_grams(spark, seed_registry, write):
    f = recipes.read(spark, seed_registry, [write("Flour, Milk,EGG\n\n100g, 1dl , 2 medium\n  \n1 kg,0,1US large\n")])
    assert [i.name for i in f.ingredients] == ["flour", "milk", "egg"]
    assert rows(f) == [pytest.approx((100, 103.1329, 88)), pytest.approx((1000, 0, 50))]


@pytest.mark.parametrize(
    "cell,grams",
    [("1c flour", None), ("1c", 238.337210755 * 0.528345), ("2tbsp", 2 * 14.7868 * 0.528345), ("3 tsp", 3 * 4.92892 * 0.528345), ("1oz", 28.3495231), ("2 lb", 907.184), ("0", 0), ("0.5", 0), ("05", 0), ("1g%", 1), (".5 kg", 500)],
)
def test_cells(spark, seed_registry, write, cell, grams):
    path = write(f"flour\n{cell}\n")
    if grams is None:
        with pytest.raises(InvalidInput, match="No unit named 'c flour' at line 2, column 0"):
            recipes.read(spark, seed_registry, [path])
    else:
        assert rows(recipes.read(spark, seed_registry, [path])) == [pytest.approx((grams,))]


@pytest.mark.parametrize(
    "text,error,message",
    [
        ("flour,salt\n1g,2g\n1g\n", InvalidInput, "The row on line 3 has 1 columns where 2 were expected"),
        ("flour,salt\n1g,cup\n", InvalidInput, "Incorrect format of measurement at line 2, column 1"),
        ("flour\n1/2 cup\n", InvalidInput, "Incorrect format of measurement at line 2, column 0"),
        ("flour\n1e3g\n", InvalidInput, "No unit named 'e' at line 2, column 0"),
        ("plutonium\n1g\n", InvalidInput, r"No such ingredient as plutonium \(line 1\)"),
        ("flour\n1 medium\n", BadUnit, "Inapplicable unit 'MEDIUM' used for ingredient 'flour' at line 2"),
        ("salt,flour\n1 stick,x\n", InvalidInput, "Incorrect format of measurement at line 2, column 1"),
    ],
)
def test_faults(spark, seed_registry, write, text, error, message):
    with pytest.raises(error, match=message):
        recipes.read(spark, seed_registry, [write(text)])


def test_headers_must_match(spark, seed_registry, write):
    a, b, c = write("flour,eggs\n1g,2g\n"), write("milk,egg\n1g,2g\n", "b.csv"), write("plain flour,egg\n5g,6g\n", "c.csv")
    with pytest.raises(InvalidInput, match="All input files must have the same header."):
        recipes.read(spark, seed_registry, [a, b])
    assert rows(recipes.read(spark, seed_registry, [a, c])) == [(1, 2), (5, 6)]  # synonyms of the same food


def frame(spark, names, data, registry):
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"c{k} double" for k in range(len(names))))
    return recipes.Frame(df, tuple(registry.get(n) for n in names))


def test_duplicates_go_before_merge(spark, seed_registry):
    f = frame(spark, ["flour", "milk", "water"], [(1, 2, 3), (1, 2, 3), (1, 3, 2)], seed_registry)
    s = stats.statistics(f, merge=compose.parse_merge("milk+water"))
    assert s.n == 2 and s.means == pytest.approx([100 / 6, 500 / 6])
    assert stats.statistics(f, distinct=False).n == 3


def test_merge(spark, seed_registry):
    names = ["flour", "milk", "water", "egg", "sugar", "salt"]
    f = frame(spark, names, [(1, 1, 1, 1, 3, 3)], seed_registry)
    m = compose.merge(f, compose.parse_merge("0+4+5:1+2"))
    assert [tuple(r) for r in m.df.collect()] == [(7, 2, 1)]
    m = compose.merge(frame(spark, names, [(4, 1, 2, 1, 6, 6)], seed_registry), compose.parse_merge("0.25+2.50"))
    assert [tuple(r) for r in m.df.collect()] == [(2, 1, 1, 6, 6)]
    with pytest.raises(InvalidMerge, match="Attempted to merge missing column 9"):
        compose.merge(f, compose.parse_merge("0+9"))
    with pytest.raises(InvalidInput, match="Missing column specified: 'rum'"):
        compose.merge(f, compose.parse_merge("rum+milk"))
    with pytest.raises(InvalidInput, match="Expected percentage after period"):
        compose.parse_merge("a.x+b")
    assert compose.parse_merge("butter.100") == [[("butter", 0.1)]]


def test_repeated_names_merge_in_place(spark, seed_registry):
    f = frame(spark, ["water", "flour", "water"], [(1, 2, 3)], seed_registry)
    assert [tuple(r) for r in compose.merge(f, compose.parse_merge("water")).df.collect()] == [(4, 2)]


def test_zeros(spark, seed_registry):
    f = frame(spark, ["flour", "egg", "butter"], [(1, 2, 6), (1, 2, 0), (1, 2, 0)], seed_registry)
    s = stats.collect(f, ["butter"])
    assert ":".join(f"{x:.0f}" for x in s.ratio) == "1:2:3" and s.n == 3
    assert stats.collect(f, [2]).ratio == pytest.approx(s.ratio)


def test_min_sample_size(spark, seed_registry):
    s = stats.Statistics((seed_registry.get("flour"),), 3, [50.0], [10.0], [0.0])
    assert s.min_sample_sizes() == [62]
    assert stats.Statistics((seed_registry.get("flour"),), 3, [0.0], [5.0], [0.0]).min_sample_sizes() == [0]


def test_statistics_are_of_the_population(spark, seed_registry):
    s = stats.collect(frame(spark, ["flour", "milk"], [(100, 100), (30, 10)], seed_registry))
    assert s.means == pytest.approx([62.5, 37.5]) and s.stds == pytest.approx([12.5, 12.5])
    assert s.intervals[0] == pytest.approx(1.96 * 12.5 / math.sqrt(2))


def test_ratio_and_limits(seed_registry):
    names = [seed_registry.get(n) for n in ("flour", "egg", "butter", "butter")]
    r = ratio.Ratio(tuple(names), [1, 2, 3, 3]).restricted([("butter", 94)])
    total, grams = r.recipe(200)
    assert grams[2] + grams[3] == pytest.approx(94)
    three = ratio.Ratio(tuple(names[:3]), [1, 2, 3]).restricted([("flour", 80)])
    assert three.recipe(1000)[1] == pytest.approx([80, 160, 240])
    with pytest.raises(InvalidInput):
        three.restricted([("rum", 1)])
    assert three.percentages() == pytest.approx([100 / 6, 200 / 6, 50])


def test_report_lines(seed_registry):
    r = ratio.Ratio(tuple(seed_registry.get(n) for n in ("flour", "egg", "butter")), [1, 2, 3])
    assert report.recipe_text(r, 200)[1].splitlines() == ["33g or 63ml flour", "67g, 65ml or 2 egg(s) where each egg is 44g", "100g or 104ml butter"]
    assert report.ratio_text(r) == "1.00:2.00:3.00 (flour:egg:butter)"
    assert report.ingredient_text(r, "flour", 1) == "1.0g or 1.9ml flour"


def test_stats_report(spark, seed_registry, write):
    f = recipes.read(spark, seed_registry, [write("flour,egg\n100g,1 medium\n100g,1 medium\n100g,2 medium\n")])
    text = str(report.stats_report(stats.statistics(f), verbose=True))
    assert "Recipe ratio with confidence intervals (confidence level is 95%)\n" + "-" * 64 in text
    assert text.splitlines()[0] == "" and text.endswith("based on 2 distinct recipe proportions. Duplicates have been removed.")
    one = report.stats_report(stats.Statistics(f.ingredients, 1, [60.0, 40.0], [0.0, 0.0], [0.0, 0.0]), distinct=False, verbose=True)
    assert "Too little data available to provide statistics." in str(one) and "may contain duplicates" in str(one)


def test_diff_report(seed_registry):
    i = tuple(seed_registry.get(n) for n in ("flour", "milk"))
    make = lambda *m: stats.Statistics(i, 5, list(m), [1.0, 1.0], [0.1, 0.1])
    d = report.diff_report(make(50.0, 50.0), make(25.0, 75.0), digits=1)
    assert d.columns[0].difference == pytest.approx(2 / 3) and d.columns[0].change == pytest.approx(-0.5)
    assert "Percentage difference between flour proportions 66.7%" in str(d)
    assert "The milk proportion has increased by 50% from data set 1 to 2" in str(report.diff_report(make(50.0, 50.0), make(25.0, 75.0), change=True))
    other = stats.Statistics(tuple(seed_registry.get(n) for n in ("flour", "egg")), 5, [50.0, 50.0], [1.0, 1.0], [0.1, 0.1])
    with pytest.raises(InvalidInput, match="do not match"):
        report.diff_report(make(50.0, 50.0), other)


def test_command_line(spark, write, capsys):
    from gramsmith import cli

    path = write("flour,egg\n100g,1 medium\n200g,1 medium\n")
    args = cli.parser().parse_args(["stats", path, "-w", "450"])
    assert "450g Recipe" in cli.run(spark, args)
    assert "Overall percentage difference = 0%" in cli.run(spark, cli.parser().parse_args(["diff", path, path]))
    assert cli.main(["stats", write("flour\nx\n", "x.csv")]) == 1
    assert "Error: Incorrect format" in capsys.readouterr().err


def test_lines_are_numbered_over_splits(spark, seed_registry, write):
    """A file of many splits: numbers, faults and order are those of the file."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        body = [f"{k + 1}g,{k % 7 + 1} dl" for k in range(2000)]
        text = "\n\nflour,milk\n" + "\n\n".join(body) + "\n"
        a, b = write(text), write("flour,milk\r\n7g,0\r8g,0", "b.csv")
        f = recipes.read(spark, seed_registry, [a, b])
        assert f.df.rdd.getNumPartitions() > 4
        got = [tuple(r) for r in f.df.select("file_idx", "line_nr", "c0").orderBy("file_idx", "line_nr").collect()]
        assert got == [(0, k + 2, k + 1.0) for k in range(2000)] + [(1, 2, 7.0), (1, 3, 8.0)]
        body[1500], body[1800] = "1g,1 foo", "1g"
        with pytest.raises(InvalidInput, match="No unit named 'foo' at line 1502, column 1"):
            recipes.read(spark, seed_registry, [b, write("flour,milk\n" + "\n".join(body), "c.csv")])
        body[1500], body[1800] = "1g,1 large", "1g,2g"
        with pytest.raises(BadUnit, match="Inapplicable unit 'LARGE' used for ingredient 'milk' at line 1504"):
            recipes.read(spark, seed_registry, [b, write("flour,milk\n" + "\n".join(body), "c.csv")])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
