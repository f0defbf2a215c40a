"""The registry: derivations, build, lookups."""

import pytest

from gramsmith.errors import InvalidInput
from gramsmith.sources import registry


def test_seed(seed_registry):
    flour, egg, rum = (seed_registry.get(n) for n in ("Flour ", "eggs", "RUM"))
    assert flour.density == pytest.approx(0.528345) and flour.density_source == "fdc_derived"
    assert egg.default_piece == 44.0 and egg.pieces["eu xl"] == 78.0 and egg.pieces["xl"] == 56.0
    assert rum.density == 0.94 and rum.density_source == "supplementary"
    assert seed_registry.get("egg") == seed_registry.get("eggs").called("egg")
    with pytest.raises(InvalidInput, match="No such ingredient"):
        seed_registry.get("granite")


def test_derived_density(spark):
    rows = [(1, 1, "cup, whipped", 100.0), (2, 1, "cup", 200.0), (3, 1, "cup", 300.0), (4, 2, "tsp, level", 5.0), (5, 2, "tablespoon", 15.0), (6, 3, "slice", 9.0), (7, 4, "cupcake", 50.0), (8, 5, "fl oz", 30.0), (9, 6, "cup, whipped", 10.0), (10, 6, "cup, fluid", 20.0)]
    got = {r["food_id"]: r["g_per_ml"] for r in registry.derived_density(spark.createDataFrame(rows, "id bigint, food_id bigint, unit_name string, gram_weight double")).collect()}
    assert got == {1: round(200 / 236.588, 6), 2: round(15 / 14.787, 6), 4: round(50 / 236.588, 6), 5: round(30 / 29.5735, 6), 6: round(20 / 236.588, 6)}


def test_portions(spark):
    raw = spark.createDataFrame([("1", "cup", "2", "250"), ("1", "", "1", "5"), ("2", "slice", "0", "5"), ("2", "slice", "x", "5"), ("3", " pod ", "3", "1"), (None, "cup", "1", "1")], "fdc_id string, modifier string, amount string, gram_weight string")
    assert {(r["fdc_id"], r["unit_name"], r["gram_weight"]) for r in registry.valid_portions(raw).collect()} >= {(1, "cup", 125.0), (3, "pod", 0.3333)}
    pieces = spark.createDataFrame([(1, 1, "Large", 5.0), (2, 1, "large ", 6.0), (3, 1, "cup, sliced", 7.0), (4, 1, "cupcake", 8.0)], "id bigint, food_id bigint, unit_name string, gram_weight double")
    assert {(r["size"], r["grams"]) for r in registry.pieces(pieces).collect()} == {("large", 6.0), ("cupcake", 8.0)}


def test_picked_density(spark):
    rows = [(1, 1, 0.1, "fao/x", None), (2, 1, 0.2, "supplementary", None), (3, 1, 0.3, "fdc_derived", None), (4, 1, 0.4, "fdc_derived", None), (5, 2, 0.5, "fao/y", None)]
    df = spark.createDataFrame(rows, registry.DENSITY)
    assert {(r["food_id"], r["g_per_ml"]) for r in registry.picked_density(df).collect()} == {(1, 0.3), (2, 0.5)}
    alt = {r["food_id"]: [a["id"] for a in r["alternatives"]] for r in registry.density_alternatives(df).collect()}
    assert alt == {1: [3, 4, 2, 1], 2: [5]}


def test_build_from_files(spark, tmp_path):
    (tmp_path / "food.csv").write_text('fdc_id,description,more\n7,"Butter, without salt",x\n8,"Egg, whole, raw, fresh",x\nz,broken,x\n')
    (tmp_path / "portion.csv").write_text("fdc_id,modifier,amount,gram_weight\n7,cup,1,227\n7,stick,1,113\n8,cup,1,243\n8,medium,1,44\n99,cup,1,5\n")
    (tmp_path / "fao.csv").write_text("name,density,specific_gravity,source\nTreacle,1.4,,KT\nOats,,0.4,NS\nNothing,x,-1,NS\nbutter,0.9,,BV\n")
    t = registry.build(spark, registry.read_foods(spark, str(tmp_path / "food.csv")), registry.read_portions(spark, str(tmp_path / "portion.csv")), registry.read_measured(spark, str(tmp_path / "fao.csv")))
    t.write(str(tmp_path / "out"))
    r = registry.Registry.of(registry.Tables.read(spark, str(tmp_path / "out")))
    assert r.get("butter").pieces == {"stick": 113.0, "cube": 56.699, "knob": 30.0}
    assert r.get("treacle").density == 1.4 and r.get("oats").density == 0.4
    assert r.get("treacle").density_source == "fao/KT"
    assert r.get("butter").food_id == r.get("Butter, without salt").food_id  # who writes a synonym first keeps it
    assert {x["table_name"] for x in t.counts().collect()} == {"food", "synonym", "density", "portion"}


def test_suggest(spark):
    food = spark.createDataFrame([(1, "Rye flour", "fdc", None), (2, "Wheat flour, white", "fdc", None), (3, "100% rye", "fdc", None)], registry.FOOD)
    syn = spark.createDataFrame([(1, 1, "rye flour"), (2, 2, "flour")], registry.SYNONYM)
    assert [r["name"] for r in registry.suggest(food, syn, "FLOUR").collect()] == ["flour", "Rye flour", "rye flour", "Wheat flour, white"]
    assert [r["name"] for r in registry.suggest(food, syn, "100% r").collect()] == ["100% rye"]
    assert registry.suggest(food, syn, "  ").count() == 0


def test_build_keeps_the_order_of_files(spark, tmp_path):
    """Not of names, units or values."""
    (tmp_path / "food.csv").write_text("fdc_id,description\n9,Zander\n7,Apple mash\n8,Milk\n9,Zander fillet\n")
    (tmp_path / "portion.csv").write_text("fdc_id,modifier,amount,gram_weight\n7,\"cup, sliced\",1,200\n9,cup,1,300\n7,\"cup, chopped\",1,100\n7,medium,1,50\n7,Medium,1,40\n9,cup,1,100\n404,cup,1,1\n")
    (tmp_path / "fao.csv").write_text("name,density,specific_gravity,source\nTreacle,1.4,,KT\nmilk,1.9,,B\nMILK,1.03,,A\nAgave,1.2,,\ntreacle,1.3,,Z\n")
    read = lambda f, n: f(spark, str(tmp_path / n))
    t = registry.build(spark, read(registry.read_foods, "food.csv"), read(registry.read_portions, "portion.csv"), read(registry.read_measured, "fao.csv"))
    foods = {r["name"]: r["id"] for r in t.food.collect()}
    assert [foods[n] for n in ("Zander", "Apple mash", "Milk", "Zander fillet", "Rum", "Cardamom seeds", "Treacle", "Agave")] == [1, 2, 3, 4, 5, 12, 13, 14] and len(foods) == 14
    portions = [(r["id"], r["food_id"], r["unit_name"], r["gram_weight"]) for r in t.portion.orderBy("id").collect()]
    # Of rows with one fdc_id the last is the food that portions go to.
    assert portions == [(1, 2, "cup, sliced", 200.0), (2, 4, "cup", 300.0), (3, 2, "cup, chopped", 100.0), (4, 2, "medium", 50.0), (5, 2, "Medium", 40.0), (6, 4, "cup", 100.0)]
    rows = [tuple(r) for r in t.density.orderBy("id").collect()]
    assert [(i, f, s) for i, f, _, s, _ in rows][:3] == [(1, 2, "fdc_derived"), (2, 4, "fdc_derived"), (3, 5, "supplementary")]
    assert rows[0][2] == round(200 / 236.588, 6) and rows[1][2] == round(300 / 236.588, 6)
    assert rows[2][4] == "typical 40% ABV spirit" and rows[0][4] == "derived from portion data"
    assert [r[1:4] for r in rows[10:]] == [(13, 1.4, "fao/KT"), (3, 1.9, "fao/B"), (3, 1.03, "fao/A"), (14, 1.2, "fao"), (13, 1.3, "fao/Z")]
    r = registry.Registry.of(t)
    assert r.get("apple mash").pieces == {"medium": 40.0} and r.get("milk").density == 1.9 and r.get("treacle").density == 1.4
    with pytest.raises(InvalidInput):
        r.get("Juice (generic)")  # only its synonyms are looked up
    missing = registry.warnings(spark, t.food)
    assert missing[0] == "FDC food not found for synonym 'milk': 'Milk, whole, 3.25% milkfat, with added vitamin D'"
    assert missing[-1] == "FDC food not found for portion: 'Potatoes, flesh and skin, raw'"


def test_numbers_run_over_ranges(spark):
    df = spark.createDataFrame([(f"k{(k * 7919) % 1000:04d}",) for k in range(1000)], "k string").repartition(7)
    got = [(r["k"], r["id"]) for r in registry.numbered(df, 10, "k").collect()]
    assert sorted(got) == [(f"k{k:04d}", 11 + k) for k in range(1000)]
    assert registry.numbered(df.limit(0), 0, "k").count() == 0


def test_large_registries_are_read_by_name(spark, seed_registry):
    """The limit decides how much is read, not what is found."""
    r = registry.Registry.of(seed_registry.tables, limit=3)
    assert r.ingredients == {}
    r.load(["Flour", "eggs", "granite"])
    assert set(r.ingredients) >= {"flour", "plain flour", "eggs", "egg"} and "rum" not in r.ingredients
    for name in ("flour", "eggs"):
        a, b = r.get(name), seed_registry.get(name)
        assert (a, a.density, a.pieces, a.synonyms, a.alternatives) == (b, b.density, b.pieces, b.synonyms, b.alternatives)
    with pytest.raises(InvalidInput, match="No such ingredient"):
        r.get("granite")
