"""The catalog: build, constraints, document."""

import copy
import json

import pytest

from gramsmith import cli
from gramsmith.operators import catalog


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text("flour,milk,egg\n100g,3dl,2 medium\n200g,5dl,3 medium\n200g,5dl,3 medium\n100g,2 dl,1 large\n")
    (tmp_path / "b.csv").write_text("flour,rum\n100g,1 tbsp\n")
    entry = {"category": "crepes", "csv_files": ["a.csv"], "sources": [{"type": "text", "ref": "own"}]}
    config = [entry | {"id": "thin-cakes", "title": "Thin cakes", "description": "Thin."}, entry | {"id": "rum-cakes", "title": "Rum cäkes", "csv_files": ["b.csv"]}]
    (tmp_path / "config.json").write_text(json.dumps(config))
    return tmp_path


def test_document(spark, folder):
    out = folder / "new" / "catalog.json"
    args = cli.parser().parse_args(["catalog", str(folder), str(out), "--config", str(folder / "config.json")])
    assert cli.run(spark, args).startswith("Wrote 2 recipes")
    text = out.read_text(encoding="utf-8")
    doc = json.loads(text)
    assert text.endswith("}\n") and "Rum cäkes" in text and doc["version"] == 1
    thin, rum = doc["recipes"]
    assert list(thin) == ["id", "title", "category", "description", "base_ingredient", "sample_size", "confidence_level", "ingredients", "sources"] and "description" not in rum
    assert thin["base_ingredient"] == "flour" and thin["sample_size"] == 3 and thin["confidence_level"] == 0.95
    flour, milk, egg = thin["ingredients"]
    assert flour["ratio"] == 1.0 and flour["whole_unit"] is None and egg["whole_unit"] == {"name": "medium", "grams": 44.0}
    assert flour["density_g_per_ml"] == 0.5283 and milk["ratio"] > 2
    assert sum(i["proportion"] for i in thin["ingredients"]) == pytest.approx(1, abs=0.001)
    assert rum["sample_size"] == 1 and rum["ingredients"][0]["std_deviation"] == 0.0
    assert catalog.faults(spark, doc["recipes"]) == []


BROKEN = {
    "slug": lambda r: r.update(id="Thin Cakes"), "title": lambda r: r.pop("title"), "category": lambda r: r.pop("category"), "base_ingredient": lambda r: r.pop("base_ingredient"), "sample_size": lambda r: r.update(sample_size=0),
    "ingredients": lambda r: r.update(ingredients=[]), "required": lambda r: r["ingredients"][0].pop("ci_lower"), "ratio": lambda r: r["ingredients"][0].update(ratio=-1.0), "proportion": lambda r: r["ingredients"][1].update(proportion=1.5),
    "std_deviation": lambda r: r["ingredients"][0].update(std_deviation=-0.1), "interval": lambda r: r["ingredients"][0].update(ci_upper=-0.1), "min_sample_size": lambda r: r["ingredients"][0].update(min_sample_size=-1),
    "whole_unit": lambda r: r["ingredients"][0].update(whole_unit={"name": "medium", "grams": 0.0}), "source_type": lambda r: r["sources"][0].update(type="film"), "source_ref": lambda r: r["sources"][0].pop("ref"),
    "unknown field ingredients.note": lambda r: r["ingredients"][0].update(note="x"),
}


def test_constraints(spark, folder):
    """Each rule is told by a record that breaks it alone; nothing is written then."""
    ingredient = {"name": "flour", "ratio": 1.0, "proportion": 1.0, "std_deviation": 0.0, "ci_lower": 0.5, "ci_upper": 1.0, "min_sample_size": 0, "density_g_per_ml": None, "whole_unit": None}
    good = {"id": "a-b", "title": "t", "category": "c", "base_ingredient": "flour", "sample_size": 1, "ingredients": [ingredient, dict(ingredient)], "sources": [{"type": "url", "ref": "r"}]}
    made = []
    for change in BROKEN.values():
        r = copy.deepcopy(good)
        change(r)
        made.append(r)
    assert sorted(catalog.faults(spark, [*made, good])) == sorted(f"recipe {k}: {f}" for k, f in enumerate(BROKEN))
    with pytest.raises(ValueError, match="slug"):
        catalog.write_catalog(spark, made[:1], str(folder / "x.json"))
    assert not (folder / "x.json").exists()


def test_embedded_configuration():
    config = cli.default_catalog()
    assert [c["id"] for c in config] == ["swedish-pancakes", "english-pannkakor", "french-crepes", "english-crepes"]
    assert all(c["category"] == "crepes" and c["csv_files"] and c["sources"][0]["type"] == "text" for c in config)
