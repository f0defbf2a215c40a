"""Embedded dimension data. All values are fixed values."""

# unit names, kind, factor: grams, millilitres, or None for sizes of whole pieces (the first name is the size).
UNITS = [
    (["gram", "grams", "g"], "weight", 1.0),
    (["hg", "hectogram", "hectograms"], "weight", 100.0),
    (["kg", "kilos", "kilograms"], "weight", 1000.0),
    (["oz", "ounces"], "weight", 28.3495231),
    (["lbs", "lb", "pounds"], "weight", 453.592),
    (["quart", "quarts"], "volume", 946.353),
    (["us pint", "pint", "pints", "pt", "us_pint"], "volume", 473.176),
    (["imperial pint", "uk pint", "imp_pint"], "volume", 568.261),
    (["us fluid ounce", "us_floz", "fluid ounce", "fl oz", "fl. oz"], "volume", 29.5735),
    (["imperial fluid ounce", "uk fluid ounce", "impfloz"], "volume", 28.4131),
    (["ml", "milliliter", "milliliters"], "volume", 1.0),
    (["krm"], "volume", 1.0),
    (["cl", "centiliter", "centiliters"], "volume", 10.0),
    (["dl", "deciliter", "deciliters"], "volume", 100.0),
    (["l", "liter", "liters"], "volume", 1000.0),
    (["c", "cups", "cup", "us cup", "us cups"], "volume", 238.337210755),
    (["metric cup", "metric cups"], "volume", 250.0),
    (["metric tbsp", "metric tb", "mtb", "metric tablespoon", "metric tablespoons", "msk", "cas"], "volume", 15.0),
    (["tbsp", "tb", "tblsp", "tablespoon", "tablespoons"], "volume", 14.7868),
    (["dessert spoon", "dsp", "dstspn"], "volume", 10.0),
    (["tsp", "teaspoon", "teaspoons"], "volume", 4.92892),
    (["metric tsp", "metric teaspoon", "metric teaspoons", "tsk", "mtsp", "cac"], "volume", 5.0),
    (["pinch", "pinches"], "volume", 0.3125),
    (["dash", "dashes"], "volume", 0.625),
    (["xl"], "whole", None),
    (["medium", "us medium"], "whole", None),
    (["eu medium"], "whole", None),
    (["large", "us large"], "whole", None),
    (["eu large"], "whole", None),
    (["small", "us small"], "whole", None),
    (["eu small"], "whole", None),
    (["stick", "sticks"], "whole", None),
    (["cube", "cubes"], "whole", None),
    (["knob", "knobs"], "whole", None),
]

# Names of portions that are measures and no whole units.
MEASURE_NAMES = ["cup", "tbsp", "tablespoon", "tsp", "teaspoon", "fl oz", "fluid ounce", "quart", "pint", "liter", "oz"]

# Millilitres by which densities are derived from portions; the cup differs from the one measures are parsed by.
DERIVE_CUP, DERIVE_TBSP, DERIVE_TSP, DERIVE_FLOZ = 236.588, 14.787, 4.929, 29.5735

# description, grams of a cup, portions of whole pieces. Weights of cups follow from published densities.
FOODS = [
    ("Wheat flour, white, all-purpose, enriched, bleached", 125.0, {}),
    ("Milk, whole, 3.25% milkfat, with added vitamin D", 244.0, {}),
    ("Beverages, water, tap, drinking", 236.8, {}),
    ("Egg, whole, raw, fresh", 243.0, {"small": 38.0, "medium": 44.0, "large": 50.0}),
    ("Butter, without salt", 227.0, {"stick": 113.0}),
    ("Salt, table", 292.0, {}),
    ("Sugars, granulated", 200.0, {}),
    ("Cocoa, dry powder, unsweetened", 86.0, {}),
    ("Cream, fluid, heavy whipping", 238.0, {}),
    ("Cornstarch", 128.0, {}),
    ("Honey", 339.0, {}),
]

# name, synonyms, density, note
SUPPLEMENTARY = [
    ("Rum", ["rum"], 0.94, "typical 40% ABV spirit"),
    ("Juice (generic)", ["juice"], 1.05, "approximate for mixed fruit juices"),
    ("Apple (raw)", ["apple", "apples"], 0.56, "chopped/diced apple bulk density"),
    ("Raisins", ["raisin", "raisins"], 0.65, "packed raisins bulk density"),
    ("Candied peel", ["peel"], 0.75, "chopped candied peel estimate"),
    ("Grated cheese (generic)", ["grated cheese"], 0.38, "loosely packed grated cheese"),
    ("Potato starch", ["potato starch"], 0.72, "bulk density of potato starch powder"),
    ("Cardamom seeds", ["cardamom seed", "cardamom seeds"], 0.65, "whole cardamom seed bulk density"),
]

# synonym, description
ALIASES = [
    ("milk", "Milk, whole, 3.25% milkfat, with added vitamin D"),
    ("water", "Beverages, water, tap, drinking"),
    ("egg", "Egg, whole, raw, fresh"),
    ("eggs", "Egg, whole, raw, fresh"),
    ("egg yolk", "Egg, yolk, raw, fresh"),
    ("yolk", "Egg, yolk, raw, fresh"),
    ("egg white", "Egg, white, raw, fresh"),
    ("all purpose flour", "Wheat flour, white, all-purpose, enriched, bleached"),
    ("plain flour", "Wheat flour, white, all-purpose, enriched, bleached"),
    ("flour", "Wheat flour, white, all-purpose, enriched, bleached"),
    ("salt", "Salt, table"),
    ("butter", "Butter, without salt"),
    ("granulated sugar", "Sugars, granulated"),
    ("sugar", "Sugars, granulated"),
    ("brown sugar", "Sugars, brown"),
    ("icing sugar", "Sugars, powdered"),
    ("powder sugar", "Sugars, powdered"),
    ("confectioner's sugar", "Sugars, powdered"),
    ("honey", "Honey"),
    ("cream", "Cream, fluid, heavy whipping"),
    ("sour cream", "Cream, sour, cultured"),
    ("cocoa", "Cocoa, dry powder, unsweetened"),
    ("cornstarch", "Cornstarch"),
    ("baking soda", "Leavening agents, baking soda"),
    ("bicarbonate", "Leavening agents, baking soda"),
    ("bicarbonate of soda", "Leavening agents, baking soda"),
    ("baking powder", "Leavening agents, baking powder, double-acting, sodium aluminum sulfate"),
    ("vanilla extract", "Vanilla extract"),
    ("buttermilk", "Milk, buttermilk, fluid, whole"),
    ("butter milk", "Milk, buttermilk, fluid, whole"),
    ("blueberries", "Blueberries, raw"),
    ("potato", "Potatoes, flesh and skin, raw"),
    ("potatoes", "Potatoes, flesh and skin, raw"),
    ("shredded potato", "Potatoes, flesh and skin, raw"),
    ("grated potato", "Potatoes, flesh and skin, raw"),
    ("onion", "Onions, raw"),
    ("onions", "Onions, raw"),
    ("rice", "Rice, white, long-grain, regular, raw, enriched"),
    ("fresh yeast", "Leavening agents, yeast, baker's, compressed"),
    ("molasses", "Molasses"),
    ("black treacle", "Molasses"),
    ("ground cinnamon", "Spices, cinnamon, ground"),
    ("cinnamon", "Spices, cinnamon, ground"),
    ("ground nutmeg", "Spices, nutmeg, ground"),
    ("nutmeg", "Spices, nutmeg, ground"),
    ("ground cardamom", "Spices, cardamom"),
    ("cardamom", "Spices, cardamom"),
    ("ground ginger", "Spices, ginger, ground"),
    ("ground cloves", "Spices, cloves, ground"),
    ("cloves", "Spices, cloves, ground"),
    ("all spice", "Spices, allspice, ground"),
    ("ricotta", "Cheese, ricotta, whole milk"),
    ("ricotta cheese", "Cheese, ricotta, whole milk"),
    ("grated parmesan", "Cheese, parmesan, grated"),
    ("corn syrup", "Syrups, corn, light"),
    ("chocolate 70 percent", "Chocolate, dark, 70-85% cacao solids"),
    ("dark chocolate", "Chocolate, dark, 70-85% cacao solids"),
    ("vegetable shortening", "Shortening, vegetable, household, composite"),
    ("crisco", "Shortening, vegetable, household, composite"),
    ("malt extract", "Syrups, malt"),
    ("malt syrup", "Syrups, malt"),
]

# description, unit, grams, note
SUPPLEMENTARY_PORTIONS = [
    ("Egg, whole, raw, fresh", "EU XL", 78.0, "EU ≥73g, midpoint ~78g"),
    ("Egg, whole, raw, fresh", "EU LARGE", 68.0, "EU 63-73g, midpoint ~68g"),
    ("Egg, whole, raw, fresh", "EU MEDIUM", 58.0, "EU 53-63g, midpoint ~58g"),
    ("Egg, whole, raw, fresh", "EU SMALL", 48.0, "EU <53g, midpoint ~48g"),
    ("Egg, whole, raw, fresh", "XL", 56.0, "alias for USDA extra large"),
    ("Butter, without salt", "CUBE", 56.699, "half stick"),
    ("Butter, without salt", "KNOB", 30.0, "approximate"),
    ("Potatoes, flesh and skin, raw", "large baking", 340.0, "US baking potato"),
    ("Potatoes, flesh and skin, raw", "medium baking", 283.0, "US baking potato"),
    ("Potatoes, flesh and skin, raw", "small baking", 226.0, "US baking potato"),
]

# id, title, description, file, source title, source of the catalog's recipes; their category is crepes.
CATALOG = [
    ("swedish-pancakes", "Swedish Pancakes (Pannkakor)", "Thin, eggy Scandinavian pancakes with a high milk-to-flour ratio. Served with jam and whipped cream.", "swedish_recipe_pannkisar.csv", "Aggregated Swedish recipes", "Swedish pannkakor recipes collected from Swedish-language cooking websites and cookbooks."),
    ("english-pannkakor", "Pannkakor (English sources)", "Swedish-style thin pancakes as documented in English-language cooking sources.", "english_recipe_pannkisar.csv", "Aggregated English-language pannkakor recipes", "Pannkakor recipes collected from English-language cooking websites and cookbooks."),
    ("french-crepes", "French Crêpes", "Classic French crêpes — thin pancakes made with flour, milk, eggs, and butter.", "french_recipe_crepes.csv", "Aggregated French recipes", "Crêpe recipes collected from French-language cooking websites and cookbooks."),
    ("english-crepes", "English Crepes", "Crepes as documented in English-language cooking sources — typically a bit thicker than French crêpes.", "english_recipe_crepes.csv", "Aggregated English-language crepe recipes", "Crepe recipes collected from English-language cooking websites and cookbooks."),
]
