"""Evaluation passages in texts."""

import random

from gramsmith.llm import leaks as L

ITEM = "In Grenholm, thirteen level spoons of skimmed milk were folded under loud protest by a market trader before the crust ran clear. How many of the 85 portions were lost?"
WORDS = ITEM.split()


def search(spark, texts, items=((1, ITEM),), **kw):
    docs = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "doc_id bigint, text string, item_id int")
    df = spark.createDataFrame(list(items), "item_id bigint, text string")
    return sorted(map(tuple, L.leaks(docs, "doc_id", "text", df, "item_id", "text", **kw).collect()))


def piece(a, b):
    return " ".join(WORDS[a:b])


def test_variants(spark):
    texts = {
        "whole": ITEM,
        "twelve": "so " + piece(2, 14) + " yes",
        "eleven": "so " + piece(2, 13) + " yes",
        "exchanged": piece(2, 8) + " cream " + piece(9, 14),
        "dropped": piece(2, 8) + " " + piece(9, 14),
        "added": piece(2, 8) + " cold " + piece(8, 14),
        "two changes": piece(2, 7) + " x " + piece(8, 13) + " y " + piece(14, 19),
        "markup": "<p>" + " ".join(f"**{w}**" if k % 3 else f"_{w}_" for k, w in enumerate(WORDS)) + "</p>",
        "wrapped": "\n> ".join(piece(k, k + 4) for k in range(0, 24, 4)),
        "case": piece(3, 18).upper(),
        "entities": piece(3, 18).replace(" ", "&nbsp;"),
        "decomposed": piece(3, 18).replace("of", "o­f").replace("skimmed", "ｓkimmed"),
        "empty": "", "null": None, "blank": " \n ",
        "long": "flour " * 30_000 + piece(4, 18) + " milk" * 30_000,
    }
    got = {list(texts)[d] for d, _ in search(spark, list(texts.values()))}
    assert got == {"whole", "twelve", "exchanged", "dropped", "added", "markup", "wrapped", "case", "entities", "decomposed", "long"}


def test_blocks_and_edges(spark):
    items = [(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(30)] + [(99, None), (98, "too short"), (1, "w1x0")]
    texts = [items[k][1] for k in (3, 17, 29)] + [None]
    want = [(0, 3), (1, 17), (2, 29)]
    assert search(spark, texts, items) == want == search(spark, texts, items, limit=8)
    assert search(spark, texts, []) == [] and search(spark, [], items) == []


def brute(text, item):
    """Every 12 words of the item against every stretch of 11 to 13 words of the text, ends kept."""
    a, b = L.words(item), L.words(text)
    for i in range(len(a) - 11):
        x = a[i : i + 12]
        for j in range(len(b)):
            for n in (11, 12, 13):
                y = b[j : j + n]
                if len(y) < n or x[0] != y[0] or x[-1] != y[-1]:
                    continue
                if n == 12 and sum(p != q for p, q in zip(x, y, strict=True)) <= 1:
                    return True
                if n == 11 and any(x[:k] + x[k + 1 :] == y for k in range(1, 11)):
                    return True
                if n == 13 and any(y[:k] + y[k + 1 :] == x for k in range(1, 12)):
                    return True
    return False


def test_against_brute_force():
    r = random.Random(5)
    items = [(k, " ".join(r.choice("ab ab cd of the 3 ninety grams".split()) for _ in range(22))) for k in range(6)]
    index = L.TemplateIndex(items)
    hits = 0
    for _ in range(250):
        w = r.choice(items)[1].split()
        s = r.randrange(0, 10)
        w = w[s : s + r.randrange(9, 15)]
        for _ in range(r.randrange(0, 3)):
            k, what = r.randrange(len(w)), r.randrange(3)
            w[k : k + (what != 2)] = [] if what == 1 else ["zz"]
        text = "start " + " ".join(w) + " end"
        want = [i for i, t in items if brute(text, t)]
        assert index.leaks(text) == want
        hits += bool(want)
    assert 40 < hits < 240


def test_templates_check_slots(spark):
    changed = ITEM.replace("Grenholm", "Tallsund").replace("thirteen", "ninety-nine").replace("85", "310")
    mixed = "In Grenholm, thirteen drops of milk against thirteen drops of rye and thirteen drops of oat in Grenholm once more"
    other = mixed.replace("thirteen", "eleven", 1).replace("thirteen", "twelve", 1)
    df = spark.createDataFrame([(1, changed), (2, mixed), (3, other)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, ITEM + " Later in Tallsund."), (2, mixed)], "item_id bigint, text string")
    got = sorted(map(tuple, L.templates(df, "doc_id", "text", items, "item_id", "text").collect()))
    assert got == [(1, 1, 3), (2, 2, 0)]  # one value that became two is no instance
    assert search(spark, [changed]) == [(0, 1)]  # twelve words between the changes stand word for word


def test_values_that_no_item_has_are_told_apart():
    item = "mix 20 of rye and 20 of oat and 20 of corn and 20 of malt"
    index = L.TemplateIndex([(1, item)])
    assert index.templates(item) == [(1, 0)]
    assert index.templates(item.replace("20", "30")) == [(1, 1)]
    assert index.templates("mix 31 of rye and 32 of oat and 33 of corn and 34 of malt") == []


def test_tags_of_any_length_are_markup():
    for tag in ('<a href="/x?' + "y" * 5000 + '">', '<img hidden src="data:image/png;base64,' + "A9 " * 3000 + '"/>', "<p style='" + "color: red; " * 50 + "'>", "<b>", "</div >"):
        assert L.words(f"rye {tag} oat") == ["rye", "oat"]
    prose = "with x <y then " + "flour and milk " * 30 + "> z"
    assert len(L.words(prose)) == len(prose.replace("<", "").replace(">", "").split())
    assert len(L.words("<a b " * 20_000)) == 40_000


def brute_templates(index, text):
    """Every stretch of every diagonal: maximal among the consistent ones of equal canonical words."""
    canon, exact = index.read(text)
    best = {}
    for i, c, e in index.items:
        for shift in range(-len(c), len(canon)):
            ok = lambda a, b: all(0 <= k + shift < len(canon) and c[k] == canon[k + shift] for k in range(a, b)) and L._consistent([(e[k], exact[k + shift], c[k]) for k in range(a, b)]) is not None  # noqa: B023, E731
            for a in range(max(0, -shift), len(c)):
                for b in range(a + L.SPAN, len(c) + 1):
                    if not ok(a, b):
                        break
                    if (a and ok(a - 1, b)) or (b < len(c) and ok(a, b + 1)):
                        continue
                    changed = L._consistent([(e[k], exact[k + shift], c[k]) for k in range(a, b)])
                    best[i] = min(changed, best.get(i, changed))
    return sorted(best.items())


def test_stretches_against_brute_force():
    """Planted: items with their numbers and units exchanged, consistently or not."""
    r = random.Random(6)
    numbers, units = ["20", "30", "ninety", "475", "7"], ["grams", "litres", "cups"]
    items = [(k, " ".join(r.choice([r.choice(numbers), r.choice(units), "of", "rye", "mix", "and"]) for _ in range(20))) for k in range(4)]
    index = L.TemplateIndex(items)
    hits = split = 0
    for _ in range(60):
        w = r.choice(items)[1].split()
        became = {x: r.choice([x, "31", "99", "pounds" if x in units else "8"]) for x in numbers + units}
        w = [became.get(x, x) if r.random() < 0.9 else x for x in w]
        text = "so " + " ".join(w[r.randrange(0, 4) :]) + " done"
        want = brute_templates(index, text)
        assert index.templates(text, whole_runs=False) == want, text
        hits, split = hits + bool(want), split + (want != index.templates(text))
    assert hits > 15 and split > 3


def test_templates_query_finds_stretches(spark):
    """A full copy in which one value became two: its last words are consistent."""
    item = "In Grenholm, thirteen drops of milk against thirteen drops of rye and thirteen drops of oat in Grenholm once more"
    df = spark.createDataFrame([(1, item.replace("thirteen", "eleven", 1))], "doc_id bigint, text string")
    items = spark.createDataFrame([(2, item)], "item_id bigint, text string")
    got = L.templates(df, "doc_id", "text", items, "item_id", "text", whole_runs=False)
    assert [tuple(x) for x in got.collect()] == [(1, 2, 0)]
