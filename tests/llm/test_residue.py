"""Template residue, filler, error pages and demands for scripts."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gramsmith.llm import residue as R

RESIDUE = [
    "{{ title }} serves four", "<%= servings %> cups", "Mix ${amount} of flour", "#{base} and milk", "@@step_1@@: whisk", "[[portion.name]]", "%COOK_TIME% left", "__RECIPE_TITLE__ with eggs", "<cook_time> minutes", "&lt;author&gt; says", "[skriv titel här] smet", "[INSERT NAME HERE]", "{% block intro %}",
    "Lorem ipsum dolor sit amet consectetur adipiscing elit.", "Crêpes\n\nNostrud ea laboris commodo ex aliqua ullamco.", "sample text placeholder copy dummy paragraph", "TODO: write the intro for this recipe", "Beskrivning kommer inom kort", "(description pending)", "Texte à venir", "Hier steht bald eine Beschreibung",
    "undefined cups null, serves NaN", "NaN dl [object Object]", "Oops! The page could not be processed. Error code 502", "Sidan kunde inte hittas (404).", "HTTP 503 – Gone", "Error 502: Bad Gateway", "Access denied. You do not have permission to view this.", "Session expired.", "Fatal error: Uncaught exception 'X' in a.php",
    "The service is temporarily unavailable due to maintenance. Please check back soon.", "The page /a/1 could not be found on this server.", "Webbläsaren har stängt av JavaScript.", "Muffins Beskrivning kommer inom kort My bowl is small", "410 Forbidden.",
    "Die angeforderte Seite wurde nicht gefunden.", "PLEASE ENABLE JAVASCRIPT TO VIEW THIS RECIPE", "Du måste aktivera JavaScript i din webbläsare.", "<noscript>Turn on scripting to load the comments.</noscript>", "Pannkakor. JavaScript is disabled.", "We can't find the recipe you are looking for.",
]
EARNEST = [
    "The ratio set {1:2:3} is easy to remember.", "{serves 4}", "[optional] add raisins.", "__Do not__ open the oven.", "We spent $5 per kg, about 20 % more than before.", "Null result: the extra egg changed nothing.", "Undefined amounts, such as a knob, were left out.", "Page not found in my copy of the book, someone tore it out.",
    "I named this cake Lorem Ipsum after my first typesetting job.", "TODO for next week: buy a bigger pan.", "Tbd means “to be done” on her cards.", "My notes had placeholders for the sugar.", "The error is mine: it should read 503 g.", "My blog shows a 404 whenever I link to the waffle post, any ideas?", "Access to the larder was denied by the cat.",
    "The server at the café said the kitchen was temporarily unavailable.", "I wrote a small JavaScript calculator for baker's percentages.", "Jag tröttnade på sidor som kräver JavaScript för ett enkelt recept.", "Serves <4 people unless they are children.", "<b>Whisk</b> the <i>eggs</i>.", "Weigh out 404 g of flour and 500 g of milk.", "", "  \n", "[page break] Stir.", "Servera mördeg med salt.",
]


def found(spark, texts):
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id bigint, text string, kind string")
    return {r["doc_id"] for r in R.residue(df, "doc_id", "text").collect()}


def test_cases(spark):
    texts = [*RESIDUE, *EARNEST, None]
    assert found(spark, texts) == set(range(len(RESIDUE)))
    long = "Whisk the eggs well.\n" * 20_000
    assert found(spark, [long, long + "Please enable JavaScript to view this recipe."]) == {1}
    assert found(spark, []) == set()


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "fine"), (1, "{{ title }}"), (1, "{{ title }}"), (None, "{{ title }}")], "doc_id bigint, text string")
    assert [r["doc_id"] for r in R.residue(df, "doc_id", "text").collect()] == [1]


BASE = "please enable javascript in order to view the whole of this recipe together with all its photos comments ratings notes and the shopping list that goes with it"


def test_labels_reach_components(spark):
    """The text decides here: all SimHashes are equal."""
    rows = [(1, R.WHOLE, BASE), (2, R.NONE, BASE + " today or then"), (3, R.NONE, BASE + " today or then again once more now"), (4, R.NONE, BASE[:40] + " quite another text about batter"), (5, R.WITHIN, BASE + " today")]
    segs = spark.createDataFrame([(i, 77, k, t) for i, k, t in rows], "seg bigint, sim bigint, kind int, words string")
    # 3 is not near 1, but reached through 2; a segment with a placeholder takes no part.
    x, y = ({" ".join(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in (rows[0][2], rows[2][2]))
    assert len(x & y) < R.SIMILARITY * len(x | y)
    assert {r["seg"] for r in R.spread_labels(segs).collect()} == {1, 2, 3}


def test_all_within_three_bits_are_found(spark):
    r = random.Random(11)
    words = BASE.split()
    base = int(R.simhashes([words])[0])
    rows = [(0, base, R.WHOLE, BASE)]
    for k in range(1, 120):
        sim = base
        for bit in r.sample(range(64), r.randrange(0, 4)):
            sim ^= 1 << bit
        rows.append((k, sim, R.NONE, BASE + " x"))
    df = spark.createDataFrame([(i, s - (1 << 64) if s >> 63 else s, k, t) for i, s, k, t in rows], "seg bigint, sim bigint, kind int, words string")
    assert R.spread_labels(df).count() == 120


def test_simhash_equals_definition():
    import xxhash

    texts = [["a"], ["a", "b", "b"], "the whole of the recipe".split()]
    for t, got in zip(texts, R.simhashes(texts), strict=True):
        bits = [sum(1 if xxhash.xxh64_intdigest(w) >> k & 1 else -1 for w in t) > 0 for k in range(64)]
        assert int(got) == sum(b << k for k, b in enumerate(bits))


def test_shingles(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a b c d e f a b c d e",)], "w string")
    assert sorted(df.select(R.shingles(F.col("w")).alias("s")).first()["s"]) == sorted({"a b c d e", "b c d e f", "c d e f a", "d e f a b", "e f a b c", "f a b c d"})


@pytest.mark.parametrize("text,parts", [("a. B!  c\r\n\r\nd e", ["a.", "B!", "c", "d", "e"]), ("", []), (" \n ", [])])
def test_segments(text, parts):
    assert R.segments(text) == parts


def test_slots_in_brackets(spark):
    """The first two are documents 1275 and 6778 of sf0.1 around their slots."""
    slots = ["Whisk well.\n[YOUR RATIO] \nServe.", "I can make the batter in about forty [ADD RATIO]", "[ADD AMOUNT] of flour", "By [YOUR AUTHOR].", "[ADD PORTION.NAME]", "[YOUR\u00a0MÄNGD]", "[FILL IN COOK_TIME]", "[add first_name] bakes"]
    earnest = ["[optional]", "[page break]", "[edit: fixed the butter amount]", "[add more milk if it is thick]", "[your choice of jam]", "[OPTIONAL]", "[PAGE BREAK]", "[EDIT: FIXED THE BUTTER AMOUNT]", "ADD RATIO", "[Add 1.5 dl]"]
    assert found(spark, slots + earnest) == set(range(len(slots)))


def covered(tree) -> bool:
    """Whether every text that a parsed pattern matches holds a trigger: proved alternative by alternative."""
    return stretches(tree)[1]


def stretches(tree):
    """(the texts that a pattern stands for if they are few, else None; whether each match holds a trigger)."""

    def holds(texts):
        return all(any(t in R.flat(x) for t in R.TRIGGERS) for x in texts)

    run, done, whole = {""}, False, True
    for op, arg in tree:
        name, texts, sure = str(op), None, False
        if name == "LITERAL":
            texts = {chr(arg)}
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            texts = {chr(c) for _, c in arg}
        elif name == "AT" or name.startswith("ASSERT"):
            texts = {""}
        elif name == "SUBPATTERN":
            texts, sure = stretches(arg[3])
        elif name == "BRANCH":
            parts = [stretches(x) for x in arg[1]]
            texts, sure = (set().union(*(t for t, _ in parts)) if all(t is not None for t, _ in parts) else None), all(s for _, s in parts)
        elif name.endswith("REPEAT"):
            low, high, body = arg
            inner, inner_sure = stretches(body)
            sure = low >= 1 and inner_sure
            if inner is not None and (low, high) in ((0, 1), (1, 1)):
                texts = inner | ({""} if low == 0 else set())
        done = done or sure
        if texts is None or len(run) * len(texts) > 20_000:
            done, run, whole = done or holds(run), {""}, False
        else:
            run = {a + b for a in run for b in texts}
    return (run if whole else None), done or holds(run)


@pytest.mark.parametrize("name", ["PLACEHOLDERS", "SLOT", "UNDERSCORED", "ANGLED", "ANNOUNCED", "ANNOUNCING", "UNSET", "UNSET_SURE", "ERRORS", "SCRIPTS"])
def test_each_alternative_has_a_trigger(name):
    from re import _parser

    pattern = getattr(R, name)
    tree = _parser.parse(pattern.pattern, pattern.flags & ~32)
    assert not any(" " in t for t in R.TRIGGERS)
    parts = [x for op, arg in tree for x in (arg[1] if str(op) == "BRANCH" else [])] if len(tree) == 1 else []
    assert [str(list(x))[:300] for x in parts if not covered(x)] == []
    assert parts or covered(tree)


GUARDS = {"ANNOUNCED": "ANNOUNCED_TRIGGERS", "ANNOUNCING": "ANNOUNCED_TRIGGERS", "UNSET": "UNSET_TRIGGERS", "UNSET_SURE": "UNSET_TRIGGERS", "ERRORS": "ERROR_TRIGGERS", "SCRIPTS": "SCRIPT_TRIGGERS", "PLACEHOLDERS": "SIGNS", "SLOT": "SIGNS", "UNDERSCORED": "SIGNS", "ANGLED": "SIGNS"}


@pytest.mark.parametrize("name", GUARDS)
def test_each_alternative_has_a_trigger_of_its_pattern(name, monkeypatch):
    monkeypatch.setattr(R, "TRIGGERS", tuple(getattr(R, GUARDS[name])))
    test_each_alternative_has_a_trigger(name)


UNTRIGGERED = [
    "Image coming soon", "Content coming soon", "Contenu à venir", "Add your content here", "This content is not available.", "This site cannot be displayed.", "The document no longer exists.", "The file does not exist.", "410 Gone",
    "Segmentation fault", "You do not have permission to view this.", "Excepteur sint occaecat cupidatat non proident, sunt in culpa qui offici", "har har har har har har", "kommer har kommer har", "filler sample filler sample", '<a href="{{ url }}">soup</a>',
]


def test_judge_agrees_without_prefilter():
    for text in [*UNTRIGGERED, *(s for t in RESIDUE + EARNEST for s in R.segments(R.visible(t)))]:
        assert R.judge(text) == R.judge(text, ("",)), text
    assert all(map(R.judge, UNTRIGGERED))
    for word in R.LOREM_SURE:  # any three sure words in a row of five make filler
        assert R.judge(f"{word} et {word} in {word}") == R.WHOLE


def planted(seed=7, n=60):
    """Pairs of a label and a near-duplicate: words appended or exchanged, of a similarity around 0.8."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    pairs = []
    for size, more, exchanged in ((20, 3, 0), (24, 4, 0), (55, 0, 1), (9, 1, 0), (9, 2, 0), (40, 9, 0), (20, 5, 0)):
        for _ in range(n):
            a = r.choices(vocabulary, k=size)
            b = a + r.choices(vocabulary, k=more)
            for _ in range(exchanged):
                b[r.randrange(len(b))] = "other"
            pairs.append((a, b))
    return pairs


def test_near_duplicates_against_brute_force(spark):
    pairs = planted()
    texts = [t for pair in pairs for t in pair]
    sims = R.simhashes(texts).view("int64")
    rows = [(k, int(sims[k]), R.NONE if k % 2 else R.WHOLE, " ".join(t)) for k, t in enumerate(texts)]
    segs = spark.createDataFrame(rows, "seg bigint, sim bigint, kind int, words string")
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    near = {k for k in range(1, len(texts), 2) if len(sets[k] & sets[k - 1]) >= 0.8 * len(sets[k] | sets[k - 1])}
    assert 200 < len(near) < len(pairs)
    assert {r["seg"] for r in R.spread_labels(segs).collect()} == near | set(range(0, len(texts), 2))


def judged_one_by_one(text):
    """The definition: each segment by itself, without triggers of the text."""
    found = {}
    for s in R.segments(R.visible(text)):
        key, kind = " ".join(R._WORD.findall(R._DIGITS.sub("0", R.flat(s)))), R.judge(s, ("",))
        old = found.get(key, R.NONE)
        found[key] = R.WHOLE if R.WHOLE in (old, kind) else max(old, kind)
    if found.get("") == R.NONE:
        del found[""]
    return found


def test_texts_are_judged_as_their_segments(spark, data):
    texts = [*RESIDUE, *EARNEST, *UNTRIGGERED, " ".join(RESIDUE), "\n".join(EARNEST + RESIDUE), "a_b __c__\u0301.\u0301 d\u2026 E. \u0130X! \u00df?\n\u0301\n{{ x }}", "1.5 dl. 2,5!\r\n\x85x"]
    texts += [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect() if r["text"]]
    for t in texts:
        assert R.judged_segments(t) == judged_one_by_one(t), t


@given(st.text(alphabet="aB1é.!? \n\t\r\x0b\x0c\x1c\x85\xa0\u2028\u1680_-{}", max_size=30))
@settings(max_examples=400, deadline=None)
def test_any_text_is_cut_as_its_segments(text):
    assert R.judged_segments(text) == judged_one_by_one(text)


KNOWN, LEARNED = "Please enable JavaScript to view this recipe.", "Zur Startseite bitte hier entlang"


def test_messages_are_learned_from_their_pages(spark):
    """A wording that the grammar lacks stands with known ones on three pages, and then alone; kitchen talk beside it stays clean."""
    pages = [f"{KNOWN}\n{LEARNED} ({k})\nQuelle {'abc'[k]}" for k in range(3)]
    clean = [f"Whisk the eggs.\n{x}" for x in ("Stir.", "Fold it in.", "Sieve the flour.", "Rest.")] + ["Whisk the eggs.\n" + KNOWN]
    texts = [*pages, LEARNED + " (7)", *clean]
    assert found(spark, texts) == {0, 1, 2, 3, 8}
    assert found(spark, [pages[0]] * 9 + [LEARNED]) == set(range(9))  # copies of a page are one page
    long = "\n".join(f"Step {w}." for w in "abcdefg")
    assert found(spark, [f"{KNOWN}\n{long}\n{LEARNED} {w}" for w in "xyz"] + [LEARNED + " x"]) == {0, 1, 2}  # no pages
