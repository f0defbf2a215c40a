"""Template residue and error-page text (problem 8).

Texts are cut into segments (lines, and sentences within them). Segments that a
grammar of residue accepts are trusted labels: unfilled placeholders, filler,
announcements of missing text, printed unset values, error messages, demands for
scripts. The labels are then propagated through connected components of all
distinct segments, which are linked in two ways:

* Near-duplicates. All distinct segments of five words or more get a SimHash of
  their words. Tables of the ten pairs of its five parts find segments near a
  labelled one: all within 3 bits, by the pigeonhole principle, with keys of 25
  bits, so that a bucket holds few segments. A prefix filter on five-word
  shingles finds all that are similar enough, whatever their SimHash. Both are
  confirmed by the Hamming distance or the sizes, and by the Jaccard similarity of
  the shingles.
* Pages. An error page is a short text of several messages. A segment that stands
  with labelled ones on at least MATES different pages of at most PAGE segments,
  and on such pages in at least PURE of all different texts that have it, belongs
  to their component. So a message in a wording that the grammar lacks is learned
  from the company it keeps, and found where it stands alone.

What is confirmed is searched from in turn, until nothing joins: the labels so
reach whole connected components, while components without a label are never
built. A document that holds a labelled segment is residue.

A placeholder within prose labels its own segment only, as the prose around it
is not residue and may stand elsewhere in earnest.

Exact copies are one segment after a pre-aggregated grouping, and copies of a text
are one text, so that copies cost nothing in the search, and pairs are only formed
between a segment newly labelled and one without a label.
"""

from __future__ import annotations

import functools
import html
import re
import unicodedata
from collections.abc import Collection, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramsmith.session import broadcast_if_small, cut, dealt, spread, written

SHINGLE = 5
SIMILARITY = 0.8
HAMMING = 12
#: Parts of a SimHash (first bit and number of bits); a table holds two of them.
PARTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Segments of a page at most, pages that tell a message at least, and their least share of the texts that have it.
PAGE, MATES, PURE = 6, 3, 0.5
NONE, WHOLE, WITHIN = 0, 1, 2

_CUT = re.compile(r"[\r\n\v\f  \x85]+|(?<=[.!?])\s+")
_WORD = re.compile(r"[^\W_]+")
_MARKS, _INVISIBLE = regex.compile(r"[\p{M}\p{Cf}]+"), regex.compile(r"\p{Cf}+")
_DIGITS = re.compile(r"\d+")
_BETWEEN = re.compile(r"[^\w\n]+")

# ---- Fixed values: the signs and words of residue ----------------------------------------------
_NAME = r"[^\W\d_][\w.]*"
PLACEHOLDERS = re.compile(
    "|".join(
        [
            r"\{\{\s*[\w.\-]+\s*\}\}",
            r"\{%|%\}",
            r"<%[=\-]|%>",
            r"[$#]\{\s*[\w.]+\s*\}",
            r"@@[\w.]+@@",
            r"\[\[\s*[\w.]+\s*\]\]",
            rf"(?<![\w%])%{_NAME}%(?![\w%])",
            r"(?<!\S)\{\d\}(?!\S)|^\{\d\}|\{\d\}(?=[:;,.]?\s*$)|\{\d\}(?=:\s)",
            r"\[(?:skriv|insert|enter|ange)\s[^\]]*\]|\[[^\]\[]*\s(?:goes here|here|här)\]",
        ]
    ),
    re.I,
)
#: A slot to fill: an imperative or possessive opener and a slot name, all in capitals or the name that of a variable.
SLOT = re.compile(r"\[\s*([^\W\d_]+)\s+(?:in\s+)?((?:[\w.\-]+\s+){0,3}[\w.\-]+)\s*\]", re.I)
SLOT_OPENERS = set("add your our my fill type write put choose select pick specify provide replace paste din ditt dina fyll välj lägg".split())
_VARIABLE = re.compile(r"[^\W\d]+(?:[_.][^\W_]+)+")
UNDERSCORED = re.compile(rf"(?<![\w])__({_NAME}?)__(?!\w)")
ANGLED = re.compile(r"<([^\W\d_][\w.]*(?:[ _.\-][\w.]+)?)>")
HTML_TAGS = set(
    "a abbr address article aside b base blockquote body br button caption center cite code col dd del details div dl dt em figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins label legend li link main mark menu meta nav noscript ol option p pre q s script section select small span strong style sub sup svg table tbody td textarea tfoot th thead tr tt u ul var video".split()
) - {"base"}
_KNOWN_TAG = re.compile(r"</?(?:" + "|".join(sorted(HTML_TAGS - {"title"}, key=len, reverse=True)) + r")(?:\s[^<>]*)?/?>", re.I)
LOREM = set(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
LOREM_SURE = LOREM - set("do et in sit ad ex ea eu id est non qui sed ut sunt esse tempor magna culpa dolor velit elit minim nulla".split())
FILLER = set("sample text placeholder copy dummy paragraph blah har kommer filler".split())
ANNOUNCED = re.compile(
    r"(?:todo|fixme|tbd|tbc|tba)\W+(?:.*\W)?(?:replace|write|copy|block|launch|editor|insert|fill|placeholder|intro|text)\b.*"
    r"|\W*(?:description|text|content|copy|image|photo|intro)s? (?:pending|coming soon|to come|to follow|goes here|missing)\W*"
    r"|\W*(?:beskrivning|text|innehall)(?:en)? (?:kommer|foljer)(?: inom kort| snart| senare)?\W*"
    r"|\W*(?:texte|description|contenu) a venir\W*"
    r"|\W*hier (?:steht|folgt|entsteht) bald (?:eine? )?(?:beschreibung|text|inhalt)\W*"
    r"|\W*add your (?:description|text|content|title) here\W*(?:click to edit this paragraph\W*)?"
    r"|\W*click to edit this (?:paragraph|text)\W*"
)
# Phrases that announce wherever they stand in a segment.
ANNOUNCING = re.compile(
    r"\bbeskrivning(?:en)? kommer inom kort\b|\bhier steht bald eine beschreibung\b|\btexte a venir\b|\(description pending\)|\badd your description here\b|\bclick to edit this paragraph\b|\breplace this block before launch\b|\btodo: write the\b|\bcopy to come from editor\b"
)
UNSET = re.compile(r"\b(?:undefined|null|nan)\b|\[object object\]")
UNSET_SURE = re.compile(r"\[object object\]|\bserves (?:undefined|null|nan)\b|\b(?:undefined|nan|null) (?:cups?|g|gram|grams|dl|ml|oz|tsp|tbsp|msk|tsk|minutes?|undefined|nan|null)\b")
_THING = r"(?:page|recipe|request|resource|address|site|url|file|document|content)"
ERRORS = re.compile(
    rf"\b(?:the|this|your|that) (?:requested )?{_THING}(?: you (?:requested|are looking for))? (?:could not be (?:processed|found|loaded|displayed)|cannot be (?:processed|found|loaded|displayed)|timed out|is not available|is (?:currently |temporarily )?unavailable|was blocked by the server|does not exist|no longer exists|has (?:been )?(?:moved or been deleted|moved or deleted|moved|deleted|expired)|was not found|may have been (?:moved|removed|deleted))\s*[.!,;:(]*\s*(?:$|(?:try|go|contact|error|status|incident|code)\b)"
    r"|^\W*(?:http|error|serverfel|fehler|erreur|fel)\s*:?\s*(?:4\d\d|5\d\d)\b(?!\s*(?:g|ml|dl|gram|grams)\b)"
    r"|^\W*(?:error code|status|incident|felkod|fehler|erreur|fel)\s+(?:[45]\d\d(?:/[0-9a-f]+)?|[0-9a-f]{8})\W*$"
    r"|^\W*request id: [0-9a-f]+\W*$"
    rf"|\b(?:the|this) (?:requested )?{_THING} \S+ (?:could not be|was not) found on this server\b|\b(?:http|error) [45]\d\d ?[:–\-] ?(?:not found|forbidden|bad gateway|gone|internal server error|service unavailable|gateway time-?out)\b"
    r"|^\W*[45]\d\d\W+(?:page )?(?:not found|forbidden|bad gateway|gone|internal server error|service unavailable|gateway timeout)\W*$"
    r"|^\W*(?:page )?not found\W*$"
    r"|\b(?:bad gateway|internal server error|gateway time-?out|service (?:temporarily )?unavailable)\W*$"
    r"|^\W*(?:go back to the start page|contact the webmaster|try reloading) (?:[45]\d\d)(?:/[0-9a-f]+)?\W*$"
    r"|\bsidan kunde inte hittas\b|\bkontrollera adressen eller ga till startsidan\b|\bett fel uppstod nar sidan skulle visas\b|\bforsok igen om en stund\b"
    r"|\bcette page n.existe plus\b|\bdie angeforderte seite wurde nicht gefunden\b|\bseite nicht gefunden\b\W*$|\bpage introuvable\b\W*$"
    r"|^\W*access denied\W*$|\byou do not have permission to (?:view|access|see)\b"
    r"|\b(?:your )?session (?:has )?expired\b\W*$|^\W*please log in again to continue\b"
    r"|\berror establishing a database connection\b|\bupstream connect error\b|\bdisconnect/reset before headers\b"
    r"|\bfatal error: uncaught\b|\btraceback \(most recent call last\)|^\W*keyerror: '|^\W*file \"[^\"]+\", line \d+, in \w+"
    r"|\bsomething went wrong while loading\b|^\W*try again later\. ?\(code|^\W*\(code [45]\d\d\)\W*$"
    r"|\bwarning: division by zero in\b|\bwarning: \w+\(\)|\bdivision by zero in /|\bunhandled exception\b|\bsegmentation fault\b"
    rf"|\bwe can(?:no|.)?t find the {_THING}\b|\b{_THING} you(?:.re| are) looking for\b|^\W*it may have been (?:removed|moved|deleted)\W*$"
    r"|^\W*too many requests\b|\b(?:the|this|our) (?:service|server|site|website) is (?:temporarily |currently )?(?:unavailable|down)(?: due to| for) maintenance\b|^\W*(?:please )?check back (?:soon|later)\W*$"
)
_SCRIPT = r"(?:javascript|java script|js|scripts?|scripting|java-script)"
SCRIPTS = re.compile(
    rf"(?:^\W*(?:oops\W+|sorry\W+|attention\W+)?|\bplease |\bmust |\bneed to |\bneeds to |\bto continue\W+|\bsorry\W+|\bhave to |\band )(?:enable|activate|turn on|switch on|allow) {_SCRIPT}(?! (?:calculator|file|code))\b"
    rf"|\b{_SCRIPT} (?:is|are|has been|seems to be|appears to be) (?:disabled|turned off|switched off|blocked|required|off)\b"
    rf"|^\W*this (?:page|site|app|recipe|website) (?:requires|needs) {_SCRIPT}\b|\bdoes not support {_SCRIPT}\b|\byour browser (?:has|blocks|does)\b.*\b(?:turned off|{_SCRIPT})"
    r"|\bwon.?t work properly without it\b|\bchecking your browser before continuing\b"
    r"|\b(?:din )?webblasaren? (?:(?:blockerar|kor inte|saknar|stoder inte) (?:java)?s[ck]ript|har stangt av (?:javascript|java script|(?:java)?skript))\b|\b(?:maste|vanligen|var god(?: och)?) aktivera (?:javascript|java script|skript)\b"
    r"|^\W*(?:aktivera|tillat|sla pa) (?:javascript|java script|skript|det)\b"
    r"|\bveuillez activer (?:javascript|les scripts)\b|\bbitte aktivieren sie (?:javascript|skripte)\b|\bbitte (?:javascript|skripte) aktivieren\b"
)
#: Every text that an alternative of the grammar accepts holds one of these in its flat form (a test proves it from the
#: patterns), so a segment without any needs no further work. None has a blank, as tags and line ends may become blanks.
SIGNS = frozenset("{ } < > @ [ % __".split())
UNSET_TRIGGERS = frozenset("undefined null nan object".split())
ANNOUNCED_TRIGGERS = frozenset("todo fixme tbd tbc tba descri conten image photo intro title text beskriv innehall beschreib inhalt click replace copy".split())
ERROR_TRIGGERS = frozenset(
    "could cannot timed available unavailable blocked exist moved deleted removed expired found http error serverfel fehler erreur fel status incident felkod request forbidden gateway gone internal "
    "page webmaster reloading sidan kontrollera forsok cette seite introuvable denied permission session continue connect disconnect fatal traceback keyerror file loading code division warning exception fault "
    "find looking maintenance check many".split()
)
SCRIPT_TRIGGERS = frozenset("script skript js java browser properly webblasar aktivera tillat sla".split())
FILLER_TRIGGERS = frozenset(LOREM_SURE | (FILLER - {"har"}))
TRIGGERS = tuple(sorted(SIGNS | UNSET_TRIGGERS | ANNOUNCED_TRIGGERS | ERROR_TRIGGERS | SCRIPT_TRIGGERS | FILLER_TRIGGERS))
# -------------------------------------------------------------------------------------------------


def flat(text: str) -> str:
    """Compatibility forms without case and marks; invisible characters and odd blanks removed."""
    if text.isascii():
        return text.lower()
    return _MARKS.sub("", unicodedata.normalize("NFKD", text.casefold()))


def visible(text: str) -> str:
    """Entities resolved and compatibility forms, case kept."""
    if "&" in text:
        text = html.unescape(text)
    return text if text.isascii() else _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))


def segments(text: str) -> list[str]:
    return [s for s in (" ".join(x.split()) for x in _CUT.split(text)) if s]


def _placeholder(seg: str) -> bool:
    if PLACEHOLDERS.search(seg):
        return True
    for m in SLOT.finditer(seg):
        if m[1].lower() in SLOT_OPENERS and (m[0].isupper() or _VARIABLE.fullmatch(m[2])):
            return True
    for m in UNDERSCORED.finditer(seg):
        if m[1].isupper() or "_" in m[1] or "." in m[1] or seg == seg.lower():
            return True
    return any(m[1].lower() not in HTML_TAGS and f"</{m[1].lower()}>" not in seg.lower() for m in ANGLED.finditer(seg))


def _filler(words: list[str]) -> bool:
    run = sure = odd = kinds = 0
    seen: set[str] = set()
    for w in words:
        if w in LOREM:
            run, sure = run + 1, sure + (w in LOREM_SURE)
            if run >= 5 and sure >= 3:
                return True
        else:
            run = sure = 0
        if w in FILLER:
            seen.add(w)
            odd += 1
            kinds = len(seen)
            if odd >= 4 and (kinds >= 2 or odd >= 6):
                return True
        else:
            odd = kinds = 0
            seen.clear()
    return bool(words) and len(words) <= 5 and all(w in LOREM for w in words) and any(w in ("lorem", "ipsum") for w in words)


def may_hold(low: str, triggers: Collection[str] = TRIGGERS) -> bool:
    """Whether the flat form of a text can hold residue: a trigger, or nothing but "har" as filler."""
    return any(map(low.__contains__, triggers)) or low.count("har") >= 6


def judge(seg: str, triggers: Collection[str] = TRIGGERS) -> int:
    """NONE, WHOLE (the segment is residue) or WITHIN (a placeholder stands in it). triggers: those that the text has."""
    return _judged(seg, flat(seg), triggers)


def _judged(seg: str, low: str, triggers: Collection[str]) -> int:
    """The same for a segment whose flat form is known."""
    if not may_hold(low, triggers):
        return NONE
    if "<" in seg:
        low = flat(_KNOWN_TAG.sub(" ", seg))
    has = {t for t in triggers if t in low}
    every = "" in has
    if (every or has & FILLER_TRIGGERS or "har" in low) and _filler(_WORD.findall(low)):
        return WHOLE
    if (every or has & ANNOUNCED_TRIGGERS) and (ANNOUNCED.fullmatch(low) or ANNOUNCING.search(low)):
        return WHOLE
    if (every or has & UNSET_TRIGGERS) and (UNSET_SURE.search(low) or len(UNSET.findall(low)) >= 2):
        return WHOLE
    if (every or has & ERROR_TRIGGERS) and ERRORS.search(low) or (every or has & SCRIPT_TRIGGERS) and SCRIPTS.search(low):
        return WHOLE
    return WITHIN if (every or not SIGNS.isdisjoint(triggers)) and _placeholder(seg) else NONE


class _Votes:
    """Bits of words as 64 counters of a byte each, in eight numbers, so that sums of words are sums of numbers."""

    SIZE = 1 << 17

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.lanes = np.zeros((self.SIZE, 8), dtype=np.uint64)
        self.hashes = np.zeros(self.SIZE, dtype=np.uint64)

    def lanes_of(self, texts: list[list[str]]) -> np.ndarray:
        """A number for each word of all texts, one after the other; equal for equal words."""
        return self.hashes[self.places(texts)]

    def places(self, texts: list[list[str]]) -> np.ndarray:
        place, new, out = self.place, [], []
        for ws in texts:
            for w in ws:
                k = place.get(w)
                if k is None:
                    k = place[w] = len(place)
                    new.append(w)
                out.append(k)
        if len(place) > len(self.lanes):
            self.lanes = np.concatenate([self.lanes, np.zeros((len(place), 8), dtype=np.uint64)])
            self.hashes = np.concatenate([self.hashes, np.zeros(len(place), dtype=np.uint64)])
        if new:
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in new], dtype="<u8")
            self.hashes[len(place) - len(new) : len(place)] = hashes
            self.lanes[len(place) - len(new) : len(place)] = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view("<u8")
        return np.array(out)


_votes = _Votes()
#: Counters of a byte hold the votes of as many words; longer segments are summed in pieces.
_PIECE = 255


def simhashes(texts: list[list[str]]) -> np.ndarray:
    """64-bit SimHashes of lists of words, each of one word at least."""
    global _votes
    if len(_votes.place) > 300_000:
        _votes = _Votes()
    if not texts:
        return np.zeros(0, dtype=np.uint64)
    pieces = [t[k : k + _PIECE] for t in texts for k in range(0, len(t), _PIECE)]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])[:-1]])
    counts = np.add.reduceat(_votes.lanes[_votes.places(pieces)], starts, axis=0).view(np.uint8)
    sizes = np.array([len(t) for t in texts])
    if len(pieces) > len(texts):
        first = np.concatenate([[0], np.cumsum(-(-sizes // _PIECE))[:-1]])
        counts = np.add.reduceat(counts.astype(np.int64), first, axis=0)
    return np.packbits(counts * np.int64(2) > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()


SEGMENT_SCHEMA = "doc_id bigint, page bigint, n int, kind int, words string"
_OUT = pa.schema([("doc_id", pa.int64()), ("page", pa.int64()), ("n", pa.int32()), ("kind", pa.int32()), ("words", pa.string())])
_CHUNK = 20_000


_BREAKS, _BLANKS = "\r\v\f\x85\u2028\u2029", "\t\x1c\x1d\x1e\x1f\u1680"
#: ASCII text to words: all but letters, digits and line ends is a blank.
_TO_WORDS = {c: " " for c in range(128) if not chr(c).isalnum() and chr(c) != "\n"}


def _cut(text: str) -> str:
    """A text in compatibility form with a line end wherever ``segments`` cuts, and more blanks at most."""
    for c in _BREAKS:
        text = text.replace(c, "\n")
    for c in _BLANKS:
        text = text.replace(c, " ")
    return text.replace(". ", ".\n").replace("! ", "!\n").replace("? ", "?\n")


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for t in TRIGGERS:
        found.add_word(t, t)
    found.make_automaton()
    return found


def judged_segments(text: str) -> dict[str, int]:
    """The kind of each distinct segment of a text, by its words.

    Digits are one, so that numbers don't tell segments apart. The text is cut and
    folded as a whole (folding neither makes nor removes a line end), and its
    segments are judged only if it holds a trigger.
    """
    shown = _cut(visible(text))
    low = flat(shown)
    words = _DIGITS.sub("0", low)
    words = words.translate(_TO_WORDS) if words.isascii() else _BETWEEN.sub(" ", words.replace("_", " "))
    keys = [" ".join(x.split()) for x in words.split("\n")]
    found = dict.fromkeys(keys, NONE)
    if triggers := {t for _, t in _automaton().iter(low)} or ({"har"} if low.count("har") >= 6 else ()):
        for key, seg, folded in zip(keys, shown.split("\n"), low.split("\n"), strict=True):
            if may_hold(folded, triggers) and (kind := _judged(" ".join(seg.split()), " ".join(folded.split()), triggers)):
                found[key] = WHOLE if WHOLE in (found[key], kind) else WITHIN
    if found.get("") == NONE:
        del found[""]
    return found


def cut_segments(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, page (a hash of the segments of the text), n (its segments), kind and words of each distinct segment of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids: list[int] = []
            pages: list[int] = []
            sizes: list[int] = []
            kinds: list[int] = []
            words: list[str] = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not t or i is None:
                    continue
                found = judged_segments(t)
                n = len(found)
                ids += [i] * n
                pages += [xxhash.xxh64_intdigest("\n".join(found)) - (1 << 63)] * n
                sizes += [n] * n
                kinds += found.values()
                words += found
                if len(ids) >= _CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip((ids, pages, sizes, kinds, words), _OUT.types, strict=True)], schema=_OUT)
                    ids, pages, sizes, kinds, words = [], [], [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip((ids, pages, sizes, kinds, words), _OUT.types, strict=True)], schema=_OUT)

    return spread(docs.select(doc_id, text)).mapInArrow(run, SEGMENT_SCHEMA)


_KEYED = pa.schema([("seg", pa.int64()), ("sim", pa.int64()), ("kind", pa.int32()), ("words", pa.string()), ("size", pa.int32()), ("prefix", pa.list_(pa.int64()))])


def prefixes(texts: list[list[str]]) -> tuple[np.ndarray, pa.ListArray]:
    """The number of distinct shingles of each text of five words or more, and its size // 5 + 1 least shingle hashes.

    Of two segments of Jaccard similarity 4/5 at least, each lacks a fifth of its
    shingles at most in the other, so the least hash that both have is among
    these on both sides: equal hashes find every such pair.
    """
    sizes = np.array([len(t) for t in texts])
    word = _votes.lanes_of(texts)
    at = np.cumsum(sizes) - sizes
    # Every place that has SHINGLE words of its own text from it on.
    owner = np.repeat(np.arange(len(texts)), sizes - SHINGLE + 1)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(sizes - SHINGLE + 1) - (sizes - SHINGLE + 1), sizes - SHINGLE + 1) + at[owner]
    mixed = np.zeros(len(owner), dtype=np.uint64)
    for k in range(SHINGLE):
        mixed = (mixed ^ word[start + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.lexsort((mixed, owner))
    owner, mixed = owner[order], mixed[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (mixed[1:] != mixed[:-1])
    owner, mixed = owner[new], mixed[new]
    size = np.bincount(owner, minlength=len(texts))
    kept = size // 5 + 1
    first = np.cumsum(size) - size
    take = np.arange(len(owner)) - first[owner] < kept[owner]
    return size, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32()), pa.array(mixed[take].view(np.int64)))


def fingerprints(segs: DataFrame) -> DataFrame:
    """seg, sim, kind, words, size and prefix of segments (seg, kind, words, and their SimHash if they have one) of five words or more."""
    given = "sim" in segs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            texts = [w.split(" ") for w in b.column(2).to_pylist()]
            sim = b.column(3) if given else pa.array(simhashes(texts).view(np.int64))
            size, prefix = prefixes(texts)
            yield pa.RecordBatch.from_arrays([b.column(0), sim, b.column(1), b.column(2), pa.array(size, pa.int32()), prefix], schema=_KEYED)

    long = segs.filter(F.size(F.split("words", " ")) >= SHINGLE).select("seg", F.col("kind").cast("int").alias("kind"), "words", *(["sim"] if given else []))
    return long.mapInArrow(run, "seg bigint, sim bigint, kind int, words string, size int, prefix array<bigint>")


#: Keys of SimHash tables are below it; those of shingles are hashes of 64 bits.
_TABLE_KEYS = 1 << 31


def _candidates(df: DataFrame) -> DataFrame:
    """A row for each two parts of the SimHash and for each shingle of the prefix."""
    part = lambda p: F.shiftrightunsigned("sim", p[0]).bitwiseAND(F.lit((1 << p[1]) - 1))
    pairs = [(i, j) for i in range(len(PARTS)) for j in range(i)]
    keys = F.array(*[part(PARTS[i]) * F.lit(1 << 17) + part(PARTS[j]) * F.lit(16) + F.lit(k) for k, (i, j) in enumerate(pairs)])
    return df.select("seg", "sim", "size", F.explode(F.concat(keys, "prefix")).alias("key"))


def shingles(words: Column) -> Column:
    """The distinct five-word shingles of a text of five words or more."""
    ws = F.split(words, " ")
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(ws) - SHINGLE), lambda k: F.concat_ws(" ", F.slice(ws, k + 1, SHINGLE))))


def _alike_in_size(a: Column, b: Column) -> Column:
    return (a * 5 >= b * 4) & (b * 5 >= a * 4)


def _near(frontier: DataFrame, open_: DataFrame) -> DataFrame:
    """Open segments (seg) near one of the frontier."""
    ends = F.col("a.seg").alias("from_seg"), F.col("b.seg").alias("to_seg")
    met = broadcast_if_small(_candidates(frontier)).alias("a").join(_candidates(open_).alias("b"), "key")
    in_table = F.col("key").between(0, _TABLE_KEYS - 1)
    near = F.bit_count(F.col("a.sim").bitwiseXOR(F.col("b.sim"))) <= HAMMING
    near = met.filter(F.when(in_table, near).otherwise(_alike_in_size(F.col("a.size"), F.col("b.size")))).select(*ends).distinct()
    a = frontier.select(F.col("seg").alias("from_seg"), F.col("words").alias("from_words"))
    b = open_.select(F.col("seg").alias("to_seg"), F.col("words").alias("to_words"))
    pairs = dealt(near, "from_seg", "to_seg").join(a, "from_seg").join(b, "to_seg").select("to_seg", shingles(F.col("from_words")).alias("x"), shingles(F.col("to_words")).alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    alike = both >= SIMILARITY * (F.size("x") + F.size("y") - both)
    return pairs.filter(alike).select(F.col("to_seg").alias("seg")).distinct()


def _mates(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Segments (seg) without a label that keep company with labelled ones. rows: page, n, kind, seg of all texts."""
    on_pages = rows.filter(F.col("n") <= PAGE).select("page", "seg", "kind").distinct()
    known = broadcast_if_small(labelled)
    pages = on_pages.join(known, "seg", "left_semi").select("page").distinct()
    mates = on_pages.filter(F.col("kind") == NONE).join(known, "seg", "left_anti").join(pages, "page", "left_semi")
    told = cut(mates.groupBy("seg").agg(F.count(F.lit(1)).alias("told")).filter(F.col("told") >= MATES))
    texts = rows.join(broadcast_if_small(told.select("seg")), "seg", "left_semi").select("seg", "page").distinct().groupBy("seg").agg(F.count(F.lit(1)).alias("texts"))
    return told.join(texts, "seg").filter(F.col("told") >= PURE * F.col("texts")).select("seg")


def spread_labels(segs: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Segments (seg) that a trusted label reaches, the trusted ones included.

    segs: seg, kind, words, and what ``fingerprints`` adds if it is there. rows:
    page, n, kind and seg of each segment of each text; without them only
    near-duplicates are linked. The frontier of a round is what the round before
    has labelled.
    """
    long = segs if "prefix" in segs.columns else fingerprints(segs)
    labelled = segs.filter(F.col("kind") == WHOLE).select("seg")
    if rows is not None:
        labelled = cut(rows.filter(F.col("kind") == WHOLE).select("seg").distinct())
    if rows is not None:
        rows = rows.select("page", "n", "kind", "seg")
    frontier, open_ = long.filter(F.col("kind") == WHOLE), long.filter(F.col("kind") == NONE)
    reached = [labelled]
    while True:
        new = _near(frontier, open_)
        if rows is not None:
            new = new.unionByName(_mates(rows, _union(reached))).distinct()
        new = cut(new)
        if new.isEmpty():
            return _union(reached)
        reached.append(new)
        new = broadcast_if_small(new)
        frontier = cut(open_.join(new, "seg", "left_semi"))
        open_ = open_.join(new, "seg", "left_anti")


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def residue(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id of every document that holds residue, once an id.

    Null, empty and blank texts hold none; a null id is never reported; an id of
    several rows is reported if one of them holds residue. Whole texts are read.
    The segments are written once to the shared checkpoint folder.
    """
    # Words with a placeholder among them are another segment than the same words without.
    seg = F.xxhash64(F.col("kind") == WITHIN, "words")
    rows = written(cut_segments(docs, doc_id, text).withColumn("seg", seg))
    segs = rows.filter(F.col("kind") != WITHIN).groupBy("seg", "words").agg(F.max("kind").alias("kind"))
    whole = spread_labels(written(fingerprints(dealt(segs, "seg"))), rows)
    within = rows.filter(F.col("kind") == WITHIN).select("doc_id")
    return rows.join(broadcast_if_small(whole), "seg", "left_semi").select("doc_id").unionByName(within).distinct()
