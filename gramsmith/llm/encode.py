"""Encoding of a corpus with a public byte-level BPE vocabulary (problem 6).

Prefix-sharing trie traversal. The distinct words of a batch, sorted by their
bytes, are their trie in depth-first order: what a word shares with the one
before it is the path that both have in common. Along the path goes one state,
the last token of the encoding of the prefix. A prefix has exactly one token t
that ends it such that the encoding of the rest, followed by t, is an encoding;
whether it is depends only on the last token of the rest and t. So the state of
a node follows from the states above it, shared prefixes are encoded once, and
the encoding of a word is read backwards along its path.

Whether two tokens may follow each other is decided by merging their bytes, once
for each pair. No text leaves its partition: the encoding is a map.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gramsmith.session import spread

# Fixed value: the pattern by which the vocabulary's words are split.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Encoded words and pairs kept by a worker; beyond it they are computed anew.
MEMO_WORDS = 300_000
MEMO_PAIRS = 1_000_000
#: Words longer than this are encoded but not kept, and found by an automaton.
LONG_WORD = 200


class TrieEncoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}
        self.split = regex.compile(PATTERN).findall

    def merge(self, data: bytes) -> list[int]:
        """The merges of the vocabulary, lowest rank first; for the bytes of two tokens at most."""
        parts = [data[k : k + 1] for k in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = min((ranks.get(parts[k] + parts[k + 1], 1 << 60), k) for k in range(len(parts) - 1))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def follows(self, a: int, b: int) -> bool:
        key = (a, b)
        if key not in self.pairs:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            self.pairs[key] = self.merge(self.bytes[a] + self.bytes[b]) == [a, b]
        return self.pairs[key]

    def reachable(self, t: int) -> bool:
        if t not in self.whole:
            self.whole[t] = self.merge(self.bytes[t]) == [t]
        return self.whole[t]

    def traverse(self, words: list[bytes]) -> Iterator[list[int]]:
        """Encodings of words that are sorted and distinct, by depth-first traversal of their trie."""
        ranks, longest = self.ranks, self.longest
        path = b""
        last: list[int] = []  # last[d]: the last token of the first d + 1 bytes of the path
        for word in words:
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared:]
            if len(word) - shared > LONG_WORD:
                self._extend(word, last)
            for d in range(len(last), len(word)):
                for start in range(max(0, d + 1 - longest), d + 1):
                    t = ranks.get(word[start : d + 1])
                    if t is not None and (self.follows(last[start - 1], t) if start else self.reachable(t)):
                        last.append(t)
                        break
            path = word
            ids, d = [], len(word)
            while d:
                t = last[d - 1]
                ids.append(t)
                d -= len(self.bytes[t])
            yield ids[::-1]

    def _extend(self, word: bytes, last: list[int]) -> None:
        """The states of a long way down the trie, from the tokens that end at each byte only, longest first.

        An automaton of all tokens finds them in one pass, so that a word of
        megabytes costs a few steps a byte and not one for each length of token.
        """
        begin = max(0, len(last) + 1 - self.longest)
        for end, t in self.automaton.iter(word.decode("latin-1"), begin):
            start = end + 1 - len(self.bytes[t])
            if end == len(last) and (self.follows(last[start - 1], t) if start else self.reachable(t)):
                last.append(t)

    @functools.cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for b, t in self.ranks.items():
            found.add_word(b.decode("latin-1"), t)
        found.make_automaton()
        return found

    def learn(self, words: set[str]) -> None:
        order = sorted((w.encode(), w) for w in words)
        for (_, w), ids in zip(order, self.traverse([b for b, _ in order]), strict=True):
            self.words[w] = ids

    def encode(self, texts: list[str | None]) -> tuple[array, array]:
        """The ids of all texts in one array, and the offsets of the texts in it."""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.words) >= MEMO_WORDS:
            self.words.clear()
        known = self.words
        self.learn({w for words in split for w in words if w not in known})
        ids, offsets = array("i"), array("i", [0])
        for words in split:
            for w in words:
                ids.extend(known[w])
            offsets.append(len(ids))
        for w in [w for words in split for w in words if len(w) > LONG_WORD]:
            known.pop(w, None)
        return ids, offsets


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(i) for t, i in (line.split() for line in data.splitlines() if line)}


_kept: dict[bytes, TrieEncoder] = {}


def _encoder(data: bytes) -> TrieEncoder:
    if data not in _kept:
        _kept.clear()
        _kept[data] = TrieEncoder(parse_ranks(data))
    return _kept[data]


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """doc_id and ids of every row; path: a vocabulary file of base64 tokens with their ranks.

    Empty and null texts have an empty list. Texts are encoded whole, whatever
    their length; strings of special tokens are ordinary text. Repeated rows give
    repeated results. The file, of fixed size, is read on the driver and sent to
    the workers.
    """
    with open(path, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data.value)
        for b in batches:
            ids, offsets = encoder.encode(b.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(memoryview(offsets), pa.int32()), pa.array(memoryview(ids), pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), lists], schema=out)

    return spread(docs.select(id_col, text_col)).mapInArrow(run, "doc_id bigint, ids array<int>")
