"""BPE encoding and decoding with an automaton over tokens that is compiled from the merges.

The automaton starts as one state that every base symbol leads back to, where any sequence
of symbols is a path. Each merge (b, a) -> ba adds its gadget, in order of rank: arcs of b
lead from then on to a copy of their state without the arc of a, and wherever b and then a
could be followed an arc of ba leads to the state after a. What is left in the end are the
paths that BPE itself gives, one for each word.

A state is fixed by the token that leads to it, and the arcs it lacks are few intervals once
tokens are numbered along the tree of their left parts: a merge takes from b the arc of a
and those of all tokens that are built from a later on, which are neighbours there. So a row
of the table is a sorted array of interval bounds, and states share a row until a gadget
splits them.
"""

from __future__ import annotations

import functools
import itertools
import json
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm.slices import SLICE_BYTES, by_slices
from feedloom.llm.token_counts import byte_symbols

#: Remembered units and words per worker, of each, and the longest that is remembered; others are encoded each time.
CACHE = 300_000
CACHED_CHARS = 64
#: Below this character the normaliser and the splitting are known here; units with others ask the library.
KNOWN = "԰"
# Fixed value: how a vocabulary with word ends splits lower-case text before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


def barred_with(row: array, start: int, end: int) -> array:
    """The bounds of a row's intervals with [start, end) among them."""
    first, last = bisect_left(row, start), bisect_right(row, end)
    inside = [] if first % 2 else [start]
    inside += [] if last % 2 else [end]
    return row[:first] + array("I", inside) + row[last:]


class Automaton:
    """Deterministic automaton over the tokens of one BPE vocabulary.

    `merges` are (left, right, token) in order of rank, by token id; `labels` what an arc
    emits. `barred[token]` is the row of the state that the token leads to.
    """

    def __init__(self, labels: list[str], merges: list[tuple[int, int, int]]):
        self.labels = labels
        made = {token: (left, rank) for rank, (left, _, token) in enumerate(merges)}
        if len(made) != len(merges):
            raise ValueError("two merges make the same token")
        built: list[list[int]] = [[] for _ in labels]
        for left, _, token in merges:
            built[left].append(token)
        self.place, size = self._number(built, made)
        self.barred = [array("I")] * len(labels)
        known = set(range(len(labels))).difference(made)
        for rank, (left, right, token) in enumerate(merges):
            if left not in known or right not in known:
                raise ValueError(f"merge {rank} uses a token made by a later one")
            if not self.follows(left, right):
                raise ValueError(f"merge {rank} can never be applied")
            # Later tokens that begin with `right` are never added to the copy, nor of a double its own token.
            later = sum(size[t] for t in built[right] if made[t][1] >= rank)
            at = self.place[right]
            self.barred[token] = self.barred[right]
            self.barred[left] = barred_with(self.barred[left], at, at + 1 + later)
            known.add(token)

    @staticmethod
    def _number(built: list[list[int]], made: dict) -> tuple[list[int], list[int]]:
        """Each token's place in the tree of left parts, latest children first, and the size of its subtree."""
        size = [1] * len(built)
        for token in reversed(made):
            size[made[token][0]] += size[token]
        place, at = [0] * len(built), 0
        for token in range(len(built)):
            if token not in made:
                place[token] = at
                at += size[token]
        for parent in [t for t in range(len(built)) if t not in made] + list(made):
            at = place[parent] + 1
            for child in reversed(built[parent]):
                place[child] = at
                at += size[child]
        return place, size

    def follows(self, token: int, after: int) -> bool:
        """The state that `token` leads to has an arc of `after`."""
        return not bisect_right(self.barred[token], self.place[after]) & 1


class WordEncoder:
    """The path of single words, as bytes, through the automaton of a vocabulary with word ends."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        labels = [""] * (max(vocab.values()) + 1)
        for token, number in vocab.items():
            labels[number] = token
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]

        def joined(left: str, right: str) -> int:
            return vocab[left + right]

        self.automaton = Automaton(labels, [(vocab[a], vocab[b], joined(a, b)) for a, b in pairs])
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        reachable = {joined(a, b) for a, b in pairs}
        self.closing: dict[bytes, int] = {}
        self.inner: dict[int, list] = {}  # by byte: the token that ends there, if any, and what may follow
        for token, number in vocab.items():
            closes = bool(suffix) and token.endswith(suffix)
            symbols = token.removesuffix(suffix) if closes else token
            if number not in reachable and len(symbols) != 1:
                continue
            spelled = bytes(byte_of[s] for s in symbols)
            if closes or not suffix:
                self.closing[spelled] = number
            if not closes:
                following = self.inner
                for byte in spelled[:-1]:
                    following = following.setdefault(byte, [None, {}])[1]
                following.setdefault(spelled[-1], [None, {}])[0] = number
        self.longest = max(map(len, vocab))

    def encode(self, word: bytes) -> list[int]:
        """The only path from the start that spells the word.

        From each place the longer tokens are tried first. Only one path leads to a place, so
        none is entered twice, and the work is linear in the word's length.
        """
        barred, place, closing, longest = self.automaton.barred, self.automaton.place, self.closing, self.longest
        at, end, row = 0, len(word) - 1, ()
        path: list[int] = []
        waiting: list[tuple[list[tuple[int, int]], Sequence[int]]] = []
        while True:
            if end - at < longest:
                last = closing.get(word[at:])
                if last is not None and not bisect_right(row, place[last]) & 1:
                    path.append(last)
                    return path
            found = []
            following = self.inner
            for to, byte in enumerate(word[at : min(end, at + longest)], at + 1):
                arc = following.get(byte)
                if arc is None:
                    break
                token, following = arc
                if token is not None:
                    found.append((token, to))
            while True:
                while not found:
                    found, row = waiting.pop()
                    path.pop()
                token, to = found.pop()
                if not bisect_right(row, place[token]) & 1:
                    break
            waiting.append((found, row))
            path.append(token)
            at, row = to, barred[token]


class Encoder:
    """Ids of whole texts as the tokenizer library gives them, without added tokens, and their decoding.

    Special strings inside a text are special tokens. A text is cut at spaces, which no
    word crosses; what a unit between them gives is remembered.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.words = WordEncoder(spec["model"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.labels = self.words.automaton.labels + [""] * len(self.special)
        for content, number in self.special.items():
            self.labels[number] = content
        self.pattern = regex.compile(WORDS)
        self.library = Tokenizer.from_file(path)
        self.byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        self.units: dict[str, bytes] = {"": b""}
        self.paths: dict[bytes, bytes] = {}

    def split(self, text: str) -> list[bytes]:
        """The words of a text without special strings, normalised."""
        if not text.isascii():
            if max(text) >= KNOWN:
                normal = self.library.normalizer.normalize_str(text)
                found = self.library.pre_tokenizer.pre_tokenize_str(normal)
                return [bytes(map(self.byte_of.__getitem__, word)) for word, _ in found]
            # Each character by itself, as the library does: no special form for a final sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if text.isalpha():
            return [text.encode()]
        return [word.encode() for word in self.pattern.findall(text)]

    def path(self, word: bytes) -> bytes:
        found = self.paths.get(word)
        if found is None:
            found = array("i", self.words.encode(word)).tobytes()
            if len(word) <= CACHED_CHARS:
                if len(self.paths) >= CACHE:
                    self.paths = {}
                self.paths[word] = found
        return found

    def whole(self, unit: str) -> bytes:
        if not any(map(unit.__contains__, self.special)):
            return b"".join(map(self.path, self.split(unit)))
        parts = self.at_special.split(unit)
        found = [b"".join(map(self.path, self.split(part))) for part in parts[::2]]
        special = [array("i", [self.special[part]]).tobytes() for part in parts[1::2]]
        return b"".join(itertools.chain.from_iterable(itertools.zip_longest(found, special, fillvalue=b"")))

    def learn(self, unit: str) -> bytes:
        found = self.units.get(unit)
        if found is None:
            found = self.whole(unit)
            if len(unit) <= CACHED_CHARS:
                if len(self.units) >= CACHE:
                    self.units = {"": b""}
                self.units[unit] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit numbers."""
        units = text.replace("\n", " ").split(" ")
        parts = list(map(self.units.get, units))
        if None in parts:
            parts = [self.learn(unit) if part is None else part for unit, part in zip(units, parts)]
        return b"".join(parts)

    def encode_all(self, texts: list[str | None]) -> pa.ListArray:
        encoded = [self.encode(text) if text else b"" for text in texts]
        ends = np.cumsum([0, *map(len, encoded)]) // 4
        ids = pa.array(np.frombuffer(b"".join(encoded), np.int32), pa.int32())
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)

    def decode(self, ids: list[int]) -> str:
        """The labels of a path's arcs; the vocabulary has no decoder, so spaces stay between them."""
        return " ".join(map(self.labels.__getitem__, ids))

    def decode_all(self, rows: pa.ListArray) -> list[str]:
        ids = rows.flatten().to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum([0] + [size or 0 for size in pc.list_value_length(rows).to_pylist()])
        return [self.decode(ids[low:high]) for low, high in itertools.pairwise(ends.tolist())]


@functools.cache
def encoder(path: str) -> Encoder:
    """One compiled vocabulary for all tasks of a worker."""
    return Encoder(path)


def encode(text: Column | str, vocabulary: str) -> Column:
    """The token ids of a text column, as array<int>.

    `vocabulary` is a file of the tokenizers library: BPE over bytes with word ends, lower
    case. The ids are those of the library without begin and end tokens, truncation or
    padding; special strings inside a text are one token each. A null or empty text, or one
    of white space, has no ids. Every row is encoded by itself, so repeated rows, ties and
    other columns make no difference. A worker holds the compiled automaton and a bounded
    memory of units; the time a word takes grows with its length, however long it is.
    """

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from by_slices(batches, encoder(vocabulary).encode_all, pa.list_(pa.int32()))

    return ids(text)


def decode(ids: Column | str, vocabulary: str) -> Column:
    """The text that the arcs of an array of ids emit; null ids give an empty text, an unknown id stops the job."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        emit = encoder(vocabulary).decode_all
        for batch in batches:
            rows = max(1, SLICE_BYTES * len(batch) // max(batch.nbytes, 1))
            parts = [pa.array(emit(batch.slice(at, rows)), pa.string()) for at in range(0, len(batch), rows)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return texts(ids)


def round_trip(text: Column | str, vocabulary: str) -> Column:
    """struct<ids, decoded>: a text column encoded and decoded again in one pass, by the same worker."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(vocabulary)

        def compute(texts: list[str | None]) -> pa.StructArray:
            ids = own.encode_all(texts)
            return pa.StructArray.from_arrays([ids, pa.array(own.decode_all(ids), pa.string())], ["ids", "decoded"])

        kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
        yield from by_slices(batches, compute, kind)

    return both(text)
