"""Token counts of whole texts by rank-synchronous merging.

Pre-tokens of many texts are held together as one ragged numpy array of symbols. In each
step every sequence applies its own lowest-rank pair, all at once and at all places of
that pair, until no sequence has a pair left; a count is then the number of symbols that
survived. Only distinct pre-tokens are merged.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.slices import by_slices

# Fixed value: how a byte-level vocabulary of this family splits text before merging.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
NO_RANK = np.iinfo(np.int64).max
#: Remembered counts per worker, of units and of pre-tokens; beyond it they are forgotten and counted anew.
CACHE = 700_000
#: Characters whose new units are merged together.
CHUNK = 4_000_000
IRREGULAR = -(1 << 60)


def byte_symbols() -> list[str]:
    """The character a byte-level vocabulary writes for each byte.

    Printable bytes stand for themselves, the others take the characters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(others)) for byte in range(256)]


class Merger:
    """The merges of one byte-level BPE vocabulary, applied to many sequences at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.byte_ids = np.array([vocab[s] for s in byte_symbols()], np.int64)
        self.base = len(vocab) + len(self.special) + 1
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in merges], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NO_RANK)

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols left of each (non-empty) sequence."""
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
        left = sizes.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), sizes)
        rank = np.full(len(symbols), NO_RANK)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.ranks(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(symbols)])
            lowest = np.minimum.reduceat(rank, starts)
            going = np.repeat(lowest < NO_RANK, lengths)
            left[owner[starts]] = lengths
            if not going.any():
                break
            symbols, owner, rank = symbols[going], owner[going], rank[going]
            lowest = np.repeat(lowest, lengths)[going]
            # Left to right without overlap: of a run of hits (a pair of equal symbols) every other one.
            hit = rank == lowest
            place = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
            first = np.flatnonzero(hit & ((place - run) % 2 == 0))
            symbols[first] = self.merged[rank[first]]
            kept = np.ones(len(symbols), bool)
            kept[first + 1] = False
            now = (np.cumsum(kept) - 1)[first]
            symbols, owner, rank = symbols[kept], owner[kept], rank[kept]
            changed = np.unique(np.r_[now, now[now > 0] - 1])
            rank[changed] = NO_RANK
            inner = changed[changed < len(symbols) - 1]
            inner = inner[owner[inner] == owner[inner + 1]]
            rank[inner] = self.ranks(symbols[inner], symbols[inner + 1])
        return left


class TextCounter:
    """Tokens of texts, remembering the counts of what recurs.

    A text is cut at single spaces between other characters: no pre-token crosses such a
    cut, as its space always opens the next one. A text with other white space at a cut
    is split whole.
    """

    def __init__(self, path: str):
        self.merger = Merger(path)
        self.pattern = regex.compile(PRE_TOKEN)
        self.special = regex.compile("|".join(map(regex.escape, self.merger.special)) or r"(?!)")
        self.units: dict[str, int] = {}
        self.tokens: dict[str, int] = {}

    def merge(self, new: set[str]) -> None:
        if len(self.tokens) + len(new) > CACHE:
            self.tokens.clear()
        texts = list(new)
        counted = self.merger.counts([text.encode() for text in texts]) if texts else ()
        self.tokens.update(zip(texts, map(int, counted)))

    def whole(self, segments: list[str]) -> list[int]:
        """Tokens of segments without special strings, each split whole."""
        split = [self.pattern.findall(segment) for segment in segments]
        wanted = set().union(*split)
        new = wanted.difference(self.tokens)
        if len(self.tokens) + len(new) > CACHE:
            self.tokens.clear()
            new = wanted
        self.merge(new)
        return [sum(map(self.tokens.__getitem__, tokens)) for tokens in split]

    def learn(self, new: list[str]) -> None:
        regular = []
        for unit in new:
            if not unit or unit[0].isspace() or unit[-1].isspace():
                self.units[unit] = IRREGULAR
            else:
                regular.append(unit)
        self.units.update(zip(regular, self.whole([" " + unit for unit in regular])))

    def chunk(self, texts: list[str]) -> list[int]:
        special = [bool(self.special.search(text)) for text in texts]
        split = [() if odd else text.split(" ") for text, odd in zip(texts, special)]
        wanted = set().union(*(units[1:] for units in split))
        new = wanted.difference(self.units)
        if len(self.units) + len(new) > CACHE:
            self.units.clear()
            new = wanted
        self.learn(list(new))
        heads = self.whole([units[0] if units else "" for units in split])
        counts = []
        for text, units, odd, head in zip(texts, split, special, heads):
            if odd:
                parts = self.special.split(text)
                counts.append(sum(self.whole(parts)) + len(parts) - 1)
                continue
            edge = len(units) > 1 and (not units[0] or units[0][-1].isspace())
            rest = sum(map(self.units.__getitem__, units[1:]))
            counts.append(self.whole([text])[0] if edge or rest < 0 else head + rest)
        return counts

    def counts(self, texts: Iterable[str | None]) -> list[int]:
        counts: list[int] = []
        waiting: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            waiting.append(text)
            size += len(text)
            if size > CHUNK:
                counts += self.chunk(waiting)
                waiting, size = [], 0
        return counts + (self.chunk(waiting) if waiting else [])


def token_counter(vocabulary: str):
    """A column function: the tokens of a text column, null counting as empty."""

    @F.arrow_udf("bigint")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from by_slices(batches, TextCounter(vocabulary).counts, pa.int64())

    return tokens


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    text: str = "text",
    limit: int = 512,
    names: tuple[str, str, str] = ("n_bytes", "n_tokens", "over_limit"),
) -> DataFrame:
    """All columns of `docs` and three more: UTF-8 bytes, tokens, and tokens > `limit`.

    Counts are those the tokenizer library gives for the whole text without added tokens;
    special strings inside a text count as one token each. Null and empty texts have 0
    bytes and 0 tokens. Repeated rows each keep their row. A column of `docs` with one of
    the three names is replaced. One narrow pass, without a shuffle; what a worker
    remembers is bounded by CACHE.
    """
    n_bytes, n_tokens, over_limit = names
    column: Column = F.col(f"`{text}`")
    tokens = token_counter(vocabulary)
    return docs.withColumns(
        {n_bytes: F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint"), n_tokens: tokens(column)}
    ).withColumn(over_limit, F.col(n_tokens) > limit)
