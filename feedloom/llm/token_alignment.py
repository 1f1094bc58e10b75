"""Alignment of two tokenizers' tokens of the same text by divide and conquer at shared cuts.

A cut is a byte at which a token of either side ends. An interval between two cuts is split
at a common end near its middle, which is looked up by bisecting the other side's ends, and
both halves are worked on alike; an interval without a common end inside is a leaf, a group
of tokens that only together cover the same bytes. Intervals of many texts are halved
together in numpy.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from feedloom.llm.token_counts import byte_symbols
from feedloom.operators.lookup import BROADCAST_BYTES, lookup_join
from feedloom.workspace import settle

#: Remembered units per worker, and the longest that is remembered; others are encoded each time.
CACHE = 250_000
CACHED_CHARS = 64
#: Text of the rows that are aligned together.
SLICE_BYTES = 2 << 20
#: Ends looked at around an interval's middle grow by this factor while none is shared.
WIDEN = 4
#: A space that opens a token in both vocabularies, whatever is before and after it.
CUT = re.compile(r"(?<! ) (?=\S)")
#: Where a text has none of these, every space of it is a cut.
ODD = re.compile(r"\A\s| (?:\s|\Z)")
#: Units that are encoded as one text.
TOGETHER = 256


def halved(ends_a: np.ndarray, ends_b: np.ndarray, tops_a: np.ndarray, tops_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of A and of B before each cut, in order.

    `ends_a` and `ends_b` are the ascending bytes where tokens end, of many texts laid
    behind each other; `tops_a` and `tops_b` the numbers of tokens up to each text's end,
    which are cuts by themselves.
    """
    cuts = [tops_a], [tops_b]
    low_a, low_b, high_a, high_b = np.r_[0, tops_a[:-1]], np.r_[0, tops_b[:-1]], tops_a, tops_b
    while len(low_a):
        inside = (high_a - low_a > 1) & (high_b - low_b > 1)
        low_a, high_a, low_b, high_b = low_a[inside], high_a[inside], low_b[inside], high_b[inside]
        cut_a, cut_b = common_ends(ends_a, ends_b, low_a, high_a - 2)
        split = cut_a >= 0  # the others are leaves
        cut_a, cut_b = cut_a[split] + 1, cut_b[split] + 1
        cuts[0].append(cut_a)
        cuts[1].append(cut_b)
        # Left and right halves in turn, so that intervals stay in order.
        low_a, high_a = np.column_stack([low_a[split], cut_a]).ravel(), np.column_stack([cut_a, high_a[split]]).ravel()
        low_b, high_b = np.column_stack([low_b[split], cut_b]).ravel(), np.column_stack([cut_b, high_b[split]]).ravel()
    places = []
    for own, ends in zip(cuts, (ends_a, ends_b)):
        marked = np.zeros(len(ends), bool)
        marked[np.concatenate(own) - 1] = True
        places.append(np.flatnonzero(marked) + 1)
    return places[0], places[1]


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the token of A, of those from `first` to `last`, with a shared end nearest the middle,
    and the token of B that ends there; -1 without one."""
    middle = (first + last) // 2
    cut_a, cut_b = np.full(len(first), -1), np.full(len(first), -1)
    found = np.searchsorted(ends_b, ends_a[middle])
    hit = ends_b[found] == ends_a[middle]
    cut_a[hit], cut_b[hit] = middle[hit], found[hit]
    waiting, reach = np.flatnonzero(~hit & (first < last)), WIDEN
    while len(waiting):
        # The ends in growing windows around the middle, each bisected among the other side's ends.
        low = np.maximum(first[waiting], middle[waiting] - reach)
        high = np.minimum(last[waiting], middle[waiting] + reach)
        width = high - low + 1
        owner = np.repeat(np.arange(len(waiting)), width)
        ends = np.arange(len(owner)) + np.repeat(low - np.cumsum(width) + width, width)
        found = np.searchsorted(ends_b, ends_a[ends])
        shared = ends_b[found] == ends_a[ends]
        owner, ends, found = owner[shared], ends[shared], found[shared]
        away = np.abs(ends - middle[waiting][owner])
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        least = np.repeat(np.minimum.reduceat(away, starts), np.diff(starts, append=len(owner))) if len(owner) else away
        # Of two as near the later one is written last.
        at = away == least
        cut_a[waiting[owner[at]]], cut_b[waiting[owner[at]]] = ends[at], found[at]
        left = (cut_a[waiting] < 0) & ((low > first[waiting]) | (high < last[waiting]))
        waiting, reach = waiting[left], reach * WIDEN
    return cut_a, cut_b


class Pair:
    """Both vocabularies: byte-level BPE of the tokenizers library (A) and a sentencepiece model (B)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread's work
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        size = max(self.a.get_vocab().values()) + 1
        self.bytes_a = [b""] * size
        for token, number in self.a.get_vocab().items():
            self.bytes_a[number] = bytes(byte_of[s] for s in token if s in byte_of)
        self.bytes_b = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            if self.b.is_byte(number):
                self.bytes_b.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.bytes_b.append(piece.replace("▁", " ").encode())
        self.sizes_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Each id's digits, right-aligned before a place for what follows it; zeros are left out.
        self.digits = np.zeros((max(size, len(self.bytes_b)), len(str(max(size, len(self.bytes_b)))) + 1), np.uint8)
        for number in range(len(self.digits)):
            text = str(number).encode()
            self.digits[number, -1 - len(text) : -1] = list(text)
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}  # by unit, without its space

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B of texts that begin with a space."""
        in_a = self.a.encode_batch_fast(texts, add_special_tokens=False)
        in_b = self.b.encode([text[1:] for text in texts], num_threads=1)
        blank = [self.b.piece_to_id("▁")]  # nothing gives nothing, not the space that B puts before
        return [
            (np.array(a.ids, np.int32), np.array(b if text != " " else blank, np.int32))
            for text, a, b in zip(texts, in_a, in_b)
        ]

    def learn(self, units: list[str]) -> dict[str, tuple[bytes, bytes, bool]]:
        """(ids of A, ids of B, both spell the unit) of units, a space before each; many are encoded as one text."""
        found: dict[str, tuple[bytes, bytes, bool]] = {}
        # A space at a unit's end would join the next one's.
        alone = [unit for unit in units if not unit or unit[-1] == " "]
        units = [unit for unit in units if unit and unit[-1] != " "]
        for unit, (a, b) in zip(alone, self.encode([" " + unit for unit in alone]) if alone else ()):
            found[unit] = a.tobytes(), b.tobytes(), self.spells(" " + unit, a, b)
        parts = [units[at : at + TOGETHER] for at in range(0, len(units), TOGETHER)]
        for part, (a, b) in zip(parts, self.encode([" " + " ".join(part) for part in parts]) if parts else ()):
            sizes = np.cumsum([len(unit.encode()) + 1 for unit in part])
            ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
            cuts_a, cuts_b = np.searchsorted(ends_a, sizes, "right"), np.searchsorted(ends_b, sizes, "right")
            if not self.spells(" " + " ".join(part), a, b):
                alone = zip(part, self.encode([" " + unit for unit in part]))
                found.update((unit, (x.tobytes(), y.tobytes(), self.spells(" " + unit, x, y))) for unit, (x, y) in alone)
                continue
            a, b, low_a, low_b = a.tobytes(), b.tobytes(), 0, 0
            for unit, high_a, high_b in zip(part, (cuts_a * 4).tolist(), (cuts_b * 4).tolist()):
                found[unit] = a[low_a:high_a], b[low_b:high_b], True
                low_a, low_b = high_a, high_b
        return found

    def tokens(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids of A and of B as 32-bit numbers; nothing for a text that either side does not spell."""
        split = []
        for text in texts:
            if not text:
                split.append([])
            elif ODD.search(text):
                split.append(CUT.split(" " + text))
            else:
                split.append(["", *text.split(" ")])
        # What is before the first cut has its space already; nothing is there as a rule.
        wanted = set().union(*(units[1:] for units in split))
        new = list(wanted.difference(self.known))
        if len(self.known) + len(new) > CACHE:
            self.known, new = {}, list(wanted)
        fresh = self.learn(new)
        self.known.update(fresh)
        known = self.known
        rows = []
        for text, units in zip(texts, split):
            if not units:
                rows.append((b"", b""))
                continue
            parts = list(map(known.__getitem__, units[1:]))
            if units[0]:
                a, b = self.encode([units[0]])[0]
                parts.insert(0, (a.tobytes(), b.tobytes(), self.spells(units[0], a, b)))
            in_a, in_b, same = zip(*parts)
            a, b = b"".join(in_a), b"".join(in_b)
            if not all(same) and not self.spells(" " + text, np.frombuffer(a, np.int32), np.frombuffer(b, np.int32)):
                a, b = b"", b""
            rows.append((a, b))
        for unit in fresh:
            if len(unit) > CACHED_CHARS:
                del known[unit]
        return rows

    def spells(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        """Both sides' bytes are the text's."""
        want = text.encode()
        return all(b"".join(map(own.__getitem__, ids.tolist())) == want for own, ids in ((self.bytes_a, a), (self.bytes_b, b)))

    def align(self, texts: list[str | None]) -> pa.StructArray:
        rows = self.tokens(texts)
        tops_a = np.cumsum([0] + [len(a) // 4 for a, _ in rows])
        tops_b = np.cumsum([0] + [len(b) // 4 for _, b in rows])
        ids_a = np.frombuffer(b"".join(a for a, _ in rows), np.int32)
        ids_b = np.frombuffer(b"".join(b for _, b in rows), np.int32)
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        full = np.flatnonzero(np.diff(tops_a)) + 1
        cuts_a, cuts_b = halved(ends_a, ends_b, tops_a[full], tops_b[full])
        groups_upto = np.searchsorted(cuts_a, tops_a, side="right")
        groups = np.diff(groups_upto)
        # The tokens that end at a cut are linked; of each text every pair once, with how often.
        pair = ids_a[cuts_a - 1].astype(np.int64) * len(self.sizes_b) + ids_b[cuts_b - 1]
        pairs = len(self.sizes_a) * len(self.sizes_b)
        keys, n = np.unique(np.repeat(np.arange(len(rows)), groups) * pairs + pair, return_counts=True)
        linked = pa.StructArray.from_arrays(
            [
                pa.array(keys % pairs // len(self.sizes_b), pa.int32()),
                pa.array(keys % len(self.sizes_b), pa.int32()),
                pa.array(n, pa.int32()),
            ],
            ["a", "b", "n"],
        )
        offsets = np.searchsorted(keys, np.arange(len(rows) + 1) * pairs)
        return pa.StructArray.from_arrays(
            [
                pa.array(np.diff(tops_a), pa.int64()),
                pa.array(np.diff(tops_b), pa.int64()),
                pa.array(groups, pa.int64()),
                self.written(ids_a, ids_b, cuts_a, cuts_b, tops_a + tops_b),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), linked),
            ],
            ["n_a", "n_b", "n_groups", "groups", "links"],
        )

    def written(self, ids_a, ids_b, cuts_a, cuts_b, tops) -> pa.Array:
        """Each text's groups as `a1,a2|b1;a3|b2,b3`."""
        sizes_a, sizes_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        numbers = np.empty(len(ids_a) + len(ids_b), np.int64)
        numbers[np.arange(len(ids_a)) + np.repeat(cuts_b - sizes_b, sizes_a)] = ids_a
        numbers[np.arange(len(ids_b)) + np.repeat(cuts_a, sizes_b)] = ids_b
        cells = self.digits[numbers]
        cells[:, -1] = ord(",")
        cells[cuts_a + cuts_b - sizes_b - 1, -1] = ord("|")
        cells[cuts_a + cuts_b - 1, -1] = ord(";")
        cells[tops[1:][np.diff(tops) > 0] - 1, -1] = 0
        shown = cells != 0
        ends = np.r_[0, np.cumsum(shown.sum(axis=1))][tops]
        data = cells[shown].tobytes()
        return pa.StringArray.from_buffers(len(tops) - 1, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data))


@functools.cache
def pair_of(path_a: str, path_b: str) -> Pair:
    """The vocabularies and what is remembered of them, for all tasks of a worker."""
    return Pair(path_a, path_b)


def align(
    docs: DataFrame, vocabulary_a: str, vocabulary_b: str, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The `keep` columns of each row and its text's tokens by both vocabularies, aligned:

    - n_a, n_b, n_groups: tokens of either side, and groups between shared cuts,
    - groups: `a1,a2|b1;a3|b2,b3`, the ids of A and of B of each group in order,
    - links: (a, b, n), every pair of ids whose tokens end together, and how often they do.

    A is byte-level BPE (a file of the tokenizers library) and encodes a space and the text,
    B is sentencepiece (a .model that puts that space there by itself, without changing the
    text otherwise) and encodes the text. No special tokens are added, and their strings
    inside a text are plain text. A null or empty text, and one that a side does not spell
    byte for byte, has no tokens, no groups and no links. Each row is aligned by itself;
    repeated rows, equal and null ids stay rows of their own. Columns that are not kept are
    not looked at; a kept one must not have one of the five names.

    Texts are cut at single spaces before other characters, where both vocabularies always
    begin a new token, and what a unit between them gives is remembered, within a bound. One
    narrow pass that gives its rows in slices, so that a task holds few texts at a time.
    """
    own = T.StructType.fromDDL(
        "n_a bigint, n_b bigint, n_groups bigint, groups string, links array<struct<a:int,b:int,n:int>>"
    )
    clash = sorted({name.lower() for name in keep}.intersection(own.names))
    if clash:
        raise ValueError(f"columns that alignment adds itself: {clash}")

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(vocabulary_a, vocabulary_b)
        for batch in batches:
            rows = max(1, SLICE_BYTES * batch.num_rows // max(batch.nbytes, 1))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                found = pair.align(part.column(0).to_pylist())
                columns = [*part.columns[1:], *found.flatten()]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *own.names])

    kept = docs.select(F.col(f"`{text}`").alias("_text"), *[F.col(f"`{name}`") for name in keep])
    schema = T.StructType([*kept.schema.fields[1:], *own.fields])
    return kept.mapInArrow(aligned, schema)


def link_counts(links: DataFrame) -> DataFrame:
    """(a, b, n, best) of all links (a, b, n): how often a pair is linked, and whether no other A id is more often
    linked to its B id. A B id has no more rows than A has tokens."""
    counts = links.groupBy("a", "b").agg(F.sum("n").alias("n"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def score_links(aligned: DataFrame, row: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(`row`, n_best, count_sum): of each row's links those whose pair is its B id's most frequent, and the sum of
    their pairs' counts in all rows.

    `aligned` is a settled table with a unique `row` and `links`; rows without links are left
    out. Counts are combined before each shuffle. The table of pairs is broadcast within its
    measured limit; beyond it both sides are merged, a pair that many rows have cut in parts.
    """
    links = aligned.select(row, F.inline("links"))
    pair = F.shiftleft(F.col("a").cast("bigint"), 32) + F.col("b")
    counts = link_counts(links).select(pair.alias("pair"), F.col("n").alias("count"), "best")
    counts = settle(counts, "link-counts")
    joined = lookup_join(
        links.select(row, pair.alias("pair"), "n"), counts, "pair", spread=F.col(row), broadcast_bytes=broadcast_bytes
    )
    return joined.groupBy(row).agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("bigint").alias("n_best"),
        F.sum(F.col("n") * F.col("count")).cast("bigint").alias("count_sum"),
    )
