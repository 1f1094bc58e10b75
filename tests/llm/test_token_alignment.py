from __future__ import annotations

import bisect
import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from feedloom.llm import token_alignment
from feedloom.llm.queries import QUERIES
from feedloom.llm.token_alignment import Pair, align, halved, link_counts, score_links
from feedloom.llm.token_counts import byte_symbols
from feedloom.workspace import settle

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
PARTS = [
    "a", "b", "the", " the", " ", "  ", "   ", "\n", "\t", "\r\n", "\x00", "\x1c", "\x85", "\xa0", "　", "​", "1", "٣",
    "'s", "don't", "é", "é", "ß", ".", "!!", "日本", "\U0001f600", "<|endoftext|>", "<s>", "<0x41>", "tokenization",
    "unbelievable", " \n", "\n ", "�", "ಜ",
]


class Library:
    """Both libraries' tokens of whole texts, aligned by plain sets of ends."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        self.byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}

    def spelled(self, text):
        """(ids, bytes) of each token of either side."""
        a = self.a.encode(" " + text, add_special_tokens=False)
        first = [(i, bytes(self.byte_of[s] for s in token)) for i, token in zip(a.ids, a.tokens)]
        second = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            byte = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            second.append((i, byte))
        return first, second

    def groups(self, text):
        if not text:
            return []
        sides = self.spelled(text)
        if any(b"".join(part for _, part in side) != (" " + text).encode() for side in sides):
            return []
        ends = []
        for side in sides:
            at = np.cumsum([len(part) for _, part in side])
            ends.append({int(end): number for end, (number, _) in zip(at, side)})
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in shared]
        for side, own in enumerate(ends):
            for end, number in own.items():
                groups[bisect.bisect_left(shared, end)][side].append(number)
        return groups


@pytest.fixture(scope="module")
def library():
    return Library()


def written(groups):
    return ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)


def links(groups):
    return collections.Counter((a[-1], b[-1]) for a, b in groups)


def check(texts, library):
    rows = Pair(*PATHS).align(texts).to_pylist()
    for text, row in zip(texts, rows, strict=True):
        groups = library.groups(text)
        assert row["groups"] == written(groups), repr(text)
        assert row["n_a"] == sum(len(a) for a, _ in groups)
        assert row["n_b"] == sum(len(b) for _, b in groups)
        assert row["n_groups"] == len(groups)
        assert {(link["a"], link["b"]): link["n"] for link in row["links"]} == links(groups)


def test_random_texts(library):
    rng = random.Random(11)
    check(["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(4000)], library)


def test_texts_that_a_side_does_not_spell_have_no_tokens(library):
    texts = [None, "", "one ▁ two", "one▁", "plain", "▁"]
    rows = Pair(*PATHS).align(texts).to_pylist()
    assert [row["n_a"] > 0 for row in rows] == [False, False, False, False, True, False]
    assert [row["groups"] for row in rows[:4]] == [""] * 4
    check(texts, library)


@pytest.mark.parametrize("piece", ["x", "ab", "é", "日本", " ", "\n", "word ", "!?", "7", " \n", "aaaa b"])
def test_long_texts(library, piece):
    check([piece * (20_000 // len(piece))], library)


@pytest.mark.parametrize("piece", ["x", " ", "\n", "qz"])
def test_very_long_texts_end(piece):
    row = Pair(*PATHS).align([piece * (1_000_000 // len(piece))])[0].as_py()
    assert row["n_groups"] > 0


@pytest.mark.parametrize("cache,chars", [(10, 64), (400_000, 2)])
def test_forgetting_changes_nothing(library, monkeypatch, cache, chars):
    monkeypatch.setattr(token_alignment, "CACHE", cache)
    monkeypatch.setattr(token_alignment, "CACHED_CHARS", chars)
    rng = random.Random(12)
    pair = Pair(*PATHS)
    for _ in range(20):
        texts = [" ".join(rng.choice(PARTS) for _ in range(20)) for _ in range(10)]
        assert [row["groups"] for row in pair.align(texts).to_pylist()] == [written(library.groups(t)) for t in texts]


def test_halving_finds_every_common_end():
    rng = np.random.default_rng(13)
    for _ in range(300):
        ends, tops, want = ([], []), ([0], [0]), ([], [])
        base = 0
        for _ in range(rng.integers(1, 5)):
            size = int(rng.integers(1, 400))
            own = [sorted({*rng.integers(1, size + 1, rng.integers(0, size)).tolist(), size}) for _ in range(2)]
            for end in sorted(set(own[0]) & set(own[1])):
                for side in range(2):
                    want[side].append(tops[side][-1] + own[side].index(end) + 1)
            for side in range(2):
                ends[side].extend(base + end for end in own[side])
                tops[side].append(len(ends[side]))
            base += size
        arrays = [np.array(x) for x in (*ends, tops[0][1:], tops[1][1:])]
        got = halved(*arrays)
        assert [list(cuts) for cuts in got] == [list(cuts) for cuts in want]


def test_a_cutless_interval_is_one_leaf():
    ends_a, ends_b = np.arange(2, 200_002, 2), np.arange(1, 200_000, 2)
    ends_b[-1] = ends_a[-1]
    cuts_a, cuts_b = halved(ends_a, ends_b, np.array([len(ends_a)]), np.array([len(ends_b)]))
    assert cuts_a.tolist() == [len(ends_a)] and cuts_b.tolist() == [len(ends_b)]


def brute_force(rows, library):
    aligned = [(doc_id, library.groups(text)) for doc_id, text in rows]
    counts = sum((links(groups) for _, groups in aligned), collections.Counter())
    most = collections.defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    want = []
    for doc_id, groups in aligned:
        own = links(groups)
        best = sum(n for pair, n in own.items() if counts[pair] == most[pair[1]])
        total = sum(n * counts[pair] for pair, n in own.items())
        digest = hashlib.sha256(written(groups).encode()).hexdigest() if groups else ""
        n_a, n_b = (sum(len(group[side]) for group in groups) for side in (0, 1))
        want.append((str(doc_id), n_a, n_b, len(groups), len(groups), best, total, digest))
    return sorted(want)


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_is_brute_force(spark, sf_dir, library):
    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op11_token_alignment"](spark, sf_dir).collect()
    assert sorted((str(row["doc_id"]), *[row[c] for c in COLUMNS]) for row in got) == brute_force(rows, library)


def test_odd_documents(spark, make_docs, tmp_path, library):
    texts = [None, "", " ", "  ", "one two", "one two", "one  two ", " one", "▁", "x" * 3000, "one two"]
    rows = [(at % 9 or None, text) for at, text in enumerate(texts)]
    make_docs(*rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_token_alignment"](spark, str(tmp_path)).collect()
    assert sorted((str(row["doc_id"]), *[row[c] for c in COLUMNS]) for row in got) == brute_force(rows, library)


def test_kept_columns_must_not_clash(make_docs):
    with pytest.raises(ValueError, match="n_a"):
        align(make_docs("a").withColumnRenamed("source", "N_A"), *PATHS, keep=["doc_id", "N_A"])
    row = align(make_docs("a").withColumnRenamed("source", "N_A"), *PATHS, keep=["lang", "doc_id"]).first()
    assert (row["lang"], row["doc_id"], row["n_a"]) == ("en", 0, 1)


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_scores_by_both_joins(spark, make_docs, limit):
    docs = make_docs(*["the cat sat on the mat", "the cat", "cat the dog", "the the the", None] * 3)
    rows = settle(align(docs, *PATHS).select("doc_id", "links"), "test")
    got = {row["doc_id"]: row for row in score_links(rows, "doc_id", limit).collect()}
    counts = {(row["a"], row["b"]): row for row in link_counts(rows.selectExpr("inline(links)")).collect()}
    own = {row["doc_id"]: row["links"] for row in rows.collect()}
    assert set(got) == {doc_id for doc_id, found in own.items() if found}
    for doc_id, row in got.items():
        assert row["count_sum"] == sum(x["n"] * counts[x["a"], x["b"]]["n"] for x in own[doc_id])
        assert row["n_best"] == sum(x["n"] for x in own[doc_id] if counts[x["a"], x["b"]]["best"])
