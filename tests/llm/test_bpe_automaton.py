from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import bpe_automaton
from feedloom.llm.bpe_automaton import Automaton, barred_with, decode, encode, encoder
from feedloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "a", "b", "the", " the", " ", "  ", "\n", "\t", "\r", "\x00", "\x1c", "\x85", "\xa0", "　", "​", "1", "٣", "½", "Ⅷ",
    "'s", "don't", "'S", "é", "é", "́", "ß", "İ", "ΑΣ", "Σ", ".", "!!", "日本", "\U0001f600", "ǅ", "ಜ", "Ᲊ",
    "<|endoftext|>", "<|startoftext|>", "<|end", "|>", "QUICK", "running",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)

    def encoded(texts):
        return [found.ids for found in tokenizer.encode_batch(texts, add_special_tokens=False)]

    encoded.decode = lambda ids: tokenizer.decode(ids, skip_special_tokens=False)
    return encoded


def own(texts):
    return [np.frombuffer(encoder(PATH).encode(text), np.int32).tolist() for text in texts]


def test_ids_are_the_librarys_on_random_texts(library):
    rng = random.Random(13)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    assert own(texts) == library(texts)


def test_ids_are_the_librarys_on_random_words(library):
    rng = random.Random(14)
    letters = "etaoinshr" * 3 + "bcdfgjklmpquvwxyzé"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(20_000)]
    words += ["a" * n for n in range(1, 200)] + ["ab" * n for n in range(1, 60)] + ["!" * n for n in range(1, 120)]
    assert own(words) == library(words)


@pytest.mark.parametrize("piece", ["x", "é", "abc", "日", "!?", " ", "\n", "7"])
def test_very_long_texts(library, piece):
    text = piece * (200_000 // len(piece))
    assert own([text]) == library([text])


def test_an_unbroken_word_takes_linear_time(library):
    rng = random.Random(15)
    word = "".join(rng.choice("abcdefghij") for _ in range(300_000))
    assert own([word]) == library([word])


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe_automaton, "CACHE", 20)
    rng = random.Random(16)
    texts = [" ".join(rng.choice(PARTS) for _ in range(20)) for _ in range(200)]
    texts += [" ".join(str(rng.randrange(10**6)) + "x" * rng.randrange(5) for _ in range(50)) for _ in range(20)]
    assert own(texts) == library(texts)


def test_decoding_is_the_librarys(library):
    rng = random.Random(17)
    for _ in range(500):
        ids = [rng.randrange(49_408) for _ in range(rng.randint(0, 20))]
        assert encoder(PATH).decode(ids) == library.decode(ids)


def merged_in_turn(word, merges):
    """BPE by its definition: each merge applied from the left, in order of rank."""
    symbols = list(word)
    for left, right, token in merges:
        done = []
        for symbol in symbols:
            if done and done[-1] == left and symbol == right:
                done[-1] = token
            else:
                done.append(symbol)
        symbols = done
    return symbols


def test_paths_of_the_automaton_are_those_of_the_merges():
    """All words over two symbols: of all their segmentations only BPE's is a path."""
    rng = random.Random(18)
    for _ in range(40):
        labels, merges = ["x", "y"], []
        while len(merges) < 6:
            word = [rng.randrange(2) for _ in range(12)]
            left, right = rng.choice(list(itertools.pairwise(merged_in_turn(word, merges) + [0, 1])))
            try:
                Automaton([*labels, "z"], [*merges, (left, right, len(labels))])
            except ValueError:
                continue
            if labels[left] + labels[right] not in labels:
                merges.append((left, right, len(labels)))
                labels.append(labels[left] + labels[right])
        automaton = Automaton(labels, merges)

        def paths(text, last=None):
            if not text:
                yield []
            for token, label in enumerate(labels):
                if text.startswith(label) and (last is None or automaton.follows(last, token)):
                    for rest in paths(text[len(label) :], token):
                        yield [token, *rest]

        for word in itertools.product([0, 1], repeat=7):
            assert list(paths("".join(labels[s] for s in word))) == [merged_in_turn(word, merges)]


def test_merges_that_cannot_be_are_refused():
    with pytest.raises(ValueError, match="same token"):
        Automaton(["a", "b", "c"], [(0, 1, 2), (0, 1, 2)])
    with pytest.raises(ValueError, match="made by a later"):
        Automaton(["a", "b", "aba", "ab"], [(3, 0, 2), (0, 1, 3)])
    with pytest.raises(ValueError, match="never be applied"):
        Automaton(["a", "b", "ab", "x"], [(0, 1, 2), (0, 1, 3)])


def test_intervals_are_joined():
    row = barred_with(barred_with(bpe_automaton.array("I"), 3, 5), 8, 9)
    assert list(row) == [3, 5, 8, 9]
    assert list(barred_with(row, 5, 8)) == [3, 9]
    assert list(barred_with(row, 4, 4)) == [3, 5, 8, 9]
    assert list(barred_with(row, 0, 20)) == [0, 20]
    assert list(barred_with(row, 6, 7)) == [3, 5, 6, 7, 8, 9]


def test_column_functions(spark, library):
    texts = [None, "", " \n", "One two", "One two", "<|endoftext|> é"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = docs.withColumn("ids", encode("text", PATH)).withColumn("back", decode("ids", PATH)).collect()
    want = library([t or "" for t in texts])
    assert [row["ids"] for row in rows] == want
    assert [row["back"] for row in rows] == [library.decode(ids) for ids in want]
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert nothing.select(decode("ids", PATH).alias("back")).first()["back"] == ""


def test_query_is_the_librarys(spark, sf_dir, library):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = {}
    for doc_id, ids in zip(texts, library([text or "" for text in texts.values()])):
        want[doc_id] = (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)))
    rows = QUERIES["op13_bpe_automaton"](spark, sf_dir).collect()
    assert {row["doc_id"]: (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) for row in rows} == want
    assert len(rows) == len(want)
