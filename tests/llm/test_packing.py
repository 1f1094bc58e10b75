from __future__ import annotations

import itertools
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedloom.llm.packing import best_boundaries, encode, encoding, pack, sequences

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def padding(histogram, boundaries):
    return sum(n * (min(b for b in boundaries if b >= length) - length) for length, n in histogram.items())


def test_boundaries_are_the_best_of_all():
    rng = random.Random(6)
    for _ in range(60):
        lengths = rng.sample(range(1, 40), rng.randint(1, 8))
        histogram = {length: rng.randint(1, 20) for length in lengths}
        for buckets in (1, 2, 3):
            found = best_boundaries(histogram, buckets)
            choices = (
                (*some, max(lengths))
                for size in range(min(buckets, len(lengths)))
                for some in itertools.combinations(sorted(lengths)[:-1], size)
            )
            assert found == sorted(found) and found[-1] == max(lengths) and len(found) <= buckets
            assert padding(histogram, found) == min(padding(histogram, some) for some in choices)
    assert best_boundaries({}, 4) == []


def check(docs, rows, **options):
    max_length, budget = options.get("max_length", 2048), options.get("batch_tokens", 32_768)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    texts = {row["doc_id"]: row["text"] or "" for row in docs.collect()}
    counts = dict(zip(texts, (len(e.ids) for e in tokenizer.encode_batch(list(texts.values()), add_special_tokens=False))))
    for doc_id, total in counts.items():
        own = sorted((row["chunk"], row["start"], row["n_tokens"]) for row in rows if row["doc_id"] == doc_id)
        assert sum(n for _, _, n in own) == total
        assert [start for _, start, _ in own] == list(range(0, total, max_length))
    histogram = {}
    batches = {}
    for row in rows:
        histogram[row["n_tokens"]] = histogram.get(row["n_tokens"], 0) + 1
        batches.setdefault((row["bucket"], row["batch"]), []).append(row["position"])
        assert row["padding"] == row["bucket"] - row["n_tokens"] >= 0
    boundaries = best_boundaries(histogram, options.get("buckets", 8))
    assert {row["bucket"] for row in rows} == set(boundaries)
    assert sum(row["padding"] for row in rows) == padding(histogram, boundaries)
    for (bucket, batch), positions in batches.items():
        capacity = max(1, budget // bucket)
        assert sorted(positions) == list(range(len(positions))) and len(positions) <= capacity
        if (bucket, batch + 1) in batches:
            assert len(positions) == capacity
    for bucket in boundaries:
        numbers = sorted(batch for own, batch in batches if own == bucket)
        assert numbers == list(range(len(numbers)))


def test_documents_fill_batches(spark, documents):
    check(documents, pack(documents, VOCABULARY, public_tokenizers.PATTERN).collect())


def test_small_budgets_long_texts_and_a_hot_length(make_docs):
    docs = make_docs(*["one two three"] * 150, *["word " * n for n in range(120)], "x y " * 5000, "<|endoftext|>", "", None)
    options = {"max_length": 64, "buckets": 4, "batch_tokens": 100}
    check(docs, pack(docs, VOCABULARY, public_tokenizers.PATTERN, **options).collect(), **options)


def test_a_sequence_longer_than_the_budget_is_a_batch_of_its_own(make_docs):
    rows = pack(make_docs("a b c d e f g h"), VOCABULARY, public_tokenizers.PATTERN, batch_tokens=3).collect()
    assert [(row["n_tokens"], row["batch"], row["position"]) for row in rows] == [(8, 0, 0)]


def test_repeated_rows_are_packed_each(make_docs):
    docs = make_docs((1, "a b"), (1, "a b"), (None, "a b"), (None, "a b"))
    rows = pack(docs, VOCABULARY, public_tokenizers.PATTERN).collect()
    assert sorted(row["position"] for row in rows) == [0, 1, 2, 3]


@pytest.mark.parametrize("piece", [" ", "\n", "\r\n", "x", "!", "7", " \n", "　", "a "])
def test_very_long_runs(make_docs, piece):
    """The last runs of a text and runs before a word, a digit, a line end; each as the library counts them."""
    long = piece * (1_000_000 // len(piece))
    short = piece * (5000 // len(piece))
    own = encoding(VOCABULARY, public_tokenizers.PATTERN)
    for text in (short, f"a{short}", f"{short}a", f"a {short} 7{short}\n.{short}", f"{short}\x1c{short}"):
        assert encode(own, text).tolist() == own.encode_ordinary(text)
    for text in (long, f"a{long}b", f"{long}\n{long}."):
        ids = encode(own, text).tolist()
        assert b"".join(map(own.decode_single_token_bytes, ids)).decode() == text
    total = sum(row["n_tokens"] for row in pack(make_docs(f"a{long}b"), VOCABULARY, public_tokenizers.PATTERN).collect())
    assert total == len(encode(own, f"a{long}b"))


def test_sequences_hold_the_ids(make_docs):
    docs = make_docs((1, "one two three"), (1, "four five six"), (None, "word " * 100), (None, ""), (2, None), (3, "x"))
    rows = sequences(docs, VOCABULARY, public_tokenizers.PATTERN, max_length=32, buckets=2).collect()
    own = encoding(VOCABULARY, public_tokenizers.PATTERN)
    texts = {}
    for row in sorted(rows, key=lambda row: (row["row"], row["chunk"])):
        assert len(row["ids"]) == row["n_tokens"]
        texts.setdefault((row["doc_id"], row["row"]), []).extend(row["ids"])
    found = sorted((str(doc_id), own.decode(ids)) for (doc_id, _), ids in texts.items())
    assert found == sorted([("1", "one two three"), ("1", "four five six"), ("None", "word " * 100), ("3", "x")])
