from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedloom.llm import token_counts
from feedloom.llm.token_counts import Merger, TextCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "the", " the", " ", "  ", "\n", "\t", "\r", "\x00", "\x1c", "\x85", "\xa0", "　", "​", "1", "٣",
    "½", "Ⅷ", "'s", "don't", "'S", "é", "é", "ß", ".", "!!", "日本", "\U0001f600", "<|endoftext|>", "<|end", "|>",
]


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(found.ids) for found in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys_on_random_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    texts += ["a" * 3000, "ab" * 2000, " " * 50, "x" + " " * 50, "\n x", " x", "x ", "", "<|endoftext|>" * 3]
    assert TextCounter(PATH).counts(texts) == library(texts)


@pytest.mark.parametrize("cache,chunk", [(50, 200), (1, 1), (700_000, 4_000_000)])
def test_forgetting_changes_nothing(monkeypatch, cache, chunk):
    monkeypatch.setattr(token_counts, "CACHE", cache)
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(PARTS) for _ in range(20)) for _ in range(200)]
    assert TextCounter(PATH).counts(texts) == library(texts)


def test_equal_symbols_merge_from_the_left():
    merger = Merger(PATH)
    sequences = [b"a" * n for n in range(1, 40)] + [b"\xff" * 9]
    assert merger.counts(sequences)[:39].tolist() == library([s.decode() for s in sequences[:39]])


def test_documents_match_the_library(spark, documents):
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}
    want = dict(zip(texts, library(list(texts.values()))))
    for row in count_tokens(documents, PATH).collect():
        assert row["n_tokens"] == want[row["doc_id"]]
        assert row["n_bytes"] == len(texts[row["doc_id"]].encode())
        assert row["over_limit"] == (want[row["doc_id"]] > 512)


def test_null_and_empty_texts_have_no_tokens(make_docs):
    rows = count_tokens(make_docs(None, "", "one two"), PATH).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows] == [(0, 0, False), (0, 0, False), (7, 2, False)]
