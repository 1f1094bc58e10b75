from __future__ import annotations

import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from feedloom.llm import language_id
from feedloom.llm.language_id import WORD_START, Scorer, Vocabulary, expected_counts, identify, word_scores

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORDS = ["the", "thernation", "éauouèque", "日本x", "a", "zzzzqq", "ııß", "x" * 40]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


@pytest.fixture(scope="module")
def log_p(vocabulary):
    return np.log(np.random.default_rng(0).dirichlet(np.ones(vocabulary.unknown + 1), 3))


def segmentations(vocabulary, word):
    """Every way to cut a word into pieces, by brute force."""
    ids = {piece: n for n, piece in enumerate(vocabulary.pieces)}
    text = WORD_START + word

    def rest(at):
        if at == len(text):
            yield []
        for end in range(at + 1, len(text) + 1):
            piece = ids.get(text[at:end], vocabulary.unknown if end == at + 1 else None)
            if piece is not None:
                yield from ([piece, *more] for more in rest(end))

    return list(rest(0))


def test_the_forward_sum_is_that_of_all_segmentations(vocabulary, log_p):
    words = [word for word in WORDS if len(word) < 12]
    found = word_scores(vocabulary, words, log_p)
    for word, scores in zip(words, found):
        ways = segmentations(vocabulary, word)
        for language in range(3):
            total = sum(math.exp(sum(log_p[language, piece] for piece in way)) for way in ways)
            assert scores[language] == pytest.approx(math.log(total))


def test_expected_counts_are_those_of_all_segmentations(vocabulary, log_p):
    words, language, n = ["the", "tion", "qqé"], np.array([0, 1, 1]), np.array([3.0, 1.0, 2.0])
    want = np.zeros(log_p.shape)
    for word, lang, count in zip(words, language, n):
        ways = segmentations(vocabulary, word)
        weights = np.array([math.exp(sum(log_p[lang, piece] for piece in way)) for way in ways])
        for way, weight in zip(ways, weights / weights.sum()):
            for piece in way:
                want[lang, piece] += count * weight
    assert np.allclose(expected_counts(vocabulary, words, language, n, log_p), want)


def test_a_very_long_word_has_a_finite_score(vocabulary, log_p):
    assert np.isfinite(word_scores(vocabulary, ["x" * 20_000, "a"], log_p)).all()


def test_forgetting_changes_no_score(vocabulary, log_p, monkeypatch):
    texts = [f"the word{n} thé {'abc'[n % 3]}tion." for n in range(200)]
    score = lambda: Scorer(vocabulary, ["x", "y", "z"], log_p, np.zeros(3))(texts)
    first = score()
    monkeypatch.setattr(language_id, "CACHE", 5)
    monkeypatch.setattr(language_id, "CHUNK", 50)
    monkeypatch.setattr(language_id, "LATTICE_WORDS", 2)
    again = score()
    assert [lang for lang, _ in first] == [lang for lang, _ in again]
    assert np.allclose([s for _, s in first], [s for _, s in again])


@pytest.fixture(scope="module")
def more_documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_documents_are_recognised(spark, more_documents):
    found = identify(more_documents, PATH).join(more_documents.select("doc_id", "lang"), "doc_id").collect()
    held = [row for row in found if row["held_out"]]
    assert len(held) > 200
    assert sum(row["lang"] == row["lang_pred"] for row in held) >= 0.98 * len(held)
    assert all(0 <= row["score"] <= 1 for row in found)


def test_labels_of_held_out_rows_teach_nothing(spark, documents):
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    changed = documents.withColumn("lang", F.when(fold == 2, "xx").otherwise(F.col("lang")))
    first, again = (sorted(identify(docs, PATH, sample_docs=20).collect()) for docs in (documents, changed))
    assert first == again and {row["held_out"] for row in first} == {True, False}


def test_texts_without_letters_or_labels(spark, make_docs):
    texts = make_docs(None, "", "12 !? 34", "the words", "words and the")
    rows = identify(texts, PATH).orderBy("doc_id").collect()
    assert [row["lang_pred"] for row in rows] == ["und", "und", "und", "en", "en"]
    assert [row["score"] for row in rows[:3]] == [0.0] * 3
    unlabelled = identify(texts.withColumn("lang", F.lit(None).cast("string")), PATH)
    assert {row["lang_pred"] for row in unlabelled.collect()} == {"und"}
