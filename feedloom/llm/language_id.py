"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The
likelihood of a word is the sum over all ways to segment it into pieces, by the forward
algorithm; a text's is the product over its words. Piece probabilities are learned by
expectation maximisation over the same lattices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.slices import by_slices
from feedloom.workspace import settle

#: About so many labelled documents of each language are learned from, those with the smallest hashes.
SAMPLE_DOCS = 1500
ROUNDS = 3
#: Counts that smoothing spreads over the pieces of a language.
SMOOTHING = 200.0
#: Words whose scores a worker remembers.
CACHE = 500_000
#: Words whose segmentations are laid out together, and characters scored together.
LATTICE_WORDS = 20_000
CHUNK = 2_000_000
UNDETERMINED = "und"
LETTERS = regex.compile(r"\p{L}+")
WORD_START = "▁"


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


class Vocabulary:
    """A trie over the vocabulary's pieces that lower-case words can hold, walked for many words at once."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(n) for n in range(model.get_piece_size()) if not model.is_byte(n)]
        usable = regex.compile(rf"{WORD_START}?\p{{L}}+|{WORD_START}")
        self.pieces = [piece for piece in pieces if usable.fullmatch(piece) and piece == piece.lower()]
        self.unknown = len(self.pieces)
        characters = sorted({ord(c) for piece in self.pieces for c in piece})
        self.characters = np.array(characters, np.int64)
        number = {c: n for n, c in enumerate(characters)}
        self.width = len(characters)
        children: dict[tuple[int, int], int] = {}
        self.piece_at = [-1]
        for piece_id, piece in enumerate(self.pieces):
            node = 0
            for character in piece:
                step = (node, number[ord(character)])
                if step not in children:
                    children[step] = len(self.piece_at)
                    self.piece_at.append(-1)
                node = children[step]
            self.piece_at[node] = piece_id
        self.piece_at = np.array(self.piece_at)
        keys = np.array([node * self.width + c for node, c in children], np.int64)
        order = np.argsort(keys)
        self.keys, self.nodes = keys[order], np.array(list(children.values()))[order]

    def lattice(self, words: list[str]) -> Lattice:
        text = WORD_START + WORD_START.join(words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.characters, codes), self.width - 1)
        letters = np.where(self.characters[at] == codes, at, -1)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.repeat(np.cumsum(sizes), sizes)
        start = np.arange(len(codes))
        node = np.zeros(len(codes), np.int64)
        single = np.zeros(len(codes), bool)
        edges = []
        length = 0
        while len(start):
            inside = start + length < ends[start]
            start, node = start[inside], node[inside]
            letter = letters[start + length]
            key = node * self.width + letter
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = (letter >= 0) & (self.keys[at] == key)
            start, node = start[found], self.nodes[at[found]]
            length += 1
            piece = self.piece_at[node]
            whole = piece >= 0
            if length == 1:
                single[start[whole]] = True
            edges.append((start[whole], np.full(int(whole.sum()), length), piece[whole]))
        rest = np.flatnonzero(~single)
        edges.append((rest, np.ones(len(rest), np.int64), np.full(len(rest), self.unknown)))
        return Lattice(sizes, *map(np.concatenate, zip(*edges)))


class Lattice:
    """All segmentations of many words: edges from a place to a later one, each with its piece."""

    def __init__(self, sizes: np.ndarray, start: np.ndarray, length: np.ndarray, piece: np.ndarray):
        first = np.cumsum(sizes) - sizes
        self.word_of = np.repeat(np.arange(len(sizes)), sizes)
        word = self.word_of[start]
        # Places of a word: before each of its characters, and one after the last.
        self.origin = first + np.arange(len(sizes))
        self.last = self.origin + sizes
        self.n_places = int(sizes.sum()) + len(sizes)
        self.start, self.end = start + word, start + word + length
        self.piece, self.word = piece, word
        self.step_in = start - first[word] + length
        self.step_out = start - first[word]

    def sums(self, scores: np.ndarray, backward: bool = False) -> np.ndarray:
        """Log sums of all paths from a word's first place (or to its last) to each place."""
        source, target = (self.end, self.start) if backward else (self.start, self.end)
        step = -self.step_out if backward else self.step_in
        order = np.lexsort((target, step))
        values = np.full((self.n_places, scores.shape[1]), -np.inf)
        values[self.last if backward else self.origin] = 0.0
        bounds = np.flatnonzero(np.r_[True, np.diff(step[order]) != 0, True])
        for low, high in zip(bounds[:-1], bounds[1:]):
            edges = order[low:high]
            into = target[edges]
            groups = np.flatnonzero(np.r_[True, np.diff(into) != 0])
            paths = values[source[edges]] + scores[edges]
            top = np.maximum.reduceat(paths, groups, axis=0)
            spread = np.repeat(top, np.diff(np.r_[groups, len(into)]), axis=0)
            values[into[groups]] = top + np.log(np.add.reduceat(np.exp(paths - spread), groups, axis=0))
        return values


def word_scores(vocabulary: Vocabulary, words: list[str], log_p: np.ndarray) -> np.ndarray:
    """Log-likelihoods (words x languages) of words, all segmentations summed."""
    if not words:
        return np.zeros((0, len(log_p)))
    lattice = vocabulary.lattice(words)
    return lattice.sums(log_p[:, lattice.piece].T)[lattice.last]


def expected_counts(vocabulary: Vocabulary, words: list[str], language: np.ndarray, n: np.ndarray, log_p: np.ndarray):
    """Expected uses (languages x pieces) of pieces in words of given language and count."""
    lattice = vocabulary.lattice(words)
    scores = log_p[language[lattice.word], lattice.piece][:, None]
    ahead, behind = lattice.sums(scores), lattice.sums(scores, backward=True)
    total = ahead[lattice.last][lattice.word]
    share = np.exp(ahead[lattice.start] + scores + behind[lattice.end] - total)[:, 0]
    flat = language[lattice.word] * log_p.shape[1] + lattice.piece
    return np.bincount(flat, share * n[lattice.word], log_p.size).reshape(log_p.shape)


class Scorer:
    """Languages of texts, remembering the scores of words."""

    def __init__(self, vocabulary: Vocabulary, languages: list[str], log_p: np.ndarray, log_prior: np.ndarray):
        self.vocabulary, self.languages, self.log_p, self.log_prior = vocabulary, languages, log_p, log_prior
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.languages)))

    def learn(self, new: list[str]) -> None:
        parts = [new[at : at + LATTICE_WORDS] for at in range(0, len(new), LATTICE_WORDS)]
        added = [word_scores(self.vocabulary, part, self.log_p) for part in parts]
        self.rows.update(zip(new, range(len(self.scores), len(self.scores) + len(new))))
        self.scores = np.concatenate([self.scores, *added])

    def chunk(self, texts: list[str]) -> list[tuple[str, float]]:
        split = [words_of(text) for text in texts]
        wanted = set().union(*split)
        new = wanted.difference(self.rows)
        if len(self.rows) + len(new) > CACHE:
            self.forget()
            new = wanted
        if new:
            self.learn(list(new))
        found = []
        for words in split:
            if not words or not self.languages:
                found.append((UNDETERMINED, 0.0))
                continue
            rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
            joint = self.scores[rows].sum(axis=0) + self.log_prior
            share = np.exp(joint - joint.max())
            best = int(joint.argmax())
            found.append((self.languages[best], float(share[best] / share.sum())))
        return found

    def __call__(self, texts) -> list[tuple[str, float]]:
        found, waiting, size = [], [], 0
        for text in texts:
            waiting.append(text or "")
            size += len(waiting[-1])
            if size > CHUNK:
                found += self.chunk(waiting)
                waiting, size = [], 0
        return found + (self.chunk(waiting) if waiting else [])


class Model:
    """Piece probabilities and priors of the learned languages; its size is bounded by the vocabulary."""

    def __init__(self, path: str, languages: list[str], log_p: np.ndarray, log_prior: np.ndarray):
        self.path, self.languages, self.log_p, self.log_prior = path, languages, log_p, log_prior


def smoothed(counts: np.ndarray) -> np.ndarray:
    counts = counts + SMOOTHING / counts.shape[1]
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def labelled_words(docs: DataFrame, labels: DataFrame, sample_docs: int) -> DataFrame:
    """(language, word, n) of about `sample_docs` documents of each language, by hash of id and text."""
    order = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(1 << 30))
    share = F.lit(float(1 << 30)) * F.lit(sample_docs) / F.col("n_docs")
    sample = docs.join(F.broadcast(labels), "lang").where(order < share)  # one row per language

    @F.arrow_udf("array<string>")
    def words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from by_slices(batches, lambda texts: list(map(words_of, texts)), pa.list_(pa.string()))

    return (
        sample.select("language", F.explode(words("text")).alias("word"))
        .groupBy("language", "word")
        .agg(F.count("*").alias("n"))
    )


def fit(
    docs: DataFrame, vocabulary_path: str, lang: str = "lang", sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS
) -> Model:
    """Learn from rows (doc_id, text, lang); those without a lang or text teach nothing.

    All rows count for the priors; pieces are learned from about `sample_docs` documents
    per language. Each round every task sums its words' expected counts, and the sums,
    one row per language and piece at most, reach the driver.
    """
    spark = docs.sparkSession
    known = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull())
    labels = known.select("doc_id", "text", F.col(lang).cast("string").alias("lang"))
    totals = sorted(labels.groupBy("lang").agg(F.count("*").alias("n_docs")).collect())
    languages = [row["lang"] for row in totals]
    vocabulary = Vocabulary(vocabulary_path)
    log_p = np.full((len(languages), vocabulary.unknown + 1), -np.log(vocabulary.unknown + 1))
    if not languages:
        return Model(vocabulary_path, languages, log_p, np.zeros(0))
    numbered = [(n, row["lang"], row["n_docs"]) for n, row in enumerate(totals)]
    numbered = spark.createDataFrame(numbered, "language int, lang string, n_docs bigint")
    words = settle(labelled_words(labels, numbered, sample_docs), "labelled-words")
    for _ in range(rounds):
        now = log_p

        def expect(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            pieces, counts = Vocabulary(vocabulary_path), np.zeros(now.shape)
            for batch in batches:
                arrays = batch["language"].to_numpy(), batch["n"].to_numpy()
                counts += expected_counts(pieces, batch["word"].tolist(), *arrays, now)
            language, piece = np.nonzero(counts)
            yield pd.DataFrame({"language": language, "piece": piece, "n": counts[language, piece]})

        sums = words.mapInPandas(expect, "language int, piece int, n double").groupBy("language", "piece")
        counts = np.zeros(log_p.shape)
        for row in sums.agg(F.sum("n").alias("n")).collect():
            counts[row["language"], row["piece"]] = row["n"]
        log_p = smoothed(counts)
    prior = np.array([row["n_docs"] for row in totals], float)
    return Model(vocabulary_path, languages, log_p, np.log(prior / prior.sum()))


def predictor(spark, model: Model):
    """A column function: struct(lang_pred, score) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred string, score double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        score = Scorer(Vocabulary(model.path), model.languages, model.log_p, model.log_prior)
        kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
        yield from by_slices(batches, lambda texts: [dict(zip(("lang_pred", "score"), f)) for f in score(texts)], kind)

    return predict


def identify(
    docs: DataFrame,
    vocabulary_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Documents with crc32(doc_id as text) mod 4 = 2 are held out from learning, and rows
    without an id, text or lang teach nothing either. Every whole text is scored, from
    the text alone; a null text, one without a letter, or any text when there was nothing
    to learn from is `und` with score 0. Equal scores go to the first language by name.
    Repeated rows each keep their row. Other columns are not looked at.
    """
    named = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")
    )
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = fit(named.where(fold != 2), vocabulary_path, sample_docs=sample_docs)
    predict = predictor(docs.sparkSession, model)
    return named.select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), predict("text").alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")
