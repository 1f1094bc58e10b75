from __future__ import annotations

import pytest

from feedloom.llm import decontamination
from feedloom.llm.decontamination import contaminated, drop_contaminated, short_items

QUESTION = (
    "Alice has 5 red apples and 3 km to walk before noon. She gives every child that she meets one of them and "
    "Alice walks 3 km more. How many apples does Alice have when she has met 4 children on her way home?"
)
OTHER = "What is the name of the long river that runs through the old town and then on to the wide blue sea?"


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(1, QUESTION), (2, OTHER), (3, "too short"), (4, None), (5, QUESTION)], "item_id bigint, text string")


def found(docs, benchmark, **options):
    return {(row["doc_id"], row["item_id"]) for row in contaminated(docs, benchmark, **options).collect()}


def test_questions_as_they_are_and_with_other_values(make_docs, benchmark):
    renamed = QUESTION.replace("Alice", "Bruno").replace("3 km", "7 miles").replace("5", "12")
    docs = make_docs(
        f"Some text before it. {QUESTION} And some after it.",
        f"Before. {renamed} After.",
        QUESTION.replace(" ", "\n"),
        OTHER,
        "Nothing of the kind is in this text, whatever its length may be, so that it has to stay where it is.",
        "",
        None,
    )
    assert found(docs, benchmark) == {(n, item) for n in (0, 1, 2) for item in (1, 5)} | {(3, 2)}


def test_slots_that_change_their_value_are_no_match(make_docs, benchmark):
    """The template is the same, but one name of the item stands for three."""
    mixed = QUESTION.replace("Alice has", "Bruno has").replace("Alice walks", "Clara walks")
    assert found(make_docs(mixed), benchmark) == set()


def test_one_changed_value_leaves_the_other_windows(make_docs, benchmark):
    """Of two numbers that are the same one is changed, in a copy word for word and in one with other names."""
    changed = QUESTION.replace("3 km more", "6 km more")
    assert changed != QUESTION
    renamed = QUESTION.replace("Alice", "Bruno").replace("Bruno walks", "Clara walks")
    swapped = QUESTION.replace("3 km to", "7 km to").replace("3 km more", "6 km more")
    rows = contaminated(make_docs(changed, renamed, swapped), benchmark).collect()
    assert sorted((row["doc_id"], row["item_id"], row["n_matched"]) for row in rows) == [
        (doc, item, n) for doc, n in ((0, 29), (1, 27)) for item in (1, 5)
    ]


def test_half_of_an_item_is_needed(make_docs, benchmark):
    words = QUESTION.split()
    assert found(make_docs(" ".join(words[:32]), " ".join(words[:12])), benchmark) == {(0, 1), (0, 5)}


def test_items_shorter_than_a_window_are_found_as_they_are(make_docs, spark):
    items = spark.createDataFrame([(1, "What is 17 times 23?"), (2, "So it is"), (3, "?")], "item_id bigint, text string")
    docs = make_docs("They ask: What is 17 times 23? Nobody knows.", "What is 18 times 23", "What is 17 times 23", "so it was", "")
    rows = contaminated(docs, items).collect()
    assert {tuple(row) for row in rows} == {(0, 1, 1, 1), (2, 1, 1, 1)}


def test_names_and_numbers_alone_delete_nothing(make_docs, spark):
    items = spark.createDataFrame([(1, "Paris"), (2, "42"), (3, "in the year 1999"), (4, None), (5, OTHER)], "item_id bigint, text string")
    docs = make_docs("Paris is a city.", "It was 42, back in the year 1999.", "Nothing.", OTHER)
    assert found(docs, items) == {(3, 5)}
    assert {row["doc_id"] for row in drop_contaminated(docs, items).collect()} == {0, 1, 2}
    assert {(row["item_id"], row["n_tokens"]) for row in short_items(items).collect()} == {(1, 1), (2, 1), (3, 4), (4, 0)}
    assert found(docs, items, min_tokens=1) == {(0, 1), (1, 2), (1, 3), (3, 5)}


def test_a_long_copy_counts_by_itself(make_docs, spark):
    """25 and 60 consecutive tokens of 150, the latter with other values around it; 24 are not enough."""
    words = [f"w{chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(150)]
    words[0] = words[30] = words[60] = "Ann"
    items = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    other = " ".join(words[31:91]).replace("Ann", "Eve")
    docs = make_docs(" ".join(words[31:55]), " ".join(words[31:56]), f"so {' '.join(words[61:121])} so", f"Bob {other}")
    rows = contaminated(docs, items).collect()
    assert {tuple(row) for row in rows} == {(1, 1, 18, 143), (2, 1, 53, 143), (3, 1, 45, 143)}


def test_placeholders_alone_are_no_evidence(make_docs, spark):
    items = spark.createDataFrame([(1, "One Two Three Four Five Six Seven Eight Nine Ten")], "item_id bigint, text string")
    docs = make_docs("Uno Due Tre Quattro Cinque Sei Sette Otto Nove Dieci", "One Two Three Four Five Six Seven Eight Nine Ten")
    assert found(docs, items) == {(1, 1)}


def test_copies_and_repeated_rows_each_get_a_row(make_docs, benchmark):
    docs = make_docs(*[(n, OTHER) for n in range(200)], (7, OTHER), (None, OTHER))
    rows = contaminated(docs, benchmark).collect()
    assert len(rows) == 202 and {row["item_id"] for row in rows} == {2}


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_both_join_ways_give_the_same(spark, documents, limit, monkeypatch):
    real = decontamination.sized_join
    monkeypatch.setattr(decontamination, "sized_join", lambda *a, **k: real(*a, **{"limit": limit} | k))
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    pairs = found(documents, items)
    texts = {row["item_id"]: row["text"] for row in items.collect()}
    planted = {(d["doc_id"], item) for d in documents.collect() for item, text in texts.items() if text in d["text"]}
    assert planted and planted <= pairs


def test_clean_documents_stay_whole(make_docs, benchmark):
    docs = make_docs(OTHER, "clean text", None).selectExpr("*", "1 AS text_hash", "2 AS row", "3 AS item_id")
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and {row["doc_id"] for row in kept.collect()} == {1, 2}
