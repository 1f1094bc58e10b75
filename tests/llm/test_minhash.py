from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest

from feedloom.llm.minhash import Shingler, coordinates, drop_near_duplicates, links, near_duplicates


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[at:] for at in range(size)]))


def brute_force(rows, size, percent):
    """(doc_id -> component) and set sizes by comparing every pair."""
    sets = {doc_id: shingles(text, size) for doc_id, text in rows}
    leader = {doc_id: doc_id for doc_id in sets}
    ids = sorted(sets)
    for at, one in enumerate(ids):
        for other in ids[:at]:
            a, b = sets[one], sets[other]
            if a and b and min(len(a), len(b)) * 100 >= max(len(a), len(b)) * percent:
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    low, high = sorted((leader[one], leader[other]))
                    leader = {doc_id: low if root == high else root for doc_id, root in leader.items()}
    return leader, {doc_id: len(found) for doc_id, found in sets.items()}


def compare(docs, **options):
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    components, sizes = brute_force(rows, options["words"], options["percent"])
    found = near_duplicates(docs, **options).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row["component_id"] == components[row["doc_id"]]
        assert row["n_shingles"] == sizes[row["doc_id"]]
        assert row["kept"] == (row["doc_id"] == row["component_id"])


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_documents_match_all_pairs(spark, words, percent):
    compare(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), words=words, percent=percent)


def family(rng, size, words, edits):
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("block", [200, 900, 3_000, 400_000])
def test_hot_groups_cut_into_blocks_match_all_pairs(make_docs, block):
    """A third of all rows exact copies, another third near copies that link only in part."""
    rng = random.Random(1)
    texts = ["The same Text\tin every one of these"] * 120 + family(rng, 120, 80, 8)
    texts += [text for _ in range(12) for text in family(rng, 6, 60, 5)] + ["one", "One", "two words", "", None, " \n"]
    rng.shuffle(texts)
    compare(make_docs(*texts), words=3, percent=85, block_shingles=block)


def test_pairs_at_the_threshold(make_docs):
    """100 * 85 / 100 links, one shingle less does not."""
    base = [f"w{n}" for n in range(102)]  # 100 shingles
    at = base[:87] + ["x"]  # 85 of them, and one more: 85 of 101
    compare(make_docs(*[" ".join(words) for words in (base, base[:87], base[:86], at)]), words=3, percent=85)


def test_links_of_one_group_equal_all_pairs():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(60)]

    def linked(a, b):
        common = len(np.intersect1d(a, b))
        return 100 * common >= 60 * (len(a) + len(b) - common)

    def groups(pairs):
        leader = list(range(60))
        for a, b in pairs:
            leader = [leader[a] if root == leader[b] else root for root in leader]
        return {frozenset(n for n in range(60) if leader[n] == root) for root in leader}

    pairs = [(a, b) for a in range(60) for b in range(a) if linked(sets[a], sets[b])]
    found = links(sets, None, 60)
    assert all(linked(sets[a], sets[b]) for a, b in found) and groups(found) == groups(pairs)
    side = np.arange(60) % 2
    across = links(sets, side, 60)
    assert groups(across) == groups([(a, b) for a, b in pairs if side[a] != side[b]])


def test_parts_that_are_connected_are_not_compared_again():
    sets = [np.arange(start, start + 100, dtype=np.uint64) for start in (0, 1, 2, 40)]
    assert len(links(sets, None, 80)) == 2
    assert len(links(sets, None, 80, np.array([7, 7, 9, 9]))) == 1
    assert links(sets, None, 80, np.array([7, 7, 7, 9])) == []


def test_sets_that_share_a_common_shingle_only_are_not_intersected():
    """200,000 sets of two shingles with one in common, within seconds; so much work as their number, not its square."""
    sets = [np.array([1, 10 + n], np.uint64) for n in range(200_000)]
    begun = time.monotonic()
    assert links(sets, None, 85) == [] and time.monotonic() - begun < 10


def test_a_chain_of_texts_that_share_bands_is_cut_and_keeps_its_links(make_docs):
    """Each text shares nine tenths with the next and less with those after it, in blocks far smaller than the chain."""
    words = [f"w{n}" for n in range(900)]
    texts = [" ".join(words[start : start + 120]) for start in range(0, 700, 6)]
    texts += [" ".join(words[start : start + 60]) for start in range(0, 700, 30)]
    compare(make_docs(*texts), words=3, percent=85, block_shingles=700)


def test_coordinates_estimate_the_similarity():
    shingler = Shingler(3)
    a, b = (shingler(" ".join(f"w{n}" for n in range(low, low + 1000))) for low in (0, 100))
    signatures = coordinates([a, b], 400)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signatures[0] == signatures[1]).mean() - true) < 0.1


def test_rows_without_an_id_and_rows_that_repeat(make_docs):
    docs = make_docs((None, "a b c d"), (None, "a b c d"), (3, "A b c d"), (3, "A b c d"), (None, "x y z"), (None, ""))
    found = near_duplicates(docs, words=3, percent=85).collect()
    by_size = {size: [(r["doc_id"], r["component_id"], r["kept"]) for r in found if r["n_shingles"] == size] for size in (0, 1, 2)}
    assert by_size[0] == [(None, None, True)] and by_size[1] == [(None, None, True)]
    assert sorted(by_size[2], key=str) == sorted([(None, 3, False)] * 2 + [(3, 3, True)] * 2, key=str)


def test_one_document_of_each_group_stays(make_docs):
    docs = make_docs((5, "a b c d e f"), (2, "a b c d e f"), (9, "other words that stay here"), (7, None))
    kept = drop_near_duplicates(docs, words=5, percent=80)
    assert kept.columns == docs.columns and {row["doc_id"] for row in kept.collect()} == {2, 7, 9}
