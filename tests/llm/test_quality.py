from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from feedloom.llm.quality import apply_rules, judge, profile

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_profile(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = {window for window, n in Counter(windows).items() if n > 1}
    inside = {at + shift for at, window in enumerate(windows) if window in often for shift in range(3)}
    filled = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(filled) - len(set(filled)),
        len(inside),
    )


def random_text(rng):
    parts = ["a", "b", "c", "a b c", "##", "x|y", "é", "日本", "\n", "\n", " ", "\t", "\r\n", "\x0b", "\xa0", "same line\n"]
    return " ".join(rng.choice(parts) for _ in range(rng.randint(0, 60))).replace("  ", rng.choice([" ", ""]))


def test_counts_of_random_texts():
    rng = random.Random(2)
    for text in [random_text(rng) for _ in range(2000)] + ["", None, " ", "a", "a a", "a a a", "a a a a", "x" * 10_000]:
        assert profile(text)[:5] == brute_profile(text)


def brute_judge(rows, limit_docs, limit_percent, depleted):
    """(doc_id -> kept) by looking at every document of each host."""

    def lines(text):
        plain = re.sub("[0-9]+", "0", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return [" ".join(WORD.findall(line)) for line in plain.split("\n") if WORD.search(line)]

    texts = {(host, text or "") for _, text, host in rows}
    hosts = Counter(host for host, _ in texts)
    counts = Counter((host, line) for host, text in texts for line in set(lines(text)))
    verdicts = {}
    for doc_id, text, host in rows:
        n_words, _, _, _, repeated = brute_profile(text)
        lost = sum(
            len(line.split())
            for line in lines(text)
            if counts[host, line] > limit_docs and counts[host, line] * 100 > hosts[host] * limit_percent
        )
        failed = n_words < 50 or 100 * repeated > 50 * n_words
        verdicts[doc_id] = (failed, lost, not failed and 100 * lost <= n_words * depleted)
    return verdicts


@pytest.fixture
def hosted(make_docs):
    """One host with two thirds of all rows; a notice in most of its documents, copies of one text, other hosts."""
    rng = random.Random(8)
    rows = []
    for n in range(600):
        host = rng.choice(["hot", "hot", "a", None])
        words = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(rng.choice([20, 45, 60, 200]))]
        text = " ".join(words)
        if host == "hot" and n % 3:
            text = f"Visit {n} Times  OUR shop " + "for all of it " * rng.choice([1, 20]) + "\n" + text
        rows.append((n, text, host))
    rows += [(1000 + n, "the very same text " + " ".join("k" * k for k in range(60)), "hot") for n in range(300)]
    rows += [(2000, None, "a"), (2001, "", None)]
    return rows


def test_verdicts_match_brute_force(make_docs, hosted):
    want = brute_judge(hosted, 10, 5, 50)
    found = judge(make_docs(*hosted)).collect()
    got = {r["doc_id"]: (r["base_failed"], r["n_removed_words"], r["kept"]) for r in found}
    assert got == want and len(found) == len(hosted)
    assert {kept for _, lost, kept in want.values() if lost} == {True, False}


def test_kept_documents_lose_their_frequent_lines_only(make_docs, hosted):
    docs = make_docs(*hosted)
    want = brute_judge(hosted, 10, 5, 50)
    after = {row["doc_id"]: row["text"] for row in apply_rules(docs).collect()}
    assert set(after) == {doc_id for doc_id, (_, _, kept) in want.items() if kept}
    before = {doc_id: text for doc_id, text, _ in hosted}
    for doc_id, text in after.items():
        dropped = want[doc_id][1]
        assert text == (before[doc_id].split("\n", 1)[1] if dropped else before[doc_id])


def test_all_columns_stay_even_with_clashing_names(make_docs, hosted):
    docs = make_docs(*hosted).selectExpr("*", "1 AS removed", "2 AS host", "'x' AS row", "3 AS own_hash")
    after = apply_rules(docs)
    assert after.columns == docs.columns
    assert {(r["removed"], r["host"], r["row"], r["own_hash"]) for r in after.collect()} == {(1, 2, "x", 3)}


def test_documents_keep_those_that_are_clean(spark, documents):
    rows = judge(documents).collect()
    assert all(row["kept"] != row["base_failed"] or row["n_removed_words"] for row in rows)
