from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from feedloom.llm.sharding import assign_shards, write_shards


def by_shard(rows):
    found = {}
    for row in rows:
        found.setdefault(row["shard"], []).append(row)
    return found


def check(rows, shards, largest):
    found = by_shard(rows)
    sizes = [sum(row["size"] for row in found.get(n, [])) for n in range(shards)]
    allowed = max(4 * 0.001 * sum(sizes) / shards, 2 * largest)  # the tolerance at both ends of two shards
    assert max(sizes) - min(sizes) <= allowed + 1
    for members in found.values():
        assert sorted(row["slot"] for row in members) == list(range(len(members)))
    return found


def test_shards_of_documents(spark, sf_dir):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {row["doc_id"]: row["text"] for row in documents.collect()}
    rows = assign_shards(documents, 16).collect()
    assert {row["doc_id"] for row in rows} == set(texts) and len(rows) == len(texts)
    for row in rows:
        data = texts[row["doc_id"]].encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert (row["law"], row["grown_shard"]) == ("bytes", None)
    check(rows, 16, max(row["size"] for row in rows))


def test_a_third_of_all_rows_with_one_text_is_cut_by_doc_id(make_docs):
    docs = make_docs(*["copy " * 20] * 4000, *[f"text {n} " * (n % 30) for n in range(8000)])
    rows = assign_shards(docs, 16).collect()
    found = check(rows, 16, max(row["size"] for row in rows))
    holders = [n for n, members in found.items() if any(row["text_crc32"] == zlib.crc32(b"copy " * 20) for row in members)]
    assert 4 <= len(holders) <= 7  # neighbours, in about as many shards as their bytes fill


def test_groups_stay_whole_where_no_boundary_cuts_them(make_docs):
    docs = make_docs(*[f"group {n // 5} " * 10 for n in range(5000)])
    shards = {}
    for row in assign_shards(docs, 8).collect():
        shards.setdefault(row["text_crc32"], set()).add(row["shard"])
    assert sum(len(held) > 1 for held in shards.values()) <= 7


def test_the_same_rows_get_the_same_shards(make_docs):
    docs = make_docs(*[f"text {n}" for n in range(500)])
    first, again = (assign_shards(d, 4).select("doc_id", "shard", "slot").collect() for d in (docs, docs.repartition(7)))
    assert sorted(first) == sorted(again)


def test_few_rows_and_one_shard(make_docs):
    assert [row["shard"] for row in assign_shards(make_docs("a"), 16).collect()] != []
    assert {row["shard"] for row in assign_shards(make_docs("a", "b", None), 1).collect()} == {0}


def test_written_shards_hold_all_columns(spark, make_docs, tmp_path):
    docs = make_docs(*[f"text {n}" for n in range(300)]).withColumn("shard", F.lit("own"))
    write_shards(docs, str(tmp_path / "t"), 4, files_per_shard=2)
    written = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(written.select("row.*").collect()) == sorted(docs.collect())
    placed = {row["doc_id"]: row["shard"] for row in assign_shards(docs, 4).collect()}
    assert {row["row"]["doc_id"]: row["shard"] for row in written.collect()} == placed
