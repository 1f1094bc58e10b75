"""The registered queries of the training-corpus operators, with SQL where it can express them.

Each runs its operator with production parameters over its whole table.
"""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.bpe_automaton import round_trip
from feedloom.llm.centroids import cluster, with_clusters
from feedloom.llm.decontamination import MIN_LITERALS, MIN_PERCENT, TOKEN, UNITS, WINDOW, contaminated
from feedloom.llm.html_extract import extract
from feedloom.llm.language_id import identify
from feedloom.llm.line_templates import repeated_lines
from feedloom.llm.minhash import near_duplicates
from feedloom.llm.packing import pack
from feedloom.llm.quality import DEPLETED_PERCENT, LIMIT_DOCS, LIMIT_PERCENT, MAX_REPEAT_PERCENT, MIN_WORDS, judge
from feedloom.llm.sharding import assign_shards
from feedloom.llm.token_alignment import align, score_links
from feedloom.llm.token_counts import count_tokens
from feedloom.llm.warc import page_of, warc_round_trip
from feedloom.workspace import settle


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that recurring templates drop from every document; `dropped_lines` are numbers from 0."""
    found = repeated_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        F.size("dropped").cast("bigint").alias("n_dropped"),
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped_lines"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences in batches of optimal length buckets."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 50k byte-level vocabulary."""
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes."""
    return assign_shards(table(spark, sf_dir, "documents"), shards=16)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    records = warc_round_trip(spark, table(spark, sf_dir, "pages"), min_bytes=0)
    return records.select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of("refers_to").alias("refers_to"),
        "target_uri",
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled documents that are not held out."""
    return identify(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contaminated document with the benchmark items found in it."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, similarity 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; its source is its host."""
    judged = judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_removed_words",
        "base_failed",
        "kept",
    )


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by a model learned from the pages that mark their article."""
    return extract(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by the byte-level and the piece vocabulary, aligned and linked."""
    vocabularies = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    rows = align(table(spark, sf_dir, "documents"), *vocabularies).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
        "links",
    )
    rows = settle(rows, "aligned")
    linked = F.aggregate("links", F.lit(0).cast("bigint"), lambda total, link: total + link["n"])
    scored = rows.withColumn("n_links", linked).drop("links").join(score_links(rows, "row"), "row", "left")
    none = F.lit(0).cast("bigint")
    return scored.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"),
        "groups_sha256",
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings after ten rounds from 8 seeds."""
    return with_clusters(*cluster(table(spark, sf_dir, "embeddings"), clusters=8, rounds=10, size=64, seed="3"))


def op13_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the 49k vocabulary with word ends and decoded again, as digests."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", round_trip("text", vocabulary).alias("bpe"))
    return docs.select(
        "doc_id",
        F.size("bpe.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("bpe.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bpe.decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_token_counts": op3_token_counts,
    "op4_sharding": op4_sharding,
    "op5_warc": op5_warc,
    "op6_language_id": op6_language_id,
    "op7_decontamination": op7_decontamination,
    "op8_minhash": op8_minhash,
    "op9_quality": op9_quality,
    "op10_html_extract": op10_html_extract,
    "op11_token_alignment": op11_token_alignment,
    "op12_centroids": op12_centroids,
    "op13_bpe_automaton": op13_bpe_automaton,
}

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rounds_of_clustering(rounds: int) -> str:
    """CTEs a1, c1, a2, c2, ...: in each round the vectors' centroids `a` and the next centroids `c`."""
    ctes = []
    for at in range(rounds + 1):
        ctes.append(f"""
        a{at} AS MATERIALIZED (
            SELECT row, min(8 * list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i]))) + c) AS best
            FROM kept k, c{at} c GROUP BY row
        ),
        s{at} AS (
            SELECT best % 8 AS c, i, sum(v[i]) AS s, count(*) AS n
            FROM a{at} JOIN kept USING (row), range(1, 65) r(i) GROUP BY ALL
        ),
        c{at + 1} AS MATERIALIZED (
            SELECT c.c, coalesce(m.v, c.v) AS v FROM c{at} c LEFT JOIN (
                SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{at} GROUP BY c
            ) m USING (c)
        ),""")
    return "".join(ctes)


ORACLES = {
    "op1_line_dedup": r"""
        WITH texts AS (
            SELECT min(doc_id) AS own, string_split(regexp_replace(regexp_replace(
                coalesce(text, ''), '\x20*[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20{2,}', ' ', 'g'), '[0-9]+', '<*>', 'g'), chr(10)) AS raw,
                coalesce(text, '') AS text
            FROM documents GROUP BY coalesce(text, '')
        ),
        split AS (SELECT own, unnest(raw) AS raw, generate_subscripts(raw, 1) - 1 AS number FROM texts),
        tokened AS (
            SELECT own, number, trim(raw, ' ') AS line, string_split(trim(raw, ' '), ' ') AS tokens
            FROM split WHERE trim(raw, ' ') != ''
        ),
        lines AS MATERIALIZED (
            SELECT own, number, row_number() OVER (PARTITION BY own ORDER BY number) AS rank, line, len(tokens) AS size,
                len(list_filter(tokens, lambda t: NOT contains(t, '<*>'))) AS plain,
                len(tokens) || ' ' || array_to_string(tokens[1:3], ' ') AS leaf
            FROM tokened
        ),
        places AS MATERIALIZED (SELECT DISTINCT leaf, line, size, own FROM lines),
        leaves AS (SELECT leaf FROM places GROUP BY leaf, size HAVING count(*) >= greatest(3, least(10, ceil(150 / size)))),
        known AS (SELECT leaf, line, size, count(*) AS n FROM places SEMI JOIN leaves USING (leaf) GROUP BY ALL),
        tokens AS (
            SELECT leaf, line, size, n, unnest(parts) AS token, generate_subscripts(parts, 1) AS place
            FROM (SELECT *, string_split(line, ' ') AS parts FROM known)
        ),
        supports AS (
            SELECT leaf, place, token, sum(n) AS support FROM tokens GROUP BY leaf, size, place, token
            HAVING sum(n) >= greatest(3, least(10, ceil(150 / size)))
        ),
        supported AS (
            SELECT leaf, line, list(token ORDER BY place) AS tokens, list(coalesce(support, 0) ORDER BY place) AS s,
                list(coalesce(support, 0) ORDER BY coalesce(support, 0) DESC) FILTER (NOT contains(token, '<*>')) AS plain,
                list(coalesce(support, 0) ORDER BY coalesce(support, 0) DESC) FILTER (place > 3) AS free
            FROM tokens LEFT JOIN supports USING (leaf, place, token) GROUP BY leaf, line
        ),
        levels AS (
            SELECT *, plain[ceil(len(tokens) * 60 / 100)::INT] AS level,
                coalesce(free[ceil(len(free) * 60 / 100)::INT], level) AS own_level
            FROM supported
        ),
        general AS (
            SELECT leaf, line, list_transform(tokens, lambda t, i: CASE WHEN s[i] >= least(level, own_level) THEN t ELSE '<*>' END) AS kept,
                len(list_filter(kept, lambda t: NOT contains(t, '<*>'))) AS c,
                len(list_filter(kept[4:], lambda t: NOT contains(t, '<*>'))) AS f
            FROM levels WHERE level > 0 AND own_level > 0
        ),
        mapped AS (
            SELECT leaf, kept, line, own, greatest(
                greatest(3, least(10, ceil(150 / greatest(c, 1)))) * pow(2, greatest(0, 6 - f)),
                ceil((SELECT count(*) FROM places) / pow(10, least(c, 15)))) AS needs
            FROM places JOIN general USING (leaf, line)
        ),
        recurring AS (
            SELECT leaf, kept, min(own) AS keeper FROM mapped GROUP BY leaf, kept, needs HAVING count(DISTINCT own) >= needs
        ),
        repeated AS (SELECT line, count(*) AS n, min(own) AS keeper FROM places GROUP BY line HAVING count(*) >= 2),
        neighbours AS MATERIALIZED (
            SELECT own, number, rank, line, size, plain, n, keeper,
                CASE WHEN lag(rank) OVER (PARTITION BY own ORDER BY rank) = rank - 1
                    THEN lag(line) OVER (PARTITION BY own ORDER BY rank) END AS before
            FROM lines JOIN repeated USING (line)
        ),
        pairs AS (
            SELECT before, line, true AS follows FROM neighbours WHERE before IS NOT NULL
            GROUP BY before, line HAVING count(DISTINCT own) >= 2
        ),
        runs AS (
            SELECT neighbours.*, count(*) FILTER (follows IS NULL) OVER (PARTITION BY own ORDER BY rank) AS run
            FROM neighbours LEFT JOIN pairs USING (before, line)
        ),
        passages AS (SELECT *, sum(plain) OVER (PARTITION BY own, run) AS passage FROM runs),
        drops AS (
            SELECT own, number FROM passages
            WHERE own != keeper AND 100 * plain >= 60 * size AND (n >= 10 OR n * passage >= 100)
            UNION
            SELECT own, number FROM lines JOIN mapped USING (leaf, line, own) JOIN recurring USING (leaf, kept) WHERE own != keeper
        ),
        filled AS (SELECT own, count(*) AS n_lines FROM lines GROUP BY own),
        lost AS (SELECT own, count(*) AS n, string_agg(number, ',' ORDER BY number) AS numbers FROM drops GROUP BY own)
        SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(lost.n, 0) AS n_dropped, coalesce(numbers, '') AS dropped_lines
        FROM documents d JOIN texts ON coalesce(d.text, '') = texts.text LEFT JOIN filled USING (own) LEFT JOIN lost USING (own)
    """,
    "op5_warc": r"""
        WITH digests AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
        firsts AS (SELECT hex, max(page_id) AS first FROM digests GROUP BY hex)
        SELECT page_id, strlen(html) AS payload_bytes,
            array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda j:
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(((('0x' || hex[5 * i + 1 : 5 * i + 5])::BIGINT >> (15 - 5 * j)) & 31) + 1)::INT]
            ), '')), '') AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id != first THEN first END AS refers_to,
            url AS target_uri
        FROM digests JOIN firsts USING (hex)
    """,
    "op7_decontamination": rf"""
        WITH raws AS (
            SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS raw FROM documents
            UNION ALL
            SELECT 'b', item_id, regexp_extract_all(coalesce(text, ''), '{TOKEN}') FROM benchmark
        ),
        typed AS (
            SELECT *, list_transform(raw, lambda t, i: CASE
                WHEN t < ':' THEN '<num>'
                WHEN t[1] != lower(t[1]) THEN '<name>'
                WHEN i > 1 AND raw[i - 1] < ':' AND list_contains({list(UNITS)}, t) THEN '<unit>'
                ELSE t END) AS types
            FROM raws
        ),
        starts AS (SELECT *, unnest(range(1, len(raw) - {WINDOW} + 2)) AS place FROM typed),
        wins AS (
            SELECT kind, id, place, len(raw) - {WINDOW} + 1 AS n_windows,
                raw[place : place + {WINDOW} - 1] AS vals, types[place : place + {WINDOW} - 1] AS types
            FROM starts
        ),
        pairs AS (
            SELECT d.id AS doc_id, b.id AS item_id, b.place AS item_place, d.place - b.place AS shift, b.n_windows,
                b.types, b.vals AS theirs, d.vals AS ours
            FROM (FROM wins WHERE kind = 'd') d JOIN (FROM wins WHERE kind = 'b') b USING (types)
            WHERE d.vals = b.vals OR len(list_filter(b.types, lambda t: NOT starts_with(t, '<'))) >= {MIN_LITERALS}
        ),
        slots AS (
            SELECT doc_id, item_id, shift, unnest(types) AS type, unnest(theirs) AS theirs, unnest(ours) AS ours FROM pairs
        ),
        clashing AS (
            SELECT DISTINCT doc_id, item_id, shift FROM (
                SELECT doc_id, item_id, shift, theirs FROM slots WHERE starts_with(type, '<')
                GROUP BY ALL HAVING count(DISTINCT ours) > 1)
        )
        SELECT doc_id, item_id, count(DISTINCT item_place) AS n_matched, any_value(n_windows) AS n_windows
        FROM pairs ANTI JOIN clashing USING (doc_id, item_id, shift)
        GROUP BY doc_id, item_id
        HAVING 100 * count(DISTINCT item_place) >= {MIN_PERCENT} * any_value(n_windows)
    """,
    "op8_minhash": rf"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
            FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, words[pos : pos + 2] AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, least(len(words), 1) + 1))) AS pos FROM docs)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS one, b.doc_id AS other
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id != b.doc_id
            JOIN sizes sa ON sa.doc_id = a.doc_id JOIN sizes sb ON sb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id
            HAVING 100 * count(*) >= 85 * (any_value(sa.n) + any_value(sb.n) - count(*))
        ),
        reached AS (SELECT doc_id, doc_id AS root FROM docs UNION SELECT other, root FROM reached JOIN links ON doc_id = one)
        SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
        FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
    "op9_quality": rf"""
        WITH docs AS (
            SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words
            FROM documents
        ),
        windows AS (
            SELECT doc_id, pos, words[pos : pos + 2] AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS pos FROM docs)
        ),
        repeated AS (
            SELECT doc_id, count(DISTINCT place) AS n
            FROM (
                SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS place
                FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS times FROM windows) WHERE times > 1
            )
            GROUP BY doc_id
        ),
        lines AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM docs),
        duplicate AS (
            SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id
        ),
        plain AS (
            SELECT doc_id, source, text, array_to_string(regexp_extract_all(
                regexp_replace(translate(line, '{UPPER}', '{LOWER}'), '[0-9]+', '0', 'g'), '{WORD}'), ' ') AS line
            FROM lines
        ),
        hosts AS (SELECT source, count(DISTINCT text) AS n FROM docs GROUP BY source),
        above AS (
            SELECT p.source, p.line FROM plain p JOIN hosts h ON p.source IS NOT DISTINCT FROM h.source
            WHERE p.line != '' GROUP BY p.source, p.line
            HAVING count(DISTINCT p.text) > {LIMIT_DOCS} AND 100 * count(DISTINCT p.text) > {LIMIT_PERCENT} * any_value(h.n)
        ),
        lost AS (
            SELECT doc_id, sum(len(string_split(p.line, ' ')))::BIGINT AS n
            FROM plain p JOIN above a ON p.source IS NOT DISTINCT FROM a.source AND p.line = a.line GROUP BY doc_id
        ),
        counted AS (
            SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                coalesce(duplicate.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
                coalesce(lost.n, 0) AS n_removed_words
            FROM docs LEFT JOIN duplicate USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id)
        ),
        judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted)
        SELECT *, NOT base_failed AND 100 * n_removed_words <= {DEPLETED_PERCENT} * n_words AS kept FROM judged
    """,
    # The tables' pages all mark their article, so patterns find the same text there.
    "op10_html_extract": r"""
        WITH articles AS (
            SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS html FROM pages
        ),
        blocks AS (
            SELECT page_id, url, string_split(regexp_replace(regexp_replace(
                replace(html, '<br>', ' '), '</?(p|h1)>', chr(31), 'g'), '<[^>]*(>|$)', '', 'g'), chr(31)) AS blocks
            FROM articles
        ),
        texts AS (
            SELECT page_id, url, array_to_string(list_filter(list_transform(blocks, lambda b: trim(regexp_replace(
                regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(
                    b, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#x27;', chr(39)), '&amp;?', '&', 'g'),
                '\s+', ' ', 'g'))), lambda b: b != ''), chr(10) || chr(10)) AS text
            FROM blocks
        )
        SELECT page_id, url, text, length(text) AS n_chars FROM texts
    """,
    "op12_centroids": f"""
        WITH kept AS MATERIALIZED (
            SELECT vec_id, row_number() OVER () AS row,
                list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
        ),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v
            FROM kept ORDER BY sha256('3:' || vec_id), v LIMIT 8
        ),
        {rounds_of_clustering(10)}
        found AS (SELECT vec_id, best % 8 AS c, best // 8 AS distance FROM a10 JOIN kept USING (row))
        SELECT vec_id, c::INTEGER AS cluster, distance::BIGINT AS distance,
            (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
            sha256(array_to_string(v, ',')) AS centroid_sha256
        FROM found JOIN c10 USING (c)
    """,
}
