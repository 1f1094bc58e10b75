"""Line dedup by a log-template tree of fixed depth, in DataFrame functions only.

A line's leaf in the tree is its token count and its leading tokens, with digit runs as
wildcards. Within a leaf that recurs, the tokens of a line that most documents have at
that place stay in its template, as many as it needs to count as constant; rarer ones are
values of variable fields and become wildcards too, however many documents the leaf has.
Templates that recur across documents are dropped but for the first document that has
them. A line without variable fields needs the fewer documents the more words recur with
it, in itself and in its neighbours; one with such fields needs more the fewer words of
its own it has, and the more lines the corpus has to show them by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import sized_join, whole_row
from feedloom.workspace import settle

#: Leading tokens that a leaf of the tree fixes, besides the token count.
DEPTH = 3
#: Documents in which a line recurs by any length; with fewer, two at least, their number times the passage's
#: plain tokens must come to EVIDENCE.
MIN_DOCS = 10
EVIDENCE = 100
#: The same of templates with wildcards, three documents at least; the documents double with each plain token that
#: the template has too few of beyond the leaf's.
GENERAL_EVIDENCE = 150
GENERAL_MIN_DOCS = 3
GENERAL_TOKENS = 6
#: Of this many lines one may have a given token at a given place by chance.
CHANCE = 10
#: Tokens of a line or template that must be plain, free of wildcards, in percent.
CONSTANT_PERCENT = 60
WILDCARD = "<*>"


def masked(text: Column) -> Column:
    """The text with digit runs as wildcards and white space within lines as one space."""
    plain = F.regexp_replace(text, r"\x20*[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20{2,}", " ")
    return F.regexp_replace(plain, "[0-9]+", WILDCARD)


def n_tokens(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def n_plain(line: Column, size: Column) -> Column:
    """The tokens of a masked line that hold no wildcard."""
    plain = F.size(F.filter(F.split(line, " "), lambda token: ~F.contains(token, F.lit(WILDCARD))))
    return F.when(F.contains(line, F.lit(WILDCARD)), plain).otherwise(size)


def placed_lines(text: Column, depth: int) -> Column:
    """Every line of a text, in order: its key, its leaf in the tree, and itself masked and trimmed."""

    def place(line: Column) -> Column:
        lead = F.substring_index(line, " ", depth)
        return F.struct(
            F.xxhash64(line).alias("key"),
            F.xxhash64(n_tokens(line), lead).alias("leaf"),
            n_tokens(line).alias("size"),
            n_plain(line, n_tokens(line)).alias("plain"),
            line.alias("line"),
        )

    return F.transform(F.transform(F.split(masked(text), "\n"), lambda line: F.trim(line)), place)


def own_text(text: str) -> tuple[Column, Column]:
    """A text column without nulls, and its hash, which stands for the document."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return body, F.xxhash64(body)


def general_docs(plain: Column, min_docs: int) -> Column:
    """The documents that a template with `plain` plain tokens needs at least."""
    docs = F.least(F.lit(min_docs), F.ceil(GENERAL_EVIDENCE / F.greatest(plain, F.lit(1))))
    return F.greatest(F.lit(min(min_docs, GENERAL_MIN_DOCS)), docs)


def reached(supports: Column, n: Column, percent: int) -> Column:
    """The support that `percent` of `n` tokens reach; null where there are not so many."""
    return F.get(F.sort_array(supports, asc=False), F.ceil(n * percent / 100).cast("int") - 1)


def templates(lines: DataFrame, occurrences: DataFrame, min_docs: int, depth: int, constant_percent: int) -> DataFrame:
    """(leaf, key, template): the template of each line in a recurring leaf that has enough constant tokens.

    A token's support is the number of documents that have it at its place in the leaf.
    The template is the most general one that still has `constant_percent` of its tokens
    plain, and keeps that share of the tokens that the leaf does not fix: it keeps those
    with at least the support that so many of them reach. Only the order of the supports
    matters, so that a corpus of any size gives the same template; a support that no
    template of the size recurs with counts as none. `template` has the documents that it
    `needs`: they double with each plain token short of GENERAL_TOKENS beyond the leaf's,
    and come to the lines that would show its plain tokens by chance.
    """
    enough = F.col("n") >= general_docs(F.col("size"), min_docs)
    n_lines = occurrences.count()
    leaves = occurrences.groupBy("leaf", "size").agg(F.count("*").alias("n")).where(enough).select("leaf")
    leaves = settle(leaves, "recurring-leaves")
    known = sized_join(occurrences, leaves, "leaf", "left_semi")
    counts = known.groupBy("leaf", "key", "size").agg(F.count("*").alias("n"))
    texts = lines.select(F.inline("lines")).where("line != ''")
    texts = sized_join(texts, leaves, "leaf", "left_semi").groupBy("leaf", "key", "line").agg(F.lit(1).alias("one"))
    known = settle(texts.drop("one").join(counts, ["leaf", "key"]), "leaf-lines")

    tokens = known.select("leaf", "key", "size", "n", F.posexplode(F.split("line", " ")).alias("place", "token"))
    tokens = tokens.withColumn("spot", F.xxhash64("leaf", "place", "token"))
    supports = tokens.groupBy("spot", "size").agg(F.sum("n").alias("n")).where(enough)
    supports = settle(supports.select("spot", F.col("n").alias("support")), "constant-tokens")
    # merged at every size, as they grow alike
    placed = tokens.drop("size", "n").join(supports.hint("merge"), "spot", "left")
    token = F.struct("place", "token", F.coalesce("support", F.lit(0)).alias("support"))
    placed = placed.groupBy("leaf", "key").agg(F.array_sort(F.collect_list(token)).alias("tokens"))

    plain = F.filter("tokens", lambda token: ~F.contains(token["token"], F.lit(WILDCARD)))["support"]
    least = reached(plain, F.size("tokens"), constant_percent)
    free = F.slice("tokens", depth + 1, F.greatest(F.size("tokens"), F.lit(1)))["support"]
    least = F.when(least.isNotNull(), F.least(least, reached(free, F.size(free), constant_percent)))

    def general(least: Column) -> Column:
        return F.transform("tokens", lambda token: F.when(token["support"] >= least, token["token"]).otherwise(WILDCARD))

    def needed(kept: Column) -> Column:
        def plain(tokens: Column) -> Column:
            return F.size(F.filter(tokens, lambda token: ~F.contains(token, F.lit(WILDCARD))))

        short = F.greatest(F.lit(0), GENERAL_TOKENS - plain(F.slice(kept, depth + 1, F.greatest(F.size(kept), F.lit(1)))))
        chance = F.ceil(n_lines / F.pow(F.lit(float(CHANCE)), F.least(plain(kept), F.lit(15))))
        return F.greatest(general_docs(plain(kept), min_docs) * F.pow(F.lit(2.0), short).cast("bigint"), chance)

    kept = F.get(F.transform(F.array(least), general), 0)  # bound, so that it is not found again for each token
    found = placed.where(least > 0).select("leaf", "key", kept.alias("kept"))
    return found.select("leaf", "key", F.xxhash64("leaf", F.array_join("kept", " ")).alias("template"), needed(F.col("kept")).alias("needs"))


def repeated_passages(lines: DataFrame, occurrences: DataFrame, min_docs: int, constant_percent: int) -> DataFrame:
    """(doc, number) of the lines that recur as they are, but for the first document that has each.

    A passage is a run of neighbours, blank lines aside, each of which follows the one before
    it in two documents or more. A line goes when `min_docs` documents have it, or when two
    or more do and their number times the passage's plain tokens comes to EVIDENCE.
    """
    repeated = occurrences.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "doc")).alias("first"))
    repeated = settle(repeated.where("n >= 2").select("key", "n", F.col("first.doc").alias("keeper")), "repeated-lines")

    def ranked(lines: Column) -> Column:
        numbered = F.transform(lines, lambda line, number: F.struct(number.alias("number"), line.alias("own")))
        return F.filter(numbered, lambda line: line["own"]["line"] != "")

    found = lines.select("doc", F.posexplode(ranked(F.col("lines"))).alias("rank", "at"))
    found = found.select("doc", "rank", "at.number", "at.own.key", "at.own.size", "at.own.plain")
    # Equal texts are one; a third of all rows may be, so they are combined before the shuffle.
    places = sized_join(found, repeated, "key").dropDuplicates(["doc", "rank"])
    order = Window.partitionBy("doc").orderBy("rank")
    before = F.when(F.lag("rank").over(order) == F.col("rank") - 1, F.lag("key").over(order))
    places = places.withColumn("pair", F.when(before.isNotNull(), F.xxhash64(before, "key")))
    places = settle(places, "repeated-places")
    pairs = places.where("pair IS NOT NULL").select("pair", "doc").distinct().groupBy("pair").agg(F.count("*").alias("n"))
    pairs = settle(pairs.where("n >= 2").select("pair", F.lit(True).alias("follows")), "repeated-pairs")
    runs = sized_join(places, pairs, "pair", "left").withColumn("run", F.count(F.when(F.col("follows").isNull(), 1)).over(order))
    runs = runs.withColumn("passage", F.sum("plain").over(Window.partitionBy("doc", "run")))
    goes = (F.col("n") >= min_docs) | (F.col("n") * F.col("passage") >= EVIDENCE)
    worded = F.col("plain") * 100 >= F.col("size") * constant_percent
    return runs.where(goes & worded & (F.col("doc") != F.col("keeper"))).select("doc", "number")


def dropped_lines(
    docs: DataFrame,
    doc_id: str,
    text: str,
    depth: int = DEPTH,
    min_docs: int = MIN_DOCS,
    constant_percent: int = CONSTANT_PERCENT,
) -> tuple[DataFrame, DataFrame]:
    """The lines of all documents, and (text_hash, dropped) of the texts that lose some, both settled.

    Hot lines are combined before each shuffle.
    """
    body, own = own_text(text)
    lines = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), own.alias("doc"), placed_lines(body, depth).alias("lines"))
    lines = settle(lines, "lines")
    found = lines.select("doc_id", "doc", F.inline("lines")).where("line != ''")
    occurrences = settle(found.groupBy("leaf", "key", "size", "doc").agg(F.min("doc_id").alias("doc_id")), "line-places")

    mapped = templates(lines, occurrences, min_docs, depth, constant_percent)
    mapped = occurrences.join(mapped, ["leaf", "key"]).select("template", "needs", "key", "doc", "doc_id")
    mapped = settle(mapped, "templated")
    recurring = (
        mapped.groupBy("template", "needs", "doc")
        .agg(F.min("doc_id").alias("doc_id"))
        .groupBy("template", "needs")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "doc")).alias("first"))
        .where("n >= needs")
        .select("template", F.col("first.doc").alias("keeper"))
    )
    recurring = settle(recurring, "recurring-templates")
    drops = sized_join(mapped, recurring, "template").where("doc != keeper").select("doc", "key").distinct()
    numbered_lines = lines.select("doc", F.posexplode("lines.key").alias("number", "key"))
    general = numbered_lines.join(drops, ["doc", "key"]).select("doc", "number")
    plain = repeated_passages(lines, occurrences, min_docs, constant_percent)
    dropped = (
        general.unionByName(plain)
        .groupBy(F.col("doc").alias("text_hash"))
        .agg(F.sort_array(F.collect_set("number")).alias("dropped"))
    )
    return lines, settle(dropped, "dropped-lines")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, text_hash, n_lines (with a token), dropped (line numbers from 0).

    A line without variable fields but numbers recurs as `repeated_passages` says: in
    `min_docs` documents, or in fewer, two at least, if it is long or part of a long passage;
    a template as `templates` says. It stays in the document
    with the smallest doc_id (null is smallest, then the smallest text hash) and
    its lines are dropped from all others. Documents with equal texts count as one and
    lose the same lines, so that whole copies are left to a later stage. A null or empty
    text has no lines. Blank lines are never dropped. Other columns are not looked at.
    """
    lines, dropped = dropped_lines(docs, doc_id, text, **options)
    filled = F.size(F.filter(F.col("lines.line"), lambda line: line != ""))
    counted = lines.select("doc_id", F.col("doc").alias("text_hash"), filled.cast("bigint").alias("n_lines"))
    return sized_join(counted, dropped, "text_hash", "left").select(
        "doc_id", "text_hash", "n_lines", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")
    )


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with all their columns and without their repeated lines.

    A document that loses every line it had leaves; texts that lose none stay as they
    are, null included.
    """
    _, lost = dropped_lines(docs, doc_id, text, **options)
    _, own = own_text(text)
    joined = sized_join(docs.select(whole_row(docs), own.alias("text_hash")), lost, "text_hash", "left")
    before = F.col("row")[text]
    left = F.filter(F.split(before, "\n"), lambda line, number: ~F.array_contains("dropped", number))
    after = F.when(F.col("dropped").isNull(), before).otherwise(F.array_join(left, "\n"))
    emptied = F.col("dropped").isNotNull() & ~F.rlike(after, F.lit(r"[^\x20\x09-\x0D]"))
    columns = [after.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    return joined.where(~emptied).select(*columns)
