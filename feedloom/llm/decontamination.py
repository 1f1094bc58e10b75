"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, names and units become typed placeholders, so that a question asked with other
values has the same template. Windows of template tokens are hashed and joined; matching
windows are then compared slot by slot, and count where each value of the benchmark item
stands for the value of the document that it mostly stands for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import sized_join, whole_row
from feedloom.workspace import settle

#: Tokens of a window.
WINDOW = 8
#: Tokens of a window that must not be placeholders, unless its values are the same too.
MIN_LITERALS = 5
#: Windows of an item that a document must have, in percent.
MIN_PERCENT = 50
#: Consecutive equal tokens that are a copy by themselves, whatever their share of the item.
COPIED = 25
#: Items of fewer tokens say nothing by themselves: a name or a number is in many clean texts.
MIN_TOKENS = 5
#: A number, or a word of letters.
TOKEN = r"[0-9]+(?:[.,][0-9]+)*|\p{L}+"
#: Words that are units when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes "
    "ml l liter liters litre litres gallon gallons cup cups s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years cent cents dollar dollars euro euros percent degrees"
).split()


def raw_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def template_tokens(raw: Column) -> Column:
    """Tokens with numbers, units after a number, and words with a capital as placeholders.

    Digits sort below ':' and letters above it, so the comparison tells a number.
    """

    def typed(token: Column, at: Column) -> Column:
        first = F.substring(token, 1, 1)
        after_number = (at > 0) & (F.get(raw, at - 1) < ":")
        return (
            F.when(token < ":", "<num>")
            .when(first != F.lower(first), "<name>")
            .when(after_number & token.isin(UNITS), "<unit>")
            .otherwise(token)
        )

    return F.transform(raw, typed)


def with_hashes(texts: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """(keep, raw, typed, hashes): tokens, template tokens and their hashes, each computed once."""
    raw = texts.select(*keep, raw_tokens(text).alias("raw"))
    typed = raw.select("*", template_tokens(F.col("raw")).alias("typed"))
    return typed.select("*", F.transform("typed", lambda token: F.xxhash64(token)).alias("hashes"))


def windows(window: int) -> Column:
    """The hash of each window of template tokens, in order; none for fewer tokens than a window."""
    starts = F.sequence(F.lit(0), F.size("hashes") - window)

    def one(start: Column) -> Column:
        return F.xxhash64(*[F.get("hashes", start + shift) for shift in range(window)])

    return F.when(F.size("hashes") >= window, F.transform(starts, one)).otherwise(F.array().cast("array<bigint>"))


def detailed_windows(texts: DataFrame, window: int, *keep: str) -> DataFrame:
    """(keep, place, hash, values, types) of each window."""
    hashed = texts.withColumn("found", windows(window))

    def one(hash_: Column, at: Column) -> Column:
        return F.struct(
            at.alias("place"),
            hash_.alias("hash"),
            F.slice("raw", at + 1, window).alias("values"),
            F.slice("typed", at + 1, window).alias("types"),
        )

    return hashed.select(*keep, F.inline(F.transform("found", one)))


def union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def short_items(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", min_tokens: int = MIN_TOKENS
) -> DataFrame:
    """(item_id, text, n_tokens): the items that are too short to be looked for, as a report."""
    n_tokens = F.size(raw_tokens(F.col(f"`{text}`")))
    items = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    return items.withColumn("n_tokens", n_tokens).where(F.col("n_tokens") < min_tokens)


def item_windows(
    benchmark: DataFrame, item_id: str, text: str, window: int, min_tokens: int
) -> tuple[DataFrame, list[int]]:
    """Every window of every distinct item, settled, with the item's number of windows; the windows' lengths.

    An item shorter than a window has one of its whole length, and one of fewer than `min_tokens` none.
    """
    items = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text")).distinct()
    hashed = with_hashes(items, F.col("text"), F.col("item_id"), F.xxhash64("text").alias("item"))
    length = F.least(F.size("hashes"), F.lit(window))
    hashed = hashed.withColumn("n_windows", (F.size("hashes") - length + 1).cast("bigint"))
    short = hashed.where(F.size("hashes").between(max(min_tokens, 1), window - 1)).select(F.size("hashes").alias("n")).distinct()
    lengths = [row["n"] for row in short.collect()] + [window]
    found = [detailed_windows(hashed.where(length == n), n, "item_id", "item", "n_windows") for n in lengths]
    literals = F.size(F.filter("types", lambda token: ~F.startswith(token, F.lit("<"))))
    found = union(found).withColumn("literals", literals).withColumnRenamed("place", "item_place")
    return settle(found, "item-windows"), lengths


def clashes(pairs: DataFrame, run: list[str]) -> DataFrame:
    """(bad_ and each name of `run`, broken, bad_spots): the runs in which an item's value has several in the document.

    Windows that do not match, but have as many literals as placeholders, say too what
    such a value stands for. `bad_spots` are the item's slots with another value than the main one of theirs;
    `broken` says that a value has no main one.
    """
    slots = F.filter(
        F.transform(
            F.arrays_zip(F.col("types").alias("type"), F.col("values").alias("theirs"), F.col("own_values").alias("ours")),
            lambda slot, at: slot.withField("spot", F.col("item_place") + at),
        ),
        lambda slot: F.startswith(slot["type"], F.lit("<")),
    )
    form = F.struct(F.size("spots").alias("n"), (F.col("theirs") == F.col("ours")).alias("own"), "ours", "spots")
    forms = (
        pairs.select(*run, "strong", F.inline(slots))
        .groupBy(*run, "theirs", "ours")
        .agg(F.collect_set("spot").alias("spots"), F.max("strong").alias("strong"))
        .groupBy(*run, "theirs")
        .agg(
            F.count_if("strong").alias("n_strong"),
            F.sum(F.size("spots")).alias("n"),
            F.sort_array(F.collect_list(form), asc=False).alias("forms"),
        )
        .where("n_strong > 1")
    )
    main = F.col("forms")[0]
    held = (main["n"] * 2 > F.col("n")) | (main["n"] * 2 == F.col("n")) & main["own"]
    others = F.flatten(F.slice("forms", 2, F.size("forms"))["spots"])
    return (
        forms.select(*[F.col(name).alias(f"bad_{name}") for name in run], held.alias("held"), others.alias("others"))
        .groupBy(*[f"bad_{name}" for name in run])
        .agg((~F.every("held")).alias("broken"), F.flatten(F.collect_list("others")).alias("bad_spots"))
    )


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    min_literals: int = MIN_LITERALS,
    min_percent: int = MIN_PERCENT,
    copied: int = COPIED,
    min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """(text_hash, item_id, n_matched, n_windows): the contaminated texts, settled.

    A window matches where template tokens are equal, and either all values are too or
    at least `min_literals` tokens are no placeholders. Matches with the same shift
    between document and item count if each value in the item's slots has one main value
    in the document's: that of over half of its slots, or at half of them itself. Windows
    with another value than the main one do not count. A text is contaminated by an item when at least `min_percent` of the
    item's windows count, or by a copy of `copied` or more consecutive equal tokens; then
    all equal windows of that shift count. An item shorter than a window is one window of
    its whole length; one of fewer than `min_tokens` is not looked for (`short_items` lists
    those), as a name or a number alone would take clean texts. Benchmark windows are broadcast where their measured size
    allows it, and merged otherwise.
    """
    items, lengths = item_windows(benchmark, item_id, item_text, window, min_tokens)
    hashes = settle(items.select("hash").distinct(), "item-hashes")
    own = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    hashed = with_hashes(docs, F.col(f"`{text}`"), own.alias("doc"))
    found = hashed.select("doc", F.explode(F.concat(*[windows(n) for n in lengths])).alias("hash"))
    candidates = settle(sized_join(found, hashes, "hash", "left_semi").select("doc").distinct(), "candidates")

    texts = sized_join(docs.select(own.alias("doc"), F.col(f"`{text}`").alias("text")), candidates, "doc", "left_semi")
    texts = with_hashes(texts.distinct(), F.col("text"), F.col("doc"))
    own_windows = union([detailed_windows(texts, n, "doc") for n in lengths])
    pairs = sized_join(own_windows.drop("types").withColumnRenamed("values", "own_values"), items, "hash")
    equal = F.col("own_values").eqNullSafe(F.col("values"))
    strong = equal | (F.col("literals") >= min_literals)
    pairs = pairs.withColumn("shift", F.col("place") - F.col("item_place")).withColumns({"strong": strong, "equal": equal})
    pairs = pairs.where(F.col("strong") | (F.col("literals") * 2 >= F.size("types")))
    pairs = settle(pairs.drop("hash", "literals", "place"), "matched-windows")

    run = ["doc", "item_id", "item", "shift"]
    clashing = clashes(pairs, run)
    same = [F.col(name).eqNullSafe(F.col(f"bad_{name}")) for name in run]
    end = F.col("item_place") + F.size("types")
    spoilt = F.exists("bad_spots", lambda spot: (spot >= F.col("item_place")) & (spot < end))
    places = F.sort_array(F.collect_set("item_place"))
    length = max(copied - window + 1, 1)  # in windows
    copies = pairs.where("equal").groupBy(*run).agg(places.alias("places")).where(F.size("places") >= length)
    starts = F.sequence(F.lit(0), F.size("places") - length)
    consecutive = F.exists(starts, lambda at: F.get("places", at + length - 1) - F.get("places", at) == length - 1)
    copies = copies.where(consecutive).select(*[F.col(name).alias(f"bad_{name}") for name in run], F.lit(True).alias("copy"))
    judged = pairs.where("strong").join(clashing, same, "left").drop(*[f"bad_{name}" for name in run])
    judged = judged.join(copies, same, "left").withColumn("copy", F.coalesce("copy", F.lit(False)))
    sound = judged.where(F.coalesce(~F.col("broken") & ~spoilt, F.lit(True)) | (F.col("copy") & F.col("equal")))
    counted = (
        sound.groupBy("doc", "item_id", "item", "item_place", "n_windows")
        .agg(F.max("copy").alias("copy"))
        .groupBy("doc", "item_id", "item", "n_windows")
        .agg(F.count("*").alias("n_matched"), F.max("copy").alias("copy"))
        .where(F.col("copy") | (F.col("n_matched") * 100 >= F.col("n_windows") * min_percent))
    )
    best = counted.groupBy(F.col("doc").alias("text_hash"), "item_id").agg(
        F.max(F.struct("n_matched", "n_windows")).alias("best")
    )
    return settle(best.select("text_hash", "item_id", "best.*"), "contaminated")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, n_matched, n_windows.

    Null and empty texts, and items of fewer than `min_tokens` tokens, match nothing. Documents with equal texts, and repeated rows, each get their rows; of items
    that share an id the best match counts. Null ids are carried as they are. Other
    columns are not looked at; empty tables on either side give no rows.
    """
    own = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    ids = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), own.alias("text_hash"))
    found = matches(docs, benchmark, text, **options)
    return sized_join(ids, found, "text_hash").select("doc_id", "item_id", "n_matched", "n_windows")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    found = matches(docs, benchmark, text, **options).select("text_hash").distinct()
    own = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    packed = docs.select(whole_row(docs), own.alias("text_hash"))
    return sized_join(packed, settle(found, "contaminated-texts"), "text_hash", "left_anti").select("row.*")
