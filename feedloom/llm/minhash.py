"""Near duplicates by circulant MinHash, banding, and exact Jaccard verification.

Two permutations of the 32-bit numbers make a whole signature: the first places each
shingle in the universe, the second, shifted round by k, gives coordinate k. Texts that
share a band fall into one candidate group. Within a group full shingle sets are compared
inside tasks, so that only links come out, never candidate pairs. A group too large for a
task is first tied together by its bands' smallest members, then compared band by band, and
there only across what those ties have left apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from feedloom.llm.common import connected_components, sized_join, whole_row
from feedloom.llm.slices import by_slices
from feedloom.workspace import settle

#: A link of similarity 0.85 shares no band with probability (1 - 0.85**7)**36 < 1e-6.
BANDS = 36
ROWS = 7
#: Shingles of one block of a candidate group; a task compares two blocks at most.
BLOCK_SHINGLES = 400_000
#: Shingles whose coordinates are made together, so that they stay in a core's cache.
CACHED = 1 << 15
#: Rows without an id get node numbers from here on.
NO_ID = 1 << 62

SIGNATURE = (
    StructType()
    .add("n_shingles", LongType())
    .add("key1", LongType())
    .add("key2", LongType())
    .add("bands", ArrayType(LongType()))
)

# The two permutations: odd multipliers and shifts, each step one to one on 32 (64) bits.
M1, M2, M3, M4 = (np.uint32(m) for m in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F))
W1, W2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * W2
    values = (values ^ (values >> np.uint64(29))) * W1
    return values ^ (values >> np.uint64(32))


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes, remembering the hashes of words."""

    LIMIT = 1_000_000

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if len(self.known) > self.LIMIT:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(words))
        if not size:
            return hashes
        run = np.full(len(words) - size + 1, size, np.uint64)
        for shift in range(size):
            run = mixed(run * W1 + hashes[shift : shift + len(run)])
        return np.unique(run)


def coordinates(sets: list[np.ndarray], count: int) -> np.ndarray:
    """The signatures (sets x count) of non-empty sets."""
    signatures = np.empty((len(sets), count), np.uint32)
    start = 0
    while start < len(sets):
        end, size = start, 0
        while end < len(sets) and (end == start or size + len(sets[end]) <= CACHED):
            size += len(sets[end])
            end += 1
        places = (np.concatenate(sets[start:end]) >> np.uint64(32)).astype(np.uint32)
        places = (places ^ (places >> np.uint32(16))) * M1
        places = (places ^ (places >> np.uint32(13))) * M2
        bounds = np.cumsum([0, *map(len, sets[start : end - 1])])
        turned = places * M3
        value = np.empty_like(turned)
        high = np.empty_like(turned)
        for k in range(count):  # (place + k) * M3, then the rest of the second permutation
            np.add(turned, np.uint32(k * int(M3) & 0xFFFFFFFF), out=value)
            np.right_shift(value, 15, out=high)
            np.bitwise_xor(value, high, out=value)
            np.multiply(value, M4, out=value)
            signatures[start:end, k] = np.minimum.reduceat(value, bounds)
        start = end
    return signatures


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for row in range(rows):
        keys = mixed(keys * W1 + parts[:, :, row])
    return keys.view(np.int64)


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """An array of lists of 64-bit numbers."""
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(flat))


def signer(words: int, bands: int, rows: int):
    @F.arrow_udf(SIGNATURE)
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shingles = Shingler(words)

        def compute(texts: list[str | None]) -> pa.Array:
            sets = [shingles(text) for text in texts]
            filled = [found for found in sets if len(found)]
            signed = iter(band_keys(coordinates(filled, bands * rows), bands, rows) if filled else ())
            keys = np.array([np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64) for found in sets])
            none = np.zeros(0, np.int64)
            columns = [np.array([len(found) for found in sets]), keys[:, 0], keys[:, 1]]
            listed = lists([next(signed) if len(found) else none for found in sets])
            return pa.StructArray.from_arrays([*map(pa.array, columns), listed], SIGNATURE.names)

        numbers = [(name, pa.int64()) for name in SIGNATURE.names[:-1]]
        yield from by_slices(batches, compute, pa.struct([*numbers, (SIGNATURE.names[-1], pa.list_(pa.int64()))]))

    return sign


def shingle_sets(words: int):
    @F.arrow_udf(ArrayType(LongType()))
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shingles = Shingler(words)
        yield from by_slices(batches, lambda texts: lists([shingles(text) for text in texts]), pa.list_(pa.int64()))

    return sets


def links(
    sets: list[np.ndarray], side: np.ndarray | None, percent: int, part: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """A spanning forest of the links among `sets`, or with sides between those of side 0 and 1.

    A link has 100 * intersection >= percent * union. Sets of one `part` count as connected.
    With its shingles in order of how many sets hold them, rarest first, a set can only link
    with one that shares a shingle of both their first size - ceil(percent * size / 100) + 1,
    and whose size is within the same ratio; only such pairs are intersected.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, term, spread = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    term = term[np.lexsort((term, spread[term], owner))]
    starts = np.r_[0, np.cumsum(sizes)]
    heads = np.flatnonzero(np.arange(len(owner)) - starts[owner] <= (sizes - -(-sizes * percent // 100))[owner])
    heads = heads[spread[term[heads]] > 1]
    # Owners by head shingle, ascending within each.
    postings = owner[heads][np.argsort(term[heads], kind="stable")]
    held = np.bincount(term[heads], minlength=len(spread))
    begins = np.cumsum(held) - held
    heads = heads[held[term[heads]] > 1]
    bounds = np.searchsorted(owner[heads], np.arange(len(sets) + 1))
    leader = np.arange(len(sets)) if part is None else np.unique(part, return_inverse=True)[1]
    members = [[] for _ in sets]
    for one, root in enumerate(leader):
        members[root].append(one)
    mark = np.zeros(len(spread), bool)
    found = []
    for one in np.unique(owner[heads]):
        if side is not None and side[one]:
            continue
        near = term[heads[bounds[one] : bounds[one + 1]]]
        other = postings[_runs(begins[near], held[near])]
        keep = (leader[other] != leader[one]) & (side[other] == 1 if side is not None else other > one)
        other = np.unique(other[keep])
        low, high = np.minimum(sizes[other], sizes[one]), np.maximum(sizes[other], sizes[one])
        other = other[low * 100 >= high * percent]
        if not len(other):
            continue
        own = term[starts[one] : starts[one + 1]]
        mark[own] = True
        lengths = sizes[other]
        common = np.add.reduceat(mark[term[_runs(starts[other], lengths)]], np.cumsum(lengths) - lengths, dtype=np.int64)
        mark[own] = False
        for linked in other[common * 100 >= (lengths + sizes[one] - common) * percent]:
            small, large = leader[one], leader[linked]
            if small != large:
                found.append((int(one), int(linked)))
                if len(members[small]) > len(members[large]):
                    small, large = large, small
                leader[members[small]] = large
                members[large] += members[small]
                members[small] = []
    return found


def _runs(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """begins[i], begins[i] + 1, ... for lengths[i] numbers, one run after the other."""
    return np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def verifier(percent: int):
    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by("root")
        roots = table.column("root").to_numpy()
        nodes = table.column("node").to_numpy()
        block = table.column("block").to_numpy()
        parts = table.column("part").to_numpy()
        p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
        sets = [np.asarray(s).view(np.uint64) for s in table.column("shingles").to_pandas()]
        cuts = np.r_[0, np.flatnonzero(roots[1:] != roots[:-1]) + 1, len(roots)]
        pairs = []
        for start, end in zip(cuts[:-1], cuts[1:]):
            side = (block[start:end] == q).astype(int) if p != q else None
            pairs += [(start + a, start + b) for a, b in links(sets[start:end], side, percent, parts[start:end])]
        return pa.table(
            {
                "a": pa.array([int(nodes[a]) for a, _ in pairs], pa.int64()),
                "b": pa.array([int(nodes[b]) for _, b in pairs], pa.int64()),
            }
        )

    return verify


def shared_bands(nodes: DataFrame) -> DataFrame:
    """(node, key, first) for the bands that a node shares with another; `first` is the band's smallest node."""
    keys = settle(nodes.select("node", F.explode("bands").alias("key")), "band-keys")
    buckets = (
        keys.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first != last")
    )
    # Merged at every size: buckets and groups grow with the documents.
    return keys.join(buckets.select("key", "first").hint("merge"), "key").select("node", "key", "first")


def verified_links(shared: DataFrame, texts: DataFrame, words: int, percent: int, block_shingles: int) -> DataFrame:
    """Links (a, b) that connect what is connected among the nodes that share bands.

    Bands that share nodes form a candidate group. The sets of a group of up to
    `block_shingles` shingles meet in one task. A larger group's sets first meet the smallest
    node of each of their bands, which ties copies of one text together at a cost that grows
    with their number; then they meet within each band that still holds several parts.
    """
    groups = connected_components(shared.select(F.col("node").alias("a"), F.col("first").alias("b")))
    sets = texts.join(settle(groups, "groups").hint("merge"), "node").select(
        "node", F.col("component").alias("root"), shingle_sets(words)("text").alias("shingles")
    )
    sets = settle(sets.withColumn("n", F.size("shingles")), "shingle-sets")
    large = sets.groupBy("root").agg(F.sum("n").alias("total")).where(F.col("total") > block_shingles)
    large = settle(large.select("root"), "large-groups")
    teams = -(-(sets.agg(F.sum("n")).first()[0] or 0) // block_shingles) + 1
    met = sized_join(sets, large, "root", "left_anti").select(
        F.lit(False).alias("wide"),
        F.pmod(F.xxhash64("root"), F.lit(teams)).alias("team"),
        *[F.lit(0).alias(name) for name in ("p", "q", "block")],
        "root",
        "node",
        F.col("node").alias("part"),
        "shingles",
    )
    found = compared(met, percent)
    if large.isEmpty():
        return found
    wide = settle(sized_join(sets, large, "root", "left_semi").select("node", "n", "shingles"), "wide-sets")
    bands = settle(shared.join(wide.select("node", "n").hint("merge"), "node"), "wide-bands")
    ties = settle(tied(bands, wide, percent, block_shingles), "ties")
    left = settle(bands_left_open(bands, ties), "bands-left")
    return found.unionByName(ties).unionByName(block_links(left, wide, percent, block_shingles))


def compared(met: DataFrame, percent: int) -> DataFrame:
    return met.groupBy("wide", "team", "p", "q").applyInArrow(verifier(percent), "a bigint, b bigint")


def tied(bands: DataFrame, sets: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """The links (a, b) of sets with the smallest nodes of their bands.

    A smallest node of very many bands' members is copied once for each `block_shingles`
    shingles of these, so that no task gets all of them.
    """
    pairs = settle(bands.where("node != first").select("node", "first", "n").distinct(), "band-pairs")
    parts = pairs.groupBy("first").agg(F.ceil(F.sum("n") / F.lit(block_shingles)).cast("int").alias("parts"))
    parts = settle(parts, "band-parts")
    salt = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("salt")
    asking = pairs.join(parts.hint("merge"), "first").select("node", "first", salt)
    asking = asking.join(sets.hint("merge"), "node")
    asked = sets.join(parts.hint("merge"), F.col("node") == F.col("first")).select(
        "first", F.col("shingles").alias("its"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt")
    )
    common = F.size(F.array_intersect("shingles", "its"))
    union = F.size("shingles") + F.size("its") - common
    met = asking.join(asked.hint("merge"), ["first", "salt"])
    return met.where(common * 100 >= union * percent).select(F.col("node").alias("a"), F.col("first").alias("b"))


def bands_left_open(bands: DataFrame, ties: DataFrame) -> DataFrame:
    """(root, node, n, part, main) for the bands whose nodes the ties leave in several parts.

    Bands of the same nodes count once. `main` marks the part with most shingles of a band.
    """
    parts = settle(connected_components(ties), "tied-parts")
    placed = bands.join(parts.hint("merge"), "node", "left")
    placed = settle(placed.select("key", "node", "n", F.coalesce("component", "node").alias("part")), "band-nodes")
    hashes = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"h{seed}") for seed in (1, 2)]
    held = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("held"), *hashes)
    chosen = held.where("low != high").groupBy("held", "h1", "h2").agg(F.min("key").alias("key")).select("key")
    left = settle(placed.join(chosen.hint("merge"), "key"), "open-nodes")
    main = left.groupBy("key", "part").agg(F.sum("n").alias("n")).groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("most"))
    return left.join(main.hint("merge"), "key").select(
        F.col("key").alias("root"), "node", "n", "part", (F.col("part") == F.col("most")).alias("main")
    )


def block_links(placed: DataFrame, sets: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """Links (a, b) that connect what is connected within each root, across its parts.

    `placed` has root, node, n, part and main. A root is cut into blocks of about
    `block_shingles` shingles, its main part into blocks of their own, which meet the other
    blocks but not each other. Small roots share a task; each pair of blocks has one.
    """
    shingles = [F.coalesce(F.sum(F.when(side, F.col("n"))), F.lit(0)) for side in (~F.col("main"), F.col("main"))]
    sizes = settle(placed.groupBy("root").agg(shingles[0].alias("rest"), shingles[1].alias("most")), "root-sizes")
    total = F.col("rest") + F.col("most")
    teams = -(-(sizes.agg(F.sum(total)).first()[0] or 0) // block_shingles) + 1
    wide = total > block_shingles
    blocks = [F.ceil(F.col(name) / F.lit(block_shingles)).cast("int") for name in ("rest", "most")]
    sizes = sizes.select(
        "root",
        wide.alias("wide"),
        F.when(wide, blocks[0]).otherwise(1).alias("rests"),
        F.when(wide, blocks[1]).otherwise(0).alias("mains"),
    )
    is_main = F.col("main") & F.col("wide")
    own = F.pmod(F.xxhash64("node"), F.greatest(F.when(is_main, F.col("mains")).otherwise(F.col("rests")), F.lit(1)))
    last = F.when(is_main, F.col("rests")).otherwise(F.col("rests") + F.col("mains")) - 1
    met = (
        placed.join(sizes.hint("merge"), "root")
        .withColumn("block", (own + F.when(is_main, F.col("rests")).otherwise(0)).cast("int"))
        .withColumn("team", F.when(F.col("wide"), F.col("root")).otherwise(F.pmod(F.xxhash64("root"), F.lit(teams))))
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("p", F.least("block", "other"))
        .withColumn("q", F.greatest("block", "other"))
        .join(sets.select("node", "shingles").hint("merge"), "node")
    )
    columns = ["wide", "team", "p", "q", "block", "root", "node", "part", "shingles"]
    return compared(met.select(columns), percent)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of other characters than ASCII white space, A-Z lowered; a set is the
    distinct shingles of `words` words, or the whole sequence where there are fewer.
    Documents link at 100 * intersection >= percent * union of full sets; component_id is
    the smallest doc_id reachable. The chance to miss a link at the threshold is
    (1 - (percent/100)**rows)**bands.

    A null, empty or blank text has 0 shingles and links with nothing. Repeated rows and
    rows that share a doc_id are one document and share a component. Rows without an id
    take part, but name a component only by null, when it has no id at all. Other columns
    are not looked at. Equal sets are one node from the start, so copies cost one narrow
    row each.
    """
    sign = signer(words, bands, rows)
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    signed = settle(source.select("doc_id", sign("text").alias("s")).select("doc_id", "s.*"), "signatures")
    number = F.pmod(F.xxhash64("key1", "key2"), F.lit(NO_ID)) + F.lit(NO_ID)
    classes = (
        signed.where("n_shingles > 0").groupBy("key1", "key2").agg(F.coalesce(F.min("doc_id"), number).alias("node"))
    )
    classes = settle(classes, "classes")
    own = signed.where("n_shingles > 0").join(classes, ["key1", "key2"])
    first = F.col("doc_id").isNull() | (F.col("doc_id") == F.col("node"))
    shared = shared_bands(own.where(first).select("node", "bands"))
    unnamed = own.where("doc_id IS NULL").where(F.col("node") >= NO_ID).select("node", "key1", "key2")
    texts = source.select(F.col("doc_id").alias("node"), "text").where("node IS NOT NULL")
    if unnamed.take(1):
        nameless = source.where("doc_id IS NULL").select("text", sign("text").alias("s"))
        nameless = nameless.select("text", "s.key1", "s.key2").join(unnamed.distinct(), ["key1", "key2"])
        texts = texts.unionByName(nameless.select("node", "text"))
    linked = connected_components(verified_links(shared, texts, words, percent, block_shingles))
    named = (
        classes.join(linked, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("component", F.when(F.col("component") < NO_ID, F.col("component")))
        .select("key1", "key2", "component")
    )
    empty = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    filled = signed.where("n_shingles > 0").join(named, ["key1", "key2"])
    filled = filled.select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    return filled.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that `near_duplicates` keeps, with all their columns: one of each group.

    Rows that share a doc_id are one document and stay together; so do all rows without
    an id, which cannot be told apart, if one of them is kept.
    """
    kept = near_duplicates(docs, doc_id, text, **options).where("kept").select("doc_id").distinct()
    packed = docs.select(whole_row(docs))
    return packed.join(kept, F.col("row")[doc_id].eqNullSafe(F.col("doc_id")), "left_semi").select("row.*")
