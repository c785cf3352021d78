"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian verification.

1. ``signed`` reduces every document to the digest of its shingle set and to the buckets
   of its signature's bands. Documents with equal sets form a class at once; only its
   smallest id goes on.
2. Ids that share a bucket are candidates. Each bucket links its members to its smallest
   one, and the components of these links are candidate groups. Documents that are not
   alike share a bucket too rarely for groups to run together.
3. Groups are cut into cells of at most ``CELL`` members, which get their full sets and
   signatures. In a cell, each member's signature is compared with the others' in batches;
   a pair is dropped as soon as the posterior probability that it reaches the threshold is
   below ``MISS``. Survivors are verified on the full sets, likeliest first, and a member
   that is linked to a component needs no further link to it. A cell thus returns a
   spanning forest, never all pairs.
4. Groups of more than one cell take a second pass over pairs of cells. Its cells are cut
   in the order of the components found so far, and pairs of cells that lie within one
   component are left out before any set is moved.

A pair at the threshold is missed by the bands with probability (1 - t^ROWS)^BANDS, 3e-6
at 0.8, and by the posterior bound with a few times ``MISS``. Verified links are exact
but for collisions of 64-bit shingle digests.

Defined cases: words are split at space and U+0009 to U+000D, with A-Z lowered. A text
with fewer words than a shingle has one shingle, its whole sequence. A null text or one
without words has none and is its own component. Documents without id take no part: their
component is null and they are kept. Rows that repeat an id are one document of the graph,
linked wherever any of its texts is; each row has the component of its own text's class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficloom.llm.common import stored
from trafficloom.llm.graph import components

SHINGLE = 5
PERCENT = 80
ROWS = 5
BANDS = 32
BATCH = 32
MISS = 1e-6
CELL = 512

#: Shingles hashed at once when signatures are made; bounds a worker's memory.
STEP = 1 << 16


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240607)
    return draw.integers(0, 2**32, ROWS * BANDS, np.uint32) | np.uint32(1), draw.integers(0, 2**32, ROWS * BANDS, np.uint32)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit digests of the text's shingles."""
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    if not words:
        return np.zeros(0, np.uint64)
    digests = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(shingle, len(words))
    count = len(words) - width + 1
    mixed = np.full(count, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ digests[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, a row per set, all of them non-empty."""
    factor, shift = _multipliers()
    out = np.full((len(sets), len(factor)), 0xFFFFFFFF, np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= STEP):
            total += len(sets[last])
            last += 1
        group = np.concatenate(sets[first:last])
        values = (group ^ (group >> np.uint64(32))).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in sets[first : last - 1]])
        for k in range(len(factor)):
            out[first:last, k] = np.minimum.reduceat(values * factor[k] + shift[k], starts)
        first = last
    return out


def buckets(signed: np.ndarray) -> np.ndarray:
    """A 64-bit bucket per band."""
    bands = signed.reshape(len(signed), BANDS, ROWS).astype(np.uint64)
    mixed = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for k in range(ROWS):
        mixed = (mixed ^ bands[:, :, k]) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
    return mixed.view(np.int64)


def needed_matches(percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """After so many compared values, the least matches with which a pair goes on.

    With a uniform prior, the similarity after m matches of n follows Beta(m+1, n-m+1),
    and it reaches t with the probability that Binomial(n+1, t) is at most m.
    """
    t = percent / 100
    steps = []
    for n in range(BATCH, ROWS * BANDS + 1, BATCH):
        chance = 0.0
        for m in range(n + 1):
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= miss:
                break
        steps.append((n, m))
    return steps


def alike(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct digests."""
    if len(left) > len(right):
        left, right = right, left
    if 100 * len(left) < percent * len(right):
        return False
    at = np.searchsorted(right, left)
    at[at == len(right)] = 0
    common = int((right[at] == left).sum())
    return 100 * common >= percent * (len(left) + len(right) - common)


def merged(
    sets: list[np.ndarray], signed: np.ndarray, roots: np.ndarray, side: np.ndarray, percent: int, miss: float
) -> np.ndarray:
    """The component of each member of a cell after all verified links.

    ``roots`` names the component each member is in so far; the smaller name stays. Where
    sides differ, only pairs across are compared; with one side, all pairs.
    """
    steps = needed_matches(percent, miss)
    roots = roots.copy()
    one_side = (side == side[0]).all()
    against = np.arange(len(sets)) if one_side else np.flatnonzero(side == 0)
    for x in range(len(sets)) if one_side else np.flatnonzero(side != 0):
        others = against[:x] if one_side else against
        others = others[roots[others] != roots[x]]
        matches, done = np.zeros(len(others), np.int64), 0
        for n, least in steps:
            matches = matches + (signed[others, done:n] == signed[x, done:n]).sum(1)
            go_on = matches >= least
            others, matches, done = others[go_on], matches[go_on], n
        for y in others[np.argsort(-matches, kind="stable")]:
            if roots[y] != roots[x] and alike(sets[x], sets[y], percent):
                roots[np.isin(roots, (roots[x], roots[y]))] = min(roots[x], roots[y])
    return roots


def signed(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Stored rows (doc_id, n_shingles, set_id, buckets) of the documents with an id."""

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            sets = [shingle_set(text, shingle) for text in batch["text"]]
            full = [s for s in sets if len(s)]
            bands = iter(buckets(signatures(full))) if full else iter(())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_shingles": [len(s) for s in sets],
                    "set_id": [xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "buckets": [next(bands) if len(s) else None for s in sets],
                }
            )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_shingles long, set_id binary, buckets array<long>"
    return stored(texts.filter("doc_id IS NOT NULL").mapInPandas(reduce, schema), "neardup-signed")


def candidate_groups(classes: DataFrame) -> DataFrame:
    """Stored rows (node, group, members) of all ids that share a bucket with another."""
    members = classes.select(F.explode("buckets").alias("bucket"), "node")
    shared = members.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b")
    stars = members.join(shared.select("bucket", "a").hint("merge"), "bucket").filter("node <> a")
    grouped = components(stars.select("a", F.col("node").alias("b")))
    sizes = grouped.groupBy("root").agg(F.count("*").alias("members"))
    return stored(
        grouped.join(sizes, "root").select("node", F.col("root").alias("group"), "members"), "neardup-groups"
    )


def with_sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """The nodes' rows with sets and signatures, made from the documents' texts."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(text, shingle) for text in batch.pop("text")]
            there = [k for k, s in enumerate(sets) if len(s)]
            if there:
                kept = [sets[k] for k in there]
                yield batch.iloc[there].assign(
                    sig=[row.tobytes() for row in signatures(kept)], shingles=[s.tobytes() for s in kept]
                )

    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    schema = "node long, group long, members long, sig binary, shingles binary"
    # Merged at any size: a broadcast that small tables allow would not last.
    return texts.join(nodes.hint("merge"), "node").select("node", "group", "members", "text").mapInPandas(make, schema)


def cell_components(cells: DataFrame, keys: list[str], percent: int, miss: float) -> DataFrame:
    """Rows (group, members, node, root, merged) of the members that a cell moves to a
    smaller component, from rows (keys, group, members, node, root, side, sig, shingles)."""

    def verify(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("node", kind="stable")
        sets = [np.frombuffer(s, np.uint64) for s in cell["shingles"]]
        sigs = np.frombuffer(b"".join(cell["sig"]), np.uint32).reshape(len(cell), -1)
        roots = cell["root"].to_numpy()
        found = merged(sets, sigs, roots, cell["side"].to_numpy(), percent, miss)
        moved = cell[["group", "members", "node", "root"]].assign(merged=found)[found != roots]
        return moved.drop_duplicates("node")  # rows that repeat an id have one component

    return cells.groupBy(*keys).applyInPandas(verify, "group long, members long, node long, root long, merged long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    miss: float = MISS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = signed(docs, id_col, text_col, shingle)
    # Equal sets have equal buckets; which copy they are taken from makes no difference.
    classes = stored(
        rows.filter("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("node"), F.first("buckets").alias("buckets")),
        "neardup-classes",
    )
    groups = candidate_groups(classes)
    members = stored(with_sets(docs, groups, id_col, text_col, shingle), "neardup-sets")
    cells = F.ceil(F.col("members") / CELL).cast("long")
    cut = F.explode(F.when(cells > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("cut")
    first = members.select("*", cut, F.col("node").alias("root"), F.lit(0).alias("side"))
    first = first.withColumn("cell", F.pmod(F.xxhash64("node", "cut"), cells))
    moved = stored(cell_components(first, ["group", "cut", "cell"], percent, miss), "neardup-moved")
    found = moved.filter(F.col("members") <= CELL).select("node", F.col("merged").alias("root"))
    large = groups.filter(F.col("members") > CELL)
    if not large.isEmpty():
        found = found.union(_across(members, large, moved.filter(F.col("members") > CELL), percent, miss))
    whole = classes.select("set_id", "node").join(found, "node", "left")
    whole = whole.select("set_id", F.coalesce("root", "node").alias("component"))
    docs_out = (
        rows.select("doc_id", "n_shingles", "set_id")
        .join(whole, "set_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(shingle_set(text, shingle)) for text in texts], dtype="int64")

    nameless = docs.filter(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias("doc_id"),
        count(F.col(text_col)).alias("n_shingles"),
        F.lit(None).cast("long").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    return docs_out.union(nameless)


def _across(members: DataFrame, large: DataFrame, moved: DataFrame, percent: int, miss: float) -> DataFrame:
    """Rows (node, root) of the groups that have more than one cell.

    A component that holds the better part of a cell is cut by itself and fills its cells
    alone, so that no two of these are compared; the rest shares cells.
    """
    found = components(moved.select(F.col("node").alias("a"), F.col("merged").alias("b")))
    named = large.join(found, "node", "left").select(
        "node", "group", "members", F.coalesce("root", "node").alias("root")
    )
    sizes = named.groupBy("group", "root").agg(F.count("*").alias("size"))
    alone = F.col("size") * 2 >= CELL
    pools = named.join(sizes, ["group", "root"]).withColumn("pool", F.when(alone, F.col("root")).otherwise(F.lit(-1)))
    pooled = pools.groupBy("group", "pool").agg(F.count("*").alias("pooled"))
    cells = F.ceil(F.col("pooled") / CELL).cast("long")
    placed = pools.join(pooled, ["group", "pool"]).withColumn("cell", F.pmod(F.xxhash64("node"), cells))
    placed = stored(placed.select("node", "group", "root", "pool", "cell"), "neardup-placed")
    spans = placed.groupBy("group", "pool", "cell").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    left, right = (
        spans.select("group", *(F.col(c).alias(f"{c}_{k}") for c in ("pool", "cell", "low", "high"))) for k in (1, 2)
    )
    ordered = F.struct("pool_1", "cell_1") <= F.struct("pool_2", "cell_2")
    differ = F.least("low_1", "low_2") != F.greatest("high_1", "high_2")
    pairs = left.join(right, "group").filter(ordered & differ)
    pairs = stored(
        pairs.select("group", "pool_1", "cell_1", "pool_2", "cell_2").withColumn("pair", F.monotonically_increasing_id()),
        "neardup-cell-pairs",
    )
    same = (F.col("pool_1") == F.col("pool_2")) & (F.col("cell_1") == F.col("cell_2"))
    first = pairs.select("group", F.col("pool_1").alias("pool"), F.col("cell_1").alias("cell"), "pair", F.lit(0).alias("side"))
    wanted = first.union(pairs.filter(~same).select("group", "pool_2", "cell_2", "pair", F.lit(1)))
    sets = members.filter(F.col("members") > CELL).select("node", "members", "sig", "shingles")
    cells = placed.join(wanted, ["group", "pool", "cell"]).join(sets, "node")
    again = stored(cell_components(cells, ["pair"], percent, miss), "neardup-moved")
    joined = components(again.select(F.col("root").alias("a"), F.col("merged").alias("b")).distinct())
    joined = joined.select(F.col("node").alias("root"), F.col("root").alias("last"))
    return placed.join(joined, "root", "left").select("node", F.coalesce("last", "root").alias("root"))


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One document of each component, columns as given.

    Where the kept id has several rows, that of the smallest text stays, nulls first; documents
    without id all do.
    """
    kept = near_duplicates(docs, id_col, text_col, shingle, percent).filter("kept AND doc_id IS NOT NULL")
    ids = stored(kept.groupBy("doc_id").agg(F.count("*").alias("n")), "neardup-kept")
    same = lambda some: docs[id_col].cast("long") == some["doc_id"]
    once, often = ids.filter("n = 1"), ids.filter("n > 1")
    found = docs.join(once.hint("merge"), same(once), "left_semi")
    if not often.isEmpty():
        rest = [F.col(c) for c in docs.columns if c != text_col]
        rows = docs.join(often, same(often), "left_semi").groupBy(id_col).agg(F.min(F.struct(text_col, *rest)).alias("row"))
        found = found.union(rows.select("row.*").select(*docs.columns))
    return found.union(docs.filter(F.col(id_col).isNull()))
