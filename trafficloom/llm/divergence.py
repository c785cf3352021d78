"""How the sources of a language differ in their words, by shared segment trees.

1. Tasks count terms per group (language, source), with the documents they occur in, and
   the sums are dealt to blocks of terms by digest. A block keeps the terms found in
   ``DOCUMENTS`` documents of the language or more, commonest first, and is stored as one
   row: its terms, and its groups' counts in sparse form.
2. In a block, every group is a segment tree over the term ids. ``Forest`` makes the trees
   of all groups at once and hash-conses them: a node is a pair of nodes below it, equal
   pairs are one node, so identical stretches of counts are shared within and between
   groups. Rare terms, most of a vocabulary, are next to each other and share most.
3. ``Forest.prices`` walks the trees of two groups together, level by level, for many pairs
   of groups at once. A pair of nodes that occurs again for the same groups is found once
   and priced once; the prices of the pairs above are sums of those below.
4. The blocks' prices per pair of groups are added up, and the blocks' best terms per group
   ranked.

A term's probability in a group is in billionths, p = 1 + floor(10^9 (count + 1) / (N + V)),
N being the group's kept occurrences and V the language's kept terms. A term of
probabilities p and q is worth floor((p - q)^2 / q). All numbers are integers: fractions are
taken in three steps of a thousand, and as the p of a group add up to at most 10^9 + V, sums
of prices stay below (10^9 + V)^2, which 64 bits hold for any V up to two billion.

A block holds a slice of the vocabulary that shrinks with ``spark.sql.shuffle.partitions``,
and of each term one count per source, summed before the block is gathered, so a source or
word of any weight is one count. Trees are cut to ``CELLS`` counts at once. The result has a
row per pair of sources of a language, and so has the work; sources are taken to be few
enough for that, and a language's list of them fits a task.

Defined cases: null texts, languages and sources are empty ones. A group without kept terms
takes part with N = 0; in a language without any, all prices are 0. Repeated rows count
each, also as documents. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trafficloom.llm.common import stored

DOCUMENTS = 3
TOP = 200
BILLION = 1_000_000_000

#: Terms a task counts before it hands them on.
ENTRIES = 400_000
#: Counts in the trees made at once, node pairs walked at once, and prices kept per task.
CELLS = 1 << 22
WALKED = 1 << 21
KEPT = 1 << 21
LEAVES = 1 << 12

NOTHING = -1  # the count of a place beyond the last term


def _folding() -> bytes:
    """Letters, A-Z lowered, and all bytes beyond ASCII as they are; a blank for the rest."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for lower in range(ord("a"), ord("z") + 1):
        table[lower] = table[lower - 32] = lower
    return bytes(table)


_FOLDING = _folding()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLDING).split()


def scaled(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / whole), exact for whole up to 9 * 10^15."""
    rest, out = counts + 1, np.zeros(np.broadcast(counts, whole).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def worth(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Forest:
    """Hash-consed segment trees, one per row of a matrix of counts."""

    def __init__(self, counts: np.ndarray):
        rows, terms = counts.shape
        leaves = 1 << max(0, terms - 1).bit_length()
        padded = np.full((rows, leaves), NOTHING, np.int64)
        padded[:, :terms] = counts
        #: Distinct counts, which are the nodes of the lowest level.
        self.counts, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(padded.shape)
        #: Left and right nodes of each node, per level above.
        self.below: list[tuple[np.ndarray, np.ndarray]] = []
        size = len(self.counts)
        while nodes.shape[1] > 1:
            pairs, above = np.unique(nodes[:, 0::2] * size + nodes[:, 1::2], return_inverse=True)
            self.below.append((pairs // size, pairs % size))
            nodes, size = above.reshape(rows, -1), len(pairs)
        self.roots, self.top = nodes[:, 0], size

    def nodes(self) -> int:
        return len(self.counts) + sum(len(left) for left, _ in self.below)

    def prices(self, table: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each pair of rows, the prices summed over all terms, both ways, and the number of
        priced pairs of counts. ``table`` has a row's probability for each distinct count."""
        pair, a, b = np.arange(len(first)), self.roots[first], self.roots[second]
        steps = []
        sizes = [len(self.counts)] + [len(left) for left, _ in self.below]
        for (left, right), size in zip(reversed(self.below), reversed(sizes[:-1])):
            codes = np.concatenate([(pair * size + left[a]) * size + left[b], (pair * size + right[a]) * size + right[b]])
            found, place = np.unique(codes, return_inverse=True)
            steps.append(place)
            b, rest = found % size, found // size
            a, pair = rest % size, rest // size
        p, q = table[first[pair], a], table[second[pair], b]
        there, back = worth(p, q), worth(q, p)
        for place in reversed(steps):
            half = len(place) // 2
            there, back = there[place[:half]] + there[place[half:]], back[place[:half]] + back[place[half:]]
        return there, back, len(pair)


def pair_prices(counts: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prices of all pairs of rows (i < j, in the order of ``np.triu_indices``), both ways.

    ``counts`` has a row per group and a column per term, ``whole`` each group's N + V.
    """
    first, second = np.triu_indices(len(counts), 1)
    there, back = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    run = max(64, min(LEAVES, 1 << (CELLS // max(1, len(counts))).bit_length() - 1))
    for start in range(0, counts.shape[1], run):
        forest = Forest(counts[:, start : start + run])
        table = np.ones((len(counts), len(forest.counts)), np.int64)
        real = forest.counts != NOTHING
        table[:, real] = scaled(forest.counts[real], whole[:, None])
        step = max(1, WALKED // run)
        for at in range(0, len(first), step):
            x, y, _ = forest.prices(table, first[at : at + step], second[at : at + step])
            there[at : at + step] += x
            back[at : at + step] += y
    return there, back


def _counted(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """Partial counts (lang, source, term, n, docs), each task's."""

    def rows(groups: dict) -> Iterator[pd.DataFrame]:
        for (lang, source), (counts, found) in groups.items():
            terms = list(counts)
            if terms:
                yield pd.DataFrame(
                    {"lang": lang, "source": source, "term": terms, "n": list(counts.values()), "docs": [found[t] for t in terms]}
                )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups = defaultdict(lambda: (Counter(), Counter()))
        for batch in batches:
            for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
                counts, found = groups[lang, source]
                terms = terms_of(text)
                counts.update(terms)
                found.update(set(terms))
            if sum(len(counts) for counts, _ in groups.values()) > ENTRIES:
                yield from rows(groups)
                groups.clear()
        yield from rows(groups)

    texts = docs.select(*_group(lang_col, source_col), F.col(text_col).cast("binary").alias("text"))
    return texts.filter("octet_length(text) > 0").mapInPandas(count, "lang string, source string, term binary, n long, docs long")


def _group(lang_col: str, source_col: str) -> list[Column]:
    named = {"lang": lang_col, "source": source_col}
    return [F.coalesce(F.col(old).cast("string"), F.lit("")).alias(new) for new, old in named.items()]


BLOCK = "lang string, sources array<string>, terms array<binary>, source array<int>, term array<int>, n array<long>, sums array<long>"


def blocks(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", documents: int = DOCUMENTS
) -> DataFrame:
    """The kept terms in blocks, one row each: ``terms``, commonest first, the ``sources``
    with any of them and their ``sums``, and the counts ``n`` by ``source`` and ``term`` place."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _counted(docs, lang_col, source_col, text_col).withColumn("block", F.pmod(F.xxhash64("term"), F.lit(parts)))
    keys = ["lang", "block"]
    summed = dealt.repartition(parts, *keys).groupBy(*keys, "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        term, names = pd.factorize(rows["term"])
        n, total = rows["n"].to_numpy(), np.zeros(len(names), np.int64)
        docs = total.copy()
        np.add.at(total, term, n)
        np.add.at(docs, term, rows["docs"].to_numpy())
        kept = sorted(np.flatnonzero(docs >= documents).tolist(), key=lambda t: (-total[t], names[t]))
        if not kept:
            return pd.DataFrame(columns=[c.split()[0] for c in BLOCK.split(", ")])
        place = np.full(len(names), -1)
        place[kept] = np.arange(len(kept))
        inside = place[term] >= 0
        source, sources = pd.factorize(rows["source"][inside], sort=True)
        sums = np.zeros(len(sources), np.int64)
        np.add.at(sums, source, n[inside])
        return pd.DataFrame(
            {
                "lang": [key[0]],
                "sources": [list(sources)],
                "terms": [[names[t] for t in kept]],
                "source": [source.astype(np.int32)],
                "term": [place[term][inside].astype(np.int32)],
                "n": [n[inside]],
                "sums": [sums],
            }
        )

    return stored(summed.groupBy(*keys).applyInPandas(pack, BLOCK), "divergence-blocks")


def group_totals(docs: DataFrame, packed: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Every occurring group with its N and its language's V, stored."""
    groups = docs.select(*_group(lang_col, source_col)).distinct()
    pairs = F.explode(F.arrays_zip("sources", "sums")).alias("pair")
    counted = packed.select("lang", pairs).groupBy("lang", F.col("pair.sources").alias("source")).agg(F.sum("pair.sums").alias("n"))
    sizes = packed.groupBy("lang").agg(F.sum(F.size("terms")).alias("v"))
    whole = groups.join(counted, ["lang", "source"], "left").join(sizes, "lang", "left")
    return stored(whole.fillna(0, ["n", "v"]).select("lang", "source", "n", "v"), "divergence-groups")


def best_terms(found: dict[str, list], top: int) -> list[np.ndarray]:
    """Of arrays of group, value and term, the rows that rank up to ``top`` in their group."""
    group, value, term = (np.concatenate(found[k]) for k in ("group", "value", "term"))
    by_name = np.argsort(np.argsort(term, kind="stable"), kind="stable") if len(term) else np.zeros(0, int)
    order = np.lexsort((by_name, -value, group))
    starts = np.searchsorted(group[order], np.arange(group.max() + 1 if len(group) else 0))
    nth = np.arange(len(order)) - starts[group[order]]
    chosen = order[nth < top]
    return [group[chosen], value[chosen], term[chosen]]


def priced(packed: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value), stored: part ``pair`` for each pair of sources,
    to be added up, and part ``term`` with each source's terms that may rank up to ``top``."""
    listed = totals.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups"), F.max("v").alias("v"))
    own = listed.select("lang", "v", F.col("groups.source").alias("all_source"), F.col("groups.n").alias("all_n"))
    work = packed.join(own, "lang").drop("sums")

    def price(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs: dict[str, list] = {}
        terms: dict[str, dict[str, list]] = {}
        names: dict[str, np.ndarray] = {}

        def rows(lang: str, part: str, source: np.ndarray, item: np.ndarray | list, value: np.ndarray) -> Iterator[pd.DataFrame]:
            if len(value):
                yield pd.DataFrame({"lang": lang, "source": names[lang][source], "part": part, "item": item, "value": value})

        def flushed() -> Iterator[pd.DataFrame]:
            for lang, (there, back) in pairs.items():
                first, second = np.triu_indices(len(names[lang]), 1)
                own, other = np.concatenate([first, second]), np.concatenate([second, first])
                yield from rows(lang, "pair", own, names[lang][other], np.concatenate([there, back]))
            for lang, found in terms.items():
                group, value, term = best_terms(found, top)
                yield from rows(lang, "term", group, [t.decode() for t in term.tolist()], value)
            pairs.clear()
            terms.clear()

        for batch in batches:
            for row in batch.itertuples(index=False):
                sources = list(row.all_source)
                names[row.lang] = np.array(sources, object)
                whole = np.asarray(row.all_n, np.int64) + row.v
                place = {s: k for k, s in enumerate(sources)}
                group = np.array([place[s] for s in row.sources], np.int64)[np.asarray(row.source)]
                term, n = np.asarray(row.term, np.int64), np.asarray(row.n, np.int64)

                there, back = pairs.setdefault(row.lang, [np.zeros(len(sources) * (len(sources) - 1) // 2, np.int64) for _ in "ab"])
                run = max(LEAVES, CELLS // len(sources))
                of_term = np.argsort(term, kind="stable")
                edges = np.searchsorted(term[of_term], np.arange(0, len(row.terms) + run, run))
                for k in range(len(edges) - 1):
                    inside = of_term[edges[k] : edges[k + 1]]
                    counts = np.zeros((len(sources), min(run, len(row.terms) - k * run)), np.int64)
                    counts[group[inside], term[inside] - k * run] = n[inside]
                    x, y = pair_prices(counts, whole)
                    there += x
                    back += y

                total = np.zeros(len(row.terms), np.int64)
                np.add.at(total, term, n)
                p, q = scaled(n, whole[group]), scaled(total, np.int64(whole.sum() - (len(sources) - 1) * row.v))[term]
                more = p > q
                found = {"group": [group[more]], "value": [worth(p[more], q[more])], "term": [np.array(row.terms, object)[term[more]]]}
                kept = terms.setdefault(row.lang, {"group": [], "value": [], "term": []})
                for name, values in zip(kept, best_terms(found, top)):
                    kept[name].append(values)
                if sum(len(v) for own in terms.values() for v in own["term"]) + sum(len(a) for a, _ in pairs.values()) > KEPT:
                    yield from flushed()
        yield from flushed()

    return stored(work.mapInPandas(price, "lang string, source string, part string, item string, value long"), "divergence-prices")


def audit(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    documents: int = DOCUMENTS,
    top: int = TOP,
) -> DataFrame:
    """Per (language, source): part ``pair``, every other source of the language by how far
    this one's words are from that one's, and part ``term``, the ``top`` words that set it
    apart from the language as a whole. ``rank`` counts from 1, value descending."""
    packed = blocks(docs, lang_col, source_col, text_col, documents)
    totals = group_totals(docs, packed, lang_col, source_col)
    found = priced(packed, totals, top)
    summed = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    own, other = totals.select("lang", "source"), totals.select("lang", F.col("source").alias("item"))
    every = own.join(other, "lang").filter("source <> item").join(summed, ["lang", "source", "item"], "left")
    pair = every.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = found.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pair.withColumn("rank", F.row_number().over(order)).union(terms)
