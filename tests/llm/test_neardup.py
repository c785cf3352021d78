"""Near duplicates and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.fixtures import changed, clashing, empty, odd_documents, prose, rows
from trafficloom.llm import neardup
from trafficloom.llm.graph import components
from trafficloom.llm.queries import QUERIES


def plain_components(docs, shingle, percent):
    """(doc_id, n_shingles, component) per row, by comparing all pairs."""
    sets, parent = [], {}
    for doc_id, text in docs:
        w = tuple((text or "").encode().lower().split())
        width = min(shingle, len(w))
        sets.append({w[k : k + width] for k in range(len(w) - width + 1)} if w else set())
        parent[doc_id] = doc_id

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, _) in enumerate(docs):
        for j in range(k):
            b, both = docs[j][0], len(sets[k] & sets[j])
            if None not in (a, b) and sets[k] and 100 * both >= percent * (len(sets[k]) + len(sets[j]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted(repr((d, len(s), None if d is None else root(d))) for (d, _), s in zip(docs, sets))


def found_components(frame):
    return sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"])) for r in frame.collect())


@pytest.mark.parametrize("shingle", [2, 5])
def test_odd_documents(spark, shingle):
    docs = clashing(odd_documents(spark))
    found = neardup.near_duplicates(docs, shingle=shingle)
    assert found_components(found) == plain_components([(r["doc_id"], r["text"]) for r in docs.collect()], shingle, 80)
    for r in found.collect():
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert neardup.near_duplicates(empty(docs), shingle=shingle).count() == 0


def test_query_equals_brute_force(spark):
    found = QUERIES["op10_bayesian_near_duplicates"](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert found_components(found) == plain_components([tuple(r) for r in docs], 2, 80)


def test_groups_larger_than_a_cell(spark, monkeypatch):
    """Copies with growing changes, linked in chains and in a dense middle, over many cells."""
    monkeypatch.setattr(neardup, "CELL", 16)
    draw = random.Random(5)
    docs = [(k, changed(prose(9, 120), k, draw.randrange(1, 14))) for k in range(150)]
    chain = prose(8, 100)
    for k in range(150, 190):
        chain = changed(chain, k, 2)
        docs.append((k, chain))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found_components(neardup.near_duplicates(frame, shingle=2)) == plain_components(docs, 2, 80)


def test_deduplicated_keeps_one_of_each_component(spark):
    docs = clashing(odd_documents(spark))
    kept = neardup.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    expected = {r["component_id"] for r in neardup.near_duplicates(docs).collect() if r["component_id"] is not None}
    assert {i for i in ids if i is not None} == expected
    assert len([i for i in ids if i is not None]) == len(expected)
    assert ids.count(None) == 2


def test_components_of_a_long_path_and_a_star(spark):
    path = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1001, 1400).select(F.lit(1000).cast("long").alias("a"), F.col("id").alias("b"))
    loops = spark.range(5, 7).select(F.col("id").alias("a"), F.col("id").alias("b"))
    found = dict(rows(components(path.union(star).union(path).union(loops))))
    assert found == {k: 0 for k in range(301)} | {k: 1000 for k in range(1000, 1400)}
    assert components(path.limit(0)).count() == 0


def test_hubs_and_chains_of_hubs(spark):
    edges = [(1000 * h, 1000 * h + k) for h in range(1, 6) for k in range(1, 90)] + [(1000 * h, 1000 * h + 1000) for h in range(1, 5)]
    edges += [(9000 + k, 9100) for k in range(60)] + [(7, 7), (8, 9), (9, 8)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(3)
    found = {r["node"]: r["root"] for r in components(frame).collect()}
    first = {n for e in edges[: 5 * 89 + 4] for n in e}
    assert {n: r for n, r in found.items() if n in first} == dict.fromkeys(first, 1000)
    assert {r for n, r in found.items() if n >= 9000} == {9000} and (found[8], found[9]) == (8, 8)
    assert components(frame.limit(0)).count() == 0


def test_posterior_bound_matches_its_definition():
    """P(similarity >= t | m of n) below the miss probability just under the bound, by integration."""
    grid = np.linspace(0, 1, 200_001)
    for n, least in neardup.needed_matches(80, 1e-6):
        for m, passes in ((least, True), (least - 1, False)):
            with np.errstate(divide="ignore"):
                density = np.exp(m * np.log(grid) + (n - m) * np.log1p(-grid) - m * np.log(m / n) - (n - m) * np.log1p(-m / n))
            density = np.nan_to_num(density)
            assert (density[grid >= 0.8].sum() / density.sum() >= 1e-6) == passes


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(4)
    values = np.unique(draw.integers(0, 2**63, 3000, np.uint64))
    left, right = values[:2000], values[500:2500]
    signed = neardup.signatures([left, right])
    assert (signed[0] == signed[1]).mean() == pytest.approx(1500 / 2500, abs=0.12)
