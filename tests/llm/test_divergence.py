"""Source divergence against a plain version, and the shared trees against plain sums."""

import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.compare import connect, differences
from tests.conftest import SF_SMALL
from tests.llm.fixtures import DOCUMENTS, clashing, empty, odd_documents
from trafficloom.llm import divergence
from trafficloom.llm.queries import ORACLES, QUERIES

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def plain(docs, top=200):
    groups, found = defaultdict(Counter), defaultdict(Counter)
    for row in docs.collect():
        lang, source, text = (row[k] or "" for k in ("lang", "source", "text"))
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups[lang, source].update(terms)
        found[lang].update(set(terms))
    out = []
    for (lang, source), counts in groups.items():
        kept = [t for t, n in found[lang].items() if n >= 3]
        own = {s: c for (l, s), c in groups.items() if l == lang}
        total = sum(own.values(), Counter())

        def chance(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept))

        def worth(p, q):
            return (p - q) ** 2 // q

        pairs = [(s, sum(worth(chance(counts, t), chance(c, t)) for t in kept)) for s, c in own.items() if s != source]
        terms = [(t, worth(chance(counts, t), chance(total, t))) for t in kept if counts[t] and chance(counts, t) > chance(total, t)]
        for part, rows in (("pair", pairs), ("term", terms)):
            ranked = sorted(rows, key=lambda r: (-r[1], r[0].encode()))
            out += [(lang, source, part, item, v, k) for k, (item, v) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(out)


def got(frame):
    return sorted(tuple(row) for row in frame.select(*COLUMNS).collect())


def talk(spark):
    rows = [
        (1, "The cat and the dog, THE bird", "en", "a", 1),
        (2, "the cat; the cat", "en", "a", 1),
        (3, "the dog-bird über Über", "en", "b", 1),
        (3, "the dog-bird über Über", "en", "b", 1),  # repeated rows are documents of their own
        (4, "the 3 cats\tand dogs x\x00y", "en", None, 1),
        (5, "only here", "de", "a", 1),
        (6, "nichts gleich", "de", "b", None),
        (7, None, "fr", "a", None),
        (8, "", "fr", None, 0),
        (9, "and the dog and the cat", "en", "", 1),
        (10, "the the the", None, "a", 1),
        (11, "the the", None, "a", 1),
        (12, "the", None, "b", 1),
        (None, "and so and cat", "en", "c", 1),
        (13, "12 34 ...", "en", "d", 1),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def test_equals_a_plain_version(spark):
    expected = plain(talk(spark))
    assert {r[2] for r in expected} == {"pair", "term"}
    assert got(divergence.audit(talk(spark))) == expected


def test_odd_documents(spark):
    docs = odd_documents(spark)
    assert got(divergence.audit(clashing(docs))) == plain(docs)
    assert got(divergence.audit(docs, top=2)) == plain(docs, top=2)


def test_small_steps_change_nothing(spark, monkeypatch):
    docs = odd_documents(spark)
    expected = plain(docs)
    for name, size in {"ENTRIES": 30, "CELLS": 1 << 8, "WALKED": 1 << 8, "KEPT": 50, "LEAVES": 64}.items():
        monkeypatch.setattr(divergence, name, size)
    assert got(divergence.audit(docs.repartition(5))) == expected


def test_empty_tables(spark):
    docs = talk(spark)
    assert got(divergence.audit(empty(docs))) == []
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    found = got(divergence.audit(blank))
    assert found == plain(blank) and {r[4] for r in found} == {0}


@settings(max_examples=40, deadline=None)
@given(st.integers(2, 5), st.integers(1, 90), st.integers(0, 3), st.integers(0, 2**32))
def test_prices_equal_plain_sums(rows, terms, most, seed):
    draw = np.random.default_rng(seed)
    counts = draw.integers(0, most + 1, (rows, terms))
    whole = counts.sum(1) + terms
    there, back = divergence.pair_prices(counts, whole)
    p = divergence.scaled(counts, whole[:, None])
    for k, (i, j) in enumerate(zip(*np.triu_indices(rows, 1))):
        assert there[k] == sum((int(a) - int(b)) ** 2 // int(b) for a, b in zip(p[i], p[j]))
        assert back[k] == sum((int(a) - int(b)) ** 2 // int(b) for a, b in zip(p[j], p[i]))


def test_equal_subtrees_are_one_node_and_priced_once():
    counts = np.tile(np.array([[1, 2, 0, 0], [1, 2, 3, 0]]), 256)
    forest = divergence.Forest(counts)
    # four counts; three pairs of them; two fours; then one node per level and group
    assert len(forest.counts) == 4 and forest.nodes() == 4 + 3 + 2 + 2 * 8
    table = divergence.scaled(np.broadcast_to(forest.counts, (2, 4)), counts.sum(1)[:, None] + 1024)
    there, _, walked = forest.prices(table, np.array([0]), np.array([1]))
    assert walked == 4  # (1,1), (2,2), (0,3), (0,0) of 1024 places
    assert there[0] == divergence.worth(divergence.scaled(counts[0], 768 + 1024), divergence.scaled(counts[1], 1536 + 1024)).sum()


def test_scaled_is_exact_beyond_64_bits():
    for count, whole in [(0, 1), (10**12, 10**12 + 1), (8 * 10**15, 9 * 10**15), (9 * 10**15 - 1, 9 * 10**15)]:
        assert divergence.scaled(np.array([count]), np.array([whole]))[0] == 1 + 10**9 * (count + 1) // whole


def test_query_equals_sql(spark):
    con = connect(SF_SMALL)
    assert differences(QUERIES["op12_source_divergence"](spark, SF_SMALL), con, ORACLES["op12_source_divergence"]) == []
