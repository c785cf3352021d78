"""Target mix and rule ledger against plain versions."""

import re
from collections import Counter, defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, differences
from tests.conftest import SF_SMALL
from tests.llm.fixtures import clashing, empty, odd_documents, rows
from trafficloom.llm import mixing, quality
from trafficloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    con = connect(SF_SMALL)
    assert differences(QUERIES[name](spark, SF_SMALL), con, ORACLES[name]) == []


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2):
    """Shares by weight; what exceeds a source's room is shared out again until none does."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: unit * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix_of_odd_documents(spark):
    docs = odd_documents(spark)
    sizes = mixing.sized(docs).cache()
    plain = defaultdict(int)
    for _, text, _, source, _ in docs.collect():
        plain[source] += len(words(text))
    targets = {r["source"]: r["target"] for r in mixing.source_rates(sizes).collect()}
    assert targets == pytest.approx(plain_targets(plain))
    copied = mixing.with_copies(sizes, mixing.source_rates(sizes))
    again = mixing.with_copies(sizes.repartition(7), mixing.source_rates(sizes.repartition(3)))
    assert rows(copied, "doc_id", "source", "copies") == rows(again, "doc_id", "source", "copies")
    assert copied.filter("copies > 2 OR copies < 0 OR copies IS NULL").isEmpty()
    assert copied.count() == docs.count()


def test_each_source_comes_near_its_target(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('w ', 1 + id % 50)").alias("text"),
        # One source holds a third of the rows.
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 7) END").alias("source"),
    )
    sizes = mixing.sized(docs)
    taken = mixing.with_copies(sizes, mixing.source_rates(sizes)).groupBy("mix.source", "mix.target").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken")
    )
    for row in taken.collect():
        assert row["taken"] == pytest.approx(row["target"], rel=0.02)


def test_coin_is_a_digest(spark):
    found = spark.range(3).select("id", mixing.coin(F.col("id"), 6).alias("c")).collect()
    for row in found:
        digits = md5(f"{row['id']}:1".encode()).hexdigest()[16:24]
        assert row["c"] == int(digits, 16) / 2**32


def test_mixed_repeats_whole_documents(spark):
    docs = clashing(odd_documents(spark))
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    sizes = mixing.sized(docs)
    expected = Counter()
    for r in mixing.with_copies(sizes, mixing.source_rates(sizes)).collect():
        expected[r["doc_id"], r["source"], r["size"]] += r["copies"]
    found = Counter((r["doc_id"], r["source"], len(words(r["text"]))) for r in mix.collect())
    assert found == +expected
    assert mixing.mixed(empty(docs)).count() == 0


def plain_measures(text):
    text = text or ""
    w = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    starts = defaultdict(list)
    for k in range(len(w) - 7):
        starts[tuple(w[k : k + 8])].append(k)
    covered = {k + j for found in starts.values() if len(found) > 1 for k in found for j in range(8)}
    return (
        len(w),
        sum(map(len, w)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures_of_odd_documents(spark):
    docs = clashing(odd_documents(spark))
    found = sorted(map(repr, rows(quality.ledger(docs), "doc_id", *quality.MEASURES)))
    assert found == sorted(repr((r["doc_id"], *plain_measures(r["text"]))) for r in docs.collect())
    assert quality.ledger(empty(docs)).count() == 0


def test_kept_keeps_columns_and_follows_the_policy(spark):
    docs = clashing(odd_documents(spark))
    for policy in quality.POLICIES:
        kept = quality.kept(docs, policy)
        assert kept.columns == docs.columns
        ledger = quality.ledger(docs).filter(quality.passes(policy))
        assert rows(kept, "doc_id") == rows(ledger, "doc_id")
    assert {r["doc_id"] for r in quality.kept(docs).collect()}.isdisjoint({3, 4, 5, 7, 12, 13})


def test_ablations_count_what_a_rule_alone_rejects(spark):
    ledger = quality.ledger(odd_documents(spark))
    bits = [r["failures"] for r in ledger.collect()]
    for row in quality.ablations(ledger).collect():
        policy = next(p for p in quality.POLICIES if p.version == row["policy"])
        failing = [b & policy.mask for b in bits]
        bit = quality.BIT[row["rule"]]
        assert row["docs"] == len(bits)
        assert row["kept"] == failing.count(0)
        assert row["failing"] == sum(b & bit > 0 for b in failing)
        assert row["freed"] == failing.count(bit)


def test_ledger_runs_without_python(spark):
    plan = quality.kept(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
