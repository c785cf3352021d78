"""Exact search against brute force; the lookup table against its definition."""

from collections import Counter
from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import empty, rows
from trafficloom.llm import sharding, topk


def plain_top(vectors, every, k):
    """(query_id, rank, vec_id, score) by comparing every query row with every other row."""
    kept = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in vectors]
    out = []
    for a, (i, v) in enumerate(kept):
        if i % every == 0:
            scores = sorted((-int(v @ w), j, b) for b, (j, w) in enumerate(kept) if b != a)[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j, _) in enumerate(scores)]
    return sorted(out)


def frame_of(spark, vectors):
    return spark.createDataFrame(vectors, "vec_id long, embedding array<float>")


@pytest.mark.parametrize("seed,count,groups", [(1, 900, 1), (2, 1500, 12), (3, 3, 1), (4, 1, 1)])
def test_top_k_equals_brute_force(spark, monkeypatch, seed, count, groups):
    monkeypatch.setattr(topk, "QUERIES", 16)
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, 12))
    vectors = [(k, (centres[k % groups] + 0.1 * draw.normal(size=12)).astype(np.float32).tolist()) for k in range(count)]
    vectors += [(5000 + 10 * k, vectors[0][1]) for k in range(count // 3)]  # a third of all are equal
    found = topk.top_k(frame_of(spark, vectors).repartition(5), "vec_id", "embedding", every=50, k=5)
    assert rows(found) == plain_top(vectors, 50, 5)


def test_odd_vectors_take_no_part(spark):
    good = [(k, [float(k % 7), 1.0 - k % 5, 0.25 * (k % 3)]) for k in range(0, 120)] + [(50, [1.0, 2.0, 3.0]), (50, [1.0, 2.0, 3.0])]
    nan, inf = float("nan"), float("inf")
    odd = [(200, None), (250, [nan, 0.0, 0.0]), (300, [1.0, None, 0.0]), (350, [inf, 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    frame = frame_of(spark, good + odd).selectExpr("*", "1 AS row", "2 AS id", "3 AS score", "'x' AS pivot")
    found = topk.top_k(frame, "vec_id", "embedding", every=50, k=5)
    assert rows(found) == plain_top(good, 50, 5)
    nothing = topk.top_k(empty(frame), "vec_id", "embedding", every=50, k=5)
    assert nothing.columns == found.columns and nothing.count() == 0


def test_vectors_of_other_lengths_go_on_with_zeros(spark):
    vectors = [(k, [float(k % 7), 1.0 - k % 5, 0.25 * (k % 3)]) for k in range(120)]
    odd = [(400, []), (450, [1.0]), (500, [3.0, 1.0]), (550, [0.5, 0.5, 0.5, 9.0]), (551, [0.0, 0.0, 0.0, -2.0, 4.0])]
    found = topk.top_k(frame_of(spark, vectors + odd), "vec_id", "embedding", every=50, k=5)
    assert rows(found) == plain_top([(i, v + [0.0] * (5 - len(v))) for i, v in vectors + odd], 50, 5)
    only = topk.top_k(frame_of(spark, [(0, []), (1, [])]), "vec_id", "embedding", every=50, k=5)
    assert rows(only) == [(0, 1, 1, 0)]


def test_large_components(spark):
    """Up to the bound all scores are exact; beyond it the vector is named."""
    large = [(k, [1e6 * (k % 5 + 1), -3e5 * (k % 3)]) for k in range(60)]
    found = topk.top_k(frame_of(spark, large), "vec_id", "embedding", every=50, k=5)
    assert rows(found) == plain_top([(i, np.float32(v).tolist()) for i, v in large], 50, 5)
    for beyond in (1e10, 3e38):
        with pytest.raises(Exception, match="may not fit 64 bits: id 77"):
            topk.top_k(frame_of(spark, [*large, (77, [beyond, 0.0])]), "vec_id", "embedding", every=50, k=5).collect()


def plain_table(weights, slots):
    """Turn by turn, with a plain search for the next free slot."""
    table, nth = [None] * slots, dict.fromkeys(weights, 0)
    while None in table:
        for name, weight in weights.items():
            digest = md5(name.encode()).digest()
            start, step = int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1
            for _ in range(weight):
                while nth[name] < slots and table[(start + nth[name] * step) % slots] is not None:
                    nth[name] += 1
                if nth[name] < slots:
                    table[(start + nth[name] * step) % slots] = name
    return table


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 3, "b": 1, "c": 2}])
def test_table_equals_its_definition(weights):
    names = list(weights)
    assert [names[k] for k in sharding.filled_table(weights, 101)] == plain_table(weights, 101)


def test_shares_follow_weights():
    weights = {f"s{k}": 1 + k % 3 for k in range(40)}
    found = Counter(sharding.filled_table(weights).tolist())
    for k, weight in enumerate(weights.values()):
        assert found[k] == pytest.approx(sharding.SLOTS * weight / sum(weights.values()), rel=0.03)


@pytest.mark.parametrize("shards,slots", [([], 101), (["a", "a"], 101), ({"a": 0}, 101), (["a"], 100), ({"a": 102}, 101)])
def test_impossible_tables_are_errors(shards, slots):
    with pytest.raises(ValueError):
        sharding.filled_table(shards, slots)


def keys(spark):
    return spark.range(2000).select(
        F.when(F.col("id") % 100 == 7, None).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("key"),
        F.lit("x").alias("slot"),
        F.lit("y").alias("shard"),
        "id",
    )


def test_rows_are_placed_by_their_key(spark):
    names = [f"s{k}" for k in range(9)]
    table = plain_table(dict.fromkeys(names, 1), 211)
    for r in sharding.placed(keys(spark), "key", names, 211).collect():
        digest = md5((sharding.NULL_KEY if r["key"] is None else r["key"]).encode()).hexdigest()
        assert r["slot"] == int(digest[:15], 16) % 211
        assert r["shard"] == table[r["slot"]]
    assert sharding.placed(empty(keys(spark)), "key", names, 211).count() == 0


def test_a_removed_shard_moves_little_else(spark):
    names = [f"s{k}" for k in range(20)]
    moves = sharding.moved(keys(spark), "key", names, names[:-1]).collect()
    placed = sharding.placed(keys(spark), "key", names).groupBy("shard").count().collect()
    lost = next(r["count"] for r in placed if r["shard"] == "s19")
    assert sum(r["shard"] == "s19" for r in moves) == lost
    assert len(moves) <= lost + 0.05 * 2000


def test_a_hot_shard_is_spread_over_files(spark, tmp_path):
    rows_ = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), "id")
    names = ["a", "b", "c", "d"]
    sharding.write_shards(rows_, "key", names, f"file://{tmp_path}/shards", files=4)
    back = spark.read.parquet(f"file://{tmp_path}/shards")
    assert back.count() == 3000
    expected = sharding.placed(rows_, "key", names).groupBy("shard").count()
    assert rows(back.groupBy("shard").count()) == rows(expected)
    hot = sharding.placed(rows_.filter("key = 'hot'"), "key", names).first()["shard"]
    assert len(list((tmp_path / "shards" / f"shard={hot}").glob("*.parquet"))) > 1


def test_query_writes_whole_documents_to_their_shards(spark):
    from tests.conftest import SF_SMALL
    from trafficloom.llm.common import table
    from trafficloom.llm.queries import QUERIES, SHARDS

    docs = table(spark, SF_SMALL, "documents")
    found = QUERIES["op1_table_sharding"](spark, SF_SMALL).collect()
    expected = sharding.placed(docs.selectExpr("doc_id", "source", "octet_length(text) AS n"), "doc_id", SHARDS).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r["doc_id"], r["slot"], r["shard"], r["source"], r["text_bytes"]) for r in found), key=key) == sorted(
        ((r["doc_id"], r["slot"], r["shard"], r["source"], r["n"]) for r in expected), key=key
    )
