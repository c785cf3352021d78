"""The whole pipeline against its stages in plain Python."""

from collections import defaultdict
from hashlib import md5

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_mixing_quality import plain_measures, plain_targets, words
from tests.llm.test_neardup import plain_components
from tests.llm.test_packing import plain_pieces
from trafficloom.llm import mixing


def good(text):
    n, chars, symbols, lines, repeated_lines, repeated = plain_measures(text)
    return not (
        n < 20
        or 100 * repeated > 30 * n
        or 10 * symbols > 3 * n
        or not 2 * n <= chars <= 20 * n
        or 2 * repeated_lines > lines
    )


def coin(doc_id, seed):
    return int(md5(f"{doc_id}:{seed // 4}".encode()).hexdigest()[8 * (seed % 4) :][:8], 16) / 2**32


def test_pipeline_equals_brute_force(spark):
    # Every document of the table is prose or junk of a labelled language; none is rejected for it.
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    texts = {r["doc_id"]: r["text"] for r in docs if good(r["text"])}
    source = {r["doc_id"]: r["source"] for r in docs}
    kept = [i for i, _, root in map(eval, plain_components(list(texts.items()), 5, 80)) if i == root]
    size = {i: len(words(texts[i])) for i in kept}
    totals = defaultdict(int)
    for i in kept:
        totals[source[i]] += size[i]
    copies = {}
    for name, target in plain_targets(totals).items():
        rate = target / totals[name]
        own = [i for i in kept if source[i] == name]
        tried = [{i: int(rate) + (coin(i, k) < rate % 1) for i in own} for k in range(mixing.SEEDS)]
        copies |= min(tried, key=lambda t: abs(sum(size[i] * n for i, n in t.items()) - target))
    expected = sorted((i, *piece) for i in kept for piece in plain_pieces(texts[i], 2048) for _ in range(copies[i]))
    found = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == expected
    filled = defaultdict(int)
    for r in found:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns, name
