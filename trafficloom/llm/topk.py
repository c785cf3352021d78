"""Exact top-k by inner product over an index of distances to pivots.

The largest inner product becomes the smallest distance when every vector x gets one more
component, sqrt(M - |x|^2) for the largest squared length M, and every query a zero: the
squared distance is then |q|^2 + M - 2 q.x.

1. Pivots come from a bounded sample, by a few rounds of k-means. Every vector is keyed by
   its nearest pivot and the distance to it.
2. The keyed vectors are sorted by pivot and distance across the cluster and cut into rings:
   blocks of at most ``RING`` neighbours in that order.
3. A query starts in the ring that holds its own vector, whose k best scores bound its
   search radius.
4. A ring is visited only if the triangle inequality leaves it within the radius: the query
   is no nearer to a vector at distance d from a pivot than its own distance to the pivot
   differs from d. A task has some rings and a block of queries; it expands every query's
   rings from the nearest outwards, narrows the radius as scores come in, and stops at the
   first ring beyond it. The tasks' k best per query are merged.

Components are integers, floor(scale * x), and scores are summed in integers, so results
are exact: distances only decide what need not be looked at, with a slack for rounding.

Defined cases: vectors that are null or hold a null or non-finite component take no part.
Vectors of different lengths are scored over the components that both have, as if the
shorter one went on with zeros; an empty one scores 0. A vector whose squared length reaches
2^62 is an error that names it: below that, no score or sum on the way leaves 64 bits. Ties go to the smaller id. Rows that repeat an id are
rows of their own, as queries and as candidates; a query leaves out only its own row. Rows
without an id are not taken as queries or candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trafficloom.llm.common import stored

SCALE = 256
PIVOTS = 32
#: Vectors the pivots are fitted on; the index holds all of them.
SAMPLE = 4096
#: Vectors in a ring, rings in a task, and queries in a task.
RING = 256
RINGS = 64
QUERIES = 1024
#: Distances are taken as equal within this share, and within this share of the longest vector:
#: they are roots of differences, which lose half of a double's digits.
SLACK, LOST = 1e-9, 1e-7
#: Squared lengths, and so all scores, stay below.
MOST = 1 << 62


def quantised(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """Stored rows (row, id, vector, length) of the vectors that take part."""
    scaled = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    fine = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = rows.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
    about = F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x)
    too_long = F.raise_error(F.concat(F.lit("scores of this vector may not fit 64 bits: id "), F.col("id").cast("string")))
    kept = valid.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), scaled.alias("scaled"))
    whole = F.transform("scaled", lambda x: x.cast("long"))
    checked = F.when(about >= F.lit(float(MOST)), too_long.cast("array<bigint>")).otherwise(whole)
    kept = stored(kept.select("row", "id", checked.alias("vector")), "topk-vectors")
    width = max(1, kept.agg(F.max(F.size("vector"))).first()[0] or 0)
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector"))
    squared = F.aggregate("vector", F.lit(0).cast("long"), lambda total, x: total + x * x)
    return kept.select("row", "id", F.concat("vector", zeros).alias("vector"), squared.alias("length"))


def extended(vectors: np.ndarray, lengths: np.ndarray, most: float) -> np.ndarray:
    return np.column_stack([vectors, np.sqrt(np.maximum(most - lengths, 0.0))]).astype(float)


def fit_pivots(vectors: DataFrame, most: float, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Centres of a bounded sample, the rows with the smallest digests."""
    cut = vectors.select(F.xxhash64("row").alias("draw")).orderBy("draw").limit(sample).agg(F.max("draw")).first()[0]
    rows = vectors.filter(F.xxhash64("row") <= cut).select("vector", "length").collect()
    points = extended(np.array([r["vector"] for r in rows]), np.array([r["length"] for r in rows]), most)
    centres = np.unique(points, axis=0)
    centres = centres[np.random.default_rng(7).permutation(len(centres))[:pivots]]
    for _ in range(8):
        nearest = distances(points, centres).argmin(1)
        centres = np.array([points[nearest == k].mean(0) if (nearest == k).any() else c for k, c in enumerate(centres)])
    return centres


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    squares = (left**2).sum(1)[:, None] + (right**2).sum(1)[None, :] - 2 * left @ right.T
    return np.sqrt(np.maximum(squares, 0.0))


def keyed(vectors: DataFrame, centres: np.ndarray, most: float) -> DataFrame:
    """The vectors with their nearest pivot and the distance to it."""

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = extended(np.array(batch["vector"].tolist()), batch["length"].to_numpy(), most)
            far = distances(points, centres)
            pivot = far.argmin(1)
            packed = [np.asarray(v, np.int64).tobytes() for v in batch["vector"]]
            yield pd.DataFrame(
                {
                    "row": batch["row"],
                    "id": batch["id"],
                    "vector": packed,
                    "pivot": pivot.astype(np.int32),
                    "distance": far[np.arange(len(pivot)), pivot],
                }
            )

    return vectors.mapInPandas(nearest, "row long, id long, vector binary, pivot int, distance double")


def best(ids: np.ndarray, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id and then the smaller row."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= floor)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((rows[some], ids[some], -scores[some]))[:k]]


def rings(index: DataFrame, every: int, k: int) -> DataFrame:
    """Stored rings of the sorted index: (pivot, near, far, ids, rows, vectors), and per
    ring its queries (ids divisible by ``every``) with their k-th score so far."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            for pivot, group in held.groupby("pivot", sort=False):
                last = pivot == held["pivot"].iloc[-1]
                while len(group) >= RING or (len(group) and not last):
                    yield ring(group.iloc[:RING])
                    group = group.iloc[RING:]
            held = group if len(group) else None
        if held is not None:
            yield ring(held)

    def ring(group: pd.DataFrame) -> pd.DataFrame:
        matrix = np.stack([np.frombuffer(v, np.int64) for v in group["vector"]])
        ids, rows = group["id"].to_numpy(), group["row"].to_numpy()
        asked = np.flatnonzero(ids % every == 0)
        bounds = []
        for at in asked:
            scores = np.delete(matrix @ matrix[at], at)
            bounds.append(np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else np.iinfo(np.int64).min)
        return pd.DataFrame(
            {
                "pivot": [int(group["pivot"].iloc[0])],
                "near": [group["distance"].min()],
                "far": [group["distance"].max()],
                "ids": [ids.tobytes()],
                "rows": [rows.tobytes()],
                "vectors": [matrix.tobytes()],
                "asked": [asked.astype(np.int64).tobytes()],
                "bounds": [np.array(bounds, np.int64).tobytes()],
            }
        )

    # The row as the last key spreads equal vectors, however many there are.
    ordered = index.repartitionByRange("pivot", "distance", "row").sortWithinPartitions("pivot", "distance", "row")
    schema = "pivot int, near double, far double, ids binary, rows binary, vectors binary, asked binary, bounds binary"
    cut_up = ordered.mapInPandas(cut, schema)
    return stored(cut_up, "topk-rings")


def top_k(rows: DataFrame, id_col: str, vector_col: str, every: int, k: int, scale: int = SCALE) -> DataFrame:
    """For each row whose id is divisible by ``every``, the k rows of the highest inner
    product: query_id, rank, vec_id, score."""
    vectors = quantised(rows, id_col, vector_col, scale)
    most = vectors.agg(F.max("length")).first()[0]
    schema = "query_id long, rank int, vec_id long, score long"
    if most is None:
        return rows.sparkSession.createDataFrame([], schema)
    most = float(most)
    centres = fit_pivots(vectors, most)
    index = rings(keyed(vectors, centres, most), every, k)
    # Runs of rings go to a task together; their pivots and distances tell who visits them.
    runs = index.withColumn("run", F.expr(f"monotonically_increasing_id() DIV {RINGS}"))
    runs = stored(runs.select("run", "pivot", "near", "far", "ids", "rows", "vectors"), "topk-runs")
    spans = runs.groupBy("run", "pivot").agg(F.min("near").alias("near"), F.max("far").alias("far"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, row_ids, matrix, asked, bounds in batch.itertuples(index=False):
                at = np.frombuffer(asked, np.int64)
                if not len(at):
                    continue
                ids, row_ids = np.frombuffer(ids, np.int64), np.frombuffer(row_ids, np.int64)
                matrix = np.frombuffer(matrix, np.int64).reshape(len(ids), -1)[at]
                points = np.column_stack([matrix, np.zeros(len(at))]).astype(float)
                yield pd.DataFrame(
                    {
                        "query": row_ids[at],
                        "query_id": ids[at],
                        "vector": [v.tobytes() for v in matrix],
                        "to_pivots": list(distances(points, centres)),
                        "bound": np.frombuffer(bounds, np.int64),
                    }
                )

    queries = index.select("ids", "rows", "vectors", "asked", "bounds").mapInPandas(
        ask, "query long, query_id long, vector binary, to_pivots array<double>, bound long"
    )
    queries = stored(queries.withColumn("radius", _radius(F.col("vector"), F.col("bound"), most)), "topk-queries")
    blocks = max(1, -(-queries.count() // QUERIES))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    visits = stored(_visits(queries, spans, most), "topk-visits")
    asked = queries.select("query", "query_id", "vector", "radius").join(visits, "query")
    # Every run of rings once for each block of queries that has visitors among them.
    pairs = visits.select(F.col("run").alias("of_run"), F.col("block").alias("of_block")).distinct()
    visited = pairs.join(runs, F.col("of_run") == F.col("run")).drop("run")
    found = (
        asked.groupBy("run", "block")
        .cogroup(visited.groupBy("of_run", "of_block"))
        .applyInPandas(_visit(centres, most, k), "query long, query_id long, vec_id long, row long, score long")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _radius(vector: Column, bound: Column, most: float) -> Column:
    """The distance that belongs to a score, the largest double for none."""

    @F.pandas_udf("double")
    def radius(vectors: pd.Series, bounds: pd.Series) -> pd.Series:
        squares = np.array([int((np.frombuffer(v, np.int64) ** 2).sum()) for v in vectors], float)
        score = bounds.to_numpy().astype(float)
        far = np.sqrt(np.maximum(squares + most - 2 * score, 0.0))
        return pd.Series(np.where(bounds.to_numpy() == np.iinfo(np.int64).min, np.finfo(float).max, far))

    return radius(vector, bound)


def _visits(queries: DataFrame, spans: DataFrame, most: float) -> DataFrame:
    """One row (run, query, block) for each run of rings that a query's radius reaches.

    The spans list the distances of each run's vectors to their pivot. A query meets the
    spans of a pivot with its own distance to it, and the triangle inequality filters them.
    """
    asked = queries.select("query", "radius", "block", F.posexplode("to_pivots").alias("at", "away"))
    reach = F.col("radius") * (1 + SLACK) + LOST * most**0.5
    gap = F.greatest(F.col("away") - F.col("far"), F.col("near") - F.col("away"))
    near = asked.join(spans, F.col("at") == F.col("pivot")).filter(gap <= reach)
    return near.select("run", "query", "block").distinct()


def _visit(centres: np.ndarray, most: float, k: int):
    def visit(queries: pd.DataFrame, visited: pd.DataFrame) -> pd.DataFrame:
        out = []
        parts = []
        for ring in visited.itertuples(index=False):
            ids = np.frombuffer(ring.ids, np.int64)
            matrix = np.frombuffer(ring.vectors, np.int64).reshape(len(ids), -1)
            parts.append((ring.pivot, ring.near, ring.far, ids, np.frombuffer(ring.rows, np.int64), matrix))
        for q in queries.itertuples(index=False):
            vector = np.frombuffer(q.vector, np.int64)
            point = np.append(vector, 0).astype(float)[None, :]
            away = distances(point, centres)[0]
            gaps = [max(away[p] - far, near - away[p], 0.0) for p, near, far, *_ in parts]
            square, radius = float((vector**2).sum()), q.radius
            ids, rows, scores = (np.zeros(0, np.int64) for _ in range(3))
            for at in np.argsort(gaps, kind="stable"):
                if gaps[at] > radius * (1 + SLACK) + LOST * most**0.5:
                    break
                _, _, _, ring_ids, ring_rows, matrix = parts[at]
                others = ring_rows != q.query
                ids = np.append(ids, ring_ids[others])
                rows = np.append(rows, ring_rows[others])
                scores = np.append(scores, (matrix @ vector)[others])
                top = best(ids, rows, scores, k)
                ids, rows, scores = ids[top], rows[top], scores[top]
                if len(scores) == k:
                    radius = min(radius, float(np.sqrt(max(square + most - 2 * scores[-1], 0.0))))
            out.append(pd.DataFrame({"query": q.query, "query_id": q.query_id, "vec_id": ids, "row": rows, "score": scores}))
        names = ["query", "query_id", "vec_id", "row", "score"]
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=names, dtype="int64")

    return visit
