"""Packing documents into sequences by patterns of few lengths.

1. ``pieces`` counts tokens and cuts only what is longer than a sequence.
2. The lengths' histogram, at most one row per possible length, goes to the driver.
   ``pack_histogram`` enumerates every way to fill a sequence with two or three lengths
   that occur, fits repeat counts to the histogram by non-negative least squares, rounds
   down, and packs what is left best-fit, longest first, with equal bins handled
   together. Its work depends on the sequence length, not on the number of documents.
3. The plan says which ranks of each length go to which sequences. A piece's rank is the
   number of pieces of its length in earlier partitions plus those before it in its own,
   so no length is gathered anywhere, however common it is.

Defined cases: a null or empty text is its end token alone, one piece of length 1. Rows
that repeat an id are packed as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trafficloom.llm.common import stored

SEQUENCE = 2048
#: Ranks of one length stay below two to this power.
RANK_BITS = 44
TOKENIZER = "byte_bpe_50k.json"

PIECES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]

#: How the vocabulary's pre-tokenizer splits a text.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beyond these characters the two libraries' Unicode tables might differ.
LATIN = re.compile("[\x00-\u024f]*")
#: The faster library's pattern matcher runs out of stack on longer runs of blanks.
BLANKS = re.compile(r"\s+")
LONGEST_RUN = 100_000

_workers: dict[str, "TextTokenizer"] = {}


class TextTokenizer:
    """Ids of texts as unsigned 32-bit bytes, from a byte-level vocabulary file.

    Latin texts go through ``tiktoken`` with the file's vocabulary, which gives the same
    ids six times as fast; all others, and texts with a run of more than ``LONGEST_RUN``
    blanks or line ends, go through ``tokenizers``, loaded when one comes.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        file = json.loads(Path(path).read_text())
        special = {token["content"] for token in file["added_tokens"]}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        vocabulary = file["model"]["vocab"].items()
        ranks = {bytes(byte[c] for c in token): rank for token, rank in vocabulary if token not in special}
        self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def exact(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    @classmethod
    def of_worker(cls, path: str) -> "TextTokenizer":
        if path not in _workers:
            _workers[path] = cls(path)
        return _workers[path]

    @staticmethod
    def _long_run(text: str) -> bool:
        if len(text) <= LONGEST_RUN:
            return False
        return any(run.end() - run.start() > LONGEST_RUN for run in BLANKS.finditer(text))

    def encode(self, text: str) -> bytes:
        if LATIN.fullmatch(text) and not self._long_run(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.exact.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, tokenizer: str | None = None) -> DataFrame:
    """One row per piece, with its partition and its place among those of its length there.

    The result is stored: ranks count on rows that stay as they are.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = TextTokenizer.of_worker(tokenizer)
        part = TaskContext.get().partitionId()
        seen = [0] * (sequence + 1)
        end = b"\0\0\0\0"
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                ids = encoder.encode(text) + end if isinstance(text, str) else end
                tokens = len(ids) // 4
                start, length, piece = 0, tokens % sequence or sequence, 0
                while start < tokens:
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, piece, start, length, crc, part, seen[length]))
                    seen[length] += 1
                    start, length, piece = start + length, sequence, piece + 1
            yield pd.DataFrame(rows, columns=PIECES)

    # The id travels as text: pandas would turn a column of longs with a null into floats.
    texts = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return stored(texts.mapInPandas(cut, schema).withColumn("doc_id", F.col("doc_id").cast("long")), "pack-pieces")


@dataclass(frozen=True)
class Plan:
    """For each run of ranks of one length: the first rank, the first sequence and the
    place in it. The n-th rank of a run goes to the n-th sequence from its first."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def patterns_of(lengths: np.ndarray, sequence: int) -> np.ndarray:
    """All triples (a, b, c) of the given lengths, a >= b >= c, that add up to the
    sequence; c is 0 for a pair."""
    there = np.zeros(sequence + 1, bool)
    there[lengths] = True
    there[0] = True
    found = []
    for a in lengths[lengths < sequence]:
        rest = sequence - a
        b = np.arange((rest + 1) // 2, min(a, rest) + 1)
        b = b[there[b] & there[rest - b]]
        b = b[b > 0]
        found.append(np.column_stack([np.full(len(b), a), b, rest - b]))
    return np.concatenate(found).astype(np.int64) if found else np.zeros((0, 3), np.int64)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, steps: int = 250) -> np.ndarray:
    """Non-negative repeats whose lengths come nearest to the counts, in least squares.

    Accelerated projected gradient steps. The matrix has a column per pattern with at
    most three entries, so a product is three gathers and its transpose three counts.
    Rows are scaled by the length, since a long piece left over costs more room.
    """
    if not len(patterns):
        return np.zeros(0)
    size = len(counts)
    scale = np.sqrt(np.arange(size, dtype=float))
    scale[0] = 0.0

    def forward(x: np.ndarray) -> np.ndarray:
        return scale * sum(np.bincount(patterns[:, k], x, size) for k in range(3))

    def backward(r: np.ndarray) -> np.ndarray:
        r = scale * r
        return r[patterns[:, 0]] + r[patterns[:, 1]] + r[patterns[:, 2]]

    probe = np.ones(len(patterns))
    for _ in range(12):
        probe /= np.linalg.norm(probe)
        image = backward(forward(probe))
        bound, probe = np.linalg.norm(image), image
    target = scale * counts
    x = ahead = np.zeros(len(patterns))
    pace = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, ahead - backward(forward(ahead) - target) / (1.05 * bound))
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / next_pace * (new - x)
        x, pace = new, next_pace
    return x


def round_repeats(patterns: np.ndarray, fitted: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeats within what is left of each length, largest fits first; takes
    them from ``left``. A second turn rounds the fractions where pieces are left for it."""
    used = []
    whole = np.floor(fitted)
    for share in (whole, np.round(fitted - whole)):
        for k in np.argsort(-share, kind="stable"):
            want = int(share[k])
            if want < 1:
                break
            parts = tuple(int(v) for v in patterns[k] if v)
            room = min(int(left[v]) // parts.count(v) for v in set(parts))
            if (repeat := min(want, room)) > 0:
                for v in parts:
                    left[v] -= repeat
                used.append((parts, repeat))
    return used


def best_fit(left: np.ndarray, sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit, longest first, on counts: equal bins are filled together, and a bin
    takes as many pieces of a length as fit."""
    open_bins: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(sequence + 1)]
    filled = np.zeros(sequence + 1, np.int64)  # bins with that much room

    def put(parts: tuple[int, ...], bins: int, room: int) -> None:
        if bins:
            open_bins[room].append((parts, bins))
            filled[room] += bins

    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            rooms = np.flatnonzero(filled[length:])
            room = length + int(rooms[0]) if len(rooms) else sequence
            parts, bins = open_bins[room].pop() if len(rooms) else ((), count)
            if len(rooms):
                filled[room] -= bins
            each = room // length
            full = min(bins, count // each)
            put(parts + (length,) * each, full, room - each * length)
            count -= full * each
            rest = 0
            if count and full < bins:
                rest = 1
                put(parts + (length,) * count, 1, room - count * length)
                count = 0
            if len(rooms):
                put(parts, bins - full - rest, room)
    return [entry for bins in open_bins for entry in bins]


def pack_histogram(counts: np.ndarray, sequence: int = SEQUENCE) -> Plan:
    """The plan for so many pieces of each length; ``counts`` has sequence + 1 places."""
    left = counts.astype(np.int64).copy()
    chosen = [((sequence,), int(left[sequence]))] if left[sequence] else []
    left[sequence] = 0
    patterns = patterns_of(np.flatnonzero(left), sequence)
    chosen += round_repeats(patterns, fit_repeats(patterns, left), left)
    chosen += best_fit(left, sequence)
    next_rank = [0] * (sequence + 1)
    rows = []
    first = 0
    for parts, repeat in chosen:
        offset = 0
        for length in parts:
            rows.append((length, next_rank[length], first, offset))
            next_rank[length] += repeat
            offset += length
        first += repeat
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], first)


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = pieces(docs, id_col, text_col, sequence, tokenizer)
    per_part = stored(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "pack-counts")
    histogram = per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `sequence` rows
    counts = np.zeros(sequence + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["n"]
    plan = pack_histogram(counts, sequence)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select(
        F.col("length").alias("of_length"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    keys = (plan.length << RANK_BITS) + plan.rank

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        ranks = rank.to_numpy()
        run = np.searchsorted(keys, (length.to_numpy() << RANK_BITS) + ranks, side="right") - 1
        return pd.DataFrame({"sequence_id": plan.sequence[run] + ranks - plan.rank[run], "offset": plan.offset[run]})

    ranked = cut.join(before, (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part")))
    return ranked.withColumn("place", place("length", F.col("before") + F.col("nth"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"
    )
