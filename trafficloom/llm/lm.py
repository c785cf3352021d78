"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is a sequence of tokens: its words with A-Z lowered, then one end. A word is coded
as its bytes and a closing blank, the end as a line feed, each byte as eight binary
decisions. Every decision is predicted from several contexts: up to six bytes before it in
the token, and the whole token so far, each with the class of the text before the token. A
context and the bits of the byte so far hash to a slot with the numbers of zeros and ones
seen there. The slots' log odds are mixed by a weight set that a gate chooses from how often
the contexts were seen; an adaptive map then refines the mixed probability by the bits so far.

The class is the language that the tokens before speak for, by a small model of letter
triples, and ``none`` before the first. The bytes' contexts end at the token, so every distinct
pair of class and token is coded once, however often it occurs, and tokens that begin alike
share the steps of their beginning.

The token before is a context of the whole token: its predictor is how often the token followed
it in training. This is mixed with the probability of the coded bytes by a share that a gate
chooses from how often the token before was seen. The shares are those under which the training
texts are likeliest with each occurrence taken out of the followers it is predicted from.

1. ``blocks`` turns the documents into bags of pairs, numbered within blocks of texts, and
   each block's list of pairs with their training counts, split by the tokens' digests into
   a share for each bucket. There are as many buckets as shuffle partitions.
2. A bucket's shares make its part of the vocabulary: every pair with its training count.
3. ``count_slots`` adds the training counts of all pairs to the slots, per task, and
   sums the tasks' tables chunk by chunk.
4. ``fit_mixer`` goes once through all training pairs, in small batches and with each
   token's own occurrence taken out of its slots. Weight sets are learned online in each
   task and averaged by the weight they have seen; the map's sums are added.
5. Every pair gets its log probability, and every two tokens in a row their training count;
   buckets tell each block what is known of its own.
6. ``fit_shares`` finds the shares of the token before from sums over all training texts, and
   blocks add up each document.

Shares travel as packed arrays, a row per block and bucket, instead of a row per pair. A
frequent token meets once per block, so no token is hot. Two tokens in a row are known by 48 bits
of a digest; among three thousand million, two that never met are taken for others once in some
90,000 times. The table of slots has a fixed size,
``LINE_BITS``, about 72 MB; it lies compressed in the shared folder, where every worker reads it
once. The weights, the map and the class model travel with the tasks. The class model is fitted on a bounded
sample of each label's training documents; everything else is learned from all of them.

Defined cases: a null text is empty and consists of its end alone. Rows that repeat count
each. A null id is digested as an empty text. Without training documents all counts are 0.
Without a label column, or if only held-out documents are labelled, all text has one class.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficloom.llm.common import file_system, new_folder, stored
from trafficloom.llm.language import SAMPLE, TextModel, bucket, fit, has_label

#: Predictors: bytes of context, -1 for the whole token so far, and whether the class of
#: the text before the token is part of the context.
PREDICTORS = ((1, True), (2, True), (3, True), (4, True), (6, True), (-1, True))
#: Lines of sixteen slots of each predictor, as powers of two.
LINE_BITS = (12, 15, 16, 16, 17, 18)
LINE = 16
FIRST_LINE = np.concatenate([[0], np.cumsum(1 << np.array(LINE_BITS))]).astype(np.int64)
SLOTS = int(FIRST_LINE[-1]) * LINE
CHUNK = 1 << 16
#: Added to zeros and ones before odds are taken.
PRIOR = 0.05
#: Gate: sixteen classes of the last predictor's count by eight of the third's.
GATES = 128
#: Cells of the adaptive map along the mixed log odds, from -8 to 8.
CELLS = 33
#: Bytes of tokens learned from at once, and scored at once.
LEARN_BYTES = 1 << 14
SCORE_BYTES = 1 << 16
#: Step of the mixer, divided by the root of the gradient's squares so far.
RATE = 0.03
#: Text bytes in a block.
BLOCK_BYTES = 1 << 23
#: Packed bytes of tokens that are merged into a vocabulary, or looked up in it, at once.
MERGE_BYTES = 1 << 22
SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "3"}

#: Gates of the shares, by the whole logarithm of how often the token before was seen.
FOLLOW_GATES = 32
#: Cells of the followers' odds against the bytes' probability, in 32 steps an octave from
#: 2 ** -30; the first is for none. Odds are rounded down, so probabilities still sum to one at most.
ODDS_STEPS, ODDS_LEAST, ODDS_CELLS = 32, -30, 1 << 16

END = "\n"
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_STEP = 0x100000001B3
_STEP_BACK = pow(_STEP, -1, 1 << 64)


@dataclass
class Edges:
    """The distinct steps of a run of tokens: class, token so far, and next byte.

    Tokens that begin alike share steps, so each is predicted once.
    """

    byte: np.ndarray
    contexts: np.ndarray  # predictors x steps
    step: np.ndarray  # of each byte of the run
    starts: np.ndarray  # of each token in the run


def edges_of(classes: np.ndarray, tokens: list[str]) -> Edges:
    parts = [(t if t == END else t + " ").encode("utf-8", "surrogatepass") for t in tokens]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(parts), np.uint8)
    size = len(data)
    begin = np.repeat(starts, sizes)
    place = np.arange(size) - begin
    wide = data.astype(np.uint64) + np.uint64(1)
    of_class = np.repeat(classes.astype(np.uint64) + np.uint64(1), sizes)
    with np.errstate(over="ignore"):
        # Polynomial digests of all prefixes at once, from sums of bytes times powers.
        powers = np.full(size, _STEP_BACK, np.uint64).cumprod(dtype=np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(wide * powers, dtype=np.uint64)])
        raised = np.full(size, _STEP, np.uint64).cumprod(dtype=np.uint64)
        whole = (sums[:-1] - sums[begin]) * raised + place.astype(np.uint64)
        with_next = ((whole * _ODD[0]) ^ (of_class << np.uint64(9)) ^ wide) * _ODD[1]
    _, at, step = np.unique(with_next, return_index=True, return_inverse=True)
    wide_before = np.concatenate([np.zeros(8, np.uint64), wide])
    found = np.empty((len(PREDICTORS), len(at)), np.uint64)
    for k, (order, classed) in enumerate(PREDICTORS):
        context = np.zeros(len(at), np.uint64)
        if order < 0:
            context = whole[at]
        for back in range(1, order + 1):
            earlier = np.where(place[at] >= back, wide_before[at + 8 - back], np.uint64(0))
            context = context | (earlier << np.uint64(9 * (back - 1)))
        with np.errstate(over="ignore"):
            found[k] = (context + (of_class[at] if classed else np.uint64(0)) * _ODD[1]) * _ODD[0]
    return Edges(data[at], found, step, starts)


def decisions(edges: Edges):
    """For each of the eight bits: the bit, the bits so far, and the slots per predictor.

    The slots of four bits lie in one line, which the context and the bits before choose.
    """
    byte = edges.byte.astype(np.int64)
    for half in (1, 0):
        lines = []
        for k, bits in enumerate(LINE_BITS):
            with np.errstate(over="ignore"):
                mixed = edges.contexts[k] + ((byte >> 4) + 1).astype(np.uint64) * _ODD[1] if half == 0 else edges.contexts[k].copy()
                mixed ^= mixed >> np.uint64(29)
                mixed *= _ODD[0]
            lines.append((FIRST_LINE[k] + (mixed >> np.uint64(64 - bits)).astype(np.int64)) * LINE)
        four = (byte >> (4 * half)) & 15
        node = np.ones(len(byte), np.int64)
        for shift in range(3, -1, -1):
            bit = (four >> shift) & 1
            so_far = node if half else node + (((byte >> 4) + 1) << 4)
            yield bit, so_far, [line + node for line in lines]
            node = node * 2 + bit


#: Values of "the bits so far": sixteen for the first four, then sixteen for each of these.
NODES = 17 * 16


def runs(classes: np.ndarray, tokens: list[str], weights: np.ndarray, most: int):
    """Runs of about ``most`` bytes; one longer token is a run of its own."""
    first, size = 0, 0
    for k, token in enumerate(tokens):
        if size and size + len(token) >= most:
            yield classes[first:k], tokens[first:k], weights[first:k]
            first, size = k, 0
        size += len(token) + 1
    if first < len(tokens):
        yield classes[first:], tokens[first:], weights[first:]


def step_weights(edges: Edges, weights: np.ndarray) -> np.ndarray:
    """How often each step occurs, from how often each token does."""
    sizes = np.diff(np.append(edges.starts, len(edges.step)))
    return np.bincount(edges.step, np.repeat(weights, sizes), len(edges.byte))


@dataclass
class Mixer:
    weights: np.ndarray  # GATES x predictors and a bias
    squares: np.ndarray
    ones: np.ndarray  # NODES x CELLS, weight of ones seen
    seen: np.ndarray

    @classmethod
    def fresh(cls) -> "Mixer":
        weights = np.full((GATES, len(PREDICTORS) + 1), 0.2)
        weights[:, -1] = 0.0
        return cls(weights, np.full(weights.shape, 1e-3), np.zeros((NODES, CELLS)), np.zeros((NODES, CELLS)))


#: The predictors whose counts the gate looks at.
GATE_BY = (2, len(PREDICTORS) - 1)


def whole_log2(x: np.ndarray) -> np.ndarray:
    """The whole part of the base-two logarithm of float32 numbers of one and more."""
    return (x.view(np.int32) >> 23) - 127


def gate_of(near: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.minimum(whole, 15).astype(np.int64) * 8 + np.minimum(near >> 1, 7)


def learning_inputs(counts: np.ndarray, where: list[np.ndarray], own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of each predictor, with a bias, and the gate, with one occurrence of the
    bits in ``own`` taken out."""
    odds = np.ones((len(PREDICTORS) + 1, len(where[0])), np.float32)
    one = own.astype(np.float32)
    pairs = counts.view(np.uint64).reshape(-1)  # zeros and ones of a slot fetched as one number
    logs = {}
    for k, at in enumerate(where):
        pair = pairs.take(at).view(np.float32).reshape(-1, 2)
        zeros = np.maximum(pair[:, 0] - (1 - one), 0)
        ones = np.maximum(pair[:, 1] - one, 0)
        if k in GATE_BY:
            logs[k] = whole_log2(zeros + ones + np.float32(1))
        odds[k] = np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)))
    return odds, gate_of(*(logs[k] for k in GATE_BY))


def known_odds(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each slot's log odds and the whole logarithm of its count, for scoring."""
    odds, sizes = np.empty(len(counts), np.float32), np.empty(len(counts), np.uint8)
    for start in range(0, len(counts), 1 << 18):  # a piece at a time, as the table is large
        some = slice(start, start + (1 << 18))
        zeros, ones = counts[some, 0], counts[some, 1]
        odds[some] = np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)))
        sizes[some] = whole_log2(counts[some].sum(1) + np.float32(1))
    return odds, sizes


def scoring_inputs(known: tuple[np.ndarray, np.ndarray], where: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    odds = np.ones((len(PREDICTORS) + 1, len(where[0])), np.float32)
    for k, at in enumerate(where):
        odds[k] = known[0].take(at)
    return odds, gate_of(*(known[1].take(where[k]) for k in GATE_BY))


def squashed(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


def mix(mixer: Mixer, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
    chosen = mixer.weights.astype(np.float32)[gate]
    return np.einsum("nk,kn->n", chosen, odds)


def map_cells(mixed: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(mixed * 2) + CELLS // 2, 0, CELLS - 1).astype(np.int64)


def learn(mixer: Mixer, counts: np.ndarray, classes: np.ndarray, tokens: list[str], weights: np.ndarray, seen: np.ndarray) -> None:
    """One online pass: after each bit of a run, each gate's weights take a step along the
    mean gradient of what it saw. The map adds up what it would have been shown."""
    for run in runs(classes, tokens, weights, LEARN_BYTES):
        edges = edges_of(*run[:2])
        each = step_weights(edges, run[2])
        for bit, so_far, where in decisions(edges):
            odds, gate = learning_inputs(counts, where, bit)
            mixed = mix(mixer, odds, gate)
            error = (bit - squashed(mixed)) * each
            total = np.bincount(gate, each, GATES)
            for k in range(len(odds)):
                slope = np.bincount(gate, error * odds[k], GATES) / np.maximum(total, 1e-9)
                mixer.squares[:, k] += slope * slope
                mixer.weights[:, k] += RATE * slope / np.sqrt(mixer.squares[:, k])
            seen += total
            cell = so_far * CELLS + map_cells(mixed)
            mixer.seen += np.bincount(cell, each, NODES * CELLS).reshape(NODES, CELLS)
            mixer.ones += np.bincount(cell, each * bit, NODES * CELLS).reshape(NODES, CELLS)


def score(
    mixer: Mixer, known: tuple[np.ndarray, np.ndarray], classes: np.ndarray, tokens: list[str]
) -> np.ndarray:
    """log10 probability of each token after text of its class, from ``known_odds``."""
    middle = squashed((np.arange(CELLS) - CELLS // 2) / 2)
    refined = (mixer.ones + 4 * middle) / (mixer.seen + 4)
    refined_odds = np.log(refined / (1 - refined)).astype(np.float32)
    out = []
    for run in runs(classes, tokens, np.zeros(len(tokens)), SCORE_BYTES):
        edges = edges_of(*run[:2])
        logs = np.zeros(len(edges.byte))
        for bit, so_far, where in decisions(edges):
            odds, gate = scoring_inputs(known, where)
            mixed = mix(mixer, odds, gate)
            both = (mixed + refined_odds[so_far, map_cells(mixed)]) / 2
            chance = np.clip(squashed(both), 1e-6, 1 - 1e-6)
            logs += np.log10(np.where(bit == 1, chance, 1 - chance))
        out.append(np.add.reduceat(logs[edges.step], edges.starts))
    return np.concatenate(out) if out else np.zeros(0)


def add_counts(table: np.ndarray, classes: np.ndarray, tokens: list[str], weights: np.ndarray) -> None:
    """Adds the tokens' occurrences to zeros and ones, ``table`` having two per slot."""
    flat = table.reshape(-1)
    for run in runs(classes, tokens, weights, SCORE_BYTES):
        edges = edges_of(*run[:2])
        each = step_weights(edges, run[2]).astype(table.dtype)  # add.at is slow between kinds
        for bit, _, where in decisions(edges):
            for at in where:
                np.add.at(flat, at * 2 + bit, each)


def class_scores(model: TextModel, words: list[bytes]) -> np.ndarray:
    """Each word's log likelihood per class, from the triples of the word between blanks."""
    table = np.ascontiguousarray(model.table.T.astype(np.float32))
    parts = []
    for start in range(0, len(words), 1 << 14):
        some = words[start : start + (1 << 14)]
        data = np.frombuffer(b" " + b" ".join(some) + b"  ", np.uint8).astype(np.uint32)
        found = table[bucket((data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:])]
        sizes = np.fromiter(map(len, some), np.int64, len(some))
        first = np.cumsum(sizes + 1) - sizes - 1  # the blank before each word
        found[first + sizes] = 0.0  # from a word's last letter into the next word
        parts.append(np.add.reduceat(found, first))
    return np.concatenate(parts)


def class_path(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For the tokens at the given places and the end after them, the class of what comes
    before: 0 for nothing, else one more than the likeliest."""
    path = np.zeros(len(at) + 1, np.int64)
    total = np.zeros(scores.shape[1])
    for start in range(0, len(at), 1 << 16):
        sums = total + np.cumsum(scores[at[start : start + (1 << 16)]], axis=0)
        path[start + 1 : start + 1 + len(sums)] = sums.argmax(1) + 1
        total = sums[-1]
    return path


_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeezed(data: bytes) -> bytes:
    return _COMPRESSOR.compress(data)


def opened(data: bytes) -> bytes:
    return _DECOMPRESSOR.decompress(data)


def packed(values: np.ndarray) -> bytes:
    return squeezed(values.tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(opened(data), kind)


def packed_tokens(tokens: list[bytes]) -> bytes:
    return squeezed(b" ".join(tokens))


def unpacked_tokens(data: bytes) -> list[bytes]:
    """No token has a blank in it, and the end is one of its own."""
    return opened(data).split(b" ")


#: What separates words, as in ``bytes.split``, and what separates packed tokens.
SPACES, BLANKS = (np.isin(np.arange(256), list(some)) for some in (b" \t\n\r\x0b\x0c", b" "))


def cut(data: bytes, between: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The pieces between separating bytes, and where each begins."""
    inside = np.zeros(len(data) + 2, bool)
    values = np.frombuffer(data, np.uint8)
    np.logical_not(between[values], out=inside[1:-1])
    starts, ends = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2).T
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(values[inside[1:-1]])]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), starts


def byte_list(tokens: pa.Array) -> list[bytes]:
    return tokens.to_numpy(zero_copy_only=False).tolist()


def shares_tokens(packs: Iterable[bytes]) -> pa.Array:
    """The tokens of several packs, one after the other."""
    return cut(b" ".join(map(opened, packs)), BLANKS)[0]


def packed_planes(values: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then their second, and so on."""
    return squeezed(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def unpacked_planes(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(opened(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def token_digests(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def follower_digests(digests: np.ndarray, first: np.ndarray, end: np.uint64) -> np.ndarray:
    """48 bits for each token and the one before it; before a text's first stands the end."""
    before = np.concatenate([[end], digests[:-1]])
    before[first] = end
    with np.errstate(over="ignore"):
        mixed = (before * _ODD[0]) ^ (digests >> np.uint64(17)) ^ (digests * _ODD[1])
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD[0]
    return (mixed ^ (mixed >> np.uint64(29))) >> np.uint64(16)


def bucket_of_digest(digests: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the 48 bits."""
    return ((digests >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)


class Block:
    """Documents of about ``BLOCK_BYTES`` and the distinct (class, token) pairs in them."""

    def __init__(self) -> None:
        self.docs: list[tuple[str | None, bool, bytes]] = []
        self.size = 0

    def add(self, doc_id: str | None, text: str | None) -> None:
        data = text.encode("utf-8", "surrogatepass").lower() if isinstance(text, str) else b""
        self.docs.append((doc_id, zlib.crc32((doc_id or "").encode()) % 5 == 1, data))
        self.size += len(text) if data and not data.isspace() else 0

    def words(self) -> tuple[list[bytes], list[np.ndarray]]:
        """The distinct tokens, the end first, and each document's words as places among them."""
        sizes = np.array([len(data) + 1 for _, _, data in self.docs])
        met, starts = cut(b" ".join(data for _, _, data in self.docs), SPACES)
        met = met.dictionary_encode()
        at = met.indices.to_numpy() + np.int32(1)
        return [END.encode(), *byte_list(met.dictionary)], np.split(at, np.searchsorted(starts, np.cumsum(sizes)[:-1]))

    def rows(self, block: int, model: TextModel, buckets: int) -> pd.DataFrame:
        words, places_of = self.words()
        scores = class_scores(model, words)
        width = len(words)
        lengths = np.array([len(at) + 1 for at in places_of])
        first = np.cumsum(lengths) - lengths
        codes = np.concatenate([class_path(scores, at) * width + np.append(at, 0) for at in places_of])
        there = np.zeros((len(model.classes) + 1) * width, bool)
        there[codes] = True
        pairs = np.flatnonzero(there)
        places = (np.cumsum(there) - 1)[codes]
        learned = np.repeat([not held_out for _, held_out, _ in self.docs], lengths)
        training = np.bincount(places[learned], minlength=len(pairs))
        digests = token_digests(words)
        out = []
        for (doc_id, held_out, _), start, length in zip(self.docs, first, lengths):
            sequence = packed_planes(places[start : start + length].astype(np.uint32))
            out.append(("text", block, None, doc_id, held_out, length, sequence, None, None, None, None))
        # Two tokens in a row, in the order of their digests, which is also that of the buckets.
        # The lowest bit of what is sorted says whether the occurrence is learned from.
        marked = np.sort((follower_digests(digests[codes % width], first, digests[0]) << np.uint64(1)) | learned)
        both = marked >> np.uint64(1)
        starts = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        counted = (marked & np.uint64(1)).astype(np.uint32)
        follows, both = np.add.reduceat(counted, starts, dtype=np.uint32), both[starts]
        ends = np.searchsorted(bucket_of_digest(both, buckets), np.arange(buckets + 1))
        for number in np.flatnonzero(np.diff(ends)):
            some = slice(ends[number], ends[number + 1])
            steps = np.diff(both[some], prepend=np.uint64(0))
            out.append(("follows", block, int(number), None, None, None, None, packed_planes(follows[some]), None, None, packed_planes(steps)))
        of_token = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, width)
        token = pairs % width
        bucket_of = of_token[token]
        order = np.argsort(bucket_of, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(bucket_of[order])) + 1):
            tokens = packed_tokens([words[k] for k in token[some]])
            classes = packed((pairs[some] // width).astype(np.uint16))
            number = int(bucket_of[some[0]])
            out.append(("pairs", block, number, None, None, None, packed(some.astype(np.uint32)), packed(training[some]), classes, tokens, None))
        return pd.DataFrame(out, columns=NUMBERED)


NUMBERED = ["kind", "block", "bucket", "doc_id", "held_out", "n_tokens", "places", "times", "classes", "tokens", "digests"]


def blocks(docs: DataFrame, id_col: str, text_col: str, model: TextModel, buckets: int) -> tuple[DataFrame, str]:
    """Stored rows per document (their ``kind`` is text) and, with a ``bucket``, per share of a
    block's list (pairs) and of its two tokens in a row (follows), in a folder of each kind.

    A document's ``places`` are those of its tokens in its block's list of pairs, in the order
    of the text. A share's ``tokens``, ``classes`` and ``places`` are its pairs and where they
    stand in the list, ``times`` the occurrences in training documents. Two tokens in a row
    have ``digests`` instead, as steps from one to the next.
    """

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, nth, block = TaskContext.get().partitionId(), 0, Block()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                block.add(doc_id, text)
                if block.size >= BLOCK_BYTES:
                    yield block.rows((part << 32) + nth, model, buckets)
                    nth, block = nth + 1, Block()
        if block.docs:
            yield block.rows((part << 32) + nth, model, buckets)

    texts = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    schema = (
        "block long, bucket int, doc_id string, held_out boolean, n_tokens long, places binary, times binary, "
        "classes binary, tokens binary, digests binary"
    )
    path = f"{new_folder(docs.sparkSession, 'lm-blocks')}/rows"
    texts.mapInPandas(number, f"kind string, {schema}").write.partitionBy("kind").parquet(path)
    return docs.sparkSession.read.schema(f"{schema}, kind string").parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a stored folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def frugal(spark: SparkSession):
    """Within it, what a query shuffled is deleted when the query has ended. All that is used
    again here is stored, so its shuffles are not. The kinds of rows are written side by
    side instead of being sorted."""
    given = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in given.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def merged_pairs(merged: tuple | None, shares: list) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens in order, and the distinct pairs in order: their classes, tokens (as
    places) and the sums of their counts, from those merged before and more shares."""
    tokens = shares_tokens(s.tokens for s in shares)
    classes = np.concatenate([unpacked(s.classes, np.uint16) for s in shares]).astype(np.int64)
    times = np.concatenate([unpacked(s.times, np.int64) for s in shares])
    if merged:
        tokens = pa.concat_arrays([merged[0].take(pa.array(merged[2])), tokens])
        classes, times = np.concatenate([merged[1], classes]), np.concatenate([merged[3], times])
    tokens = tokens.dictionary_encode()
    order = pc.array_sort_indices(tokens.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    pairs, at = np.unique(classes * len(order) + rank[tokens.indices.to_numpy()], return_inverse=True)
    sums = np.bincount(at, times, len(pairs)).astype(np.int64)  # exact below 2 ** 53
    return tokens.dictionary.take(order), pairs // len(order), pairs % len(order), sums


def runs_of_shares(shares: pd.DataFrame) -> Iterator[list]:
    """Runs of rows whose ``tokens`` have about ``MERGE_BYTES``."""
    run, size = [], 0
    for share in shares.itertuples(index=False):
        run.append(share)
        size += len(share.tokens)
        if size >= MERGE_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


class Pairs:
    """Places of pairs in a vocabulary, given as classes and places among distinct tokens."""

    def __init__(self, tokens: pa.Array, classes: np.ndarray, which: np.ndarray) -> None:
        self.tokens = tokens
        keys = classes.astype(np.int64) * len(tokens) + which
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def places(self, shares: list) -> list[np.ndarray]:
        """Those of each share's pairs, which are all in the vocabulary."""
        which = pc.index_in(shares_tokens(s.tokens for s in shares), value_set=self.tokens).to_numpy()
        classes = [unpacked(s.classes, np.uint16) for s in shares]
        keys = np.concatenate(classes).astype(np.int64) * len(self.tokens) + which
        return np.split(self.order[np.searchsorted(self.keys, keys)], np.cumsum([len(c) for c in classes])[:-1])


def vocabulary_row(group: pd.DataFrame) -> pd.DataFrame:
    """The row of one bucket, from all shares that it gets."""
    merged, waiting, size = None, [], 0
    for shares in runs_of_shares(group):
        waiting += shares
        size += sum(len(s.tokens) for s in shares)
        if merged is None or size >= merged[0].nbytes:  # else what is merged would be gone through too often
            merged, waiting, size = merged_pairs(merged, waiting), [], 0
    tokens, classes, which, times = merged_pairs(merged, waiting) if waiting else merged
    totals = np.bincount(which, times, len(tokens)).astype(np.int64)
    return pd.DataFrame(
        {
            "bucket": [group["bucket"].iloc[0]],
            "tokens": [packed_tokens(byte_list(tokens.take(pa.array(which))))],
            "classes": [packed(classes.astype(np.uint16))],
            "times": [packed(times)],
            "totals": [packed(totals[which])],
            "known": [int((totals > 0).sum())],
            "trained": [int(times.sum())],
        }
    )


def vocabulary_of(shares: DataFrame) -> DataFrame:
    """Stored rows, one per bucket: its distinct pairs in an order that lets neighbours share
    their beginnings, as packed ``tokens``, ``classes``, ``times`` (training count of the pair)
    and ``totals`` (of the token in all classes); ``known`` and ``trained`` count the distinct
    training tokens and their occurrences."""
    schema = "bucket int, tokens binary, classes binary, times binary, totals binary, known long, trained long"
    return stored(shares.groupBy("bucket").applyInPandas(vocabulary_row, schema), "lm-vocabulary")


class SlotTable:
    """The counts of all slots in a file of the shared folder, read by a worker when it
    first needs them and kept, in the form it needs, until it needs something else."""

    kept: tuple = (None, None)

    def __init__(self, path: str):
        self.path = path

    @classmethod
    def write(cls, counts: np.ndarray, folder: str) -> "SlotTable":
        system, base = file_system(folder)
        with system.open_output_stream(f"{base}/slots") as out:
            out.write(packed(counts))
        return cls(f"{folder}/slots")

    def _kept(self, form):
        if SlotTable.kept[0] != (self.path, form.__name__):
            SlotTable.kept = (None, None)
            system, name = file_system(self.path)
            with system.open_input_stream(name) as file:
                counts = unpacked(file.read(), np.float32).reshape(-1, 2)
            SlotTable.kept = (self.path, form.__name__), form(counts)
        return SlotTable.kept[1]

    def counts(self) -> np.ndarray:
        return self._kept(np.asarray)

    def odds(self) -> tuple[np.ndarray, np.ndarray]:
        return self._kept(known_odds)


def training_pairs(row) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The classes, tokens and counts of a vocabulary row's pairs that occur in training."""
    times = unpacked(row.times, np.int64)
    there = np.flatnonzero(times)
    tokens = unpacked_tokens(row.tokens)
    texts = [tokens[k].decode("utf-8", "surrogatepass") for k in there]
    return unpacked(row.classes, np.uint16)[there].astype(np.int64), texts, times[there]


def count_slots(vocabulary: DataFrame, trained: int) -> np.ndarray:
    """Zeros and ones per slot, as float32, from all pairs with a training count."""
    kind = np.uint32 if trained < 1 << 32 else np.int64  # no sum exceeds the number of tokens

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((SLOTS, 2), kind)
        for batch in batches:
            for row in batch.itertuples(index=False):
                add_counts(table, *training_pairs(row))
        for start in range(0, SLOTS, CHUNK):
            piece = table[start : start + CHUNK]
            if piece.any():
                yield pd.DataFrame({"chunk": [start], "counts": [packed(piece)]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(unpacked(c, kind).astype(np.float64) for c in group["counts"])
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "counts": [packed(total.astype(np.float32))]})

    schema = "chunk long, counts binary"
    partial = vocabulary.filter("trained > 0").select("tokens", "classes", "times").mapInPandas(count, schema)
    table = np.zeros((SLOTS, 2), np.float32)
    for row in partial.groupBy("chunk").applyInPandas(add, schema).collect():  # the table's fixed size at most
        piece = unpacked(row["counts"], np.float32).reshape(-1, 2)
        table[row["chunk"] : row["chunk"] + len(piece)] = piece
    return table


def fit_mixer(vocabulary: DataFrame, counts: SlotTable) -> Mixer:
    """The mixer from one online pass of every task over its training pairs."""

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mixer, seen = Mixer.fresh(), np.zeros(GATES)
        for batch in batches:
            for row in batch.itertuples(index=False):
                classes, tokens, times = training_pairs(row)
                learn(mixer, counts.counts(), classes, tokens, times.astype(float), seen)
        for kind, values in enumerate((mixer.weights * seen[:, None], seen, mixer.ones, mixer.seen)):
            yield pd.DataFrame({"kind": kind, "place": np.arange(values.size), "value": values.reshape(-1)})

    parts = vocabulary.filter("trained > 0").select("tokens", "classes", "times")
    parts = parts.mapInPandas(fit, "kind int, place long, value double")
    sums = parts.groupBy("kind", "place").agg(F.sum("value").alias("value")).toPandas()  # the mixer's fixed size
    mixer = Mixer.fresh()
    if not len(sums):
        return mixer
    weights, seen, ones, shown = (sums[sums["kind"] == k].sort_values("place")["value"].to_numpy() for k in range(4))
    met = seen > 0
    mixer.weights[met] = weights.reshape(GATES, -1)[met] / seen[met, None]
    mixer.ones, mixer.seen = ones.reshape(NODES, CELLS), shown.reshape(NODES, CELLS)
    return mixer


def follower_totals(group: pd.DataFrame) -> pd.DataFrame:
    """A bucket's shares with the sums over all of them in place of their own counts."""
    digests = [np.cumsum(unpacked_planes(d, np.uint64), dtype=np.uint64) for d in group["digests"]]
    values = np.concatenate(digests)
    values.sort()
    values = values[np.append(True, values[1:] != values[:-1])]  # np.unique would go through a hash table
    places = [np.searchsorted(values, d) for d in digests]  # those of a share are distinct and in order
    totals = np.zeros(len(values), np.int64)
    for at, times in zip(places, group["times"]):
        totals[at] += unpacked_planes(times, np.uint32)
    return pd.DataFrame({"block": group["block"], "bucket": group["bucket"], "times": [packed_planes(totals[at]) for at in places]})


def followers_of(shares: DataFrame) -> DataFrame:
    """Stored rows (block, bucket, times): the training counts, over all blocks, of the block's
    distinct two tokens in a row, in the order of their digests."""
    return stored(shares.groupBy("bucket").applyInPandas(follower_totals, "block long, bucket int, times binary"), "lm-followers")


def follow_odds(both: np.ndarray, before: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gate and cell of each token, from the counts of it and the token before, and of the
    latter, and its log10 probability by its bytes."""
    gate = np.minimum(np.log2(before + 1).astype(np.int64), FOLLOW_GATES - 1)
    cell = np.zeros(len(both), np.uint16)
    met = np.flatnonzero(both > 0)
    odds = np.log2(both[met] / before[met]) - logs[met] * math.log2(10)
    cell[met] = np.clip(np.floor((odds - ODDS_LEAST) * ODDS_STEPS) + 1, 0, ODDS_CELLS - 1).astype(np.uint16)
    return gate, cell


def log2_gain(shares: np.ndarray, gate: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """What the token before adds to the log2 probability."""
    odds = np.where(cell > 0, (cell.astype(float) - 1) / ODDS_STEPS + ODDS_LEAST, -np.inf)
    with np.errstate(divide="ignore"):
        return np.logaddexp2(np.log2(1 - shares)[gate], np.log2(shares)[gate] + odds)


def gain_table(shares: np.ndarray) -> np.ndarray:
    """``log2_gain`` of every gate and cell, to be looked up for each token."""
    cells = np.arange(ODDS_CELLS)
    return np.stack([log2_gain(shares, np.full(ODDS_CELLS, gate), cells) for gate in range(FOLLOW_GATES)])


def fit_shares(shown: pd.DataFrame) -> np.ndarray:
    """The likeliest share per gate, from rows (code, n) of gate and cell; one more occurrence
    without odds keeps each share below one. Expectation and maximisation in turns."""
    code, n = shown["code"].to_numpy(np.int64), shown["n"].to_numpy(float)
    gate, cell = code // ODDS_CELLS, code % ODDS_CELLS
    total = np.bincount(gate, n, FOLLOW_GATES) + 1
    shares = np.where(np.arange(FOLLOW_GATES) > 0, 0.5, 0.0)
    odds = np.where(cell > 0, (cell - 1) / ODDS_STEPS + ODDS_LEAST, -np.inf)
    for _ in range(300):
        with np.errstate(divide="ignore"):
            own = np.exp2(np.log2(shares)[gate] + odds - log2_gain(shares, gate, cell))
        shares = np.bincount(gate, n * own, FOLLOW_GATES) / total
    return shares


def scored(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str | None = "lang", sample: int = SAMPLE
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, and bits_per_byte of its coded tokens."""
    with frugal(docs.sparkSession):
        return _scored(docs, id_col, text_col, label_col, sample)


def _scored(docs: DataFrame, id_col: str, text_col: str, label_col: str | None, sample: int) -> DataFrame:
    spark = docs.sparkSession
    labelled = docs if label_col else docs.limit(0).withColumn("no_label", F.lit(""))
    digest = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    labelled = labelled.filter(digest % 5 != 1)  # as in Block.add
    try:
        model = fit(labelled, id_col, text_col, label_col or "no_label", sample)
    except ValueError:
        if docs.filter(has_label(label_col, text_col)).isEmpty():
            raise
        model = fit(docs.limit(0), id_col, text_col, label_col, sample)
    numbered, folder = blocks(docs, id_col, text_col, model, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = numbered.filter("kind = 'pairs'")
    followers = followers_of(numbered.filter("kind = 'follows'").select("block", "bucket", "times", "digests"))
    dropped(spark, f"{folder}/kind=follows")
    vocabulary = vocabulary_of(shares.select("bucket", "tokens", "classes", "times"))
    sums = vocabulary.agg(F.coalesce(F.sum("trained"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0)))
    trained, distinct = sums.first()
    counts = SlotTable.write(count_slots(vocabulary, trained), new_folder(spark, "lm-slots"))
    mixer = fit_mixer(vocabulary, counts)

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            logs = []
            for row in batch.itertuples(index=False):
                texts = [t.decode("utf-8", "surrogatepass") for t in unpacked_tokens(row.tokens)]
                logs.append(score(mixer, counts.odds(), unpacked(row.classes, np.uint16).astype(np.int64), texts).tobytes())
            yield batch.assign(logs=logs)

    rated = vocabulary.select("bucket", "tokens", "classes", "totals").mapInPandas(
        rate, "bucket int, tokens binary, classes binary, totals binary, logs binary"
    )

    def answer(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        SlotTable.kept = (None, None)
        (row,) = known.itertuples(index=False)
        tokens = shares_tokens([row.tokens]).dictionary_encode()
        which, tokens = tokens.indices.to_numpy(), tokens.dictionary
        pairs = Pairs(tokens, unpacked(row.classes, np.uint16), which)
        closed = pc.not_equal(tokens, pa.scalar(END.encode(), tokens.type)).to_numpy(zero_copy_only=False)
        sizes = (pc.binary_length(tokens).to_numpy() + closed).astype(np.uint32)[which]
        digests = token_digests(byte_list(tokens))[which]
        totals, logs = unpacked(row.totals, np.int64), np.frombuffer(row.logs, np.float64)
        out = []
        for shares in runs_of_shares(asked):
            for share, at in zip(shares, pairs.places(shares)):
                values = packed(totals[at]), logs[at].tobytes(), packed(sizes[at]), packed(digests[at])
                out.append((share.block, None, share.places, *values, None))
        return pd.DataFrame(out, columns=["block", "bucket", "places", "totals", "logs", "sizes", "digests", "times"])

    answers = "block long, bucket int, places binary, totals binary, logs binary, sizes binary, digests binary, times binary"

    known = (
        shares.select("block", "bucket", "places", "tokens", "classes")
        .groupBy("bucket")
        .cogroup(stored(rated, "lm-rated").groupBy("bucket"))
        .applyInPandas(answer, answers)
    )
    norm = trained + 0.5 * (distinct + 1)

    def add_up(texts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        SlotTable.kept = (None, None)
        shares, follows = known[known["places"].notna()], known[known["places"].isna()].sort_values("bucket")
        at = [unpacked(p, np.uint32) for p in shares["places"]]
        size = sum(map(len, at))
        total, logs, sizes, digests = np.zeros(size, np.int64), np.zeros(size), np.zeros(size, np.int64), np.zeros(size, np.uint64)
        for places, row in zip(at, shares.itertuples(index=False)):
            total[places] = unpacked(row.totals, np.int64)
            logs[places] = np.frombuffer(row.logs, np.float64)
            sizes[places] = unpacked(row.sizes, np.uint32)
            digests[places] = unpacked(row.digests, np.uint64)
        base = np.log10((total + 0.5) / norm)
        lengths = texts["n_tokens"].to_numpy(np.int64)
        first = np.cumsum(lengths) - lengths
        own = np.concatenate([unpacked_planes(p, np.uint32) for p in texts["places"]])
        both = follower_digests(digests[own], first, digests[own[-1]])
        order = np.argsort(both)
        both = both[order]
        rank = np.cumsum(np.append(False, both[1:] != both[:-1]))
        both[order] = np.concatenate([unpacked_planes(t, np.uint64) for t in follows["times"]])[rank]
        both = both.view(np.int64)
        del order, rank, digests
        before = np.append(0, total[own[:-1]])
        before[first] = total[own[-1]]  # every text ends once, and begins once
        learned = np.repeat(~texts["held_out"].to_numpy(bool), lengths)
        gate, cell = follow_odds(both, before, logs[own])
        gate = gate.astype(np.uint8)
        shown = follow_odds(both[learned] - 1, before[learned] - 1, logs[own[learned]])
        codes, n = np.unique(shown[0] * ODDS_CELLS + shown[1], return_counts=True)
        del shown, both, before
        rows = [(None, None, None, None, None, None, None, packed(codes), packed(n.astype(np.int64)))]
        sums = [np.add.reduceat(x[own], first).tolist() for x in ((total > 0).astype(np.int64), base, logs, sizes)]
        for doc_id, held_out, start, length, *values in zip(texts["doc_id"], texts["held_out"], first, lengths, *sums):
            some = slice(start, start + length)
            rows.append((doc_id, held_out, length, *values, packed(gate[some]), packed_planes(cell[some])))
        return pd.DataFrame(rows, columns=["doc_id", "held_out", "n_tokens", "n_known", "base", "logs", "bytes", "gates", "cells"])

    texts = numbered.filter("kind = 'text'").select("block", "doc_id", "held_out", "n_tokens", "places")
    nothing = (F.lit(None).cast("binary").alias(c) for c in ("places", "totals", "logs", "sizes", "digests"))
    known = known.union(followers.select("block", "bucket", *nothing, "times"))
    schema = (
        "doc_id string, held_out boolean, n_tokens long, n_known long, base double, logs double, bytes long, "
        "gates binary, cells binary"
    )
    found = stored(texts.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(add_up, schema), "lm-found")

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for codes, n in zip(batch["gates"], batch["cells"]):
                yield pd.DataFrame({"code": unpacked(codes, np.int64), "n": unpacked(n, np.int64)})

    shown = found.filter("n_tokens IS NULL").select("gates", "cells").mapInPandas(listed, "code long, n long")
    follow = fit_shares(shown.groupBy("code").agg(F.sum("n").alias("n")).toPandas())  # gates times cells at most

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gains = gain_table(follow)
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                gain = gains[unpacked(row.gates, np.uint8), unpacked_planes(row.cells, np.uint16)]
                score = row.logs + float(gain.sum()) / math.log2(10)
                bits = -score * math.log2(10) / row.bytes
                rows.append((row.doc_id, row.held_out, row.n_tokens, row.n_known, trained, row.base, score, bits))
            names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
            yield pd.DataFrame(rows, columns=names)

    schema = (
        "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double"
    )
    return found.filter("n_tokens IS NOT NULL").mapInPandas(finish, schema).withColumn("doc_id", F.col("doc_id").cast("long"))
