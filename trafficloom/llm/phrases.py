"""Collocations of two to five words, counted in burst tries.

1. Words are counted per language. Word ids are seeded 64-bit digests of (language, word);
   the vocabulary is checked for two words with one id, and a collision takes the next
   seed, so ids are as good as numbers from a dictionary, and no dictionary travels.
2. Every part of a phrase is at least as frequent as the phrase, so a window of words ends
   before a word or a pair of words below the least count. Which ones those are is told by
   bit fields of bounded size. Pairs are counted for that by 64-bit codes. A bit or code
   that two share only means a window longer than it need be; the exact counts drop it.
3. In a pass of its own, each task inserts the windows into a ``BurstTrie``: a shallow trie over word ids whose
   leaves are hash containers of the rest of the window. A container that grows beyond
   ``BURST`` bursts into one container per next word. A trie beyond ``ENTRIES`` spills its
   largest subtrees whole, as runs of (phrase, count) sorted by phrase.
4. The stored runs are cut into ranges of phrases, which are partitions by prefix that
   reach as deep as a hot prefix needs, sorted there, and added up. A phrase has at most
   one row per spill, so no range is hot, whatever one word, pair or passage is repeated.
5. Cuts, containment and ranks are joins and grouped aggregates over the frequent phrases
   alone. Products are decimals of 38 digits.

Defined cases: a null language is ``und``. A null or empty text has no words. Repeated rows
count each. An empty table, or one without a phrase as frequent as asked, gives no rows.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trafficloom.llm.common import stored

LONGEST = 5
LEAST = 100
TOP = 2000
#: A phrase is dropped for a longer one with at least this percentage of its count.
COVERED = 100

#: Entries of a container before it bursts, and of a trie or word table before it spills.
BURST = 4096
ENTRIES = 500_000
#: Rows that a task hands on at once.
ROWS = 50_000
#: About how many windows are counted before they go to the trie.
AT_ONCE = 100_000
#: Codes of pairs that a task sorts at once.
CODES = 8_000_000
#: Words whose ids a worker remembers.
REMEMBERED = 1_000_000

#: Bits per frequent word or pair, and the bounds of the field's size as powers of two.
SPARSE = 16
FEWEST_BITS, MOST_BITS = 15, 28
BUCKET = 1 << 15  # bits in a row of Spark's bitmap functions

ID = 8  # bytes of a word id
NO_ID = bytes(ID)
_BREAK = b"\xff"  # in no UTF-8 text


def _folding() -> bytes:
    """A-Z lowered, and the characters that end a piece as a byte of its own."""
    table = bytearray(range(256))
    for upper in range(ord("A"), ord("Z") + 1):
        table[upper] = upper + 32
    for stop in b".,;:!?\n\x0b\x0c\r":
        table[stop] = _BREAK[0]
    return bytes(table)


_FOLDING = _folding()


def words_and_breaks(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, and a break wherever a piece ends."""
    return text.translate(_FOLDING).replace(_BREAK, b" \xff ").split()


class BurstTrie:
    """Counts windows of word ids, given as their bytes one after the other.

    ``root`` maps a first id to a container or to a branch, a branch maps a next id, or
    nothing where a window ends, to a container or a deeper branch. A container counts
    the rests of windows.
    """

    class Branch(dict):
        pass

    class Container(dict):
        pass

    def __init__(self, shortest: int, longest: int, burst: int = BURST, entries: int = ENTRIES):
        self.shortest, self.longest, self.burst, self.entries = shortest, longest, burst, entries
        self.root = self.Branch()
        self.held = 0

    def add(self, windows: Iterable[bytes]) -> None:
        container = self.Container
        for window, n in Counter(windows).items():
            branch, at = self.root, ID
            word = window[:ID]
            node = branch.get(word)
            while type(node) is self.Branch:
                branch, word, at = node, window[at : at + ID], at + ID
                node = branch.get(word)
            if node is None:
                node = branch[word] = container()
            rest = window[at:]
            if rest in node:
                node[rest] += n
                continue
            node[rest] = n
            self.held += 1
            if len(node) > self.burst:
                branch[word] = self._burst(node)

    def _burst(self, container: Container) -> Branch:
        branch = self.Branch()
        for rest, n in container.items():
            branch.setdefault(rest[:ID], self.Container())[rest[ID:]] = n
        return branch

    def _walk(self, prefix: bytes, node: Branch | Container) -> Iterator[tuple[bytes, int]]:
        """The windows of a subtree in order, with their counts."""
        if type(node) is self.Branch:
            for word in sorted(node):
                yield from self._walk(prefix + word, node[word])
        else:
            for rest in sorted(node):
                yield prefix + rest, node[rest]

    def _size(self, node: Branch | Container) -> int:
        return sum(map(self._size, node.values())) if type(node) is self.Branch else len(node)

    def _run(self, word: bytes, node: Branch | Container) -> Iterator[tuple[bytes, int]]:
        """The phrases that the windows of a subtree begin with, in order, and their counts."""
        if self.shortest == self.longest:
            return self._walk(word, node)
        run: dict[bytes, int] = {}
        for window, n in self._walk(word, node):
            for end in range(ID * self.shortest, len(window) + 1, ID):
                phrase = window[:end]
                run[phrase] = run.get(phrase, 0) + n
        return iter(sorted(run.items()))

    def spill(self, down_to: int) -> Iterator[tuple[list[bytes], list[int]]]:
        """The largest subtrees, which leave the trie, as one sorted run of phrases and their
        counts, in parts of some ``ROWS``."""
        words = []
        for size, word in sorted(((self._size(node), word) for word, node in self.root.items()), reverse=True):
            if self.held <= down_to:
                break
            self.held -= size
            words.append(word)
        phrases: list[bytes] = []
        counts: list[int] = []
        for word in sorted(words):
            for phrase, n in self._run(word, self.root.pop(word)):
                phrases.append(phrase)
                counts.append(n)
            if len(phrases) > ROWS:
                yield phrases, counts
                phrases, counts = [], []
        if phrases:
            yield phrases, counts

    def overfull(self) -> bool:
        return self.held > self.entries


def reaches(linked: np.ndarray, longest: int) -> np.ndarray:
    """For each word, how many words a window from it holds; ``linked[i]`` says whether
    words i and i + 1 may stand in one window."""
    reach = np.ones(len(linked) + 1, np.int64)
    upto = np.ones(len(linked), bool)
    for k in range(min(longest - 1, len(linked))):
        upto = upto[: len(linked) - k] & linked[k:]
        reach[: len(upto)] += upto
    return reach


def pair_codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each pair of ids; ids are digests, so few pairs share one."""
    return left ^ (right << np.uint64(29) | right >> np.uint64(35))


def _low(ids: np.ndarray) -> np.ndarray:
    return ids & np.uint64(0xFFFFFFFF)


class BitField:
    """Which of 2^k slots are taken."""

    def __init__(self, data: bytes):
        self.bits, self.last = data, 8 * len(data) - 1
        self.data, self.mask = np.frombuffer(data, np.uint8), np.uint64(self.last)

    def has_one(self, slot: int) -> bool:
        slot &= self.last
        return self.bits[slot >> 3] >> (slot & 7) & 1 != 0

    def has(self, slots: np.ndarray) -> np.ndarray:
        slots = slots & self.mask
        return (self.data[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0

    @staticmethod
    def of(slots: DataFrame) -> bytes:
        """The field of a stored frame with one column of slots, with ``SPARSE`` bits a row as far
        as 2^``MOST_BITS``, so at most 32 MB come to the driver."""
        power = min(MOST_BITS, max(FEWEST_BITS, (SPARSE * slots.count()).bit_length()))
        slot = F.col(slots.columns[0]).bitwiseAND((1 << power) - 1)
        parts = slots.groupBy(F.shiftright(slot, 15).alias("bucket")).agg(
            F.bitmap_construct_agg(slot.bitwiseAND(BUCKET - 1)).alias("bits")
        )
        field = bytearray(1 << (power - 3))
        for row in parts.collect():  # at most 2^13 rows of 4 KB
            field[row["bucket"] * BUCKET // 8 : (row["bucket"] + 1) * BUCKET // 8] = row["bits"]
        return bytes(field)


class WordIds(dict):
    """Ids of a language's words; ``NO_ID`` for a break and for a word that is not in the field."""

    def __init__(self, lang: str, seed: int, field: BitField | None = None):
        self.prefix, self.seed, self.field = lang.encode() + b"\0", seed, field
        self[_BREAK] = NO_ID

    def __missing__(self, word: bytes) -> bytes:
        from xxhash import xxh64_digest

        found = xxh64_digest(self.prefix + word, self.seed)
        if self.field is not None and not self.field.has_one(int.from_bytes(found[4:], "big")):
            found = NO_ID
        self[word] = found
        return found


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """Languages and texts as bytes; texts without a word in any language are of no use."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.col(text_col).cast("binary").alias("text")).filter("octet_length(text) > 0")


def _counted_words(texts: DataFrame, seed: int) -> DataFrame:
    """Every word of every language with its id and count, stored."""

    def rows(counts: dict[str, Counter]) -> Iterator[pd.DataFrame]:
        for lang, own in counts.items():
            ids, words = WordIds(lang, seed), list(own)
            yield pd.DataFrame({"lang": lang, "word": words, "id": [ids[w] for w in words], "n": list(own.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                own = counts[lang]
                own.update(words_and_breaks(text))
                own.pop(_BREAK, None)
            if sum(map(len, counts.values())) > ENTRIES:
                yield from rows(counts)
                counts.clear()
        yield from rows(counts)

    partial = texts.mapInPandas(count, "lang string, word binary, id binary, n long")
    return stored(partial.groupBy("lang", "word", "id").agg(F.sum("n").alias("n")), "phrase-words")


def vocabulary(texts: DataFrame, first_seed: int = 0) -> tuple[DataFrame, int]:
    """All words, counted, and the first seed that gives no two of them one id."""
    for seed in itertools.count(first_seed):
        words = _counted_words(texts, seed)
        shared = words.groupBy("id").agg(F.count("*").alias("words"))
        if shared.filter((F.col("words") > 1) | (F.col("id") == F.lit(NO_ID))).isEmpty():
            return words, seed


def _ids(batches: Iterator[pd.DataFrame], seed: int, field: BitField) -> Iterator[tuple[bytes, np.ndarray]]:
    """The word ids of each text, as bytes and as numbers, 0 for breaks and rare words."""
    known: dict[str, WordIds] = {}
    for batch in batches:
        if sum(map(len, known.values())) > REMEMBERED:
            known.clear()
        for lang, text in zip(batch["lang"], batch["text"]):
            if lang not in known:
                known[lang] = WordIds(lang, seed, field)
            data = b"".join(map(known[lang].__getitem__, words_and_breaks(text)))
            yield data, np.frombuffer(data, ">u8").astype(np.uint64)


def frequent_pairs(texts: DataFrame, seed: int, words: bytes, least: int) -> bytes:
    """The field of all pairs of frequent words that are counted ``least`` times or more, by
    their codes. Pairs that share a code may be in it for their common count."""
    word_bits = texts.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pd.DataFrame:
            codes, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            held.clear()
            return pd.DataFrame({"code": codes.view(np.int64), "n": n.astype(np.int64)})

        for _, ids in _ids(batches, seed, BitField(word_bits.value)):
            at = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
            held.append(pair_codes(ids[at], ids[at + 1]))
            size += len(at)
            if size > CODES:
                yield counted()
                size = 0
        yield counted()

    codes = texts.mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    frequent = codes.filter(F.col("n") >= least).select(F.col("code").bitwiseAND(0xFFFFFFFF).alias("slot"))
    return BitField.of(stored(frequent, "phrase-pairs"))


def counted_phrases(texts: DataFrame, seed: int, words: bytes, pairs: bytes, longest: int, least: int) -> DataFrame:
    """Phrases of two to ``longest`` words counted ``least`` times or more, stored."""
    spark = texts.sparkSession
    word_bits, pair_bits = spark.sparkContext.broadcast(words), spark.sparkContext.broadcast(pairs)

    def runs(trie: BurstTrie, down_to: int) -> Iterator[pd.DataFrame]:
        for phrases, counts in trie.spill(down_to):
            yield pd.DataFrame({"phrase": phrases, "n": counts})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair_field = BitField(pair_bits.value)
        trie = BurstTrie(2, longest)
        windows: list[bytes] = []
        for data, ids in _ids(batches, seed, BitField(word_bits.value)):
            linked = (ids[:-1] != 0) & (ids[1:] != 0)
            at = np.flatnonzero(linked)
            linked[at] = pair_field.has(_low(pair_codes(ids[at], ids[at + 1])))
            reach = reaches(linked, longest)
            starts = np.flatnonzero(reach > 1)
            ends = ID * (starts + reach[starts])
            spans = list(zip((ID * starts).tolist(), ends.tolist()))
            for first in range(0, len(spans), AT_ONCE):
                windows += [data[a:b] for a, b in spans[first : first + AT_ONCE]]
                if len(windows) < AT_ONCE:
                    continue
                trie.add(windows)
                windows.clear()
                if trie.overfull():
                    yield from runs(trie, trie.entries // 2)
        trie.add(windows)
        yield from runs(trie, 0)

    spilled = stored(texts.mapInPandas(count, "phrase binary, n long"), "phrase-runs")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = spilled.repartitionByRange(parts, "phrase").sortWithinPartitions("phrase")
    return stored(merged.groupBy("phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrases")


def counted(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST
) -> tuple[DataFrame, DataFrame]:
    """Words (lang, word, id, n), all of them, and phrases (phrase, n) of two words or more
    that are counted ``least`` times or more; a phrase is the ids of its words in a row."""
    texts = _texts(docs, lang_col, text_col)
    words, seed = vocabulary(texts)
    low = F.conv(F.hex(F.substring("id", 5, 4)), 16, 10).cast("long")
    word_field = BitField.of(words.filter(F.col("n") >= least).select(low))
    pair_field = frequent_pairs(texts, seed, word_field, least)
    return words, counted_phrases(texts, seed, word_field, pair_field, longest, least)


def _words_in(phrase: Column) -> Column:
    return (F.octet_length(phrase) / ID).cast("int")


def _part(phrase: Column, first: Column, words: Column) -> Column:
    """Words of a phrase, the first being number 0."""
    return F.substring(phrase, (ID * first + 1).cast("int"), (ID * words).cast("int"))


def scored(phrases: DataFrame, words: DataFrame, least: int = LEAST) -> DataFrame:
    """Each phrase with the cut of the lowest score, ties to the shortest first part."""
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    heads = words.filter(F.col("n") >= least).join(totals, "lang").select("id", "lang", "total")
    known = phrases.select(F.col("phrase").alias("part"), F.col("n").alias("f")).union(
        words.filter(F.col("n") >= least).select("id", "n")
    )
    phrase = F.col("phrase")
    cuts = (
        phrases.select("phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), _words_in(phrase) - 1)).alias("k"))
        .withColumn("left", _part(phrase, F.lit(0), F.col("k")))
        .withColumn("right", _part(phrase, F.col("k"), _words_in(phrase) - F.col("k")))
        .withColumn("head", _part(phrase, F.lit(0), F.lit(1)))
    )
    both = (
        cuts.join(known.withColumnsRenamed({"part": "left", "f": "l"}), "left")
        .join(known.withColumnsRenamed({"part": "right", "f": "r"}), "right")
        .join(heads.withColumnRenamed("id", "head"), "head")
    )
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    both = both.withColumn("above", wide("a") * wide("total") * F.lit(1000).cast("decimal(4,0)"))
    both = both.withColumn("below", wide("l") * wide("r")).withColumn("score", F.expr("above div below"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return both.groupBy("phrase", "lang", "a", F.col("total").alias("n")).agg(best).select("phrase", "lang", "a", "n", "best.*")


def covered(phrases: DataFrame) -> DataFrame:
    """The phrases that stand in longer ones, with the largest count of those."""
    whole = _words_in(F.col("phrase"))
    inside = F.flatten(
        F.transform(
            F.sequence(F.lit(2), whole - 1),
            lambda words: F.transform(F.sequence(F.lit(0), whole - words), lambda at: _part(F.col("phrase"), at, words)),
        )
    )
    longer = phrases.filter(whole > 2).select("n", F.explode(F.array_distinct(inside)).alias("phrase"))
    return longer.groupBy("phrase").agg(F.max("n").alias("longer"))


def spelled(phrases: DataFrame, words: DataFrame, least: int = LEAST) -> DataFrame:
    """The phrases with their words as ``text``, joined by blanks."""
    at = F.explode(F.sequence(F.lit(0), _words_in(F.col("phrase")) - 1)).alias("at")
    each = phrases.select("phrase", at).withColumn("id", _part(F.col("phrase"), F.col("at"), F.lit(1)))
    named = words.filter(F.col("n") >= least).select("id", F.col("word").cast("string").alias("word"))
    listed = F.sort_array(F.collect_list(F.struct("at", "word")))  # at most as many as the longest phrase has
    return each.join(named, "id").groupBy("phrase").agg(F.concat_ws(" ", F.transform(listed, lambda x: x["word"])).alias("text"))


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    covered_percent: int = COVERED,
) -> DataFrame:
    """The best phrases per language: ``lang``, ``rank`` from 1, ``phrase``, its count ``a``,
    the counts ``l`` and ``r`` of its parts at the cut that counts, the language's words
    ``n``, and ``score``, floor(1000 a n / (l r)).

    Of each language the first ``top`` by score and count descending, then by phrase in byte
    order. Phrases inside a longer one with ``covered_percent`` of their count are left out.
    """
    words, phrases = counted(docs, lang_col, text_col, longest, least)
    judged = stored(scored(phrases, words, least).join(covered(phrases), "phrase", "left"), "phrase-scores")
    open_ = judged.filter(F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a")))
    named = open_.join(spelled(open_.select("phrase"), words, least), "phrase")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text")
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
