"""Linking quotations to the messages they quote, and conversations in reply order.

1. ``parsed`` splits each message into its own text and the passages it quotes, with their
   level of nesting, and digests both. Digests are of words only, with A-Z lowered, so
   wrapping, blanks and markers make no difference. A text's units are itself, its
   paragraphs, lines and sentences; sentences run across lines.
2. A passage is linked to the earliest message of which it is a unit. A passage that is none
   is a part of a message if its words stand there in a row: ``ANCHORS`` of its windows of
   ``ANCHOR`` words are joined with those of the conversation's messages, each of which stands
   for the earliest message that has it, and what meets is compared word by word. A passage that is
   no part of these either, since it was changed or runs over several messages, is linked by
   the largest kind of its own units that finds a message, to the latest it finds; units of
   less than ``MIN_WORDS`` words are the last resort.
3. A message replies to the latest message among those its outermost passages were linked to;
   if these found none, among the nested ones.
4. Threads come from doubling: every message with a parent looks up its parent's ancestor
   until all have reached a message without one. Messages are ordered by thread, depth and turn.

Keys are pairs of conversation and unit, window or turn, so a conversation of any size is
spread; a unit or window that many messages share is reduced to its earliest message in every
task before. Windows are made only of conversations that need them, and only those leave a task
that a bit field of all anchors, of bounded size, does not rule out. With ``scope="corpus"``
originals are sought in all conversations.

Defined cases: a null or empty text has no units. Messages without a conversation or turn are
not linked and keep their place. Rows that repeat a turn are one place: they share parent and
thread, and each keeps its own text. A message is only linked to earlier turns; within the
corpus, to other conversations' messages or earlier turns. Units of any length are linked
within a conversation; across the corpus, where short ones are everywhere, units and parts
of less than ``MIN_WORDS`` words are not. A part whose anchors all stand in still earlier messages is
linked by its units alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficloom.llm.common import stored
from trafficloom.llm.phrases import BitField

MIN_WORDS = 4
#: Words of a window, and windows of a passage that look for the message it is a part of.
ANCHOR, ANCHORS = 5, 4
WHOLE, PARAGRAPH, LINE, SENTENCE = 4, 3, 2, 1
SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
#: Markers at the start of a line, with at most three blanks before.
MARKERS = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)")
#: A line that introduces a quotation, dropped together with it.
INTRODUCES = re.compile(r"\bwrote:\s*$")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def digest(words: list[bytes]) -> int:
    """A signed 64-bit digest of words."""
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def levels(text: str) -> list[tuple[int, str]]:
    """Each line's level of quotation and its text without markers."""
    found = []
    for line in text.split("\n"):
        marker = MARKERS.match(line)
        found.append((marker[1].count(">"), line[marker.end() :]) if marker else (0, line))
    return found


def split_message(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The message's own text, and its quoted passages with their levels in order.

    A passage is a run of lines of one level. A line that introduces a quotation belongs
    to the quotation's surroundings and is dropped.
    """
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    lines = levels(text)
    for k, (level, line) in enumerate(lines):
        introduces = INTRODUCES.search(line) and k + 1 < len(lines) and lines[k + 1][0] > level
        if introduces:
            continue
        if level == 0:
            own.append(line)
        elif passages and k and lines[k - 1][0] == level:
            passages[-1][1].append(line)
        else:
            passages.append((level, [line]))
    return "\n".join(own).strip(), [(level, "\n".join(p)) for level, p in passages if any(x.strip() for x in p)]


def units(text: str) -> list[tuple[int, int, int]]:
    """Distinct (unit, digest, words) of a text: itself, its paragraphs, lines and sentences."""
    whole = words_of(text)
    if not whole:
        return []
    found = {digest(whole): (WHOLE, len(whole))}
    parts = {PARAGRAPH: re.split(r"\n[ \t]*\n", text), LINE: text.split("\n"), SENTENCE: SENTENCE_END.split(text)}
    for unit, texts in parts.items():
        for words in map(words_of, texts):
            if words:
                found.setdefault(digest(words), (unit, len(words)))
    return [(unit, value, words) for value, (unit, words) in found.items()]


def anchors(words: list[bytes]) -> list[int]:
    """Distinct digests of some windows, evenly spread from the first to the last; a text
    shorter than a window is one by itself."""
    size = min(ANCHOR, len(words))
    last = len(words) - size
    return list({digest(words[k : k + size]) for k in {last * i // (ANCHORS - 1) for i in range(ANCHORS)}})


def windows(words: list[bytes], sizes: Iterable[int]) -> list[int]:
    """Distinct digests of all windows of so many words."""
    return list({digest(words[k : k + n]) for n in sizes for k in range(len(words) - n + 1)})


QUOTED = "passage:int,level:int,unit:int,digest:bigint,words:int"


def parsed(messages: DataFrame, conv_col: str, turn_col: str, text_col: str) -> DataFrame:
    """The messages with ``parsed_message``: ``own``, their text without quotations, ``own_units``
    (structs of digest and words), ``passages`` (each with its level and its words in a row) and
    ``quoted`` (structs of passage, level, unit, digest, words); other columns as given."""

    @F.pandas_udf(
        "own string, own_units array<struct<digest:bigint,words:int>>, n_quotes int, "
        f"passages array<struct<passage:int,level:int,anchors:array<bigint>,words:int,line:string>>, quoted array<struct<{QUOTED}>>"
    )
    def parse(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            own, found = split_message(text) if isinstance(text, str) else (None, [])
            passages, quoted = [], []
            for k, (level, passage) in enumerate(found):
                words = words_of(passage)
                line = b" ".join(words).decode("utf-8", "surrogatepass")
                passages.append({"passage": k, "level": level, "anchors": anchors(words), "words": len(words), "line": line})
                quoted += [
                    {"passage": k, "level": level, "unit": unit, "digest": value, "words": n} for unit, value, n in units(passage)
                ]
            rows.append((own, [{"digest": value, "words": n} for _, value, n in units(own or "")], len(found), passages, quoted))
        return pd.DataFrame(rows, columns=["own", "own_units", "n_quotes", "passages", "quoted"])

    return messages.withColumn("parsed_message", parse(F.col(text_col)))


def _searched(places: DataFrame, bits: bytes) -> DataFrame:
    """Messages (conv, turn) with those ``windows`` of their own text, of the ``sizes`` asked
    for, that the field has, and the text's words in a ``line``, from rows with ``own``."""
    shared = places.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("windows array<bigint>, line string")
    def measure(texts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        field, rows = BitField(shared.value), []
        for words, wanted in zip((words_of(text or "") for text in texts), sizes):
            found = [w for w in windows(words, wanted) if field.has_one(w & 0xFFFFFFFF)]
            rows.append((found, b" ".join(words).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(rows, columns=["windows", "line"])

    return places.select("conv", "turn", measure("own", "sizes").alias("m")).select("conv", "turn", "m.*").filter(F.size("windows") > 0)


KEYS = ["conv", "turn", "passage", "level"]


def links(places: DataFrame, scope: str = "conversation") -> DataFrame:
    """Rows (conv, turn, passage, level, of_conv, of_turn) of the passages whose original is
    found, from rows (conv, turn, own, own_units, passages, quoted)."""
    if scope not in ("conversation", "corpus"):
        raise ValueError("the scope is conversation or corpus")
    least = 1 if scope == "conversation" else MIN_WORDS

    def earliest(own: DataFrame) -> DataFrame:
        """Rows (conv, turn, digest) reduced to the earliest message of each digest."""
        if scope == "conversation":
            first = own.groupBy("conv", "digest").agg(F.min("turn").alias("of_turn"))
            return first.select(F.col("conv").alias("of_conv"), F.col("digest").alias("of_digest"), "of_turn")
        first = own.groupBy("digest").agg(F.min(F.struct("conv", "turn")).alias("of"))
        return first.select(F.col("digest").alias("of_digest"), F.col("of.conv").alias("of_conv"), F.col("of.turn").alias("of_turn"))

    def matched(quoted: DataFrame, first: DataFrame) -> DataFrame:
        same = F.col("digest") == F.col("of_digest")
        if scope == "conversation":
            same = same & (F.col("conv") == F.col("of_conv"))
        earlier = (F.col("conv") != F.col("of_conv")) | (F.col("of_turn") < F.col("turn"))
        return quoted.join(first, same).filter(earlier).drop("of_digest", "digest")

    own = places.select("conv", "turn", F.explode("own_units").alias("u")).select("conv", "turn", "u.*")
    first = earliest(own.filter(F.col("words") >= least).select("conv", "turn", "digest"))
    quoted = places.select("conv", "turn", F.explode("quoted").alias("q")).select("conv", "turn", "q.*").filter(F.col("words") >= least)
    by_unit = stored(matched(quoted, first), "chat-units")
    target = ["of_conv", "of_turn"]
    whole = by_unit.filter(F.col("unit") == WHOLE).select(*KEYS, *target)

    # parts of messages: windows find them, all words decide
    passages = places.select("conv", "turn", F.explode("passages").alias("p")).select("conv", "turn", "p.*")
    open_ = passages.filter(F.col("words") >= least).join(whole, KEYS, "left_anti")
    open_ = stored(open_, "chat-open")
    sought = stored(open_.select(*KEYS, "words", F.explode("anchors").alias("digest")), "chat-anchors")
    bits = BitField.of(sought.select(F.col("digest").bitwiseAND(0xFFFFFFFF).alias("slot")))
    size = F.least("words", F.lit(ANCHOR))
    if scope == "corpus":
        wanted = places.withColumn("sizes", F.array(*(F.lit(n) for n in range(least, ANCHOR + 1))))
    else:  # at most as many sizes as an anchor has words
        wanted = places.join(sought.groupBy("conv").agg(F.collect_set(size).alias("sizes")), "conv")
    searched = stored(_searched(wanted, bits), "chat-searched")
    own_windows = searched.select("conv", "turn", F.explode("windows").alias("digest"))
    near = matched(sought.drop("words"), earliest(own_windows)).distinct()
    texts = searched.select(F.col("conv").alias("of_conv"), F.col("turn").alias("of_turn"), F.col("line").alias("own_line"))
    blank = F.lit(" ")
    holds = F.contains(F.concat(blank, "own_line", blank), F.concat(blank, "line", blank))
    part = near.join(open_.select(*KEYS, "line"), KEYS).join(texts, target).filter(holds).select(*KEYS, *target)
    part = stored(part.distinct(), "chat-parts")

    rest = by_unit.join(whole.union(part), KEYS, "left_anti")
    long = (F.col("words") >= MIN_WORDS).alias("long")
    best = rest.groupBy(*KEYS).agg(F.max(F.struct(long, "unit", "of_turn", "of_conv")).alias("best"))
    by_part = best.select(*KEYS, "best.of_conv", "best.of_turn")
    found = whole.union(part).union(by_part)
    return found.groupBy(*KEYS).agg(F.min(F.struct(*target)).alias("of")).select(*KEYS, "of.of_conv", "of.of_turn")


def threads(parents: DataFrame) -> DataFrame:
    """For rows (conv, turn, parent), parents being earlier turns: (conv, turn, parent, root, depth).

    In each round, messages that have not reached a root take over their ancestor's ancestor;
    those that have reached one are set aside, so that a few long threads do not keep all
    others busy.
    """
    active = stored(parents.select("conv", "turn", "parent", F.col("parent").alias("up"), F.lit(1).alias("depth")), "chat-threads")
    settled = active.limit(0)
    while not active.isEmpty():
        above = active.union(settled)
        above = above.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("up").alias("u"), F.col("depth").alias("d"))
        found = active.join(above, (F.col("conv") == F.col("c")) & (F.col("up") == F.col("t")), "left")
        step = found.select(
            "conv",
            "turn",
            "parent",
            F.coalesce("u", "up").alias("up"),
            (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"),
            F.col("u").isNotNull().alias("moved"),
        )
        step = stored(step, "chat-threads")
        settled = settled.union(step.filter("NOT moved").drop("moved"))
        active = step.filter("moved").drop("moved")
    return settled.select("conv", "turn", "parent", F.col("up").alias("root"), "depth")


def reply_ordered(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    scope: str = "conversation",
) -> DataFrame:
    """One row per message, sorted by conversation, thread, depth and turn: conv_id, turn,
    role, text without quotations, n_quotes, n_linked, parent_turn, thread_root, depth."""
    columns = [F.col(c).alias(name) for c, name in ((conv_col, "conv"), (turn_col, "turn"), (role_col, "role"), (text_col, "text"))]
    rows = parsed(messages.select(*columns), "conv", "turn", "text")
    rows = stored(rows.select("conv", "turn", "role", "parsed_message.*"), "chat-messages")
    places = rows.filter("conv IS NOT NULL AND turn IS NOT NULL")
    found = stored(links(places, scope), "chat-links")
    inside = found.filter("conv = of_conv")
    # Outermost first: the smallest level that was linked, and of it the latest message.
    reply = F.min(F.struct("level", (-F.col("of_turn")).alias("late")))
    parents = inside.groupBy("conv", "turn").agg((-reply["late"]).alias("parent"))
    placed = threads(parents)
    counts = found.groupBy("conv", "turn").agg(F.count_distinct("passage").alias("n_linked"))
    known = counts.join(placed, ["conv", "turn"], "left").withColumnsRenamed({"conv": "c", "turn": "t"})
    joined = rows.join(known, (F.col("conv") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
    out = joined.select(
        F.col("conv").alias("conv_id"),
        "turn",
        "role",
        F.col("own").alias("text"),
        "n_quotes",
        F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
        F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("thread_root"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
    )
    order = ["conv_id", "thread_root", "depth", "turn"]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)
