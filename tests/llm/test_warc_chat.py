"""Archives as exact round trips; quotations and threads against a plain version."""

import base64
import random
import re
import zlib
from hashlib import sha1

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import empty
from trafficloom.llm import chat, warc
from trafficloom.llm.common import new_folder

PAGES = "page_id long, url string, html string, note string"


def pages(spark):
    same = "<p>same</p>" * 50
    rows = [
        (1, "http://a.example/", same, "n"),
        (7, "http://b.example/?q=a b\r\nX: y", same, None),
        (3, None, same, "n"),
        (4, "http://c.example/", None, "n"),
        (5, "http://d.example/", "", "n"),
        (6, "http://e.example/", "größe \r\n\r\n WARC/1.1 日本", "n"),
        (6, "http://e.example/", "größe \r\n\r\n WARC/1.1 日本", "n"),
        (None, "http://f.example/", same, "n"),
        (None, "http://f.example/", "alone", "n"),
        (8, "http://g.example/", "".join(random.Random(1).choice("abcdef<>") for _ in range(400_000)), "n"),
    ] + [(100 + k, f"http://h.example/{k}", f"<p>{k % 30}</p>", "n") for k in range(90)]
    return spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS digest", "1 AS id", "'y' AS payload").repartition(3)


def expected(rows, revisit_from):
    largest = {}
    for r in rows:
        largest.setdefault(r["html"] or "", []).append(r["page_id"])
    out = []
    for r in rows:
        payload = (r["html"] or "").encode()
        ids = [i for i in largest[r["html"] or ""] if i is not None]
        top = max(ids) if ids else None
        revisits = r["page_id"] != top and len(payload) >= revisit_from
        digest = base64.b32encode(sha1(payload).digest()).decode()
        out.append(repr((r["page_id"], len(payload), digest, "revisit" if revisits else "response", top if revisits else None)))
    return sorted(out)


def number(name):
    digits = name.removeprefix("<urn:x-page:").removesuffix(">") if name else ""
    return int(digits) if digits else None


@pytest.mark.parametrize("file_bytes,range_bytes", [(1 << 30, 1 << 24), (2000, 700), (1 << 30, 64)])
@pytest.mark.parametrize("revisit_from", [0, 20])
def test_round_trip(spark, file_bytes, range_bytes, revisit_from):
    given = pages(spark)
    typed = warc.with_types(given, "page_id", "url", "html", revisit_from)
    folder = new_folder(spark, "warc")
    manifest = warc.write_archives(typed, folder if "://" in folder else f"file://{folder}", file_bytes=file_bytes)
    found = warc.read_archives(spark, manifest, range_bytes).collect()
    assert sum(r["type"] == "warcinfo" for r in found) == manifest.count()
    records = [r for r in found if r["type"] != "warcinfo"]
    got = [
        repr((number(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["type"], number(r["refers_to"])))
        for r in records
    ]
    assert sorted(got) == expected(given.collect(), revisit_from)
    html = {r["page_id"]: r["html"] for r in given.collect() if r["page_id"] is not None}
    for r in records:
        if r["type"] == "response" and number(r["record_id"]) is not None:
            assert r["payload"].decode() == (html[number(r["record_id"])] or "")


def test_empty_table(spark):
    assert warc.archived(empty(pages(spark))).count() == 0


def archive(tmp_path, parts):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(parts))
    return f"file://{path}", path.stat().st_size


def test_every_split_gives_every_record_once(tmp_path):
    draw = random.Random(2)
    parts = [warc.member([("WARC-Type", "resource"), ("WARC-Record-ID", str(k))], draw.randbytes(draw.randrange(300))) for k in range(60)]
    path, size = archive(tmp_path, parts)
    for step in (1, 17, 100, 1000, size):
        found = [r[4] for start in range(0, size, step) for r in warc.records_in(path, start, start + step)]
        assert found == [str(k) for k in range(60)]


def test_embedded_archives_are_not_records(tmp_path):
    """Compressed members are stored as they are inside another member, so their starts
    can be found there; their chain breaks where the embedding member goes on."""
    draw = random.Random(3)
    inner = b"".join(warc.member([("WARC-Type", "resource"), ("WARC-Record-ID", f"in{k}")], draw.randbytes(200)) for k in range(4))
    outer = []
    for k in range(5):
        block = inner + draw.randbytes(3000)
        head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: out{k}\r\nContent-Length: {len(block)}\r\n\r\n"
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        outer.append(packer.compress(head.encode() + block + warc.RECORD_END) + packer.flush())
        assert inner in outer[k]
    path, size = archive(tmp_path, outer)
    for step in (1500, 2500, 5000):
        found = [r[4] for start in range(0, size, step) for r in warc.records_in(path, start, start + step)]
        assert found == [f"out{k}" for k in range(5)]


def test_damage_is_an_error(tmp_path):
    part = warc.member([("WARC-Type", "resource")], b"x" * 100)
    path, size = archive(tmp_path, [part, part[:-6]])
    with pytest.raises(ValueError):
        list(warc.records_in(path, 0, size))
    assert zlib.decompress(part, 31).startswith(b"WARC/1.1")


def test_headers_of_any_length_come_back(spark):
    rows = [(1, "http://a.example/" + "x" * 70_000, "<p>a</p>"), (2, "http://b.example/?" + "y" * 3_000_000, "<p>b</p>"), (3, "http://c/", "")]
    found = {r["record_id"]: r for r in warc.archived(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for page, url, html in rows:
        record = found[warc.record_name(page)]
        assert record["target_uri"] == url and bytes(record["payload"]).decode() == html


MESSAGES = "conv_id long, turn long, role string, text string, own string"

THREAD = [
    (1, 0, "a", "Where is the station in this town?\nI cannot find it anywhere here."),
    (1, 1, "b", "On Monday, a wrote:\n> Where is the STATION\n> in this town?\nIt is behind the old church over there."),
    (1, 2, "c", "> > Where is the station in this town?\n>\n> It is behind the old church over there.\n\nThat one has been closed for years now."),
    (1, 3, "d", ">> It is behind the old church over there.\nNo idea, but thanks to all of you."),
    (1, 4, "e", "> quoted from elsewhere, not here at all\nA new subject without any quotation."),
    (1, 5, "f", "   > A new subject without any quotation.\n> That one has been closed for years now.\nBoth."),
    (1, 5, "f", "A second text of the same turn."),
    (2, 0, "a", "> Where is the station in this town?\nSame words in another conversation."),
    (2, 1, "b", None),
    (2, 2, "b", ""),
    (None, 0, "a", "> Where is the station in this town?"),
    (3, None, "a", "Where is the station in this town?"),
]


def conversations(spark):
    return spark.createDataFrame([(*r, "clash") for r in THREAD], MESSAGES).selectExpr("*", "1 AS depth", "2 AS conv", "3 AS parent")


def test_threads(spark):
    found = {(r["conv_id"], r["turn"], r["text"]): r for r in chat.reply_ordered(conversations(spark)).collect()}
    assert len(found) == len(THREAD)
    by_turn = {(c, t): r for (c, t, _), r in found.items()}
    parents = {t: by_turn[1, t]["parent_turn"] for t in range(6)}
    # Turn 2's nested quotation is older than the one it replies to; turn 3 quotes at level two only.
    assert parents == {0: None, 1: 0, 2: 1, 3: 1, 4: None, 5: 4}
    assert {t: (by_turn[1, t]["thread_root"], by_turn[1, t]["depth"]) for t in range(6)} == {
        0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (0, 2), 4: (4, 0), 5: (4, 1),
    }
    assert by_turn[1, 1]["text"] == "It is behind the old church over there."
    assert by_turn[1, 2]["text"] == "That one has been closed for years now."
    assert (by_turn[1, 4]["n_quotes"], by_turn[1, 4]["n_linked"]) == (1, 0)
    assert by_turn[2, 0]["parent_turn"] is None
    assert chat.reply_ordered(empty(conversations(spark))).count() == 0


def test_order_follows_threads(spark):
    rows = chat.reply_ordered(conversations(spark)).filter("conv_id = 1").collect()
    keys = [(r["thread_root"], r["depth"], r["turn"]) for r in rows if r["turn"] is not None]
    assert keys == sorted(keys)


def test_corpus_scope_links_other_conversations(spark):
    rows = chat.parsed(conversations(spark).selectExpr("conv_id AS conv", "turn", "text"), "conv", "turn", "text")
    places = rows.select("conv", "turn", "parsed_message.*").filter("conv IS NOT NULL AND turn IS NOT NULL")
    found = {(r["conv"], r["turn"]): (r["of_conv"], r["of_turn"]) for r in chat.links(places, "corpus").collect() if r["conv"] == 2}
    assert found == {(2, 0): (1, 0)}


def test_deep_chain_and_popular_original(spark):
    """Each message quotes the one before; half of all quote the first one as well."""
    said = lambda k: f"message number {k} says something of its own"
    rows = [(1, 0, "a", said(0))]
    for k in range(1, 70):
        rows.append((1, k, "a", f"> {said(k - 1)}\n{said(k)}" if k % 2 else f"> {said(0)}\n>> {said(k - 1)}\n{said(k)}"))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = {r["turn"]: (r["parent_turn"], r["thread_root"], r["depth"]) for r in chat.reply_ordered(frame).collect()}
    for k in range(1, 70):
        parent = k - 1 if k % 2 else 0
        assert found[k] == (parent, 0, found[parent][2] + 1)


def test_levels_and_units():
    assert chat.levels("> > a\n>>b\n    > code\n>") == [(2, "a"), (2, "b"), (0, "    > code"), (1, "")]
    own = chat.units("One two three four five.\n\nShort.\n\nOne two three four five.")
    assert [unit for unit, _, _ in own] == [chat.WHOLE, chat.PARAGRAPH, chat.PARAGRAPH]
    assert [words for _, _, words in own] == [11, 5, 1]
    assert chat.units(" \n") == []


SHORT = [
    (1, 0, "a", "I arrive at nine. Which town is it? Please tell me before Friday.\nThanks."),
    (1, 1, "b", "> Which town?\nThe one by the river."),  # is a part of no message: a word is missing
    (1, 2, "b", "> Thanks.\nNever mind."),
    (1, 3, "b", "> Which town\n> is it?\nThe other one."),  # a sentence, wrapped anew
    (1, 4, "c", "> town is it? Please tell\nWhy do you ask?"),  # neither a line nor a sentence
    (1, 5, "c", "> it?\nThis."),
    (1, 6, "c", "> The one by the river.\n> I never wrote this line.\nOnly one of both."),
    (1, 7, "d", "> nothing of the kind\nHello."),
]


def test_short_and_partial_quotations(spark):
    frame = spark.createDataFrame(SHORT, "conv_id long, turn long, role string, text string")
    found = {r["turn"]: (r["n_linked"], r["parent_turn"]) for r in chat.reply_ordered(frame).collect()}
    assert found == {0: (0, None), 1: (0, None), 2: (1, 0), 3: (1, 0), 4: (1, 0), 5: (1, 0), 6: (1, 1), 7: (0, None)}


def plain_links(messages):
    """What ``links`` finds within conversations, on words instead of digests."""
    words = lambda text: tuple(text.encode().lower().split())

    def units(text):
        kinds = [[text], re.split(r"\n[ \t]*\n", text), text.split("\n"), re.split(r"(?<=[.!?])\s+", text)]
        found = {}
        for kind, parts in zip((4, 3, 2, 1), kinds):
            for part in parts:
                if words(part):
                    found.setdefault(words(part), kind)
        return found

    def has(line, part):
        return any(line[k : k + len(part)] == part for k in range(len(line) - len(part) + 1))

    found = {}
    for conv, turn, text in messages:
        earlier = sorted((t, chat.split_message(x)[0]) for c, t, x in messages if c == conv)
        for k, (level, passage) in enumerate(chat.split_message(text)[1]):
            line = words(passage)
            first = lambda holds: next((t for t, x in earlier if holds(x)), None)
            known = lambda t: t is not None and t < turn
            of = {first(lambda x: line in units(x))}
            if not any(map(known, of)):
                size = min(chat.ANCHOR, len(line))
                parts = {line[i : i + size] for i in ((len(line) - size) * k // 3 for k in range(4))}
                of = {first(lambda x: has(words(x), p)) for p in parts}
                of = {t for t in of if known(t) and has(words(dict(earlier)[t]), line)}
            if not any(map(known, of)):
                own = [(len(u) >= 4, kind, first(lambda x: u in units(x))) for u, kind in units(passage).items()]
                of = {max((x for x in own if known(x[2])), default=(0, 0, None))[2]}
            of = [t for t in of if known(t)]
            if of:
                found[conv, turn, k, level] = min(of)
    return found


def test_links_equal_a_plain_version(spark):
    draw = random.Random(11)
    vocabulary = "a b c d e f g Which town is it. No! Yes? the of".split()
    messages, said = [], {}
    for conv in range(12):
        for turn in range(9):
            lines = []
            for _ in range(draw.randrange(3)):
                source = draw.choice([said[conv, t] for t in range(turn)] or ["x y z"]).split()
                start = draw.randrange(len(source) + 1)
                piece = source[start : start + draw.randrange(1, 14)]
                if draw.random() < 0.25:
                    piece.append("changed")
                marker = "> " * draw.randrange(1, 4)
                lines += [marker + " ".join(piece[k : k + 4]) for k in range(0, len(piece), 4)] + [""]
            own = [" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(0, 9))) for _ in range(draw.randrange(1, 4))]
            said[conv, turn] = "\n".join(own)
            messages.append((conv, turn, "\n".join(lines + own)))
    frame = spark.createDataFrame(messages, "conv long, turn long, text string").repartition(3)
    places = chat.parsed(frame, "conv", "turn", "text").select("conv", "turn", "parsed_message.*")
    found = {(r["conv"], r["turn"], r["passage"], r["level"]): r["of_turn"] for r in chat.links(places).collect()}
    expected = plain_links(messages)
    assert len(expected) > 40 and len(set(expected.values())) > 4
    assert found == expected


def test_query_gives_the_conversations_back(spark):
    from tests.compare import connect, differences
    from tests.conftest import SF_SMALL
    from trafficloom.llm.queries import ORACLES, QUERIES

    found = QUERIES["op3_quotation_threads"](spark, SF_SMALL)
    assert differences(found, connect(SF_SMALL), ORACLES["op3_quotation_threads"]) == []
    assert found.agg(F.sum("n_linked")).first()[0] > 100


def test_plan_has_no_cross_join(spark):
    frame = chat.reply_ordered(conversations(spark).withColumn("z", F.lit(1)))
    assert "Cartesian" not in frame._jdf.queryExecution().executedPlan().toString()
