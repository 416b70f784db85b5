"""Quotation linking: conversations in reply order, without the quotes.

A line's quote level is the number of ``>`` before it.  A quoted passage (a run of lines of
one level, its paragraphs, lines and sentences) is normalised to its words and hashed; the hash is
joined to the first earlier message of the conversation that wrote the passage itself.  The
message that most words of the outermost quotes come from is the one replied to.  Replies
follow the message their chain starts with, in the order of turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearloom.llm import shared

#: Words a passage needs to be looked for; shorter ones are said by many, so they must be
#: all of a quoted run and all of a message, paragraph or line.
LEAST_WORDS = 3

#: Rounds of following chains, each twice as long as the one before.
MOST_ROUNDS = 60

MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
ATTRIBUTION = re.compile(r"(?:wrote|writes|said|schrieb|écrit|a écrit|escribió) ?:$", re.IGNORECASE)
WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?…])[\s\"'”’)]+")


def levels(text: str) -> list[tuple[int, str]]:
    """Quote level and rest of each line; a line that only introduces a quote counts to it."""
    lines = []
    for line in text.split("\n"):
        found = MARKS.match(line)
        lines.append((found[1].count(">"), line[found.end():]) if found else (0, line))
    following = 0  # the level of the next line that is not empty
    for k in reversed(range(len(lines))):
        level, line = lines[k]
        if following > level and ATTRIBUTION.search(line.strip()):
            lines[k] = (following, "")
        elif level or line.strip():
            following = level
    return lines


def passages(lines: list[str], quoted: bool = False) -> dict[int, int]:
    """Hashes of a run of lines, its paragraphs, lines and sentences, with their numbers of words."""
    whole = "\n".join(lines)
    parts = {*whole.split("\n\n"), *lines}
    sentences = {x for part in parts for x in SENTENCE.split(part)}
    out = {}
    for piece in {whole, *parts, *sentences}:
        words = WORD.findall(piece.lower())
        short = piece == whole or (not quoted and piece in parts)
        if len(words) >= (1 if short else LEAST_WORDS):
            out[_digest(" ".join(words))] = len(words)
    return out


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def parse(text: str) -> tuple[str, list[tuple[str, list[int]]], list[tuple[int, int, int]]]:
    """The text without quotes, the quoted runs with their hashes, and (level, hash, words) of all passages."""
    runs: list[tuple[int, list[str]]] = []
    for level, line in levels(text):
        if not runs or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(line)
    own = "\n".join("\n".join(lines).strip("\n") for level, lines in runs if level == 0).strip("\n")
    found = {(0, h): n for h, n in passages(own.split("\n")).items()}
    quoted = []
    for level, lines in runs:
        if level:
            own_hashes = passages("\n".join(lines).strip("\n").split("\n"), quoted=True)
            found |= {(level, h): n for h, n in own_hashes.items()}
            quoted.append(("\n".join(lines), list(own_hashes)))
    return own if len(runs) > 1 or (runs and runs[0][0]) else text, quoted, [(a, b, n) for (a, b), n in found.items()]


MESSAGES = "conv_id long, turn long, role string, text string, n_quotes int, c string, t long, " \
    "found array<struct<level: int, hash: long, words: int>>, quoted array<struct<text: string, key: long, hashes: array<long>>>"


def _parsed(conversations: DataFrame) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("words", pa.int32())]))
        runs = pa.list_(pa.struct([("text", pa.string()), ("key", pa.int64()), ("hashes", pa.list_(pa.int64()))]))
        for batch in batches:
            done = [parse(x) if x else (x, [], []) for x in batch.column("text").to_pylist()]
            found = [[{"level": a, "hash": h, "words": n} for a, h, n in x[2]] for x in done]
            quoted = [[{"text": a, "key": _digest(a), "hashes": h} for a, h in x[1]] for x in done]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "turn", "role")), pa.array([x[0] for x in done], pa.string()),
                 pa.array([len(x[1]) for x in done], pa.int32()), batch.column("c"), batch.column("t"), pa.array(found, kind),
                 pa.array(quoted, runs)],
                names=["conv_id", "turn", "role", "text", "n_quotes", "c", "t", "found", "quoted"])

    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), "text",
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")).alias("c"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("t")).mapInArrow(task, MESSAGES)


def _passages(messages: DataFrame) -> DataFrame:
    return messages.select("c", "t", F.explode("found").alias("f")).select("c", "t", "f.*")


def _originals(messages: DataFrame) -> DataFrame:
    """The first message of a conversation that wrote each passage itself."""
    return _passages(messages).where("level = 0").groupBy("c", "hash").agg(F.min("t").alias("original"))


def found_runs(messages: DataFrame) -> DataFrame:
    """(c, t, keys): the quoted runs of a message of which any passage has an original."""
    runs = messages.select("c", "t", F.explode("quoted").alias("q")).select("c", "t", "q.key", F.explode("q.hashes").alias("hash"))
    return runs.join(_originals(messages), ["c", "hash"]).where("original < t").groupBy("c", "t").agg(F.collect_set("key").alias("keys"))


def reply_links(messages: DataFrame) -> DataFrame:
    """(c, t, reply_to) of the messages with a quote whose original is found."""
    quoted = _passages(messages).where("level > 0").join(_originals(messages), ["c", "hash"]).where("original < t")
    votes = quoted.groupBy("c", "t", "level", "original").agg(F.sum("words").alias("words"))
    best = F.min(F.struct("level", (-F.col("words")).alias("words"), (-F.col("original")).alias("original")))
    return votes.groupBy("c", "t").agg(best.alias("best")).select("c", "t", (-F.col("best.original")).alias("reply_to"))


def chain_starts(links: DataFrame) -> DataFrame:
    """(c, t, reply_to, root): the message each reply's chain starts with, by following ever longer steps."""
    current = shared.stored(links.withColumn("root", F.col("reply_to")), "replies")
    for _ in range(MOST_ROUNDS):
        further = current.select("c", F.col("t").alias("root"), F.col("root").alias("next"))
        moved = current.join(further, ["c", "root"], "left")
        current = shared.stored(moved.select("c", "t", "reply_to", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "replies")
        if current.where("moved").isEmpty():
            return current.drop("moved")
        current = current.drop("moved")
    raise RuntimeError("reply chains did not settle")


def _positions(messages: DataFrame, chains: DataFrame) -> DataFrame:
    """(row, reply_to, root, position): places 0, 1, .. of a conversation's messages by (root, turn), however many it has.

    They come from a distributed sort of the keys, stored so that it cannot change: a message's
    number in its partition, plus the conversation's messages in earlier partitions.  Messages
    of one turn are told apart by hash and row, so that a conversation without turns, too, is
    spread over partitions.
    """
    rows = messages.select("c", "t", "row", F.xxhash64("role", "text").alias("tie")).join(chains, ["c", "t"], "left")
    rows = shared.stored(rows.withColumn("root", F.coalesce("root", "t")), "placed")
    keys = ["c", "root", "t", "tie", "row"]
    ranked = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("c", "row", "reply_to", "root", F.monotonically_increasing_id().alias("at"))
    ranked = shared.stored(ranked, "ranked").withColumn("part", F.shiftright("at", 33))
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = ranked.groupBy("c", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    bases = pieces.select("c", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return ranked.join(bases, ["c", "part"]).select("row", "reply_to", "root", (F.col("at") - F.col("first") + F.col("base")).alias("position"))


def unquoted(conversations: DataFrame, unfound: bool = False) -> DataFrame:
    """One row per message: conv_id, position, turn, role, reply_to, root_turn, n_quotes, text.

    ``text`` is the message without its quotes and the lines that introduce them; ``reply_to``
    the turn of the message it quotes, null if none is found; ``root_turn`` the turn its chain
    of replies starts with, its own without one; ``position`` counts from 0 without gaps by
    root_turn and turn, ties by a hash of role and text.  Null texts stay null; null turns count as -1 and null conversations
    as one; repeated rows and rows of one turn are messages of their own, which share
    reply_to; an empty table gives an empty result.  Other columns are not read.  With
    ``unfound`` a last column of that name holds the quoted runs, without their marks, of
    which no passage has an original.
    """
    messages = shared.stored(_parsed(conversations).withColumn("row", F.monotonically_increasing_id()), "messages")
    places = _positions(messages, chain_starts(reply_links(messages)))
    columns = ["conv_id", "position", "turn", "role", "reply_to", F.col("root").alias("root_turn"), "n_quotes", "text"]
    if unfound:
        lost = F.filter("quoted", lambda q: ~F.coalesce(F.array_contains("keys", q["key"]), F.lit(False)))
        messages = messages.join(found_runs(messages), ["c", "t"], "left").withColumn("unfound", F.transform(lost, lambda q: q["text"])).drop("keys")
        columns.append("unfound")
    return messages.drop("found", "quoted", "c", "t").join(places, "row").select(*columns)
