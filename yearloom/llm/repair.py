"""Conversation structure repair: cheapest edits, ties by the least audit, found by prefix doubling.

A conversation is well formed if its role initials read ``(s?(ua)+)?``.  Messages are kept
(K), given another role (R) or deleted (D), empty messages are inserted (I); the edits'
letters in order are the audit.  A cost DP runs from the last message to the first.  The
arcs that reach its optimum are then ranked by their audits' first 1, 2, 4, .. letters, as
suffixes are in prefix doubling; the ranks choose the first arc of the least path, and the
doubled pointers spell it out.  Rows travel without their texts until the audit is known;
then texts stream past it in order, so no task holds the texts of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Costs of the edits, and of leaving a truncated message.
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5

#: Rows of conversations worked on together; a longer conversation is worked on alone.
ROWS_TOGETHER = 50_000

SPACES = " \t\n\x0b\f\r"
NO_COST = 1 << 40

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the only role an inserted or rerolled message may have.
NEXT = np.array([USER, USER, ASSISTANT, USER])
ROLE_OF = {USER: b"user", ASSISTANT: b"assistant"}
#: Audit letters in ASCII order; 0 stands for the end.
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _shown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def messages(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (1): what the operator reads; null roles and texts are one space."""
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), _shown("role").alias("role"),
                                _shown("text").alias("text"), F.lit(1).alias("copies"))


def damaged(conversations: DataFrame) -> DataFrame:
    """`messages` with damage by crc32 of ``conv_id:turn`` modulo 20 (nulls are one space there too).

    0 drops the row (copies 0), 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it
    (copies 2), 4 gives it the role user.  Dropped rows stay for their conv_id.
    """
    kind = F.crc32(F.concat(_shown("conv_id"), F.lit(":"), _shown("turn"))) % 20
    return messages(conversations).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with the digest that orders equal turns and finds repeats, and what their texts say."""
    end = F.rtrim("text", F.lit(SPACES))
    return rows.select(
        "*", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")).alias("same"),
        (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"))


def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *before, "turn", "role", "same")


# --- audits of many conversations at once ---------------------------------------

def _arcs(initial: np.ndarray, must: np.ndarray, cut: np.ndarray):
    """Edits of rows: per letter, the states they lead to and their costs, both rows x 4."""
    n = len(initial)
    states = np.broadcast_to(np.arange(4), (n, 4))
    left = np.where(cut, LEFT_TRUNCATED, 0)[:, None]
    fits = (initial[:, None] == NEXT) | ((initial[:, None] == SYSTEM) & (states == START))
    keep = np.where(fits & ~must[:, None], left, NO_COST)
    rerole = np.where(must[:, None], NO_COST, left + REROLE)
    return {"D": (states, np.full((n, 4), DELETE)), "K": (np.where(fits, initial[:, None], 0), keep),
            "R": (np.broadcast_to(NEXT, (n, 4)), np.broadcast_to(rerole, (n, 4)))}


def _costs_to_go(arcs: dict, bounds: np.ndarray) -> np.ndarray:
    """Cheapest cost from each position and state to a legal end; a conversation has one position more than rows."""
    conversations, lengths = len(bounds) - 1, np.diff(bounds)
    places = bounds[:-1] + np.arange(conversations)
    go = np.full((int(bounds[-1]) + conversations, 4), NO_COST, np.int64)
    go[places + lengths] = [0, 2 * INSERT, INSERT, 0]
    order = np.argsort(-lengths, kind="stable")
    longer = conversations - np.searchsorted(np.sort(lengths), np.arange(1, lengths.max(initial=0) + 1))
    for back, active in enumerate(longer.tolist(), 1):
        own = order[:active]
        row, place = bounds[own + 1] - back, places[own] + lengths[own] - back
        base = np.full((active, 4), NO_COST, np.int64)
        for to, cost in arcs.values():
            base = np.minimum(base, cost[row] + np.take_along_axis(go[place + 1], to[row], 1))
        go[place] = np.minimum(base, np.minimum(base[:, NEXT] + INSERT, base[:, NEXT[NEXT]] + 2 * INSERT))
    return go


def audits(bounds: np.ndarray, initial: np.ndarray, must: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cost, letters, bounds of letters) of conversations ``bounds[i]:bounds[i + 1]`` of rows.

    ``initial`` holds the state a role's initial stands for (0: none), ``must`` rows that
    have to go, ``cut`` truncated ones.
    """
    arcs = _arcs(initial, must, cut)
    go = _costs_to_go(arcs, bounds)
    conversations, lengths = len(bounds) - 1, np.diff(bounds)
    places = bounds[:-1] + np.arange(conversations)
    row_place = np.arange(len(initial)) + np.repeat(np.arange(conversations), lengths)
    # Optimal arcs, four letters a node in ASCII order; a legal end leads to itself under letter 0.
    nodes = go.size
    letter, head = np.zeros((nodes, 4), np.int8), np.full((nodes, 4), -1, np.int64)
    for slot, name in ((0, "D"), (2, "K"), (3, "R")):
        to, cost = arcs[name]
        best = cost + np.take_along_axis(go[row_place + 1], to, 1) == go[row_place]
        which = (row_place[:, None] * 4 + np.arange(4))[best]
        head[which, slot] = ((row_place[:, None] + 1) * 4 + to)[best]
        letter[which, slot] = slot + 1
    insert = (go[:, NEXT] + INSERT == go).ravel()
    which = np.flatnonzero(insert)
    head[which, 1], letter[which, 1] = which // 4 * 4 + NEXT[which % 4], 2
    ends = ((places + lengths)[:, None] * 4 + [START, ASSISTANT]).ravel()
    head[ends, 0], letter[ends, 0] = ends, 0
    arc_of = np.flatnonzero(head.ravel() >= 0)
    letter, head = letter.ravel()[arc_of], head.ravel()[arc_of]
    opens = np.searchsorted(arc_of, np.arange(nodes + 1) * 4)
    # A node's arcs have different letters, so one letter decides which arc follows; ranks of 2^k letters.
    jump = opens[head]
    rank, jumps, starts = letter.astype(np.int64), [], opens[places * 4]
    ending = letter == 0
    while True:
        pair = rank * (rank.max(initial=0) + 1) + rank[jump]
        rank = np.unique(pair, return_inverse=True)[1]
        jumps.append(jump)
        following = jump[jump]
        first = _least(rank, opens, places * 4)
        if ending[jump[first]].all():
            starts = first
            break
        jump = following
    path = starts[:, None]
    for jump in jumps:
        path = np.concatenate([path, jump[path]], axis=1)
    letters = letter[path]
    used = letters > 0
    return go[places, START], LETTERS[letters[used]], np.concatenate([[0], np.cumsum(used.sum(1))])


def _least(rank: np.ndarray, opens: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The arc of least rank out of each node."""
    best = opens[nodes]
    for step in range(1, 4):
        other = opens[nodes] + step
        there = other < opens[nodes + 1]
        other = np.where(there, other, best)
        best = np.where(rank[other] < rank[best], other, best)
    return best


# --- reports ---------------------------------------------------------------------

def _change(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before; nulls are equal to each other."""
    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.concatenate([[True], codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, bool)


def whole_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in tables of whole conversations, about `ROWS_TOGETHER` rows each."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < ROWS_TOGETHER:
            continue
        last = int(np.flatnonzero(_change(batch.column("conv_id")))[-1])
        if last == 0 and (
                len(held) == 1 or held[-2].column("conv_id")[-1].as_py() == batch.column("conv_id")[0].as_py()):
            continue  # one conversation up to here
        yield pa.Table.from_batches([*held[:-1], batch.slice(0, last)])
        held, rows = [batch.slice(last)], batch.num_rows - last
    if rows:
        yield pa.Table.from_batches(held)


def _turn_gaps(turns: np.ndarray, known: np.ndarray, owner: np.ndarray, conversations: int) -> np.ndarray:
    """Turns missing between the first and the last of each conversation; rows come in order of turns."""
    turns, owner = turns[known], owner[known]
    gaps = np.zeros(conversations, object)
    if len(turns):
        new = np.concatenate([[True], (turns[1:] != turns[:-1]) | (owner[1:] != owner[:-1])])
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        last = np.concatenate([first[1:], [len(owner)]]) - 1
        span = turns[last].astype(object) - turns[first].astype(object) + 1
        gaps[owner[first]] = span - np.add.reduceat(new.astype(np.int64), first)
    return np.minimum(gaps, 2**63 - 1).astype(np.int64)


def _reported(table: pa.Table) -> pa.RecordBatch:
    """One row per conversation of a table of whole ones."""
    ids = table.column("conv_id").combine_chunks()
    opens = np.flatnonzero(_change(ids))
    conversations = len(opens)
    copies = table.column("copies").to_numpy().astype(np.int64)
    every = np.repeat(np.arange(len(copies)), copies)
    owner = (np.searchsorted(opens, np.arange(len(copies)), side="right") - 1)[every]
    bounds = np.searchsorted(owner, np.arange(conversations + 1))

    initial = np.zeros(len(copies), np.int64)
    names = table.column("initial").combine_chunks().dictionary_encode()
    for state, name in ((SYSTEM, "s"), (USER, "u"), (ASSISTANT, "a")):
        at = names.dictionary.to_pylist()
        if name in at:
            initial[names.indices.to_numpy() == at.index(name)] = state
    initial = initial[every]
    blank, cut = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False).astype(bool)[every] for c in ("blank", "cut"))
    same = table.column("same").combine_chunks().dictionary_encode()
    key = owner * max(1, len(same.dictionary)) + same.indices.to_numpy()[every]
    seen = np.ones(len(every), bool)
    seen[np.unique(key, return_index=True)[1]] = False
    repeated, truncated = seen & ~blank, cut & ~seen & ~blank

    following = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = initial[following] * 4 + initial[following + 1]
    legal = np.isin(pairs, [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])

    def count(flags: np.ndarray, of: np.ndarray = owner) -> np.ndarray:
        return np.bincount(of[flags], minlength=conversations).astype(np.int64)

    turn = table.column("turn").combine_chunks()
    known = turn.is_valid().to_numpy(zero_copy_only=False)[every]
    turns = turn.fill_null(0).to_numpy(zero_copy_only=False)[every]
    cost, audit = np.zeros(conversations, np.int64), np.full(conversations, b"", object)
    classes = np.array([int(n).bit_length() for n in np.diff(bounds)])
    for size in np.unique(classes[classes > 0]).tolist():
        own = np.flatnonzero(classes == size)
        lengths = np.diff(bounds)[own]
        own_bounds = np.concatenate([[0], np.cumsum(lengths)])
        rows = np.repeat(bounds[own] - own_bounds[:-1], lengths) + np.arange(own_bounds[-1])
        cost[own], letters, at = audits(own_bounds, initial[rows], (blank | repeated)[rows], truncated[rows])
        spelled = letters.tobytes()
        audit[own] = [spelled[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    columns = [_turn_gaps(turns, known, owner, conversations), count(blank), count(repeated), count(truncated),
               count(~legal, owner[following]), cost]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(opens)), *map(pa.array, columns), pa.array([a.decode() for a in audit], pa.string())],
        names=["conv_id", *COUNTS, "audit"])


def report(rows: DataFrame) -> DataFrame:
    """Faults and cheapest edits of each conversation of `messages` (or `damaged`) rows.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit, one row per
    conv_id; rows without conv_id are one conversation.  Rows go by turn, nulls first, then
    role, then the digest of role and text, so repeated rows are adjacent.  Their first fault
    counts: blank, else duplicate (role and text seen earlier), else truncated.  Conversations
    whose rows were all dropped have zeros and an empty audit.  An empty table gives none.
    """
    schema = T.StructType([rows.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in COUNTS),
                           T.StructField("audit", T.StringType())])
    light = _marked(rows).select("conv_id", "turn", "role", F.substring("role", 1, 1).alias("initial"), "copies", "same",
                                 "blank", "cut")

    def reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_conversations(batches):
            yield _reported(table)

    return _in_order(light).mapInArrow(reported, schema)


class Repaired:
    """Follows an audit past the rows of a conversation and hands out the lines that stay."""

    def __init__(self, audit: str, line: Callable[[bytes, bytes, str], None]):
        self.audit, self.line, self.at, self.state = audit, line, 0, START

    def _write(self, role: bytes | None, text: bytes, edit: str) -> None:
        if role is None:
            self.state = int(NEXT[self.state])
            role = ROLE_OF[self.state]
        else:
            self.state = {b"s": SYSTEM, b"u": USER, b"a": ASSISTANT}[role[:1]]
        self.line(role, text, edit)

    def inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._write(None, b"", "I")

    def row(self, role: bytes, text: bytes) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._write(role if edit == "K" else None, text, edit)


def _streamed(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's report, then its rows in order, in one partition."""
    empty = {f.name: F.lit(None).cast(f.dataType) for f in reports.schema if f.name != "conv_id"}
    texts = _marked(rows).where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "same", F.col("text").cast("binary").alias("text"), "copies",
        *[c.alias(n) for n, c in empty.items()])
    heads = reports.select("conv_id", F.lit(0).alias("kind"), *[
        F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in ("turn", "role", "same", "text", "copies")], *empty)
    return _in_order(heads.unionByName(texts), "kind").withColumn("role", F.col("role").cast("binary"))


def _followed(batches: Iterator[pa.RecordBatch], begin, line, close) -> Iterator[None]:
    """Runs the audits past the rows and pauses after each batch; ``begin`` gets a conversation's
    report as a dict, ``close`` is called at its end."""
    current = None
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        texts, roles, copies = batch.column("text"), batch.column("role"), batch.column("copies")
        for i, kind in enumerate(kinds.tolist()):
            if kind == 0:
                if current is not None:
                    current.inserted()
                    close()
                head = {name: batch.column(name)[i].as_py() for name in ("conv_id", *COUNTS, "audit")}
                begin(head)
                current = Repaired(head["audit"], line)
            else:
                for _ in range(copies[i].as_py()):
                    current.row(roles[i].as_py(), texts[i].as_py())
        yield
    if current is not None:
        current.inserted()
        close()
        yield


def repaired(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The messages that stay: conv_id, place (from 0), role, text, edit (K, R or I)."""
    schema = T.StructType([rows.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("edit", T.StringType())])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, now, kind = [], {}, None

        def seen(stream):
            nonlocal kind
            for batch in stream:
                kind = batch.schema.field("conv_id").type
                yield batch

        def begin(head):
            now.update(id=head["conv_id"], place=0)

        def line(role, text, edit):
            lines.append((now["id"], now["place"], role, text, edit))
            now["place"] += 1

        for _ in _followed(seen(batches), begin, line, lambda: None):
            if lines:
                ids, places, roles, texts, edits = zip(*lines, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, kind), pa.array(places, pa.int64()), pa.array(roles, pa.binary()).cast(pa.string()),
                     pa.array(texts, pa.binary()).cast(pa.string()), pa.array(edits, pa.string())], names=schema.names)
                lines.clear()

    return _streamed(rows, reports).mapInArrow(written, schema)


def digests(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The reports with repaired_sha256: of the repaired ``role:text`` lines, joined by line feeds.

    A digest is one chain over its conversation, so one task makes it; the texts only pass by.
    """
    schema = T.StructType([*reports.schema, T.StructField("repaired_sha256", T.StringType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, kinds = [], {}, None

        def seen(stream):
            nonlocal kinds
            for batch in stream:
                kinds = [batch.schema.field(c).type for c in schema.names[:-1]]
                yield batch

        def begin(head):
            now.update(head=head, sum=hashlib.sha256(), lines=0)

        def line(role, text, _):
            now["sum"].update(b"\n" * bool(now["lines"]) + role + b":")
            now["sum"].update(text)
            now["lines"] += 1

        def close():
            done.append((*now["head"].values(), now["sum"].hexdigest()))

        for _ in _followed(seen(batches), begin, line, close):
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*done, strict=True), [*kinds, pa.string()], strict=True)],
                    names=schema.names)
                done.clear()

    return _streamed(rows, reports).mapInArrow(hashed, schema)


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """Damages conversations, repairs them and returns their reports with the digests of the repaired ones."""
    rows = damaged(conversations)
    return digests(rows, report(rows))
