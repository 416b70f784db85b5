import random
import re
from contextlib import contextmanager

import pytest
from cases import SMALL
from pyspark.sql import functions as F

from yearloom.llm import quotes as qt

THREAD = [
    (1, 0, "u", "How do I sort a list in python?\nThanks a lot in advance"),
    (1, 1, "a", "On Monday u wrote:\n> How do I sort a list\n> in python?\nUse sorted and a key."),
    (1, 2, "b", "> > How do I sort a list in python?\n> Use sorted and a key.\nThat makes a copy, beware."),
    (1, 3, "c", "> How do I SORT a list in Python?\nOr call the sort method."),
    (1, 4, "d", "Unrelated new topic here now"),
    (1, 5, "e", "> That makes a copy, beware.\nGood point that is."),
    (2, 0, "u", "> How do I sort a list in python?\nquoted from elsewhere"),
]


def test_levels():
    text = "a\n> b\n>> c\n> > d\n  > e\nx wrote:\n\n> f > g\n1 > 0"
    assert qt.levels(text) == [(0, "a"), (1, "b"), (2, "c"), (2, "d"), (1, "e"), (1, ""), (0, ""), (1, "f > g"), (0, "1 > 0")]


def test_thread_in_reply_order(spark):
    df = spark.createDataFrame(THREAD, "conv_id long, turn int, role string, text string")
    got = {(r.conv_id, r.turn): r for r in qt.unquoted(df).collect()}
    assert [(got[1, t].reply_to, got[1, t].root_turn, got[1, t].position) for t in range(6)] == [
        (None, 0, 0), (0, 0, 1), (1, 0, 2), (0, 0, 3), (None, 4, 5), (2, 0, 4)]
    assert got[1, 1].text == "Use sorted and a key." and got[1, 2].n_quotes == 2
    assert got[2, 0].reply_to is None and got[2, 0].text == "quoted from elsewhere"


def test_long_chain(spark):
    rows = [(1, 0, "u", "message number zero here")]
    rows += [(1, i, "u", f"> message number {'zero' if i == 1 else i - 1} here\nmessage number {i} here") for i in range(1, 40)]
    got = qt.unquoted(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert all(r.root_turn == 0 and r.reply_to == (r.turn - 1 if r.turn else None) and r.position == r.turn for r in got)


@pytest.mark.parametrize("partitions", [1, 3, 64])
def test_positions_over_partitions(spark, partitions):
    rows = [(c, t, "u", f"said {c} {t % 5} words" if t % 3 else f"> said {c} {t % 5} words\nnew {t} words here") for c in (1, 2) for t in range(25)]
    with partitioned(spark, partitions):
        got = qt.unquoted(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    for c in (1, 2):
        own = sorted((r for r in got if r.conv_id == c), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(25))
        assert [(r.root_turn, r.turn) for r in own] == sorted((r.root_turn, r.turn) for r in own)


def test_messages_without_turns_are_spread(spark):
    rows = [(None, None, "u", f"message {k % 40}") for k in range(600)] + [(1, 0, "u", "x")]
    with partitioned(spark, 16):
        messages = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
        got = [r for r in qt.unquoted(messages).collect() if r.conv_id is None]
        widths = qt._positions(*parts(spark, messages)).groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r.position for r in got) == list(range(600))
    assert max(r["count"] for r in widths) < 200


def parts(spark, messages):
    parsed = qt._parsed(messages).withColumn("row", F.monotonically_increasing_id())
    return parsed, qt.chain_starts(qt.reply_links(parsed))


@contextmanager
def partitioned(spark, n):
    """Exchanges of ``n`` partitions that are not joined together."""
    names = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def naive(rows):
    """(conversation, turn) -> reply_to, root, position, quotes, text: each message held against all earlier ones."""
    def runs(text):
        out = []
        for line in text.split("\n"):
            level = 0
            while line.startswith(">"):
                level, line = level + 1, line[1:].removeprefix(" ")
            if not out or out[-1][0] != level:
                out.append((level, []))
            out[-1][1].append(line)
        return out

    def said(lines, quoted):
        """Words of what a run says: the whole, its paragraphs, lines and sentences."""
        whole = "\n".join(lines).strip("\n")
        parts = whole.split("\n\n") + whole.split("\n")
        sentences = [x for part in parts for x in re.split(r"(?<=[.!?])\s+", part)]
        found = {" ".join(re.findall(r"\w+", x.lower())) for x in sentences if len(re.findall(r"\w+", x)) >= 3}
        found |= {" ".join(re.findall(r"\w+", x.lower())) for x in [whole, *(parts if not quoted else [])]}
        found |= {" ".join(re.findall(r"\w+", x.lower())) for x in parts if len(re.findall(r"\w+", x)) >= 3}
        return found - {""}

    out = {}
    for c in {r[0] for r in rows}:
        messages = sorted((t, text) for k, t, _, text in rows if k == c)
        own = {t: "\n".join("\n".join(x).strip("\n") for n, x in runs(text) if not n).strip("\n") for t, text in messages}
        reply = {}
        for t, text in messages:
            votes = {}
            for level in {n for n, _ in runs(text)} - {0}:
                pieces = set().union(*(said(x, True) for n, x in runs(text) if n == level))
                for piece in pieces:
                    first = next((e for e, _ in messages if piece in said(own[e].split("\n"), False)), t)
                    if first < t:
                        votes[level, first] = votes.get((level, first), 0) + len(piece.split())
            reply[t] = min(votes, key=lambda v: (v[0], -votes[v], -v[1]))[1] if votes else None
        root = {}
        for t, _ in messages:
            root[t] = t
            while reply[root[t]] is not None:
                root[t] = reply[root[t]]
        for place, t in enumerate(sorted(root, key=lambda t: (root[t], t))):
            n = sum(level > 0 for level, _ in runs(dict(messages)[t]))
            out[c, t] = (reply[t], root[t], place, n, own[t] if n else dict(messages)[t])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_nested_threads_agree_with_a_plain_search(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)]

    def sentence():
        return " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 6, 8]))) + rng.choice([".", "?", "!", ""])

    rows = []
    for c in range(25):
        texts = []
        for t in range(rng.randint(1, 12)):
            lines = []
            for _ in range(rng.randint(1, 3)):
                if texts and rng.random() < 0.6:  # quotes grow a level each time they are quoted again
                    source = rng.choice(texts).split("\n")
                    a = rng.randrange(len(source))
                    lines += [(">" if x.startswith(">") else "> ") + x for x in source[a:a + rng.randint(1, 3)]]
                if rng.random() < 0.2:
                    lines.append("> " + sentence())
                if rng.random() < 0.8:
                    lines.append(" ".join(sentence() for _ in range(rng.randint(1, 3))))
                if rng.random() < 0.2:
                    lines.append("")
            texts.append("\n".join(lines))
            rows.append((c, t, "u", texts[-1]))
    want = naive(rows)
    got = qt.unquoted(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert {(r.conv_id, r.turn): (r.reply_to, r.root_turn, r.position, r.n_quotes, r.text) for r in got} == want
    assert len(got) == len(rows) and sum(v[0] is not None for v in want.values()) > 30


def test_odd_rows(spark):
    rows = [(1, 6, "f", None, 1), (1, 6, "f", None, 1), (2, 0, "u", "", 1), (None, None, "x", "> not found at all\nhi", 1), (None, 3, "y", "a > b", 1),
            (3, 0, None, "> only quotes here now", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, position int")
    got = sorted((tuple(r) for r in qt.unquoted(df).collect()), key=str)
    assert got == sorted([
        (1, 0, 6, "f", None, 6, 0, None), (1, 1, 6, "f", None, 6, 0, None), (2, 0, 0, "u", None, 0, 0, ""), (None, 0, None, "x", None, -1, 1, "hi"),
        (None, 1, 3, "y", None, 3, 0, "a > b"), (3, 0, 0, None, None, 0, 1, "")], key=str)
    assert qt.unquoted(df.limit(0)).collect() == []


def test_texts_without_quotes_are_unchanged(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    got = qt.unquoted(df)
    plain = df.where("not text like '%>%'")
    joined = got.select("conv_id", "turn", "text").join(plain.withColumnRenamed("text", "own"), ["conv_id", "turn"])
    assert joined.count() == plain.count() and joined.where("text <> own").count() == 0


def test_sentences_and_short_messages_are_found(spark):
    rows = [(1, 0, "u", "It rains a lot here. Shall we go out now? I would like to."), (1, 1, "a", "Why not?"),
            (1, 2, "b", "> Shall we go out now?\nYes, in an hour."), (1, 3, "c", "> Why not?\nIt is wet."),
            (1, 4, "d", "> Why not?\n> a long text from elsewhere\n>>> import this\n> It rains a lot here.\nSo it is.")]
    got = sorted(qt.unquoted(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"), unfound=True).collect(), key=lambda r: r.turn)
    assert [r.reply_to for r in got] == [None, None, 0, 1, 0]
    assert [r.unfound for r in got] == [[], [], [], [], ["Why not?\na long text from elsewhere", "import this"]]
