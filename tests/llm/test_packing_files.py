"""Packing and token files: limits, whole coverage, exact round trips."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import ODD_TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from yearloom.llm import packing, shared, token_files
from yearloom.llm import tokens as tk


@given(st.lists(st.tuples(st.integers(1, 90), st.floats(0, 1)), max_size=40),
       st.tuples(st.integers(4, 40), st.integers(1, 6), st.integers(1, 40)), st.integers(1, 8))
@settings(max_examples=300, deadline=None)
def test_fill_respects_limits_and_places_every_id_once(examples, limits, least):
    tokens = np.array([t for t, _ in examples], np.int64)
    loss = np.array([int(t * f) for t, f in examples], np.int64)
    pieces = packing.fill(tokens, loss, limits, least)
    example, start, length, sequence, offset, bears = pieces.T
    for i, t in enumerate(tokens):
        own = pieces[example == i]
        own = own[np.argsort(own[:, 1])]
        assert own[:, 1].tolist() == np.concatenate([[0], np.cumsum(own[:, 2])[:-1]]).tolist() and own[:, 2].sum() == t
    for s in np.unique(sequence):
        own = pieces[sequence == s]
        own = own[np.argsort(own[:, 4])]
        assert own[:, 4].tolist() == np.concatenate([[0], np.cumsum(own[:, 2])[:-1]]).tolist()
        assert (own[:, 2].sum(), len(own), own[:, 5].sum()) <= (limits[0], 10**9, 10**9)
        assert len(own) <= limits[1] and own[:, 5].sum() <= limits[2]
    for i, a, n, b in zip(example, start, length, bears, strict=True):
        assert b == max(0, a + n - max(tokens[i] - loss[i], a + 1))


def test_little_padding():
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 5_000, 1_500)
    pieces = packing.fill(tokens, tokens - 1, (2048, 128, 2047))
    assert tokens.sum() / 2048 / (pieces[:, 3].max() + 1) > 0.99


def plain_choices(tokens, loss, limits):
    """Whole examples placed one by one: the largest dot product of demands and free shares that fits, larger examples first."""
    left = sorted(((t, b) for t, b in zip(tokens, loss, strict=True)), reverse=True)
    caps, sequences = np.array(limits, float), []
    while left:
        free, own = np.ones(3), []
        while True:
            fits = [(float(np.dot(np.array([t, 1, b]) / caps, free)), -i) for i, (t, b) in enumerate(left)
                    if (np.array([t, 1, b]) / caps <= free + 1e-9).all()]
            if not fits:
                break
            best = max(score for score, _ in fits)
            i = min(-k for score, k in fits if score == best)
            own.append(left.pop(i))
            free = 1 - np.array([sum(t for t, _ in own), len(own), sum(b for _, b in own)]) / caps
        sequences.append(own)
    return sequences


@given(st.lists(st.tuples(st.integers(1, 30), st.floats(0, 1)), max_size=30), st.integers(1, 6), st.integers(5, 31))
@settings(max_examples=150, deadline=None)
def test_choices_are_those_of_a_plain_loop(examples, segments, most):
    tokens = np.array([min(t, most) for t, _ in examples], np.int64)
    loss = np.array([int((t - 1) * f) for t, (_, f) in zip(tokens, examples, strict=True)], np.int64)
    limits = (31, segments, most)
    pieces = packing.fill(tokens, loss, limits, least=1_000)  # no cuts
    got = [[(int(r[2]), int(r[5])) for r in sorted(pieces[pieces[:, 3] == s].tolist(), key=lambda r: r[4])]
           for s in range(int(pieces[:, 3].max(initial=-1)) + 1)]
    assert got == plain_choices(tokens.tolist(), loss.tolist(), limits)


def test_every_limit_binds():
    rng = np.random.default_rng(2)
    tokens = rng.integers(1, 60, 3_000)
    for limits, kind in (((2048, 128, 2048), 0), ((2048, 20, 2048), 1), ((2048, 128, 900), 2)):
        pieces = packing.fill(tokens, tokens - 1, limits)
        n = int(pieces[:, 3].max()) + 1
        used = [np.bincount(pieces[:, 3], pieces[:, 2], n), np.bincount(pieces[:, 3], minlength=n), np.bincount(pieces[:, 3], pieces[:, 5], n)]
        assert np.median(used[kind]) >= 0.99 * limits[kind]


def test_fill_does_not_depend_on_the_split(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = documents(spark, "/root/testdata/sf0.01")
    for parts in (1, 100):
        pieces = packing.pack(docs.repartition(parts), path, 1, (2048, 128, 2040)).toPandas()
        fill = pieces.length.sum() / 2048 / pieces.sequence_id.nunique()
        assert fill > 0.98, parts
        assert pieces.groupby("sequence_id").loss_tokens.sum().max() == 2040


def test_pack_covers_all_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = tk.load(path)
    odd = spark.createDataFrame([(-i, t, 5) for i, t in enumerate(ODD_TEXTS, 1)], "doc_id long, text string, start int")
    docs = documents(spark).selectExpr("doc_id", "text", "1 as start").unionByName(odd)
    pieces = packing.pack(docs.repartition(5), path, 1, (2048, 128, 2040)).toPandas()
    for row in docs.collect():
        ids = np.array(own.encode(row.text or "", add_special_tokens=False).ids + [1], "<u4")
        mine = pieces[pieces.doc_id == row.doc_id].sort_values("start")
        assert mine.length.sum() == len(ids) and (mine.doc_tokens == len(ids)).all()
        at = 0
        for p in mine.itertuples():
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length])
            at += p.length
    for _, s in pieces.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.length.sum() <= 2048 and s.offset.tolist() == [0, *s.length.cumsum()[:-1].tolist()]


def test_pack_repeats_and_empty(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    got = packing.pack(docs, path, 1, (2048, 128, 2047)).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(1, 3), (1, 3), (2, 1)]
    assert packing.pack(docs.limit(0), path, 1, (2048, 128, 2047)).collect() == []


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=60))
@settings(max_examples=200, deadline=None)
def test_codes_round_trip(ranks):
    ranks = np.array(ranks, np.uint32)
    control, data = token_files.encode(ranks)
    assert len(control) == -(-len(ranks) // 4)
    assert token_files.decode(control, data, len(ranks)).tolist() == ranks.tolist()


def test_files_round_trip_and_frequent_ids_take_a_byte():
    ids = np.array([70_000] * 500 + list(range(400)), np.uint32)
    parts = token_files.pack_file(np.array([3, 9]), np.array([500, 400]), ids)
    doc_ids, counts, back, nameless = token_files.unpack_file(b"".join(p.tobytes() for p in parts))
    assert (doc_ids.tolist(), counts.tolist(), back.tolist(), nameless) == ([3, 9], [500, 400], ids.tolist(), 0)
    assert len(parts[-1]) < 1_100
    with pytest.raises(ValueError):
        token_files.unpack_file(b"x" * 64)


def test_token_files_hold_all_documents_in_order(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    own = tk.load(path)
    odd = spark.createDataFrame([(-i, t, "f") for i, t in enumerate(ODD_TEXTS, 1)] + [(7, "again", "f"), (7, "again", "f")],
                                "doc_id long, text string, file string")
    docs = documents(spark).selectExpr("doc_id", "text", "'x' as file").unionByName(odd)
    folder = shared.folder(spark, "test-tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write(docs, folder, path, 2, file_ids=3_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 3
    got = sorted((tuple(r) for r in token_files.read(spark, folder, manifest).collect()), key=lambda r: r[1])
    at = 0
    for row, mine in zip(sorted(docs.collect(), key=lambda r: (r.doc_id, r.text or "")), got, strict=True):
        ids = np.array(own.encode(row.text or "", add_special_tokens=False).ids + [2], "<u4")
        assert mine == (row.doc_id, at, len(ids), zlib.crc32(ids))
        at += len(ids)


def test_token_files_of_nothing(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.round_trip(empty, path, 2).collect() == []


def test_documents_without_id_come_first_by_text(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    own = tk.load(path)
    rows = [(None, f"x {i % 40}") for i in range(300)] + [(None, None), (-5, "a b"), (3, "c"), (3, "b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = shared.folder(spark, "nameless")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write(docs, folder, path, 2, file_ids=200)
        assert manifest.select("part").distinct().count() > 3  # equal ids are dealt over several tasks
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted((tuple(r) for r in token_files.read(spark, folder, manifest).collect()), key=lambda r: r[1])
    at = 0
    for (doc_id, text), mine in zip(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")), got, strict=True):
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert mine == (doc_id, at, len(ids), zlib.crc32(ids))
        at += len(ids)
