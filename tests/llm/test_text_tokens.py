"""Byte-level words against regular expressions, chunked ids against the tokenizers' own."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import ALNUM, NONSPACE, ODD_TEXTS, SMALL, lower
from hypothesis import given, settings
from hypothesis import strategies as st

from yearloom.llm import text as tx
from yearloom.llm import tokens as tk

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB1 .\n\té日🙂'|<>- ", max_size=40)), max_size=8)


@given(TEXTS)
@settings(max_examples=150, deadline=None)
@pytest.mark.parametrize("mask, pattern", [(tx.alnum_mask(), ALNUM), (tx.nonspace_mask(), NONSPACE)])
def test_words_are_those_of_the_pattern(mask, pattern, texts):
    data, offsets = tx.text_bytes(pa.array(texts, pa.string()))
    lowered = tx.lower_table()[data]
    first, last, owner = tx.find_words(lowered, offsets, mask)
    raw = lowered.tobytes()
    got = [[raw[first[k]:last[k]].decode() for k in range(owner[i], owner[i + 1])] for i in range(len(texts))]
    assert got == [pattern.findall(lower(t)) for t in texts]
    hashes = tx.Hasher().ranges(lowered, first, last)
    flat = [w for ws in got for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat))


def test_blocks_keep_all_rows_in_order():
    texts = ["x" * n for n in (0, 5, 30, 1, 1, 100, 0, 7)] + [None]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "n": list(range(9))})
    cut = list(tx.blocks(iter([batch, batch.slice(0, 0)]), limit=10))
    assert [r["n"] for b in cut for r in b.to_pylist()] == list(range(9))
    assert all(b.num_rows == 1 or sum(len(x or "") for x in b.column("text").to_pylist()) <= 10 for b in cut)


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
class TestIds:
    def same(self, encoder, own, texts):
        ids, bounds = encoder.block(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            want = own.encode(text or "", add_special_tokens=False).ids
            assert ids[bounds[i]:bounds[i + 1]].tolist() == want, text

    def test_odd_and_real_texts(self, name, spaced):
        import pyarrow.parquet as pq

        path = public_tokenizers.path(name)
        own, encoder = tk.load(path), tk.Encoder(path, spaced, remembered=2_000)
        self.same(encoder, own, ODD_TEXTS)
        texts = pq.read_table(f"{SMALL}/documents.parquet").column("text").to_pylist()
        for at in range(0, len(texts), 40):  # the memory is emptied on the way
            self.same(encoder, own, texts[at:at + 40])

    @given(texts=TEXTS)
    @settings(max_examples=100, deadline=None)
    def test_any_text(self, name, spaced, texts):
        path = public_tokenizers.path(name)
        self.same(tk.encoder(path, spaced), tk.encoder(path, spaced).tokenizer, texts)


def test_end_follows_every_document():
    ids, bounds = tk.with_end(np.array([5, 6, 7], np.uint32), np.array([0, 2, 2, 3]), 9)
    assert ids.tolist() == [5, 6, 9, 9, 7, 9]
    assert bounds.tolist() == [0, 3, 4, 6]
