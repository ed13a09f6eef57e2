import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from touchline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.dictionaries(st.integers(1, 256), st.integers(0, 40), max_size=60))
@settings(max_examples=40, deadline=None)
def test_layout_places_each_piece_once(histogram):
    layout = packing.Layout(histogram, 256, 8)
    length = np.repeat(list(histogram), list(histogram.values())).astype(np.int64)
    rank = np.concatenate([np.arange(n) for n in histogram.values()] or [[]]).astype(np.int64)
    if not len(length):
        return
    sequence, slot = layout.place(length, rank)
    assert len(set(zip(sequence.tolist(), slot.tolist()))) == len(length)
    fill = np.bincount(sequence, length, layout.sequences)
    assert fill.max() <= 256 and fill.min() > 0


def test_nnls_beats_zero_and_is_exact_where_it_can_be():
    a = np.array([[1.0, 0, 1], [0, 2, 1]])

    x = packing.nnls(a, a @ np.array([1.0, 2, 3]))
    assert (x >= 0).all() and a @ x == pytest.approx(a @ np.array([1.0, 2, 3]))


def test_pieces_make_up_the_documents(docs, corpus):
    rows = [(i, t) for i, t, _ in corpus] * 3 + [(None, "null id")]
    got = packing.pack(docs(rows), PATH, 1, with_ids=True).collect()
    plain, texts = Tokenizer.from_file(PATH), dict(rows)
    whole, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert zlib.crc32(bytes(r["ids"])) == r.ids_crc32 and len(r["ids"]) == 4 * r.length
        whole[r.doc_id].append((r.start, bytes(r["ids"])))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, t in texts.items():
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        parts = sorted(whole[i])[:: 1 if i is None else 3]
        assert b"".join(p for _, p in parts) == np.array(ids, "<u4").tobytes()
        assert {r.doc_tokens for r in got if r.doc_id == i} == {len(ids)}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(r.length for r in got)
    assert used / (2048 * len(sequences)) > 0.9


def test_empty_table(docs):
    assert packing.pack(docs([]), PATH, 1).count() == 0
