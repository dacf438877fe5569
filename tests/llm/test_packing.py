import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from helpers import LONG, documents, needs_tables, small_documents
from rosterkeep.llm import packing

ODD = ["", "<|endoftext|> a b<|ENDOFTEXT|>c", "\x1c a\x1cb  Ünï̈ ΑΣ ΑΣ.", "'S it's don't", "á ́b", "日本 語123 ½²", "÷÷ é÷", "é… a", "½é½ ab½", "5é6É٣", "áb ab́", "İI ß", "A,b;C!!"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


def test_ids_are_those_of_whole_texts(tokenizer):
    texts = ODD + ([t for _, t, _ in small_documents()] if not needs_tables() else [])
    flat, sizes = packing.Encoder(packing.tokenizer_path()).encode([t.encode() for t in texts])
    assert np.split(flat, np.cumsum(sizes)[:-1])[0].tolist() == []
    for text, own in zip(texts, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
        assert own.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:50]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBé'ß.,1 \n\t…́½日<|>x÷"), max_size=30), max_size=4))
def test_any_text(texts):
    encoder = packing._encoder(packing.tokenizer_path())
    flat, sizes = encoder.encode([t.encode() for t in texts])
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert flat.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_pack_lengths(lengths):
    lengths = np.array(lengths, np.int64)
    sequence, offset, fill = packing.pack_lengths(lengths, 64)
    by = defaultdict(list)
    for s, o, n, f in zip(sequence, offset, lengths, fill):
        by[s].append((o, n, f))
    assert set(by) == set(range(len(by)))
    for rows in by.values():
        at = 0
        for o, n, f in sorted(rows):
            assert o == at
            at += n
        assert at <= 64 and all(f == at for _, _, f in rows)


def test_local_search_raises_squares_and_empties_sequences():
    lengths = np.array([50, 40, 30, 30, 30, 20], np.int64)
    bins = packing.Bins(lengths, 100)
    bins.bin, bins.fill = np.array([0, 1, 0, 1, 2, 2]), np.array([80, 70, 50])
    before = (bins.fill**2).sum()
    bins.improve()
    assert (bins.fill**2).sum() > before and (bins.fill > 0).sum() == 2
    assert np.bincount(bins.bin, weights=lengths, minlength=3).tolist() == bins.fill.tolist()


def test_round_trip(spark, tokenizer):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(90, None), (91, LONG), (0, ""), (None, "no id"), (92, "one two " * 5000)]
    if not needs_tables():
        rows += [(1000 + i, t) for i, t, _ in small_documents()]
    got = packing.pack(documents(spark, rows), group=50).collect()
    fills, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        fills[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for own in fills.values():
        assert [o for o, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1]]
        assert sum(n for _, n in own) <= packing.CAPACITY
    want = defaultdict(list)
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[s : s + 4096], "<u4")
            want[i].append((k, s, len(part), zlib.crc32(part.tobytes())))
    assert {i: sorted(p) for i, p in pieces.items()} == {i: sorted(p) for i, p in want.items()}
    total = sum(r["length"] for r in got)
    assert len(fills) <= -(-total // packing.CAPACITY) + 2


def test_empty(spark):
    assert packing.pack(documents(spark, [])).count() == 0
