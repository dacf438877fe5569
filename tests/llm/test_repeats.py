import hashlib
import random

import numpy as np
import pytest

from helpers import LONG, documents, needs_tables, small_documents
from rosterkeep.llm import bwt_merge, repeats


def plain(rows, width=100):
    first = {}
    order = lambda i: (i is None, i or 0)
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for s in range(len(t) - width + 1):
            w = t[s : s + width]
            first[w] = min(first.get(w, (order(i), s)), (order(i), s))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - width + 1):
            if first[t[s : s + width]] < (order(i), s):
                gone[s : s + width] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=str)


def answers(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def passages(seed):
    """Texts put together from passages of about the width, some with a byte changed, and runs of one letter."""
    rng = random.Random(seed)
    letters = "abcdefgh é"
    parts = ["".join(rng.choices(letters, k=rng.randint(60, 260))) for _ in range(12)] + ["ab" * 120, "z" * 300]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.randint(1, 5)):
            part = rng.choice(parts)
            if rng.random() < 0.4:
                at = rng.randrange(len(part))
                part = part[:at] + "#" + part[at + 1 :]
            text += part[rng.randrange(40) :] if rng.random() < 0.3 else part
            text += "".join(rng.choices(letters, k=rng.choice([0, 3, 50])))
        rows.append((rng.randint(0, 10**6), text))
    return rows


@pytest.mark.parametrize("seed,batch,most", [(1, 1 << 22, 3 << 19), (2, 2000, 3 << 19), (3, 2000, 300)])
def test_against_plain(spark, seed, batch, most):
    rows = passages(seed)
    assert answers(repeats.remove_repeats(documents(spark, rows), batch_bytes=batch, most_bytes=most)) == plain(rows)


@pytest.mark.skipif(needs_tables(), reason="no test tables")
def test_test_documents(spark):
    rows = [(i, t) for i, t, _ in small_documents()]
    assert answers(repeats.remove_repeats(documents(spark, rows), batch_bytes=50_000)) == plain(rows)


def test_odd_rows(spark):
    text = "".join(random.Random(5).choices("abcdef", k=400))
    rows = [(3, text), (3, text), (None, text), (1, None), (2, ""), (4, text[:99]), (5, text[:100]), (6, "x" + text[50:] + "y"), (7, text + text)]
    got = repeats.remove_repeats(documents(spark, rows))
    assert answers(got) == plain(rows)
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in got.collect()}
    assert kept[3] == text and kept[7] == "" and kept[6] == "xy" and kept[None] == "" and kept[1] == ""
    assert repeats.remove_repeats(documents(spark, [])).count() == 0


def test_one_long_text(spark):
    got = repeats.remove_repeats(documents(spark, [(1, LONG)])).first()
    period = len("lorem ipsum dolor sit amet ")
    assert got["n_removed"] == len(LONG) - period and got["n_spans"] == 1


@pytest.mark.parametrize("shard", [300, 1000, 10**6])
def test_merged_transforms_find_equal_windows(shard):
    rng = random.Random(shard)
    parts = ["".join(rng.choices("abc", k=rng.choice([100, 120, 140, 181]))).encode() for _ in range(6)]
    strings = [rng.choice(parts)[rng.choice([0, 0, 3]) :] for _ in range(25)] + [b"a" * 150, b"a" * 120]
    data = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8)
    lengths = np.array([len(s) + 1 for s in strings])
    places, block = bwt_merge.equal_windows(data, lengths, 100, shard)
    got, want = {}, {}
    for p, b in zip(places.tolist(), block.tolist()):
        got.setdefault(b, set()).add(p)
    at = 0
    for s in strings:
        for i in range(len(s) - 99):
            want.setdefault(s[i : i + 100], set()).add(at + i)
        at += len(s) + 1
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_merge_keeps_each_shards_order():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 500).astype(np.uint8)
    lengths = np.full(4, 125)
    symbol = np.unique(bwt_merge.symbols(data, np.arange(4) * 125, lengths), return_inverse=True)[1].astype(np.int64)
    a, b = bwt_merge.transform(symbol[:250], 0), bwt_merge.transform(symbol[250:], 250)
    whole, _ = bwt_merge.merge(a, b)
    assert whole.places[whole.places < 250].tolist() == a.places.tolist() and whole.places[whole.places >= 250].tolist() == b.places.tolist()
    assert sorted(whole.places.tolist()) == list(range(500))
