import hashlib
import random

import numpy as np
import pytest

from helpers import LONG, documents, needs_tables, small_documents
from rosterkeep.llm import winnowing as wi

SOME = "It was the best of times, it was the worst of times, it was the age of wisdom; 日本語も少し。 " * 3


def plain(text, gram=wi.GRAM, window=wi.WINDOW):
    """(hash, position) of the least hash of each window, the rightmost of equal ones; each run hashed by itself."""
    grams = [text[i : i + gram] for i in range(max(1, len(text) - gram + 1))] if text else []
    of = {g: int(wi._rolling(np.frombuffer(g.encode("utf-32-le"), np.uint32), len(g))[0]) for g in set(grams)}
    hashes = [of[g] for g in grams]
    kept = []
    for start in range(max(1, len(hashes) - window + 1) if hashes else 0):
        least = min(hashes[start : start + window])
        place = max(i for i in range(start, min(len(hashes), start + window)) if hashes[i] == least)
        if (least, place) not in kept[-1:]:
            kept.append((least, place))
    return kept


def of(text, **options):
    return list(zip(*(x.tolist() for x in wi.fingerprint(text, **options))))


@pytest.mark.parametrize("text", ["", "a", "short", "x" * 10, "x" * 200, SOME, SOME[:39], SOME[:40], "ab" * 100, "\x00\U0001f600é" * 40])
@pytest.mark.parametrize("options", [{}, {"gram": 3, "window": 4}, {"gram": 1, "window": 1}])
def test_windows(text, options):
    assert of(text, **options) == plain(text, **options)


def test_chunks(monkeypatch):
    want = of(SOME * 20)
    for chunk in (1, 7, 64):
        monkeypatch.setattr(wi, "CHUNK", chunk)
        assert of(SOME * 20) == want


def test_shared_runs_are_found():
    """Any shared run of GRAM + WINDOW - 1 code points shares a kept hash, at its positions."""
    r = random.Random(1)
    for _ in range(50):
        run = "".join(r.choices("abcdefgh ", k=wi.GRAM + wi.WINDOW - 1))
        one, two = ("".join(r.choices("ijklmnop ", k=200)) for _ in range(2))
        a, b = one[:50] + run + one[50:], two[:120] + run + two[120:]
        shared = [(i, j) for h, i in of(a) for k, j in of(b) if h == k]
        assert any(50 <= i and i - 50 == j - 120 for i, j in shared)


def test_round_trip():
    hashes, positions = wi.fingerprint(SOME)
    back = wi.from_text(wi.as_text(hashes, positions))
    assert (back[0] == hashes).all() and (back[1] == positions).all() and wi.as_text(*wi.fingerprint("")) == ""


def expected(texts):
    """Rows by id; of equal ids in any order of their texts that is given."""
    out = []
    for k, (i, text) in enumerate(texts):
        text, following = text or "", texts[(k + 1) % len(texts)][1] or ""
        changed = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        marks = [wi.fingerprint(x) for x in (text, changed, following)]
        sets = [set(m[0].tolist()) for m in marks]
        near = [1.0 if not sets[0] and not s else len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), wi.as_text(*marks[0]), wi.as_text(*marks[1]), *near))
    return out


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def compared(df):
    out = wi.compare_edits(df)
    assert out.columns == NAMES
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_successors(spark, partitions):
    texts = [(i, SOME[i % 17 : 30 + 7 * i % 211]) for i in range(60)] + [(200, ""), (300, None), (301, LONG), (302, "x")]
    shuffled = random.Random(3).sample(texts, len(texts))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert compared(documents(spark, shuffled)) == expected(texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_rows(spark):
    assert compared(documents(spark, [])) == []
    assert compared(documents(spark, [(5, SOME)])) == expected([(5, SOME)])
    assert compared(documents(spark, [(None, SOME), (2, "abcdefgh" * 9)])) == expected([(None, SOME), (2, "abcdefgh" * 9)])
    assert compared(documents(spark, [(1, SOME)] * 40)) == expected([(1, SOME)] * 40)
    assert len(compared(documents(spark, [(7, f"{SOME}{i}") for i in range(50)]))) == 50


def test_fingerprints(spark):
    got = {r["doc_id"]: list(zip(r["hashes"], r["positions"])) for r in wi.fingerprints(documents(spark, [(1, SOME), (2, None)])).collect()}
    assert got == {1: plain(SOME), 2: []}


@pytest.mark.skipif(needs_tables(), reason="no test tables")
def test_documents(spark):
    texts = [(i, t) for i, t, _ in small_documents()]
    got = compared(documents(spark, texts))
    assert got == expected(sorted(texts))
    assert np.mean([r[5] > r[6] for r in got]) > 0.9
