import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from rosterkeep.llm import collocations as co

KIND = "doc_id long, text string, lang string, n string, Text string"
NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, top=2000, support=30):
    """Counts of all phrases in one dictionary."""
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())):
            words = re.findall(rb"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    found = {k: a for k, a in counts.items() if a >= support}
    absorbed = set()
    for (lang, w), a in found.items():
        for n in range(2, len(w)):
            absorbed |= {(lang, w[i : i + n]) for i in range(len(w) - n + 1) if 100 * a >= 80 * found[lang, w[i : i + n]]}
    out = []
    for lang in sorted(totals):
        listed = []
        for (of, w), a in found.items():
            if of == lang and len(w) > 1 and (of, w) not in absorbed:
                score, _, left, right = min((2000000 * a // (found[of, w[:k]] + found[of, w[k:]]), k, found[of, w[:k]], found[of, w[k:]]) for k in range(1, len(w)))
                listed.append((-score, -a, b" ".join(w), left, right))
        for rank, (minus, neg, phrase, left, right) in enumerate(sorted(listed)[:top], 1):
            out.append((lang, rank, phrase.decode(), -neg, left, right, totals[lang], -minus))
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], KIND)
    out = co.collocations(df, **options)
    assert out.columns == NAMES
    return sorted(map(tuple, out.collect()))


def texts(n, seed, words=60, lang=("en", "fr", None, "und")):
    r = random.Random(seed)
    vocabulary = [f"W{i}é" if i % 5 == 0 else f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    for i in range(n):
        out = []
        for w in r.choices(vocabulary, weights, k=r.randrange(0, 120)):
            out += [w, r.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", " new york city ", "\x0b", " a:b "])]
        yield i, "".join(out), r.choice(lang)


@pytest.mark.parametrize("blocks", [(4 << 20, 8 << 20, 1 << 20), (300, 500, 64)])
def test_all_phrases(spark, monkeypatch, blocks):
    for name, value in zip(("BLOCK", "LAST_BLOCK", "BUCKET_KEYS"), blocks):
        monkeypatch.setattr(co, name, value)
    rows = list(texts(400, 1))
    want = plain(rows)
    assert len(want) > 80 and any(2 * x[3] > x[4] for x in want)
    assert found(spark, rows) == want
    assert found(spark, rows, top=3) == plain(rows, top=3)


def test_support_reached_over_shards_only(spark):
    """Thirty occurrences, no shard with more than a few of them; and one short of that."""
    rows = [(i, "alpha beta" if i < 30 else "gamma delta" if i < 59 else "other words here", "en") for i in range(200)]
    assert [x[2] for x in found(spark, rows)] == ["other words here", "alpha beta"] and found(spark, rows) == plain(rows)


def test_long_text_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(co, "BLOCK", 64)
    monkeypatch.setattr(co, "LAST_BLOCK", 96)
    rows = [(1, "one two three four five six " * 3000, "en"), (2, "x" * 1000 + " " + "one two. " * 40, "en")]
    assert found(spark, rows) == plain(rows)


def test_overlaps_and_repeats(spark):
    rows = [(7, "na na na na na", "en")] * 20 + [(None, "na na", None)] * 40
    assert found(spark, rows) == plain(rows)


def test_few_bits_let_more_through_only(spark, monkeypatch):
    monkeypatch.setattr(co, "FILTER_BITS", 10)
    rows = list(texts(200, 2))
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, "en"), (2, "", None), (None, " .,;\n", "x")]) == []
    rows = [(1, "日本 語 " * 40 + "\x00 \x1c\x85 " * 40, "ja"), (2, "İ A b c " * 35, "")]
    assert found(spark, rows) == plain(rows)


def test_score_beyond_64_bits(spark):
    """The products of the score, with counts of the size of a large corpus."""
    from pyspark.sql import functions as F

    big = 7 * 10**15
    row = spark.createDataFrame([(big, big + 1, big + 3)], "a long, l long, r long")
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    assert row.select(score).first()[0] == 2000000 * big // (2 * big + 4)


def test_a_block_is_as_many_rows_however_many_phrases_it_has():
    """Counted phrases were a row each, and those are more a text as the corpus grows."""

    class Every:
        value = b"\xff" * (1 << co.FILTER_BITS - 3)

    text = b" ".join(b"w%d" % i for i in range(5000))
    batch = pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array(["en"]), pa.array([text], pa.binary())], names=["shard", "lang", "text"])
    table = pa.Table.from_batches(list(co._counted(Every, 1)(iter([batch]))))
    assert 0 < table.num_rows <= 2**co.ROW_BITS
    found = co._totals(1)(table).to_pylist()
    assert len(found) == 4 * 5000 - 6 and {r["a"] for r in found} == {1}
    assert {(r["phrase"], r["words"]) for r in found} >= {("w7", 1), ("w3 w4 w5 w6", 4)}
