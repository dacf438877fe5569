import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import LONG, SMALL, blank_words, documents, needs_tables, small_documents
from rosterkeep.llm import hmm

END = b""


def tokens(text):
    return blank_words(text) + [END]


def base_of(rows, learns):
    counts = Counter(w for i, t in rows if learns(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return counts, n, lambda w: (counts[w] + 0.5) / (n + 0.5 * (v + 1))


def scored(spark, rows, learns):
    corpus = hmm.count_corpus(documents(spark, rows), learns(F.col("doc_id")))
    model = hmm.train(corpus)
    return corpus, model, hmm.score(corpus, model).collect()


ROWS = [(i, t) for i, t in enumerate(["a b a", "b a b a", "C d", "c d c", "A b", "d c d c"] * 6)]


def test_counts_and_base(spark):
    rows = ROWS + [(100, None), (101, ""), (102, "new a"), (103, LONG), (0, "a b a"), (None, "a")]
    _, n, base = base_of(rows, lambda i: i is None or i < 100)
    counts, _, _ = base_of(rows, lambda i: i is None or i < 100)
    corpus, _, got = scored(spark, rows, lambda i: F.coalesce(i < 100, F.lit(True)))
    assert corpus.train_tokens == n and corpus.distinct == len(counts)
    want = sorted((i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), round(sum(math.log10(base(w)) for w in tokens(t)), 6)) for i, t in rows if i is not None)
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got if r["doc_id"] is not None) == want
    assert all(r["score"] < 0 for r in got)


def test_probabilities_sum_to_one(spark):
    corpus, model, _ = scored(spark, ROWS, lambda i: i < 1000)
    words = [b"a", b"b", b"c", b"d", b"unknown"]
    counts, n, base = base_of(ROWS, lambda i: True)
    # All texts of up to three words, and what longer ones have left, by the classes' recursion.
    top = sorted((-c, w) for w, c in counts.items() if w != END)
    number = {w: k for k, (_, w) in enumerate(top, 1)} | {END: 0, b"unknown": len(corpus.mass) - 1}
    texts = [list(t) + [END] for k in range(4) for t in itertools.product(words, repeat=k)]
    lengths = np.array([len(t) for t in texts])
    flat = np.array([number[w] for t in texts for w in t], np.uint16)
    total = (10 ** model.log10_likelihoods(flat, lengths)).sum()
    longer = np.array([[number[w] for w in t] for t in itertools.product(words, repeat=4)], np.uint16)
    rest = (10 ** model.log10_likelihoods(longer.ravel(), np.full(len(longer), 4))).sum()
    assert total + rest == pytest.approx(1, abs=1e-9)
    assert model.emit.sum(axis=1) == pytest.approx(1) and corpus.mass.sum() == pytest.approx(1)


def test_forward_and_expectations_against_plain_sums():
    rng = np.random.default_rng(2)
    k, c = 3, 5
    normal = lambda x: x / x.sum(axis=-1, keepdims=True)
    model = hmm.Model(normal(rng.random(k)), normal(rng.random(k)), normal(rng.random((k, k))), normal(rng.random((k, c))))
    texts = [rng.integers(0, c, n) for n in (4, 1, 3, 4)]
    lengths = np.array([len(t) for t in texts])
    got = model.log10_likelihoods(np.concatenate(texts).astype(np.uint16), lengths)
    starts, moves, emitted = np.zeros(k), np.zeros((k, k)), np.zeros((c, k))
    for text, found in zip(texts, got):
        weight = {}
        for path in itertools.product(range(k), repeat=len(text)):
            p = model.start[path[0]] * model.emit[path[0], text[0]]
            for a, b, x in zip(path, path[1:], text[1:]):
                p *= model.move[a, b] * model.emit[b, x]
            weight[path] = p
        total = sum(weight.values())
        assert found == pytest.approx(math.log10(total))
        for path, p in weight.items():
            starts[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
            for s, x in zip(path, text):
                emitted[x, s] += p / total
    *sums, likelihood = model.expected(np.concatenate(texts).astype(np.uint16), lengths)
    for a, b in zip(sums, (starts, moves, emitted)):
        assert a == pytest.approx(b)
    assert likelihood == pytest.approx(got.sum())


def test_long_texts_are_cut_for_training_only():
    rng = np.random.default_rng(3)
    model = hmm.Model(*(x / x.sum(axis=-1, keepdims=True) for x in (rng.random(4), rng.random(4), rng.random((4, 4)), rng.random((4, 6)))))
    lengths = np.array([1000, 64, 65, 1])
    starts, moves, emitted, _ = model.expected(rng.integers(0, 6, lengths.sum()).astype(np.uint16), lengths)
    assert starts.sum() == pytest.approx(4) and emitted.sum() == pytest.approx(lengths.sum())
    # Also the moves from one segment to the next.
    assert moves.sum() == pytest.approx(lengths.sum() - len(lengths))


def test_nothing_to_learn_from(spark):
    _, model, got = scored(spark, [(1, "a b"), (2, None)], lambda i: i < 0)
    assert model is None and sorted((r["doc_id"], r["n_known"], r["base_score"], r["score"]) for r in got) == [(1, 0, 0.0, 0.0), (2, 0, 0.0, 0.0)]
    assert scored(spark, [], lambda i: i < 0)[2] == []


@pytest.mark.skipif(needs_tables(), reason="no test tables")
def test_held_out_texts_score_above_the_base(spark):
    from rosterkeep.llm.queries import QUERIES

    got = QUERIES["op6_hidden_markov_scores"](spark, SMALL).collect()
    rows = [(i, t) for i, t, _ in small_documents()]
    counts, n, base = base_of(rows, lambda i: zlib.crc32(str(i).encode()) % 5 != 1)
    texts = dict(rows)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) and r["train_tokens"] == n
        own = tokens(texts[r["doc_id"]])
        assert r["base_score"] == pytest.approx(sum(math.log10(base(w)) for w in own)) and r["n_known"] == sum(counts[w] > 0 for w in own)
    held = [r for r in got if r["held_out"]]
    # Unknown words, of which so few texts hold many, cost what they cost the base; the gain is in the known ones.
    assert sum(r["score"] for r in held) > 0.997 * sum(r["base_score"] for r in held)
    assert sum(r["score"] for r in got) > 0.99 * sum(r["base_score"] for r in got)


@pytest.mark.skipif(needs_tables(), reason="no test tables")
def test_nonsense_ranks_last_and_states_help(spark):
    """Invented words score below every document, at the base; held-out texts of known words gain over it."""
    from rosterkeep.llm.common import table

    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    words = "zqxj vkrw pplk qqzz jjxw wvut kkxq zzpf".split()
    junk = spark.createDataFrame([(-k, " ".join(f"{w}{k}{i}" for i in range(25) for w in words)) for k in (1, 2, 3)], docs.schema)
    corpus = hmm.count_corpus(docs.unionByName(junk), (F.col("doc_id") > 0) & (F.col("doc_id") % 5 != 1))
    got = hmm.score(corpus, hmm.train(corpus)).collect()
    per_token = {r["doc_id"]: r["score"] / r["n_tokens"] for r in got}
    assert max(per_token[-k] for k in (1, 2, 3)) < min(p for i, p in per_token.items() if i > 0)
    known = [r for r in got if not r["train"] and r["n_known"] == r["n_tokens"]]
    assert known and sum(r["score"] for r in known) > 0.95 * sum(r["base_score"] for r in known)
    held = [r for r in got if not r["train"] and r["doc_id"] > 0]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)


def test_hot_word(spark):
    """Counts are joined back by a join that can be split; no window over words."""
    from rosterkeep.llm.common import join_reduced

    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "word string, n int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_reduced(df, df.groupBy("word").agg(F.sum("n").alias("c")), ["word"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(word") >= 3
        assert sorted(map(tuple, out.collect())) == [("a", 1, 3), ("a", 2, 3), ("b", 3, 3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
