import random

import pytest

from helpers import LONG, SMALL, documents, needs_tables
from rosterkeep.llm import quality


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(n=400):
    rng = random.Random(7)
    words = ["".join(rng.choices("aeiourstln", k=rng.randint(2, 8))) for _ in range(800)]
    good = lambda: " ".join(rng.choices(words, k=120)) + "."
    bad = lambda: " | ".join(w.upper() + "!!" for w in rng.choices(words, k=80))
    return [(i, (good if i % 2 else bad)()) for i in range(n)]


def test_good_above_bad(spark):
    rows = corpus()
    docs = documents(spark, rows + [(1000, None), (1001, ""), (None, "text"), (1, rows[1][1]), (1002, LONG)])
    labels = labelled(spark, [(i, i % 2, 0) for i, _ in rows if i < 300] + [(5, None, 0), (6, 7, 0), (None, 1, 0), (99999, 1, 0)])
    got = quality.score(docs, quality.learn(docs, labels)).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r["score"] <= 1 for r in got)
    held = {r["doc_id"]: r["score"] for r in got if r["doc_id"] is not None and r["doc_id"] >= 300}
    assert min(s for i, s in held.items() if i % 2 and i < 400) > max(s for i, s in held.items() if i % 2 == 0 and i < 400)
    assert held[1000] == held[1001]


def test_no_labels(spark):
    docs = documents(spark, corpus(20))
    for rows, share in (([], 0.5), ([(1, 1, 0)], 0.99), ([(1, 0, 0)], 0.01)):
        got = quality.score(docs, quality.learn(docs, labelled(spark, rows))).collect()
        assert {round(r["score"], 6) for r in got} == {share}
    model = quality.learn(documents(spark, []), labelled(spark, [(1, 1, 0), (2, 0, 0)]))
    assert quality.score(documents(spark, []), model).count() == 0


def test_few_labels(spark):
    rows = corpus(12)
    docs = documents(spark, rows)
    got = quality.score(docs, quality.learn(docs, labelled(spark, [(i, i % 2, 0) for i, _ in rows]))).collect()
    assert len(got) == 12 and all(0 <= r["score"] <= 1 for r in got)


@pytest.mark.skipif(needs_tables(), reason="no test tables")
def test_held_out(spark):
    import pyarrow.parquet as pq

    from rosterkeep.llm.queries import QUERIES

    folder = SMALL.replace("0.001", "0.01")
    truth = dict(zip(*(pq.read_table(f"{folder}/labels.parquet")[c].to_pylist() for c in ("doc_id", "quality"))))
    held = [(r["score"], truth[r["doc_id"]]) for r in QUERIES["op10_quality_classifier"](spark, folder).collect() if r["held_out"] and r["doc_id"] in truth]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert len(bad) >= 5 and sum(g > b for g in good for b in bad) > 0.9 * len(good) * len(bad)
