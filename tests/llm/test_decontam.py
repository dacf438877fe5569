import hashlib
import re

import pytest
from pyspark.sql import functions as F

from helpers import LONG, documents, lowered
from rosterkeep.llm import decontam

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu é12."


def plain(docs, items, width=10):
    windows = {}
    for item, text in items:
        words = WORD.findall(lowered(text)) if text and item is not None else []
        n = min(width, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        words, hit, found = WORD.findall(lowered(text or "")), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if of := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= of
        out.append((doc_id, len(words), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


DOCS = [
    (1, f"before {ITEM} after"),
    (1, f"before {ITEM} after"),
    (2, ITEM.upper().replace("É", "é")),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (4, "short item here and once more SHORT  item-here"),
    (5, None),
    (6, ""),
    (7, "!!! ..."),
    (8, LONG + ITEM + LONG),
    (9, "alpha beta gamma delta epsilon zeta eta theta iota kappa and mu"),
    (None, ITEM),
]
ITEMS = [(10, ITEM), (9, ITEM + " more"), (10, ITEM), (3, "short item here"), (4, None), (5, ""), (6, "?!"), (None, "before alpha")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_against_plain(spark, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.contamination(documents(spark, DOCS), items, block_bytes=block_bytes).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got), key=str) == plain(DOCS, ITEMS)


def test_empty_tables(spark):
    items, none = spark.createDataFrame(ITEMS, "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(documents(spark, []), items).count() == 0
    assert decontam.contamination(documents(spark, DOCS), none).agg(F.sum("n_hit")).first()[0] == 0


def test_decontaminate(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, DOCS).withColumn("n_chars", F.length("doc_id"))
    docs = documents(spark, DOCS)
    out = decontam.decontaminate(docs, items)
    assert out.columns == docs.columns
    places = [docs.columns.index(c) for c in ("doc_id", "text")]
    got = {r[places[0]]: r[places[1]] for r in out.collect()}
    # Documents that are mostly passage go; null and empty ones, and those without a hit, stay as they are.
    assert set(got) == {3, 5, 6, 7, 8} and got[5] is None and got[6] == "" and got[3] == DOCS[3][1]
    assert got[8] == LONG + "." + LONG
    assert all(n == 0 for _, _, n, _ in plain(list(got.items()), ITEMS))


def test_cut_until_clean(spark):
    words = [f"w{i}" for i in range(10)]
    item = " ".join(words)
    # Cutting the inner passage brings an outer one together.
    text = " ".join(words[:5]) + " " + item + " " + " ".join(words[5:]) + " rest" * 60
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontam.decontaminate(documents(spark, [(1, text)]), items).collect()
    assert "w3" not in left[0][1] and left[0][1].split() == ["rest"] * 60


def test_digest_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_one_worker_a_task(spark):
    """Pipeline: scan and cuts were three Python workers a task, each with the windows."""
    docs = documents(spark, DOCS)
    items = spark.createDataFrame([("i", "a b c")], "item_id string, text string")
    plan = decontam.decontaminate(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
