import random

import pytest
from pyspark.sql import functions as F

from helpers import LONG, documents, lines_to_drop, needs_tables, small_documents
from rosterkeep.llm import line_dedup


def dropped(spark, rows):
    return {(r["doc_id"], r["line_no"]) for r in line_dedup.dropped_lines(documents(spark, rows)).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    lines = []
    for _ in range(60):
        words = rng.choices("a b c d e f".split(), k=rng.randint(4, 9)) if rng.random() < 0.5 else rng.choices([f"w{i}" for i in range(50)], k=rng.randint(5, 30))
        for _ in range(rng.randint(1, 5)):
            lines.append(rng.choice(["", " ", "\t"]) + rng.choice([" ", "  "]).join(words))
            words = list(words)
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = rng.choices(["new", "a", "b"], k=rng.randint(0, 1))
            words = words or ["x"]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i::10])) for i in range(10)]
    assert dropped(spark, rows) == lines_to_drop(rows)


@pytest.mark.skipif(needs_tables(), reason="no test tables")
def test_test_documents(spark):
    rows = [(i, t) for i, t, _ in small_documents()]
    assert dropped(spark, rows) == lines_to_drop(rows)


def test_odd_rows(spark):
    line = "one two three four five"
    rows = [(5, line), (1, None), (2, ""), (3, "\n\n \n"), (4, f"{line}\nshort\nshort\nONE  two three four five\r"), (None, line), (9, LONG), (8, LONG + "x"), (7, line.replace("two", "2"))]
    assert dropped(spark, rows) == lines_to_drop([r for r in rows if r[0] is not None]) == {(4, 2), (4, 3), (5, 0), (7, 0), (9, 0)}
    # The same row twice is one document.
    assert dropped(spark, [(1, line), (1, line), (2, line)]) == {(2, 0)}
    assert dropped(spark, []) == set()


def test_report_and_documents(spark):
    line = "one two three four five"
    rows = [(1, f"{line}\nother words"), (2, line), (3, f"keep\n{line} six\n\nend"), (4, None), (5, ""), (None, line)]
    docs = documents(spark, rows)
    got = {r["doc_id"]: tuple(r)[1:] for r in line_dedup.line_report(docs).collect()}
    assert got == {1: (2, 0, 0, []), 2: (1, 1, 0, [0]), 3: (4, 1, 1, [1]), 4: (0, 0, 0, []), 5: (1, 0, 0, []), None: (1, 0, 0, [])}
    out = line_dedup.drop_lines(docs)
    assert out.columns == docs.columns
    assert {r[0]: r[1] for r in out.collect()} == {1: rows[0][1], 3: "keep\n\nend", 4: None, 5: "", None: line}
    sized = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    assert {r["doc_id"]: r["n_chars"] for r in line_dedup.drop_lines(sized).collect()} == {1: 35, 3: 9, 4: None, 5: 0, None: 23}


def test_within_one_edit(spark):
    cases = [("a b c", "a b c", True), ("a b c", "a x c", True), ("a b c", "a c", True), ("a b c", "b c", True), ("a b", "a b c", True), ("a b c", "c b a", False), ("a b c d", "a b", False), ("a b c", "x y", False), ("a", "b c", False)]
    df = spark.createDataFrame([(a.split(), b.split(), w) for a, b, w in cases], "a array<string>, b array<string>, want boolean")
    assert df.where(line_dedup.within_one_edit(F.col("a"), F.col("b")) != F.col("want")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = line_dedup.drop_lines(documents(spark, [(1, "a b c d e")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
