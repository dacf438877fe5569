import duckdb
import pytest

import corpus_pipeline
from helpers import documents, lines_to_drop, needs_tables, small_documents
from rosterkeep.llm import line_dedup
from rosterkeep.llm.queries import ORACLE

MENU = "Home\nAll rights reserved.\none two three four five six"


def dropped(spark, rows):
    return {(r["doc_id"], r["line_no"]) for r in line_dedup.dropped_lines(documents(spark, rows)).collect()}


def test_short_lines(spark):
    rows = [(1, MENU), (2, "HOME\nall rights  reserved.\nother"), (3, "\n \nHome sweet\nHome\nother!"), (4, "Home\nHome")]
    assert dropped(spark, rows) == lines_to_drop(rows) == {(2, 0), (2, 1), (3, 3), (4, 0), (4, 1)}
    # Short lines one edit apart stay.
    assert dropped(spark, [(1, "one two three four"), (2, "one two three 4")]) == set()


def test_scripts_without_blanks(spark):
    rows = [(1, "今天天气很好我们去公园"), (2, "今天天气很好我们去公园"), (3, "今天天气很好我们去学校"), (4, "今天天气很好我们去公司"), (5, "今天"), (6, "今天"), (7, "今明"), (8, "สวัสดีชาวโลก"), (9, "สวัสดีชาวโลก"), (10, "reserved."), (11, "reserved?")]
    # 3 differs from 1 in two characters, 4 in one.
    assert dropped(spark, rows) == {(2, 0), (4, 0), (6, 0), (9, 0)}


@pytest.mark.skipif(needs_tables(), reason="no test tables")
def test_test_documents(spark):
    rows = [(i, t) for i, t, _ in small_documents()]
    assert dropped(spark, rows) == lines_to_drop(rows)


def test_sql_in_scripts_without_blanks():
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM (VALUES (1, '今天天气很好'), (2, '今天天气很坏'), (3, 'Les.'), (4, 'les. '), (5, '今')) AS t(doc_id, text)")
    got = con.execute(ORACLE["op7_line_deletion_dedup"]).fetchall()
    assert {r[0] for r in got if r[2]} == {2, 4}


def test_copies_leave_nothing(spark):
    rows = [(1, MENU), (2, MENU), (3, MENU + "\nan own line of its words"), (4, "Home\n\nAll rights reserved."), (5, "Les.")]
    out = line_dedup.drop_lines(documents(spark, rows))
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: MENU, 3: "an own line of its words", 5: "Les."}


@pytest.mark.skipif(needs_tables(), reason="no test tables")
def test_pipeline_with_planted_copies(spark, tmp_path):
    words = [f"w{i}" for i in range(400)]
    texts = ["Home\nLes.\n" + " ".join(words[k * 40 : k * 40 + 40]) + "\nAll rights reserved." for k in range(5)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts + texts, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    lines = stages["line_dedup"](spark, docs, str(tmp_path))
    left = {r["doc_id"]: r["text"] for r in stages["near_dedup"](spark, lines, str(tmp_path)).collect()}
    assert left == {1: texts[0]} | {i + 1: texts[i].split("\n")[2] for i in range(1, 5)}
