import pytest

from helpers import LONG, documents, needs_tables, small_documents, SMALL
from rosterkeep.llm import langid

TEXTS = {"a": "the cat and the dog sat on the mat ", "b": "der hund und die katze auf der matte "}


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def learned(spark):
    rows = [(i, TEXTS[lang], lang) for i, lang in enumerate("ab" * 20)] + [(90, None, "a"), (91, "words", None), (92, "", "a")]
    return langid.learn(labelled(spark, rows))


def test_known_unseen_and_unknown(spark):
    rows = [(1, "the dog"), (2, "DER HUND!"), (3, "thecat"), (4, None), (5, ""), (6, "123 ½ _ …"), (7, "日本"), (1, "the dog"), (8, LONG + "katze " * 900_000), (None, "und die")]
    got = langid.identify(documents(spark, rows), learned(spark)).collect()
    assert len(got) == len(rows)
    of = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert [of[i][0] for i in (1, 2, 3, 8, None)] == ["a", "b", "a", "b", "b"]
    assert of[4] == of[5] == of[6] == ("und", 0.0)
    assert of[7] == ("a", 0.5)  # says nothing: equal scores, the smaller name
    assert all(0 <= s <= 1 for _, s in of.values())


def test_nothing_learned(spark):
    model = langid.learn(labelled(spark, []))
    assert [tuple(r) for r in langid.identify(documents(spark, [(1, "text")]), model).collect()] == [(1, "und", 0.0)]
    assert langid.identify(documents(spark, []), learned(spark)).count() == 0


def test_keep_identified(spark):
    docs = labelled(spark, [(1, "the dog", None), (2, "der hund", "x"), (3, "12", "a"), (4, None, "a")])
    got = langid.keep_identified(docs, learned(spark))
    assert got.columns == docs.columns and sorted(tuple(r) for r in got.collect()) == [(1, "the dog", "a"), (2, "der hund", "b")]


@pytest.mark.skipif(needs_tables(), reason="no test tables")
def test_held_out_accuracy(spark):
    from rosterkeep.llm.queries import QUERIES

    truth = {i: lang for i, _, lang in small_documents()}
    held = [r for r in QUERIES["op3_language_id"](spark, SMALL).collect() if r["held_out"]]
    assert len(held) > 40
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.97 * len(held)
