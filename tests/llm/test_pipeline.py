import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from helpers import SMALL, lines_to_drop, near_components, needs_tables
from test_decontam import plain as plain_decontamination
from rosterkeep.llm import packing
from rosterkeep.llm.common import stored, table

pytestmark = pytest.mark.skipif(needs_tables(), reason="no test tables")


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_each_stage_against_a_plain_version(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = docs = stored(stage(spark, docs, SMALL), name)
        if name != "packing":
            assert docs.columns == columns
            assert docs.where("n_chars <> length(text)").count() == 0
    before = texts(table(spark, SMALL, "documents"))

    lang = texts(kept["language_id"])
    assert lang.items() <= before.items() and len(lang) >= 0.97 * len(before)

    gone = lines_to_drop(lang.items())
    want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in lang.items()}
    want = {i: t for i, t in want.items() if t.strip() or t == lang[i]}
    lines = texts(kept["line_dedup"])
    assert lines == want

    of = near_components(lines.items(), 5)
    near = texts(kept["near_dedup"])
    assert near == {i: t for i, t in lines.items() if of[i] == i}

    clean = texts(kept["decontamination"])
    items = [tuple(r) for r in table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    hits = {i: n for i, _, n, _ in plain_decontamination(near.items(), items)}
    assert {i: t for i, t in near.items() if not hits[i]}.items() <= clean.items()
    assert not any(n for _, _, n, _ in plain_decontamination(clean.items(), items))

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokens = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in clean.items()}
    packed = docs.groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in packed} == tokens
    assert docs.select("sequence_id").distinct().count() <= -(-sum(tokens.values()) // packing.CAPACITY) + 2


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0 and corpus_pipeline.ORACLE_SQL is None
