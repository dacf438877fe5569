import numpy as np
import pytest

from rosterkeep.llm import ann


def exact(rows, k=10):
    usable = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = {}
    for q, x in usable:
        if q % 100 == 0:
            best = {}
            for i, v in usable:
                if i != q:
                    best[i] = min(best.get(i, np.inf), float(np.sqrt(((v - x) ** 2).sum())))
            out[q] = sorted((d, i) for i, d in best.items())[:k]
    return out


def found(spark, rows, **kinds):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, Vec_ID string".split(", Vec_ID")[0])
    out = {}
    for r in ann.search(df, lambda i: i % 100 == 0).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


@pytest.mark.parametrize("clusters", [1, 30])
def test_recall(spark, clusters):
    rng = np.random.default_rng(clusters)
    centres = rng.normal(size=(clusters, 32))
    vectors = (centres[rng.integers(0, clusters, 3000)] + 0.4 * rng.normal(size=(3000, 32))).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    want, got = exact([(i, v) for i, v, _ in rows]), found(spark, rows)
    assert want.keys() == got.keys()
    hits = [len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want]
    assert np.mean(hits) >= 9.5
    for q in got:
        assert got[q] == sorted(got[q]) and len(got[q]) == 10


def test_odd_rows(spark):
    ok = [1.0, 2.0]
    rows = [(0, ok, "x"), (100, [0.0, 0.0], "x"), (200, None, "x"), (300, [1.0, None], "x"), (400, [float("nan"), 1.0], "x"), (500, [float("inf"), 1.0], "x")]
    rows += [(i, ok, "x") for i in (7, 3, 3, 5)] + [(None, ok, "x"), (9, [1.0, 2.5], "x"), (10, [1.0], "x")]
    got = found(spark, rows)
    assert got == {0: [(0.0, 3), (0.0, 5), (0.0, 7), (0.5, 9)]}


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 1.0, 1.0] if i % 3 else [float(i), 1.0, 2.0], "x") for i in range(2000, 0, -1)]
    assert found(spark, rows)[100] == [(0.0, i) for i in [1, 2, 4, 5, 7, 8, 10, 11, 13, 14]]


def test_empty(spark):
    assert found(spark, []) == {}
