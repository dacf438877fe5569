import random

from rosterkeep.llm import quality


def frames(spark, copies):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choices(("a b c d e f g" if i % 2 else "v w x y z u t").split(), k=400))) for i in range(400)]
    labels = [(i, i % 2) for i in range(400)] + [(7, 1)] * copies
    return spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_a_hot_label_does_not_change_the_sample(spark, monkeypatch):
    seen = []
    kept = quality._dictionary
    monkeypatch.setattr(quality, "_dictionary", lambda parts: seen.append(sorted(parts)) or kept(parts))
    curves = []
    monkeypatch.setattr(quality, "_curve", lambda x, y, weight: curves.append((len(x), weight.sum())) or (1.0, 0.0))
    for copies in (0, 5000):
        quality.learn(*frames(spark, copies), per_label=50)
    assert seen[:2] == seen[2:] and curves[0][0] == curves[1][0] <= 200
