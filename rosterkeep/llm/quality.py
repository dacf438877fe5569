"""Quality classifier by compression: a text is good if a zstandard dictionary of good texts compresses it better, by more
than one of bad texts does.

Both dictionaries are trained on a bounded sample of labelled texts: of about ``PER_LABEL`` documents of each label, chosen
by a hash of the id, at most ``PARTS`` parts of ``PART`` bytes, also chosen by a hash. A text is compressed part by part, so
that no text becomes its own dictionary; all parts of the whole text count. The compressed-size difference is normalised by
the size of the text, flattened beyond ``SOFT`` (copies of sampled texts differ by far more than others), and becomes the
score by a logistic curve fitted on other documents of the sample (half of it) and weighted to the labels' shares among all
labelled rows.

Null and empty texts have difference 0. Without labels of both kinds the score is the share of label 1, or 0.5. Labels
other than 0 and 1, null labels, and labels of absent documents are not learned from; a document with several labels is
learned from for each, and a label that is repeated weighs as often in the curve. Repeated documents are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from rosterkeep.llm.common import pick

PER_LABEL = 3000
PARTS = 4000
PART = 2048
DICTIONARY = 96 << 10
LEVEL = 3
SOFT = 0.03


@dataclass(frozen=True)
class Model:
    """Dictionaries of good and bad text, and the curve from the normalised difference to the score."""

    good: bytes
    bad: bytes
    slope: float = 0.0
    intercept: float = 0.0

    @cached_property
    def _compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for data in (self.good, self.bad):
            known = zstandard.ZstdCompressionDict(data)
            known.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False))
        return out

    def difference(self, text: bytes | None) -> float:
        """How much smaller the text gets with the good dictionary than with the bad one, per byte."""
        if not text or not self.good:
            return 0.0
        parts = [text[i : i + PART] for i in range(0, len(text), PART)]
        good, bad = (sum(len(c.compress(p)) for p in parts) for c in self._compressors)
        return (bad - good) / len(text)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_compressors"}


def _differences(spark, model: Model):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def difference(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.difference(t) for t in batch], dtype=float)

    return difference


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the weighted logistic regression, lightly held to 0, by Newton's method."""
    scale = x.std() or 1.0
    rows = np.column_stack((x / scale, np.ones(len(x))))
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -50, 50)))
        gradient = rows.T @ (weight * (y - p)) - 1e-3 * beta
        hessian = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Fit on ``doc_id`` and ``text`` of the documents and ``doc_id`` and ``quality`` of the labels given."""
    spark = docs.sparkSession
    known = pick(labels, "doc_id", "quality").where("quality in (0, 1) and doc_id is not null")
    # A label given many times is one row with its count, so no id makes the sample large.
    known = known.groupBy("doc_id", "quality").agg(F.count(F.lit(1)).alias("n"))
    counted = known.groupBy("quality").agg(F.sum("n"), F.count(F.lit(1))).collect()
    sizes, ids = {int(r[0]): r[1] for r in counted}, {int(r[0]): r[2] for r in counted}
    total = sum(sizes.values())
    if len(sizes) < 2:
        share = np.clip(sizes.get(1, 0) / total, 0.01, 0.99) if total else 0.5
        return Model(b"", b"", 0.0, float(np.log(share / (1 - share))))
    hashed = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 21))
    part = F.when(F.col("quality") == 1, min(1.0, per_label / ids[1])).otherwise(min(1.0, per_label / ids[0]))
    # At most about twice per_label rows, whatever the labels hold: small enough to broadcast.
    chosen = known.where(F.floor(hashed / 2) / (1 << 20) < part).select("doc_id", "quality", "n", (hashed % 2 == 0).alias("fit"))
    texts = pick(docs, "doc_id", "text").where("text is not null and doc_id is not null")
    sample = texts.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PART)), lambda i: F.substring("text", (i * PART + 1).cast("int"), F.lit(PART)))
    parts = sample.where(F.col("fit") & (F.length("text") > 0)).select("quality", "doc_id", F.posexplode(cut).alias("i", "part"))
    dictionaries = []
    for quality in (1, 0):
        rows = parts.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id", "i"), "doc_id", "i").limit(PARTS).select("part").collect()
        dictionaries.append(_dictionary([bytes(r[0]) for r in rows]))
    if not all(dictionaries):
        return Model(b"", b"", 0.0, float(np.log(sizes[1] / sizes[0])))
    model = Model(*dictionaries)
    rows = sample.where(~F.col("fit")).select("quality", "n", _differences(spark, model)("text").alias("x")).toPandas()
    if rows["quality"].nunique() < 2:
        return Model(*dictionaries, 1.0, float(np.log(sizes[1] / sizes[0])))
    x, y = np.tanh(rows["x"].to_numpy(float) / SOFT), rows["quality"].to_numpy(float)
    n = rows["n"].to_numpy(float)
    weight = n * np.where(y == 1, sizes[1] / n[y == 1].sum(), sizes[0] / n[y == 0].sum()) * len(y) / total
    return Model(*dictionaries, *_curve(x, y, weight))


def _dictionary(parts: list[bytes]) -> bytes:
    """A trained dictionary; of too little text for that, the text itself."""
    if not parts:
        return b""
    size = sum(map(len, parts))
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(1024, size // 8)), parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY:].rjust(8, b" ")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: ``doc_id``, ``difference`` and ``score``."""
    rows = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text"))
    out = rows.select("doc_id", _differences(docs.sparkSession, model)("text").alias("difference"))
    linear = F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.tanh(F.col("difference") / SOFT) * model.slope + model.intercept))
    return out.withColumn("score", 1 / (1 + F.exp(-linear)))
