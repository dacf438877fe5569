"""Language identification by words first: known words score by their log frequency in each language, unseen words back
off to progressively shorter character n-grams.

The model is fitted on a bounded sample of labelled documents: about ``PER_LANGUAGE`` of each language, chosen by a hash of
id and text, and of their words and n-grams the ``MAX_WORDS`` and ``MAX_GRAMS`` (of each length) most frequent. That bounds what
is collected and broadcast. Counting is a Spark aggregation over whole texts; every document is predicted from its whole
text.

A word is a run of letters, lower-cased. A word outside the model is scored by its longest n-grams (with word ends) of
which the model knows at least one, as the mean over the known ones, weighted less the shorter they are; a word without any
known n-gram says nothing. The score is the posterior of the language under equal priors. Ties go to the smaller language
name. Null texts and texts without a letter are ``und`` with score 0, and so is everything if no language was learned.
Rows without a language are never learned from; repeated rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rosterkeep.llm.common import begin, give_back, pick, pieces_of_bytes, stored, with_columns_by_place

PER_LANGUAGE = 800
MAX_WORDS = 60_000
MAX_GRAMS = 20_000
LONGEST = 4
#: Weight of n-grams of the greatest length, and the factor for each length less.
BACKOFF = 0.5
SMOOTHING = 0.5
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    words = _LETTERS.findall(text.lower())
    # The pattern also takes numerals that are not decimal digits; such a run alone makes no word.
    return words if all(w[0].isalpha() for w in words) else [w for w in words if any(map(str.isalpha, w))]


def grams_of(word: str, n: int) -> list[str]:
    padded = f"^{word}$" if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    #: Rows of ``scores`` by word, and by n-gram for each length.
    words: dict[str, int]
    grams: dict[int, dict[str, int]]
    scores: np.ndarray
    #: Score rows of unseen words met so far by this process, dropped when there are many.
    _seen: dict[str, np.ndarray] = field(default_factory=dict, repr=False)

    def forget(self) -> None:
        self._seen.clear()

    def _unseen(self, word: str) -> np.ndarray:
        for n in range(LONGEST, 0, -1):
            known = [r for g in grams_of(word, n) if (r := self.grams.get(n, {}).get(g)) is not None]
            if known:
                return self.scores[known].mean(axis=0) * BACKOFF ** (LONGEST - n + 1)
        return np.zeros(len(self.languages))

    def totals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text its score by language, and whether it has a word."""
        if len(self._seen) > 50_000:
            self._seen.clear()
        fresh: dict[str, int] = {}
        rows, lengths, size = [], [], len(self.scores)
        get = self.words.get
        for text in texts:
            words = words_of(text) if text else []
            lengths.append(len(words))
            rows += [get(w, -1) for w in words]
            if -1 in rows[len(rows) - len(words) :]:
                for i, w in enumerate(words, len(rows) - len(words)):
                    if rows[i] < 0:
                        rows[i] = size + fresh.setdefault(w, len(fresh))
        more = np.zeros((len(fresh), len(self.languages)))
        for w, i in fresh.items():
            if (known := self._seen.get(w)) is None:
                known = self._seen[w] = self._unseen(w)
            more[i] = known
        every = np.vstack((self.scores, more))
        has = np.array(lengths) > 0
        out = np.zeros((len(texts), len(self.languages)))
        if has.any():
            starts = np.concatenate(([0], np.cumsum(lengths)))[:-1][has]
            out[has] = np.add.reduceat(every[np.array(rows)], starts, axis=0)
        return out, has

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        if not self.languages:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0})
        totals, has = self.totals(texts)
        best = totals.argmax(axis=1)
        share = np.exp(totals - totals.max(axis=1, keepdims=True))
        score = np.where(has, 1 / share.sum(axis=1), 0.0)
        names = np.where(has, np.array(self.languages, dtype=object)[best], UNKNOWN)
        return pd.DataFrame({"lang_pred": names, "score": score})


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words (length 0) and n-grams of some texts with their number by language; of about a megabyte at a time."""
    begin("langid")
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            texts = texts.tolist()
            for a, b in pieces_of_bytes(texts, 1 << 20):
                words: Counter[str] = Counter()
                for text in texts[a:b]:
                    words.update(words_of(text))
                for n in range(LONGEST + 1):
                    counts: Counter[str] = Counter()
                    for w, k in words.items() if n else ():
                        for g in grams_of(w, n):
                            counts[g] += k
                    found = counts if n else words
                    yield pd.DataFrame({"lang": lang, "n": n, "gram": list(found.keys()), "k": list(found.values())})


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on ``doc_id``, ``text`` and ``lang`` of a bounded sample of the rows that have a text and a language."""
    rows = labelled.where("text is not null and lang is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], {}, {}, np.zeros((0, 0)))
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))])
    # The hash of id and text is spread evenly over [0, 1).
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit("langid")), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.where(chance < share[F.col("lang")]).select("lang", "text")
    counted = sample.mapInPandas(_counts, "lang string, n int, gram string, k long").groupBy("n", "gram", "lang").agg(F.sum("k").alias("k"))
    by_gram = counted.groupBy("n", "gram").agg(F.sum("k").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "k"))).alias("by"))
    by_gram = stored(by_gram, "grams")
    words: dict[str, int] = {}
    grams: dict[int, dict[str, int]] = {}
    blocks, at = [], 0
    for n in range(LONGEST + 1):
        limit = MAX_GRAMS if n else MAX_WORDS
        top = by_gram.where(F.col("n") == n).orderBy(F.desc("total"), "gram").limit(limit).collect()
        counts = np.array([[r["by"].get(lang, 0) for lang in languages] for r in top], dtype=float).reshape(-1, len(languages))
        total = counts.sum(axis=0)
        blocks.append(np.log((counts + SMOOTHING) / (total + SMOOTHING * (len(top) + 1))))
        own = words if n == 0 else grams.setdefault(n, {})
        own.update((r["gram"], at + i) for i, r in enumerate(top))
        at += len(top)
    scores = np.vstack(blocks)
    # Only differences between languages count.
    return Model(languages, words, grams, scores - scores.mean(axis=1, keepdims=True))


def predictor(spark, model: Model):
    """A column expression of ``lang_pred`` and ``score`` of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        begin("langid")
        for texts in batches:
            values = texts.tolist()
            sizes = (bytes(0) if t is None else t for t in values)
            parts = [shared.value.predict(values[a:b]) for a, b in pieces_of_bytes(sizes, 1 << 20)]
            yield pd.concat(parts, ignore_index=True) if parts else shared.value.predict([])
        # The process waits while other stages need the memory.
        shared.value.forget()
        give_back()

    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: ``doc_id``, ``lang_pred``, ``score``."""
    found = pick(docs, "doc_id", "text").withColumn("found", predictor(docs.sparkSession, model)("text"))
    return found.select("doc_id", "found.lang_pred", "found.score")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents whose language is identified with a score of at least ``least``, ``lang`` set to it; all columns stay."""
    out, at = with_columns_by_place(docs)
    out = out.withColumn("_found", predictor(docs.sparkSession, model)(F.col(at["text"])))
    out = out.where((F.col("_found.lang_pred") != UNKNOWN) & (F.col("_found.score") >= least))
    if "lang" in at:
        out = out.withColumn(at["lang"], F.col("_found.lang_pred"))
    return out.drop("_found").toDF(*docs.columns)
