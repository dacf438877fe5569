"""Scores of texts by a hidden Markov language model, trained by Baum-Welch counts that are summed over all partitions.

Tokens are the words between blanks, A-Z lower-cased, and one end. The unigram base of a token is
``(c + 0.5) / (N + 0.5 * (V + 1))`` with its count, all tokens and distinct tokens of the training texts. The model has
``STATES`` hidden states; a state emits a class, and the class its tokens in proportion to their base. The end, each of the
``TOP`` most frequent words and all unknown words together are classes of their own; the others are dealt by their last
three bytes into ``BUCKETS`` classes. So every word of the corpus has its exact count, the model's size is fixed, and the
probabilities of all token sequences sum to one, with all unknown words as one token. That token has the base's probability
in every state: a text is not made likelier by words nobody knows, and ranks below texts of known ones.

1. Texts are encoded by batches of about ``BATCH`` bytes, each with its own word list. Only one row for each word of a
   batch is shuffled, to be counted, and back to its batch; that grows with the corpus, but no word has more rows than there
   are batches.
2. Baum-Welch starts from the company of the classes: how often each class has neighbours of each of ``CONTEXTS`` groups,
   counted over all training texts, is grouped into as many clusters as there are states. Then it makes passes over all
   training texts until the likelihood of a pass is less than ``SETTLED`` better than that of the one before, ``PASSES`` at
   most; the rule is the same for every size. Texts are passed in segments of ``SEGMENT`` tokens, which overlap by one so
   that every move is counted; each task sends one row of expected counts for each class.
3. Scores are exact sequence likelihoods of whole texts by the scaled forward recursion, for all texts of a batch at once.

A null text is empty: its only token is the end. Without training texts every token is unknown and every score 0. Repeated
documents are learned from and scored each; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rosterkeep.llm.common import blank_words, join_reduced, pick, stored

STATES = 8
TOP = 4096
BUCKETS = 512
SEGMENT = 64
PASSES = 6
SETTLED = 0.0002
BATCH = 6 << 20
#: Groups of neighbours by which classes are told apart at the start, and rounds of that.
CONTEXTS, CLUSTER_ROUNDS = 32, 30
SMOOTHING = 0.5

END = b""
_END_CLASS = 0


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.compress(out.getvalue(), 3)


def _unpacked(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(zstandard.decompress(blob))) as arrays:
        return dict(arrays)


_ENCODED = "batch long, blob binary, idx int, word binary, n long"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch of texts one row with all its tokens by number, and one row for each distinct token."""
    base, number = TaskContext.get().partitionId() << 32, 0
    ids: list[int | None] = []
    train: list[bool] = []
    tokens: list[np.ndarray] = []
    places: dict[bytes, int] = {END: 0}
    size = 0

    def flush() -> pa.RecordBatch:
        flat = np.concatenate(tokens)
        lengths = np.array([len(t) for t in tokens])
        counts = np.bincount(flat[np.repeat(train, lengths)], minlength=len(places))
        blob = _packed(
            ids=np.array([i or 0 for i in ids], np.int64), known=np.array([i is not None for i in ids]), train=np.array(train), lengths=lengths, tokens=flat
        )
        m = len(places)
        columns = [
            pa.array(np.full(m + 1, base + number)),
            pa.array([blob] + [None] * m, pa.binary()),
            pa.array([None, *range(m)], pa.int32()),
            pa.array([None, *places], pa.binary()),
            pa.array([None, *counts.tolist()], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["batch", "blob", "idx", "word", "n"])

    for batch in batches:
        for doc_id, text, learns in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "train")), strict=True):
            words = blank_words(text) if text else []
            tokens.append(np.array([places.setdefault(w, len(places)) for w in words] + [0], np.int32))
            ids.append(doc_id), train.append(learns)
            size += len(text or b"") + 1
            if size >= BATCH:
                yield flush()
                number += 1
                ids, train, tokens, places, size = [], [], [], {END: 0}, 0
    if tokens:
        yield flush()


@dataclass(frozen=True)
class Corpus:
    """All texts as classes, batch by batch, and the figures of the training tokens."""

    batches: DataFrame
    train_tokens: int
    distinct: int
    once: int
    #: Base probability of each class, and the classes of top words that exist.
    mass: np.ndarray


def count_corpus(docs: DataFrame, train: Column) -> Corpus:
    """Tokens counted exactly over the training texts; every text with its base score and its classes."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), train.alias("train"))
    encoded = stored(rows.mapInArrow(_encode, _ENCODED), "encoded")
    words = encoded.where("word is not null").select("batch", "idx", "word", "n")
    # Summed before the shuffle; joined back so that adaptive execution can split a word that every batch has.
    totals = words.groupBy("word").agg(F.sum("n").alias("c"), F.min("batch").alias("least"))
    counted = join_reduced(words, totals, ["word"]).select("batch", "idx", "word", "n", "c", (F.col("batch") == F.col("least")).alias("first"))
    counted = stored(counted, "counted")
    figures = counted.agg(F.sum("n"), F.count_if(F.expr("first and c > 0")), F.count_if(F.expr("first and c = 1"))).first()
    n, v, once = (int(x or 0) for x in figures)
    whole = n + 0.5 * (v + 1)

    words = counted.where("first and c > 0 and octet_length(word) > 0")
    top = [bytes(r[0]) for r in words.orderBy(F.desc("c"), "word").limit(TOP).select("word").collect()]
    spark = docs.sparkSession
    top_rows = spark.createDataFrame([(w, i) for i, w in enumerate(top, 1)], "word binary, rank int")
    n_classes = TOP + BUCKETS + 2
    bucket = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(BUCKETS)) + TOP + 1
    own = F.when(F.octet_length("word") == 0, _END_CLASS).when(F.col("c") == 0, n_classes - 1).otherwise(F.coalesce("rank", bucket))
    # At most TOP words, whatever the corpus holds.
    classed = counted.join(F.broadcast(top_rows), "word", "left").withColumn("class", F.when((F.col("c") == 0), n_classes - 1).otherwise(own).cast("int"))
    mass = np.zeros(n_classes)
    for r in classed.where("first and c > 0").groupBy("class").agg(F.sum((F.col("c") + 0.5) / whole)).collect():
        mass[r[0]] = r[1]
    mass[-1] = 0.5 / whole

    def code(left: pa.Table, right: pa.Table) -> pa.Table:
        """Classes and base scores of a batch: its numbered words with their counts are all on the right."""
        m = right.num_rows
        idx = right["idx"].to_numpy()
        c, classes = np.zeros(m, np.int64), np.zeros(m, np.uint16)
        c[idx], classes[idx] = right["c"].to_numpy(), right["class"].to_numpy()
        blobs = []
        for blob in left["blob"].to_pylist():
            x = _unpacked(blob)
            starts = np.cumsum(x["lengths"]) - x["lengths"]
            log_base = np.log10((c + 0.5) / whole)
            within = log_base - np.log10(mass[classes])
            tokens = x.pop("tokens")
            x["base"] = np.add.reduceat(log_base[tokens], starts)
            x["within"] = np.add.reduceat(within[tokens], starts)
            x["n_known"] = np.add.reduceat((c > 0)[tokens].astype(np.int64), starts)
            blobs.append(_packed(classes=classes[tokens], **x))
        return pa.table({"blob": pa.array(blobs, pa.binary())})

    texts = encoded.where("blob is not null").select("batch", "blob")
    coded = texts.groupBy("batch").cogroup(classed.select("batch", "idx", "c", "class").groupBy("batch")).applyInArrow(code, "blob binary")
    return Corpus(stored(coded, "coded"), n, v, once, mass)


@dataclass(frozen=True)
class Model:
    start: np.ndarray
    #: Distribution of states inside texts, for segments that begin there.
    inside: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    def log10_likelihoods(self, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Scaled forward recursion over whole texts, all texts in step; the longest come first and the others end."""
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        ordered = lengths[order]
        active = np.searchsorted(-ordered, -np.arange(1, ordered[0] + 1), "right") if len(ordered) else []
        emit = np.ascontiguousarray(self.emit.T)
        out = np.zeros(len(lengths))
        alpha = None
        for t, s in enumerate(active):
            now = emit[classes[starts[:s] + t]]
            alpha = now * (self.start if alpha is None else alpha[:s] @ self.move)
            scale = alpha.sum(axis=1)
            out[:s] += np.log10(scale)
            alpha /= scale[:, None]
        back = np.empty(len(lengths))
        back[order] = out
        return back

    def expected(self, classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected numbers of starts, moves and emissions (by class) over texts cut into segments.

        A segment but the first of a text begins with the last token of the one before, whose emission counts there.
        """
        cut = -(-lengths // SEGMENT)
        first = np.concatenate(([True], np.zeros(cut.sum() - 1, bool))) if cut.sum() else np.zeros(0, bool)
        first[np.cumsum(cut)[:-1]] = True
        of_text = np.repeat(np.arange(len(lengths)), cut)
        number = np.arange(len(of_text)) - np.repeat(np.cumsum(cut) - cut, cut)
        begins = (np.cumsum(lengths) - lengths)[of_text] + number * SEGMENT - (number > 0)
        sizes = np.minimum(SEGMENT, lengths[of_text] - number * SEGMENT) + (number > 0)
        k = len(self.start)
        starts, moves, emitted, likelihood = np.zeros(k), np.zeros((k, k)), np.zeros((self.emit.shape[1], k)), np.zeros(1)
        for i in range(0, len(begins), 2048):
            part = slice(i, i + 2048)
            order = np.argsort(-sizes[part], kind="stable")
            self._segments(classes, begins[part][order], sizes[part][order], first[part][order], starts, moves, emitted, likelihood)
        return starts, moves, emitted, likelihood

    def _segments(self, classes, begins, sizes, first, starts, moves, emitted, likelihood) -> None:
        active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")
        emit = np.ascontiguousarray(self.emit.T)
        seen = [classes[begins[:s] + t] for t, s in enumerate(active)]
        alphas, scales = [], []
        for t, s in enumerate(active):
            before = np.where(first[:, None], self.start, self.inside) if t == 0 else alphas[-1][:s] @ self.move
            alpha = before * emit[seen[t]]
            scales.append(alpha.sum(axis=1))
            alphas.append(alpha / scales[-1][:, None])
            likelihood += np.log10(scales[-1] if t else scales[0][first]).sum()
        gammas = [None] * len(active)
        beta = np.ones((active[-1], len(self.start)))
        for t in range(len(active) - 1, -1, -1):
            if t + 1 < len(active):
                s = active[t + 1]
                ahead = emit[seen[t + 1]] * beta / scales[t + 1][:, None]
                moves += self.move * (alphas[t][:s].T @ ahead)
                beta = np.ones((active[t], len(self.start)))
                beta[:s] = ahead @ self.move.T
            gammas[t] = alphas[t] * beta
        starts += gammas[0][first].sum(axis=0)
        gammas[0] = gammas[0] * first[:, None]
        every, gamma = np.concatenate(seen), np.concatenate(gammas)
        for j in range(len(self.start)):
            emitted[:, j] += np.bincount(every, weights=gamma[:, j], minlength=len(emitted))


def _next(model: Model, corpus: Corpus, starts: np.ndarray, moves: np.ndarray, emitted: np.ndarray) -> Model:
    """The model of expected counts, held a little to the base. ``emitted`` is by class and state."""
    k = len(starts)
    unseen = _unknown_share(corpus)
    known = corpus.mass.copy()
    known[-1] = 0
    known /= known.sum()
    emit = emitted.T + SMOOTHING * len(known) * known
    emit[:, -1] = 0
    emit = (1 - unseen) * emit / emit.sum(axis=1, keepdims=True)
    emit[:, -1] = unseen
    move = (moves + SMOOTHING) / (moves + SMOOTHING).sum(axis=1, keepdims=True)
    inside = emitted.sum(axis=0) + 1
    return Model((starts + SMOOTHING) / (starts.sum() + SMOOTHING * k), inside / inside.sum(), move, emit)


def _unknown_share(corpus: Corpus) -> float:
    return float(corpus.mass[-1])


def _company(corpus: Corpus) -> np.ndarray:
    """For each class how often each group of contexts comes before and after it, over all training texts.

    The most frequent words are groups of their own, the other classes are dealt among the rest.
    """
    own = CONTEXTS // 2
    ranks = np.argsort(np.argsort(-corpus.mass, kind="stable"), kind="stable")
    group = np.where(ranks < own, ranks, own + ranks % (CONTEXTS - own))
    shared = corpus.batches.sparkSession.sparkContext.broadcast(group)
    n = len(group)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2 * CONTEXTS, n), np.int64)
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                x = _unpacked(blob)
                of_train = np.repeat(x["train"], x["lengths"])
                classes = x["classes"][of_train].astype(np.int64)
                ends = np.cumsum(x["lengths"][x["train"]])[:-1]
                inside = np.ones(max(len(classes) - 1, 0), bool)
                inside[ends - 1] = False
                left, right = classes[:-1][inside], classes[1:][inside]
                for side, (these, those) in enumerate(((right, left), (left, right))):
                    places = (shared.value[those] + side * CONTEXTS) * n + these
                    total += np.bincount(places, minlength=total.size).reshape(total.shape)
        columns = [pa.array(np.arange(n), pa.int32()), *[pa.array(c) for c in total]]
        yield pa.RecordBatch.from_arrays(columns, names=["row", *[f"s{j}" for j in range(len(total))]])

    names = [f"s{j}" for j in range(2 * CONTEXTS)]
    summed = corpus.batches.mapInArrow(count, "row int, " + ", ".join(f"{c} long" for c in names)).groupBy("row").agg(*[F.sum(c).alias(c) for c in names])
    return np.array(sorted(tuple(r) for r in summed.collect()), float)[:, 1:]


def _first(corpus: Corpus, states: int) -> Model:
    """States of classes that keep like company: clusters of their contexts, weighed by how often the classes occur."""
    company = _company(corpus)
    seen = company.sum(axis=1)
    expected = company.sum(axis=0, keepdims=True) / max(company.sum(), 1)
    share = (company + 10 * expected) / (seen[:, None] + 10 * expected.sum())
    points = np.sqrt(share)
    # The class farthest from the centres so far, by its weight, is the next centre: no chance in it.
    centres = [np.average(points, axis=0, weights=seen + 1e-9)]
    while len(centres) < states:
        far = np.min([((points - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(points[np.argmax(far * seen)])
    centres = np.array(centres)
    for _ in range(CLUSTER_ROUNDS):
        nearest = np.argmin(((points[:, None, :] - centres[None]) ** 2).sum(axis=2), axis=1)
        for j in range(states):
            if seen[nearest == j].sum() > 0:
                centres[j] = np.average(points[nearest == j], axis=0, weights=seen[nearest == j])
    belongs = np.full((len(points), states), 0.2 / states)
    belongs[np.arange(len(points)), nearest] += 0.8
    emitted = corpus.mass[:, None] * corpus.train_tokens * belongs
    moves = np.full((states, states), 100.0) + np.eye(states)
    return _next(None, corpus, np.ones(states), moves, emitted)


def train(corpus: Corpus, states: int = STATES, passes: int = PASSES, settled: float = SETTLED) -> Model | None:
    """Baum-Welch; None without training tokens."""
    if not corpus.train_tokens:
        return None
    model, k = _first(corpus, states), states
    spark = corpus.batches.sparkSession
    before = -np.inf
    for _ in range(passes):
        shared = spark.sparkContext.broadcast(model)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for blob in batch.column("blob").to_pylist():
                    x = _unpacked(blob)
                    of_train = np.repeat(x["train"], x["lengths"])
                    if not of_train.any():
                        continue
                    found = shared.value.expected(x["classes"][of_train], x["lengths"][x["train"]])
                    total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
            if total is not None:
                rows = np.vstack((np.full((1, k), total[3][0]), total[0][None, :], total[1], total[2]))
                columns = [pa.array(np.arange(len(rows)), pa.int32()), *[pa.array(c) for c in rows.T]]
                yield pa.RecordBatch.from_arrays(columns, names=["row", *[f"s{j}" for j in range(k)]])

        kind = "row int, " + ", ".join(f"s{j} double" for j in range(k))
        summed = corpus.batches.mapInArrow(count, kind).groupBy("row").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(k)])
        rows = np.array(sorted(tuple(r) for r in summed.collect()))[:, 1:]
        shared.unpersist()
        model = _next(model, corpus, rows[1], rows[2 : k + 2], rows[k + 2 :])
        likelihood = rows[0][0]
        if likelihood - before < settled * abs(likelihood):
            break
        before = likelihood
    return model


def score(corpus: Corpus, model: Model | None) -> DataFrame:
    """Per document: ``doc_id``, ``train``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10 probabilities)."""
    shared = corpus.batches.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                x = _unpacked(blob)
                likelihood = 0.0 if shared.value is None else shared.value.log10_likelihoods(x["classes"], x["lengths"])
                columns = [
                    pa.array(x["ids"], mask=~x["known"]),
                    pa.array(x["train"]),
                    pa.array(x["lengths"].astype(np.int64)),
                    pa.array(x["n_known"]),
                    pa.array(x["base"]),
                    pa.array(x["within"] + likelihood),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])

    return corpus.batches.mapInArrow(rate, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
