"""Benchmark decontamination: a broadcast hash set of the word windows of test items, scanned over training texts.

A text's words are the runs of digits, letters and characters beyond ASCII, A-Z lower-cased. A window of an item is
``width`` consecutive words; an item with fewer words, but not none, is one window. A word of a document is hit if it lies
inside any occurrence of a window.

Items are read in blocks of at most ``BLOCK_BYTES`` of text, so what is broadcast is bounded: each block is one pass over
the documents, and as many passes are made as the items need. Inside a task, words become numbers by the block's
vocabulary, runs of known words are hashed in one step per batch, and every hash hit is verified on the words themselves.

Null and empty texts have no words and no hits. Null items, null item ids and items without words take no part; several
items with the same id count once. Repeated documents are judged one by one; extra columns are kept or ignored, whatever
their names are. Without documents or items the results are empty and without hits.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rosterkeep.llm.common import LOWER_WORDS, begin, give_back, pick, small_batches, stored, with_columns_by_place

WIDTH = 10
#: Bytes of item text whose windows are broadcast at a time.
BLOCK_BYTES = 32 << 20

_HITS = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Windows:
    """The windows of one block of items, by their number of words."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.ids = sorted({item for item, _ in items})
        number = {item: i for i, item in enumerate(self.ids)}
        self.vocabulary: dict[bytes, int] = {}
        found: dict[int, dict[bytes, set[int]]] = {}
        for item, text in items:
            words = text.translate(LOWER_WORDS).split()
            coded = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], dtype=np.int64)
            n = min(width, len(coded))
            for i in range(len(coded) - n + 1 if n else 0):
                found.setdefault(n, {}).setdefault(coded[i : i + n].tobytes(), set()).add(number[item])
        #: For each length the sorted hashes, and the items by the window's exact words.
        self.by_length = {
            n: (np.unique(_hashes(np.array([np.frombuffer(k, np.int64) for k in by]))), {k: sorted(v) for k, v in by.items()})
            for n, by in found.items()
        }

    def hits(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, merged ranges of words inside occurrences, and the ids of the items that occur."""
        words = text.translate(LOWER_WORDS).split()
        get = self.vocabulary.get
        coded = np.array([get(w, 0) for w in words], dtype=np.int64)
        # Known words before each place: a window can only stand where all its words are known.
        known = np.concatenate(([0], np.cumsum(coded != 0)))
        spans, items = [], set()
        for n, (hashes, exact) in self.by_length.items():
            if len(coded) < n:
                continue
            starts = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(starts):
                continue
            own = _hashes(coded[starts[:, None] + np.arange(n)])
            place = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            for start in starts[hashes[place] == own].tolist():
                if (of := exact.get(coded[start : start + n].tobytes())) is not None:
                    spans.append((start, start + n))
                    items.update(of)
        return len(words), _merged(spans), [self.ids[i] for i in sorted(items)]


def _hashes(windows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(windows), np.uint64)
    for column in windows.T.astype(np.uint64):
        out = (out ^ column) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The items with words in blocks whose text is about ``block_bytes`` together."""
    items = pick(benchmark, "item_id", "text").where("item_id is not null and text is not null")
    items = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    return [items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k) if n > 1 else items for k in range(n)]


def _windows(block: DataFrame, width: int):
    return block.sparkSession.sparkContext.broadcast(Windows([tuple(r) for r in block.toLocalIterator()], width))


def _scanner(windows):
    @F.pandas_udf(_HITS)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = [(0, [], []) if t is None else windows.value.hits(t) for t in texts]
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return scan


def _cleaner(windows):
    @F.pandas_udf("string")
    def clean(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cleaned(t, s, windows.value) for t, s in zip(texts, spans, strict=True)], dtype=object)

    return clean


def _judge(windows, drop_from: float):
    """Whether a text goes, and the text without the passages if it has any."""

    @F.pandas_udf("gone boolean, text string")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        begin("decontam")
        known = windows.value

        def judged(text: bytes | None) -> tuple[bool, str | None]:
            n_words, spans, _ = (0, [], []) if text is None else known.hits(text)
            n_hit = sum(end - start for start, end in spans)
            gone = n_hit > 0 and n_hit >= drop_from * n_words
            return gone, _cleaned(text, spans, known) if spans and not gone else None

        for batch in texts:
            yield pd.DataFrame([judged(text) for text in batch], columns=["gone", "text"]).astype({"gone": bool, "text": object})
        give_back()

    # Else a condition on its result would be moved below it, and run it a second time.
    return judge.asNondeterministic()


def _merger():
    @F.pandas_udf("array<struct<start: long, end: long>>")
    def merge(spans: pd.Series) -> pd.Series:
        return spans.map(lambda row: _merged([(s["start"], s["end"]) for s in row]))

    return merge


def with_hits(docs: DataFrame, text: str, benchmark: DataFrame, into: str, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with a column ``into`` of their words, hit ranges of words and items, for all blocks of items."""
    out = None
    for block in _blocks(benchmark, block_bytes):
        scan = _scanner(_windows(block, width))
        if out is None:
            out = docs.withColumn(into, scan(F.col(text).cast("binary")))
        else:  # one block at a time in a task's memory
            more = stored(out, "hits").withColumn("_more", scan(F.col(text).cast("binary")))
            out = more.withColumn(into, _both(F.col(into), F.col("_more"))).drop("_more")
    return out


def _both(a: Column, b: Column) -> Column:
    return F.struct(
        a["n_words"].alias("n_words"),
        _merger()(F.concat(a["spans"], b["spans"])).alias("spans"),
        F.array_union(a["items"], b["items"]).alias("items"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: words, hit words, hit ranges of words, the items that occur."""
    out = with_hits(pick(docs, "doc_id", "text"), "text", benchmark, "hits", width, block_bytes)
    n_hit = F.aggregate("hits.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "text", "hits.n_words", n_hit.alias("n_hit"), "hits.spans", F.array_sort("hits.items").alias("items"))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the ranges of words; what stood between two words of a range goes with them."""
    words = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : words[start][0]])
        at = words[end - 1][1]
    return b"".join([*kept, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, drop_from: float = 0.5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, with all their columns, without benchmark passages.

    A document whose hit words are at least the share ``drop_from`` of its words goes; of others the hit ranges are cut
    out. Cutting can bring words together, so it is repeated until no window of the block of items occurs. ``n_chars``, if there, follows.
    """
    out, at = with_columns_by_place(docs)
    small_batches(docs.sparkSession)
    blocks = _blocks(benchmark, block_bytes)
    if len(blocks) == 1:  # one worker and one copy of the windows a task
        judge = _judge(_windows(blocks[0], width), drop_from)
        out = out.withColumn("_judged", judge(F.col(at["text"]).cast("binary"))).where("not _judged.gone")
        cut = F.col("_judged.text").isNotNull()
        changed = {at["text"]: F.when(cut, F.col("_judged.text")).otherwise(F.col(at["text"]))}
        if "n_chars" in at:
            kind = docs.schema["n_chars"].dataType
            changed[at["n_chars"]] = F.when(cut, F.length("_judged.text").cast(kind)).otherwise(F.col(at["n_chars"]))
        return out.withColumns(changed).drop("_judged").toDF(*docs.columns)
    out = with_hits(out, at["text"], benchmark, "_hits", width, block_bytes)
    n_hit = F.aggregate("_hits.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = out.where((n_hit == 0) | (n_hit < drop_from * F.col("_hits.n_words")))
    text = F.col(at["text"])
    for block in blocks:
        clean = _cleaner(_windows(block, width))
        # One block at a time in a task's memory.
        out = stored(out, "hits").withColumn(at["text"], F.when(F.size("_hits.spans") > 0, clean(text.cast("binary"), F.col("_hits.spans"))).otherwise(text))
    if "n_chars" in at:
        kind = docs.schema["n_chars"].dataType
        out = stored(out, "hits")
        out = out.withColumn(at["n_chars"], F.when(F.size("_hits.spans") > 0, F.length(at["text"]).cast(kind)).otherwise(F.col(at["n_chars"])))
    return out.drop("_hits").toDF(*docs.columns)


def _cleaned(text: bytes | None, spans, windows: Windows) -> str | None:
    if text is None:
        return None
    while len(spans):
        spans = windows.hits(text)[1]
        text = cut_spans(text, spans)
    return text.decode()
