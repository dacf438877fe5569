"""Document fingerprints by winnowing.

The code points of a text give a rolling hash for each run of ``GRAM``; of every ``WINDOW`` hashes in a row the least is
kept, of equal ones the rightmost, together with its position. So two texts that share a run of ``GRAM + WINDOW - 1`` code
points share a kept hash, and the positions tell where. A text of fewer than ``GRAM`` code points, but not none, has its whole
as its one run; one with fewer runs than ``WINDOW`` keeps its least hash. An empty text has no hashes. Hashes have 32 bits.

The likeness of two fingerprints is the number of different hashes they share by the number either has; of two empty
fingerprints it is 1. Equal texts have equal fingerprints. Null texts count as empty. A very long text is hashed ``CHUNK`` code
points at a time with the overlap a window needs, so memory follows the text only, not its hashes' steps.

``with_next`` brings each document and its successor by id together without a window over all documents: rows are dealt
out and sorted by ranges of (id, hash of the text), so most successors are the next row of the same task. The first row of
each range, found beforehand from ids and hashes alone, goes to the range before as well; these keys, one a range, are the
only thing collected. Texts are shuffled once. The successor of the last document is the first; a single document is its
own. Rows that share an id are in the order of the hashes of their texts; a null id counts as the least. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterkeep.llm.common import groups_for, pick

GRAM = 10
WINDOW = 30
CHUNK = 1 << 18
#: Bytes of text in a range, about, where the session's number of shuffle partitions would give more.
RANGE = 64 << 20
#: Rows of this many bytes are handed on together.
GIVEN = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_PLACE = np.uint64(0xFFFFFFFF)


# --- Fingerprints -------------------------------------------------------------------------------------------------


def _rolling(points: np.ndarray, size: int) -> np.ndarray:
    """A 32-bit hash of each run of ``size`` code points, by doubling: a run is two shorter ones that may overlap."""
    hashes, length = points.astype(np.uint64) + np.uint64(1), 1
    while length < size:
        step = min(length, size - length)
        shift = np.uint64(pow(_BASE, length, 1 << 64) | 1)
        hashes = (hashes[:-step] * shift) ^ (hashes[step:] + np.uint64(length))
        hashes *= _MIX
        length += step
    return (hashes ^ (hashes >> np.uint64(33))) * _MIX >> np.uint64(32)


def _least(packed: np.ndarray, window: int) -> np.ndarray:
    """The least of each ``window`` values in a row."""
    length = 1
    while length < window:
        step = min(length, window - length)
        packed = np.minimum(packed[:-step], packed[step:])
        length += step
    return packed


def fingerprint(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The kept hashes and their positions, in order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    runs = max(1, len(points) - gram + 1)
    hashes, positions = [], []
    for start in range(0, max(1, runs - window + 1), CHUNK):
        end = min(runs, start + CHUNK + window - 1)
        rolled = _rolling(points[start : end + gram - 1], min(gram, len(points)))
        # Greater positions are lesser values, so of equal hashes the rightmost wins.
        packed = (rolled << np.uint64(32)) | (_PLACE - np.arange(start, start + len(rolled), dtype=np.uint64))
        kept = _least(packed, min(window, len(packed)))
        kept = kept[np.flatnonzero(np.concatenate(([True], kept[1:] != kept[:-1])))]
        hashes.append((kept >> np.uint64(32)).astype(np.uint32))
        positions.append((_PLACE - (kept & _PLACE)).astype(np.uint32))
    hashes, positions = np.concatenate(hashes), np.concatenate(positions)
    new = np.concatenate(([True], positions[1:] != positions[:-1]))  # a chunk's last may be the next one's first
    return hashes[new], positions[new]


def as_text(hashes: np.ndarray, positions: np.ndarray) -> str:
    """The fingerprint as text: base64 of little-endian (hash, position) pairs."""
    return base64.b64encode(np.stack([hashes, positions], axis=1).astype("<u4").tobytes()).decode() if len(hashes) else ""


def from_text(fingerprint_text: str) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(base64.b64decode(fingerprint_text), "<u4").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes by all hashes of two sets of different, sorted ones."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_chars`` and the arrays ``hashes`` and ``positions`` of each document."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch["text"]):
                text = text.as_py() or ""
                marks = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in fingerprint(text, gram, window)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, 1), pa.array([len(text)], pa.int64()), *marks], names=["doc_id", "n_chars", "hashes", "positions"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(batches_of, "doc_id long, n_chars long, hashes array<long>, positions array<long>")


# --- A document and its successor ---------------------------------------------------------------------------------


def _part_of(ids: np.ndarray, hashes: np.ndarray, first_ids: np.ndarray, first_hashes: np.ndarray) -> np.ndarray:
    """The range each (id, hash) lies in, by the first one of every range."""
    low, high = np.searchsorted(first_ids, ids, "left"), np.searchsorted(first_ids, ids, "right")
    part = high - 1
    for start in np.unique(low[low < high]):  # ids a range begins with: their hashes tell
        rows = np.flatnonzero((low == start) & (low < high))
        end = high[rows[0]]
        part[rows] = start + np.searchsorted(first_hashes[start:end], hashes[rows], "right") - 1
    return part


def with_next(docs: DataFrame, compare: Callable, schema: str) -> DataFrame:
    """``doc_id`` and what ``compare(text, next_text)`` returns, for each document by ascending id.

    ``schema`` names the columns of the values returned. ``compare`` gets and returns plain values; it may keep what it made
    of a text for the following call, where that is the first argument.
    """
    spark = docs.sparkSession
    least = F.lit(-(2**63)).cast("long")
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.coalesce("doc_id", least).alias("id"), F.xxhash64("text").alias("hash"), "text")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = np.lexsort((batch["hash"].to_numpy(), batch["id"].to_numpy()))[:1]
            yield batch.take(pa.array(order))

    # The first document of each range; ids and hashes only are shuffled for that.
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups_for(size, RANGE))
    keys = rows.select("id", "hash").repartitionByRange(ranges, "id", "hash")
    found = keys.mapInArrow(first, "id long, hash long").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("id", "hash")).alias("k"))
    firsts = sorted((r["k"]["id"], r["k"]["hash"]) for r in found.collect())
    if not firsts:
        return spark.createDataFrame([], f"doc_id long, {schema}")
    first_ids, first_hashes = (np.array(c, np.int64) for c in zip(*firsts))
    n = len(firsts)

    @F.pandas_udf("int")
    def part_of(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(_part_of(ids.to_numpy(), hashes.to_numpy(), first_ids, first_hashes).astype(np.int32))

    # The first document of a range also follows the range before, and that of the first one the last.
    before = spark.createDataFrame([(*key, (i - 1) % n) for i, key in enumerate(firsts)], "id long, hash long, part int")
    # One row a range: small enough to broadcast, and the texts stay where they are.
    heads = rows.join(F.broadcast(before), ["id", "hash"]).dropDuplicates(["part"])
    every = rows.withColumn("part", part_of("id", "hash")).select("part", F.lit(False).alias("head"), "doc_id", "id", "hash", "text")
    every = every.unionByName(heads.select("part", F.lit(True).alias("head"), "doc_id", "id", "hash", "text"))
    dealt = every.repartitionById(n, F.col("part")).sortWithinPartitions("part", "head", "id", "hash")

    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    kinds = [_arrow_type(f.dataType) for f in spark.createDataFrame([], f"doc_id long, {schema}").schema.fields]

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with the row that follows in its range; the last one of a range is the one that follows it."""

        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds, strict=True)], names=["doc_id", *names])

        last, held, size = None, [], 0
        for batch in batches:
            for part, head, doc_id, text in zip(*(batch[c].to_pylist() for c in ("part", "head", "doc_id")), batch["text"]):
                text = text.as_py()
                if last is not None and last[0] == part:
                    held.append((last[1], *compare(last[2], text)))
                    size += 64 + len(text)
                    if size >= GIVEN:
                        yield batch_of(held)
                        held, size = [], 0
                last = None if head else (part, doc_id, text)
        if held:
            yield batch_of(held)

    return dealt.select("part", "head", "doc_id", "text").mapInArrow(neighbours, f"doc_id long, {schema}")


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def edited(text: str, following: str, share: int = 4) -> str:
    """The last ``1 / share`` of the code points replaced by the first as many, or all, of another text."""
    n = len(text) // share
    return text[: len(text) - n] + following[:n]


class _Comparison:
    """Of a document, its edited text and its successor; a successor's fingerprint is kept until its own turn."""

    def __init__(self, gram: int, window: int):
        self.options, self.kept = (gram, window), None

    def __getstate__(self):
        return {"options": self.options, "kept": None}

    def __call__(self, text: str, following: str) -> tuple:
        own = self.kept[1] if self.kept and self.kept[0] == text else fingerprint(text, *self.options)
        after = fingerprint(following, *self.options)
        self.kept = following, after
        changed = edited(text, following)
        changed_marks = fingerprint(changed, *self.options)
        sets = [np.unique(marks[0]) for marks in (own, changed_marks, after)]
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return len(text), digest, as_text(*own), as_text(*changed_marks), likeness(sets[0], sets[1]), likeness(sets[0], sets[2])


def compare_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of each document."""
    schema = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, _Comparison(gram, window), schema)
