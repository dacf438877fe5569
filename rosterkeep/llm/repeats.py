"""Removal of repeated byte strings over a corpus: every byte covered by a 100-byte string that also starts earlier goes.

Earlier means a smaller doc_id, or an earlier start in the same document. Strings are judged on the input and never cross
documents. The suffixes of a whole corpus can't be merged in one task, so they are first cut by content:

1. Texts are written as batches of about ``BATCH`` bytes. Each window of 100 bytes has an anchor, the 20 bytes in it with
   the least hash (the first of equal ones); equal windows have equal anchors at equal places. Neighbouring windows with one
   anchor make a segment.
2. Only hashes of anchors and segments are shuffled, one row for each different segment of a batch. Of equal segments all
   but the earliest go wholly, so a passage in a third of all documents is one row a batch. A segment that is alone at its
   anchor is done.
3. The others, each different one once, are dealt by their anchor with their bytes.
4. Different segments at one anchor may still share windows. One that shares neither the 40 bytes before the anchor nor
   the 40 bytes after it with another shares no window. Shards of the others become Burrows-Wheeler transforms and
   are merged by interleave refinement (``bwt_merge``); the blocks of ranks with common prefixes of 100 bytes are the
   repeated windows. All but the earliest of a block go. Every block is verified on its bytes.
5. An anchor with more than ``MOST`` bytes of different segments does not fit a shard; its windows are rows, the earliest of
   equal windows found by an aggregation.

Null texts are empty. Documents without an id come after all others. Rows that share an id count as one document: equal
strings at the same place of such rows do not remove each other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rosterkeep.llm.bwt_merge import equal_windows, hashes
from rosterkeep.llm.common import pick, stored

WIDTH = 100
ANCHOR = 20
BATCH = 6 << 20
#: Bytes of different segments merged at a time, and of one shard among them.
BLOCK = 768 << 10
SHARD = 512 << 10
MOST = 3 << 19
_CHUNK = (1 << 20) - 2 * WIDTH
_LAST = np.iinfo(np.int64).max


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.compress(out.getvalue(), 7)


def _unpacked(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(zstandard.decompress(blob))) as arrays:
        return dict(arrays)


def _batches(batches: Iterator[pa.RecordBatch], batch_bytes: int) -> Iterator[pa.RecordBatch]:
    """Texts put together, with their ids; one row a batch."""
    base, number = TaskContext.get().partitionId() << 32, 0
    ids, texts, size = [], [], 0

    def flush() -> pa.RecordBatch:
        data = np.frombuffer(b"".join(texts), np.uint8)
        known = np.array([i is not None for i in ids])
        blob = _packed(ids=np.array([_LAST if i is None else i for i in ids], np.int64), known=known, lengths=np.array([len(t) for t in texts], np.int64), data=data)
        return pa.RecordBatch.from_arrays([pa.array([base + number], pa.int64()), pa.array([blob], pa.binary())], names=["batch", "blob"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids.append(doc_id), texts.append(text or b"")
            size += len(texts[-1]) + 1
            if size >= batch_bytes:
                yield flush()
                ids, texts, size, number = [], [], 0, number + 1
    if texts:
        yield flush()


_BASE = 0x9E3779B97F4A7C15
_POWERS, _INVERSES = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(_CHUNK + 2 * WIDTH, x, np.uint64)))) for x in (_BASE, pow(_BASE, -1, 1 << 64)))


class Segments(NamedTuple):
    """First and last window start of each segment of a batch, the hash and the place of its anchor, its own hash."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    place: np.ndarray
    whole: np.ndarray


def segments(data: np.ndarray, lengths: np.ndarray) -> Segments:
    """Texts lie one after the other."""
    ends = np.cumsum(lengths)
    out = []
    for at in range(0, len(data) - WIDTH + 1, _CHUNK):
        part = data[at : at + _CHUNK + WIDTH - 1]
        hashed = hashes(part, ANCHOR)
        # The place in the low bits: the least value is the first of equal hashes.
        key = (hashed & ~np.uint64((1 << 20) - 1)) | np.arange(len(hashed), dtype=np.uint64)
        n, w = len(part) - WIDTH + 1, WIDTH - ANCHOR + 1
        rows = -(-len(key) // w)
        full = np.full(rows * w, np.iinfo(np.uint64).max)
        full[: len(key)] = key
        full = full.reshape(rows, w)
        up = np.minimum.accumulate(full, axis=1).ravel()
        down = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(down[:n], up[w - 1 : w - 1 + n]) & np.uint64((1 << 20) - 1)).astype(np.int64)
        starts = np.arange(at, at + n)
        text_end = ends[np.searchsorted(ends, starts, "right")]
        valid = np.flatnonzero(starts + WIDTH <= text_end)
        if not len(valid):
            continue
        new = np.ones(len(valid), bool)
        new[1:] = (np.diff(valid) > 1) | (np.diff(anchor[valid]) != 0) | (np.diff(text_end[valid]) != 0)
        heads = np.flatnonzero(new)
        first, last = valid[heads], valid[np.append(heads[1:], len(valid)) - 1]
        of_segment = anchor[first]
        # The hashes of all its 20 bytes, each times a power of its place.
        summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashed * _POWERS[: len(hashed)])))
        whole = (summed[last + w] - summed[first]) * _INVERSES[first]
        out.append(Segments(first + at, last + at, hashed[of_segment].astype(np.int64), of_segment + at, whole.astype(np.int64)))
    return Segments(*(np.concatenate(x) for x in zip(*out, strict=True))) if out else Segments(*(np.zeros(0, np.int64) for _ in range(5)))


class _Located(NamedTuple):
    """Of the segments of a batch: text, id, start in the text, and whether an equal one is earlier in the batch."""

    doc: np.ndarray
    doc_id: np.ndarray
    start: np.ndarray
    later: np.ndarray


def _located(x: dict[str, np.ndarray], found: Segments) -> _Located:
    ends = np.cumsum(x["lengths"])
    doc = np.searchsorted(ends, found.first, "right")
    start = found.first - (ends - x["lengths"])[doc]
    doc_id = x["ids"][doc]
    order = np.lexsort((start, doc_id, found.whole, found.anchor))
    head = np.ones(len(order), bool)
    head[1:] = (np.diff(found.anchor[order]) != 0) | (np.diff(found.whole[order]) != 0)
    of = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))] if len(order) else order
    later = np.zeros(len(order), bool)
    later[order] = (doc_id[order] != doc_id[of]) | (start[order] != start[of])
    return _Located(doc, doc_id, start, later)


_ANCHORS = "batch long, idx int, anchor long, whole long, doc_id long, start long"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The earliest of each different segment of a batch."""
    for batch in batches:
        for number, blob in zip(batch.column("batch").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            x = _unpacked(blob)
            found = segments(x["data"], x["lengths"])
            at = _located(x, found)
            idx = np.flatnonzero(~at.later)
            columns = (np.full(len(idx), number), idx.astype(np.int32), found.anchor[idx], found.whole[idx], at.doc_id[idx], at.start[idx])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in _ANCHORS.split(", ")])


_SEGMENTS = "anchor long, segment binary, doc_id long, start long, batch long, doc int, size int"


def _again(left: pa.Table, right: pa.Table) -> pa.Table:
    """Segments of a batch to compare, with bytes and the place of their anchor as ``size``; ranges to remove, without."""
    idx, gone = right["idx"].to_numpy(), right["gone"].to_numpy()
    rows: list[tuple] = []
    for number, blob in zip(left["batch"].to_pylist(), left["blob"].to_pylist(), strict=True):
        x = _unpacked(blob)
        found = segments(x["data"], x["lengths"])
        at = _located(x, found)
        remove = at.later.copy()
        remove[idx[gone]] = True
        out = np.flatnonzero(remove)
        # Segments follow each other in a text: ranges that touch are one.
        begin, end = found.first[out], found.last[out] + WIDTH
        new = np.ones(len(out), bool)
        new[1:] = (begin[1:] > end[:-1]) | (np.diff(at.doc[out]) != 0)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(out)) - 1
        columns = (at.doc_id[out[heads]], at.start[out[heads]], at.doc[out[heads]], (end[tails] - begin[heads]) if len(out) else begin)
        rows += [(None, None, i, s, number, d, n) for i, s, d, n in zip(*(c.tolist() for c in columns), strict=True)]
        data, own = x["data"].tobytes(), idx[~gone]
        columns = (found.anchor, found.first, found.last, at.doc_id, at.start, at.doc, found.place - found.first)
        rows += [(h, data[a : b + WIDTH], i, s, number, d, p) for h, a, b, i, s, d, p in zip(*(c[own].tolist() for c in columns), strict=True)]
    names = [f.split()[0] for f in _SEGMENTS.split(", ")]
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


_REMOVED = "batch long, doc int, start long, end long, doc_id long, segment binary"


class _Removals:
    """Collects ranges to remove, and segments left over, as rows of ``_REMOVED``."""

    def __init__(self):
        self.rows: list[tuple] = []

    def range(self, segment: tuple, start: int, end: int) -> None:
        self.rows.append((segment[3], segment[4], start, end, None, None))

    def left_over(self, segment: tuple) -> None:
        self.rows.append((segment[3], segment[4], segment[2], None, segment[1], segment[0]))

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in _REMOVED.split(", ")])

    def merged(self, found: list[tuple]) -> None:
        """Ranges of the windows that occur earlier in another of these segments (bytes, doc_id, start, batch, doc, place)."""
        lengths = np.array([len(s[0]) + 1 for s in found], np.int64)
        data = np.frombuffer(b"".join(s[0] + b"\0" for s in found), np.uint8)
        places, block = equal_windows(data, lengths, WIDTH, SHARD)
        if not len(places):
            return
        begins = np.cumsum(lengths) - lengths
        of = np.searchsorted(begins, places, "right") - 1
        ids, starts = np.array([s[1] for s in found], np.int64), np.array([s[2] for s in found], np.int64)
        own_id, own_start = ids[of], starts[of] + places - begins[of]
        order = np.lexsort((own_start, own_id, block))
        head = np.ones(len(order), bool)
        head[1:] = np.diff(block[order]) != 0
        owner = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        later = (own_id[order] != own_id[owner]) | (own_start[order] != own_start[owner])
        # Symbols are hashes: the bytes decide.
        order, owner = order[later], owner[later]
        span = np.arange(WIDTH)
        same = np.concatenate([(data[places[order[i : i + 50_000], None] + span] == data[places[owner[i : i + 50_000], None] + span]).all(axis=1) for i in range(0, len(order), 50_000)] or [np.zeros(0, bool)])
        if not same.all():
            raise ArithmeticError("two different strings have the same hashes")
        gone = np.sort(places[order])
        if not len(gone):
            return
        segment = np.searchsorted(begins, gone, "right") - 1
        new = np.ones(len(gone), bool)
        new[1:] = (np.diff(gone) > 1) | (np.diff(segment) != 0)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(gone)) - 1
        for a, b, s in zip(gone[heads].tolist(), gone[tails].tolist(), segment[heads].tolist(), strict=True):
            at = found[s][2] - int(begins[s])
            self.range(found[s], a + at, b + at + WIDTH)


def _may_share(own: list[tuple]) -> list[tuple]:
    """The segments that share the bytes before or after their anchor with another.

    A window holds at least half of its other bytes on one side of the anchor.
    """
    half = (WIDTH - ANCHOR) // 2
    sides = [(s[0][s[5] - half : s[5]] if s[5] >= half else None, s[0][s[5] + ANCHOR : s[5] + ANCHOR + half]) for s in own]
    before, after = Counter(x for x, _ in sides), Counter(y for _, y in sides)
    return [s for s, (x, y) in zip(own, sides, strict=True) if (x is not None and before[x] > 1) or (len(y) == half and after[y] > 1)]


def _by_anchor(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows come by anchor; at one anchor all segments are different."""
    out, block, size = _Removals(), [], 0
    own: list[tuple] = []  # different segments of the anchor
    own_size, anchor, most = 0, None, False

    def close() -> None:
        nonlocal own, own_size, block, size, most
        if most:
            for s in own:
                out.left_over(s)
        elif len(own) > 1:
            shared = _may_share(own)
            block += shared
            size += sum(len(s[0]) for s in shared)
        own, own_size, most = [], 0, False
        if size >= BLOCK:
            out.merged(block)
            block, size = [], 0

    for batch in batches:
        for h, segment, doc_id, start, number, doc, size_or_place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            row = (segment, doc_id, start, number, doc, size_or_place)
            if segment is None:
                out.range(row, start, start + size_or_place)
                continue
            if h != anchor:
                close()
                anchor = h
            own.append(row)
            own_size += len(segment)
            if own_size > most_bytes:
                most = True
            if most:
                for s in own:
                    out.left_over(s)
                own = []
        yield out.take()
    close()
    if block:
        out.merged(block)
    yield out.take()


_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cutter(bytes_too: bool):
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        """Each text of a batch without its ranges: counts and the hash of what is kept."""
        rows = []
        doc, start, end = (right[c].to_numpy() for c in ("doc", "start", "end"))
        for blob in left["blob"].to_pylist():
            x = _unpacked(blob)
            begins = np.cumsum(x["lengths"]) - x["lengths"]
            depth = np.zeros(len(x["data"]) + 1, np.int32)
            np.add.at(depth, begins[doc] + start, 1)
            np.add.at(depth, begins[doc] + end, -1)
            gone = np.cumsum(depth)[:-1] > 0
            for doc_id, known, a, n in zip(x["ids"].tolist(), x["known"].tolist(), begins.tolist(), x["lengths"].tolist(), strict=True):
                own = gone[a : a + n]
                n_spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
                kept = x["data"][a : a + n][~own].tobytes()
                rows.append((doc_id if known else None, n, int(own.sum()), n_spans, hashlib.sha256(kept).hexdigest(), *[kept] * bytes_too))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * bytes_too]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[: len(names)]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return cut


def remove_repeats(docs: DataFrame, bytes_too: bool = True, batch_bytes: int = BATCH, most_bytes: int = MOST) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and ``kept``, the bytes that stay."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    texts = stored(rows.mapInArrow(lambda x: _batches(x, batch_bytes), "batch long, blob binary"), "batches")
    # At an anchor there is one row for each different segment of a batch, however often it occurs there.
    at_anchor = Window.partitionBy("anchor")
    first = Window.partitionBy("anchor", "whole").orderBy("doc_id", "start")
    anchors = texts.mapInArrow(_anchors, _ANCHORS).select(
        "batch",
        "idx",
        (F.struct("doc_id", "start") != F.first(F.struct("doc_id", "start")).over(first)).alias("gone"),
        (F.min("whole").over(at_anchor) != F.max("whole").over(at_anchor)).alias("several"),
    )
    wanted = anchors.where("gone or several").select("batch", "idx", "gone")
    found = texts.groupBy("batch").cogroup(wanted.groupBy("batch")).applyInArrow(_again, _SEGMENTS)
    spread = F.coalesce("anchor", F.xxhash64("batch", "doc", "start"))
    found = found.repartition(spread).sortWithinPartitions("anchor")
    removed = stored(found.mapInArrow(lambda x: _by_anchor(x, most_bytes), _REMOVED), "removed")

    long = removed.where("segment is not null").select("batch", "doc", "doc_id", "start", "segment")
    windows = F.transform(F.sequence(F.lit(1), F.length("segment") - (WIDTH - 1)), lambda i: F.substring("segment", i, F.lit(WIDTH)))
    windows = long.select("batch", "doc", "doc_id", "start", F.posexplode(windows).alias("i", "window"))
    windows = windows.withColumn("start", F.col("start") + F.col("i"))
    earliest = windows.groupBy("window").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = windows.join(earliest, "window").where(F.struct("doc_id", "start") > F.col("first"))
    ranges = removed.where("segment is null").select("batch", "doc", "start", "end")
    ranges = ranges.unionByName(repeated.select("batch", "doc", "start", (F.col("start") + WIDTH).alias("end")))
    kind = _KEPT + ", kept binary" * bytes_too
    return texts.groupBy("batch").cogroup(ranges.groupBy("batch")).applyInArrow(_cutter(bytes_too), kind)
