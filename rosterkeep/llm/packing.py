"""Best-fit packing of documents into sequences, with a swap-based local search.

Every document becomes its token ids and one end id; only documents longer than a sequence are cut, into full pieces and a
rest. A full piece is a sequence of its own. The other pieces are dealt into groups of about ``GROUP`` pieces by a hash. In
a group, pieces go by falling length to the fullest sequence they fit in. Then pieces move from emptier to fuller underfull
sequences, are exchanged one for one, or two for one, whenever that raises the sum of the squared fills; so sequences run
empty and are dropped. The sequences that stay underfull are dealt anew into fewer groups and packed once more, so that what
each group leaves over is filled up across groups.

Texts are encoded with the tokenizer file at ``tokenizer``, read on each executor. The tokenizer drops white space and no
token spans it or the border between letters and other characters, so a batch's distinct runs are encoded once each and put
together; the ids are those of encoding the whole text. Texts with apostrophes (contractions are tokens), with what could be
a special token, or with characters other than ASCII and the letters of two bytes are only cut at blanks.

A null text is empty: its piece is the end id alone. Repeated documents are packed each. Without documents there are no
pieces. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from rosterkeep.llm.common import begin, give_back, groups_for, pick, pieces_of_bytes, stored

CAPACITY = 4096
END_ID = 1
#: Pieces packed together in one task.
GROUP = 20_000
ROUNDS = 4
TOKENIZER = "word_bpe_49k.json"
#: Distinct runs whose ids a process keeps, at about 50 bytes each.
KEPT_RUNS = 1_000_000
#: What stands between runs that are encoded together, and how many those are at most.
_BETWEEN, _TOGETHER = "|", 1000

#: What makes a text be cut at blanks only: beyond the letters of two bytes, contractions, the begin of special tokens.
_WIDE = re.compile(rb"[\xe0-\xff]|\xc2[^\xaa\xb5\xba]|\xc3[\x97\xb7]|'|<\|")
#: Of each byte: 0 white space, 1 a letter or part of one, 2 anything else.
_KINDS = np.array([0 if b in b" \t\n\r\x0b\x0c" else 1 if b >= 0x80 or 0x61 <= b <= 0x7A else 2 for b in range(256)], np.uint8)
#: Two odd numbers, whose powers weigh the bytes of a run in its two hashes.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes of a longer text that are encoded at once.
_SEGMENT = 1 << 19


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a number and of its inverse, modulo 2^64."""
    both = []
    for x in (base, pow(base, -1, 1 << 64)):
        out = np.full(n, x, np.uint64)
        out[0] = 1
        both.append(np.multiply.accumulate(out))
    return both[0], both[1]


def _segments(text: bytes) -> list[bytes]:
    """A text, cut at white space where it is long."""
    out, start = [], 0
    while len(text) - start > _SEGMENT:
        end = start + _SEGMENT
        while end < len(text) and _KINDS[text[end]]:
            end += 1
        out.append(text[start:end])
        start = end
    return [*out, text[start:]]


class Encoder:
    """Token ids of whole texts; keeps the ids of the runs it met."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        alone = [self._ids(text) for text in ("ab", _BETWEEN, "ba")]
        #: The one id of what stands between runs; None if the tokenizer does not keep it apart.
        self.between = alone[1][0] if len(alone[1]) == 1 and self._ids(f"ab {_BETWEEN} ba") == sum(alone, []) else None
        self.forget()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def forget(self) -> None:
        #: Of each run known, in order of its first hash: both hashes, its number, and whether it may stand in a plain text.
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.numbers, self.plain = np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the number of each text."""
        parts = [_segments(t) for t in texts]
        flat = [part for own in parts for part in own]
        found = [self._encode(flat[a:b]) for a, b in pieces_of_bytes(flat, _SEGMENT)]
        if not found:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        sizes = np.concatenate([n for _, n in found])
        starts = np.cumsum([0, *map(len, parts)])
        return np.concatenate([ids for ids, _ in found]), np.diff(np.concatenate(([0], np.cumsum(sizes)))[starts])

    def _encode(self, texts: list[bytes], at_blanks: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) > KEPT_RUNS:
            self.forget()
        at_blanks = at_blanks or [bool(_WIDE.search(t)) for t in texts]
        # Of bytes, so A-Z only; as the tokenizer does it.
        joined = b"\n".join([t if wide else t.lower() for t, wide in zip(texts, at_blanks)]) + b"\n"
        data = np.frombuffer(joined, np.uint8)
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        kinds = _KINDS[data]
        for i in np.flatnonzero(at_blanks).tolist():
            kinds[bounds[i] : bounds[i + 1]] = kinds[bounds[i] : bounds[i + 1]] != 0
        change = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
        starts, ends = np.concatenate(([0], change)), np.append(change, len(data))
        some = kinds[starts] != 0
        starts, ends = starts[some], ends[some]
        sizes = np.diff(np.searchsorted(starts, bounds))

        keys = self._hashes(data, starts, ends)
        distinct, first, run = np.unique(keys[0], return_index=True, return_inverse=True)
        checks = keys[1][first]
        place = np.searchsorted(self.keys, distinct)
        inside = place < len(self.keys)
        known = np.zeros(len(distinct), bool)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        if (checks[run] != keys[1]).any() or (self.checks[place[known]] != checks[known]).any():
            raise ArithmeticError("two runs of characters have the same hash")  # of 64 bits, on one machine
        if not known.all():
            self._learn([joined[starts[i] : ends[i]] for i in first[~known].tolist()], distinct[~known], checks[~known], place[~known])
            place = np.searchsorted(self.keys, distinct)
        odd = ~self.plain[place][run] & (kinds[starts] == 1)
        if odd.any():
            texts_of_odd = np.searchsorted(bounds, starts[odd], "right") - 1
            again = [wide or i in set(texts_of_odd.tolist()) for i, wide in enumerate(at_blanks)]
            if again != at_blanks:
                return self._encode(texts, again)
        of_run = self.numbers[place][run]
        n = self.lengths[of_run]
        ends = np.cumsum(n)
        begins = np.cumsum(self.lengths) - self.lengths
        flat = self.ids[np.repeat(begins[of_run] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        edges = np.concatenate(([0], ends))[np.cumsum([0, *sizes])]
        return flat, np.diff(edges)

    @staticmethod
    def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Two hashes of each run: its bytes weighed by powers, wherever it stands."""
        out = []
        size = 1 << max(_SEGMENT, len(data)).bit_length()
        for base in _BASES:
            powers, inverse = _powers(base, size)
            sums = np.cumsum((data + np.uint64(1)) * powers[: len(data)])
            before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
            mixed = (sums[ends - 1] - before) * inverse[starts]
            out.append((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD) + (ends - starts).astype(np.uint64))
        return out

    def _learn(self, runs: list[bytes], keys: np.ndarray, checks: np.ndarray, place: np.ndarray) -> None:
        """Encode runs that are new, in order of their first hash, and keep them."""
        texts = [r.decode() for r in runs]
        plain = np.array([t.isascii() or t.isalpha() for t in texts])
        joined = plain & np.array([_BETWEEN not in t for t in texts]) & (self.between is not None)
        together = [texts[i] for i in np.flatnonzero(joined).tolist()]
        apart = [texts[i] for i in np.flatnonzero(~joined).tolist()]
        rows = [f" {_BETWEEN} ".join([*together[i : i + _TOGETHER], ""]) for i in range(0, len(together), _TOGETHER)]
        flat, lengths = [], np.zeros(len(texts), np.int64)
        if rows:
            ids = np.fromiter(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)), np.uint32)
            ends = np.flatnonzero(ids == self.between)
            lengths[joined] = np.diff(ends, prepend=-1) - 1
            flat.append(np.delete(ids, ends))
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(apart, add_special_tokens=False)]
        lengths[~joined] = [len(c) for c in coded]
        flat.append(np.fromiter(chain.from_iterable(coded), np.uint32))
        numbers = np.empty(len(texts), np.int64)
        numbers[joined] = len(self.lengths) + np.arange(len(together))
        numbers[~joined] = len(self.lengths) + len(together) + np.arange(len(apart))
        self.lengths = np.concatenate((self.lengths, lengths[joined], lengths[~joined]))
        self.ids = np.concatenate((self.ids, *flat))
        self.keys, self.checks = np.insert(self.keys, place, keys), np.insert(self.checks, place, checks)
        self.numbers, self.plain = np.insert(self.numbers, place, numbers), np.insert(self.plain, place, plain)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length`` and ``ids_crc32`` of each piece of each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("packing", _encoder.cache_clear)
        encoder = _encoder(tokenizer or tokenizer_path())
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for a, b in pieces_of_bytes(texts):
                ids, sizes = encoder.encode(texts[a:b])
                place, number, start, length, crc = [], [], [], [], []
                at = 0
                for i, n in enumerate(sizes.tolist(), a):
                    own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    for k, s in enumerate(range(0, len(own), capacity)):
                        part = own[s : s + capacity]
                        place.append(i), number.append(k), start.append(s), length.append(len(part)), crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(place)), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        give_back()

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(cut, _PIECES)


class Bins:
    """Pieces of one group in sequences; all work is on their lengths."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bin = np.zeros(len(lengths), np.int64)
        self.fill = np.zeros(0, np.int64)
        self._best_fit()

    def _best_fit(self) -> None:
        """Pieces by falling length, each to the fullest sequence it fits in; sequences by room, rooms in a bit set."""
        rooms: dict[int, list[int]] = {}
        present = 0
        fill: list[int] = []
        for i in np.argsort(-self.lengths, kind="stable").tolist():
            n = int(self.lengths[i])
            above = present >> n
            if above:
                room = n + (above & -above).bit_length() - 1
                b = rooms[room].pop()
                if not rooms[room]:
                    present ^= 1 << room
            else:
                room, b = self.capacity, len(fill)
                fill.append(0)
            fill[b] += n
            self.bin[i] = b
            if left := room - n:
                rooms.setdefault(left, []).append(b)
                present |= 1 << left
        self.fill = np.array(fill, dtype=np.int64)

    def improve(self, rounds: int = ROUNDS) -> None:
        for _ in range(rounds):
            if not self._round():
                break

    def _round(self) -> bool:
        """Each underfull sequence, the emptiest first, gives to fuller ones what raises the sum of squares."""
        under = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
        mine = np.flatnonzero(np.isin(self.bin, under))
        of: dict[int, list[int]] = {}
        for i in mine.tolist():
            of.setdefault(int(self.bin[i]), []).append(i)
        changed = False
        for donor in under[np.argsort(self.fill[under], kind="stable")].tolist():
            for i in sorted(of.get(donor, []), key=lambda i: -self.lengths[i]):
                if self.bin[i] == donor and (self._move(donor, i, under) or self._exchange(donor, [i], mine)):
                    changed = True
            own = np.flatnonzero(self.bin[mine] == donor)
            own = mine[own].tolist()
            for a in range(len(own)):
                for b in range(a + 1, len(own)):
                    if self.bin[own[a]] == donor == self.bin[own[b]] and self._exchange(donor, [own[a], own[b]], mine):
                        changed = True
        return changed

    def _move(self, donor: int, piece: int, under: np.ndarray) -> bool:
        n, fill = self.lengths[piece], self.fill[under]
        # (f + n)^2 + (d - n)^2 > f^2 + d^2 where f + n > d.
        fits = (fill + n <= self.capacity) & (fill + n > self.fill[donor]) & (fill > 0) & (under != donor)
        if not fits.any():
            return False
        taker = under[np.argmax(np.where(fits, fill, -1))]
        self.bin[piece] = taker
        self.fill[taker] += n
        self.fill[donor] -= n
        return True

    def _exchange(self, donor: int, given: list[int], mine: np.ndarray) -> bool:
        """One or two pieces of the donor for one piece elsewhere that is shorter than they are together."""
        n = self.lengths[given].sum()
        gain, taker = n - self.lengths[mine], self.bin[mine]
        after = self.fill[taker] + gain
        fits = (gain > 0) & (after <= self.capacity) & (after > self.fill[donor]) & (taker != donor)
        if not fits.any():
            return False
        back = mine[np.argmax(np.where(fits, after, -1))]
        taker = self.bin[back]
        gain = n - self.lengths[back]
        self.bin[given], self.bin[back] = taker, donor
        self.fill[taker] += gain
        self.fill[donor] -= gain
        return True


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each piece its sequence (numbered without gaps), its offset there, and its sequence's fill."""
    bins = Bins(lengths, capacity)
    bins.improve(rounds)
    _, sequence = np.unique(bins.bin, return_inverse=True)
    order = np.argsort(sequence, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    first = np.concatenate(([True], np.diff(sequence[order]) > 0)) if len(order) else np.zeros(0, bool)
    offset = np.empty(len(lengths), np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
    return sequence, offset, bins.fill[bins.bin]


def _packed(rows: DataFrame, n_groups: int, level: int, capacity: int, rounds: int) -> DataFrame:
    """Pieces with sequence, offset and fill. A sequence id holds the level, the group and the number in the group."""
    key = F.pmod(F.xxhash64("doc_id", "piece", F.lit(level)), F.lit(n_groups))

    def pack(group: pa.Table) -> pa.Table:
        sequence, offset, fill = pack_lengths(group["length"].to_numpy(), capacity, rounds)
        number = (level << 60) + group["group"][0].as_py() * (1 << 28) + sequence
        out = group.drop_columns(["group"])
        for name, values in (("sequence_id", number), ("offset", offset), ("fill", fill)):
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out

    return rows.withColumn("group", key).groupBy("group").applyInArrow(pack, f"{_PIECES}, sequence_id long, offset long, fill long")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; also ``fill``, the tokens of its sequence."""
    cut = stored(pieces(docs, tokenizer, capacity, end_id), "pieces")
    full = F.col("length") == capacity
    whole = cut.where(full).select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("fill"))
    rest = cut.where(~full)
    first = stored(_packed(rest, groups_for(rest.count(), group), 1, capacity, rounds), "packed")
    done = F.col("fill") == capacity
    again = first.where(~done).select(*cut.columns)
    second = _packed(again, groups_for(again.count(), group), 2, capacity, rounds)
    # Sequences without a level are the numbers of whole pieces: below 2**60 for any number of partitions under 2**27.
    return whole.unionByName(first.where(done)).unionByName(second)
