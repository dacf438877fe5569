"""Records of CSV files whose quoted fields may hold line feeds, read by many tasks a file.

A physical line ends a record unless a quoted field is open at its end, and whether one is depends on all lines before it. So
files are read twice. The first pass gives for each split of a file, for both cases (a field is open at its begin, or not),
whether one is open at its end and at which line that record began. From these few numbers a split the driver works out
each split's real begin. The second pass then puts the lines together to records; lines of a record that goes on over the
border of a split are glued by file and record. A quote opens a field only at the field's begin; doubled ones are part of it.

A record that is still open at the end of its file has a quote that was never closed. Its lines are not glued, however many
they are: each is given as a row of its own, marked so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

QUOTE, COMMA = b'"', b","
BYTE_ORDER_MARK = b"\xef\xbb\xbf"

_SPLIT = (
    "file string, start long, length long, lines long, header binary, header_line long, "
    "closed_after boolean, closed_tail long, open_after boolean, open_tail long"
)
_RECORD = "file string, line long, record binary, part string, unclosed boolean, layout int"


class NoHeader(ValueError):
    """A file whose first record does not end, or not soon enough to be read as a header."""


class ChangedSplits(RuntimeError):
    """The files are split otherwise than when their borders were looked for; they have to be read anew."""


def ends_open(line: bytes, open_before: bool) -> bool:
    """Whether a quoted field is open at the end of a line."""
    at = 0
    inside = open_before
    while True:
        if not inside:
            # At the begin of a field; the next one that begins with a quote.
            if line[at : at + 1] != QUOTE:
                at = line.find(COMMA + QUOTE, at)
                if at < 0:
                    return False
                at += 1
            at += 1
        # Within a quoted field: to its closing quote, then on to the next field.
        while True:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] != QUOTE:
                break
            at += 2
        at = line.find(COMMA, at + 1)
        if at < 0:
            return False
        at, inside = at + 1, False


@dataclass
class Split:
    """Where a split of a file stands in it."""

    layout: int
    crlf: bool
    first_line: int
    #: Whether a record is open at the begin; the names of that record and of the one open at the end, NULL if never closed.
    open_before: bool
    head: str | None = None
    tail_at: int | None = None
    tail: str | None = None


def _names(schema: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in schema.split(",")]


def _lines(spark: SparkSession, files: list[str], line_sep: str) -> DataFrame:
    place = [F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "file"), ("file_block_start", "start"), ("file_block_length", "length"))]
    return spark.read.option("lineSep", line_sep).text(files).select(F.col("value").cast("binary").alias("line"), *place)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array]]:
    """Lines of one split after another, batch by batch."""
    for batch in batches:
        starts, lengths = batch["start"].to_numpy(), batch["length"].to_numpy()
        files = batch["file"].dictionary_encode()
        codes = files.indices.to_numpy()
        changes = np.flatnonzero((starts[1:] != starts[:-1]) | (codes[1:] != codes[:-1]) | (lengths[1:] != lengths[:-1])) + 1
        for a, b in zip([0, *changes], [*changes, len(starts)]):
            if a < b:
                yield (files.dictionary[int(codes[a])].as_py(), int(starts[a]), int(lengths[a])), batch["line"].slice(a, b - a)


#: A field with the comma behind it left out, and one that is open at the end of the line.
_FIELD, _OPEN = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*)?', r'"(?:[^"]|"")*\z'
#: Lines after which ``ends_open``, if no field was open before, and if one was.
_FROM_CLOSED = rf"\A(?:{_FIELD},)*{_OPEN}"
_FROM_OPEN = rf'\A(?:[^"]|"")*(?:\z|"(?:[^",][^,]*)?,(?:{_FIELD},)*{_OPEN})'


def _moves(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``ends_open`` of each line, if no field was open before and if one was; a line without a quote changes nothing."""
    quoted = pc.match_substring(lines, '"')
    closed, opened = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    at = np.flatnonzero(quoted.to_numpy(zero_copy_only=False))
    if len(at):
        some = lines if len(at) == len(lines) else lines.filter(quoted)
        closed[at] = pc.match_substring_regex(some, _FROM_CLOSED).to_numpy(zero_copy_only=False)
        opened[at] = pc.match_substring_regex(some, _FROM_OPEN).to_numpy(zero_copy_only=False)
    return closed, opened


def _states(moves: tuple[np.ndarray, np.ndarray], is_open: bool) -> tuple[np.ndarray, np.ndarray]:
    """Whether a field is open before and after each line, with the state before the first one given."""
    closed, opened = moves
    # The last line so far that leads to one state from both, and how often the state was turned over since.
    last = np.maximum.accumulate(np.where(closed == opened, np.arange(len(closed)), -1))
    turned = np.cumsum(closed & ~opened)
    after = np.where(last >= 0, closed[last], is_open) ^ ((turned - np.where(last >= 0, turned[last], 0)) % 2 == 1)
    return np.concatenate(([is_open], after[:-1])), after


class _Survey:
    """What the lines of one split lead to."""

    def __init__(self, split: tuple, quoted_breaks: bool):
        self.split, self.quoted_breaks, self.lines = split, quoted_breaks, 0
        #: For both states at the begin: whether a field is open now, and the line at which its record began.
        self.states = {False: (False, None), True: (quoted_breaks, None)}
        self.header: list[bytes] = []
        self.header_line = None
        self.in_header = split[1] == 0

    def add(self, lines: pa.Array) -> None:
        for i in range(len(lines) if self.in_header else 0):
            line = lines[i].as_py()
            if not self.header and not line.removeprefix(BYTE_ORDER_MARK).rstrip(b"\r"):
                continue  # blank lines before it
            self.header.append(line)
            self.header_line = self.header_line or self.lines + i + 1
            if not (self.quoted_breaks and ends_open(b"\n".join(self.header), False)):
                self.in_header = False
                break
        if self.quoted_breaks:
            moves = _moves(lines)
            for begin, (is_open, tail) in self.states.items():
                before, after = _states(moves, is_open)
                began = np.flatnonzero(after & ~before)
                tail = self.lines + int(began[-1]) if len(began) else tail
                self.states[begin] = bool(after[-1]), tail if after[-1] else None
        self.lines += len(lines)

    def row(self) -> tuple:
        header = b"\n".join(self.header) if self.header and not self.in_header else None
        return (*self.split, self.lines, header, self.header_line, *self.states[False], *self.states[True])


def _surveyed(quoted_breaks: bool):
    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a split."""

        def batch_of(done: _Survey) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), *[pa.bool_(), pa.int64()] * 2]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(done.row(), kinds, strict=True)], names=_names(_SPLIT))

        now = None
        for split, lines in _runs(batches):
            if now is None or split != now.split:
                if now is not None:
                    yield batch_of(now)
                now = _Survey(split, quoted_breaks)
            now.add(lines)
        if now is not None:
            yield batch_of(now)

    return survey


def _place(rows: list, layouts: dict[bytes, int]) -> dict[tuple, Split]:
    """The splits of one file, in order."""
    parts = sorted(rows, key=lambda r: r["start"])
    header = next((p["header"] for p in parts if p["header"] is not None), b"")
    layout, crlf = layouts[_bare(header)], header.endswith(b"\r")
    placed: dict[tuple, Split] = {}
    is_open, line, record = False, 1, None
    for p in parts:
        after, tail = (p["open_after"], p["open_tail"]) if is_open else (p["closed_after"], p["closed_tail"])
        split = placed[p["file"], p["start"], p["length"]] = Split(layout, crlf, line, is_open, record)
        if after and tail is not None:
            record = f"{p['file']}#{line + tail}"
            split.tail_at, split.tail = tail, record
        elif not after:
            record = None
        is_open, line = after, line + p["lines"]
    if is_open:  # the last record is never closed
        for split in placed.values():
            split.head = None if split.head == record else split.head
            split.tail = None if split.tail == record else split.tail
    return placed


def _bare(header: bytes) -> bytes:
    return header.removeprefix(BYTE_ORDER_MARK).removesuffix(b"\r").replace(b"\r\n", b"\n")


def _without_return(lines: pa.Array) -> pa.Array:
    return pc.if_else(pc.ends_with(lines, b"\r"), pc.binary_slice(lines, 0, -1), lines)


def _gathered(places: dict[tuple, Split], quoted_breaks: bool):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole records, and lines of those that go on over the border of a split or are never closed."""
        key = split = None
        number, is_open, in_head, began = 0, False, False, 0
        held: list[bytes] = []

        def rows(at, texts: pa.Array, part: str | None, unclosed: bool) -> pa.RecordBatch:
            n = len(texts)
            columns = [pa.repeat(key[0], n), pa.array(split.first_line + np.asarray(at, np.int64)), texts, pa.array([part] * n, pa.string())]
            columns += [pa.array(np.full(n, unclosed)), pa.array(np.full(n, split.layout, np.int32))]
            return pa.RecordBatch.from_arrays(columns, names=_names(_RECORD))

        for of, lines in _runs(batches):
            if of != key:
                if of not in places:
                    raise ChangedSplits(f"{of[0]} was split otherwise at first")
                key, split, number, held = of, places[of], 0, []
                is_open = in_head = split.open_before
            n = len(lines)
            moves = _moves(lines) if quoted_breaks else (np.zeros(n, bool), np.ones(n, bool))
            before, after = _states(moves, is_open)
            if split.crlf:
                # Breaks within a record are line feeds where the file's rows end in CRLF.
                lines = _without_return(lines)
            starts = np.flatnonzero(~before)
            first = int(starts[0]) if len(starts) else n
            tail = n if split.tail_at is None else min(max(split.tail_at - number, 0), n)
            if first:  # lines of a record that began before
                if in_head:
                    yield rows(range(number, number + first), lines.slice(0, first), split.head, split.head is None)
                elif tail == 0:
                    yield rows(range(number, number + first), lines.slice(0, first), split.tail, split.tail is None)
                else:
                    held += lines.slice(0, first).to_pylist()
                if not after[first - 1]:
                    if held:
                        yield rows([began], pa.array([b"\n".join(held)], pa.binary()), None, False)
                    held, in_head = [], False
            if first < tail:
                starts, end = starts[starts < tail], tail
                if after[tail - 1]:  # its end comes with the next lines
                    end, starts = int(starts[-1]), starts[:-1]
                    began, held = number + end, lines.slice(end, tail - end).to_pylist()
                if len(starts):
                    texts = lines.slice(first, end - first)
                    if len(starts) < end - first:
                        offsets = pa.array(np.append(starts, end) - first, pa.int32())
                        texts = pc.binary_join(pa.ListArray.from_arrays(offsets, texts), b"\n")
                    yield rows(number + starts, texts, None, False)
            if (rest := max(first, tail)) < n:
                yield rows(range(number + rest, number + n), lines.slice(rest), split.tail, split.tail is None)
            number, is_open = number + n, bool(after[-1])

    return gather


def records(spark: SparkSession, files: list[str], quoted_breaks: bool = True, line_sep: str = "\n") -> tuple[DataFrame, list[str]]:
    """``file, line, record, unclosed, layout`` of each record but the headers and blank lines, and the different headers.

    ``line`` is where the record begins, from 1; ``layout`` the number of its file's header. ``quoted_breaks=False`` takes
    each line as a record. The first pass runs at once; it must find the files split as the second one will.
    """
    lines = _lines(spark, files, line_sep)
    by_file: dict[str, list] = {}
    for row in lines.mapInArrow(_surveyed(quoted_breaks), _SPLIT).collect():
        by_file.setdefault(row["file"], []).append(row)
    for file, rows in by_file.items():
        if all(r["header"] is None for r in rows) and (len(rows) > 1 or rows[0]["header_line"]):
            raise NoHeader(f"no header that ends within the first part of {file}")
    headers = {file: next((r["header"], r["header_line"]) for r in rows if r["header"] is not None) for file, rows in by_file.items() if any(r["header"] for r in rows)}
    layouts = {h: i for i, h in enumerate(sorted({_bare(h) for h, _ in headers.values()}))}
    places: dict[tuple, Split] = {}
    for file, rows in by_file.items():
        # A file of blank lines only has no header, and no records.
        places |= _place(rows, layouts) if file in headers else {(r["file"], r["start"], r["length"]): Split(0, False, 1, False) for r in rows}
    found = lines.mapInArrow(_gathered(places, quoted_breaks), _RECORD).withColumn("record", F.col("record").cast("string"))
    whole = found.where("part is null").drop("part")
    if any(split.tail for split in places.values()):
        listed = F.array_sort(F.collect_list(F.struct("line", "record")))["record"]
        glued = found.where("part is not null").groupBy("part", "file", "layout").agg(F.min("line").alias("line"), F.array_join(listed, "\n").alias("record"))
        whole = whole.unionByName(glued.withColumn("unclosed", F.lit(False)).drop("part"))
    last = max((line for _, line in headers.values()), default=1)
    if last == 1:
        whole = whole.where("line > 1")
    else:
        begins = spark.createDataFrame([(file, line) for file, (_, line) in headers.items()], "of string, header_line long")
        whole = whole.join(begins, F.col("file") == F.col("of")).where("line > header_line").drop("of", "header_line")
    return whole.where(F.rtrim(F.col("record"), F.lit("\r")) != ""), [h.decode("utf-8", "replace") for h in layouts]
