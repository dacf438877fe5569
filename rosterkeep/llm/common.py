"""What several operators need: shared scratch tables, columns picked by place, words of a text, split by id."""

from __future__ import annotations

import ctypes
import gc
import math
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterkeep.sources.paths import shared_folder

#: A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: The same, and every byte that is neither a digit, a letter nor part of a character beyond ASCII becomes a space.
LOWER_WORDS = bytes(LOWER[b] if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(128)) + bytes(range(128, 256))
#: A-Z to a-z and the bytes 0x09-0x0D to a space; 0x1C-0x1F stay, since they separate nothing.
LOWER_BLANKS = bytes(0x20 if 0x09 <= b <= 0x0D else LOWER[b] for b in range(256))

#: Whether Spark removes the shuffle files of a query when it ends, rather than some time later.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def blank_words(text: bytes) -> list[bytes]:
    """Lower-cased runs ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text."""
    return text.translate(LOWER_BLANKS).split()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet in the shared folder and read again.

    This cuts the lineage: a lost executor costs the running stage only. The shuffle files of the writing go with its end,
    the table when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a batch that goes to Python; Spark's own bound is many times that, and a worker holds a batch several times.
BATCH = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``BATCH`` bytes; lower bounds stay."""
    before = spark.conf.get(_BATCH, None)
    size = re.fullmatch(r"(\d+)b?", before or "", re.IGNORECASE)
    if not size or not 0 < int(size[1]) <= BATCH:
        spark.conf.set(_BATCH, str(BATCH))


#: What operators keep in a worker process from one task to the next, and how it is dropped.
_kept: dict[str, Callable[[], None]] = {}


def begin(operator: str, forget: Callable[[], None] | None = None) -> None:
    """Called by a task that begins: what other operators kept in this process is dropped."""
    others = [o for o in _kept if o != operator]
    for other in others:
        _kept.pop(other)()
    if others:
        give_back()
    if forget:
        _kept[operator] = forget


def give_back() -> None:
    """Hand freed memory back to the system, which allocators otherwise keep for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Columns by their exact names, whatever else the frame has (also names that differ only in case).

    They are what an operator sends to Python, so batches are made small.
    """
    small_batches(df.sparkSession)
    places = [df.columns.index(n) for n in names]
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_{i}").alias(n) for i, n in zip(places, names, strict=True)])


def with_columns_by_place(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with numbered columns, and the number of each exact name; ``toDF(*df.columns)`` takes it back."""
    numbered = [f"_{i}" for i in range(len(df.columns))]
    return df.toDF(*numbered), dict(zip(df.columns, numbered, strict=True))


def join_reduced(df: DataFrame, reduced: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join by columns with a side that was aggregated by them.

    Spark would reuse the partitioning of that aggregate, and adaptive execution then cannot split a hot key. The digest as one
    more key makes Spark shuffle the reduced side too, which has one row a key by then, so that it can.
    """
    digest = F.xxhash64(*names)
    return df.withColumn("_digest", digest).join(reduced.withColumn("_digest", digest), [*names, "_digest"], how).drop("_digest")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def pieces_of_bytes(texts: Iterable[bytes], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of a batch of texts with about ``limit`` bytes each, so that memory does not follow the batch."""
    start = size = at = 0
    for at, text in enumerate(texts, 1):
        size += len(text)
        if size >= limit:
            yield start, at
            start, size = at, 0
    if at > start:
        yield start, at


def groups_for(rows: int, per_group: int) -> int:
    return max(1, math.ceil(rows / per_group))
