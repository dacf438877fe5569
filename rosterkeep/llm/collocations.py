"""Phrase collocations by SON partitioning (mine parts at a lowered support, unite, count exactly).

A text is lower-cased (A-Z), split at ``[.,;:!?]`` and line breaks into pieces and those at blanks and tabs into words; a
phrase is 1 to ``LONGEST`` words in a row within a piece. Everything is per language; a null language is ``und``.

1. *Mine each shard completely.* A document belongs to one of ``SHARDS`` shards by a hash of its id. A task counts the
   phrases of each shard and language in blocks of text, as sorted 64-bit keys, and deals them out in buckets by their
   leading bits. A bucket gathers the keys of all blocks, so counts of a key are whole there: first each shard's own.
   A phrase with the support asked for in all has, in at least one shard, its proportional part of it; so a shard keeps
   the phrases with at least ``support * (words of the shard) / (words of the language)``.
2. *Unite* the locally frequent keys of all shards, and drop those whose sum over the shards is below the support. What
   is left is one bit a key in a filter of ``2 ** FILTER_BITS`` bits, the only thing that is broadcast; its size does not
   depend on the corpus.
3. *Count all candidates globally and exactly.* A second pass over the texts writes out the phrases the filter has, counted
   block by block and dealt out in the same buckets, and a bucket sums them by their words. Keys that meet in a hash or a bit let through more to count, never
   less, so the counts are exact.

The number of shards is the same for every corpus, so the local support does not sink to one as the corpus grows; a shard
is mined by many tasks. The number of buckets follows the number of words, so a bucket stays at about ``BUCKET_KEYS`` keys,
however frequent one of them is: a block brings a key once.

Null and empty texts have no words. Rows that repeat a document count again. Very long texts are counted block by block,
with the words before a block's begin seen again. Null ids are one shard. An empty table gives no rows. Other columns are
ignored. A number a language and shard is collected, and the filter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterkeep.llm.common import LOWER, pick, stored

LONGEST = 4
SUPPORT = 30
SHARDS = 8
#: Bytes of text counted at once: when keys are dealt out, and in the last pass.
BLOCK, LAST_BLOCK = 4 << 20, 4 << 20
BUCKET_KEYS = 1 << 20
ROW_BITS = 11
FILTER_BITS = 27
MOST_BUCKET_BITS = 24

#: A-Z to a-z, tab to a blank, all that ends a piece to a full stop.
_PIECES = bytes(0x2E if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else LOWER[b] for b in range(256))
_STOP = b"."
#: Odd numbers for the places of words in a phrase and its length.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)

_DEALT = "bucket int, lang string, n int, keys binary, shards binary, counts binary"
_COUNTED = "bucket int, lang string, phrases binary, counts binary"


# --- Words and keys -----------------------------------------------------------------------------------------------


def _documents(docs: DataFrame) -> DataFrame:
    rows = pick(docs, "doc_id", "text", "lang").where("text is not null and text <> ''")
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).cast("int")
    return rows.select(shard.alias("shard"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[tuple[int, list[bytes], int]]]]:
    """A language, and for each shard the words of some documents, stops among them, and how many were seen before.

    A block has about ``size`` bytes. Of a text that goes on from one block to the next, the last words are seen again, so
    that phrases across are counted.
    """
    waiting: dict[str, dict[int, list[bytes]]] = {}
    held: dict[str, int] = {}

    def words(parts: list[bytes]) -> list[bytes]:
        return b"\n".join(parts).translate(_PIECES).replace(_STOP, b" . ").split()

    def block(lang: str) -> tuple[str, list[tuple[int, list[bytes], int]]]:
        held.pop(lang)
        return lang, [(shard, words(texts), 0) for shard, texts in waiting.pop(lang).items()]

    for batch in batches:
        for shard, lang, value in zip(batch["shard"].to_pylist(), batch["lang"].to_pylist(), batch["text"]):
            text = value.as_buffer().to_pybytes()
            if len(text) > size:
                yield from ((lang, [(shard, *part)]) for part in _long(text, size, words))
                continue
            waiting.setdefault(lang, {}).setdefault(shard, []).append(text)
            held[lang] = held.get(lang, 0) + len(text)
            if held[lang] >= size:
                yield block(lang)
            elif sum(held.values()) >= 4 * size:
                yield block(max(held, key=held.get))
    for lang in list(waiting):
        yield block(lang)


def _long(text: bytes, size: int, words) -> Iterator[tuple[list[bytes], int]]:
    """A text of more than one block, cut at blanks."""
    seen: list[bytes] = []
    start = 0
    while start < len(text):
        end = start + size
        while end < len(text) and text[end] not in b" \t\n":
            end += 1
        found = words([text[start:end]])
        yield seen + found, len(seen)
        seen = (seen + found)[-(LONGEST - 1) :]
        start = end


def _numbered(words: list[bytes], lang: str) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """A number for each word, the words by number, and their hashes; number 0 is the stop."""
    numbers: dict[bytes, int] = {_STOP: 0}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))
    distinct = list(numbers)
    seed = xxhash.xxh64_intdigest(lang.encode())
    return ids, distinct, np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in distinct), np.uint64, len(distinct))


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys ^= keys >> np.uint64(31)
    keys *= np.uint64(0x7FB5D329728EA185)
    keys ^= keys >> np.uint64(27)
    return keys


def _phrases(ids: np.ndarray, hashes: np.ndarray, seen: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length the keys of all phrases that end beyond the words seen before, and their starts."""
    of_word = hashes[ids]
    whole = ids != 0
    for n in range(1, LONGEST + 1):
        if len(ids) < n:
            return
        ok = whole[: len(ids) - n + 1].copy()
        ok[: max(0, seen - n + 1)] = False
        for j in range(1, n):
            ok &= whole[j : len(ids) - n + 1 + j]
        starts = np.flatnonzero(ok)
        keys = np.full(len(starts), n, np.uint64)
        for j in range(n):
            keys = (keys ^ of_word[starts + j]) * _MIX[j]
            keys ^= keys >> np.uint64(29)
        yield n, _mixed(keys), starts


# --- Bytes of equal rank together, so that the codec of the shuffle sees those that are zero -----------------------


def _pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unpack(data: bytes, n: int, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).ravel()


# --- Passes -------------------------------------------------------------------------------------------------------


def _words_by_shard(rows: DataFrame) -> dict[tuple[int, str], int]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, parts in _blocks(batches, BLOCK):
            n = [len(words) - words.count(_STOP) - (seen - words[:seen].count(_STOP)) for _, words, seen in parts]
            shards = pa.array([shard for shard, *_ in parts], pa.int32())
            yield pa.RecordBatch.from_arrays([shards, pa.array([lang] * len(n)), pa.array(n, pa.int64())], names=["shard", "lang", "n"])

    found = rows.mapInArrow(count, "shard int, lang string, n long").groupBy("shard", "lang").agg(F.sum("n").alias("n"))
    return {(r["shard"], r["lang"]): r["n"] for r in found.collect()}


def _dealt(bits: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The keys of a block in order, as differences, with shards and counts: a row for each of ``2 ** ROW_BITS`` ranges.

        So a block is as many rows however large the corpus is, until a bucket is less than a range.
        """
        row_bits = max(bits, ROW_BITS)
        for lang, parts in _blocks(batches, BLOCK):
            found = []
            for shard, words, seen in parts:
                ids, _, hashes = _numbered(words, lang)
                keys = np.concatenate([k for _, k, _ in _phrases(ids, hashes, seen)] or [np.zeros(0, np.uint64)])
                keys, counts = np.unique(keys, return_counts=True)
                found.append((keys, np.full(len(keys), shard, np.uint8), counts.astype(np.uint32)))
            del parts
            keys, shards, counts = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(keys, kind="stable")
            keys, shards, counts = keys[order], shards[order], counts[order]
            ranges = (keys >> np.uint64(64 - row_bits)).astype(np.int64)
            borders = np.flatnonzero(np.diff(ranges, prepend=-1))
            rows = []
            for a, b in zip(borders, [*borders[1:], len(keys)]):
                steps = np.diff(keys[a:b], prepend=np.uint64(0))
                rows.append((int(ranges[a]) >> (row_bits - bits), lang, int(b - a), _pack(steps), shards[a:b].tobytes(), _pack(counts[a:b])))
            for at in range(0, len(rows), 512):
                part = list(zip(*rows[at : at + 512]))
                kinds = [pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, kinds, strict=True)], names=["bucket", "lang", "n", "keys", "shards", "counts"])

    return deal


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _frequent(support: int, least: dict[tuple[int, str], int], bits: int):
    def mine(table: pa.Table) -> pa.Table:
        """The part of the filter that a bucket's keys fall into."""
        by_lang: dict[str, list] = {}
        for lang, n, keys, shards, counts in zip(*(table[c].to_pylist() for c in ("lang", "n", "keys", "shards", "counts"))):
            entry = np.cumsum(_unpack(keys, n, np.uint64), dtype=np.uint64), np.frombuffer(shards, np.uint8), _unpack(counts, n, np.uint32).astype(np.int64)
            by_lang.setdefault(lang, []).append(entry)
        kept = []
        for lang in list(by_lang):
            keys, shards, counts = (np.concatenate(c) for c in zip(*by_lang.pop(lang)))
            locally = []
            for shard in np.unique(shards):
                own = shards == shard
                key, count = _summed(keys[own], counts[own])
                locally.append(key[count >= least[int(shard), lang]])
            united = np.unique(np.concatenate(locally))
            key, count = _summed(keys, counts)
            kept.append(key[(count >= support) & np.isin(key, united, assume_unique=True)])
        kept = np.concatenate(kept)
        bucket = table["bucket"][0].as_py()
        places = (kept >> np.uint64(64 - FILTER_BITS)).astype(np.int64) - (bucket << (FILTER_BITS - bits))
        flags = np.zeros(1 << (FILTER_BITS - bits), np.uint8)
        flags[places] = 1
        return pa.table([pa.array([bucket], pa.int32()), pa.array([zlib.compress(np.packbits(flags).tobytes(), 1)], pa.binary())], names=["bucket", "bits"])

    return mine


def _counted(known, bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phrases the filter has, with their number in each block: a row for each of ``2 ** ROW_BITS`` ranges of keys."""
        flags = np.frombuffer(known.value, np.uint8)
        row_bits = max(bits, ROW_BITS)
        for lang, [(_, words, seen)] in _blocks(batches, LAST_BLOCK):
            ids, distinct, hashes = _numbered(words, lang)
            del words
            distinct = pa.array(distinct, pa.binary())
            found = []
            for n, keys, starts in _phrases(ids, hashes, seen):
                place = (keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                kept = (flags[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
                # By the numbers of their words, which are exact: two words of four make one 64-bit number.
                at = ids[starts[kept][:, None] + np.arange(n)].astype(np.int64)
                pair = [(at[:, j] << 32) | (at[:, j + 1] if j + 1 < n else 0) for j in range(0, n, 2)]
                order = np.lexsort(pair[::-1])
                if not len(order):
                    continue
                new = np.any([p[order][1:] != p[order][:-1] for p in pair], axis=0)
                first = np.flatnonzero(np.concatenate(([True], new)))
                counts = np.diff(np.append(first, len(order))).astype(np.uint32)
                at = at[order[first]]
                texts = pc.binary_join_element_wise(*[distinct.take(pa.array(at[:, j])) for j in range(n)], b" ")
                found.append(((keys[kept][order[first]] >> np.uint64(64 - row_bits)).astype(np.int64), texts, counts))
            if not found:
                continue
            ranges, counts = (np.concatenate([f[i] for f in found]) for i in (0, 2))
            texts = pa.concat_arrays([f[1] for f in found])
            del found
            order = np.argsort(ranges, kind="stable")
            ranges, counts, texts = ranges[order], counts[order], texts.take(pa.array(order))
            borders = np.flatnonzero(np.diff(ranges, prepend=-1))
            ends = np.append(borders[1:], len(ranges))
            lists = pa.ListArray.from_arrays(pa.array(np.append(borders, len(ranges)), pa.int32()), texts)
            columns = [
                pa.array(ranges[borders] >> (row_bits - bits), pa.int32()),
                pa.repeat(lang, len(borders)),
                pc.binary_join(lists, b"\n"),  # no word has a line feed
                pa.array([_pack(counts[a:b]) for a, b in zip(borders, ends)], pa.binary()),
            ]
            batch = pa.RecordBatch.from_arrays(columns, names=["bucket", "lang", "phrases", "counts"])
            yield from (batch.slice(a, 512) for a in range(0, len(batch), 512))

    return count


def _totals(support: int):
    def total(table: pa.Table) -> pa.Table:
        """The phrases of a bucket that reach the support, by their words."""
        table = table.combine_chunks()
        lists = pc.split_pattern(table["phrases"].combine_chunks().cast(pa.string()), "\n")
        sizes = pc.list_value_length(lists).to_pylist()
        counts = np.concatenate([_unpack(c, n, np.uint32) for c, n in zip(table["counts"].to_pylist(), sizes)])
        lang = table["lang"].combine_chunks().take(pc.list_parent_indices(lists))
        every = pa.table([lang, pc.list_flatten(lists), pa.array(counts.astype(np.int64))], names=["lang", "phrase", "a"])
        summed = every.group_by(["lang", "phrase"]).aggregate([("a", "sum")])
        summed = summed.filter(pc.greater_equal(summed["a_sum"], support))
        words = pc.add(pc.count_substring(summed["phrase"], " "), 1).cast(pa.int32())
        return pa.table([summed["lang"], summed["phrase"], words, summed["a_sum"]], names=["lang", "phrase", "words", "a"])

    return total


def frequent_phrases(docs: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, a`` of each phrase of 1 to ``LONGEST`` words that occurs ``support`` times, written; and
    ``lang, n``, the words of each language."""
    spark = docs.sparkSession
    rows = _documents(docs)
    sizes = _words_by_shard(rows)
    of_lang = pd.Series(sizes, dtype="int64").groupby(level=1).sum().to_dict() if sizes else {}
    totals = spark.createDataFrame([(lang, int(n)) for lang, n in of_lang.items()], "lang string, n long")
    least = {(shard, lang): max(1, -(-support * n // of_lang[lang])) for (shard, lang), n in sizes.items() if n}
    bits = min(MOST_BUCKET_BITS, max(1, (LONGEST * sum(sizes.values()) // BUCKET_KEYS).bit_length()))
    parts = rows.mapInArrow(_dealt(bits), _DEALT).groupBy("bucket").applyInArrow(_frequent(support, least, bits), "bucket int, bits binary")
    known = np.zeros((1 << bits, (1 << (FILTER_BITS - bits)) // 8), np.uint8)
    for row in parts.collect():
        known[row["bucket"]] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    known = spark.sparkContext.broadcast(known.tobytes())
    counted = rows.withColumn("shard", F.lit(0)).mapInArrow(_counted(known, bits), _COUNTED)
    summed = counted.groupBy("bucket").applyInArrow(_totals(support), "lang string, phrase string, words int, a long")
    found = stored(summed, "phrases")
    known.unpersist()
    return found, totals


# --- Scores -------------------------------------------------------------------------------------------------------


def _span(start: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.col("w"), start, length), " ")


def collocations(docs: DataFrame, top: int = 2000, support: int = SUPPORT, absorbed: int = 80) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of two words and more of each language.

    A phrase of frequency ``a`` cut after its first k words, into parts of frequencies ``l`` and ``r``, has
    ``floor(2000000 * a / (l + r))``; its lowest-scoring cut counts. Phrases inside a longer one that has at least
    ``absorbed`` percent of their frequency are dropped.
    """
    found, totals = frequent_phrases(docs, support)
    split = found.where("words > 1").withColumn("w", F.split("phrase", " ", -1))
    cut = split.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), "w")
    cut = cut.select("lang", "phrase", "words", "a", "k", _span(F.lit(1), F.col("k")).alias("first"), _span(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    for part, name in (("first", "l"), ("rest", "r")):
        of = found.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of"), F.col("a").alias(name))
        cut = cut.join(of, (F.col("lang") == F.col("of_lang")) & (F.col(part) == F.col("of"))).drop("of_lang", "of")
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cut.groupBy("lang", "phrase", "words", "a").agg(lowest)

    inner = split.where("words > 2").select("lang", "words", "a", "w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m"))
    inner = inner.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("i"))
    inner = inner.select(F.col("lang").alias("in_lang"), _span(F.col("i"), F.col("m")).alias("inner"), "a")
    longer = inner.groupBy("in_lang", "inner").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inner")), "left")
    percent = F.expr(f"cast(100 as decimal(3,0)) * cast(longer as decimal(20,0)) >= cast({absorbed} as decimal(3,0)) * cast(a as decimal(20,0))")
    kept = kept.where(F.col("longer").isNull() | ~percent)

    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    out = best.join(totals.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"))
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
