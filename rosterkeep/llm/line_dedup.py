"""Line deduplication by a deletion-neighbourhood join, with built-in functions only.

A line's words are its runs between blanks, lower-cased. A line that is not blank is dropped if an earlier line (of a smaller
doc_id, or further up in the same document) has the same words. A line with at least ``MIN_WORDS`` words is dropped too if an
earlier one has words within one edit: one word changed, inserted or removed; in shorter lines one edit would make nearly
anything of them. A line of one word in a script written without blanks (Chinese, Japanese, Thai, Lao, Burmese, Khmer) has
its characters for words, so it is deduplicated like others.

1. Equal lines are one class with its first place; all later work is on classes, so a line of a third of all rows is one.
2. Two lines within one edit share their first or their last half, aligned for their lengths. Classes that share no half
   with another class need no variants, and others only those for the lengths they share one with. Only hashes are
   shuffled for that.
3. Each remaining class emits itself or the variants without its i-th word, for every i, as hashed keys. Changing word i
   makes the variants without word i equal; removing word i makes the variant equal to the other line. So each key needs
   its earliest class only, not pairs: a template line with a million fillings is one group reduced by ``min``.
4. Each class joins the earliest partner of its keys; the edit distance of the pair is then verified on the words. Joins
   with what was reduced to one row a key are such that adaptive execution can split a hot key, as that of a template line.

Keys are pairs of 64-bit hashes. The hash of a variant is the exclusive or of the hashes of its words with their places, so
all variants of a line come from running totals.

Null texts have no lines; empty lines and blank ones are never dropped; line ends are line feeds. Documents without an id
have no place in the order and are left as they are. Rows that share an id count as one document; equal lines at the same
place of such rows are the same line. Other columns are ignored or kept, whatever their names are. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterkeep.llm.common import join_reduced, pick, stored, with_columns_by_place

MIN_WORDS = 5
_BLANKS = " \t\x0b\x0c\r"
#: Characters of scripts written without blanks between words.
UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"
_PLACE = ("doc_id", "line_no", "h1")
#: Lines that may share a half with a line: as long, one word shorter, one word longer.
_AS_LONG, _SHORTER, _LONGER = 1, 2, 4


def words_of(line: Column) -> Column:
    # Few lines hold other blanks than spaces, and a split at one character needs no pattern.
    spaced = F.when(F.rlike(line, F.lit(f"[{_BLANKS[1:]}]")), F.translate(line, _BLANKS[1:], " " * len(_BLANKS[1:]))).otherwise(line)
    return F.array_remove(F.split(F.lower(spaced), " "), "")


def parts_of(line: Column) -> Column:
    """The words of a line; of a single word in a script without blanks its characters."""

    def parts(words: Column) -> Column:
        only = F.try_element_at(words, F.lit(1))
        return F.when((F.size(words) == 1) & F.rlike(only, F.lit(UNSPACED)), F.split(only, "")).otherwise(words)

    # Through an array, so that the words are made once.
    return F.transform(F.array(words_of(line)), parts)[0]


def _hashes(words: Column) -> tuple[Column, Column]:
    return F.xxhash64(words), F.xxhash64(F.lit(1), words)


def _half_keys(words: Column) -> Column:
    """Keys of the halves: aligned for partners up to this length, and for partners one word longer."""
    n = F.size(words)
    even, odd = F.floor(n / 2).cast("int"), F.floor((n + 1) / 2).cast("int")
    return F.array(
        F.xxhash64(F.lit(0), n, F.slice(words, F.lit(1), even)),
        F.xxhash64(F.lit(1), n, F.slice(words, even + 1, n - even)),
        F.xxhash64(F.lit(0), n + 1, F.slice(words, F.lit(1), odd)),
        F.xxhash64(F.lit(1), n + 1, F.slice(words, odd, n + 1 - odd)),
    )


def _numbered_lines(docs: DataFrame, *more: str) -> DataFrame:
    """Lines that can be dropped, with their words.

    The words are made before the lines become rows; made after that, the filter would make them once more.
    """
    of_lines = F.transform(F.split("text", "\n", -1), parts_of)
    return docs.select("doc_id", *more, F.posexplode(of_lines).alias("line_no", "words")).where(F.size("words") > 0)


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words differ by at most one word changed, inserted or removed."""
    longer, shorter = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)), F.size(longer).cast("long")).cast("int")
    without = F.concat(F.slice(longer, F.lit(1), first - 1), F.slice(longer, first + 1, F.size(longer)))
    changed = F.size(F.filter(same, lambda x: ~x)) <= 1
    return F.when(F.size(a) == F.size(b), changed).when(F.abs(F.size(a) - F.size(b)) == 1, without == shorter).otherwise(False)


def _variants(lines: DataFrame) -> DataFrame:
    """Key (``v1``, ``v2``, ``tag``) rows of each line: its variants by place, all its variants, and itself, as ``kinds`` asks.

    ``tag`` is the place of the word left out, or 0 for the keys that match a line with one word less; there ``whole``
    tells the line itself from its variants.
    """
    line = Window.partitionBy(*_PLACE)
    so_far = line.orderBy("j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    words = lines.repartition(*[F.col(c) for c in _PLACE]).select(*_PLACE, "kinds", F.posexplode("words").alias("j", "word"))
    # Hashes of a word at its place (a) and moved up by one (c), by two functions.
    hashed = words.select(
        *_PLACE,
        "kinds",
        "j",
        *[F.xxhash64(F.lit(k), "word", F.col("j") - back).alias(f"{name}{k}") for k in (1, 2) for name, back in (("a", 0), ("c", 1))],
    )
    totals = hashed.select(
        "*",
        *[F.bit_xor(f"{name}{k}").over(so_far).alias(f"{name}{k}_to") for k in (1, 2) for name in "ac"],
        *[F.bit_xor(f"{name}{k}").over(line).alias(f"{name}{k}_all") for k in (1, 2) for name in "ac"],
    )

    def without(k: int) -> Column:
        before = F.col(f"a{k}_to").bitwiseXOR(F.col(f"a{k}"))
        return before.bitwiseXOR(F.col(f"c{k}_all")).bitwiseXOR(F.col(f"c{k}_to"))

    def key(v1: Column, v2: Column, tag: Column, whole: bool) -> Column:
        return F.struct(v1.alias("v1"), v2.alias("v2"), tag.alias("tag"), F.lit(whole).alias("whole"))

    def asked(kind: int, more: Column, row: Column) -> Column:
        none = F.array().cast("array<struct<v1: bigint, v2: bigint, tag: int, whole: boolean>>")
        return F.when((F.col("kinds").bitwiseAND(F.lit(kind)) != 0) & more, F.array(row)).otherwise(none)

    keys = F.concat(
        asked(_AS_LONG, F.lit(True), key(without(1), without(2), F.col("j") + 1, False)),
        asked(_SHORTER, F.lit(True), key(without(1), without(2), F.lit(0), False)),
        asked(_LONGER, F.col("j") == 0, key(F.col("a1_all"), F.col("a2_all"), F.lit(0), True)),
    )
    return totals.select(F.struct(*_PLACE).alias("place"), F.inline(keys))


def dropped_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``line_no``, ``h1`` (the hash of its words) and ``near`` of each line to drop.

    ``near`` tells lines that are the first of their kind but within one edit of an earlier line.
    """
    docs = pick(docs, "doc_id", "text").where("doc_id is not null and text is not null")
    h1, h2 = _hashes(F.col("words"))
    keys = F.when(F.size("words") >= min_words, _half_keys(F.col("words"))).otherwise(F.array().cast("array<bigint>"))
    lines = _numbered_lines(docs).select("doc_id", "line_no", h1.alias("h1"), h2.alias("h2"), keys.alias("keys"))
    lines = stored(lines, "lines")
    first = F.min(F.struct("doc_id", "line_no", "keys"))
    classes = stored(lines.groupBy("h1", "h2").agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "line-classes")

    # The first two keys of a line are for its own length, the others for lines one word longer.
    halves = classes.select("first.doc_id", "first.line_no", "h1", F.posexplode("first.keys").alias("i", "key"))
    own = F.col("i") < 2
    shared = halves.groupBy("key").agg(F.count_if(own).alias("n_own"), F.count_if(~own).alias("n_shorter"))
    shared = shared.where("n_own > 1 or (n_own > 0 and n_shorter > 0)")
    kinds = F.when(own & (F.col("n_own") > 1), _AS_LONG).otherwise(0) + F.when(own & (F.col("n_shorter") > 0), _SHORTER).otherwise(0)
    kinds = kinds + F.when(~own & (F.col("n_own") > 0), _LONGER).otherwise(0)
    marked = join_reduced(halves, shared, ["key"]).select(*_PLACE, kinds.alias("kinds")).where("kinds > 0")
    marked = marked.groupBy(*_PLACE).agg(F.bit_or("kinds").alias("kinds"))
    of_doc = marked.groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "h1", "kinds")).alias("wanted"))
    found = _numbered_lines(docs.join(of_doc, "doc_id"), "wanted").withColumn("h1", _hashes(F.col("words"))[0])
    own_mark = F.filter("wanted", lambda x: (x["line_no"] == F.col("line_no")) & (x["h1"] == F.col("h1")))
    found = found.select(*_PLACE, "words", F.try_element_at(own_mark["kinds"], F.lit(1)).alias("kinds")).where("kinds is not null")
    found = stored(found, "line-words").dropDuplicates(list(_PLACE))

    keys = stored(_variants(found), "line-variants")
    earliest = keys.groupBy("v1", "v2", "tag").agg(
        F.min(F.when(F.col("whole"), F.col("place"))).alias("line"),
        F.min(F.when(~F.col("whole"), F.col("place"))).alias("variant"),
        F.count(F.lit(1)).alias("n"),
    )
    partner = F.when((F.col("tag") > 0) | F.col("whole"), F.col("variant")).otherwise(F.col("line"))
    met = join_reduced(keys, earliest.where("n > 1").drop("n"), ["v1", "v2", "tag"]).select("place", partner.alias("partner"))
    pairs = met.where("partner < place").groupBy("place").agg(F.min("partner").alias("partner"))
    words = found.select(F.struct(*_PLACE).alias("place"), "words")
    both = pairs.join(words, "place").join(words.select(F.col("place").alias("partner"), F.col("words").alias("others")), "partner")
    near = both.where(within_one_edit(F.col("words"), F.col("others"))).select("place.*", F.lit(True).alias("near"))

    several = classes.where("n > 1").select("h1", "h2", F.struct("first.doc_id", "first.line_no").alias("first"))
    repeated = join_reduced(lines.select(*_PLACE, "h2"), several, ["h1", "h2"]).where(F.struct("doc_id", "line_no") != F.col("first"))
    return repeated.select(*_PLACE, F.lit(False).alias("near")).unionByName(near)


def _by_document(dropped: DataFrame) -> DataFrame:
    return dropped.groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "h1")).alias("dropped"), F.count_if("near").alias("n_near"))


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: ``doc_id``, ``n_lines``, ``n_removed``, ``n_near`` and the numbers of the lines to drop."""
    rows = pick(docs, "doc_id", "text").select("doc_id", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n_lines"))
    rows = rows.withColumn("n_lines", F.greatest("n_lines", F.lit(0)).cast("long"))
    of_doc = _by_document(dropped_lines(docs, min_words))
    numbers = F.array_sort(F.transform("dropped", lambda x: x["line_no"]))
    out = rows.join(of_doc.select("doc_id", "n_near", F.array_distinct(numbers).alias("removed")), "doc_id", "left")
    return out.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def drop_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, with all their columns, without the lines to drop; ``n_chars``, if there, follows.

    A document that loses lines and keeps none but blank ones goes; so an exact copy leaves nothing.
    """
    of_doc = _by_document(dropped_lines(docs, min_words)).select(F.col("doc_id").alias("_doc"), "dropped")
    out, at = with_columns_by_place(docs)
    out = out.join(of_doc, F.col(at["doc_id"]) == F.col("_doc"), "left")
    text = F.col(at["text"])
    kept = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("dropped", F.struct(i.alias("line_no"), _hashes(parts_of(x))[0].alias("h1"))))
    out = out.withColumn(at["text"], F.when(F.col("dropped").isNull(), text).otherwise(F.array_join(kept, "\n")))
    if "n_chars" in at:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(at["n_chars"], F.when(F.col("dropped").isNull(), F.col(at["n_chars"])).otherwise(F.length(at["text"]).cast(kind)))
    blank = F.length(F.btrim(F.col(at["text"]), F.lit(_BLANKS + "\n"))) == 0
    out = out.where(F.col("dropped").isNull() | ~blank)
    return out.select(*[at_name for at_name in at.values()]).toDF(*docs.columns)
