"""The operators over the test tables: one query each, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterkeep.llm import ann, collocations, decontam, hard_negatives, hmm, langid, license_scan, line_dedup, minmax_dedup, packing, quality, repeats, winnowing
from rosterkeep.llm.common import pick, remainder, table


def _sha(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ",").cast("binary"), 256)


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _sha(F.col("items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = langid.learn(pick(docs, "doc_id", "text", "lang").where(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "fill")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = quality.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "difference")


def collision_counting_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def min_max_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=4)


def hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 1
    corpus = hmm.count_corpus(table(spark, sf_dir, "documents"), ~held_out)
    scored = hmm.score(corpus, hmm.train(corpus))
    train_tokens = F.lit(corpus.train_tokens).cast("long").alias("train_tokens")
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", train_tokens, "base_score", "score")


def line_deletion_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_report(table(spark, sf_dir, "documents"))
    return found.withColumn("removed", F.array_join("removed", ","))


def license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["license"])))
    return found.select(
        "doc_id",
        F.size(names).cast("long").alias("n_licenses"),
        F.array_join(names, ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["contained"])), F.lit(0.0)).alias("contained"),
    )


def suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), bytes_too=False)


def winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_edits(table(spark, sf_dir, "documents"))


def son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def hard_negatives_by_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(
        table(spark, sf_dir, "embeddings"),
        lambda vec_id: vec_id % 100 == 0,
        label=lambda vec_id, label: F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_collision_counting_search": collision_counting_search,
    "op2_benchmark_decontamination": benchmark_decontamination,
    "op3_language_id": language_id,
    "op4_min_max_dedup": min_max_dedup,
    "op5_best_fit_packing": best_fit_packing,
    "op6_hidden_markov_scores": hidden_markov_scores,
    "op7_line_deletion_dedup": line_deletion_dedup,
    "op8_license_windows": license_windows,
    "op9_suffix_repeats": suffix_repeats,
    "op10_quality_classifier": quality_classifier,
    "op11_winnowing_fingerprints": winnowing_fingerprints,
    "op12_son_collocations": son_collocations,
    "op13_hard_negatives": hard_negatives_by_rtree,
}

#: Words of a text: A-Z lower-cased, digits, letters and everything beyond ASCII.
_WORDS = "list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

ORACLE: dict[str, str] = {
    "op12_son_collocations": """
        WITH piece AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
            FROM documents WHERE text IS NOT NULL
        ),
        word AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') AS w FROM piece),
        total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM word GROUP BY lang),
        place AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM word, unnest([1, 2, 3, 4]) AS t(k)),
        phrase AS (
            SELECT lang, k AS words, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS phrase, count(*) AS a
            FROM place GROUP BY lang, k, phrase HAVING count(*) >= 30
        ),
        split AS (SELECT lang, phrase, words, a, string_split(phrase, ' ') AS w FROM phrase WHERE words > 1),
        cut_at AS (SELECT *, unnest(range(1, words)) AS k FROM split),
        cut AS (
            SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, CAST((2000000::HUGEINT * c.a) // (l.a + r.a) AS BIGINT) AS score
            FROM cut_at c
            JOIN phrase l ON l.lang = c.lang AND l.phrase = list_aggregate(c.w[1:c.k], 'string_agg', ' ')
            JOIN phrase r ON r.lang = c.lang AND r.phrase = list_aggregate(c.w[c.k + 1:], 'string_agg', ' ')
        ),
        lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        part AS (SELECT *, unnest(range(2, words)) AS m FROM split),
        inside AS (SELECT lang, a, m, w, unnest(range(1, words - m + 2)) AS i FROM part),
        longer AS (SELECT lang, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') AS phrase, max(a) AS most FROM inside GROUP BY 1, 2),
        kept AS (SELECT x.* FROM lowest x LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
        SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, score FROM kept JOIN total USING (lang)
        WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= 2000""",
    "op13_hard_negatives": """
        WITH row_of AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        anchor AS (SELECT * FROM row_of WHERE vec_id % 100 = 0),
        pair AS (
            SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
            FROM anchor a JOIN row_of r ON a.vec_id <> r.vec_id
        ),
        positive AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pair WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.other_id AS negative_id, positive_score, n.score AS negative_score
        FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other_id)
        QUALIFY row_number() OVER w <= 10""",
    "op2_benchmark_decontamination": f"""
        WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
        win AS (
            SELECT DISTINCT item, len(words[i:i + 9]) AS n, list_aggregate(words[i:i + 9], 'string_agg', ' ') AS key
            FROM item, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(i) WHERE len(words) > 0
        ),
        doc AS (SELECT doc_id, coalesce({_WORDS}, []) AS words FROM documents),
        sizes AS (SELECT DISTINCT n FROM win),
        place AS (
            SELECT doc_id, i, n, list_aggregate(words[i:i + n - 1], 'string_agg', ' ') AS key
            FROM doc, sizes, unnest(range(1, len(words) - n + 2)) AS t(i)
        ),
        hit AS (SELECT doc_id, i, place.n, item FROM place JOIN win USING (key)),
        covered AS (
            SELECT doc_id, count(DISTINCT w) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hit) GROUP BY doc_id
        ),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_line_deletion_dedup": f"""
        WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
        cut AS (
            SELECT doc_id, i - 1 AS line_no,
                   list_filter(regexp_split_to_array(lower(lines[i]), '[ \\t\\x0B\\f\\r]+'), lambda w: w <> '') AS words
            FROM raw, unnest(range(1, len(lines) + 1)) AS t(i)
        ),
        line AS (
            SELECT doc_id, line_no, row_number() OVER (ORDER BY doc_id, line_no) AS place,
                   CASE WHEN len(words) = 1 AND regexp_matches(words[1], '{line_dedup.UNSPACED}') THEN regexp_extract_all(words[1], '.') ELSE words END AS words
            FROM cut WHERE len(words) > 0
        ),
        class AS (SELECT words, min(place) AS first FROM line GROUP BY words),
        long AS (SELECT words, first FROM class WHERE len(words) >= 5),
        variant AS (SELECT first, i, list_concat(words[1:i - 1], words[i + 1:]) AS rest FROM long, unnest(range(1, len(words) + 1)) AS t(i)),
        changed AS (SELECT i, rest, min(first) AS least FROM variant GROUP BY i, rest HAVING count(*) > 1),
        pair AS (
            SELECT first, least FROM variant JOIN changed USING (i, rest) WHERE least < first
            UNION ALL
            SELECT greatest(v.first, c.first), least(v.first, c.first) FROM variant v JOIN long c ON v.rest = c.words
        ),
        near AS (SELECT DISTINCT first FROM pair),
        dropped AS (
            SELECT doc_id, line_no, place = c.first AS is_near FROM line JOIN class c USING (words)
            WHERE place > c.first OR c.first IN (SELECT first FROM near)
        ),
        of_doc AS (
            SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE is_near) AS n_near, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS removed
            FROM dropped GROUP BY doc_id
        )
        SELECT doc_id, coalesce(len(lines), 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_near, 0) AS n_near, coalesce(removed, '') AS removed
        FROM raw LEFT JOIN of_doc USING (doc_id)""",
    "op4_min_max_dedup": """
        WITH RECURSIVE doc AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
            FROM documents WHERE text IS NOT NULL
        ),
        shingle AS (SELECT DISTINCT doc_id, words[i:i + 3] AS s FROM doc, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS t(i) WHERE len(words) > 0),
        size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
        link AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
        ),
        reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reach JOIN link ON other = a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d LEFT JOIN size USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)""",
    "op9_suffix_repeats": """
        WITH doc AS (SELECT doc_id, coalesce(hex(encode(text)), '') AS h FROM documents),
        str AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM doc, unnest(range(0, length(h) // 2 - 99)) AS t(i)),
        start AS (SELECT doc_id, i FROM str QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
        run AS (SELECT *, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS new FROM start),
        numbered AS (SELECT *, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM run),
        span AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run),
        gap AS (
            SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, s.a AS b FROM span s WINDOW w AS (PARTITION BY doc_id ORDER BY s.a)
            UNION ALL SELECT doc_id, max(b), length(any_value(h)) // 2 FROM span JOIN doc USING (doc_id) GROUP BY doc_id
            UNION ALL SELECT doc_id, 0, length(h) // 2 FROM doc WHERE doc_id NOT IN (SELECT doc_id FROM span)
        ),
        kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM gap JOIN doc USING (doc_id) GROUP BY doc_id),
        of_doc AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
        SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
        FROM doc JOIN kept USING (doc_id) LEFT JOIN of_doc USING (doc_id)""",
}
