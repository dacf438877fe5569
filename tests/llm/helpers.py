"""Frames with what operators have to bear, and plain versions of what several compute."""

import re
from pathlib import Path

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 40_000
BLANK = re.compile(rb"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    """``doc_id`` and ``text`` beside columns whose names results also have, or that differ in case only."""
    kind = "doc_id long, text string, n_words string, score string, component_id string, kept string, hits string, Text string, batch string"
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x", "x", "x") for i, t in rows], kind)


def small_documents():
    table = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pydict()
    return list(zip(table["doc_id"], table["text"], table["lang"]))


def needs_tables():
    return not Path(SMALL).exists()


def lowered(text):
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode())


def blank_words(text):
    return BLANK.findall(lowered(text or ""))


def shingle_set(text, size):
    words = blank_words(text)
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def components(ids, links):
    """Smallest id reachable, for each id."""
    to = {i: i for i in ids}

    def root(i):
        while to[i] != i:
            i = to[i]
        return i

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        to[high] = low
    return {i: root(i) for i in ids}


def near_components(texts, size, percent=80):
    """Components of documents by full comparison of all pairs."""
    sets = {i: shingle_set(t, size) for i, t in texts}
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    links.append((a, b))
    return components(ids, links)


UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def lines_to_drop(texts, least=5):
    """(doc_id, line_no) of lines with an earlier equal line, or an earlier one within one edit of words where both have
    ``least`` words, by full comparison."""
    lines = []
    for i, t in sorted((i, t) for i, t in texts if t is not None):
        for n, line in enumerate(t.split("\n")):
            words = tuple(w for w in re.split(r"[ \t\x0b\f\r]+", line.lower()) if w)
            if len(words) == 1 and UNSPACED.search(words[0]):
                words = tuple(words[0])
            if words:
                lines.append((i, n, words))

    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < least:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        if abs(len(a) - len(b)) != 1:
            return False
        a, b = sorted((a, b), key=len)
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[k:] == b[k + 1 :]

    return {(i, n) for k, (i, n, w) in enumerate(lines) if any(near(w, v) for _, _, v in lines[:k])}
