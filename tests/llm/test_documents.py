"""Quality rules, repeated passages and near-duplicates against plain Python."""

import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import cases
from threadline.llm import decontaminate, line_quality, simhash, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


@pytest.mark.parametrize("bits", [24, 3])
def test_quality(spark, monkeypatch, bits):
    monkeypatch.setattr(line_quality, "_PLACE", bits)  # 3: longer texts take the way of unpacked words
    got = Counter(tuple(r)[:7] for r in line_quality.report(cases.frame(spark)).collect())
    assert got == Counter((i, *plain_quality(t)) for i, t, *_ in cases.odd_rows())
    assert line_quality.report(cases.frame(spark, [])).count() == 0


def test_quality_stage(spark):
    docs = cases.frame(spark)
    kept = line_quality.keep_good(docs)
    assert kept.columns == docs.columns
    report = {r["doc_id"]: r["kept"] for r in line_quality.report(docs).collect()}
    assert report[21] and not report[15] and not report[11] and not report[5]
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert 11 not in rows and "about | contact" not in rows[21]["text"] and rows[21]["n_chars"] == len(rows[21]["text"])


def plain_repeats(rows, window):
    words = [WORD.findall(t or "") for _, t, *_ in rows]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, *_), w in zip(rows, words, strict=True):
        gone = {k + j for k in range(len(w) - window + 1) if starts[tuple(w[k : k + window])] > 1 for j in range(window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [8, 12, 35])
def test_repeats(spark, window):
    rows = cases.odd_rows()
    got = Counter(tuple(r)[:4] for r in substring.remove_repeats(cases.frame(spark), window).collect())
    assert got == plain_repeats(rows, window)
    assert substring.remove_repeats(cases.frame(spark, []), window).count() == 0


def test_repeats_of_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in cases.documents(spark).collect()]
    got = Counter(tuple(r)[:4] for r in substring.remove_repeats(cases.documents(spark)).collect())
    assert got == plain_repeats(rows, 35)


def test_word_hashes_keep_nothing():
    substring.word_hashes([b"first"])
    tracemalloc.start()
    for i in range(10):
        words = [b"w%d" % n for n in range(10_000 * i, 10_000 * (i + 1))]
        assert np.array_equal(substring.word_hashes(words)[:, 0], np.frombuffer(xxhash.xxh3_128_digest(words[0]), "<u8"))
    del words
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 1_000_000


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    marks = [(i, plain_fingerprint(t)) for i, t, *_ in rows]
    distinct = sorted({m for _, m in marks})
    root = {m: m for m in distinct}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    array = np.array(distinct, np.uint64)
    for k, m in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(array[k + 1 :] ^ array[k]) <= 3):
            root[find(distinct[k + 1 + j])] = find(m)
    least = defaultdict(list)
    for i, m in marks:
        if i is not None:
            least[find(m)].append(i)
    return Counter((i, f"{m:016x}", min(least[find(m)], default=None)) for i, m in marks)


def test_simhash(spark):
    rows = cases.odd_rows()
    assert Counter(tuple(r) for r in simhash.simhash_components(cases.frame(spark)).collect()) == plain_components(rows)
    assert simhash.simhash_components(cases.frame(spark, [])).count() == 0


def test_simhash_of_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in cases.documents(spark).collect()]
    assert Counter(tuple(r) for r in simhash.simhash_components(cases.documents(spark)).collect()) == plain_components(rows)


@pytest.mark.parametrize("large", [4, 2048])
def test_links_connect_the_same(large, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE_GROUP", large)
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 62, 3, np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 31, rng.integers(0, 4)).astype(np.uint64), initial=np.uint64(0)) for _ in range(300)], np.uint64)
    marks = np.unique(centre[rng.integers(0, 3, 300)] ^ flips)

    def parts(edges):
        root = {int(m): int(m) for m in marks}

        def find(m):
            while root[m] != m:
                m = root[m]
            return m

        for a, b in edges:
            root[find(int(a))] = find(int(b))
        return {m: min(x for x in root if find(x) == find(m)) for m in root}

    want = [(a, b) for k, a in enumerate(marks) for b in marks[k + 1 :] if np.bitwise_count(a ^ b) <= 3]
    got = [e for block in simhash._group_edges(marks, 0, 3) for e in block]
    assert parts(got) == parts(want)


def test_components_of_a_chain(spark):
    edges = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in simhash.components(edges).collect()} == {0}
    assert simhash.components(edges.limit(0)).count() == 0


def test_keep_first(spark):
    docs = cases.frame(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    marks = {}  # ids by fingerprint; two texts of one id are two documents
    for i, text, *_ in cases.odd_rows():
        marks.setdefault(simhash.fingerprint(text or ""), []).append(i)
    least, left = Counter(), set(marks)
    while left:
        part, todo = [], [left.pop()]
        while todo:
            one = todo.pop()
            part += marks[one]
            near = {m for m in left if (m ^ one).bit_count() <= 3}
            left -= near
            todo += near
        least[min(part, key=lambda i: (i is None, i))] += 1
    assert Counter(r["doc_id"] for r in kept.collect()) == least


def test_keep_first_tells_rows_apart(spark):
    rows = [(None, f"{w} " * 8 + "one two three", "en", "s", 1, "", "") for w in ("red", "green")]
    rows += [(7, "blue sky over the sea " * 4, "en", "s", 1, "", "")] * 3 + [(7, "another text with the same id " * 3, "en", "s", 1, "", "")]
    rows += [(8, "blue sky over the sea " * 4, "en", "s", 1, "", ""), (None, "blue sky over the sea " * 4, "en", "s", 1, "", "")]
    kept = [tuple(r) for r in simhash.keep_first(cases.frame(spark, rows)).collect()]
    assert sorted(kept, key=str) == sorted([rows[0], rows[1], rows[2], rows[5]], key=str)
    assert simhash.keep_first(cases.frame(spark, [])).count() == 0


def test_leaks_take_no_other_rows_along(spark):
    passage = "the quick brown fox jumps over the lazy dog while seven wise owls watch from a tall old tree"
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = [(None, f"some words {passage} more words"), (None, "a clean text without any of it " * 3), (4, passage), (4, "clean text of the same id " * 3), (5, None)]
    docs = cases.frame(spark, [(i, t, "en", "s", 1, "", "") for i, t in rows])
    left = {(r["doc_id"], r["text"]) for r in decontaminate.remove_leaks(docs, benchmark).collect()}
    assert left == {rows[1], rows[3], rows[4]}
