"""Phrases, whitening and mixing against plain Python and numpy."""

import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import cases
from threadline.llm import collocations, mixing, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_collocations(rows, least, top, longest=4):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    known = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    for (lang, *words), a in known.items():
        size = len(words)
        score, k = min((2000000 * a // (f[(lang, *words[:k])] + f[(lang, *words[k:])]), k) for k in range(1, size))
        longer = [b for key, b in known.items() if key[0] == lang and len(key) - 1 > size and any(list(key[1 + i : 1 + i + size]) == words for i in range(len(key) - size))]
        if not any(100 * b >= 80 * a for b in longer):
            out.append((lang, " ".join(words), a, f[(lang, *words[:k])], f[(lang, *words[k:])], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranks = Counter()
    return [(r[0], ranks[r[0]], *r[1:]) for r in out if not ranks.update([r[0]]) and ranks[r[0]] <= top]


@pytest.mark.parametrize(("least", "top"), [(2, 2000), (5, 7), (30, 2000)])
def test_collocations(spark, least, top):
    rows = [(*r[:2], ("en", "de", None)[i % 3], *r[3:]) for i, r in enumerate(cases.odd_rows() * 2)]
    rows.append((99, "a.b, c d\x0be f\x1c g  h\ti; I J  k " * 8, "de", "s", 1, "x", "y"))
    got = collocations.collocations(cases.frame(spark, rows), least, top=top).collect()
    assert [tuple(r) for r in sorted(got)] == plain_collocations([(r[1], r[2]) for r in rows], least, top)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(cases.frame(spark, [])).count() == 0
    assert collocations.collocations(cases.frame(spark, [(1, None, None, None, 1, "", ""), (2, "", "en", "s", 1, "", "")])).count() == 0


def test_chunks_do_not_change_counts(monkeypatch):
    rows = [(r[1] or "", "en" if i % 2 else "de") for i, r in enumerate(cases.odd_rows())]
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows]), pa.array([r[0] for r in rows])], ["lang", "text"])

    def counted():
        found = Counter()
        for chunk, _ in collocations._chunks([batch], 3):
            for k, places in enumerate(chunk.places):
                found.update((chunk.lang, *chunk.words[p : p + k + 1]) for p in places.tolist())
        return found

    whole = counted()
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 100)
    monkeypatch.setattr(collocations, "KNOWN_WORDS", 3)
    assert counted() == whole and len(whole) > 1000


@pytest.mark.parametrize("seed", range(4))
def test_summary_keeps_frequent_keys(seed):
    rng = np.random.default_rng(seed)
    stream = rng.permutation(np.concatenate([np.repeat(np.arange(40), 30 + seed), rng.integers(100, 1 << 31, 20000)])).astype(np.uint32)
    counts = Counter(stream.tolist())
    summary = collocations.Summary(len(stream) // 30 + 1)
    for part in np.array_split(stream, 37):  # each a summary of its own that never lost anything
        keys, times = np.unique(part, return_counts=True)
        summary.add(keys, times)
    summary.merge()
    assert 0 < summary.lost < 30 and len(summary.keys) <= summary.capacity
    assert all(c <= counts[k] <= c + summary.lost for k, c in zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))
    assert {k for k, c in counts.items() if c >= 30} <= set(summary.reaching(30).tolist())


def test_filter_has_no_false_negatives():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    for parts in (256, 1 << 20):
        found = collocations.Filter(parts)
        assert not found.passing(keys).any()
        part, rest = collocations.split_key(keys, found.shift)
        for p in np.unique(part).tolist():
            found.put(p, found.slice_of(rest[part == p]))
        assert found.passing(keys).all()
        assert found.passing(keys + np.uint64(1 << 38)).mean() < 0.6
    assert collocations.parts_of(0) == 256 and collocations.parts_of(10**12) == 1 << 14


def vectors(rng, n=300, d=6):
    base = rng.standard_normal((n, d)) @ rng.standard_normal((d, d))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(base)]
    rows += [(1000 + i, base[0].tolist(), 1) for i in range(200)]  # copies count once in the fit
    rows += [(2000, None, 1), (2001, [1.0] * (d - 1) + [None], 1), (2002, [float("nan")] * d, 1), (2003, [float("inf")] + [0.0] * (d - 1), 1)]
    return rows + [(2004, [], 1), (2005, [1.0], 1), (2006, [1e300] * d, 1), (None, base[1].tolist(), 1), (3, base[3].tolist(), 2)]


VECTORS = "vec_id long, embedding array<double>, component int"


def test_whitening(spark):
    rows = vectors(np.random.default_rng(5))
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    left = [(i, np.floor(256 * np.array(v)).astype(int).tolist()) for i, v, _ in rows if v and len(v) == 6 and all(x is not None and abs(x) < 1e9 for x in v)]
    fit = np.array(sorted({tuple(x) for _, x in left}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1], components[:, ::-1]
    assert len(got) == 4 * len(left) and {r["n"] for r in got} == {n} and got[0]["identity_error"] < 1e-10
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    first = [by[5, k + 1][0]["whitened"] for k in range(4)]
    turn = components[:, :4] / np.sqrt(values[:4])
    sign = np.sign(first) * np.sign((np.array(left[5][1]) - sums / n) @ turn)
    for i, x in left:
        expected = (np.array(x) - sums / n) @ turn * sign
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        for k in range(4):
            r = by[i, k + 1][0]
            assert r["deviation"] == deviation and abs(r["whitened"] - expected[k]) < 1e-9
            assert abs(r["explained"] - values[k] / values.sum()) < 1e-12
    assert len(by[3, 1]) == 2 and len(by[None, 1]) == 1


def test_whitening_of_little(spark):
    frame = lambda rows: spark.createDataFrame(rows, VECTORS)
    for rows in ([], [(1, [1.0, 2.0], 0)] * 3, [(1, [], 0), (2, [], 0)]):
        assert whitening.whiten(frame(rows)).count() == 0
    one = whitening.whiten(frame([(i, [float(i), 0.0], 0) for i in range(5)])).collect()
    assert {r["component"] for r in one} == {1} and all(r["explained"] == 1 for r in one)
    large = whitening.whiten(frame([(i, [float(i) * 2**40, 1.0], 0) for i in range(3)])).collect()
    assert {r["vec_id"]: r["deviation"] for r in large} == {0: None, 1: 0, 2: None}


@pytest.mark.parametrize("kind", ["random", "equal", "close", "graded", "zero", "rank"])
def test_eigen(kind):
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((24, 24)))
    values = {"random": rng.random(24), "equal": np.ones(24), "close": 1 + np.arange(24) * 1e-14, "graded": 10.0 ** -np.arange(24), "zero": np.zeros(24), "rank": (np.arange(24) < 3) * 2.0}[kind]
    a = q @ np.diag(values) @ q.T
    found, vectors = whitening.eigen(a)
    assert np.allclose(found, np.linalg.eigvalsh((a + a.T) / 2)[::-1], atol=1e-14 * max(values.max(), 1))
    assert np.allclose(vectors.T @ vectors, np.eye(24), atol=1e-14) and np.allclose(a @ vectors, vectors * found, atol=1e-13)


def plain_targets(sizes, weights, share, most):
    target = {s: Fraction(0) for s in sizes}
    open_, left = set(sizes), share * sum(sizes.values())
    while True:
        level = left / max(sum(weights[s] for s in open_), 1)
        over = {s for s in open_ if weights[s] * level > most * sizes[s]}
        if not over:
            return {s: weights[s] * level if s in open_ else Fraction(most * sizes[s]) for s in target}
        open_ -= over
        left -= sum(most * sizes[s] for s in over)


def plain_mix(spark, rows, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    frame = cases.frame(spark, rows)
    places = frame.select("source", mixing.words("text").alias("size"), mixing.place("doc_id", "text").alias("place")).collect()
    sizes = Counter()
    for r in places:
        sizes[r["source"]] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s))
    target = plain_targets(sizes, {s: weights[i % len(weights)] for i, s in enumerate(order)}, share, most)
    out = []
    for s in order:
        whole = target[s] // sizes[s] if sizes[s] else 0
        budget, upto = target[s] - whole * sizes[s], 0
        for place, size in sorted((r["place"], r["size"]) for r in places if r["source"] == s):
            copies = whole + (2 * upto + size < 2 * budget)
            upto += size
            out.append((s, size, sizes[s], float(target[s]), copies, copies * size))
    return Counter(out)


def spread(rows):
    return [(i, t, lang, (None, "b", "a", "ü", "b")[k % 5], *rest) for k, (i, t, lang, _, *rest) in enumerate(rows)]


@pytest.mark.parametrize("share", [Fraction(3, 2), Fraction(1, 3)])
def test_mix(spark, share):
    rows = spread(cases.odd_rows() * 3)
    rows += [(7, "same words here", "en", "hot", 1, "", "")] * 50 + [(8, "", "en", "empty", 1, "", "")]
    got = mixing.mix(cases.frame(spark, rows), share=share).collect()
    assert Counter(tuple(r)[1:] for r in got) == plain_mix(spark, rows, share=share)
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    again = mixing.mix(cases.frame(spark, rows[::-1]), share=share).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mixed_rows_and_nested_budgets(spark):
    docs = cases.documents(spark)
    less, more = (mixing.mix(docs, share=s) for s in (Fraction(1, 2), Fraction(3, 5)))
    pairs = less.alias("l").join(more.alias("m"), "doc_id").where("l.copies > m.copies")
    assert pairs.count() == 0
    out = mixing.mixed(docs)
    taken = mixing.mix(docs)
    assert out.columns == docs.columns
    assert Counter(r[0] for r in out.select("doc_id").collect()) == Counter({r["doc_id"]: r["copies"] for r in taken.collect() if r["copies"]})
    for r in taken.groupBy("source", "target").agg({"taken": "sum", "size": "max"}).collect():
        assert abs(r["target"] - r["sum(taken)"]) <= r["max(size)"] / 2


def test_mix_by_table_and_of_nothing(spark):
    assert mixing.mix(cases.frame(spark, [])).count() == 0 and mixing.mixed(cases.frame(spark, [])).count() == 0
    rows = [(i, "a b c", "en", s, 1, "", "") for i, s in enumerate(["x", "x", "y", "y", None])]
    weights = spark.createDataFrame([("x", 1), (None, 1)], "source string, weight long")
    got = mixing.mix(cases.frame(spark, rows), weights, share=Fraction(2, 5))
    assert {(r["source"], r["target"]) for r in got.collect()} == {("x", 3.0), ("y", 0.0), (None, 3.0)}
