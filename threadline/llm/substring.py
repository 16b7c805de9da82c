"""Repeated passages by relative Lempel-Ziv parsing against blocks of the whole collection.

Every text is parsed into factors: the windows that share one anchor, the smallest of the 8-word hashes a
window holds. Equal windows have equal anchors, so the occurrences of an anchor are the one reference
block a factor has to be held against, and the index is the collection dealt by anchor. A factor that
equals another in whole is a duplicate span at once, however often it occurs. Where only part of a factor
can match, near the places where texts begin to differ, its windows are checked one by one against those
of the factors in its block. Factors are at most 28 windows and the check covers each window, so spans
that reach over factor boundaries are found whole.

Words are hashed to 128 bits; factors and windows are compared by hashes only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.llm.frames import each_text, stored, texts

#: Words of an anchor.
ANCHOR = 8
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two hashes of each word; none is kept, as a look into a large cache costs more than the hash."""
    import xxhash

    raw = b"".join(map(xxhash.xxh3_128_digest, words))
    return np.frombuffer(raw, "<u8").reshape(-1, 2).T.astype(np.uint64)


def rolled(lane: np.ndarray, base: np.uint64, size: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``size`` words, put together from runs of doubled lengths."""
    out, power, done, run, step = None, np.uint64(1), 0, lane, 1
    n = len(lane) - size + 1
    scale = base
    left = size
    while left:
        if left & 1:
            term = run[done : done + n] * power
            out = term if out is None else out + term
            power *= scale
            done += step
        left >>= 1
        if left:
            run = run[:-step] + run[step:] * scale
            step *= 2
            scale *= scale
    return out


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def factors(lanes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, content hash, first window and number of windows of each factor of a text of ``window`` words or more."""
    n = lanes.shape[1]
    with np.errstate(over="ignore"):
        value = _mixed(rolled(lanes[0], _BASES[0], ANCHOR))
        # leftmost smallest value among the anchors of each window
        size = window - ANCHOR + 1
        best, at, width = value, np.arange(len(value)), 1
        while width < size:
            step = min(width, size - width)
            later = best[step:] < best[:-step]
            at = np.where(later, at[step:], at[:-step])
            best = np.where(later, best[step:], best[:-step])
            width += step
        begins = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        counts = np.diff(np.concatenate([begins, [n - window + 1]]))
        # content: words from the first window's first to the last window's last
        powers = _powers(_BASES[1], n + 1)
        inverses = _powers(np.uint64(pow(int(_BASES[1]), -1, 1 << 64)), n + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lanes[1] * powers[:n])])
        content = (sums[begins + counts + window - 1] - sums[begins]) * inverses[begins]
        content = _mixed(content + counts.astype(np.uint64))
    return value[at[begins]].view(np.int64), content.view(np.int64), begins, counts


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with a key of their own: rows alike in id and text have the same result and may share it."""
    return texts(docs, key, text).select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("id"), F.hash("text").alias("th"))


def repeated_spans(docs: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, th, start, n``: runs of windows whose word sequence also starts elsewhere; ``id, th`` as in ``_keyed``."""
    if window < ANCHOR:
        raise ValueError(f"a window has at least {ANCHOR} words")

    def parse(batches):
        for batch, values in each_text(batches):
            out = []
            for i, value in enumerate(values):
                words = value.encode().split()
                if len(words) >= window:
                    anchor, content, start, n = factors(word_hashes(words), window)
                    out.append((np.full(len(start), i), anchor, content, start.astype(np.int32), n.astype(np.int32)))
            if out:
                row, anchor, content, start, n = (np.concatenate(c) for c in zip(*out, strict=True))
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(content), batch.column("id").take(row), batch.column("th").take(row), pa.array(start), pa.array(n)],
                    ["anchor", "content", "id", "th", "start", "n"],
                )

    keyed = _keyed(docs, key, text)
    parsed = stored(keyed.select("id", "th", "text").mapInArrow(parse, "anchor long, content long, id long, th int, start int, n int"), "factors")
    contents = parsed.groupBy("anchor", "content").agg(F.count("*").alias("copies"))
    blocks = contents.groupBy("anchor").agg(F.count("*").alias("variants"), F.sum("copies").alias("total")).where("total > 1").select("anchor", "variants")
    known = stored(contents.join(blocks, "anchor"), "shared-factors")
    shared = stored(parsed.join(known, ["anchor", "content"]), "shared-rows")
    whole = shared.where("copies > 1").select("id", "th", "start", "n")
    partly = shared.where("copies = 1").select("id", "th", "start", "n", F.lit(True).alias("asks"))
    # one occurrence stands for all that are alike
    models = shared.where("copies > 1 AND variants > 1").groupBy("anchor", "content").agg(F.min(F.struct("id", "th", "start", "n")).alias("one")).select("one.*", F.lit(False).alias("asks"))
    wanted = partly.unionByName(models).groupBy("id", "th").agg(F.collect_list(F.struct("start", "n", "asks")).alias("spans"))

    def windows(batches):
        for batch, values in each_text(batches):
            out = []
            for i, (value, spans) in enumerate(zip(values, (s.as_py() for s in batch.column("spans")), strict=True)):
                lanes = word_hashes(value.encode().split())
                with np.errstate(over="ignore"):
                    first, second = (_mixed(rolled(lane, base, window)).view(np.int64) for lane, base in zip(lanes, _BASES, strict=True))
                at = np.concatenate([np.arange(s["start"], s["start"] + s["n"]) for s in spans])
                asks = np.repeat([s["asks"] for s in spans], [s["n"] for s in spans])
                out.append((np.full(len(at), i), first[at], second[at], at.astype(np.int32), asks))
            if out:
                row, first, second, at, asks = (np.concatenate(c) for c in zip(*out, strict=True))
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first), pa.array(second), batch.column("id").take(row), batch.column("th").take(row), pa.array(at), pa.array(asks)],
                    ["first", "second", "id", "th", "start", "asks"],
                )

    # rows alike in id and text would give each window twice: one of them is enough
    some = keyed.select("id", "th", "text").join(wanted.hint("shuffle_hash"), ["id", "th"])
    seen = stored(some.mapInArrow(windows, "first long, second long, id long, th int, start int, asks boolean").distinct(), "windows")
    twice = seen.groupBy("first", "second").agg(F.count("*").alias("copies")).where("copies > 1").select("first", "second")
    single = seen.where("asks").join(twice, ["first", "second"], "left_semi").select("id", "th", "start", F.lit(1).alias("n"))
    return whole.unionByName(single)


def remove_repeats(docs: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept``: every row without the words of its repeated windows.

    Null and empty texts have no words. Texts shorter than a window lose nothing. Rows that repeat lose all
    words that a window covers. Null ids are rows like others.
    """
    spans = repeated_spans(docs, window, key, text).groupBy("id", "th").agg(F.collect_list(F.struct("start", "n")).alias("spans"))

    def remove(batches):
        for batch, values in each_text(batches):
            rows = []
            for value, spans_ in zip(values, (s.as_py() for s in batch.column("spans")), strict=True):
                words = value.encode().split()
                n = len(words)
                kept = words
                if spans_:
                    starts = np.array([s["start"] for s in spans_])
                    ends = starts + np.array([s["n"] for s in spans_]) + window - 1
                    depth = np.zeros(n + 1, np.int64)
                    np.add.at(depth, starts, 1)
                    np.add.at(depth, ends, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                joined = b" ".join(kept)
                rows.append((n, n - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode()))
            n, removed, digest, kept = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest), pa.array(kept)], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    joined = _keyed(docs, key, text).join(spans.hint("shuffle_hash"), ["id", "th"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
