"""Benchmark passages in documents, paraphrases included, by latent semantic retrieval.

The benchmark is a stated set of queries, taken in blocks of ``BLOCK`` passages. For a block, document
frequencies of its terms are counted over all documents; a randomised SVD of the passages' TF-IDF rows,
multiplied out in Spark tasks, gives the latent space. Every document is folded in window by window, and
windows whose cosine with a passage and whose share of it are high enough become candidates. A candidate is
a leak if the longest common subsequence covers most of the passage, or a good part of it together with
nearly all of its answer, the passage's last quarter.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.llm.frames import each_text, stored, texts

#: Passages of a block, words of a passage and of half a window, latent dimensions and spare ones.
BLOCK, PASSAGE, HALF, RANK, SPARE = 2048, 48, 32, 128, 16
#: Terms in more than this share of documents, and in more than that many, tell nothing; least cosine and
#: share of a candidate.
COMMON, FEW, COSINE, SHARE = 0.05, 100, 0.3, 0.4
#: Parts of a passage in common order: enough alone; enough with that part of the answer; least words.
WHOLE, PARTLY, ANSWER, LEAST = 0.75, 0.6, 0.8, 6

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def lcs(one: list[str], other: list[str]) -> int:
    """Length of the longest common subsequence, a bit per word of ``one``."""
    places: dict[str, int] = {}
    for i, w in enumerate(one):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(one)) - 1
    row = full
    for w in other:
        hit = row & places.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(one) - row.bit_count()


def passages(text: str) -> list[list[str]]:
    """A benchmark text in parts of at most ``PASSAGE`` words, of about equal size."""
    words = words_of(text)
    parts = max(1, -(-len(words) // PASSAGE))
    cuts = [round(i * len(words) / parts) for i in range(parts + 1)]
    return [words[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if b - a >= LEAST]


class _Numbers(dict):
    """Numbers of terms; -1 for any other word."""

    def __missing__(self, word: str) -> int:
        return -1


def _terms(words: list[str], index: dict[str, int]) -> np.ndarray:
    return np.array([index[w] for w in words if w in index], np.int64)


def latent_space(spark, rows: list[list[str]], index: dict[str, int], idf: np.ndarray, rounds: int = 2) -> np.ndarray:
    """Right singular vectors (terms x rank) of the passages' TF-IDF rows.

    A pass multiplies the matrix and its transpose with a thin one; each of at most eight tasks returns one
    sum of terms x rank, which is bounded by the size of a block.
    """
    n_terms, width = len(idf), min(RANK + SPARE, len(rows), len(idf))
    table = spark.createDataFrame([(r,) for r in rows], "words array<string>").repartition(min(8, len(rows)))

    def multiplied(thin: np.ndarray) -> np.ndarray:
        def run(batches):
            out = np.zeros_like(thin)
            for batch in batches:
                for words in batch.column("words").to_pylist():
                    at, times = np.unique(_terms(words, index), return_counts=True)
                    weights = times * idf[at]
                    norm = np.linalg.norm(weights)
                    if norm:
                        weights = weights / norm
                        out[at] += np.outer(weights, weights @ thin[at])
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()])], ["part"])

        return sum((np.frombuffer(r["part"]).reshape(thin.shape) for r in table.mapInArrow(run, "part binary").collect()), np.zeros_like(thin))

    basis = np.random.default_rng(17).standard_normal((n_terms, width))
    for _ in range(rounds):
        basis = np.linalg.qr(multiplied(basis))[0]
    small = basis.T @ multiplied(basis)
    _, vectors = np.linalg.eigh((small + small.T) / 2)
    return basis @ vectors[:, ::-1][:, :RANK]


def _frequencies(docs: DataFrame, vocabulary: set[str]) -> tuple[dict[str, int], int]:
    """In how many documents each term of a block occurs, and how many documents there are."""

    def count(batches):
        names = sorted(vocabulary)
        at = {w: i for i, w in enumerate(names)}
        counts, rows = np.zeros(len(names) + 1, np.int64), 0
        for batch, values in each_text(batches):
            rows += batch.num_rows
            for value in values:
                found = vocabulary.intersection(words_of(value))
                counts[[at[w] for w in found]] += 1
        counts[-1] = rows
        yield pa.RecordBatch.from_arrays([pa.array([*names, ""]), pa.array(counts)], ["term", "n"])

    found = {r["term"]: r["n"] for r in docs.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return found, found.pop("", 0)


def _search(docs: DataFrame, block: list[tuple[int, list[str]]]) -> DataFrame:
    spark = docs.sparkSession
    seen, n_docs = _frequencies(docs, {w for _, ws in block for w in ws})
    telling = {w for w, n in seen.items() if n <= max(COMMON * n_docs, FEW)}
    for _, ws in block:
        if len(telling.intersection(ws)) < 3:  # a passage of common terms keeps them
            telling.update(ws)
    rare = sorted(telling)
    index = {w: i for i, w in enumerate(rare)}
    idf = np.array([np.log((n_docs + 1) / (seen.get(w, 0) + 1)) + 1 for w in rare])
    space = latent_space(spark, [ws for _, ws in block], index, idf)
    folded = (space * idf[:, None]).astype(np.float32)  # a term's occurrence as a latent vector
    queries = np.stack([folded[_terms(ws, index)].sum(axis=0) for _, ws in block])
    squares = np.maximum((queries**2).sum(axis=1), 1e-9)
    least = SHARE * float(np.sqrt(squares.min()))

    def search(batches):
        number = _Numbers(index)
        for batch, values in each_text(batches):
            found = []
            for key, value in zip(batch.column("doc_id"), values, strict=True):
                words = words_of(value)
                numbers = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                hits = np.flatnonzero(numbers >= 0)
                if not len(hits):
                    continue
                part, term = hits // HALF, numbers[hits]
                begins = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])
                sums = np.zeros((int(part[-1]) + 2, folded.shape[1]), np.float32)
                sums[part[begins]] = np.add.reduceat(folded[term], begins, axis=0)
                windows = sums[:-1] + sums[1:]
                norms = np.sqrt((windows**2).sum(axis=1))
                strong = np.flatnonzero(norms >= least)
                for at in range(0, len(strong), 4096):
                    some = strong[at : at + 4096]
                    dots = windows[some] @ queries.T
                    near = (dots >= COSINE * norms[some, None] * np.sqrt(squares)) & (dots >= SHARE * squares)
                    for w, q in zip(*np.nonzero(near), strict=True):
                        first = max(0, int(some[w]) * HALF - HALF)
                        item, passage = block[q]
                        region = words[first : int(some[w]) * HALF + 3 * HALF]
                        common = lcs(passage, region) / len(passage)
                        if common < PARTLY:
                            continue
                        answer = passage[-max(3, len(passage) // 4) :]
                        if common >= WHOLE or lcs(answer, region) / len(answer) >= ANSWER:
                            found.append((key.as_py(), item, first, common, float(dots[w, q] / (norms[some[w]] * np.sqrt(squares[q])))))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(),) * 3 + (pa.float64(),) * 2, strict=True)], ["doc_id", "item_id", "first_word", "common", "cosine"])

    return docs.mapInArrow(search, "doc_id long, item_id long, first_word long, common double, cosine double")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, first_word, common, cosine``: one row per document and benchmark text found in it.

    Words are letters and digits in lower case. Benchmark texts of fewer than six words, null and empty ones
    find nothing, nor do documents like that. Items or rows alike give one row; a null id is an id of its own.
    """
    spark = docs.sparkSession
    whole = texts(docs)

    def split(batches):
        for batch in batches:
            rows = [(i, p) for i, t in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for p in passages(t or "")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], ["item_id", "words"])

    parts = stored(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(split, "item_id long, words array<string>").distinct(), "passages")
    blocks = max(1, -(-parts.count() // BLOCK))
    found = spark.createDataFrame([], "doc_id long, item_id long, first_word long, common double, cosine double")
    numbered = parts.withColumn("b", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
    for b in range(blocks):  # one pass over the documents per block of benchmark passages
        block = [(r["item_id"], list(r["words"])) for r in numbered.where(F.col("b") == b).orderBy("item_id", "words").collect()]
        if block:
            found = found.unionByName(_search(whole, block))
    best = F.max(F.struct("common", "cosine", -F.col("first_word"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", (-F.col("best")["col3"]).alias("first_word"), "best.common", "best.cosine")


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak. Texts are told apart by their own hash, so null and repeated ids lose nothing else."""
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    leaked = find_leaks(docs.select(mark.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__leaked")).distinct()
    return docs.join(leaked, mark == F.col("__leaked"), "left_anti")
