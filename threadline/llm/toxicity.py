"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are words and their beginnings, a new term for every doubling of how often they occur in a text; the
``TERMS`` that tell toxic examples best (largest log-likelihood ratio) span the space. Examples lie in
blocks of similar ones, and a block's largest weight per term bounds the cosine any of its examples can
reach. Blocks are visited from the highest bound down until the bound falls below the k-th best cosine, so
the neighbours are exact. Votes weigh by squared cosine and are drawn towards the base rate, which makes
scores of texts without telling terms the base rate itself.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.llm.bpe import Answers
from threadline.llm.frames import each_text, stored, texts

#: Labelled rows learnt from at most (those with the smallest hash of their id), terms, neighbours,
#: examples of a block, weight of the base rate, score from which a text counts as toxic.
EXAMPLES, TERMS, NEIGHBOURS, BLOCK, PULL, LINE = 6000, 128, 15, 64, 0.1, 0.7
PREFIXES = (4, 6, 8)

_WORD = re.compile(r"[^\W\d_]+")


def _stems(word: str) -> list[str]:
    return [f"={word}", *(word[:k] for k in PREFIXES if len(word) >= k)]


def terms(text: str) -> set[str]:
    counts: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for stem in _stems(word):
            counts[stem] += n
    return {f"{stem}*{j}" for stem, n in counts.items() for j in range(n.bit_length())}


def held_out(key) -> F.Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Neighbours:
    """Block-max index over example vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, rate: float):
        full = np.flatnonzero(vectors.any(axis=1))
        # alike examples side by side, so that a block's bounds are tight
        order = full[np.lexsort((ids[full], *(vectors[full] > 0).T[::-1]))] if len(full) else full
        self.ids, self.labels, self.vectors, self.rate = ids[order], labels[order], vectors[order], rate
        begins = np.arange(0, len(order), BLOCK)
        self.bounds = np.maximum.reduceat(self.vectors, begins, axis=0) if len(order) else np.zeros((0, vectors.shape[1]))

    def nearest(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k nearest with a term in common; ties go to the smaller id."""
        bounds = self.bounds @ query
        rows, cosines = np.empty(0, np.int64), np.empty(0)
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or len(rows) == k and bounds[block] < cosines[-1] - 1e-12:
                break
            at = np.arange(block * BLOCK, min((block + 1) * BLOCK, len(self.ids)))
            rows, cosines = np.concatenate([rows, at]), np.concatenate([cosines, np.round(self.vectors[at] @ query, 12)])
            best = np.lexsort((self.ids[rows], -cosines))[:k]
            rows, cosines = rows[best], cosines[best]
        shared = cosines > 0
        return rows[shared], cosines[shared]

    def score(self, query: np.ndarray, k: int) -> tuple[float, list[int]]:
        if not query.any():
            return self.rate, []
        rows, cosines = self.nearest(query, k)
        weights = cosines**2
        return float((weights @ self.labels[rows] + PULL * self.rate) / (weights.sum() + PULL)), self.ids[rows[:3]].tolist()


def _vector(found: set[str] | dict, index: dict[str, int], idf: np.ndarray) -> np.ndarray:
    vector = np.zeros(len(idf))
    at = [index[t] for t in found if t in index]
    vector[at] = idf[at]
    norm = np.linalg.norm(vector)
    return vector / norm if norm else vector


def score_toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, n_terms: int = TERMS, k: int = NEIGHBOURS) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` of every row; evidence is the ids of the nearest examples.

    Only labelled rows outside the held-out third are learnt from; contradicting labels of one id count as
    toxic, null labels and null ids not at all. Null, empty and wordless texts get the base rate, which is 0
    without any labels. Repeated rows get equal scores.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    )
    # at most ``examples`` rows of two numbers
    chosen = stored(known, "examples")
    taught = texts(docs).join(F.broadcast(chosen), "doc_id")

    def teach(batches):
        for batch, values in each_text(batches):
            found = [sorted(terms(v)) for v in values]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.string()))], ["doc_id", "toxic", "terms"])

    lessons = stored(taught.mapInArrow(teach, "doc_id long, toxic int, terms array<string>"), "lessons")
    totals = lessons.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("n1")).first()
    n, n1 = totals["n"], totals["n1"]
    n0 = n - n1
    a, b = F.col("a").cast("double"), F.col("b").cast("double")

    def part(k_, size, p):
        return F.when(k_ > 0, k_ * F.log(k_ / (size * p))).otherwise(0.0)

    share = (a + b) / F.lit(float(n or 1))
    ratio = part(a, n1, share) + part(n1 - a, n1, 1 - share) + part(b, n0, share) + part(n0 - b, n0, 1 - share)
    telling = (
        lessons.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
        .where((F.col("a") >= 3) & (F.col("a") * n0 > F.col("b") * n1))
        .orderBy(F.round(ratio, 9).desc(), "term").limit(n_terms)
    ).collect()
    index = {r["term"]: i for i, r in enumerate(telling)}
    idf = np.array([np.log((n + 1) / (r["a"] + r["b"] + 1)) + 1 for r in telling])
    # at most ``examples`` rows of ``n_terms`` terms
    rows = lessons.select("doc_id", "toxic", F.array_intersect("terms", F.array(*[F.lit(t) for t in index]) if index else F.array().cast("array<string>")).alias("terms")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["terms"]))
    vectors = np.array([_vector(r["terms"], index, idf) for r in rows]).reshape(len(rows), len(idf))
    learnt = Neighbours(np.array([r["doc_id"] for r in rows], np.int64), np.array([r["toxic"] for r in rows], float), vectors, n1 / n if n else 0.0)
    wanted = {t.rpartition("*")[0] for t in index}

    def score(batches):
        hits = Answers(lambda word: tuple(s for s in _stems(word) if s in wanted))
        for batch, values in each_text(batches):
            out = []
            for value in values:
                counts: Counter = Counter()
                for word, times in Counter(_WORD.findall(value.lower())).items():
                    for stem in hits[word]:
                        counts[stem] += times
                out.append(learnt.score(_vector({f"{s}*{j}" for s, m in counts.items() for j in range(m.bit_length())}, index, idf), k))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([o[0] for o in out], pa.float64()), pa.array([o[1] for o in out], pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    scored = texts(docs).mapInArrow(score, "doc_id long, score double, evidence array<long>")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LINE).cast("int").alias("predicted"), "evidence")
