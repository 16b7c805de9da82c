"""Token counts by whole-token shortcut.

A pre-token that is itself a vocabulary string known to encode alone as one token counts one without
any merging. Which strings those are is proved once per worker by merging every vocabulary string;
only the other pre-tokens are merged, and repeated chunks of text keep their count.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from threadline.llm import bpe
from threadline.llm.frames import each_text, texts

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


@lru_cache(maxsize=2)
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that, standing alone as a pre-token, come out as the one token they name."""
    loaded = bpe.tokenizer(path)
    merge = loaded.model.tokenize
    found = set()
    for piece, number in loaded.get_vocab(with_added_tokens=False).items():
        merged = merge(piece)
        if len(merged) == 1 and merged[0].id == number:
            found.add(piece)
    return frozenset(found)


@lru_cache(maxsize=2)
def _counter(path: str) -> bpe.Answers:
    loaded = bpe.tokenizer(path)
    added = [token.content for token in loaded.get_added_tokens_decoder().values()]
    shortcut, split, merge, normalizer = whole_tokens(path), loaded.pre_tokenizer.pre_tokenize_str, loaded.model.tokenize, loaded.normalizer

    def count(chunk: str) -> int:
        if any(token in chunk for token in added):
            return len(loaded.encode(chunk, add_special_tokens=False).ids)
        if normalizer is not None:
            chunk = normalizer.normalize_str(chunk)
        return sum(1 if piece in shortcut else len(merge(piece)) for piece, _ in split(chunk))

    return bpe.Answers(count)


def token_count(path: str, text: str) -> int:
    counts = _counter(path)
    if bpe.has_unusual_space(text):
        return counts.ask(text)
    return sum(map(counts.__getitem__, bpe.chunks_of(path, text)))


def count_tokens(docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: UTF-8 bytes, tokens without added special ones, and whether they exceed the limit.

    Null and empty texts have no tokens. Repeated rows and null ids stay rows of their own. Nothing is
    shuffled; a text is held once in one task, whatever its length.
    """

    def count(batches):
        for batch, values in each_text(batches):
            counts = pa.array([token_count(path, value) for value in values], pa.int64())
            size = pc.cast(pc.binary_length(batch.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, counts, pc.greater(counts, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts(docs, key, text).mapInArrow(count, SCHEMA)
