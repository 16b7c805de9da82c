"""Registered queries: each operator over its whole table with production settings."""

from __future__ import annotations

import public_tokenizers

from threadline.llm import (
    collocations,
    decontaminate,
    huffman,
    line_quality,
    mixing,
    packing,
    pii,
    revisits,
    simhash,
    substring,
    token_counts,
    toxicity,
    whitening,
)
from threadline.llm.frames import table

QUERIES, ORACLES = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_line_quality(spark, sf_dir):
    return line_quality.report(table(spark, sf_dir, "documents"))


ORACLES["op2_line_quality"] = line_quality.ORACLE


@query
def op3_crf_pii(spark, sf_dir):
    return pii.find_pii(table(spark, sf_dir, "documents"))


@query
def op4_huffman_token_files(spark, sf_dir):
    return huffman.token_files_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op5_nnls_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_repeated_passages(spark, sf_dir):
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op7_latent_decontamination(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_revisit_resolution(spark, sf_dir):
    return revisits.resolved_pages(table(spark, sf_dir, "pages"))


ORACLES["op8_revisit_resolution"] = revisits.ORACLE


@query
def op9_simhash_near_dedup(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op10_nearest_toxic_examples(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_phrase_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_phrase_collocations"] = collocations.ORACLE


@query
def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op13_source_mixing"] = mixing.ORACLE
