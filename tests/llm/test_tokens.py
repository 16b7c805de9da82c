"""Token counts, token files and packing against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import cases
from threadline.llm import bpe, huffman, packing, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def encoded(path, text, end=()):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, *end]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_chunks_give_the_librarys_ids(path):
    whole = Tokenizer.from_file(path)
    rng = random.Random(1)
    letters = ["a", "B", "é", "ß", "ő", "日", "1", "²", "'", "s", ".", ",", "-", " ", "  ", "\n", "\t", "́", "Σ", "<|endoftext|>", "×", "_", "\r\n", "İ", "`", "{"]
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 14)))
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(bpe.token_bytes(path, text), "<u4").tolist() == ids, repr(text)
        assert token_counts.token_count(path, text) == len(ids), repr(text)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_token_counts(spark, path):
    rows = cases.odd_rows()
    got = Counter(token_counts.count_tokens(cases.frame(spark), path).collect())
    want = Counter((i, len((t or "").encode()), len(encoded(path, t)), len(encoded(path, t)) > 512) for i, t, *_ in rows)
    assert got == want
    assert token_counts.count_tokens(cases.frame(spark, []), path).count() == 0


def test_whole_tokens_are_single():
    whole = token_counts.whole_tokens(BYTES)
    model = Tokenizer.from_file(BYTES).model
    assert all(len(model.tokenize(p)) == 1 for p in random.Random(2).sample(sorted(whole), 500))
    assert 0 < len(whole) <= 50257


def test_code_lengths_are_limited_and_complete():
    rng = np.random.default_rng(3)
    for n, bits in ((1, 4), (2, 4), (40, 6), (5000, 14), (300, 20)):
        counts = (1e9 / (1 + np.arange(n)) ** rng.uniform(0.5, 4)).astype(np.int64) + 1
        lengths = huffman.code_lengths(counts, bits).astype(int)
        assert lengths.max() <= bits
        if n > 1:
            assert sum(2.0**-lengths) == 1
        ids = rng.integers(0, n, 3000)
        codes = huffman.canonical_codes(lengths)
        size, checkpoints, payload = huffman.encode_ids(ids, codes, lengths)
        assert size == lengths[ids].sum()
        assert (huffman.Decoder(lengths).decode(len(ids), checkpoints, payload) == ids).all()


def test_code_lengths_reach_the_entropy_bound():
    counts = np.array([2**k for k in range(10, 0, -1)])
    assert huffman.code_lengths(counts, 20).tolist() == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9]


def test_token_files(spark, tmp_path):
    rows = cases.odd_rows()
    folder = str(tmp_path / "ids")
    huffman.write_token_files(cases.frame(spark), BYTES, folder)
    got = sorted(huffman.read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, *_ in rows), key=lambda i: (i is not None, i))
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == Counter((i, np.array(encoded(BYTES, t, [0]), "<u4").tobytes()) for i, t, *_ in rows)
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]) // 4)
        at += r["n_tokens"]
    assert huffman.token_files_digest(cases.frame(spark, []), BYTES).count() == 0


@pytest.mark.parametrize("window", [16, 2048])
def test_packing(spark, window):
    rows = cases.odd_rows()
    pieces = packing.packed_ids(cases.frame(spark), WORDS, window).collect()
    plain = packing.pack(cases.frame(spark), WORDS, window).collect()
    assert Counter(tuple(r) for r in plain) == Counter(tuple(r)[:-1] for r in pieces)
    documents = defaultdict(list)
    sequences = defaultdict(list)
    for r in pieces:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        documents[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    want = defaultdict(Counter)
    for i, t, *_ in rows:
        want[i].update(encoded(WORDS, t, [1]))
    assert {i: Counter(np.concatenate([np.frombuffer(r["ids"], "<u4") for r in p]).tolist()) for i, p in documents.items()} == want
    single = [i for i, n in Counter(i for i, *_ in rows).items() if n == 1]
    for i in single:
        at = 0
        for r in sorted(documents[i], key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
        assert at == documents[i][0]["doc_tokens"]
    assert sorted(sequences) == list(range(len(sequences)))
    filled = []
    for p in sequences.values():
        at = 0
        for r in sorted(p, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        filled.append(at)
    assert max(filled) <= window and sum(f < window for f in filled) <= 1
    assert packing.pack(cases.frame(spark, []), WORDS).count() == 0


def test_least_squares_uses_the_histogram_up():
    counts = np.bincount(np.random.default_rng(4).integers(1, 2048, 100_000), minlength=2049)
    combos = packing.combinations(counts, 2048)
    assert (combos.sum(axis=1) == 2048).all()
    repeats = packing.repeat_counts(counts, combos)
    used = np.bincount(combos.ravel(), np.repeat(repeats, 3), 2049)
    assert (used[1:] <= counts[1:]).all()
    assert repeats.sum() * 2048 > 0.9 * (counts * np.arange(2049)).sum()


def test_white_space_that_leaves_a_text_undivided():
    from threadline.llm import bpe

    assert [s for s in map(chr, range(0x110000)) if s.isspace() and s not in " \t\n\r"] == list(bpe.UNUSUAL_SPACE)
    assert bpe.UNUSUAL_SPACE[:6].isascii() and not any(s.isascii() for s in bpe.UNUSUAL_SPACE[6:])
    assert bpe.has_unusual_space("a\x1fb") and bpe.has_unusual_space("é b") and not bpe.has_unusual_space("a \t\n\rb é")


def test_bit_strings_of_any_length_decode():
    import numpy as np

    from threadline.llm import huffman

    rng = np.random.default_rng(1)
    lengths = huffman.code_lengths(rng.integers(0, 1000, 3000) ** 3)
    for n in (0, 1, 2, 33, 5000):
        ids = rng.choice(np.flatnonzero(lengths), n)
        _, checkpoints, payload = huffman.encode_ids(ids, huffman.canonical_codes(lengths), lengths)
        assert huffman.Decoder(lengths).decode(n, checkpoints, payload).tolist() == ids.tolist()
