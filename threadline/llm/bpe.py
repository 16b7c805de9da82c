"""Token ids of whole texts from the tokenizers library, with its answers kept per chunk.

A text falls into chunks at places where the library splits in any case: before white space that
follows other text, and between a run of Latin letters and the ASCII sign or space after it. The
ids of a text are therefore the ids of its chunks, one after the other, and a chunk that occurred
before needs no second encoding. Texts with unusual white space go to the library undivided.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

_LETTERS, _SMALL = "A-Za-zÀ-ÖØ-öø-ÿ", "a-zß-öø-ÿ"
_RUN = rf"(?:[{_LETTERS}]+(?=[ \t\n\r!-@\[-`{{-~]|\Z)|[^ \t\n\r]+)"
WITH_SPACE = re.compile(rf"[ \t\n\r]*{_RUN}|[ \t\n\r]+")
WITHOUT_SPACE = re.compile(_RUN)
#: White space at which a text goes to the library undivided; the first six are all of it that ASCII has.
UNUSUAL_SPACE = "\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters whose small form may depend on their neighbours or on composition.
NOT_LATIN = re.compile("[İɐ-῿⁰-\U0010ffff]")

#: Answers of one generation kept by a Python worker, and the longest chunk kept.
CACHE_ROWS, CACHE_CHARS = 450_000, 80


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_padding()
    loaded.no_truncation()
    return loaded


class Answers(dict):
    """Chunk to answer; asks on first use. Two generations are kept, so that what is in use outlives a full one."""

    def __init__(self, ask):
        super().__init__()
        self.ask, self.older = ask, {}

    def __missing__(self, chunk: str):
        answer = self.older.get(chunk)
        if answer is None:
            answer = self.ask(chunk)
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE_ROWS:
                self.older = dict(self)
                self.clear()
            self[chunk] = answer
        return answer


@lru_cache(maxsize=1)
def _byte_signs() -> dict[int, str]:
    """The sign the byte-level alphabet has for each byte: printable Latin-1 itself, the others from 256 up."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    return {b: chr(b if b in own else 256 + b - sum(o < b for o in own)) for b in range(256)}


def _packed(path: str):
    encode, merge, signs, small = tokenizer(path).encode, tokenizer(path).model.tokenize, _byte_signs(), lowers(path)
    one = re.compile(rf"{'' if drops_space(path) else ' ?'}[{_SMALL if small else _LETTERS}]+")

    space, packs = signs[ord(" ")], [struct.Struct(f"<{n}I").pack for n in range(1 + CACHE_CHARS)]

    def ask(chunk: str) -> bytes:
        if one.fullmatch(chunk):  # a single pre-token: only the merges are left to do
            if not chunk.isascii():
                chunk = chunk.encode().decode("latin-1").translate(signs)
            elif chunk[0] == " ":
                chunk = space + chunk[1:]  # letters stand for themselves
            ids = [t.id for t in merge(chunk)]
        else:
            ids = encode(chunk, add_special_tokens=False).ids
        return packs[len(ids)](*ids) if len(ids) < len(packs) else struct.pack(f"<{len(ids)}I", *ids)

    return ask


@lru_cache(maxsize=4)
def _packed_answers(path: str) -> Answers:
    return Answers(_packed(path))


def forget() -> None:
    """Give up the answers this worker keeps; later stages reuse its process and need the memory."""
    _packed_answers.cache_clear()


@lru_cache(maxsize=4)
def drops_space(path: str) -> bool:
    """Whether white space leaves no ids of its own, so that chunks can do without it."""
    encode = tokenizer(path).encode
    return encode(" a \n", add_special_tokens=False).ids == encode("a", add_special_tokens=False).ids


@lru_cache(maxsize=4)
def lowers(path: str) -> bool:
    """Whether capitals and small letters have the same ids."""
    encode = tokenizer(path).encode
    return encode("ÀB", add_special_tokens=False).ids == encode("àb", add_special_tokens=False).ids


def chunks_of(path: str, text: str) -> list[str]:
    if lowers(path) and not NOT_LATIN.search(text):
        text = text.lower()
    return (WITHOUT_SPACE if drops_space(path) else WITH_SPACE).findall(text)


def has_unusual_space(text: str) -> bool:
    """Looked for sign by sign: each is one fast scan of the text, many times cheaper than a pattern's walk."""
    for sign in UNUSUAL_SPACE[:6] if text.isascii() else UNUSUAL_SPACE:
        if sign in text:
            return True
    return False


def token_bytes(path: str, text: str) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit integers."""
    answers = _packed_answers(path)
    if has_unusual_space(text):
        return answers.ask(text)
    return b"".join(map(answers.__getitem__, chunks_of(path, text)))
