"""Exact encoding with public tokenizers.

A byte-pair vocabulary whose ids follow the order of its merges is a table of ranks, so the rank encoder of tiktoken gives
the ids of the tokenizers library, at any length of a word in nearly linear time. `byte_bpe_50k.json` keeps white space:
whole texts go to the encoder. `word_bpe_49k.json` drops it and marks the ends of words: pieces between blanks stand alone
there, so each distinct piece is encoded once for a chunk of texts and kept in a store of bounded bytes. Special tokens
part a text first, as in the library.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import cached_property, lru_cache
from typing import TYPE_CHECKING

import numpy as np
import regex

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Bytes of results that one Python worker keeps, characters of the texts that are encoded together.
STORE_BYTES, CHUNK = 96_000_000, 4_000_000
#: What an entry of a store takes besides its key and value.
ENTRY = 220

# The pre-token patterns of the two vocabularies and white space as they count it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+").findall
#: Mark the end of a word, and part two pieces; texts that hold them go to the library.
WORD_END, PARTING = "\x01", "\x02"


def path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Store(dict):
    """A memory of results. Whoever adds to it asks now and then whether it is full: then it starts anew."""

    def __init__(self, most: int = STORE_BYTES) -> None:
        super().__init__()
        self.most, self.held = most, 0

    def __reduce__(self) -> tuple:
        return Store, (self.most,)

    def full(self) -> bool:
        if self.held < self.most:
            return False
        self.clear()
        self.held = 0
        return True

    def keep(self, key: object, value: object, size: int = 0) -> None:
        """size: bytes of key and value, as far as they vary."""
        self[key] = value
        self.held += size + ENTRY


class Encoder:
    """Texts to ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, name: str) -> None:
        import tiktoken

        self.name = name
        with open(path(name), encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        self.end = model["end_of_word_suffix"] or ""
        self.specials = {x["content"]: packed([x["id"]]) for x in added}
        self.parted = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")").split
        code = {c: b for b, c in enumerate(byte_letters())}

        def key(token: str) -> bytes:
            last = bool(self.end) and token.endswith(self.end)
            return bytes([code[c] for c in (token.removesuffix(self.end) if last else token)]) + WORD_END.encode() * last

        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        order = [model["vocab"][a + b] for a, b in merges]
        singles = [i for t, i in model["vocab"].items() if len(t.removesuffix(self.end) if self.end else t) == 1]
        if order != sorted(order) or max(singles) > order[0]:
            raise ValueError("ids that do not follow the order of the merges are no ranks")
        ranks = {key(t): i for t, i in model["vocab"].items() if t not in self.specials}
        self.ranks = tiktoken.Encoding(name, pat_str=rf"[^{WORD_END}]+{WORD_END}" if self.end else BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(WORD_PATTERN, regex.V0).findall
        self.parting = packed([model["vocab"][byte_letters()[ord(PARTING)] + self.end]]) if self.end else b""
        self.pieces = Store()

    @cached_property
    def library(self) -> Tokenizer:
        """The tokenizers library's own; texts without word ends or odd pieces never need it."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(path(self.name))
        out.no_truncation()
        out.no_padding()
        return out

    def ranked(self, text: str) -> bytes:
        return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def by_library(self, text: str) -> bytes:
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def has_special(self, text: str) -> bool:
        return "<|" in text and any(x in text for x in self.specials)

    def learn(self, pieces: list[str]) -> None:
        """Ids of new pieces into the store, all in one pass."""
        odd = [x for x in pieces if WORD_END in x or PARTING in x or "<|" in x]
        for x in odd:
            ids = self.by_library(x)
            self.pieces.keep(x, ids, len(x) + len(ids))
        if odd:
            pieces = list(set(pieces).difference(odd))
        plain = [x for x in pieces if x.isascii()]
        other = [x for x in pieces if not x.isascii()] if len(plain) < len(pieces) else []
        for some, lower, split in ((plain, str.lower, ASCII_SPLIT), (other, self.library.normalizer.normalize_str, self.split)):
            if some:
                text = f" {PARTING} ".join(some)
                found = self.ranked(WORD_END.join([*split(lower(text)), ""]))
                self.pieces.update(zip(some, parts(found, self.parting), strict=True))
                self.pieces.held += len(text) + len(found) + ENTRY * len(some)

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text."""
        if not self.end:
            for x in texts:
                yield b"".join([self.specials.get(p) or self.ranked(p) for p in self.parted(x)]) if self.has_special(x) else self.ranked(x)
            return
        start = 0
        while start < len(texts):
            cut, size = [], 0
            while start < len(texts) and (size < CHUNK or not cut):
                cut.append(texts[start].split(" "))
                size += len(texts[start])
                start += 1
            self.pieces.full()
            new = set().union(*cut).difference(self.pieces)
            new.discard("")
            self.learn(list(new))
            self.pieces.setdefault("", b"")
            get = self.pieces.__getitem__
            for x in cut:
                yield b"".join(map(get, x))

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


def parts(data: bytes, by: bytes) -> Iterator[bytes]:
    """data between the places of the 4-byte value `by`."""
    ids = np.frombuffer(data, "<u4")
    ends = (np.flatnonzero(ids == np.frombuffer(by, "<u4")[0]) * 4).tolist()
    at = 0
    for end in [*ends, len(data)]:
        yield data[at:end]
        at = end + 4


@lru_cache(4)
def encoder(name: str) -> Encoder:
    """One encoder a worker process. word_bpe_49k.json drops white space, byte_bpe_50k.json keeps it."""
    return Encoder(name)
