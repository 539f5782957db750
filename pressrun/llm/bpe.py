"""Byte-pair encoding with forced boundaries, and decoding.

A pair of bytes that stands side by side inside no token of the vocabulary can never be merged across: a word is
certainly cut there. Words are split at all such places, the fragments are encoded one by one by the merge
ranks, and their ids are concatenated. Fragments and words repeat, so their results are kept in bounded stores.

Defined cases: null text counts as empty and has no ids (hashes are those of the empty string); special tokens
in a text get their ids, as the library gives them; repeated rows are each returned; an empty table gives an
empty result; columns besides doc_id and text are not read. A row is encoded alone, so a task holds one batch.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame

from pressrun.llm._base import text_or_empty
from pressrun.llm.tokens import ASCII_SPLIT, ENTRY, STORE_BYTES, WORD_PATTERN, Store, byte_letters, path

END = "</w>"
#: Letters of a fragment that is merged in a list.
LONG = 64


class Spelled(Store):
    """Of each word the ids of its tokens as text, and in `names` their names. A new word is encoded when it is asked for."""

    def __init__(self, bpe: ForcedBPE) -> None:
        super().__init__(2 * STORE_BYTES)
        self.bpe, self.names = bpe, {}

    def __missing__(self, word: str) -> str:
        bpe = self.bpe
        found = [bpe.specials[word]] if word in bpe.specials else bpe.merged(word)
        ids, names = " ".join(map(str, found)), bpe.decode(found)
        self.keep(word, ids, len(word) + len(ids) + len(names) + ENTRY)
        self.names[word] = names
        return ids

    def full(self) -> bool:
        if super().full():
            self.names.clear()
            return True
        return False


class ForcedBPE:
    """A vocabulary whose words end in a marker, as word_bpe_49k.json."""

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["end_of_word_suffix"] != END or model["continuing_subword_prefix"]:
            raise ValueError("a vocabulary with word ends is needed")
        self.ids: dict[str, int] = model["vocab"]
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        made = [self.ids[a + b] for a, b in merges]
        if made != sorted(made):
            raise ValueError("ids that do not follow the order of the merges are no ranks")
        #: From two ids side by side to the id of both, which is its rank too.
        self.merges = {self.ids[a] << 32 | self.ids[b]: i for (a, b), i in zip(merges, made)}
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.specials.items()}
        inside = {t[i : i + 2] for t in (x.removesuffix(END) for x in self.ids) for i in range(len(t) - 1)}
        letters = byte_letters()
        self.letters = letters
        #: Pairs of byte letters that certainly part two tokens.
        self.forced = {a + b for a in letters for b in letters if a + b not in inside}
        self.normalizer = Tokenizer.from_file(file).normalizer
        self.split = regex.compile(WORD_PATTERN, regex.V0).findall
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")").split
        self.fragments, self.words = Store(STORE_BYTES // 2), Store()
        self.spelled = Spelled(self)

    def cut(self, word: str) -> list[str]:
        """A word in byte letters, split at its forced boundaries."""
        places = [i + 1 for i in range(len(word) - 1) if word[i : i + 2] in self.forced]
        if not places:
            return [word]
        return [word[a:b] for a, b in zip([0, *places], [*places, len(word)])]

    def merge(self, symbols: list[str]) -> list[int]:
        """Merges the adjacent pair of least rank until no pair has one.

        A merge makes pairs of higher rank only, so equal pairs are taken one by one from the left. After each only
        the ranks of its two neighbours change.
        """
        if len(symbols) > LONG:
            return self.merge_long(symbols)
        ids, rank, none = [self.ids[x] for x in symbols], self.merges.get, 1 << 60
        ranks = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            ids[i] = least
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 32 | least, none)
            if i < len(ranks):
                ranks[i] = rank(least << 32 | ids[i + 1], none)
        return ids

    def merge_long(self, symbols: list[str]) -> list[int]:
        """The same merges from a heap over linked ids: n log n for a word of n letters. -1: merged into the one before."""
        ids, n, rank = [self.ids[x] for x in symbols], len(symbols), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank(a << 32 | b)) is not None]
        heapify(heap)
        while heap:
            found, i = heappop(heap)
            j = after[i]
            if j == n or ids[i] < 0 or rank(ids[i] << 32 | ids[j]) != found:
                continue  # one of the two has merged since
            ids[i], ids[j] = found, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := rank(found << 32 | ids[after[i]])) is not None:
                    heappush(heap, (r, i))
            if before[i] >= 0 and (r := rank(ids[before[i]] << 32 | found)) is not None:
                heappush(heap, (r, before[i]))
        return [x for x in ids if x >= 0]

    def word(self, word: str) -> list[int]:
        out = self.words.get(word)
        if out is None:
            out = self.merged(word)
            self.words.keep(word, out, len(word) + 8 * len(out))
        return out

    def merged(self, word: str) -> list[int]:
        mapped = word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode()])
        out = []
        parts = self.cut(mapped)
        for i, part in enumerate(parts):
            last = i == len(parts) - 1
            key = part + END if last else part
            found = self.fragments.get(key)
            if found is None:
                symbols = list(part)
                if last:
                    symbols[-1] += END
                found = self.merge(symbols)
                if len(parts) > 1:  # a word of one fragment is kept as a word
                    self.fragments.keep(key, found, len(key) + 8 * len(found))
            out += found
        return out

    def plain(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        return ASCII_SPLIT(text.lower()) if text.isascii() else self.split(self.normalizer.normalize_str(text))

    def parted(self, text: str) -> list[str]:
        """The words and special tokens of a text. No word reads like a special token, which has letters and signs."""
        if "<|" not in text:
            return self.plain(text)
        return [w for x in self.special_split(text) for w in ([x] if x in self.specials else self.plain(x))]

    def decode(self, ids: list[int]) -> str:
        """As the library decodes a vocabulary without a decoder: the names of the tokens, joined by blanks."""
        return " ".join([self.names[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        return [i for w in self.parted(text) for i in ([self.specials[w]] if w in self.specials else self.word(w))]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the ids and of the decoded text, of each text. Both are put together from what is kept of each distinct word."""
        out, spelled, names = [], self.spelled.__getitem__, self.spelled.names.__getitem__
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for text in texts:
            self.fragments.full()
            self.spelled.full()
            words = self.parted(text)
            ids = " ".join(map(spelled, words))  # learns new words, names too
            out.append((ids.count(" ") + 1 if words else 0, sha(ids), sha(" ".join(map(names, words)))))
        return out

    def digest(self, text: str) -> tuple[int, str, str]:
        return self.digests([text])[0]


@lru_cache(2)
def load(file: str) -> ForcedBPE:
    return ForcedBPE(file)


def encode_decode(docs: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row; no shuffle."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path(name))
        for batch in batches:
            found = bpe.digests(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": [x[0] for x in found], "ids_sha256": [x[1] for x in found], "decoded_sha256": [x[2] for x in found]})

    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
