"""Periodic runs of words, found by scanning Lyndon stacks under both orders.

A run is a stretch of words with smallest period q that no neighbouring word extends, here with at least LEAST_WORDS
words and LEAST_PERIODS periods. The longest Lyndon word from each place is read off a stack of next smaller suffixes,
filled from right to left, once under an order of the words and once under its reverse; every run has a Lyndon root
under one of them, and a root that comes again at once is extended to both sides. Suffixes are compared, and roots
extended, by the longest common extension: a binary search over rolling hashes, whose answer is then verified word by
word, so that hashes decide nothing. Extensions at one distance are kept, since those of a run end at one place.

Only stretches that may hold a run are scanned. In a run of 4 q >= 4 words or more, of at least 6, each four words in
a row come again at a distance of at most q, so a run lies in a stretch of consecutive places whose four words come
again within a quarter of the stretch. Nothing else is left out, and what is scanned holds whole runs.

Documents are independent: nothing is shuffled, and a lost task is only run again. A text takes about 20 times its bytes
while its words are numbered; hashes and stacks exist for one stretch at a time.

Defined cases: null and blank text have no words and no run; rows are judged one by one, so repeated rows and null
doc_ids are kept; ties among runs are none, since start and period tell runs apart; an empty table gives an empty
result; columns besides doc_id, text and those to carry are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressrun.llm._base import text_or_empty, trim

LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words in a row by which places are compared; words of one pass; words that keep their number between texts.
GRAM, PASS_WORDS, STORE = 4, 500_000, 1_000_000
BASE, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Extensions:
    """Longest common extensions of a list of numbers, to the right and to the left."""

    def __init__(self, w: list[int]) -> None:
        self.w, self.n = w, len(w)
        self.power = [1] * (self.n + 1)
        self.sums = [0] * (self.n + 1)
        p = 1
        s = 0
        for i, x in enumerate(w):
            s = (s * BASE + x + 1) & MASK
            p = p * BASE & MASK
            self.sums[i + 1], self.power[i + 1] = s, p
        self.known: dict[int, tuple[int, int]] = {}

    def same(self, i: int, j: int, n: int) -> bool:
        s, p = self.sums, self.power[n]
        return (s[i + n] - s[i] * p - s[j + n] + s[j] * p) & MASK == 0

    def search(self, i: int, j: int, most: int) -> int:
        """How many words agree from i and j on, at most `most`."""
        if not most or self.w[i] != self.w[j]:
            return 0
        low, high = 1, 2
        while high <= most and self.same(i, j, high):
            low, high = high, 2 * high
        high = min(high, most + 1)
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self.same(i, j, mid) else (low, mid)
        w = self.w
        if w[i : i + low] != w[j : j + low]:
            low = next(k for k in range(low) if w[i + k] != w[j + k])
        return low

    def right(self, i: int, j: int) -> int:
        """Words that agree from i < j on. What is known of a distance is the stretch [lo, hi) in which all its words agree, up to one that does not."""
        d = j - i
        lo, hi = self.known.get(d, (self.n, -1))
        if lo <= i <= hi:
            return hi - i
        if i < lo and hi >= 0:
            n = self.search(i, j, lo - i)
            hi = hi if n == lo - i else i + n
        else:
            hi = i + self.search(i, j, self.n - j)
        self.known[d] = (i, hi)
        return hi - i

    def left(self, i: int, j: int) -> int:
        """Words that agree before i < j."""
        w = self.w
        if not i or w[i - 1] != w[j - 1]:
            return 0
        low, high = 1, 2
        while high <= i and self.same(i - high, j - high, high):
            low, high = high, 2 * high
        high = min(high, i + 1)
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self.same(i - mid, j - mid, mid) else (low, mid)
        if w[i - low : i] != w[j - low : j]:
            low = next(k for k in range(low) if w[i - 1 - k] != w[j - 1 - k])
        return low


def runs(w: list[int], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """start, length, period of the runs of a list of numbers, by start and period. least_periods: 3 or more, so that a root comes again whole."""
    n, found = len(w), set()
    if n < least_words:
        return []
    ext = Extensions(w)
    for v in (w, [-x for x in w]):
        ext.known.clear()
        next_smaller = [n] * (n + 1)
        met: dict[int, tuple[int, int]] = {}
        for i in range(n - 2, -1, -1):
            j, a = i + 1, v[i]
            while j < n:
                b = v[j]
                if a > b:
                    break
                if a == b:
                    k = ext.right(i, j)
                    if j + k >= n or v[i + k] > v[j + k]:
                        break
                j = next_smaller[j]
            next_smaller[i] = j
            if j < n and a == v[j]:
                q, k = j - i, ext.right(i, j)
                start, end = met.get(q, (n, n))
                if k >= q and not (start <= i and j <= end):
                    back = ext.left(i, j)
                    met[q] = i - back, j + k
                    if q + k + back >= max(least_words, least_periods * q):
                        found.add((i - back, q + k + back, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 word of the stretches that may hold a run. ids: the words of texts that end at `ends`."""
    none = np.empty(0, "i8"), np.empty(0, "i8")
    n = len(ids) - GRAM + 1
    if n < 1:
        return none
    lengths = np.diff(ends, prepend=0)
    text = np.repeat(np.arange(len(ends), dtype="u8"), lengths)
    key = text[:n] * np.uint64(BASE)
    for k in range(GRAM):
        key = (key + ids[k : k + n].astype("u8")) * np.uint64(BASE)
        key ^= key >> np.uint64(29)
    at = np.flatnonzero(text[:n] == text[GRAM - 1 :])
    key = key[at]
    bits = max(10, int(4 * len(at)).bit_length())
    slot = (key >> np.uint64(64 - bits)).astype("i8")
    several = np.bincount(slot, minlength=1)[slot] > 1
    at, key = at[several], key[several]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    gap = np.where(same, np.diff(at[order]), len(ids))
    near = np.empty(len(at), "i8")
    near[order] = np.minimum(np.append(gap, len(ids)), np.insert(gap, 0, len(ids))) if len(at) else 0
    keep = near < len(ids)
    while True:
        at, near = at[keep], near[keep]
        if not len(at):
            return none
        first = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])))
        words = np.diff(np.append(first, len(at))) + GRAM - 1
        keep = LEAST_PERIODS * near <= np.repeat(words, np.diff(np.append(first, len(at))))
        keep &= np.repeat(words >= LEAST_WORDS, np.diff(np.append(first, len(at))))
        if keep.all():
            return at[first], at[first] + words


def runs_of_texts(texts: list[list[bytes]], store: dict[bytes, int]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given by its words."""
    ends = np.cumsum([len(x) for x in texts], dtype="i8")
    ids = np.fromiter((store[x] for words in texts for x in words), "i8", int(ends[-1]) if len(ends) else 0)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    firsts, lasts = stretches(ids, ends)
    for d, a, b in zip(np.searchsorted(ends, firsts, side="right").tolist(), firsts.tolist(), lasts.tolist()):
        before = a - int(ends[d]) + len(texts[d])
        out[d] += [(s + before, n, q) for s, n, q in runs(ids[a:b].tolist())]
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run contains after its first period."""
    if found:
        edge = np.zeros(len(words) + 1, "i8")
        for start, length, period in found:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = list(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))
    return b" ".join(words)


def _passes(texts: list[bytes | None], most: int) -> Iterator[list[list[bytes]]]:
    """Words of texts, in order, about `most` at a time; a longer text is alone."""
    part, size = [], 0
    for text in texts:
        words = (text or b"").split()  # of bytes, at \x20 and \x09 to \x0D alone
        if part and size + len(words) > most:
            yield part
            part, size = [], 0
        part.append(words)
        size += len(words)
    if part:
        yield part


def collapse(docs: DataFrame, carry: list[str] = [], pass_words: int = PASS_WORDS) -> DataFrame:  # noqa: B006
    """doc_id, runs (start, length, period in words, by start and period), collapsed (words joined by one space) of each row, and its columns `carry`."""
    rows = docs.select("doc_id", *carry, text_or_empty().cast("binary").alias("text_bytes_"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), f"runs {RUNS}", "collapsed string"])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store: dict[bytes, int] = defaultdict(count().__next__)
        for batch in batches:
            found: list[list[tuple[int, int, int]]] = []
            left: list[str] = []
            for texts in _passes(batch.column("text_bytes_").to_pylist(), pass_words):
                if len(store) > STORE:
                    store = defaultdict(count().__next__)
                some = runs_of_texts(texts, store)
                found += some
                left += [collapsed(words, r).decode() for words, r in zip(texts, some)]
            held = [batch.column(i) for i in range(batch.num_columns - 1)]
            made = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found], kind)
            yield pa.RecordBatch.from_arrays([*held, made, pa.array(left, pa.string())], [*batch.schema.names[:-1], "runs", "collapsed"])
        trim()

    return rows.mapInArrow(run, schema)


def planted(docs: DataFrame) -> DataFrame:
    """docs where of each tenth document, by hash h of doc_id, the words from a on repeat with period p: a and p follow from h and the number of words."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    chosen = F.coalesce((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    g = F.floor(h / 10)
    split = docs.select("doc_id", "text", g.alias("g"), F.when(chosen, words).alias("words"))
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    sized = split.withColumn("n", n).withColumn("a", F.when(F.col("words").isNotNull(), a))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    sized = sized.withColumn("p", p)
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))), F.lit(1), F.col("n") - F.col("a"))
    whole = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return sized.select("doc_id", F.when(F.col("words").isNotNull(), whole).otherwise(F.col("text")).alias("text"))


def best(runs_: Column) -> Column:
    """The run with the greatest exact length / period; of equal ones the first."""
    nothing = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    more = lambda x, y: x.isNull() | (y["length"] * x["period"] > x["length"] * y["period"])
    return F.aggregate(runs_, nothing, lambda x, y: F.when(more(x, y), y).otherwise(x))


def digests(found: DataFrame) -> DataFrame:
    """Counts, the best run and digests of the runs and of the collapsed text."""
    said = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    said = F.when(F.size("runs") > 0, F.concat(said, F.lit("\n"))).otherwise("")
    top = found.withColumn("best", best(F.col("runs")))
    return top.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(said.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
