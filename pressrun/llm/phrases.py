"""Collocations: phrases that occur more often together than their parts do apart, by language.

Each shard of texts becomes a generalised suffix automaton of bounded depth. It is built level by level: places whose last
k words agree share a node, whose front (without the last word) and suffix link (without the first word) are nodes of
the level before; nodes that end at the same places form a state, with one endpos count for all its phrases. Counts of
all shards are added up by phrase.

A phrase is frequent only if all shorter ones in it are, so cheaper rounds come first, of depth 1, 2, and so on: shards send 32 bits
of a phrase's hash and its count, at most `least`, and where the sums reach `least` a bit is set in a bitmap of BITS bits (8 MB, whatever the
input). The next round's automata leave out nodes without a bit. Collisions and a full bitmap only let more phrases
pass: the last round counts phrases by their words, exactly.

Every cut of a candidate is scored with the counts of both parts, which are frequent too. What lies inside a longer candidate is
reached from it by suffix links, from each of its fronts. Products are decimals of 38 digits. The first rows of a language
are chosen among the first of each of SALTS parts of its candidates, so no task ranks a whole language.

Skew: a phrase is one record of a shard however often it occurs, and a shard sends a row for each part of its phrases, so rows are shards times
parts and phrases are added up part by part; frequent parts are joined by `join_hot`. Memory: a shard
is about SHARD_BYTES of texts, a longer text is a shard of its own (about 30 times its bytes); a lost task is run again from its texts.

Defined cases: null text counts as empty, null lang as `und`; rows are counted as they come, so repeated rows and null doc_ids
count; phrases never cross pieces; of cuts with the same score the first counts; ties go to the more frequent, then to the phrase
that comes first in UTF-8; an empty table gives an empty result; columns besides text and lang are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressrun.llm._base import join_hot, lean, materialize, shuffle_parts, text_or_empty
from pressrun.llm.minhash import mix

DEPTH, LEAST, TOP, SCALE, SHARE = 4, 30, 2000, 2_000_000, 80
#: Bytes of texts of a shard, numbered at a time, and that a part of the counts stands for; bits of a bitmap; parts of a language's ranking.
SHARD_BYTES, CHUNK_BYTES, PART_BYTES, BITS, SALTS = 12_000_000, 2_000_000, 64_000_000, 1 << 26, 64
BREAK = b"\xff"  # occurs in no UTF-8
TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 10 + b" ")
SENT = np.dtype([("key", "<u4"), ("n", "u1")])
BASE = np.uint64(0x9E3779B97F4A7C15)


def numbered(texts: list[bytes], store: dict[bytes, int]) -> np.ndarray:
    """The words of texts as numbers, 0 between pieces."""
    words = BREAK.join([b"", *texts, b""]).translate(TABLE).replace(BREAK, b" " + BREAK + b" ").split()
    return np.fromiter(map(store.__getitem__, words), "i4", len(words))


def new_store() -> dict[bytes, int]:
    store: dict[bytes, int] = defaultdict(count().__next__)
    store[BREAK]
    return store


@dataclass
class Level:
    """The nodes of one length: a place where each ends, how often it occurs, its front and its suffix link in the level before, its hash."""

    end: np.ndarray
    count: np.ndarray
    front: np.ndarray
    link: np.ndarray
    hash: np.ndarray


@dataclass
class States:
    """Endpos classes: a place where each ends, lengths of its longest and shortest phrase, count, state of its suffix link (-1: none)."""

    end: np.ndarray
    longest: np.ndarray
    shortest: np.ndarray
    count: np.ndarray
    link: np.ndarray


def automaton(ids: np.ndarray, hashes: np.ndarray, depth: int, filters: list[np.ndarray]) -> list[Level]:
    """The levels of the automaton of numbered pieces. hashes: of the words, from number 1 on; filters: bitmaps of levels 1, 2, ..."""
    n = len(hashes)
    end = np.zeros(n + 1, "i8")
    end[ids] = np.arange(len(ids))
    level = Level(end[1:], np.bincount(ids, minlength=n + 1)[1:], np.full(n, -1), np.full(n, -1), hashes)
    at = ids.astype("i8") - 1
    levels: list[Level] = []
    for k in range(1, depth + 1):
        if k > 1:
            place = np.flatnonzero((at[1:] >= 0) & (at[:-1] >= 0)) + 1
            nodes = len(levels[-1].end)
            key, first, node, times = np.unique(at[place - 1] * nodes + at[place], return_index=True, return_inverse=True, return_counts=True)
            at = np.full(len(ids), -1)
            at[place] = node
            front, end = key // max(1, nodes), place[first]
            level = Level(end, times, front, key - front * nodes, mix(levels[-1].hash[front] * BASE + hashes[ids[end] - 1]))
        if k <= len(filters):
            keep = passing(level.hash, filters[k - 1])
            at = np.append(np.where(keep, np.cumsum(keep) - 1, -1), -1)[at]
            level = Level(*[getattr(level, f)[keep] for f in ("end", "count", "front", "link", "hash")])
        levels.append(level)
    return levels


def states(levels: list[Level]) -> States:
    """Nodes that occur equally often as their link ends at share its state: both end at the same places."""
    start = np.cumsum([0, *[len(x.end) for x in levels]])
    top = np.arange(start[-1])
    link = np.full(start[-1], -1)
    for k in range(len(levels) - 1, 0, -1):
        level, below = levels[k], levels[k - 1]
        own = np.arange(start[k], start[k + 1])
        link[own] = start[k - 1] + level.link
        same = level.count == below.count[level.link]
        top[link[own[same]]] = top[own[same]]
    length = np.repeat(np.arange(1, len(levels) + 1), np.diff(start))
    names, state = np.unique(top, return_inverse=True)
    shortest = np.full(len(names), len(levels) + 1)
    np.minimum.at(shortest, state, length)
    low = np.empty(len(names), "i8")
    least = length == shortest[state]
    low[state[least]] = np.flatnonzero(least)
    whole = lambda f: np.concatenate([getattr(x, f) for x in levels])
    return States(whole("end")[names], length[names], shortest, whole("count")[names], np.where(link[low] >= 0, state[link[low]], -1))


def phrases(found: States, ids: np.ndarray, words: list[str]) -> tuple[list[str], list[int]]:
    """All phrases of the states and their counts. words: by number, from 1 on."""
    out: list[str] = []
    times: list[int] = []
    for size in range(1, int(found.longest.max(initial=0)) + 1):
        some = (found.shortest <= size) & (found.longest >= size)
        rows = ids[found.end[some][:, None] + np.arange(1 - size, 1)] - 1
        columns = [[words[i] for i in column] for column in rows.T.tolist()]
        out += columns[0] if size == 1 else map(" ".join, zip(*columns))
        times += found.count[some].tolist()
    return out, times


def passing(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bit = (hashes >> np.uint64(32)) % np.uint64(BITS)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype("u1")) & 1 > 0


def shards(batches: Iterator[pa.RecordBatch], most: int = SHARD_BYTES) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """lang, numbered pieces and words of about `most` bytes of texts of one language."""
    held: dict[str, tuple[dict[bytes, int], list[np.ndarray]]] = {}
    sizes: dict[str, int] = defaultdict(int)

    def done(lang: str) -> tuple[str, np.ndarray, list[bytes]]:
        store, parts = held.pop(lang)
        sizes.pop(lang)
        return lang, np.concatenate(parts), list(store)[1:]

    for batch in batches:
        waiting: dict[str, list[bytes]] = defaultdict(list)
        waits: dict[str, int] = defaultdict(int)
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            waiting[lang].append(text.as_py())
            waits[lang] += len(waiting[lang][-1])
            if waits[lang] >= CHUNK_BYTES:
                yield from _number(lang, waiting.pop(lang), waits.pop(lang), held, sizes, done, most)
        for lang, texts in waiting.items():
            yield from _number(lang, texts, waits[lang], held, sizes, done, most)
        while sum(sizes.values()) >= most:  # of many languages the largest goes
            yield done(max(sizes, key=sizes.__getitem__))
    for lang in list(held):
        yield done(lang)


def _number(lang: str, texts: list[bytes], size: int, held: dict, sizes: dict, done, most: int) -> Iterator:
    if lang not in held:
        held[lang] = new_store(), []
    held[lang][1].append(numbered(texts, held[lang][0]))
    sizes[lang] += size
    if sizes[lang] >= most:
        yield done(lang)


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), "u8", len(words))


def frequent(texts: DataFrame, filters: list[np.ndarray], least: int, parts: int, shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """The bitmap of the phrases one word longer than the filters are for, with a bit for each one that occurs `least` times or more."""
    depth = len(filters) + 1
    given = texts.sparkSession.sparkContext.broadcast(filters)
    enough = min(least, 255)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, words in shards(batches, shard_bytes):
            level = automaton(ids, word_hashes(lang, words), depth, given.value)[-1]
            part = (level.hash & np.uint64(0xFFFFFFFF)) % np.uint64(parts)
            rows = np.empty(len(part), SENT)
            rows["key"], rows["n"] = level.hash >> np.uint64(32), np.minimum(level.count, enough)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype="u8"))
            data = rows[order]
            kept = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array([data[cuts[i] : cuts[i + 1]].tobytes() for i in kept], pa.binary())], ["part", "data"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(group["data"]), SENT)
        order = np.argsort(rows["key"], kind="stable")
        key = rows["key"][order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        total = np.add.reduceat(rows["n"][order].astype("i8"), first)
        return pd.DataFrame({"bit": np.unique(key[first[total >= enough]] % BITS).astype("i8") + 1})

    bits = texts.mapInArrow(lean(send), "part long, data binary").groupBy("part").applyInPandas(add, "bit long")
    maps = bits.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    out = np.zeros(BITS // 8, "u1")
    for bucket, bitmap in maps.collect():  # BITS bits at most
        at = (bucket - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bitmap, "u1")[: len(out) - at]
    return out


def sent(texts: DataFrame, filters: list[np.ndarray], depth: int, parts: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """part, lang, phrases, n: of each shard a row for each part of its phrases, with their counts; an empty phrase stands for all words."""
    given = texts.sparkSession.sparkContext.broadcast(filters)

    def count_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, words in shards(batches, shard_bytes):
            found = states(automaton(ids, word_hashes(lang, words), depth, given.value))
            names, times = phrases(found, ids, [w.decode("utf-8", "replace") for w in words])
            data = [x.encode() for x in [*names, ""]]
            n = np.array([*times, int((ids > 0).sum())], "u4")  # words of one shard
            seed = crc32(lang.encode())
            part = np.fromiter((crc32(x, seed) for x in data), "i8", len(data)) % parts
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            kept = np.flatnonzero(np.diff(cuts))
            some = [order[cuts[i] : cuts[i + 1]] for i in kept]
            columns = [pa.array(kept, pa.int64()), pa.array([lang] * len(kept), pa.string()), pa.array([b"\n".join([data[j] for j in x.tolist()]) for x in some], pa.binary()), pa.array([n[x].tobytes() for x in some], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "lang", "phrases", "n"])

    return texts.mapInArrow(lean(count_), "part long, lang string, phrases binary, n binary")


def counts(texts: DataFrame, filters: list[np.ndarray], depth: int, least: int, shard_bytes: int = SHARD_BYTES, parts: int | None = None) -> DataFrame:
    """lang, phrase, n of all phrases of up to `depth` words that occur `least` times, and of each lang, with an empty phrase, all words."""

    def add(group: pa.Table) -> pa.Table:
        langs: list[pa.Array] = []
        names: list[pa.Array] = []
        for lang, data in zip(group["lang"].to_pylist(), group["phrases"]):
            names.append(pa.array(data.as_py().split(b"\n"), pa.binary()).cast(pa.string()))  # no phrase has a line break
            langs.append(pa.repeat(lang, len(names[-1])))
        n = np.frombuffer(b"".join(group["n"].to_pylist()), "u4").astype("i8")
        rows = pa.table({"lang": pa.chunked_array(langs, pa.string()), "phrase": pa.chunked_array(names, pa.string()), "n": n})
        total = rows.group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["lang", "phrase", "n"])
        return total.filter(pc.or_(pc.greater_equal(total["n"], least), pc.equal(total["phrase"], "")))

    return sent(texts, filters, depth, parts or shuffle_parts(texts.sparkSession), shard_bytes).groupBy("part").applyInArrow(add, "lang string, phrase string, n long")


def mine(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, top: int = TOP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first `top` collocations of 2 to `depth` words of each lang. least: at most 255."""
    spark = docs.sparkSession
    texts = docs.select(text_or_empty().cast("binary").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    parts, filters = max(shuffle_parts(spark), size // PART_BYTES + 1), []
    for _ in range(max(1, depth - 1)):
        filters.append(frequent(texts, filters, least, parts, shard_bytes))
    known = materialize(counts(texts, filters, depth, least, shard_bytes, parts), "phrases")
    words = known.where("phrase = '' AND n > 0").select("lang", F.col("n").alias("n"))
    named = known.where("phrase <> ''").withColumn("key", F.concat_ws(" ", "lang", "phrase"))
    found = named.where(F.col("phrase").contains(" ")).select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    # What suffix links reach from the fronts of a longer candidate: all that lies inside it.
    size_ = F.size("w")
    fronts = F.transform(F.sequence(F.lit(2), size_), lambda m: F.slice("w", F.lit(1), m))
    inside = F.flatten(F.transform(fronts, lambda f: F.transform(F.sequence(F.lit(2), F.size(f)), lambda m: F.slice(f, F.size(f) - m + 1, m))))
    longer = found.where(size_ > 2).select("lang", F.col("a").alias("f"), F.explode(F.array_except(inside, F.array("w"))).alias("x"))
    most = longer.groupBy("lang", F.array_join("x", " ").alias("phrase")).agg(F.max("f").alias("most"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    open_ = found.join(most, ["lang", "phrase"], "left").where(F.col("most").isNull() | (exact("most") * 100 < exact("a") * SHARE))

    cuts = open_.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    side = lambda x: F.concat_ws(" ", "lang", F.array_join(x, " "))
    cuts = materialize(cuts.select("lang", "phrase", "a", "k", side(F.slice("w", F.lit(1), F.col("k"))).alias("first"), side(F.slice("w", F.col("k") + 1, F.size("w"))).alias("rest")), "phrases-cuts")
    total = cuts.count()
    for part, name in (("first", "l"), ("rest", "r")):
        uses = cuts.groupBy(part).agg(F.count("*").alias("uses")).join(named.select(F.col("key").alias(part), F.col("n").alias(name)), part)
        cuts = join_hot(cuts, uses, part, "uses", total).drop("uses", part)
    cuts = cuts.withColumn("score", F.expr(f"(CAST(a AS DECIMAL(20,0)) * {SCALE}BD) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    least_cut = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(least_cut.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("rank") <= top)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)  # SALTS * top rows a lang
    return first.join(F.broadcast(words), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pc AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
ws AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pc),
g AS (SELECT lang, w, unnest(range(len(w))) AS i FROM ws),
c AS (SELECT lang, k, array_to_string(w[i + 1 : i + k], ' ') AS phrase, count(*) AS f FROM g, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS w FROM c WHERE k > 1 AND f >= 30),
inside AS (SELECT lang, w, a, size, unnest(range(2, size)) AS m FROM cand WHERE size > 2),
parts AS (SELECT lang, w, a, m, unnest(range(size - m + 1)) AS i FROM inside),
most AS (SELECT lang, array_to_string(w[i + 1 : i + m], ' ') AS phrase, max(a) AS most FROM parts GROUP BY ALL),
kept AS (SELECT cand.* FROM cand LEFT JOIN most USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM kept),
s AS (SELECT cuts.lang, cuts.phrase, a, cuts.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score FROM cuts
      JOIN c x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1 : cuts.k], ' ') JOIN c y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[cuts.k + 1 : size], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= 2000
"""
