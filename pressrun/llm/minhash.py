"""Near-duplicates: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

A document's set holds its distinct shingles of `shingle` words; words are ASCII-lower-cased and parted by
[\\x20\\x09-\\x0D]. Texts with one sequence of words share one set, so they are one node, whose id is their least
doc_id, and only distinct texts are compared. Each element of a set walks through one random permutation of the
signature's places, rank by rank, and offers rank + fraction to the place it meets; once every place of a
document holds less than the next rank, its later ranks cannot matter and it stops early.

Each bucket of a band links its members to its hub, the member with most neighbours over all bands: these pairs are
confirmed by the exact Jaccard similarity of the full sets. What a hub gathered over all bands is its group, so two
members of one bucket lie in one group at least. Where a group still holds several components, its members are compared
across components: first by signatures, which name the members that may have a link, then these by their full sets. Both
go in blocks, every two blocks meet once, and a task gives back members or the links that join components, never pairs,
so what moves grows with the members of a group and its blocks.

Pairs whose signatures agree in fewer than `least_agree` of 200 places are taken as no links: at the threshold a pair
agrees in 160 on average, so few with a chance of about 1e-6; least_agree = 0 compares all full sets. The chance that a
pair at the threshold meets in no band is (1 - 0.8^5)^40, about 1e-7, and less above it.

Defined cases: null, empty or blank text has an empty set and is linked with nothing; fewer words than a shingle
make one shingle; ties go to the least doc_id; rows that share a doc_id are one node; rows with a null doc_id
are returned with a null component and kept; an empty table gives an empty result; columns besides doc_id and
text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressrun.llm._base import among, join_hot, lean, materialize, shuffle_parts, text_or_empty
from pressrun.llm.graph import components

CUT = re.compile(rb"[ \t\n\x0b\f\r]")
#: Elements of one signature pass in a task, bytes of text that are hashed at once.
CHUNK, SLICE = 100_000, 500_000
#: Links that one copy of a hub confirms; members of one block of signatures; rows of blocks in a task.
STAR, BLOCK, TASK_ROWS = 512, 3_000, 20_000
#: Bytes of one block of full sets, and of blocks in a task.
BLOCK_BYTES, TASK_BYTES = 2_000_000, 8_000_000


@dataclass(frozen=True)
class NearDup:
    shingle: int = 2
    percent: int = 80
    bands: int = 40
    rows: int = 5
    least_agree: float = 0.65

    @property
    def places(self) -> int:
        return self.bands * self.rows


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15
_spaces = np.isin(np.arange(256), list(b" \t\n\x0b\f\r"))
_powers = np.ones(1, "u8")


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.append(np.uint64(1), np.full(max(1023, 2 * n), BASE, "u8")))
    return _powers


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of lower-case bytes, and where the word starts."""
    letters = np.frombuffer(data, "u1")
    space = _spaces[letters]
    before = np.append(True, space[:-1])
    starts = np.flatnonzero(before & ~space)
    if not len(starts):
        return np.empty(0, "u8"), starts
    lengths = np.diff(np.append(starts, len(letters)))
    inside = np.arange(starts[0], len(letters)) - np.repeat(starts, lengths)
    letters, space = letters[starts[0] :], space[starts[0] :]
    longest = int(inside[~space].max()) + 1
    terms = np.where(space, np.uint64(0), (letters + np.uint64(1)) * _powers_to(longest)[np.minimum(inside, longest - 1)])
    return mix(np.add.reduceat(terms, starts - starts[0])), starts


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the words of each text. Slices are cut at white space, so a text of any length needs little room."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        found, starts = _hashes(b" ".join([x for _, x in held]))
        ends = np.cumsum([len(x) + 1 for _, x in held])
        for (i, _), part in zip(held, np.split(found, np.searchsorted(starts, ends[:-1]))):
            out[i].append(part)
        held.clear()
        size = 0

    for i, text in enumerate(texts):
        data, at = text.encode("utf-8", "surrogatepass").lower(), 0
        while at < len(data) or at == 0:
            end = at + SLICE
            if end < len(data):
                found = CUT.search(data, end)
                end = found.start() if found else len(data)
            held.append((i, data[at:end]))
            size += end - at
            at = max(end, at + 1)
            if size >= SLICE:
                flush()
    if held:
        flush()
    return [np.concatenate(x) for x in out]


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a sequence of word hashes."""
    if not len(words):
        return np.empty(0, "u8")
    n = max(1, len(words) - k + 1)
    acc = mix(words[:n] + np.uint64(BASE))
    for i in range(1, min(k, len(words))):
        acc = mix(acc * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n])
    return np.unique(acc)


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash: a row of m values (rank * 2^32 + fraction) for each set; all ones for an empty set."""
    sig = np.full(len(sets) * m, ~np.uint64(0), "u8")
    sizes = np.array([len(x) for x in sets])
    doc = np.repeat(np.arange(len(sets)), sizes)
    elements = np.concatenate(sets) if len(sets) else np.empty(0, "u8")
    walk = None
    for rank in range(m):
        if not len(doc):
            break
        drawn = mix(elements + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        at = rank + (((drawn >> np.uint64(32)) * np.uint64(m - rank)) >> np.uint64(32)).astype("i8")
        if walk is None:
            place = at
        else:
            row = np.arange(len(doc))
            place = walk[row, at].astype("i8")
            walk[row, at] = walk[:, rank]
        np.minimum.at(sig, doc * m + place, (np.uint64(rank) << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF)))
        most = sig.reshape(-1, m).max(axis=1)
        active = (most >= np.uint64(rank + 1) << np.uint64(32))[doc]
        if walk is None:
            doc, elements, at = doc[active], elements[active], at[active]
            walk = np.tile(np.arange(m, dtype="u2"), (len(doc), 1))
            walk[np.arange(len(doc)), at] = 0
        elif not active.all():
            doc, elements, walk = doc[active], elements[active], walk[active]
    return sig.reshape(-1, m)


def sketch(docs: DataFrame, how: NearDup) -> DataFrame:
    """doc_id, n_shingles, key of the sequence of words, 16 bits of each place."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            start = 0
            while start < len(texts):
                held, end = 0, start
                while end < len(texts) and (held < 6 * CHUNK or end == start):
                    held += len(texts[end])
                    end += 1
                words = word_hashes(texts[start:end])
                sets = [shingles(x, how.shingle) for x in words]
                keys = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in words]
                sig = mix(signatures(sets, how.places)).astype("u2")
                yield pd.DataFrame({"doc_id": pd.array(ids[start:end], "object"), "n_shingles": [len(x) for x in sets], "key": keys, "sig": [x.tobytes() for x in sig]})
                start = end

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInPandas(lean(run), "doc_id long, n_shingles long, key binary, sig binary")


def full_sets(docs: DataFrame, ids: DataFrame, how: NearDup) -> DataFrame:
    """doc_id, shingles of the documents in ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "shingles": [shingles(x, how.shingle).view("i8") for x in word_hashes(batch["text"].tolist())]})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return among(texts, ids, "doc_id").mapInPandas(lean(run), "doc_id long, shingles array<long>")


def _meet(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """pairs (u, v) with the value of both, a and b. A u with many pairs is copied once for each STAR of them.

    The joins are named, so that plans do not change with the size of the table.
    """
    values = values.hint("merge")
    fans = pairs.groupBy("u").agg(((F.count("*") / STAR).cast("int") + 1).alias("fans"))
    left = fans.join(values.withColumnRenamed("doc_id", "u"), "u").select("u", F.explode(F.sequence(F.lit(0), F.col("fans") - 1)).alias("fan"), F.col(name).alias("a"))
    fanned = pairs.join(fans, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("fans")).cast("int").alias("fan"))
    right = fanned.join(values.select(F.col("doc_id").alias("v"), F.col(name).alias("b")), "v")
    return right.join(left.hint("merge"), ["u", "fan"]).select("u", "v", "a", "b")


def likely(pairs: DataFrame, sigs: DataFrame, how: NearDup) -> DataFrame:
    """The pairs (u, v) whose signatures agree often enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[c]), "u2").reshape(len(batch), how.places) for c in "ab")
            yield batch.loc[(a == b).sum(axis=1) >= how.least_agree * how.places, ["u", "v"]]

    return _meet(pairs, sigs, "sig").mapInPandas(lean(run), "u long, v long")


def confirm(pairs: DataFrame, sets: DataFrame, how: NearDup) -> DataFrame:
    """The pairs (u, v) that reach the threshold."""
    both = F.size(F.array_intersect("a", "b"))
    return _meet(pairs, sets, "shingles").where(100 * both >= how.percent * (F.size("a") + F.size("b") - both)).select("u", "v")


def in_blocks(rows: DataFrame, blocks: Column, parts: int) -> DataFrame:
    """rows (u, node, ...) of a group u dealt so that every two of its blocks meet in one part: adds own, i, j, part.

    The number of blocks follows from the group's size, so that no task holds a large group.
    """
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    met = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other")
    return met.withColumn("part", F.pmod(F.xxhash64("u", "i", "j"), F.lit(parts)))


def meetings(rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, bool]]:
    """Rows of each (u, i, j), and whether two blocks meet there."""
    u, i, j = (rows[c].to_numpy() for c in "uij")
    order = np.lexsort((j, i, u))
    u, i, j = u[order], i[order], j[order]
    new = np.flatnonzero(np.append(True, (u[1:] != u[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
    for a, b in zip(new, np.append(new[1:], len(order))):
        yield order[a:b], bool(i[a] != j[a])


def alike(sig: np.ndarray, sizes: np.ndarray, c: np.ndarray, own: np.ndarray, cross: bool, how: NearDup) -> np.ndarray:
    """Which members may have a link with one of another component (and of the other block, where two meet)."""
    out = np.zeros(len(c), bool)
    names, counts = np.unique(c, return_counts=True)
    if len(names) < 2:
        return out
    for r in np.flatnonzero(c != names[np.argmax(counts)]):
        may = (c != c[r]) & (100 * np.minimum(sizes, sizes[r]) >= how.percent * np.maximum(sizes, sizes[r]))
        if cross:
            may &= own != own[r]
        other = np.flatnonzero(may)
        close = other[(sig[other] == sig[r]).sum(axis=1) >= how.least_agree * how.places]
        if len(close):
            out[close] = out[r] = True
    return out


def joins(sets: list[np.ndarray], node: np.ndarray, c: np.ndarray, own: np.ndarray, cross: bool, percent: int) -> list[tuple[int, int]]:
    """Links between members of different components, as many as join what can be joined: at most one a component.

    Sets meet in inverted lists of the elements that several sets hold. What a set alone holds bounds its similarity with
    any other, so most members of a group of near copies are settled without looking at their lists.
    """
    names, root, counts = np.unique(c, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return []
    sizes = np.array([len(x) for x in sets])
    doc = np.repeat(np.arange(len(sets)), sizes)
    _, element, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    held = often[element] > 1
    doc, element = doc[held], element[held]
    most = np.bincount(doc, minlength=len(sets))
    lists = np.argsort(element, kind="stable")
    ends = np.cumsum(np.bincount(element, minlength=len(often)))
    listed, at = doc[lists], np.append(0, np.cumsum(most))
    out = []
    for r in np.flatnonzero(root != np.argmax(counts)):
        bound = np.minimum(most, most[r])
        may = (root != root[r]) & (100 * bound >= percent * (sizes + sizes[r] - bound))
        if cross:
            may &= own != own[r]
        if not may.any():
            continue
        mine = element[at[r] : at[r + 1]]
        runs = often[mine]
        places = np.arange(int(runs.sum())) + np.repeat(ends[mine] - np.cumsum(runs), runs)
        both = np.bincount(listed[places], minlength=len(sets))
        found = np.flatnonzero(may & (100 * both >= percent * (sizes + sizes[r] - both)))
        for k in found[np.unique(root[found], return_index=True)[1]]:
            out.append((int(min(node[r], node[k])), int(max(node[r], node[k]))))
            root[root == root[k]] = root[r]
    return out


def across(open_: DataFrame, nodes: DataFrame, docs: DataFrame, how: NearDup) -> DataFrame:
    """Links between components of one group. open_: u, n, node, c, stored."""
    spark = docs.sparkSession
    blocks = (F.col("n") / BLOCK + 1).cast("int")
    parts = max(shuffle_parts(spark), open_.agg(F.coalesce(F.sum(blocks.cast("long")), F.lit(0))).first()[0] // TASK_ROWS + 1)

    def mark(rows: pd.DataFrame) -> pd.DataFrame:
        node, c, own, sizes = (rows[x].to_numpy() for x in ("node", "c", "own", "n_shingles"))
        sig = np.frombuffer(b"".join(rows["sig"]), "u2").reshape(len(rows), how.places)
        out = [x[alike(sig[x], sizes[x], c[x], own[x], cross, how)] for x, cross in meetings(rows)]
        out = np.concatenate(out) if out else np.empty(0, "i8")
        return pd.DataFrame({"u": rows["u"].to_numpy()[out], "node": node[out], "c": c[out]})

    met = in_blocks(open_.join(nodes.select("node", "n_shingles", "sig").hint("merge"), "node"), blocks, parts).drop("n")
    marked = materialize(met.groupBy("part").applyInPandas(mark, "u long, node long, c long").distinct(), "minhash-marked")
    sized = marked.join(nodes.select("node", "n_shingles"), "node")
    groups = sized.groupBy("u").agg((F.sum("n_shingles") * 8 / BLOCK_BYTES + 1).cast("int").alias("blocks"), F.count("*").alias("n"))
    groups = materialize(groups, "minhash-groups")
    totals = sized.join(groups.select("u", "blocks"), "u").agg(F.coalesce(F.sum(F.col("n_shingles") * 8 * F.col("blocks")), F.lit(0)), F.count("*")).first()
    parts = max(shuffle_parts(spark), totals[0] // TASK_BYTES + 1)
    sets = full_sets(docs, marked.select(F.col("node").alias("doc_id")).distinct(), how).withColumnRenamed("doc_id", "node")

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        node, c, own = (rows[x].to_numpy() for x in ("node", "c", "own"))
        sets_ = [np.asarray(x) for x in rows["shingles"]]
        out = [p for x, cross in meetings(rows) for p in joins([sets_[k] for k in x], node[x], c[x], own[x], cross, how.percent)]
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    near = join_hot(marked, groups, "u", "n", totals[1]).drop("n").join(sets.hint("merge"), "node")
    return in_blocks(near, F.col("blocks"), parts).drop("blocks").groupBy("part").applyInPandas(link, "u long, v long")


def group(docs: DataFrame, how: NearDup = NearDup()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row."""
    rows = materialize(sketch(docs, how), "minhash")
    named = rows.where("doc_id IS NOT NULL AND key IS NOT NULL")
    # Rows of one key have one signature.
    nodes = named.groupBy("key").agg(F.min("doc_id").alias("node"), F.count("*").alias("n"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    nodes = materialize(nodes, "minhash-nodes")
    width = 2 * how.rows
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", 1 + k * width, width)) for k in range(how.bands)])
    spread = nodes.select("node", F.explode(bands).alias("bucket"))
    buckets = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    placed = materialize(join_hot(spread, buckets, "bucket", "n", nodes.count() * how.bands), "minhash-buckets")
    degree = placed.groupBy("node").agg(F.sum("n").alias("degree"))
    ranked = placed.join(degree, "node")
    hubs = ranked.groupBy("bucket", "n").agg(F.max_by("node", F.struct("degree", -F.col("node"))).alias("u"))
    stars = join_hot(placed.drop("n"), hubs, "bucket", "n", placed.count()).where("u <> node").groupBy("u", F.col("node").alias("v")).agg(F.max("n").alias("n"))
    stars = materialize(stars, "minhash-stars")
    pairs = materialize(likely(stars.select("u", "v"), nodes.select(F.col("node").alias("doc_id"), "sig"), how), "minhash-likely")
    ids = pairs.select(F.col("u").alias("doc_id")).unionByName(pairs.select(F.col("v").alias("doc_id"))).distinct()
    sets = materialize(full_sets(docs, ids, how), "minhash-sets")
    links = materialize(confirm(pairs, sets, how), "minhash-links")
    found = materialize(components(links), "minhash-components")

    # Groups whose members, but for the hub, lie in several components. Buckets of two members have met.
    met = stars.where("n > 2").select("u", F.col("v").alias("node")).join(found.withColumnRenamed("component", "c"), "node", "left").select("u", "node", F.coalesce("c", "node").alias("c"))
    met = materialize(met, "minhash-met")
    split = met.groupBy("u").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("n")).where("low <> high").select("u", "n")
    open_ = materialize(join_hot(met, split, "u", "n", met.count()).select("u", "n", "node", "c"), "minhash-open")
    more = materialize(across(open_, nodes, docs, how), "minhash-across")
    found = components(links.unionByName(more))
    classes = nodes.join(found, "node", "left").select("key", "n", F.coalesce("component", "node").alias("component_id"))
    # A doc_id whose rows have several texts is one node: they share their least component.
    grouped = join_hot(named.select("doc_id", "n_shingles", "key"), materialize(classes, "minhash-classes"), "key", "n", rows.count())
    alone = rows.where("doc_id IS NULL OR key IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = grouped.select("doc_id", "n_shingles", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE len(ws) WHEN 0 THEN [] WHEN 1 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 80 * (x.n + y.n - met)),
reach AS (SELECT doc_id AS id, doc_id AS least FROM n UNION SELECT b, least FROM reach JOIN links ON a = id),
c AS (SELECT id, min(least) AS component_id FROM reach GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id, coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.id = w.doc_id
"""
